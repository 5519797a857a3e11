"""Scalar text functions as column expressions (JVM side, no Python workers)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Endings of inflected Lithuanian words and their nominative, tried in this order.
LT_ENDINGS = [("ių", "ys"), ("ės", "ė"), ("io", "is"), ("ui", "us"), ("os", "a"), ("ą", "as"), ("ę", "ė"), ("į", "is")]
#: Esperanto endings, tried in this order.
FLEXION = ["as", "is", "os", "us", "u", "i", "o", "a", "e"]
#: Lines of amendments and publication notes.
AMENDMENT_LINE = r"(?i)^(?:Nr\.|Straipsnio|Papildyta|Ŝanĝoj|Aldonita|TAR pastaba|Noto pri|N-ro)"
AMENDMENT_CONTENT = r"(?i)publikigita en la TAR"
BLANKS = r"[ \t\n\r\x0B\f]+"


def strip(x: Column) -> Column:
    """Without blanks (the six ASCII ones and the no-break space) at either end; null stays null."""
    return F.regexp_replace(x, r"^[ \t\n\r\x0B\f\u00A0]+|[ \t\n\r\x0B\f\u00A0]+$", "")


def normalise(x: Column) -> Column:
    """Lower case, everything but a-z and 0-9 as one blank, trimmed; null becomes empty."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(x, F.lit(""))), "[^a-z0-9]+", " "))


def normalise_definition(x: Column) -> Column:
    return F.lower(strip(F.coalesce(x, F.lit(""))))


def nominative_lt(phrase: Column) -> Column:
    """The last word with its first fitting ending replaced; some of the stem must remain."""
    last = F.regexp_extract(phrase, r"[^ ]*$", 0)
    out = None
    for ending, nominative in LT_ENDINGS:
        fits = last.endswith(ending) & (F.length(last) > len(ending))
        value = F.concat(F.substring(phrase, F.lit(1), F.length(phrase) - len(ending)), F.lit(nominative))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out.otherwise(phrase)


def strip_flexion(word: Column) -> Column:
    """Drops a final n, then a final j, then the first fitting ending if something remains."""
    for letter in ("n", "j"):
        word = F.when(word.endswith(letter), F.substring(word, F.lit(1), F.length(word) - 1)).otherwise(word)
    out = None
    for ending in FLEXION:
        fits = word.endswith(ending) & (F.length(word) > len(ending))
        value = F.substring(word, F.lit(1), F.length(word) - len(ending))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out.otherwise(word)


def slug(term: Column) -> Column:
    """Lower-case identifier: no parenthesised parts, runs of other characters as one hyphen."""
    plain = F.lower(F.regexp_replace(term, r"\([^)]*\)", ""))
    return F.regexp_replace(F.regexp_replace(plain, r"[^\p{L}\p{N}_]+", "-"), "^-+|-+$", "")


def is_noise_line(line: Column) -> Column:
    """Blank, short, a pure number, or a line of amendments."""
    t = strip(line)
    return (F.length(t) < 10) | t.rlike(r"^\d+$") | t.rlike(AMENDMENT_LINE) | t.rlike(AMENDMENT_CONTENT)


def is_amendment_line(line: Column) -> Column:
    return line.rlike(AMENDMENT_LINE) | line.rlike(AMENDMENT_CONTENT)


def first_match(text: Column, patterns: list[str], group: int = 1) -> Column:
    """The group of the first pattern that matches, else null."""
    found = [F.nullif(F.regexp_extract(text, p, group), F.lit("")) for p in patterns]
    return reduce(lambda a, b: F.coalesce(a, b), found) if found else F.lit(None).cast("string")


def celex_year(identifier: Column) -> Column:
    """First of January of the year in an identifier such as 32013R0952."""
    year = F.regexp_extract(identifier, r"^\d(\d{4})[A-Z]", 1)
    return F.when(year != "", F.make_date(F.try_to_number(year, F.lit("9999")).cast("int"), F.lit(1), F.lit(1)))


def bidirectional_contains(a: Column, b: Column) -> Column:
    return a.contains(b) | b.contains(a)
