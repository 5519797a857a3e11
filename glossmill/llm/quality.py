"""Quality rules as a short-circuit cascade of built-in column functions.

Five counts describe a text; two base rules reject on them. Further rules, four on the counts and six that each
read the text in their own way, are tried one after another, and the first that rejects ends the row's evaluation.
Their order comes from a random sample of expected size SAMPLE_ROWS: each rule's rejection rate, and its cost for a
row as the comparisons and characters that it reads there (a rule states its passes over the text), are measured, and
rules with the most rejections for their cost go first, in the stated order where they are equal. Unlike times, which on
rules this cheap are mostly the scheduler's, the cost is the same in every run. The order changes the work only, never
the verdict; which of several failing rules is named may differ.

Defined cases: a null or empty text has no words, so every count is 0 and it is rejected; repeated rows and
ids are judged each by itself; extra columns are ignored; an empty table gives an empty result and the
order in which the rules were stated.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Separators of words.
GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[^#*$%&|<>]+"
MIN_WORDS = 50
#: Expected rows of the sample.
SAMPLE_ROWS = 512
#: Low bits of a packed window key hold its position; longer texts use wide keys.
POSITION_BITS = 20
#: Bits of a window's hash that are used; tests take few, so that hashes collide.
HASH_MASK = -1


@dataclass(frozen=True)
class Rule:
    """A rule rejects where `rejects` holds; it reads the text `passes` times."""

    name: str
    rejects: Column
    passes: int = 0


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, GAP), lambda w: w != "")


def _repeat_count(n: Column, repeated_positions: Column) -> Column:
    """Words covered by windows of three at the given sorted positions."""
    return F.when(F.size(repeated_positions) == 0, F.lit(0)).otherwise(
        F.aggregate(repeated_positions, F.struct(F.lit(0).alias("sum"), F.lit(-3).alias("last")), lambda s, p: F.struct((s["sum"] + F.least(F.lit(3), p - s["last"])).alias("sum"), p.alias("last")), lambda s: s["sum"])
    )


def measures(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words.

    Each step is a projection of its own over the last one's columns. Windows of three words are hashed,
    packed with their position and sorted as plain longs; equal neighbours are then compared word by word. A
    text in which neighbours have one hash and other words is sorted by the words themselves instead.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    low = (1 << POSITION_BITS) - 1
    at = lambda words, i: F.concat_ws("\x20", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    df = df.withColumn("_words", words_of(t)).withColumn("n_words", F.size("_words").cast("long"))
    words = F.col("_words")
    windows = F.when(F.col("n_words") < 3, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("n_words").cast("int") - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).bitwiseAND(F.lit(~low & HASH_MASK)).bitwiseOR(i.cast("long")))
    )
    df = df.withColumn("_keys", F.when(F.col("n_words") <= low, F.sort_array(windows)))
    keys = F.col("_keys")
    # A pair of neighbours with one hash: compared on the words themselves.
    one_hash = lambda k, j: F.get(keys, j).bitwiseAND(F.lit(~low)) == k.bitwiseAND(F.lit(~low))
    equal = lambda k, j: at(words, F.get(keys, j).bitwiseAND(F.lit(low)).cast("int")) == at(words, k.bitwiseAND(F.lit(low)).cast("int"))
    same = lambda k, j: one_hash(k, j) & equal(k, j)
    clash = F.size(F.filter(keys, lambda k, j: (j > 0) & one_hash(k, j - 1) & ~equal(k, j - 1))) > 0
    df = df.withColumn("_by_words", (F.col("n_words") > low) | clash)
    packed = F.filter(keys, lambda k, j: ((j > 0) & same(k, j - 1)) | ((j < F.size(keys) - 1) & same(k, j + 1)))
    wide = F.array_sort(F.transform(F.sequence(F.lit(0), F.col("n_words").cast("int") - 3), lambda i: F.struct(at(words, i).alias("w"), i.alias("i"))))
    df = df.withColumn("_wide", F.when(F.col("_by_words"), wide))
    found = F.col("_wide")
    slow = F.filter(found, lambda k, j: ((j > 0) & (F.get(found, j - 1)["w"] == k["w"])) | ((j < F.size(found) - 1) & (F.get(found, j + 1)["w"] == k["w"])))
    positions = F.when(~F.col("_by_words"), F.transform(packed, lambda k: k.bitwiseAND(F.lit(low)).cast("int"))).otherwise(F.transform(slow, lambda k: k["i"]))
    df = df.withColumn("_at", F.sort_array(positions))
    lines = F.filter(F.split(t, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return (
        df.withColumn("_lines", lines)
        .withColumns(
            {
                "word_chars": F.char_length(F.array_join(words, "")).cast("long"),
                "n_symbols": F.char_length(F.regexp_replace(t, SYMBOLS, "")).cast("long"),
                "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
                "n_lines": F.size("_lines").cast("long"),
                "n_repeat_words": _repeat_count(F.col("n_words"), F.col("_at")).cast("long"),
            }
        )
        .drop("_words", "_keys", "_by_words", "_wide", "_at", "_lines")
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rules(text: str = "text") -> list[Rule]:
    """The stated rules, each a comparison of whole numbers."""
    n, t = F.col("n_words"), F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    share = lambda pattern: F.size(F.filter(lines, lambda line: line.rlike(pattern)))
    return [
        Rule("word_length", ~F.col("word_chars").between(2 * n, 15 * n)),
        Rule("symbols", 10 * F.col("n_symbols") > 3 * n),
        Rule("repeated_lines", 10 * F.col("n_dup_lines") > 7 * F.col("n_lines")),
        Rule("repeated_words", 100 * F.col("n_repeat_words") > 45 * n),
        Rule("few_letters", 2 * F.char_length(F.regexp_replace(t, r"[^\p{L}]+", "")) < F.col("word_chars"), 2),
        Rule("blank_filler", F.col("word_chars") * 4 < F.char_length(t), 1),
        Rule("placeholder", F.lower(t).contains("lorem ipsum"), 2),
        Rule("bullets", 10 * share(r"^[\x20\x09-\x0D]*[*\u2022-]") > 9 * F.col("n_lines"), 3),
        Rule("ellipses", 10 * share(r"(\.\.\.|\u2026)[\x20\x09-\x0D]*$") > 3 * F.col("n_lines"), 3),
        Rule("endless_word", t.rlike(r"[^\x20\x09-\x0D]{1000}"), 1),
    ]


def cascade_order(df: DataFrame, stated: list[Rule], text: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Orders rules by rejections for their cost, both measured on a random sample of the raw rows."""
    total = df.count()
    if not total:
        return stated
    sample = measures(df.sample(min(1.0, sample_rows / total), seed=7), text)
    size = F.char_length(F.coalesce(F.col(text), F.lit("")))
    found = sample.agg(F.count("*").alias("_rows"), *[F.avg(r.rejects.cast("int")).alias(f"share_{r.name}") for r in stated], *[F.avg(1 + r.passes * size).alias(f"cost_{r.name}") for r in stated]).first()
    if not found["_rows"]:
        return stated
    return sorted(stated, key=lambda r: -found[f"share_{r.name}"] / found[f"cost_{r.name}"])


def judge(df: DataFrame, ordered: list[Rule]) -> DataFrame:
    """base_failed, rejected_by and kept; WHEN stops at the first rule that rejects."""
    first = reduce(lambda when, r: when.when(r.rejects, F.lit(r.name)), ordered, F.when(F.col("base_failed"), F.lit("base")))
    return df.withColumn("base_failed", base_failed()).withColumn("rejected_by", first).withColumn("kept", F.col("rejected_by").isNull())


def quality(df: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """All measures and the verdict for each row of df; keeps its other columns, but for those named like the results."""
    made = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words", "base_failed", "rejected_by", "kept"]
    df = df.drop(*[c for c in made if c != text])
    return judge(measures(df, text), cascade_order(df, rules(text), text, sample_rows))
