"""Sentences, tokens and token runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words that the miner leaves out before it forms windows; a parameter of every operator that uses it.
STOP_WORDS = ["the", "of", "and", "to", "in", "is", "be", "that", "for", "are", "as", "by", "this", "was", "with", "on", "it", "he", "an", "a"]
DOCUMENT_MARK = "♥"


def split_documents(df: DataFrame, text: str = "value", mark: str = DOCUMENT_MARK) -> DataFrame:
    """One row for each non-blank part between marks, with its number."""
    parts = df.select("*", F.posexplode(F.split(F.col(text), mark)).alias("doc_idx", "part"))
    return parts.where(F.trim("part") != "")


def sentences_of(text: Column) -> Column:
    """Cut behind . ! or ? where blanks follow."""
    return F.split(F.regexp_replace(text, r"([.!?])[ \t\n\r\x0B\f]+", "$1\u0001"), "\u0001")


def words_of(text: Column) -> Column:
    """Runs of letters, in lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+)"), F.lit(1))


def sentences(df: DataFrame, text: str = "text") -> DataFrame:
    """One row per sentence, with sent_idx; other columns stay."""
    rest = [c for c in df.columns if c != text]
    return df.select(*rest, F.posexplode(sentences_of(F.col(text))).alias("sent_idx", "sentence"))


def mined_sentences(df: DataFrame, text: str = "text", stop_words: list[str] = STOP_WORDS) -> DataFrame:
    """Sentences as arrays of words without stop words; empty ones go. A sentence is cut into words once."""
    kept = lambda s: F.filter(words_of(s), lambda w: ~w.isin(stop_words)) if stop_words else words_of(s)
    found = F.transform(sentences_of(F.col(text)), lambda s, i: F.struct(i.alias("sent_idx"), kept(s).alias("words")))
    rest = [c for c in df.columns if c != text]
    return df.select(*rest, F.inline(F.filter(found, lambda x: F.size(x["words"]) > 0)))


def token_runs(df: DataFrame, text: str = "text") -> DataFrame:
    """Runs of words that only blanks part, for every sentence; anything else is a token that stops a match.

    A match of several words never crosses such a token, so a run can be matched by itself.
    """
    rest = [c for c in df.columns if c != text]
    # Split at all else than letters and blanks: a pattern of repeated words would recurse once per word.
    parts = lambda s: F.filter(F.split(F.lower(s), r"[^\p{L} \t\n\r\x0B\f]+"), lambda r: r.rlike(r"\p{L}"))
    runs = F.transform(sentences_of(F.col(text)), lambda s, i: F.transform(parts(s), lambda r, j: F.struct(i.alias("sent_idx"), j.alias("run_idx"), words_of(r).alias("words"))))
    return df.select(*rest, F.inline(F.flatten(runs)))
