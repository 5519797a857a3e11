"""Review of candidates: keys, overlaps with names and other domains, counts of states, unions of stores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossmill.operators.writer import approved, pending


def candidate_key() -> Column:
    """The normalised phrase, or the phrase in lower case where that is null or empty."""
    return F.coalesce(F.when(F.col("phrase_normalized") != "", F.col("phrase_normalized")), F.lower("phrase"))


def name_overlap(candidates: DataFrame, names: DataFrame) -> DataFrame:
    """Candidates whose key is the key of a named entity."""
    keys = names.select(candidate_key().alias("_key")).distinct()
    return candidates.withColumn("_key", candidate_key()).join(keys, "_key", "left_semi").drop("_key")


def domain_matches(candidates: DataFrame, labels: DataFrame) -> DataFrame:
    """Candidates whose key another domain's store has, with that domain; labels (phrase, domain) has a phrase once."""
    other = labels.select(F.col("phrase").alias("_key"), F.col("domain").alias("other_domain"))
    return candidates.withColumn("_key", candidate_key()).join(other, "_key").drop("_key")


def state_counts(records: DataFrame, by: list[str]) -> DataFrame:
    """Records, approved ones and pending ones."""
    return records.groupBy(*by).agg(F.count("*").alias("total"), F.count_if(approved()).alias("approved"), F.count_if(pending()).alias("pending"))


def require_approved(records: DataFrame) -> DataFrame:
    """records, or an error where none is approved: the gate between review and writing."""
    if records.where(approved()).isEmpty():
        raise ValueError("no record is approved: review the candidates first")
    return records


def label_numbers(labels: Column) -> Column:
    """The first digits of each label that has some."""
    return F.filter(F.transform(labels, lambda x: F.regexp_extract(x, "([0-9]+)", 1)), lambda x: x != "")


def control_row(rows: DataFrame, value: str, order: str, by: list[str]) -> DataFrame:
    """The row with the largest value, of equals the first; null values never win."""
    kept = [c for c in rows.columns if c not in by]
    best = F.struct(F.col(value).alias("v"), (-F.col(order)).alias("o"))
    return rows.where(F.col(value).isNotNull()).groupBy(*by).agg(F.max_by(F.struct(*kept), best).alias("r")).select(*by, "r.*")


def later_wins(maps: DataFrame, key: str, value: str, ord_: list[str]) -> DataFrame:
    """One value for each key of several maps: that of the last one, by `ord_`."""
    return maps.groupBy(key).agg(F.max_by(F.struct(value), F.struct(*ord_)).alias("r")).select(key, f"r.{value}")


def shared_count(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    """One row: how many distinct values stand in both."""
    return a.select(column).intersect(b.select(column)).agg(F.count("*").alias("n_shared"))
