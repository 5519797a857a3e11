"""Merging of per-area candidates, signatures, and routing to review buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glossmill.functions import scores

TOP_PER_AREA = 30


def attestation(rows: DataFrame) -> DataFrame:
    """(phrase, area, source_file) with summed doc_count and frequency."""
    return rows.groupBy("phrase", "area", "source_file").agg(F.sum("doc_count").alias("doc_count"), F.sum("frequency").alias("frequency"))


def area_counts(area: str = "area", count: str = "doc_count") -> dict[str, Column]:
    """Aggregates: documents of each canonical area."""
    return {a: F.sum(F.when(F.col(area) == a, F.col(count)).otherwise(0)).cast("long") for a in scores.AREAS}


def merge_candidates(rows: DataFrame) -> DataFrame:
    """One row per phrase of rows (phrase, area, source_file, doc_count, frequency[, pos_pattern, context, ord])."""
    parts = attestation(rows)
    merged = parts.groupBy("phrase").agg(
        F.sum("doc_count").alias("total_doc_count"),
        F.sum("frequency").alias("total_frequency"),
        F.transform(F.sort_array(F.collect_list(F.struct((-F.col("doc_count")).alias("neg"), "area", "source_file", "frequency"))), lambda x: F.struct(x["area"].alias("area"), (-x["neg"]).alias("doc_count"), x["frequency"].alias("frequency"), x["source_file"].alias("source_file"))).alias("attestation"),
        *[c.alias(f"d_{a}") for a, c in area_counts().items()],
    )
    counts = [F.col(f"d_{a}") for a in scores.AREAS]
    merged = merged.withColumn("area_signature", scores.area_signature(counts)).withColumn("area_specificity", scores.area_specificity(counts))
    if "context" in rows.columns:
        best = rows.groupBy("phrase").agg(F.max_by(F.substring("context", 1, 200), F.struct(F.length(F.substring("context", 1, 200)), -F.col("ord"))).alias("sample_context"))
        merged = merged.join(best, "phrase", "left")
    if "pos_pattern" in rows.columns:
        tags = rows.where("pos_pattern is not null").groupBy("phrase", "pos_pattern").agg(F.count("*").alias("n"), F.min("ord").alias("first"))
        merged = merged.join(tags.groupBy("phrase").agg(F.max_by("pos_pattern", F.struct("n", -F.col("first"))).alias("pos_pattern"), (F.count("*") > 1).alias("pos_pattern_inconsistent")), "phrase", "left")
    return merged


def n_areas() -> Column:
    return sum(((F.col(f"d_{a}") > 0).cast("int") for a in scores.AREAS), F.lit(0))


def dominant_area() -> Column:
    """The area with most documents, of equals the first; without any, the cross-cutting one."""
    counts = [F.col(f"d_{a}") for a in scores.AREAS]
    out = F.when(F.greatest(*counts) <= 0, F.lit(scores.CROSS_CUTTING))
    for a, c in zip(scores.AREAS, counts, strict=True):
        out = out.when(c == F.greatest(*counts), F.lit(a))
    return out


def low_scorers(candidates: DataFrame, texts: DataFrame) -> DataFrame:
    """phrase and labels of the pinned texts (label, text) that contain it as a string.

    Phrases meet the texts by their opening letters, as sample contexts do.
    """
    from glossmill.functions.text import normalise
    from glossmill.operators.ngrams import CUT

    needle = candidates.select("phrase", normalise(F.col("phrase")).alias("needle")).where("needle <> ''").withColumn("head", F.substring("needle", 1, CUT))
    n = F.length("hay")
    openings = F.flatten(F.transform(F.sequence(F.lit(1), n), lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(CUT), n - i + 1)), lambda k: F.substring(F.col("hay"), i, k))))
    hay = texts.select("label", normalise(F.col("text")).alias("hay")).where("hay <> ''").select("label", "hay", F.explode(F.array_distinct(openings)).alias("head"))
    return needle.join(hay, "head").where(F.col("hay").contains(F.col("needle"))).groupBy("phrase").agg(F.sort_array(F.collect_set("label")).alias("appears_in"))


def route(enriched: DataFrame, per_area: int = TOP_PER_AREA) -> DataFrame:
    """Adds bucket: of the third only the best per dominant area stay, the rest goes to the fourth."""
    routed = enriched.withColumn("n_areas", n_areas()).withColumn("dominant_area", dominant_area()).withColumn("routed", scores.review_bucket(F.col("n_areas"), F.coalesce(F.size("appears_in"), F.lit(0)) if "appears_in" in enriched.columns else F.lit(0), F.col("area_specificity"), F.col("ne_risk")))
    third = routed.where("routed = 3").withColumn("rank", F.row_number().over(W.partitionBy("dominant_area").orderBy(F.desc("area_specificity"), F.desc("total_doc_count"), "phrase"))).where(F.col("rank") <= per_area)
    kept = third.select("phrase", F.lit(True).alias("stays"))
    return routed.join(kept, "phrase", "left").withColumn("bucket", F.when((F.col("routed") == 3) & F.col("stays").isNull(), 4).otherwise(F.col("routed"))).drop("routed", "stays")
