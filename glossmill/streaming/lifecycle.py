"""Streams over the batch operators: lifecycles, chat turns and appended candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from glossmill.functions import scores
from glossmill.operators.tokens import words_of

MOST_WORDS = 10_000


def concept_status(occurrences: DataFrame, delay: str = "1 day") -> DataFrame:
    """Distinct sources of each concept so far and its status; for update or complete mode.

    occurrences: concept, source, ts. Repeats of a pair within the delay are dropped by state that the watermark
    bounds; the count is exact, as a concept's state is the set of its sources.
    """
    pairs = occurrences.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["concept", "source"])
    counted = pairs.groupBy("concept").agg(F.size(F.collect_set("source")).cast("long").alias("n_sources"))
    return counted.withColumn("status", scores.lifecycle(F.col("n_sources")))


def turn_signal(turns: DataFrame, tiers: DataFrame, domain_words: list[str], most: int = MOST_WORDS) -> DataFrame:
    """Words of each turn (conv_id, turn, text) by tier, statelessly: the vocabulary is a static list of at most `most` words.

    A larger vocabulary is an error. Words are looked up in a hash set that the plan holds.
    """
    common = [r["word"] for r in tiers.where("tier <= 2").select("word").distinct().limit(most + 1).collect()]
    if max(len(common), len(domain_words)) > most:
        raise ValueError(f"a stream's vocabulary holds at most {most} words")
    words = words_of(F.col("text"))
    inside = lambda some: F.size(F.filter(words, lambda w: w.isin(some))) if some else F.lit(0)
    out = turns.withColumn("n_words", F.size(words)).withColumn("common", inside(common)).withColumn("domain", inside(domain_words))
    return out.withColumn("signal", F.when(F.col("common") > 0, F.col("domain") / F.col("common")).otherwise(F.when(F.col("n_words") > 0, F.col("domain") / F.col("n_words")).otherwise(0.0)))


def event_windows(events: DataFrame, size: str = "5 minutes", delay: str = "10 minutes") -> DataFrame:
    """Counts and sums by tumbling window and type; late rows beyond the delay are left out."""
    return events.withWatermark("ts", delay).groupBy(F.window("ts", size), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def append_new(candidates: DataFrame, keys: list[str], path: str, checkpoint: str, delay: str = "1 day") -> StreamingQuery:
    """Appends each key once to a table; exactly once by the file sink's log."""
    unique = candidates.withWatermark("ts", delay).dropDuplicatesWithinWatermark(keys)
    return unique.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start(path)
