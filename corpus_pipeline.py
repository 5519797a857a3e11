"""A corpus pipeline: toxicity, line dedup, near-dedup, suffix dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as
the next stage's docs. All but the last return the columns of documents; the last returns packed pieces.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmill.llm import lines, packing, simhash, suffixes, toxicity
from glossmill.llm.common import shared_dir, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model predicts toxic go; it learns from the labelled ones among docs."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated chunks of two or more lines go from the texts; n_chars follows."""
    kept = lines.dedup(docs).withColumn("n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast("long"))
    return kept.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id stays."""
    return simhash.keep_one(docs)


def dedup_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated strings of 100 bytes go from the texts; bytes of a cut character go with them."""
    kept = suffixes.dedup(docs, replace=True).withColumn("n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast("long"))
    return kept.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("near dedup", drop_near_duplicates),
    ("suffix dedup", dedup_passages),
    ("packing", pack),
]

#: The stages' models, hashes and packings are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    base = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{i}")
        docs = spark.read.parquet(f"{base}/{i}")
    return docs
