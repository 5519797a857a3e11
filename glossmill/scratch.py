"""The folder for intermediate tables, and cuts of long lineages."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, which all executors share; a local master may do without and gets a temporary folder."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: it must name a folder that all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='glossmill-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def path(spark: SparkSession, what: str) -> str:
    return f"{folder(spark)}/{what}-{uuid.uuid4().hex}"


def settled(df: DataFrame, what: str = "table") -> DataFrame:
    """df written as a table and read back: computed once, safe against lost executors."""
    target = path(df.sparkSession, what)
    df.write.parquet(target)
    return df.sparkSession.read.parquet(target)
