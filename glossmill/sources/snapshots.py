"""Numbered snapshots of a group of tables in a folder: a new one replaces the last at once, and the old ones are kept.

A snapshot is a folder of tables named by its number. Its marker is written last, so one that a lost driver left half-way is
never read, and its number is not used again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from glossmill.sources.files import found

MARKER = "complete"


def numbers(spark: SparkSession, folder: str, complete: bool = True) -> list[int]:
    """Numbers of the snapshots in a folder, complete ones only or all that were begun."""
    paths = found(spark, f"{folder}/snapshot-*/{MARKER}") if complete else found(spark, f"{folder}/snapshot-*")
    at = -2 if complete else -1
    return sorted(int(p.rstrip("/").split("/")[at].removeprefix("snapshot-")) for p in paths)


def current(spark: SparkSession, folder: str) -> str | None:
    """Path of the last complete snapshot."""
    held = numbers(spark, folder)
    return f"{folder}/snapshot-{held[-1]}" if held else None


def read(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame] | None:
    """The tables of the last complete snapshot; None where there is none."""
    path = current(spark, folder)
    return {n: spark.read.parquet(f"{path}/{n}") for n in names} if path else None


def commit(spark: SparkSession, folder: str, tables: dict[str, DataFrame]) -> str:
    """Writes all tables as the next snapshot. They may read the last one, which stays."""
    number = max(numbers(spark, folder, complete=False), default=0) + 1
    path = f"{folder}/snapshot-{number}"
    for name, df in tables.items():
        df.write.parquet(f"{path}/{name}")
    spark.range(1).write.parquet(f"{path}/{MARKER}")
    return path
