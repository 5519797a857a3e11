"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import itertools
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows of an Arrow batch are handed to the numpy code in slices of about so many text bytes.
SLICE_BYTES = 4 << 20
#: A key with this share of all rows, and with so many rows at least, counts as hot.
HOT_KEYS, HOT_LEAST = 1000, 64
_cuts = itertools.count(1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table as Spark's reader sees it (any file system, any layout)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Only a local master may do without; it gets a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext._jsc.sc()
    if not found:
        known = context.getCheckpointDir()
        if known.isDefined():
            found = known.get()
        elif spark.sparkContext.master.startswith("local"):
            found = f"file://{tempfile.mkdtemp(prefix='glossmill-')}"
        else:
            raise RuntimeError("spark.checkpoint.dir is not set: it must name a folder that all executors share")
        spark.conf.set("spark.checkpoint.dir", found)
    if not context.getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(found)
    return found


def cut(df: DataFrame) -> DataFrame:
    """Cuts the lineage: a reliable checkpoint in the shared folder, safe against lost executors."""
    shared_dir(df.sparkSession)
    out = df.checkpoint(eager=True)
    if next(_cuts) % 4 == 0:
        release(df.sparkSession)
    return out


def stored(df: DataFrame, what: str, by: list[str] | None = None, **options: str) -> DataFrame:
    """Writes df as a table in the shared folder and reads it back. With `by` it is bucketed by these columns, so joins on them move only the other side."""
    spark, name = df.sparkSession, f"{what}-{uuid.uuid4().hex}"
    path, options = f"{shared_dir(spark)}/{name}", {"compression": "zstd", **options}
    if by is None:
        df.write.options(**options).parquet(path)
        release(spark)
        return spark.read.parquet(path)
    table_name, buckets = name.replace("-", "_"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Dealt as the buckets are, so that each one is a file.
    df.repartition(buckets, *by).write.format("parquet").options(**options, path=path).bucketBy(buckets, *by).saveAsTable(table_name)
    release(spark)
    return spark.table(table_name)


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner drop the shuffle files, broadcasts and compiled plans that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.java.lang.System.gc()


def dropped(spark: SparkSession, path: str) -> None:
    """Deletes a scratch folder through the file system that holds it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def looked_up(left: DataFrame, right: DataFrame, on: list[str], uses: str, spread: list[str], fits: Column | None = None, total: int | None = None) -> DataFrame:
    """left with right's other columns; right has one row for each key `on`, and in `uses` how many rows of left have it.

    Keys with a HOT_KEYS-th of all rows or more, HOT_KEYS at most, are broadcast; the rest meet by a shuffle in
    which rows already served are dealt by the columns `spread`. So no task gets all rows of a hot key. Where a
    row of right may be large, `fits` says which ones may be broadcast. right is read several times.
    """
    values = [c for c in right.columns if c not in on and c != uses]
    fits = F.lit(True) if fits is None else fits
    counted, most = right.agg(F.sum(uses), F.max(F.when(fits, F.col(uses)))).first()
    hot_at = max(HOT_LEAST, (counted or 0 if total is None else total) // HOT_KEYS)
    if (most or 0) < hot_at:
        return left.join(right.drop(uses), on, "left")
    is_hot = (F.col(uses) >= hot_at) & fits
    hot = right.where(is_hot).select(*on, F.struct(*values).alias("_gm_hot"))
    rest = right.where(~is_hot).select(*on, F.struct(*values).alias("_gm_rest"), F.lit(0).cast("long").alias("_gm_salt"))
    served = left.join(F.broadcast(hot), on, "left").withColumn("_gm_salt", F.when(F.col("_gm_hot").isNull(), F.lit(0)).otherwise(1 + F.pmod(F.xxhash64(*spread), F.lit(1 << 20))).cast("long"))
    found = served.join(rest, [*on, "_gm_salt"], "left").withColumn("_gm_hot", F.coalesce("_gm_hot", "_gm_rest"))
    return found.select(*left.columns, *[F.col(f"_gm_hot.{c}").alias(c) for c in values])


def met(left: DataFrame, right: DataFrame, on: list[str], uses: str) -> DataFrame:
    """The rows of left whose key right has, with right's other columns; as `looked_up`, without the rows that find nothing.

    Hot keys, HOT_KEYS at most, are known by their hashes, by which both sides are parted; so each row takes one join, and
    a task of the shuffle gets no row of a hot key. Keys that share a hash go the same way. Both sides are read twice.
    """
    values = [c for c in right.columns if c not in on and c != uses]
    right = right.select(*on, *values, uses)
    counted = right.agg(F.sum(uses)).first()[0] or 0
    digest = F.xxhash64(*on)
    hot = [r[0] for r in right.where(F.col(uses) >= max(HOT_LEAST, counted // HOT_KEYS)).select(digest).distinct().collect()]
    if not hot:
        return left.join(right.drop(uses), on)
    is_hot = digest.isin(hot)
    return left.where(is_hot).join(F.broadcast(right.where(is_hot).drop(uses)), on).unionByName(left.where(~is_hot).join(right.where(~is_hot).drop(uses), on))


def sliced(batches: Iterator[pa.RecordBatch], text: str | int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts batches into slices of at most about `most` bytes in the column `text`, or as it states them where it holds whole numbers (a longer value stands alone)."""
    for batch in batches:
        column = batch.column(text)
        start = size = 0
        lengths = pc.fill_null(column if pa.types.is_integer(column.type) else pc.binary_length(column), 0).to_pylist()
        for i, n in enumerate(lengths):
            if size and size + n > most:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < batch.num_rows:
            yield batch.slice(start)


def map_texts(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | StructType, text: str) -> DataFrame:
    """mapInArrow over slices of bounded bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, text):
            out = work(batch)
            if out is not None and out.num_rows:
                yield out

    return df.mapInArrow(run, schema)


def utf8(column: pa.Array) -> list[bytes]:
    """The column's texts as UTF-8 bytes; nulls become empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]
