"""Connected components by alternating large-star and small-star steps, and in one task where the edges are few."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossmill.llm.common import cut, looked_up


#: Fewer edges than this are joined as they are.
MANY = 20_000
#: So many edges at most, of 16 bytes each, are worked off by one task; it takes no rounds and gives the same labels.
ONE_TASK = 250_000


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def _met(edges: DataFrame, least: DataFrame, total: int) -> DataFrame:
    """edges (u, v) with m of their u; few edges have no hot node."""
    return looked_up(edges, least, ["u"], "uses", ["v"], total=total) if total >= MANY else edges.join(least.drop("uses"), "u")


def least_reached(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct nodes of edges (u, v), and the least node that each reaches."""
    nodes, codes = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = codes[: len(u)], codes[len(u) :]
    label = np.arange(len(nodes))
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return nodes, nodes[label]
        np.minimum.at(label, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while not np.array_equal(further := label[label], label):
            label = further


def _in_one_task(edges: DataFrame, kind: str) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)) for b in batches if b.num_rows]
        if held:
            nodes, labels = least_reached(*(np.concatenate(x) for x in zip(*held, strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(labels)], ["node", "label"])

    return edges.select("u", "v").coalesce(1).mapInArrow(work, f"node {kind}, label {kind}")


def components(edges: DataFrame, most_rounds: int = 64, one_task: int = ONE_TASK) -> DataFrame:
    """edges (u, v), any order -> (node, label), label the least node that `node` reaches.

    Only nodes of an edge appear. Loops and repeats do no harm. Minima are combined before each shuffle and
    looked up by a key that stands once on one side, hot ones by broadcast, so a hub with very many neighbours
    is dealt out; no neighbourhood is ever gathered. Each round is checkpointed. An empty table gives an empty result.
    Up to `one_task` distinct edges, of long nodes, are worked off by one task instead, with the same result.
    """
    now = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = _state(now)
    if state[0] <= one_task and dict(now.dtypes)["u"] == "bigint":
        return _in_one_task(now, "long")
    for _ in range(most_rounds):
        if not state[0]:
            break
        # Large star: every larger neighbour moves to the least node of the neighbourhood.
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("uses")).withColumn("m", F.least("u", "m"))
        large = _met(both, least, state[0]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: smaller neighbours and the node itself move to the least of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("uses"))
        small = _met(large, low, state[0]).select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v")
        now = cut(small.distinct())
        before, state = state, _state(now)
        if state == before:
            break
    else:
        raise RuntimeError("components: no end within the allowed rounds")
    members = now.groupBy("u").agg(F.min("v").alias("label")).withColumnRenamed("u", "node")
    return members.unionByName(members.select(F.col("label").alias("node"), "label").distinct())
