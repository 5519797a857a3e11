"""Token-bucket throttling of clicks that arrive late and out of order, as a stateful stream.

Every client has a bucket of credit (microseconds): at first and at most 2 * COST, refilled by the time that passes;
an admitted click takes COST, a click that finds less is throttled. Clicks come in numbered batches. A click waits
until the watermark W (the largest time of all earlier batches less DELAY) has passed it, then it is settled in order
of time; one that W has passed when it comes is late and touches nothing.

One Structured Streaming query, restarted for each batch on one checkpoint, does it in three steps:

1. The waiting room: `applyInPandasWithState` keeps waiting clicks, dealt to shards by client and hour, and releases
   those that are due. A clock row for each shard carries W to shards without clicks.
2. Chains. Without clicks for long enough credit is full, and what follows depends on nothing before: a chain
   starts at a click that finds full credit, at t0. From then on credit passes COST exactly at the ticks
   t0 + m * COST, as long as each interval between ticks has a click; the first interval without one fills the bucket
   and ends the chain. A gap that long lies between the last and the first click of two stretches of COST
   microseconds, so a client's chains follow from the least and largest time and the number of clicks of its stretches:
   a number of rows bounded by time, however many clicks a client has. Each client's last chain is kept as state.
3. Settlement. A chain is cut at every PIECE-th tick, where its credit is known to be COST, so that a client with a third
   of all clicks is settled in many tasks. Within a piece the work jumps from admission to admission: when credit falls
   below COST, a binary search finds the first click at or after the instant of refill, and all clicks up to it are
   marked throttled at once. A piece that W cuts hands its credit, time and open penalty to the next batch.

The state of steps 2 and 3 are tables numbered by batch, which a repeated batch writes anew, so a restart changes nothing.

Defined cases: rows with a null time or client are left out; equal rows count once; a null arrival is in the last batch;
a null click_id comes before all others of its time and is not moved a batch on; clicks with equal client, time and
click_id are settled one after the other; clients and click ids are integers; other columns only tell rows apart; an
empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from glossmill.llm.common import dropped, shared_dir

COST = 600 * 1_000_000
BATCHES, DELAY, HOUR = 12, 48 * 3600 * 1_000_000, 3600 * 1_000_000
#: Refill intervals of a piece (6 hours), and about so many clicks of all batches for each shard.
PIECE, SHARD_ROWS = 36, 40_000
#: Before all times.
NEVER = -(1 << 62)
_RELEASED = "click_id long, no_id boolean, client_id long, ts long, batch int, late boolean"
_CHAINS = "client_id long, stretch long, t0 long, last long, alone boolean, head boolean"
_SETTLED = "click_id long, no_id boolean, outcome string, batch int, credit_after long, penalty_start_us long, penalty_end_us long, client_id long, t0 long, piece long, last long, carried boolean"


def micros(df: DataFrame, name: str) -> Column:
    """Epoch microseconds of a timestamp; one without a zone is read as UTC."""
    if dict(df.dtypes)[name] == "timestamp_ntz":
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{name}`)")
    return F.unix_micros(name)


def cut_into_batches(clicks: DataFrame, batches: int = BATCHES) -> DataFrame:
    """click_id, no_id, client_id, ts (microseconds) and batch of each click that counts."""
    hour = F.floor(micros(clicks, "arrived_at") / F.lit(HOUR)).cast("long")
    moved = F.coalesce(F.pmod(F.crc32(F.col("click_id").cast("string")), F.lit(7)) == 0, F.lit(False))
    rows = clicks.dropDuplicates().where("ts IS NOT NULL AND client_id IS NOT NULL").select(F.coalesce("click_id", F.lit(0)).cast("long").alias("click_id"), F.col("click_id").isNull().alias("no_id"), F.col("client_id").cast("long").alias("client_id"), micros(clicks, "ts").alias("ts"), hour.alias("_gm_hour"), moved.alias("_gm_moved"))
    span = clicks.where("ts IS NOT NULL AND client_id IS NOT NULL").agg(F.min(hour).alias("lo"), F.max(hour).alias("hi")).first()
    lo, hi = (span["lo"], span["hi"]) if span["lo"] is not None else (0, 0)
    number = F.expr(f"(_gm_hour - {lo}) * {batches} div {hi - lo + 1}") + F.col("_gm_moved").cast("int")
    return rows.select("click_id", "no_id", "client_id", "ts", F.coalesce(F.least(number, F.lit(batches - 1)), F.lit(batches - 1)).cast("int").alias("batch"))


def release(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Step 1 for one shard: late clicks and those due now; the others wait in the state."""
    new = pd.concat(list(frames))
    w, batch, last = int(new["w"].iloc[0]), int(new["number"].iloc[0]), bool(new["final"].iloc[0])
    new = new.loc[~new["clock"], ["click_id", "no_id", "client_id", "ts"]]
    late = new["ts"] < w
    waiting = new[~late]
    if state.exists:
        waiting = pd.concat([pa.ipc.open_stream(state.get[0]).read_pandas(), waiting])
    due = np.full(len(waiting), True) if last else (waiting["ts"] < w).to_numpy()
    table = pa.Table.from_pandas(waiting[~due], preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    state.update((sink.getvalue().to_pybytes(),))
    for some, is_late in ((new[late], True), (waiting[due], False)):
        if len(some):
            yield some.assign(batch=batch, late=is_late)


def chains(stretches: pd.DataFrame, heads: pd.DataFrame) -> pd.DataFrame:
    """Step 2 for the clients of one shard: each stretch's t0, and each client's last chain (head).

    A chain in its first interval with no click but its own has `alone`: its credit is full again a tick after t0.
    """
    known = {c: (t0, last, alone) for c, t0, last, alone in heads[["client_id", "t0", "last", "alone"]].itertuples(index=False)}
    stretches = stretches.sort_values(["client_id", "low"])
    out = []
    for client, stretch, low, high, n in stretches[["client_id", "stretch", "low", "high", "n"]].itertuples(index=False):
        t0, last, alone = known.get(client, (None, None, False))
        if t0 is None or (low - t0) // COST >= (last - t0) // COST + 2 or alone and low - t0 >= COST:
            t0, alone = low, n == 1
        else:
            alone = False
        known[client] = (t0, high, alone)
        out.append((client, stretch, t0, high, alone, False))
    out += [(c, 0, t0, last, alone, True) for c, (t0, last, alone) in known.items()]
    return pd.DataFrame(out, columns=["client_id", "stretch", "t0", "last", "alone", "head"])


def settle(ts: np.ndarray, credit: int, last: int, start: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, tuple[int, int, int | None]]:
    """Step 3 for clicks in order: credit after each, whether admitted, start and end of its penalty, and (credit, last, start) at the end.

    credit is that of the instant `last`; start is that of a penalty that is open then. One round per admission.
    """
    n, i = len(ts), 0
    after, admitted = np.zeros(n, np.int64), np.zeros(n, bool)
    starts, ends = np.zeros(n, np.int64), np.zeros(n, np.int64)
    while i < n:
        if credit < COST:
            refill = last + COST - credit
            j = i if ts[i] >= refill else i + int(np.searchsorted(ts[i:], refill))
            if j > i:
                start = int(ts[i]) if start is None else start
                after[i:j] = credit - last + ts[i:j]
                starts[i:j], ends[i:j] = start, refill
                credit, last = int(after[j - 1]), int(ts[j - 1])
                i = j
                if i == n:
                    break
        t = int(ts[i])
        credit, last, start = min(2 * COST, credit + t - last) - COST, t, None
        after[i], admitted[i] = credit, True
        i += 1
    return after, admitted, starts, ends, (credit, last, start)


def settlement(batch: int, w: int):
    """Step 3 for the pieces of one shard, with what the batch before has handed over."""
    names = ["click_id", "no_id", "outcome", "batch", "credit_after", "penalty_start_us", "penalty_end_us", "client_id", "t0", "piece", "last", "carried"]

    def work(due: pd.DataFrame, carry: pd.DataFrame) -> pd.DataFrame:
        due = due.sort_values(["client_id", "t0", "piece", "ts", "no_id", "click_id"], ascending=[True, True, True, True, False, True])
        handed = {(c, t0, p): (credit, last, None if start == NEVER else start) for c, t0, p, credit, last, start in carry[["client_id", "t0", "piece", "credit_after", "last", "penalty_start_us"]].itertuples(index=False)}
        ts, keys = due["ts"].to_numpy(), due[["client_id", "t0", "piece"]].to_numpy()
        first = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)]) if len(due) else np.zeros(0, int)
        after, admitted = np.zeros(len(due), np.int64), np.zeros(len(due), bool)
        starts, ends = np.zeros(len(due), np.int64), np.zeros(len(due), np.int64)
        for a, z, (client, t0, piece) in zip(first.tolist(), np.r_[first, len(due)][1:].tolist(), keys[first].tolist(), strict=True):
            tick = t0 + piece * PIECE * COST
            entry = handed.pop((client, t0, piece), (COST if piece else 2 * COST, tick, None))
            after[a:z], admitted[a:z], starts[a:z], ends[a:z], end = settle(ts[a:z], *entry)
            handed[client, t0, piece] = end
        blank = pd.array(starts, "Int64"), pd.array(ends, "Int64")
        for column in blank:
            column[admitted] = pd.NA
        done = pd.DataFrame({"click_id": due["click_id"].to_numpy(), "no_id": due["no_id"].to_numpy(), "outcome": np.where(admitted, "admitted", "throttled"), "batch": batch, "credit_after": after, "penalty_start_us": blank[0], "penalty_end_us": blank[1], "client_id": keys[:, 0], "t0": keys[:, 1], "piece": keys[:, 2], "last": 0, "carried": False}, columns=names)
        # A piece that W has not passed may get more clicks.
        left = [(0, False, "", batch, credit, NEVER if start is None else start, 0, c, t0, p, last, True) for (c, t0, p), (credit, last, start) in handed.items() if t0 + (p + 1) * PIECE * COST > w]
        if not left:
            return done
        more = pd.DataFrame(left, columns=names).astype({"penalty_start_us": "Int64", "penalty_end_us": "Int64"})
        return pd.concat([done, more]) if len(done) else more

    return work


def step(spark: SparkSession, base: str, batch: int, w: int, shards: int) -> None:
    """Steps 2 and 3 for what batch `batch` has released; reads the tables of the batch before, writes its own."""
    found = spark.read.schema(_RELEASED).parquet(f"{base}/released/{batch}")
    due = found.where(~F.col("late")).withColumn("stretch", F.floor(F.col("ts") / F.lit(COST)).cast("long"))
    before = lambda what, schema: spark.read.parquet(f"{base}/{what}/{batch - 1}") if batch else spark.createDataFrame([], schema)
    shard = lambda *by: F.pmod(F.xxhash64(*by), F.lit(shards)).alias("shard")
    stretches = due.groupBy("client_id", "stretch").agg(F.min("ts").alias("low"), F.max("ts").alias("high"), F.count("*").alias("n"))
    heads = before("chains", _CHAINS).where("head")
    known = stretches.groupBy(shard("client_id")).cogroup(heads.groupBy(shard("client_id"))).applyInPandas(chains, _CHAINS)
    known.write.mode("overwrite").parquet(f"{base}/chains/{batch}")
    places = spark.read.schema(_CHAINS).parquet(f"{base}/chains/{batch}").where("NOT head").select("client_id", "stretch", "t0")
    placed = due.join(places, ["client_id", "stretch"]).withColumn("piece", F.floor((F.col("ts") - F.col("t0")) / F.lit(PIECE * COST)).cast("long"))
    carry = before("settled", _SETTLED).where("carried")
    by = ("client_id", "t0", "piece")
    settled = placed.groupBy(shard(*by)).cogroup(carry.groupBy(shard(*by))).applyInPandas(settlement(batch, w), _SETTLED)
    nothing = {"credit_after": "long", "penalty_start_us": "long", "penalty_end_us": "long", "t0": "long", "piece": "long", "last": "long"}
    late = found.where("late").select("click_id", "no_id", F.lit("late").alias("outcome"), "batch", "client_id", F.lit(False).alias("carried"), *[F.lit(None).cast(k).alias(c) for c, k in nothing.items()])
    settled.unionByName(late).write.mode("overwrite").parquet(f"{base}/settled/{batch}")


def throttle(clicks: DataFrame, batches: int = BATCHES) -> DataFrame:
    """click_id, outcome, batch, credit_after, penalty_start_us, penalty_end_us of each click that counts."""
    spark = clicks.sparkSession
    base = f"{shared_dir(spark)}/throttle-{uuid.uuid4().hex}"
    cut_into_batches(clicks, batches).write.partitionBy("batch").parquet(f"{base}/clicks")
    schema = "click_id long, no_id boolean, client_id long, ts long, batch int"
    cut = spark.read.schema(schema).parquet(f"{base}/clicks")
    per_batch = {r["batch"]: (r["n"], r["latest"]) for r in cut.groupBy("batch").agg(F.count("*").alias("n"), F.max("ts").alias("latest")).collect()}
    shards = max(64, sum(n for n, _ in per_batch.values()) // SHARD_ROWS)
    shard = F.pmod(F.xxhash64("client_id", F.floor(F.col("ts") / F.lit(HOUR))), F.lit(shards)).cast("int")
    fed = "shard int, click_id long, no_id boolean, client_id long, ts long, clock boolean, number int, w long, final boolean"
    w = NEVER
    for k in range(batches):
        with_clock = cut.where(F.col("batch") == k).select(shard.alias("shard"), "click_id", "no_id", "client_id", "ts", F.lit(False).alias("clock"))
        clock = spark.range(shards).select(F.col("id").cast("int").alias("shard"), F.lit(0).cast("long").alias("click_id"), F.lit(False).alias("no_id"), F.lit(0).cast("long").alias("client_id"), F.lit(0).cast("long").alias("ts"), F.lit(True).alias("clock"))
        rows = with_clock.unionByName(clock).withColumns({"number": F.lit(k), "w": F.lit(w).cast("long"), "final": F.lit(k == batches - 1)})
        rows.write.parquet(f"{base}/feed/{k}")

        def settle_batch(found: DataFrame, _: int, k: int = k, w: int = w) -> None:
            found.write.mode("overwrite").parquet(f"{base}/released/{k}")
            step(found.sparkSession, base, k, w, shards)

        stream = spark.readStream.schema(fed).option("recursiveFileLookup", "true").parquet(f"{base}/feed")
        released = stream.groupBy("shard").applyInPandasWithState(release, _RELEASED, "waiting binary", "append", GroupStateTimeout.NoTimeout)
        query = released.writeStream.foreachBatch(settle_batch).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()
        if k in per_batch:
            w = max(w, per_batch[k][1] - DELAY)
    for done in ("clicks", "feed", "released", "chains", "checkpoint"):
        dropped(spark, f"{base}/{done}")
    settled = spark.read.schema(_SETTLED).option("recursiveFileLookup", "true").parquet(f"{base}/settled").where("NOT carried")
    return settled.select(F.when(~F.col("no_id"), F.col("click_id")).alias("click_id"), "outcome", "batch", "credit_after", "penalty_start_us", "penalty_end_us")
