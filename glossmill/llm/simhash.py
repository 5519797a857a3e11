"""SimHash near-duplicate groups by the generalised pigeonhole principle.

Every text gets a 64-bit fingerprint: a bit is 1 where it is set in over half the hashes of the text's word
shingles. Two fingerprints link when they differ in at most `radius` bits. The 64 bits are grouped into
partitions of correlated bits; a threshold for each partition is allocated by dynamic programming on
estimated candidate counts, such that thresholds sum to radius - partitions + 1. Any linked pair then agrees,
in some partition, up to its threshold. Each distinct fingerprint is an index row for each partition and
probes the ball of its threshold there; candidates are verified on all bits.

Large buckets (a big group of near copies shares most bits) are never paired out: their members are joined
to pivots, and groups of pivots are then compared only until they are known to be one component. What reaches a
bucket beyond BLOCK rows is dealt in blocks, each with the first one beside it; once the components of that are
known, only rows outside a bucket's largest component still meet all others, in pairs of blocks. Which way a bucket
takes changes the work and not the links' components.

Defined cases: null texts and texts without a word have fingerprint 0 and link like any other; texts of
fewer words than a shingle give one shingle; equal texts are joined by their fingerprint, not by pairs;
repeated rows stay; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations
from math import ceil, comb, log

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossmill.llm.common import cut, looked_up, map_texts, met, release, stored, utf8
from glossmill.llm.graph import components

BITS = 64
#: Buckets with more index members than this go to the pivot path; a pivot task holds about two blocks.
LARGE, BLOCK = 128, 20_000
#: Cost of one probe row against that of one verified candidate.
PROBE_COST, VERIFY_COST = 1.0, 0.1
#: Least hashes in a band, and the chance at most that two texts just similar enough share no band.
ROWS, MISS = 4, 1e-5
#: Band buckets with more members are searched as a whole, in pairs of blocks of at most so many members and bytes.
CROWD, CROWD_BLOCK, CROWD_BYTES = 32, 4_000, 16 << 20
#: Shingle sets up to this size may be broadcast, where very many links meet in them.
HOT_BYTES = 64 << 10


def fingerprint(text: bytes, width: int = 4, seed: int = 42) -> int:
    """The unsigned fingerprint of one text."""
    return majority(hashes(text, width, seed))


def hashes(text: bytes, width: int, seed: int = 42) -> np.ndarray:
    """The uint64 hash of every word shingle; none without a word, one where the words are fewer than a shingle's."""
    words = text.lower().split()  # bytes: A-Z only, and the six ASCII blanks
    if not words:
        return np.zeros(0, np.uint64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([digest(joined, seed)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-width] + 1].tolist()
    stops = ends[width - 1 :].tolist()
    return np.array([digest(joined[a:b], seed) for a, b in zip(starts, stops, strict=True)], np.uint64)


def majority(h: np.ndarray) -> int:
    """The bits that over half of the hashes set."""
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(h), 1 << 14):
        counts += np.unpackbits(h[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4) -> DataFrame:
    """key and fp, the fingerprint as a signed long."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(t, width) for t in utf8(batch.column(1))], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], [key, "fp"])

    return map_texts(df.select(key, text), work, f"{key} {dict(df.dtypes)[key]}, fp long", text)


def band_count(least: float) -> int:
    """Bands of ROWS least hashes, so many that texts of similarity `least` share none with a chance of MISS at most."""
    return 1 if least >= 1 else ceil(log(MISS) / log(1 - least**ROWS))


def bands(h: np.ndarray, mixers: np.ndarray) -> list[int]:
    """Signed hashes of the bands: ROWS least values each, every one under a mixing of its own."""
    least = np.full(mixers.shape[1], np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(h), 1 << 12):
        x = (h[at : at + (1 << 12), None] ^ mixers[0]) * mixers[1]
        x ^= x >> np.uint64(31)
        x *= mixers[2]
        least = np.minimum(least, x.min(axis=0))
    return np.array([xxhash.xxh64_intdigest(x.tobytes(), 42) for x in least.reshape(-1, ROWS)], np.uint64).view(np.int64).tolist()


def sketches(df: DataFrame, key: str, text: str, width: int, least: float) -> DataFrame:
    """k, th (key and hash of the text), fp, mark (128-bit digest of the shingle set), n (its size) and bands."""
    mixers = np.random.default_rng(42).integers(0, 1 << 64, (3, band_count(least) * ROWS), np.uint64) | np.uint64(1)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps, marks, sizes, banded = [], [], [], []
        for t in utf8(batch.column(2)):
            h = hashes(t, width)
            distinct = np.unique(h)
            fps.append(majority(h))
            marks.append(xxhash.xxh3_128_digest(distinct.tobytes()))
            sizes.append(len(distinct))
            banded.append(bands(distinct, mixers))
        columns = [batch.column(0), batch.column(1), pa.array(np.array(fps, np.uint64).view(np.int64)), pa.array(marks, pa.binary()), pa.array(sizes, pa.int64()), pa.array(banded, pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(columns, ["k", "th", "fp", "mark", "n", "bands"])

    return map_texts(df.select(F.col(key).alias("k"), F.xxhash64(text).alias("th"), F.col(text).alias("t")), work, f"k {dict(df.dtypes)[key]}, th long, fp long, mark binary, n long, bands array<long>", "t")


def co_counts(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and, over all of them, how often each pair of bits is set: 64 x 64 whole numbers."""

    def work(batches):
        total, n = np.zeros((BITS, BITS), np.int64), 0
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(fps), 1 << 16):
                x = np.unpackbits(np.ascontiguousarray(fps[at : at + (1 << 16)]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
                total += (x.T @ x).astype(np.int64)
                n += len(x)
        if n:
            cells = np.r_[n, total.ravel()]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells), dtype=np.int32)), pa.array(cells)], ["cell", "n"])

    rows = nodes.select("fp").mapInArrow(work, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    cells = np.zeros(BITS * BITS + 1, np.int64)
    for cell, n in rows:
        cells[cell] = n
    return int(cells[0]), cells[1:].reshape(BITS, BITS)


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in `parts` groups of nearly equal size; each grows by the bit most correlated with its members."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    linked = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    free, groups = set(range(BITS)), []
    for k in range(parts):
        size = (BITS - sum(map(len, groups))) // (parts - k)
        group = [max(free, key=lambda b: (spread[b], -b))]
        free.discard(group[0])
        while len(group) < size:
            best = max(free, key=lambda b: (round(linked[b, group].sum(), 9), -b))
            group.append(best)
            free.discard(best)
        groups.append(sorted(group))
    return groups


def allocate(n: int, both: np.ndarray, groups: list[list[int]], radius: int) -> tuple[float, list[int]]:
    """Thresholds (-1: not probed) that sum to radius - len(groups) + 1 at the least estimated cost."""
    n = max(n, 1)  # also without fingerprints the smallest balls are the cheapest
    p = np.diag(both) / n
    differ = 2 * p * (1 - p)
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for group in groups:
        near = np.zeros(radius + 1)  # chance of so many differing bits
        near[0] = 1
        for b in group:
            near = near * (1 - differ[b]) + np.r_[0, near[:-1]] * differ[b]
        costs = {-1: 0.0}
        for t in range(radius + 1):
            ball = sum(comb(len(group), i) for i in range(t + 1))
            costs[t] = PROBE_COST * n * ball + VERIFY_COST * n * n * float(near[: t + 1].sum()) / 2
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for t, c in costs.items():
                if used + t + 1 not in step or cost + c < step[used + t + 1][0]:
                    step[used + t + 1] = (cost + c, [*chosen, t])
        best = step
    return best[radius + 1]  # each t counts as t + 1: their sum is radius - m + 1 + m


def plan(n: int, both: np.ndarray, radius: int) -> tuple[list[list[int]], list[int]]:
    """The cheapest grouping into two to radius + 1 partitions, with its thresholds."""
    shown = [(allocate(n, both, groups := group_bits(n, both, m), radius), groups) for m in range(2, radius + 2)]
    (_, thresholds), groups = min(shown, key=lambda x: x[0][0])
    return groups, thresholds


def _masks(group: list[int], threshold: int) -> list[int]:
    """Signed masks that flip up to `threshold` of the group's bits."""
    flips = [sum(1 << b for b in some) for t in range(threshold + 1) for some in combinations(group, t)]
    return np.array(flips, np.uint64).view(np.int64).tolist()


def pivots(points: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that span the components of distinct uint64 points under distance <= radius.

    Points go to the first pivot within the radius; a pivot that also reaches points of earlier ones is linked
    to these. Only pairs of groups that are still apart, and whose pivots and widths leave room for a link,
    are then searched for one.
    """
    owner = np.full(len(points), -1)
    heads, widths, us, vs, parent = [], [], [], [], []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    free = 0
    while free < len(points):
        if owner[free] >= 0:
            free += 1
            continue
        g = len(heads)
        far = np.bitwise_count(points ^ points[free])
        near = np.flatnonzero(far <= radius)
        old = owner[near]
        fresh = near[old < 0]
        owner[fresh] = g
        parent.append(g)
        heads.append(points[free])
        widths.append(int(far[fresh].max()))
        us.append(np.full(len(fresh) - 1, points[free]))
        vs.append(points[fresh[1:]])
        seen, at = np.unique(old, return_index=True)
        for k, i in zip(seen.tolist(), at.tolist(), strict=True):
            if k >= 0 and root(k) != g:
                parent[root(k)] = g
                us.append(points[free : free + 1])
                vs.append(points[near[i] : near[i] + 1])
    top, wide = np.array(heads, np.uint64), np.array(widths, np.int64)
    order = np.argsort(owner, kind="stable")
    edges = np.searchsorted(owner[order], np.arange(len(heads) + 1))
    for i in range(len(top) - 1):
        reach = np.bitwise_count(top[i + 1 :] ^ top[i]) <= radius + wide[i] + wide[i + 1 :]
        for j in (np.flatnonzero(reach & ((wide[i] > 0) | (wide[i + 1 :] > 0))) + i + 1).tolist():
            if root(i) == root(j):
                continue
            small, big = sorted((points[order[edges[k] : edges[k + 1]]] for k in (i, j)), key=len)
            for at in range(0, len(small), 256):
                some = small[at : at + 256]
                hit = np.argwhere(np.bitwise_count(some[:, None] ^ big[None, :]) <= radius)
                if len(hit):
                    us.append(some[hit[0, :1]])
                    vs.append(big[hit[0, 1:]])
                    parent[root(j)] = root(i)
                    break
    return (np.concatenate(us), np.concatenate(vs)) if us else (points[:0], points[:0])


def links(nodes: DataFrame, radius: int) -> DataFrame:
    """Edges (u, v) between distinct fingerprints that keep every component of the relation distance <= radius."""
    n, both = co_counts(nodes)
    groups, thresholds = plan(n, both, radius)
    used = [(i, g, t) for i, (g, t) in enumerate(zip(groups, thresholds, strict=True)) if t >= 0]
    whole = {i: int(np.uint64(sum(1 << b for b in g)).view(np.int64)) for i, g, _ in used}
    fp = F.col("fp")
    key = lambda i: fp.bitwiseAND(F.lit(whole[i]))
    index = nodes.select("fp", F.explode(F.array(*[F.struct(F.lit(i).alias("part"), key(i).alias("bucket")) for i, _, _ in used])).alias("at")).select("fp", "at.*")
    reach = lambda i, g, t: F.transform(F.array(*[F.lit(m) for m in _masks(g, t)]), lambda m: F.struct(F.lit(i).alias("part"), key(i).bitwiseXOR(m).alias("bucket")))
    probes = nodes.select("fp", F.explode(F.concat(*[reach(i, g, t) for i, g, t in used])).alias("at")).select("fp", "at.*")
    sizes = cut(index.groupBy("part", "bucket").agg(F.count("*").alias("n")).where("n > 1 or part in (%s)" % ",".join([str(i) for i, _, t in used if t > 0] or ["-1"])))
    few, many = sizes.where(F.col("n") <= LARGE), sizes.where(F.col("n") > LARGE)
    members = index.withColumnRenamed("fp", "v").join(few, ["part", "bucket"]).drop("n")
    small = probes.join(members, ["part", "bucket"]).where((F.col("v") < fp) & (F.bit_count(fp.bitwiseXOR(F.col("v"))) <= radius)).select(F.col("fp").alias("u"), "v")
    if many.isEmpty():
        return small.distinct()
    # Members of large buckets, with all probes that reach them, each once: masks differ.
    reached = cut(probes.join(many.select("part", "bucket"), ["part", "bucket"]))

    def span(pdf: pd.DataFrame) -> pd.DataFrame:
        u, v = pivots(np.unique(pdf["fp"].to_numpy().view(np.uint64)), radius)
        return pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})

    sizes = cut(reached.groupBy("part", "bucket").agg(F.count("*").alias("uses")).where(F.col("uses") > BLOCK).withColumn("blocks", F.ceil(F.col("uses") / BLOCK).cast("int")))
    if sizes.isEmpty():
        return small.unionByName(reached.groupBy("part", "bucket").applyInPandas(span, "u long, v long")).distinct()
    # Where a bucket is larger than a block: in blocks, each with the first one.
    dealt = looked_up(reached, sizes, ["part", "bucket"], "uses", ["fp"]).withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks").cast("long")).cast("int"))
    others = F.when(F.col("blocks") > 1, F.sequence(F.lit(1), F.col("blocks") - 1)).otherwise(F.array(F.lit(0)))
    first = dealt.select("part", "bucket", "fp", F.explode(F.when(F.col("block") > 0, F.array("block")).otherwise(others)).alias("b")).groupBy("part", "bucket", "b").applyInPandas(span, "u long, v long")
    found = small.unionByName(first).distinct()
    if sizes.where("blocks > 2").isEmpty():
        return found
    found = cut(found)
    return found.unionByName(apart(dealt.where("blocks > 2"), "fp", components(found), BLOCK).groupBy("part", "bucket", "a", "b").applyInPandas(span, "u long, v long")).distinct()


def apart(dealt: DataFrame, node: str, labels: DataFrame, most: int) -> DataFrame:
    """Rows (part, bucket, node, label, block, blocks) in groups (a, b) in which all rows of different labels meet.

    Within a bucket those outside its most frequent label, in blocks of `most`, meet every block of all rows.
    """
    uses = dealt.groupBy(node).agg(F.count("*").alias("uses"))
    named = cut(looked_up(dealt, cut(uses.join(labels, F.col(node) == F.col("node"), "left").select(node, "uses", F.coalesce("label", node).alias("label"))), [node], "uses", ["part", "bucket"]))
    counts = named.groupBy("part", "bucket", "label").agg(F.count("*").alias("n"))
    tops = counts.groupBy("part", "bucket").agg(F.max_by("label", F.struct("n", "label")).alias("top"), F.sum("n").alias("uses"), F.max("n").alias("best"))
    tops = cut(tops.where("best < uses").withColumn("few", F.ceil((F.col("uses") - F.col("best")) / most).cast("int")).drop("best"))
    rows = looked_up(named, tops, ["part", "bucket"], "uses", [node]).where("top is not null")
    mine = F.pmod(F.xxhash64(F.lit(3), node), F.col("few").cast("long")).cast("int")
    as_any = F.transform(F.sequence(F.lit(0), F.col("few") - 1), lambda a: F.struct(a.alias("a"), F.col("block").alias("b")))
    as_few = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: F.struct(mine.alias("a"), b.alias("b")))
    pairs = F.when(F.col("label") == F.col("top"), as_any).otherwise(F.array_distinct(F.concat(as_any, as_few)))
    return rows.select("part", "bucket", node, "label", F.explode(pairs).alias("at")).select("part", "bucket", node, "label", "at.*")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4, radius: int = 4) -> DataFrame:
    """key, fp and component_id, the smallest key that the row's text reaches by links."""
    marked = cut(fingerprints(df, key, text, width))
    nodes = cut(marked.groupBy("fp").agg(F.min(key).alias("least"), F.count("*").alias("uses")))
    labels = components(links(nodes.select("fp"), radius))
    # Each fingerprint's label; one that no link touches stands for itself.
    named = cut(nodes.join(labels, nodes["fp"] == labels["node"], "left").select("fp", "least", "uses", F.coalesce("label", "fp").alias("label")))
    tops = named.groupBy("label").agg(F.min("least").alias("component_id"), F.count("*").alias("members"))
    found = looked_up(named, tops, ["label"], "members", ["fp"]).select("fp", "component_id", "uses")
    return looked_up(marked, found, ["fp"], "uses", [key]).select(key, "fp", "component_id")


def shingle_sets(texts: DataFrame, width: int) -> DataFrame:
    """mark and shingles of rows (t): the sorted distinct hashes of the word shingles, as little-endian uint64 bytes."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [np.unique(hashes(t, width)).astype("<u8").tobytes() for t in utf8(batch.column(0))]
        return pa.RecordBatch.from_arrays([pa.array([xxhash.xxh3_128_digest(x) for x in out], pa.binary()), pa.array(out, pa.binary())], ["mark", "shingles"])

    return map_texts(texts.select("t"), work, "mark binary, shingles binary", "t")


def resemblance(a: bytes, b: bytes) -> float:
    """Jaccard similarity of two shingle sets; two empty ones are equal."""
    x, y = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
    if not len(x) or not len(y):
        return float(len(x) == len(y))
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both)


def verified(edges: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The edges (u, v) between ids whose shingle sets have a Jaccard similarity of `least` or more."""
    pairs, total = edges, edges.count()
    for end, side in (("u", "a"), ("v", "b")):
        uses = edges.groupBy(end).agg(F.count("*").alias("uses"))
        held = sets.select(F.col("id").alias(end), F.col("shingles").alias(side)).join(uses, end)
        pairs = looked_up(pairs, held, [end], "uses", ["v" if end == "u" else "u"], F.octet_length(side) <= HOT_BYTES, total)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        similar = pa.array([resemblance(a, b) >= least for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)], pa.bool_())
        return batch.select(["u", "v"]).filter(similar)

    return map_texts(pairs, work, "u long, v long", "a")


def spanning(ids: np.ndarray, labels: np.ndarray, sets: list[bytes], least: float) -> tuple[list[int], list[int]]:
    """Similar pairs that, with the labels, keep every component of similarity `least` among the sets.

    Each member, from one component to the next, is compared with all those that no component has yet; what
    shares a label with a member found comes with it.
    """
    us, vs = [], []
    _, labels = np.unique(labels, return_inverse=True)
    arrays = [np.frombuffer(x, "<u8") for x in sets]
    sizes = np.array([len(x) for x in arrays], np.int64)
    vocabulary, codes = np.unique(np.concatenate(arrays), return_inverse=True)
    starts = np.r_[0, np.cumsum(sizes)]
    mine, present = [codes[a:b] for a, b in zip(starts[:-1], starts[1:], strict=True)], np.zeros(len(vocabulary), np.int64)
    free = np.argsort(-sizes, kind="stable")
    while len(free):
        chosen = labels[free] == labels[free[0]]
        queue, free = free[chosen].tolist(), free[~chosen]
        flat = np.concatenate([mine[i] for i in free]) if len(free) else codes[:0]
        while queue and len(free):
            i = queue.pop()
            present[mine[i]] = 1
            ends = np.cumsum(sizes[free])
            total = np.r_[0, np.cumsum(present[flat])]
            both = total[ends] - total[ends - sizes[free]]
            present[mine[i]] = 0
            union = sizes[free] + sizes[i] - both
            hit = np.where(union > 0, both / np.maximum(union, 1), 1.0) >= least
            if hit.any():
                # One link for each label that comes.
                came, first = np.unique(labels[free[hit]], return_index=True)
                us += [ids[i]] * len(came)
                vs += ids[free[hit][first]].tolist()
                chosen = np.isin(labels[free], came)
                queue += free[chosen].tolist()
                free = free[~chosen]
                flat = np.concatenate([mine[j] for j in free]) if len(free) else codes[:0]
    return us, vs


def crowds(large: DataFrame, labels: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Similar pairs (u, v) that join the labels within each large bucket. A bucket of one label has none."""
    sizes = cut(large.groupBy("part", "bucket").agg(F.count("*").alias("uses"), F.sum("n").alias("size")).withColumn("blocks", F.ceil(F.greatest(F.col("uses") / CROWD_BLOCK, F.col("size") * 8 / CROWD_BYTES)).cast("int")).drop("size"))
    dealt = cut(looked_up(large.select("part", "bucket", "id"), sizes, ["part", "bucket"], "uses", ["id"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks").cast("long")).cast("int")))
    rows = apart(dealt, "id", labels, CROWD_BLOCK)

    def span(pdf: pd.DataFrame) -> pd.DataFrame:
        u, v = spanning(pdf["id"].to_numpy(), pdf["label"].to_numpy(), pdf["shingles"].tolist(), least)
        return pd.DataFrame({"u": np.array(u, np.int64), "v": np.array(v, np.int64)})

    return rows.join(sets, "id").groupBy("part", "bucket", "a", "b").applyInPandas(span, "u long, v long")


def similar_groups(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, radius: int = 7, least: float = 0.8) -> DataFrame:
    """key and group_id: components of the relation that texts' shingle sets have a Jaccard similarity of `least`.

    Texts with one shingle set are one unit. Pairs of units that share a band are compared by their sets, and so
    are links of fingerprints within the radius and units with one fingerprint. In buckets of over CROWD members
    all are first compared with the least one, and then those that are still apart with each other. group_id is
    the smallest key of a group; null keys come first.
    """
    return _members(df, key, text, width, radius, least).select(F.col("k").alias(key), F.col("best.k").alias("group_id"))


def _members(df: DataFrame, key: str, text: str, width: int, radius: int, least: float) -> DataFrame:
    """k, th of every row, and `best`, the least (k, th) of its group."""
    marked = cut(sketches(df, key, text, width, least))
    units = marked.groupBy("mark").agg(F.min(F.struct("k", "th")).alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.count("*").alias("uses"))
    # Numbers of the units: checkpointed rows always come in the same order.
    units = cut(units).withColumn("id", F.monotonically_increasing_id())
    points = cut(marked.select("fp", "mark").distinct().join(units.select("mark", "id"), "mark").select("fp", "id"))
    heads = cut(points.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("uses")))
    star = looked_up(points, heads, ["fp"], "uses", ["id"]).where("id <> least").select(F.col("id").alias("u"), F.col("least").alias("v"))
    found = links(heads.select("fp"), radius)
    name = lambda side: heads.select(F.col("fp").alias(side), F.col("least").alias(f"{side}_id"))
    across = found.join(name("u"), "u").join(name("v"), "v").select(F.col("u_id").alias("u"), F.col("v_id").alias("v"))
    banded = units.select("id", "n", F.posexplode("bands").alias("part", "bucket"))
    sizes = cut(banded.groupBy("part", "bucket").agg(F.count("*").alias("uses"), F.min("id").alias("hub")).where("uses > 1").withColumn("members", F.col("uses")))
    index = cut(met(banded, sizes, ["part", "bucket"], "uses"))
    few, large = index.where(F.col("members") <= CROWD), index.where(F.col("members") > CROWD)
    other = few.select("part", "bucket", F.col("id").alias("v"), F.col("n").alias("m"))
    close = F.least("n", "m") >= F.greatest("n", "m") * (least - 1e-9)  # the similarity is no more than the sizes' ratio
    shared = few.join(other, ["part", "bucket"]).where((F.col("v") < F.col("id")) & close).select(F.col("id").alias("u"), "v")
    spokes = large.select(F.col("id").alias("u"), F.col("hub").alias("v"))
    edges = cut(star.unionByName(across).unionByName(shared).unionByName(spokes).where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    release(df.sparkSession)
    # One row of each unit that has a candidate shows its shingles.
    needed = units.join(edges.select(F.explode(F.array("u", "v")).alias("id")).distinct(), "id").select("mark", "id", "rep")
    rows = df.select(F.col(key).alias("k"), F.xxhash64(text).alias("th"), F.col(text).alias("t"))
    shown = rows.join(needed.select("rep"), rows["k"].eqNullSafe(F.col("rep.k")) & (rows["th"] == F.col("rep.th")), "left_semi")
    sets = stored(shingle_sets(shown, width).join(needed.select("mark", "id"), "mark").select("id", "shingles").dropDuplicates(["id"]), "shingles")
    similar = cut(verified(edges, sets, least))
    release(df.sparkSession)
    labels = cut(components(similar))
    if not large.isEmpty():
        labels = cut(components(similar.unionByName(crowds(large, labels, sets, least))))
    named = cut(units.join(labels, units["id"] == labels["node"], "left").select("mark", "rep", "uses", F.coalesce("label", "id").alias("label")))
    tops = named.groupBy("label").agg(F.min("rep").alias("best"), F.count("*").alias("members"))
    of_mark = looked_up(named, tops, ["label"], "members", ["mark"]).select("mark", "uses", "best")
    return looked_up(marked.select("k", "th", "mark"), of_mark, ["mark"], "uses", ["k", "th"]).select("k", "th", "best")


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, radius: int = 7, least: float = 0.8) -> DataFrame:
    """The rows of df that stand first, by key and then by a hash of the text, in their group.

    A row is its key and text: where a key repeats with other texts, each is judged by itself, and rows equal in
    both stay or go together. Null keys come first.
    """
    members = _members(df, key, text, width, radius, least)
    gone = cut(members.where(~(F.col("k").eqNullSafe(F.col("best.k")) & (F.col("th") == F.col("best.th")))).select(F.col("k").alias("_gm_k"), F.col("th").alias("_gm_th")).distinct())
    release(df.sparkSession)
    return df.join(gone, df[key].eqNullSafe(gone["_gm_k"]) & (F.xxhash64(text) == gone["_gm_th"]), "left_anti")


def hex_of(fp: Column) -> Column:
    """16 lower-case hex digits of a signed long."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
