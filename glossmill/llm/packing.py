"""Best-fit packing of tokenised documents by a grouping genetic algorithm on islands.

Each document's ids get a closing id; only documents longer than a sequence are cut, the rest stay whole. Full
pieces are sequences by themselves. The others are dealt by hash into shards of bounded size. For each shard
several islands evolve packings: a crossover injects whole well-filled bins of one parent into the other,
removes the bins that hold the same pieces, and best-fits the pieces so displaced; a mutation does the same
with poorly filled bins. After each epoch every island's best packing migrates to its neighbour. An island
stops when its bins reach a lower bound (Martello and Toth's L2), so easy shards cost one best-fit pass.

Defined cases: null and empty texts are one piece that holds the closing id; equal ids and repeated rows are
packed each by itself (pieces are told apart by a row number of their own); extra columns are ignored; an
empty table gives an empty result. The same stored pieces always give the same packing.
"""

from __future__ import annotations

import re
import zlib
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossmill.llm.common import map_texts, stored

CAPACITY, END_ID = 2048, 0
#: About so many pieces in a shard; islands for each shard, epochs, and within an epoch population and generations.
SHARD, ISLANDS, EPOCHS, POPULATION, GENERATIONS = 16_384, 2, 2, 4, 4
#: A worker remembers the ids of at most so many distinct pre-tokens, then starts anew.
REMEMBERED = 250_000


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids of whole texts as little-endian uint32 bytes, equal to the tokenizer's own.

    The vocabulary's pre-tokens are independent of one another, so each distinct one is encoded once and
    remembered. Only texts made of plain characters, for which Python's `re` splits exactly as the tokenizer
    does, take that way; all others, and those that hold a special token's string, go to the tokenizer whole.
    """

    PLAIN = re.compile(r"[\t-\r -~À-ÖØ-öø-ſ]*")
    SPLIT = re.compile(r"'(?:[sdmt]|ll|ve|re)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        model = self.tokenizer.model
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        letters = {**{b: chr(b) for b in shown}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}

        class Known(dict):
            def __missing__(self, word: str) -> bytes:
                if len(self) >= REMEMBERED:
                    self.clear()
                ids = [t.id for t in model.tokenize(word.encode().decode("latin-1").translate(letters))]
                self[word] = found = np.array(ids, "<u4").tobytes()
                return found

        self.known = Known()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def __call__(self, text: str) -> bytes:
        if self.PLAIN.fullmatch(text) and not any(s in text for s in self.special):
            return b"".join(map(self.known.__getitem__, self.SPLIT.findall(text)))
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def cut_points(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids; the first may be shorter, the rest are full."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first), *((at, capacity) for at in range(first, n, capacity))]


def pieces(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """key, piece, start, length, ids_crc32 of every piece of every row."""
    path = path or tokenizer_path()
    names = [key, "piece", "start", "length", "ids_crc32"]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        encode, end = encoder(path), np.array([END_ID], "<u4").tobytes()
        out: list[list] = [[] for _ in names]
        for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids = memoryview(encode(t or "") + end)
            for i, (start, length) in enumerate(cut_points(len(ids) // 4, capacity)):
                for column, value in zip(out, (k, i, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])), strict=True):
                    column.append(value)
        kinds = [batch.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names)

    return map_texts(df.select(key, text), work, f"{key} {dict(df.dtypes)[key]}, piece int, start long, length long, ids_crc32 long", text)


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """L2: for each a, pieces over capacity - a stand alone and those over half need a bin each."""
    count = np.bincount(lengths, minlength=capacity + 1)
    n, mass = np.r_[0, np.cumsum(count)], np.r_[0, np.cumsum(count * np.arange(capacity + 1))]
    half, a = capacity // 2, np.arange(0, capacity // 2 + 1)
    alone = n[-1] - n[capacity - a + 1]
    big_n, big_mass = n[capacity - a + 1] - n[half + 1], mass[capacity - a + 1] - mass[half + 1]
    small = mass[half + 1] - mass[a]
    return int((alone + big_n + np.maximum(0, -(-(small - (big_n * capacity - big_mass)) // capacity))).max())


class Bins:
    """Open bins by room, for best fit: the least sufficient room is the lowest set bit of a mask."""

    def __init__(self, rooms: list[int], ids: list[int], fresh: int):
        self.by_room: dict[int, list[int]] = {}
        self.mask, self.fresh = 0, fresh
        for room, b in zip(rooms, ids, strict=True):
            if room:
                self.put(room, b)

    def put(self, room: int, b: int) -> None:
        held = self.by_room.setdefault(room, [])
        held.append(b)
        self.mask |= 1 << room

    def fit(self, length: int, capacity: int) -> int:
        open_ = self.mask >> length
        if open_:
            room = length + (open_ & -open_).bit_length() - 1
            held = self.by_room[room]
            b = held.pop()
            if not held:
                self.mask &= ~(1 << room)
        else:
            room, b, self.fresh = capacity, self.fresh, self.fresh + 1
        if room > length:
            self.put(room - length, b)
        return b


def best_fit(lengths: np.ndarray, order: np.ndarray, capacity: int) -> np.ndarray:
    bins, out = Bins([], [], 0), np.empty(len(lengths), np.int64)
    sizes = lengths.tolist()
    for i in order.tolist():
        out[i] = bins.fit(sizes[i], capacity)
    return out


def _compact(assigned: np.ndarray) -> np.ndarray:
    return np.unique(assigned, return_inverse=True)[1]


def refit(lengths: np.ndarray, assigned: np.ndarray, loose: np.ndarray, capacity: int) -> np.ndarray:
    """Best-fits the loose pieces, longest first, into the bins of the others."""
    held = assigned[~loose]
    top = int(held.max(initial=-1)) + 1
    fill = np.bincount(held, lengths[~loose], top).astype(np.int64)
    live = np.flatnonzero(fill)
    bins, out = Bins((capacity - fill[live]).tolist(), live.tolist(), top), assigned.copy()
    at = np.flatnonzero(loose)
    at = at[np.argsort(-lengths[at], kind="stable")]
    for i, n in zip(at.tolist(), lengths[at].tolist(), strict=True):
        out[i] = bins.fit(n, capacity)
    return _compact(out)


def crossover(lengths: np.ndarray, a: np.ndarray, b: np.ndarray, rng: np.random.Generator, capacity: int) -> np.ndarray:
    """b's well-filled bins, some of them at random, enter a; a's bins that share a piece with them go."""
    fill = np.bincount(b, lengths)
    good = (fill >= np.quantile(fill, 0.5)) & (rng.random(len(fill)) < 0.5)
    injected = good[b]
    hit = np.zeros(int(a.max()) + 1, bool)
    hit[a[injected]] = True
    loose = hit[a] & ~injected
    child = np.where(injected, b + len(hit), a)
    return refit(lengths, child, loose, capacity)


def mutate(lengths: np.ndarray, a: np.ndarray, rng: np.random.Generator, capacity: int) -> np.ndarray:
    """Opens the worst-filled bins and a few others, and fits their pieces anew."""
    fill = np.bincount(a, lengths)
    opened = (fill <= np.quantile(fill, 0.02)) | (rng.random(len(fill)) < 0.02)
    return refit(lengths, a, opened[a], capacity)


def fitness(lengths: np.ndarray, a: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer bins first, then Falkenauer's mean square of the fill; smaller is better."""
    fill = np.bincount(a, lengths)
    return len(fill), -float(((fill / capacity) ** 2).mean())


def evolve(lengths: np.ndarray, elites: list[np.ndarray], seed: int, capacity: int = CAPACITY, population: int = POPULATION, generations: int = GENERATIONS) -> np.ndarray:
    """The best packing after some generations; elites take part unchanged."""
    rng, bound = np.random.default_rng(seed), lower_bound(lengths, capacity)
    rate = lambda x: fitness(lengths, x, capacity)
    alive = [*elites] or [best_fit(lengths, np.argsort(-lengths, kind="stable"), capacity)]
    if rate(min(alive, key=rate))[0] <= bound:
        return min(alive, key=rate)
    while len(alive) < population:
        alive.append(best_fit(lengths, np.argsort(-(lengths * rng.uniform(0.9, 1.1, len(lengths))), kind="stable"), capacity))
    for _ in range(generations):
        alive.sort(key=rate)
        if rate(alive[0])[0] <= bound:
            break
        children = []
        for _ in range(population - 1):
            i, j = sorted(rng.choice(len(alive), 2, replace=False).tolist())
            children.append(mutate(lengths, crossover(lengths, alive[i], alive[j], rng, capacity), rng, capacity))
        alive = [alive[0], *sorted([*alive[1:], *children], key=rate)[: population - 1]]
    return min(alive, key=rate)


def assign(items: DataFrame, capacity: int = CAPACITY, shard: int = SHARD, islands: int = ISLANDS, epochs: int = EPOCHS) -> DataFrame:
    """items (uid, length) -> uid, sequence_id, offset; sequence_id is the uid of the sequence's first piece."""
    shards = max(1, round(items.count() / shard))
    start = items.select(F.pmod(F.xxhash64("uid"), F.lit(shards)).cast("int").alias("shard"), F.explode(F.array(*[F.lit(i) for i in range(islands)])).alias("island"), "uid", "length", F.lit(None).cast("long").alias("own"), F.lit(None).cast("long").alias("guest"))
    schema = "shard int, island int, uid long, length long, own long, guest long"

    def step(epoch: int):
        def work(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("uid", ignore_index=True)
            lengths = pdf["length"].to_numpy()
            elites = [_compact(pdf[c].to_numpy().astype(np.int64)) for c in ("own", "guest") if not pdf[c].isna().any()]
            one, island = int(pdf["shard"].iat[0]), int(pdf["island"].iat[0])
            best = evolve(lengths, elites, zlib.crc32(f"{one} {island} {epoch}".encode()), capacity)
            return pdf.assign(own=best, guest=pd.array([pd.NA] * len(pdf), "Int64"))

        return work

    now = start
    for epoch in range(epochs):
        if epoch:
            # Elites migrate round the ring of islands.
            sent = now.select("shard", F.pmod(F.col("island") + 1, F.lit(islands)).cast("int").alias("island"), "uid", "length", F.lit(None).cast("long").alias("own"), F.col("own").alias("guest"))
            now = now.unionByName(sent).groupBy("shard", "island", "uid").agg(F.max("length").alias("length"), F.max("own").alias("own"), F.max("guest").alias("guest"))
        # Stored, as each epoch's result is read twice.
        now = stored(now.groupBy("shard", "island").applyInPandas(step(epoch), schema), "islands")

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        shown = {i: part.sort_values("uid") for i, part in pdf.groupby("island")}
        best = min(sorted(shown), key=lambda i: fitness(shown[i]["length"].to_numpy(), shown[i]["own"].to_numpy(), capacity))
        part = shown[best].sort_values(["own", "uid"], ignore_index=True)
        own, lengths = part["own"].to_numpy(), part["length"].to_numpy()
        first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        run = np.cumsum(np.r_[True, own[1:] != own[:-1]]) - 1
        before = np.cumsum(lengths) - lengths
        return pd.DataFrame({"uid": part["uid"], "sequence_id": part["uid"].to_numpy()[first][run], "offset": before - before[first][run]})

    return now.groupBy("shard").applyInPandas(choose, "uid long, sequence_id long, offset long")


def pack(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Every piece with its sequence and its place there; pieces are encoded once and stored."""
    cut = stored(pieces(df, key, text, path, capacity).withColumn("uid", F.monotonically_increasing_id()), "pieces")
    full = cut.where(F.col("length") == capacity).select("*", F.col("uid").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = cut.where(F.col("length") < capacity)
    placed = rest.join(assign(rest.select("uid", "length"), capacity), "uid")
    return full.unionByName(placed).select(key, "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
