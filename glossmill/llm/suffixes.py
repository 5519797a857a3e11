"""Suffix-array deduplication: bytes covered by a string of `size` bytes that also starts earlier are removed.

A sparse suffix array of the corpus is sorted and merged; the common prefixes of its neighbours are the result.

1. Sampling. Every window of `size` bytes has an anchor, the least hashed GRAM-byte string in it (of equal ones the
   first), so equal windows have equal anchors at one offset, whatever surrounds them. Consecutive windows with
   one anchor form a run. Its suffix starts at the anchor and ends with the run's last window; the bytes from
   the run's first window up to the anchor are its left part. Only the anchors' hashes are exchanged at first:
   runs whose hash stands alone in the corpus hold no repeated window and are dropped. What a task knows to be
   repeated sends one marker for each hash, so a string that very many texts hold is not gathered.
2. Splitters. A sample of the suffixes, SAMPLE for each bucket of about BUCKET bytes, is sorted on the driver and
   gives the ranges. A range starts at a whole anchor string, so that equal windows meet in one range. Only
   where one anchor string fills more than a range is it cut inside, by suffix and left part.
3. Sorted runs. Tasks sort suffixes, drop and report copies within the task, cut the order at the splitters and
   send front-coded pieces: the length of the prefix shared with the suffix before, and the rest.
4. Merge. For each range a loser tree merges the pieces; every contender carries its prefix common with the last
   winner, so known prefixes are never compared again, and the merged order comes with the common prefixes of
   neighbours. Equal suffixes with equal left parts meet; all but the first go whole.
5. Result. The window at offset o before an anchor is its suffix' first size - o bytes and its left part's nearest o.
   Neighbours that share that much of both, by the common prefixes of the two sorted orders, hold one window; all
   but the first (by key, then place) go. No byte is hashed for this, and none compared twice.
6. Windows that reach over a border inside an anchor string are settled by their own bytes, with the one first
   window of each range beside it.

Defined cases: null and empty texts and those shorter than `size` lose nothing; a null text stays null; a null
key comes before all others; matches never cross texts; rows that repeat a key are told apart by a hash of their
text, equal rows are judged alike, by what starts earlier in other rows or in themselves; other columns pass
through, but for those named like the results, which these replace; an empty table gives an empty result. A cut
inside a UTF-8 character is left as bytes in `kept_bytes`.
"""

from __future__ import annotations

import pickle
from bisect import bisect_left

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from glossmill.llm.common import SLICE_BYTES, sliced, stored, utf8

SIZE, GRAM = 100, 32
#: Bytes of suffixes in a range, hashes' bytes of text in a bucket, sampled suffixes for each range.
BUCKET, HASH_BUCKET, SAMPLE = 32 << 20, 256 << 20, 16
#: Texts are hashed in slices of so many bytes: a slice takes about 70 times as much memory.
SCAN_BYTES = 1 << 20
#: A task deals its anchors' hashes when it holds so many.
FLUSH = 1 << 20
#: A sample of at most so many rows is sent to all tasks; a larger one is joined by key.
SMALL_SAMPLE = 200_000
_BASE = 0x9E3779B97F4A7C15


# -- sampling


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Mixed polynomial hashes of all substrings of `gram` bytes, by doubling."""
    one = data.astype(np.uint64) + np.uint64(1)
    cur, width, out, done, left = one, 1, None, 0, gram
    while True:
        if left & 1:
            if out is None:
                out, done = cur, width
            else:
                n = len(one) - (done + width) + 1
                out = out[:n] * np.uint64(pow(_BASE, width, 1 << 64)) + cur[done : done + n]
                done += width
        left >>= 1
        if not left:
            break
        n = len(one) - 2 * width + 1
        cur = cur[:n] * np.uint64(pow(_BASE, width, 1 << 64)) + cur[width : width + n]
        width *= 2
    out = out ^ (out >> np.uint64(29))
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return out


def _sliding(values: np.ndarray, width: int, pick: np.ufunc, fill: int) -> np.ndarray:
    """pick over every window of `width` values, from running picks within blocks."""
    n = len(values) - width + 1
    whole = np.full(-(-len(values) // width) * width, fill, values.dtype)
    whole[: len(values)] = values
    block = whole.reshape(-1, width)
    ahead = pick.accumulate(block, axis=1).ravel()
    behind = pick.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(behind[:n], ahead[width - 1 : width - 1 + n])


def runs_of(texts: list[bytes], size: int = SIZE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts: index of the text, first window, number of windows, bytes from there to the anchor, its hash."""
    empty = np.zeros(0, np.int64)
    width = size - GRAM + 1
    lengths = np.array([len(t) for t in texts], np.int64)
    joined = np.frombuffer(b"".join(texts), np.uint8)
    if len(joined) < size:
        return empty, empty, empty, empty, empty.astype(np.uint64)
    h = gram_hashes(joined)
    # The upper half of the hash over the place: of equal hashes the first place is the least.
    ranked = h >> np.uint64(32) << np.uint64(32) | np.arange(len(h), dtype=np.uint64)
    anchor = (_sliding(ranked, width, np.minimum, 2**64 - 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    doc = np.repeat(np.arange(len(texts)), lengths)[: len(anchor)]
    valid = np.arange(len(anchor)) + size <= ends[doc]
    at = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])] & valid)
    # Valid windows of a text are contiguous, so a run ends at the next one or at the text's last window.
    n = np.minimum(np.r_[at[1:], len(anchor)], (ends - size + 1)[doc[at]]) - at
    return doc[at], at - starts[doc[at]], n, anchor[at] - at, h[anchor[at]]


def suffix_key(text: bytes, at: int, n: int, left: int, size: int = SIZE) -> bytes:
    """The suffix from a run's anchor, filled up to `size` bytes, its own length in two bytes, and the left part reversed."""
    p, stop = at + left, at + n - 1 + size
    return text[p:stop].ljust(size, b"\0") + (stop - p).to_bytes(2, "big") + text[at:p][::-1]


# -- sorted runs with common prefixes


def common_prefixes(strings: list[bytes]) -> np.ndarray:
    """For each of sorted strings the length of the prefix it shares with the one before."""
    out = np.zeros(len(strings), np.int64)
    for at in range(1, len(strings), 1 << 14):
        some = strings[at - 1 : at + (1 << 14)]
        width = max(map(len, some))
        lengths = np.array([len(s) for s in some])
        rows = np.frombuffer(b"".join([s.ljust(width, b"\0") for s in some]), np.uint8).reshape(-1, width)
        differ = rows[1:] != rows[:-1]
        same = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        out[at : at + len(some) - 1] = np.minimum(same, np.minimum(lengths[1:], lengths[:-1]))
    return out


def front_code(strings: list[bytes], prefixes: np.ndarray) -> tuple[np.ndarray, np.ndarray, bytes]:
    """(common prefix, length of the rest, the rests) of sorted strings."""
    rests = [s[p:] for s, p in zip(strings, prefixes.tolist(), strict=True)]
    return prefixes.astype(np.uint16), np.array([len(r) for r in rests], np.uint16), b"".join(rests)


def front_decode(prefixes: np.ndarray, lengths: np.ndarray, rests: bytes) -> list[bytes]:
    out, last, at = [], b"", 0
    for p, n in zip(prefixes.tolist(), lengths.tolist(), strict=True):
        last = last[:p] + rests[at : at + n]
        at += n
        out.append(last)
    return out


def _extend(a: bytes, b: bytes, at: int) -> int:
    """Common prefix of a and b, known to be at least `at`."""
    most = min(len(a), len(b))
    while at + 16 <= most and a[at : at + 16] == b[at : at + 16]:
        at += 16
    while at < most and a[at] == b[at]:
        at += 1
    return at


def merge(runs: list[tuple[list[bytes], list[int]]]) -> list[tuple[int, int, int]]:
    """Merges sorted strings with their common prefixes: (run, place in it, prefix shared with the string before).

    A loser tree. `known[r]` is the prefix that run r's head shares with the last winner it was compared with,
    or that came out there; of two contenders the one that shares more is smaller, and only when both share
    equally much are bytes behind that prefix compared.
    """
    k = 1
    while k < max(len(runs), 1):
        k *= 2
    strings = [r[0] for r in runs] + [[]] * (k - len(runs))
    prefixes = [r[1] for r in runs] + [[]] * (k - len(runs))
    place, known = [0] * k, [0] * k
    heads: list[bytes | None] = [s[0] if s else None for s in strings]
    losers = [0] * k

    def beats(a: int, b: int) -> bool:
        """Whether a's head comes first; the other one's known prefix becomes that with the winner."""
        x, y = heads[a], heads[b]
        if x is None or y is None:
            return y is None if x is None else True
        if known[a] != known[b]:
            return known[a] > known[b]
        p = _extend(x, y, known[a])
        first = p == len(x) if p in (len(x), len(y)) else x[p] < y[p]
        if p == len(x) == len(y):
            first = a < b
        known[b if first else a] = p
        return first

    def build(node: int) -> int:
        if node >= k:
            return node - k
        a, b = build(2 * node), build(2 * node + 1)
        winner, loser = (a, b) if beats(a, b) else (b, a)
        losers[node] = loser
        return winner

    out = []
    winner = build(1) if k > 1 else 0
    while heads[winner] is not None:
        i = place[winner]
        out.append((winner, i, known[winner]))
        place[winner] = i = i + 1
        if i < len(strings[winner]):
            heads[winner], known[winner] = strings[winner][i], prefixes[winner][i]
        else:
            heads[winner] = None
        node = (winner + k) >> 1
        while node:
            other = losers[node]
            if not beats(winner, other):
                losers[node], winner = winner, other
            node >>= 1
    return out


# -- windows


def repeated_windows(strings: list[bytes], shared: np.ndarray, places: np.ndarray, size: int = SIZE, low: bytes | None = None, high: bytes | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(gone, open): of distinct sorted suffix keys and for every offset, whether that window stands earlier too.

    shared: prefix that each key has in common with the one before; places: rows (key, mark, place of the anchor).
    A window is `open` if it is not gone and the range's borders `low` and `high` may part it from equal ones.
    Offset o is column o; windows that a run doesn't hold are neither.
    """
    most = size - GRAM
    left = np.array([len(s) - size - 2 for s in strings], np.int64)
    right = np.array([int.from_bytes(s[size : size + 2], "big") for s in strings], np.int64)
    ahead = np.minimum(shared, size)
    ahead[:1] = 0
    # Left parts in order within each block of neighbours that share an anchor string.
    block = np.cumsum(ahead < GRAM)
    lefts = [s[size + 2 :] for s in strings]
    order = np.array(sorted(range(len(strings)), key=lambda i: (block[i], lefts[i])), np.int64)
    behind = common_prefixes([lefts[i] for i in order.tolist()])
    behind[np.r_[True, block[order][1:] != block[order][:-1]]] = -1
    by_place = np.lexsort((places[:, 2], places[:, 1], places[:, 0]))
    edge = np.zeros(len(strings), np.int64)
    if low is not None:
        first = min(_extend(low, strings[0], 0), size)
        edge = np.maximum(edge, np.minimum.accumulate(np.r_[first, ahead[1:]]))
    if high is not None:
        last = min(_extend(high, strings[-1], 0), size)
        edge = np.maximum(edge, np.minimum.accumulate(np.r_[ahead[1:], last][::-1])[::-1])
    gone, open_ = np.zeros((len(strings), most + 1), bool), np.zeros((len(strings), most + 1), bool)
    left_id = np.empty(len(strings), np.int64)
    for o in range(most + 1):
        held = (left >= o) & (right >= size - o)
        some = by_place[held[by_place]]
        if not len(some):
            continue
        left_id[order] = np.cumsum(behind < o)
        group = np.cumsum(ahead < size - o)[some] * (len(strings) + 1) + left_id[some]
        _, first = np.unique(group, return_index=True)
        later = np.ones(len(some), bool)
        later[first] = False
        gone[some[later], o] = True
        open_[some[first], o] = edge[some[first]] >= size - o
    return gone, open_


def spans_of(ident: np.ndarray, mark: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, ...]:
    """Joins overlapping and touching spans of the same row."""
    if not len(ident):
        return ident, mark, start, stop
    order = np.lexsort((start, mark, ident))
    ident, mark, start, stop = ident[order], mark[order], start[order], stop[order]
    row = np.r_[True, (ident[1:] != ident[:-1]) | (mark[1:] != mark[:-1])]
    number = np.cumsum(row)
    shift = int(stop.max()) + 1
    reach = np.maximum.accumulate(stop + number * shift) - number * shift
    new = row | np.r_[True, start[1:] > reach[:-1]]
    at = np.flatnonzero(new)
    return ident[at], mark[at], start[at], np.maximum.reduceat(stop, at)


# -- the distributed operator


def _pack(*columns: np.ndarray) -> bytes:
    """Columns with their types, compressed: what is exchanged is small."""
    return pickle.dumps([(c.dtype.str, zstandard.compress(np.ascontiguousarray(c).tobytes(), 3)) for c in columns], protocol=5)


def _unpack(blob: bytes) -> list[np.ndarray]:
    return [np.frombuffer(zstandard.decompress(data), kind) for kind, data in pickle.loads(blob)]


_FOUND = "kind int, bucket int, blob binary, k long, mark long, start int, stop int"
_KINDS = {"kind": pa.int32(), "bucket": pa.int32(), "blob": pa.binary(), "k": pa.int64(), "mark": pa.int64(), "start": pa.int32(), "stop": pa.int32()}
#: Kinds of exchanged rows: a front-coded piece, a span that goes, a window at a border.
PIECE, SPAN, WINDOW = 0, 1, 2


def _frame(kind: int, bucket, blob, k, mark, start, stop) -> dict:
    n = len(k)
    return {"kind": np.full(n, kind, np.int32), "bucket": np.asarray(bucket, np.int32) if np.ndim(bucket) else np.full(n, bucket, np.int32), "blob": blob or [None] * n, "k": k, "mark": mark, "start": np.asarray(start, np.int32), "stop": np.asarray(stop, np.int32)}


def _batch(frame: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(frame[c], t) for c, t in _KINDS.items()], list(_KINDS))


def _firsts(places: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of rows numbered by equal strings: the first one by place for each number, and for each row."""
    order = np.lexsort((places[:, 2], places[:, 1], places[:, 0], number))
    front = order[np.flatnonzero(np.r_[True, number[order][1:] != number[order][:-1]])] if len(number) else order
    return front, front[number]


def splitters_of(sample: list[bytes], ranges: int) -> list[bytes]:
    """Borders of the ranges: whole anchor strings, and whole keys where one anchor string fills more than a range."""
    out: list[bytes] = []
    sample = sorted(sample)
    for i in range(1, ranges):
        if not sample:
            break
        key = sample[i * len(sample) // ranges]
        for border in (key[:GRAM], key):
            if not out or border > out[-1]:
                out.append(border)
                break
    return out


def repeated_spans(df: DataFrame, key: str, text: str, mark: str, size: int = SIZE, bucket_bytes: int = BUCKET) -> DataFrame:
    """k, mark, start, stop: spans that go, of rows told apart by key (a long, not null) and mark; spans may overlap.

    df is read several times; bucketed by key and mark, its texts are not shuffled.
    """
    spark = df.sparkSession
    bytes_ = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-bytes_ // HASH_BUCKET))

    def scan(batches):
        kept: list[tuple[np.ndarray, ...]] = []
        for batch in sliced(batches, 2, SCAN_BYTES):
            ids, marks = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            doc, at, n, left, h = runs_of(utf8(batch.column(2)), size)
            kept.append((ids[doc], marks[doc], at.astype(np.uint32), n.astype(np.uint8), left.astype(np.uint8), h))
            if sum(len(x[0]) for x in kept) >= FLUSH:
                yield from dealt(kept)
                kept = []
        yield from dealt(kept)

    def dealt(kept: list[tuple[np.ndarray, ...]]):
        if not sum(len(x[0]) for x in kept):
            return
        *columns, h = (np.concatenate(x) for x in zip(*kept, strict=True))
        distinct, where, count = np.unique(h, return_inverse=True, return_counts=True)
        twice = count[where] > 1
        kinds, targets, blobs = [], [], []

        def send(kind: int, b: int, chosen: np.ndarray, marker: np.ndarray, single: np.ndarray) -> None:
            for column, value in zip((kinds, targets, blobs), (kind, b, _pack(marker, single, *(c[chosen] for c in columns))), strict=True):
                column.append(value)

        # Known to be repeated: passed on as they are, to some bucket.
        known, none = np.flatnonzero(twice), np.zeros(0, np.uint32)
        for i in range(0, len(known), FLUSH // 16):
            send(1, int((h[known[i]] + np.uint64(i)) % np.uint64(buckets)), known[i : i + FLUSH // 16], none, none)
        # 32 bits of the hash besides its bucket: a few strings that stand alone pass too, which does no harm.
        for kind, values, places in ((0, distinct[count > 1], none), (2, h[~twice], np.flatnonzero(~twice))):
            b = (values % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(b, kind="stable")
            edges = np.flatnonzero(np.r_[True, np.diff(b[order]) != 0, True]) if len(b) else np.zeros(1, np.int64)
            for x, y in zip(edges[:-1], edges[1:], strict=True):
                short = (values[order[x:y]] >> np.uint64(32)).astype(np.uint32)
                if kind:
                    send(2, int(b[order[x]]), places[order[x:y]], none, short)
                else:
                    send(0, int(b[order[x]]), none.astype(np.int64), short, none)
        yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(targets, pa.int32()), pa.array(blobs, pa.binary())], ["kind", "bucket", "blob"])

    def repeated(pdf: pd.DataFrame) -> pd.DataFrame:
        known, markers, parts = ([_unpack(b) for b in pdf.loc[pdf["kind"] == kind, "blob"]] for kind in (1, 0, 2))
        if parts:
            single = np.concatenate([p[1] for p in parts])
            # A marker stands for two or more.
            _, where, count = np.unique(np.concatenate([single, *[p[0] for p in markers * 2]]), return_inverse=True, return_counts=True)
            keep = np.split(count[where[: len(single)]] > 1, np.cumsum([len(p[1]) for p in parts])[:-1])
            known += [[*p[:2], *(c[chosen] for c in p[2:])] for p, chosen in zip(parts, keep, strict=True) if chosen.any()]
        return pd.DataFrame({c: np.concatenate([x[i] for x in known]).astype(kind) if known else np.zeros(0, kind) for i, (c, kind) in enumerate((("k", np.int64), ("mark", np.int64), ("at", np.int32), ("n", np.int32), ("lead", np.int32)), 2)})

    thin = df.select(F.col(key).alias("k"), F.col(mark).alias("mark"), F.col(text).alias("t"))
    repeats = stored(thin.mapInArrow(scan, "kind int, bucket int, blob binary").groupBy("bucket").applyInPandas(repeated, "k long, mark long, at int, n int, lead int"), "suffix-repeats")
    runs, held = repeats.agg(F.count("*"), F.sum(F.col("n") + F.lit(size - 1))).first()
    ranges = max(spark.sparkContext.defaultParallelism, -(-(held or 0) // bucket_bytes))

    def with_texts(some: DataFrame, few: bool) -> DataFrame:
        lists = some.groupBy("k", "mark").agg(F.collect_set(F.struct("at", "n", "lead")).alias("runs")).withColumnsRenamed({"k": "k2", "mark": "mark2"})
        return thin.join(F.broadcast(lists) if few else lists, (F.col("k") == F.col("k2")) & (F.col("mark") == F.col("mark2"))).select("k", "mark", "t", "runs")

    def keyed(batch: pa.RecordBatch) -> tuple[list[bytes], np.ndarray]:
        """Suffix keys of a slice and their places (k, mark, anchor)."""
        listed = batch.column(3)
        offsets = listed.offsets.to_numpy()
        at, n, left = (listed.values.field(i).to_numpy(zero_copy_only=False) for i in range(3))
        ids, marks = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        strings = [suffix_key(t, int(at[j]), int(n[j]), int(left[j]), size) for i, t in enumerate(utf8(batch.column(2))) for j in range(offsets[i], offsets[i + 1])]
        owner, held_ = np.repeat(np.arange(len(ids)), np.diff(offsets)), slice(offsets[0], offsets[-1])
        return strings, np.stack([ids[owner], marks[owner], at[held_].astype(np.int64) + left[held_]], axis=1)

    def sampled(batches):
        for batch in sliced(batches, 2):
            yield pa.RecordBatch.from_arrays([pa.array(keyed(batch)[0], pa.binary())], ["key"])

    borders: list[bytes] = []
    if runs and ranges > 1:
        share = min(1.0, SAMPLE * ranges / runs)
        some = repeats.where(F.pmod(F.xxhash64("k", "mark", "at"), F.lit(1 << 30)) < int(share * (1 << 30)))
        borders = splitters_of([r[0] for r in with_texts(some, SAMPLE * ranges <= SMALL_SAMPLE).mapInArrow(sampled, "key binary").collect()], ranges)

    def whole_spans(strings: list[bytes], places: np.ndarray, gone: np.ndarray) -> tuple[np.ndarray, ...]:
        """The spans of whole runs."""
        left = np.array([len(strings[i]) for i in gone], np.int64) - size - 2
        right = np.array([int.from_bytes(strings[i][size : size + 2], "big") for i in gone], np.int64)
        return places[gone, 0], places[gone, 1], places[gone, 2] - left, places[gone, 2] + right

    def sort_runs(batches):
        for batch in sliced(batches, 2, 2 * SLICE_BYTES):
            strings, places = keyed(batch)
            order = np.array(sorted(range(len(strings)), key=strings.__getitem__), np.int64)
            strings, places = [strings[i] for i in order], places[order]
            same = common_prefixes(strings)
            lengths = np.array([len(s) for s in strings], np.int64)
            number = np.cumsum(np.r_[True, (same[1:] != lengths[1:]) | (lengths[1:] != lengths[:-1])][: len(strings)]) - 1
            front, first_of = _firsts(places, number)
            gone = np.flatnonzero((places != places[first_of]).any(axis=1))
            if len(gone):
                k, m, a, z = spans_of(*whole_spans(strings, places, gone))
                yield _batch(_frame(SPAN, (a + k) % ranges, None, k, m, a, z))
            kept = [strings[i] for i in front]
            prefixes = common_prefixes(kept)
            cuts = [0, *(bisect_left(kept, x) for x in borders), len(kept)]
            blobs, targets = [], []
            for b, (x, y) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                if y > x:
                    mine = prefixes[x:y].copy()
                    mine[0] = 0
                    heads, rests, data = front_code(kept[x:y], mine)
                    blobs.append(_pack(heads, rests, np.frombuffer(data, np.uint8), *places[front[x:y]].T))
                    targets.append(b)
            if blobs:
                nothing = np.zeros(len(blobs), np.int64)
                yield _batch(_frame(PIECE, np.array(targets), blobs, nothing, nothing, nothing, nothing))

    def merge_runs(pdf: pd.DataFrame) -> pd.DataFrame:
        known = pdf[pdf["kind"] == SPAN]  # spans that a task found by itself pass through
        parts = [_unpack(b) for b in pdf.loc[pdf["kind"] == PIECE, "blob"]]
        if not parts:
            return known
        pieces = [(front_decode(p[0], p[1], p[2].tobytes()), p[0].tolist()) for p in parts]
        merged = merge(pieces)
        offsets = np.cumsum([0, *(len(r[0]) for r in pieces[:-1])])
        places = np.concatenate([np.stack(p[3:], axis=1) for p in parts])[np.array([offsets[r] + i for r, i, _ in merged], np.int64)]
        strings = [pieces[r][0][i] for r, i, _ in merged]
        shared = np.array([p for _, _, p in merged], np.int64)
        lengths = np.array([len(s) for s in strings], np.int64)
        fresh = np.r_[True, (shared[1:] != lengths[1:]) | (lengths[1:] != lengths[:-1])]
        front, first_of = _firsts(places, np.cumsum(fresh) - 1)
        gone = np.flatnonzero((places != places[first_of]).any(axis=1))
        found = [whole_spans(strings, places, gone)]
        # Distinct suffixes: the first of equal ones shares with the one before what any of them does.
        b = int(pdf["bucket"].iat[0])
        low, high = borders[b - 1] if b else None, borders[b] if b < len(borders) else None
        ahead = np.minimum(shared[fresh], size)
        ahead[0] = 0
        edge = [_extend(x, strings[i], 0) if x is not None else 0 for x, i in ((low, 0), (high, len(strings) - 1))]
        near = np.r_[edge[0], ahead[1:]] >= GRAM
        near |= np.r_[ahead[1:], edge[1]] >= GRAM
        some = np.flatnonzero(near)
        opened: dict | None = None
        if len(some):
            # What lies between two of them shares less than an anchor string with either.
            mine, at = [strings[i] for i in front[some]], places[front[some]]
            reach = np.where(np.r_[True, np.diff(some) == 1], ahead[some], 0)
            gone, open_ = repeated_windows(mine, reach, at, size, low if edge[0] >= GRAM else None, high if edge[1] >= GRAM else None)
            # Neighbouring windows (falling offsets) as one span.
            most = size - GRAM
            steps = np.diff(np.pad(gone[:, ::-1], ((0, 0), (1, 1))).astype(np.int8), axis=1)
            (row, x), (_, y) = np.nonzero(steps == 1), np.nonzero(steps == -1)
            found.append((at[row, 0], at[row, 1], at[row, 2] - most + x, at[row, 2] - most + y - 1 + size))
            if open_.any():
                row, o = np.nonzero(open_)
                bodies = [mine[i][size + 2 : size + 2 + j][::-1] + mine[i][: size - j] for i, j in zip(row.tolist(), o.tolist(), strict=True)]
                opened = _frame(WINDOW, 0, bodies, at[row, 0], at[row, 1], at[row, 2] - o, at[row, 2] - o + size)
        k, m, a, z = spans_of(*(np.concatenate([s[i] for s in found]) for i in range(4)))
        frames = [known, pd.DataFrame(_frame(SPAN, 0, None, k, m, a, z))]
        return pd.concat([*frames, *([pd.DataFrame(opened)] if opened else [])], ignore_index=True)

    merged = stored(with_texts(repeats, False).mapInArrow(sort_runs, _FOUND).groupBy("bucket").applyInPandas(merge_runs, _FOUND), "suffix-merged")
    spans = merged.where(F.col("kind") == SPAN).select("k", "mark", "start", "stop")
    if len(set(x[:GRAM] for x in borders)) < len(borders):
        # One window of each range at most for each string of bytes, so the lists are as short as there are ranges.
        shown = merged.where(F.col("kind") == WINDOW).groupBy("blob").agg(F.collect_list(F.struct("k", "mark", "start", "stop")).alias("all")).where(F.size("all") > 1)
        later = shown.select(F.explode(F.filter("all", lambda x: x != F.array_min("all"))).alias("x")).select("x.*")
        spans = spans.unionByName(later)
    return spans


def dedup(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE, bucket_bytes: int = BUCKET, replace: bool = False) -> DataFrame:
    """df with n_bytes, n_removed, n_spans and kept_bytes (the remaining bytes of `text`); key is an integer column.

    With `replace`, `text` itself becomes the remaining text, without bytes left of a cut character.
    """
    added = ["n_bytes", "n_removed", "n_spans"]
    given = df.drop(*[c for c in (*added, "kept_bytes") if c not in (key, text)])
    marked = given.withColumns({"_gm_key": F.coalesce(F.col(key).cast("long"), F.lit(-(2**63))), "_gm_text": F.xxhash64(text)})
    # Both joins with the texts find them in their buckets, so they are shuffled once.
    marked = stored(marked, "suffix-texts", ["_gm_key", "_gm_text"])
    spans = repeated_spans(marked, "_gm_key", text, "_gm_text", size, bucket_bytes)
    lists = spans.groupBy("k", "mark").agg(F.collect_list(F.struct("start", "stop")).alias("_gm_spans")).withColumnsRenamed({"k": "_gm_k", "mark": "_gm_mark"})
    joined = marked.join(lists, (F.col("_gm_key") == F.col("_gm_k")) & (F.col("_gm_text") == F.col("_gm_mark")), "left").drop("_gm_k", "_gm_mark")
    fields = given.schema.fields
    names = [f.name for f in fields]
    at_text = names.index(text)

    def cut_out(batches):
        for batch in sliced(batches, at_text):
            out: tuple[list, ...] = ([], [], [], [])
            for value, t, spans_ in zip(batch.column(at_text), utf8(batch.column(at_text)), batch.column(len(names)).to_pylist(), strict=True):
                removed = n = 0
                kept = t
                if spans_:
                    parts, last = [], 0
                    pairs = np.array(sorted((s["start"], s["stop"]) for s in spans_), np.int64)
                    zero = np.zeros(len(pairs), np.int64)
                    _, _, starts, stops = spans_of(zero, zero, pairs[:, 0], pairs[:, 1])
                    for a, b in zip(starts.tolist(), stops.tolist(), strict=True):
                        parts.append(t[last:a])
                        last, removed, n = b, removed + b - a, n + 1
                    kept = b"".join([*parts, t[last:]])
                if replace:
                    kept = kept.decode(errors="ignore") if value.is_valid else None
                for column, x in zip(out, (len(t), removed, n, kept), strict=True):
                    column.append(x)
            columns = [batch.column(i) for i in range(len(names))]
            counts = [pa.array(c, pa.int64()) for c in out[:3]]
            if replace:
                columns[at_text] = pa.array(out[3], batch.schema.field(at_text).type)
                yield pa.RecordBatch.from_arrays([*columns, *counts], [*names, *added])
            else:
                yield pa.RecordBatch.from_arrays([*columns, *counts, pa.array(out[3], pa.binary())], [*names, *added, "kept_bytes"])

    schema = StructType([*fields, *(StructField(n, LongType()) for n in added), *([] if replace else [StructField("kept_bytes", BinaryType())])])
    return joined.select(*names, "_gm_spans").mapInArrow(cut_out, schema)
