"""SentencePiece encoding and decoding with a batched numpy Viterbi.

A text is cut into units that no piece crosses. Distinct units of equal length advance together, one position
at a time: every substring that ends there is hashed (from prefix hashes), its hash probes the sorted keys of
the pieces, and vectorised maxima over the candidates store a backpointer. For a unigram model a candidate
adds its score. For a BPE model a score tells the order of merges and not a chance, so the best sum is not
the model's segmentation; there a candidate is worth 0 if it may follow the last piece of the best path
to its start, else minus infinity. Two pieces may be neighbours if merging their joined text leaves
just these two, which a batched run of the merges finds out once for each distinct pair.

Characters outside the vocabulary become byte pieces. Decoding joins the pieces' bytes.

Defined cases: null and empty texts have no pieces; the mark U+2581 itself reads as a blank (as in the
format); repeated rows are encoded alike; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import defaultdict
from functools import cache
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from glossmill.llm.common import map_texts

MARK = "▁"
#: A worker remembers at most so many distinct units and pairs, then starts anew.
REMEMBERED, PAIRS = 800_000, 4_000_000
#: Units longer than this go through the merges or the plain recurrence by themselves.
UNIT_BLOCK = 40_000
#: A table of so many bits of a hash tells most substrings that are no piece before the sorted keys are probed.
FILTER_BITS = 21
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _model_type(path: str) -> int:
    """The model's algorithm from its trainer settings: 1 unigram, 2 BPE (field 3 of field 2 of the file)."""

    def fields(data: bytes):
        at = 0

        def number():
            nonlocal at
            value = shift = 0
            while True:
                byte = data[at]
                at += 1
                value |= (byte & 127) << shift
                shift += 7
                if byte < 128:
                    return value

        while at < len(data):
            tag = number()
            if tag & 7 == 0:
                yield tag >> 3, number()
            else:
                n = number() if tag & 7 == 2 else 8 if tag & 7 == 1 else 4
                yield tag >> 3, data[at : at + n]
                at += n

    with open(path, "rb") as file:
        settings = next((v for k, v in fields(file.read()) if k == 2), b"")
    return next((v for k, v in fields(settings) if k == 3), 1)


class Model:
    """Vocabulary arrays, and the encoder and decoder over them."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.names = [sp.id_to_piece(i) for i in range(n)]
        self.scores = np.array([sp.get_score(i) for i in range(n)], np.float64)
        self.bpe = _model_type(path) == 2
        byte = {int(m[1], 16): i for i in range(n) if sp.is_byte(i) and (m := _BYTE.fullmatch(self.names[i]))}
        self.byte_ids = [np.array([byte[b]], "<u4").tobytes() for b in range(256)]
        self.packed = [int(i).to_bytes(4, "little") for i in range(n)]
        special = {i for i in range(n) if sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)}
        self.normal = [i for i in range(n) if i not in special]
        self.lengths = np.array([len(x) for x in self.names], np.int64)
        self.longest = int(self.lengths[self.normal].max())
        self.power = np.array([pow(int(_BASE), k, 1 << 64) for k in range(self.longest + 1)], np.uint64)
        keys = np.zeros(len(self.normal), np.uint64)
        for length, rows in self._by_length([self.names[i] for i in self.normal]).items():
            h = self._prefix_hashes(self._matrix([self.names[self.normal[r]] for r in rows], length))
            keys[rows] = h[:, length] + np.uint64(length)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(self.normal, np.int64)[order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces with one hash")
        self.seen = np.zeros(1 << FILTER_BITS, bool)
        self.seen[self.keys >> np.uint64(64 - FILTER_BITS)] = True
        self.unk_score = float(self.scores[self.normal].min()) - 10.0
        self.raw = [b"" if i in special else self.names[i].replace(MARK, " ").encode() for i in range(n)]
        for b, i in byte.items():
            self.raw[i] = bytes([b])
        joined = {c for i in self.normal if len(self.names[i]) > 1 for c in self.names[i]} - {MARK}
        inside = "".join(re.escape(c) for c in sorted(joined))
        self.units = re.compile(f"{MARK}*[{inside}]+|{MARK}+|.", re.DOTALL)
        if any(MARK in self.names[i].lstrip(MARK) for i in self.normal):
            raise ValueError("pieces that cross words are not supported")
        self.pair_keys, self.pair_ok = np.zeros(0, np.int64), np.zeros(0, bool)
        self.alone = np.ones(n, bool)
        if self.bpe:
            self.alone[self.normal] = [len(x) == 1 for x in self.merge([self.names[i] for i in self.normal])]
        self.known: dict[str, bytes] = {}

    # -- hashing

    @staticmethod
    def _by_length(words: list[str]) -> dict[int, list[int]]:
        out: dict[int, list[int]] = defaultdict(list)
        for i, w in enumerate(words):
            out[len(w)].append(i)
        return out

    @staticmethod
    def _matrix(words: list[str], length: int) -> np.ndarray:
        return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(words), length)

    @staticmethod
    def _prefix_hashes(points: np.ndarray) -> np.ndarray:
        h = np.zeros((points.shape[0], points.shape[1] + 1), np.uint64)
        for i in range(points.shape[1]):
            h[:, i + 1] = h[:, i] * _BASE + points[:, i] + np.uint64(1)
        return h

    def lookup(self, key: np.ndarray) -> np.ndarray:
        """Ids of the hashes, or -1."""
        out = np.full(key.shape, -1, np.int64)
        maybe = np.nonzero(self.seen[key >> np.uint64(64 - FILTER_BITS)])
        wanted = key[maybe]
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        out[maybe] = np.where(self.keys[at] == wanted, self.ids[at], -1)
        return out

    def probe(self, h: np.ndarray, rows, start, stop) -> np.ndarray:
        """Ids of the substrings [start, stop) of the rows, or -1."""
        length = np.minimum(stop - start, self.longest)
        found = self.lookup(h[rows, stop] - h[rows, start] * self.power[length] + np.asarray(length).astype(np.uint64))
        return np.where(stop - start <= self.longest, found, -1)

    # -- merges

    def merge(self, words: list[str]) -> list[list[int]]:
        """BPE of each word: the best-scored neighbours merge first, of equals the leftmost; -1 for unknown characters."""
        out: list[list[int]] = [[] for _ in words]
        for length, members in self._by_length(words).items():
            for at in range(0, len(members), UNIT_BLOCK):
                some = members[at : at + UNIT_BLOCK]
                if length:
                    for i, ids in zip(some, self._merge_block([words[i] for i in some], length), strict=True):
                        out[i] = ids
        return out

    def _ends(self, words: list[str], sizes: np.ndarray, cut: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Prefix hashes, and the end of the symbol that starts at each place when nothing merges any more.

        Words of any lengths `sizes` advance together, padded to the longest. Where a merge would cross `cut`, a word is left
        there at once, with an end beyond the cut.
        """
        w, n = len(words), int(sizes.max())
        h, rows = self._prefix_hashes(self._matrix([x.ljust(n) for x in words], n)), np.arange(w)
        end = np.tile(np.arange(1, n + 2), (w, 1))  # of the symbol that starts there
        before = np.tile(np.arange(-1, n), (w, 1))  # start of the symbol before
        gain = np.full((w, n + 1), -np.inf)
        if n > 1:
            found = self.lookup(h[:, 2:] - h[:, :-2] * self.power[2] + np.uint64(2)) if self.longest > 1 else np.full((w, n - 1), -1)
            gain[:, : n - 1] = np.where((found >= 0) & (np.arange(2, n + 1) <= sizes[:, None]), self.scores[found], -np.inf)

        def rate(r: np.ndarray, i: np.ndarray) -> None:
            stop = end[r, end[r, i]]
            ok = stop <= sizes[r]
            found = np.where(ok, self.probe(h, r, i, np.minimum(stop, n)), -1)
            gain[r, i] = np.where(found >= 0, self.scores[found], -np.inf)

        live = rows
        while len(live):
            best = gain[live].argmax(axis=1)
            more = gain[live, best] > -np.inf
            live, best = live[more], best[more]
            if not len(live):
                break
            second = end[live, best]
            stop = end[live, second]
            end[live, best], before[live, stop] = stop, best
            gain[live, second] = -np.inf
            gain[live, best] = -np.inf
            if cut is not None:
                inside = (best >= cut[live]) | (stop <= cut[live])
                end[live[~inside], 0] = n + 1
                live, best, stop = live[inside], best[inside], stop[inside]
            inner, left = stop < sizes[live], before[live, best]
            has = left >= 0
            rate(np.r_[live[inner], live[has]], np.r_[best[inner], left[has]])
        return h, end

    def _merge_block(self, words: list[str], n: int) -> list[list[int]]:
        rows = np.arange(len(words))
        h, end = self._ends(words, np.full(len(words), n))
        out = []
        for r in range(len(words)):
            i, spans = 0, []
            while i < n:
                spans.append((i, int(end[r, i])))
                i = spans[-1][1]
            out.append(spans)
        flat_r = np.repeat(rows, [len(s) for s in out])
        flat = np.array([x for s in out for x in s], np.int64).reshape(-1, 2)
        ids = self.probe(h, flat_r, flat[:, 0], flat[:, 1]).tolist()
        at, result = 0, []
        for s in out:
            result.append(ids[at : at + len(s)])
            at += len(s)
        return result

    def _stay(self, pairs: np.ndarray) -> np.ndarray:
        """Whether merging the joined text of two pieces, left * len(names) + right, leaves just these two."""
        a, b = np.divmod(pairs, len(self.names))
        cut, sizes = self.lengths[a], self.lengths[a] + self.lengths[b]
        out = np.zeros(len(pairs), bool)
        for at in range(0, len(pairs), UNIT_BLOCK):
            some = slice(at, at + UNIT_BLOCK)
            _, end = self._ends([self.names[i] + self.names[j] for i, j in zip(a[some].tolist(), b[some].tolist(), strict=True)], sizes[some], cut[some])
            out[some] = (end[:, 0] == cut[some]) & (end[np.arange(len(end)), cut[some]] == sizes[some])
        return out

    def allowed(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether two pieces can be neighbours in a BPE result; -1 on the left: start or unknown character."""
        out = self.alone[right].copy()
        both = left >= 0
        if not both.any():
            return out
        wanted = left[both] * len(self.names) + right[both]
        distinct, where = np.unique(wanted, return_inverse=True)
        at = np.minimum(np.searchsorted(self.pair_keys, distinct), max(len(self.pair_keys) - 1, 0))
        fresh = distinct if not len(self.pair_keys) else distinct[self.pair_keys[at] != distinct]
        if len(fresh):
            ok = self._stay(fresh)
            keys = np.concatenate([self.pair_keys if len(self.pair_keys) < PAIRS else distinct[:0], fresh])
            values = np.concatenate([self.pair_ok if len(self.pair_keys) < PAIRS else ok[:0], ok])
            order = np.argsort(keys, kind="stable")
            self.pair_keys, self.pair_ok = keys[order], values[order]
            if len(distinct) != len(fresh) and len(keys) == len(fresh):
                return self.allowed(left, right)
            at = np.searchsorted(self.pair_keys, distinct)
        out[both] = self.pair_ok[at][where]
        return out

    # -- Viterbi

    def viterbi(self, words: list[str]) -> list[list[int]]:
        """The best path of each word; -1 for unknown characters."""
        out: list[list[int]] = [[] for _ in words]
        for length, members in self._by_length(words).items():
            block = max(1, UNIT_BLOCK * 8 // max(length, 8))
            for at in range(0, len(members), block):
                some = members[at : at + block]
                if length:
                    for i, ids in zip(some, self._viterbi_block([words[i] for i in some], length), strict=True):
                        out[i] = ids
        return out

    def _viterbi_block(self, words: list[str], n: int) -> list[list[int]]:
        h, w = self._prefix_hashes(self._matrix(words, n)), len(words)
        rows = np.arange(w)
        # Every piece found in the block, by its last position; of one position the longest come first.
        spans: list[list[tuple[int, np.ndarray, np.ndarray]]] = [[] for _ in range(n + 1)]
        unknown = np.zeros((w, n + 1), bool)
        for k in range(min(n, self.longest), 0, -1):
            found = self.lookup(h[:, k:] - h[:, :-k] * self.power[k] + np.uint64(k))
            if k == 1:
                unknown[:, 1:] = found < 0
            for stop in range(k, n + 1):
                r = np.flatnonzero(found[:, stop - k] >= 0)
                if len(r):
                    spans[stop].append((k, r, found[r, stop - k]))
        best = np.full((w, n + 1), -np.inf)
        best[:, 0] = 0.0
        last = np.full((w, n + 1), -1, np.int64)
        back = np.zeros((w, n + 1), np.int64)
        for stop in range(1, n + 1):
            if spans[stop]:
                r, ids = np.concatenate([x[1] for x in spans[stop]]), np.concatenate([x[2] for x in spans[stop]])
                start = stop - np.repeat([x[0] for x in spans[stop]], [len(x[1]) for x in spans[stop]])
                if self.bpe:
                    value = np.where(self.allowed(last[r, start], ids), best[r, start], -np.inf)
                else:
                    value = best[r, start] + self.scores[ids]
                # Maxima by row; the order is stable, so of equals the longest piece wins.
                top = np.full(w, -np.inf)
                np.maximum.at(top, r, value)
                hit = np.flatnonzero((value == top[r]) & (value > -np.inf))[::-1]
                best[r[hit], stop], last[r[hit], stop], back[r[hit], stop] = value[hit], ids[hit], start[hit]
            odd = unknown[:, stop]
            if odd.any():
                value = best[odd, stop - 1] + (0.0 if self.bpe else self.unk_score)
                at = np.flatnonzero(odd)[value > best[odd, stop]]
                best[at, stop], last[at, stop], back[at, stop] = value[value > best[odd, stop]], -1, stop - 1
        # All words walk back together.
        steps, at = [], np.full(w, n)
        while (at > 0).any():
            steps.append(np.where(at > 0, last[rows, at], -2))
            at = back[rows, at]
        path = np.stack(steps[::-1], axis=1)
        return [[i for i in p if i != -2] for p in path.tolist()]

    def _learn(self, units: set[str]) -> None:
        known = self.known
        fresh = [u for u in units if u not in known]
        if not fresh:
            return
        if len(known) + len(fresh) > REMEMBERED:
            known.clear()
            fresh = list(units)
        # Runs of marks tie in score, which only the merges themselves resolve.
        runs = [u for u in fresh if u.startswith(MARK * 2)] if self.bpe else []
        plain = [u for u in fresh if not (self.bpe and u.startswith(MARK * 2))]
        names, pack = self.names, self.packed
        for words, paths in ((plain, self.viterbi(plain)), (runs, self.merge(runs))):
            for word, path in zip(words, paths, strict=True):
                if -1 in path:
                    at, parts = 0, []
                    for i in path:
                        if i < 0:
                            parts += [self.byte_ids[b] for b in word[at].encode()]
                            at += 1
                        else:
                            parts.append(pack[i])
                            if not word.startswith(names[i], at):
                                raise ValueError("a path does not spell its unit")
                            at += len(names[i])
                    known[word] = b"".join(parts)
                else:
                    if "".join([names[i] for i in path]) != word:
                        raise ValueError("a path does not spell its unit")
                    known[word] = b"".join([pack[i] for i in path])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian uint32 bytes."""
        cut = [self.units.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        self._learn(set().union(*cut) if cut else set())
        return [b"".join(map(self.known.__getitem__, units)) for units in cut]

    def decode(self, ids: bytes) -> str:
        data = b"".join(map(self.raw.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return data.removeprefix(b" ").decode(errors="replace")


@cache
def model(path: str) -> Model:
    return Model(path)


def encode_column(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """key and ids (array of int) of each row."""
    path = path or model_path()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [np.frombuffer(x, "<u4").astype(np.int32) for x in model(path).encode([t or "" for t in batch.column(1).to_pylist()])]
        offsets = np.r_[0, np.cumsum([len(x) for x in found])].astype(np.int32)
        ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int32), *found])))
        return pa.RecordBatch.from_arrays([batch.column(0), ids], [key, "ids"])

    return map_texts(df.select(key, text), work, f"{key} {dict(df.dtypes)[key]}, ids array<int>", text)


def digests(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """key, n_pieces, ids_crc32, decoded_sha256, round_trip: encodes and decodes each row."""
    path = path or model_path()
    names = [key, "n_pieces", "ids_crc32", "decoded_sha256", "round_trip"]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        m, texts = model(path), [t or "" for t in batch.column(1).to_pylist()]
        out: tuple[list, ...] = ([], [], [], [])
        for t, ids in zip(texts, m.encode(texts), strict=True):
            back = m.decode(ids)
            for column, value in zip(out, (len(ids) // 4, crc32(ids), sha256(back.encode()).hexdigest(), back == t), strict=True):
                column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.bool_())
        return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))], names)

    return map_texts(df.select(key, text), work, f"{key} {dict(df.dtypes)[key]}, n_pieces long, ids_crc32 long, decoded_sha256 string, round_trip boolean", text)
