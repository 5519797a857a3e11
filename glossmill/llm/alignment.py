"""Cross-tokenizer alignment through a dictionary of token groups.

Both tokenizers cut the same bytes. Where tokens of both end at the same byte, a group ends; all its A tokens are
linked to all its B tokens. A corpus has far fewer distinct groups than groups, so links are never expanded where
they occur: a group's text `a1,a2|b1` is its dictionary key, its links are written out once for each distinct
group, and counts are the group's documents. Documents that hold one pair in several groups would be counted
several times; within each document the surplus is found and taken off, so an id pair's count is exactly the
number of documents that hold it linked. The counts of a group's links are added up by group and joined back to
the documents by the key; groups in a 65,536th of all memberships or more, of which there are no more than that,
are broadcast, the others meet their documents in a shuffle.

Within a document, a blank or line break after a character that is no white space is a border of both
tokenizers' tokens (no piece of B reaches over one), so a text is cut there, and each distinct unit is encoded
once per worker. What cannot be cut so stays whole and goes to the tokenizers as it is.

Defined cases: texts that are null or empty, and those whose joined token bytes of A or B differ from a blank and
the text, have no tokens: zeros and an empty digest. Special tokens' strings are plain text. Rows are told apart by
a number of their own, so null or repeated keys and repeated rows count each by itself; extra columns are ignored;
an empty table gives an empty result. The path of either vocabulary is a parameter.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import cache
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossmill.llm.common import looked_up, map_texts, sliced, stored

#: A worker remembers at most so many distinct units or groups, then keeps those at hand; longer units are not remembered.
REMEMBERED, LONGEST = 250_000, 120
#: New units are encoded together, about so many in a text.
TOGETHER = 4000
#: Groups with this share of all memberships are broadcast, with their two sums: at most so many rows. Where rows meet, a
#: group of more than KEY characters is known by its SHA-256.
HOT_SHARE, KEY = 65_536, 64
MARKS = ".,;:!?"
#: A word's closing mark starts a unit of its own behind these letters.
_CLOSING = re.compile(r"[A-Za-zÀ-ÖØ-öø-ɏЀ-ҁҊ-ӿ][.,;:!?]")
_SAFE = re.compile(r"(?<=\S)(?=[ \n])")
MARK = "▁"


def paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones as they are, others from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    moved = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}


class Aligner:
    """Groups of texts, by two tokenizers; remembers what units come to."""

    def __init__(self, a_path: str, b_path: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(a_path), SentencePieceProcessor(model_file=b_path)
        self.a.encode_special_tokens = True
        letters = byte_letters()
        self.a_bytes: dict[int, bytes] = {}
        for token, i in self.a.get_vocab().items():
            if all(c in letters for c in token):
                self.a_bytes[i] = bytes(letters[c] for c in token)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(names)]
        self.blank = self.b.piece_to_id(MARK)
        #: No piece may reach over a unit's border, else texts are not cut.
        self.cuts = not any(MARK in p.lstrip(MARK) or "\n" in p for p in names)
        self.closes = not any(_CLOSING.search(p) for p in names)
        self.a_size = np.zeros(max(self.a_bytes) + 1, np.int64)
        self.a_size[list(self.a_bytes)] = [len(x) for x in self.a_bytes.values()]
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        #: What a unit is known by: a word without the blank before it, else the unit itself.
        self.where: dict[str, int] = {}
        self.parts: list[tuple[str, ...] | None] = []
        self.sizes = np.zeros((0, 4), np.int64)
        self.names: dict[str, str] = {}
        self.short: dict[tuple[int, int], dict[int, str]] = {}
        self.marks: dict[str, tuple[tuple[str, ...] | None, np.ndarray]] = {}

    def groups(self, text: str) -> tuple[np.ndarray, list[str], np.ndarray] | None:
        """Of a text that starts with a blank: where its groups end (bytes), their texts and tokens of A and B; None if bytes differ."""
        a, b = self.a.encode(text, add_special_tokens=False).ids, self.b.encode(text[1:]) if len(text) > 1 else [self.blank]
        raw = text.encode()
        if b"".join(self.a_bytes.get(i, b"") for i in a) != raw or b"".join(map(self.b_bytes.__getitem__, b)) != raw:
            return None
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        ends_a, ends_b = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        place = np.full(len(raw) + 1, -1, np.int64)
        place[ends_a] = np.arange(len(a))
        at_b = np.flatnonzero(place[ends_b] >= 0)
        ends = ends_b[at_b]
        at_a, at_b = np.r_[0, place[ends] + 1], np.r_[0, at_b + 1]
        tokens = np.stack([np.diff(at_a), np.diff(at_b)], axis=1)
        texts = np.empty(len(ends), object)
        shape = tokens[:, 0] << 32 | tokens[:, 1]
        for kind in np.unique(shape).tolist():
            x, y = kind >> 32, kind & 0xFFFFFFFF
            at = np.flatnonzero(shape == kind)
            ids = np.concatenate([a[at_a[at, None] + np.arange(x)], b[at_b[at, None] + np.arange(y)]], axis=1)
            texts[at] = self.spelt(x, y, ids)
        return ends, texts.tolist(), tokens

    def spelt(self, x: int, y: int, ids: np.ndarray) -> list[str]:
        """Texts of groups of x tokens of A and y of B. Short groups are known by their packed ids."""
        if x + y > 4 or ids.max() >= 1 << 16:
            return [self.names.setdefault(t, t) for t in (f"{','.join(map(str, own[:x]))}|{','.join(map(str, own[x:]))}" for own in ids.tolist())]
        known = self.short.setdefault((x, y), {})
        codes = (ids.astype(np.uint64) << (np.arange(x + y, dtype=np.uint64) * np.uint64(16))).sum(axis=1, dtype=np.uint64).tolist()
        out = list(map(known.get, codes))
        for i in [i for i, t in enumerate(out) if t is None]:
            own = list(map(str, ids[i].tolist()))
            out[i] = known.setdefault(codes[i], f"{','.join(own[:x])}|{','.join(own[x:])}")
        return out

    def learn(self, units: set[str]) -> None:
        fresh = units - self.where.keys()
        if len(self.where) + len(fresh) > REMEMBERED:
            at = [(u, self.where[u]) for u in units - fresh]
            self.parts, self.sizes = [self.parts[i] for _, i in at], self.sizes[[i for _, i in at]]
            self.where = {u: n for n, (u, _) in enumerate(at)}
            self.names, self.short = {}, {}
        odd = {u for u in fresh if u[0] == "\n" or " " in u or not u.isprintable()}
        plain = fresh - odd
        closed = [u for u in plain if u[-1] in MARKS and _CLOSING.fullmatch(u, len(u) - 2)] if self.closes else []
        words = list((plain - set(closed) | {u[:-1] for u in closed}) - self.where.keys())
        breaks = [u for u in odd if u[0] == "\n" and u[-1] != "\n" and " " not in u and u.lstrip("\n").isprintable()]
        for some, guard in ((words, ""), (breaks, " x")):
            for start in range(0, len(some), TOGETHER):
                self._together(some[start : start + TOGETHER], guard)
        for u in odd - set(breaks):
            self._together([u], " x")
        if closed:
            bases, marks = [self.where[u[:-1]] for u in closed], [self.mark(u[-1]) for u in closed]
            self.sizes = np.concatenate([self.sizes, self.sizes[bases] + np.array([size for _, size in marks])])
            self.where.update(zip(closed, range(len(self.parts), len(self.parts) + len(closed)), strict=True))
            self.parts += [None if self.parts[i] is None or mark is None else self.parts[i] + mark for i, (mark, _) in zip(bases, marks, strict=True)]

    def mark(self, mark: str) -> tuple[tuple[str, ...] | None, np.ndarray]:
        """Groups and sizes of a closing mark behind a letter."""
        if mark not in self.marks:
            found = self.groups(" x" + mark)
            if found is None:
                self.marks[mark] = (None, np.zeros(4, np.int64))
            else:
                ends, texts, tokens = found
                own = int(np.searchsorted(ends, 2, "right"))
                self.marks[mark] = (tuple(texts[own:]), np.array([*tokens[own:].sum(axis=0), len(texts) - own, tokens[own:].prod(axis=1).sum()]))
        return self.marks[mark]

    def _together(self, units: list[str], guard: str) -> None:
        """Encodes units as one text, each behind a guard, and remembers what lies within each."""
        whole = [u if u[:1].isspace() else " " + u for u in units]
        found = self.groups("".join(guard + u for u in whole))
        if found is None:
            if len(units) > 1:
                for u in units:
                    self._together([u], " x")
                return
            self.where[units[0]] = len(self.parts)
            self.parts.append(None)
            self.sizes = np.concatenate([self.sizes, np.zeros((1, 4), np.int64)])
            return
        ends, texts, tokens = found
        length = np.array([len(u.encode()) for u in whole], np.int64)
        behind = np.cumsum(length + len(guard))
        first, last = np.searchsorted(ends, behind - length, "right"), np.searchsorted(ends, behind, "right")
        sums = np.r_[np.zeros((1, 4), np.int64), np.cumsum(np.column_stack([tokens, np.ones(len(tokens), np.int64), tokens.prod(axis=1)]), axis=0)]
        self.sizes = np.concatenate([self.sizes, sums[last] - sums[first]])
        for u, i, j in zip(units, first.tolist(), last.tolist(), strict=True):
            self.where[u] = len(self.parts)
            self.parts.append(tuple(texts[i:j]))

    def cut(self, text: str) -> list[str]:
        """The units of a text behind a blank."""
        if not self.cuts:
            return [text if not text[:1].isspace() else " " + text]
        if "  " in text or " \n" in text or "\n " in text or text[0] == " " or text[-1] in " \n" or text[0] == "\n" or not text.replace("\n", "").isprintable():
            return [u[1:] if u[0] == " " and u[1:] and not u[1].isspace() else u for u in _SAFE.split(" " + text)]
        if "\n" not in text:
            return text.split(" ")
        out: list[str] = []
        breaks = ""
        for line in text.split("\n"):
            if line:
                words = line.split(" ")
                words[0] = breaks + words[0]
                out += words
                breaks = ""
            breaks += "\n"
        return out

    def align(self, texts: list[str | None]) -> list[tuple[int, int, int, int, str | None, dict[str, int]]]:
        """Tokens of A and B, groups, links, the groups in order as text (None: no tokens), and how often each group occurs."""
        units = [self.cut(t) if t else [] for t in texts]
        self.learn(set(chain.from_iterable(units)))
        out = []
        for text, own in zip(texts, units, strict=True):
            at = list(map(self.where.__getitem__, own))
            try:
                found = list(chain.from_iterable(map(self.parts.__getitem__, at)))
            except TypeError:  # a unit's bytes differ
                out.append(self.whole(text))
                continue
            n = self.sizes[at].sum(axis=0).tolist() if at else [0] * 4
            out.append((*n, ";".join(found) if own else None, dict(Counter(found))))
        for u in [u for u in self.where if len(u) > LONGEST]:
            del self.where[u]
        return out

    def whole(self, text: str) -> tuple[int, int, int, int, str | None, dict[str, int]]:
        """A text that has a unit whose bytes differ: as a whole it may still spell itself."""
        found = self.groups(" " + text)
        if found is None:
            return 0, 0, 0, 0, None, {}
        _, parts, tokens = found
        return (*(int(x) for x in tokens.sum(axis=0)), len(parts), int(tokens.prod(axis=1).sum()), ";".join(parts), dict(Counter(parts)))


@cache
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def links_of(group: str) -> dict[tuple[int, int], int]:
    """The distinct links (A id, B id) of a group and how often it has each."""
    a, b = (Counter(map(int, side.split(","))) for side in group.split("|"))
    return {(x, y): n * m for x, n in a.items() for y, m in b.items()}


def grouped(documents: DataFrame, key: str = "doc_id", text: str = "text", a_path: str | None = None, b_path: str | None = None, spell: bool = False) -> DataFrame:
    """A row per document: row (its number), key, n_a, n_b, n_groups, n_links, groups_sha256, its distinct groups and their
    frequencies; with `spell` also `alignment`, all groups in order."""
    a_path, b_path = a_path or paths()[0], b_path or paths()[1]
    names = ["row", key, "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups", "frequencies", *["alignment"] * spell]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = aligner(a_path, b_path).align(batch.column(2).to_pylist())
        numbers = [pa.array([x[i] for x in found], pa.int64()) for i in range(4)]
        digest = pa.array([sha256(x[4].encode()).hexdigest() if x[4] is not None else "" for x in found], pa.string())
        own = [pa.array([list(x[5]) for x in found], pa.list_(pa.string())), pa.array([list(x[5].values()) for x in found], pa.list_(pa.int32()))]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *numbers, digest, *own, *[pa.array([x[4] for x in found], pa.string())] * spell], names)

    rows = documents.select(F.monotonically_increasing_id().alias("row"), key, text)
    schema = f"row long, {key} {dict(documents.dtypes)[key]}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups array<string>, frequencies array<int>" + ", alignment string" * spell
    return map_texts(rows, work, schema, text)


def dictionary(rows: DataFrame) -> DataFrame:
    """grp and its documents in n; and rows with null grp: how often documents hold the pair a, b in a group beyond the first.

    Added up within tasks, then over all; a task's dictionaries are handed on before they outgrow REMEMBERED.
    """

    def work(batches):
        known: dict[str, list[int]] = {}
        groups, surplus = Counter(), Counter()

        def handed():
            g, p = list(groups), list(surplus)
            none = [None] * len(g)
            columns = [pa.array([*g, *[None] * len(p)], pa.string()), pa.array([*none, *(x >> 32 for x in p)], pa.int32()), pa.array([*none, *(x & 0xFFFFFFFF for x in p)], pa.int32()), pa.array([*groups.values(), *surplus.values()], pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["grp", "a", "b", "n"])

        for batch in batches:
            for own in batch.column(0).to_pylist():
                groups.update(own)
                if len(known) > REMEMBERED:
                    known.clear()
                for g in own:
                    if g not in known:
                        known[g] = [a << 32 | b for a, b in links_of(g)]
                held = Counter(chain.from_iterable(map(known.__getitem__, own)))
                if len(held) < sum(held.values()):
                    for p, n in held.items():
                        if n > 1:
                            surplus[p] += n - 1
            if len(groups) + len(surplus) > REMEMBERED:
                yield handed()
                groups, surplus = Counter(), Counter()
        yield handed()

    parts = rows.select("groups").mapInArrow(work, "grp string, a int, b int, n long")
    return parts.groupBy("grp", "a", "b").agg(F.sum("n").alias("n"))


def expanded(groups: DataFrame) -> DataFrame:
    """The links of each distinct group (grp, n): grp, a, b, times (how often the group has the link), n."""

    def work(batches):
        for batch in batches:
            for part in sliced(iter([batch]), 0, 1 << 18):
                grp, a, b, times, n = [], [], [], [], []
                for g, k in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    for (x, y), t in links_of(g).items():
                        grp.append(g)
                        a.append(x)
                        b.append(y)
                        times.append(t)
                        n.append(k)
                yield pa.RecordBatch.from_arrays([pa.array(grp, pa.string()), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(times, pa.int64()), pa.array(n, pa.int64())], ["grp", "a", "b", "times", "n"])

    return groups.select("grp", "n").mapInArrow(work, "grp string, a int, b int, times long, n long")


def pair_counts(links: DataFrame, surplus: DataFrame) -> DataFrame:
    """a, b, count (documents that hold the pair linked), best (whether it is the highest of its a), uses (groups that have it)."""
    parts = links.select("a", "b", F.col("n"), F.lit(1).alias("uses")).unionByName(surplus.select("a", "b", (-F.col("n")).alias("n"), F.lit(0).alias("uses")))
    counted = stored(parts.groupBy("a", "b").agg(F.sum("n").alias("count"), F.sum("uses").alias("uses")), "pair-counts")
    highest = counted.groupBy("a").agg(F.max("count").alias("highest"))  # a row per id of A's vocabulary
    return counted.join(F.broadcast(highest), "a").select("a", "b", "count", (F.col("count") == F.col("highest")).alias("best"), "uses")


def group_sums(links: DataFrame, pairs: DataFrame) -> DataFrame:
    """grp, n (documents), n_best and count_sum of one occurrence of the group."""
    found = looked_up(links, pairs, ["a", "b"], "uses", ["grp"])
    return found.groupBy("grp").agg(F.max("n").alias("n"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum"))


def document_sums(rows: DataFrame, sums: DataFrame, memberships: int) -> DataFrame:
    """row, n_best, count_sum: the sums of a document's groups by their frequencies."""
    least = max(2, -(-memberships // HOT_SHARE))
    sums = sums.withColumn("grp", F.when(F.length("grp") > KEY, F.sha2(F.col("grp").cast("binary"), 256)).otherwise(F.col("grp")))
    hot = {r["grp"]: (r["n_best"], r["count_sum"]) for r in sums.where(F.col("n") >= least).select("grp", "n_best", "count_sum").collect()}
    shared = rows.sparkSession.sparkContext.broadcast(hot)

    def work(batches):
        hot = shared.value
        for batch in batches:
            row, grp, often, best, total = [], [], [], [], []
            for r, own, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                x = y = 0
                for g, m in zip(own, k, strict=True):
                    if len(g) > KEY:
                        g = sha256(g.encode()).hexdigest()
                    s = hot.get(g)
                    if s is None:
                        row.append(r)
                        grp.append(g)
                        often.append(m)
                    else:
                        x += m * s[0]
                        y += m * s[1]
                row.append(r)
                grp.append(f"#{r}")  # no group: this row holds what is summed up already
                often.append(0)
                best += [None] * (len(row) - 1 - len(best)) + [x]
                total += [None] * (len(row) - 1 - len(total)) + [y]
            kinds = (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((row, grp, often, best, total), kinds, strict=True)], ["row", "grp", "often", "best", "total"])

    def bounded(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                yield batch.slice(start, 256)

    flat = rows.select("row", "groups", "frequencies").mapInArrow(lambda b: work(bounded(b)), "row long, grp string, often int, best long, total long")
    found = flat.join(sums.where(F.col("n") < least).select("grp", "n_best", "count_sum"), "grp", "left")
    own = lambda known, each: F.sum(F.coalesce(F.col(known), F.col("often") * F.col(each)))
    return found.groupBy("row").agg(own("best", "n_best").alias("n_best"), own("total", "count_sum").alias("count_sum"))


def align(documents: DataFrame, key: str = "doc_id", text: str = "text", a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row."""
    rows = stored(grouped(documents, key, text, a_path, b_path), "token-groups")
    words = stored(dictionary(rows), "group-dictionary")
    groups, surplus = words.where("grp IS NOT NULL"), words.where("grp IS NULL")
    links = stored(expanded(groups), "group-links")
    sums = stored(group_sums(links, pair_counts(links, surplus)), "group-sums")
    memberships = groups.agg(F.sum("n").alias("n")).first()["n"] or 0
    found = rows.drop("groups", "frequencies").join(document_sums(rows, sums, memberships), "row", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return found.select(key, "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
