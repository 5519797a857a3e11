"""The tagger boundary: any tagger gives words, lemmas and parts of speech, and what is mined keeps them.

A tagger is a function of a list of sentences that gives, for each, its tokens as (text, lemma, pos, skip); it runs over
Arrow batches, is called once per slice of bounded bytes, and may load its model on first use. `dictionary_tagger` makes one of a stated
table. Everything behind the boundary is columns: candidates carry the pattern, file and place of their first occurrence,
and a word its first lemma, through the same shuffle that counts them. Both are combined slice by slice before it.

Where a least frequency is asked for, windows are first counted in slots of a hash; only those in a slot that reaches it are
spelt and counted by themselves. A slot counts no less than each of its phrases, so none is lost, and what shares a slot goes
when it is counted.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmill.functions.text import is_noise_line
from glossmill.operators.tokens import STOP_WORDS, sentences_of
from glossmill.scratch import settled

Token = tuple[str, str, str, bool]
Tagger = Callable[[list[str]], list[list[Token]]]
TOKEN = "struct<text:string,lemma:string,pos:string,skip:boolean>"
#: Parts of speech that are left out of what is mined.
IDLE = ["PUNCT", "SPACE", "NUM", "SYM"]
MOST_ENTRIES = 500_000
#: Words whose tokens a dictionary's tagger holds from one call to the next.
MOST_HELD = 100_000
#: Sentences are tagged, and their tokens handed on, in slices of about so many bytes.
SLICE_BYTES = 1 << 20
#: Documents that Spark hands over at once: their words, tags and numbers are held outside the heap and again in the worker.
BATCH_ROWS = 1000
#: Words are counted in slices of about so many bytes, and slots are handed on when so many are at hand.
COUNT_BYTES, FLUSH = 1 << 21, 1 << 21
#: Slots are whole numbers of 32 bits, dealt by their first bits. What is looked up has 16 bits for each slot kept, 32 MB at most.
SLOT_BITS, PART_BITS, LEAST_BITS, MOST_BITS = 32, 9, 16, 28
_TOKEN = pa.struct([("text", pa.string()), ("lemma", pa.string()), ("pos", pa.string()), ("skip", pa.bool_())])


class _Held(dict):
    """What was made of a key, made when it is first asked for."""

    def __init__(self, make: Callable[[str], Token]) -> None:
        super().__init__()
        self.make = make

    def __missing__(self, key: str) -> Token:
        made = self[key] = self.make(key)
        return made


def dictionary_tagger(entries: dict[str, tuple[str, str]], other: Callable[[str], tuple[str, str]], stop_words: list[str] = STOP_WORDS) -> Tagger:
    """Lemma and part of speech of a word from a bounded table, of all other words from `other`; what is no word is PUNCT and skipped."""
    import regex

    if len(entries) > MOST_ENTRIES:
        raise ValueError(f"a dictionary holds at most {MOST_ENTRIES} words")
    token, stop = regex.compile(r"\p{L}+|[^\p{L}\s]+"), set(stop_words)

    def one(found: str) -> Token:
        low = found.lower()
        return (found, *(entries.get(low) or other(low)), low in stop) if found[0].isalpha() else (found, found, "PUNCT", True)

    known = _Held(one)

    def tag(sentences: list[str]) -> list[list[Token]]:
        if len(known) > MOST_HELD:
            known.clear()
        return [list(map(known.__getitem__, token.findall(s or ""))) for s in sentences]

    return tag


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """What is run inside gets Arrow batches of at most so many rows; a smaller setting stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _cuts(sizes: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours that together have at most about `most` bytes; a longer one stands alone."""
    start = size = 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and size + n > most:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(sizes):
        yield start, len(sizes)


def _lengths(strings: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.binary_length(strings), 0).to_numpy(zero_copy_only=False)


def _starts(lists: pa.ListArray) -> pa.Array:
    """Offsets of lists into their flattened values."""
    return pa.array(np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))]), pa.int32())


def _slices(batch: pa.RecordBatch, at: int, most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.ListArray]]:
    """A batch cut by the bytes in column `at`, a list of strings; each part with that column."""
    column = batch.column(at)
    ends = np.concatenate([[0], np.cumsum(_lengths(column.flatten()))])
    for i, j in _cuts(np.diff(ends[_starts(column).to_numpy()]), most):
        part = batch.slice(i, j - i)
        yield part, part.column(at)


def _ordered(batch: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    """Slices in the order of the key in the first column; where Arrow may order a type unlike Spark, each row stands alone."""
    kind, t = batch.column(0).type, pa.types
    same = any(f(kind) for f in (t.is_integer, t.is_string, t.is_large_string, t.is_binary, t.is_decimal, t.is_date, t.is_timestamp))
    for part, _ in _slices(batch, at, COUNT_BYTES if same else 0):
        yield part.take(pc.sort_indices(part.column(0), null_placement="at_start")) if same else part


def _tokens(tagged: list[list[Token]]) -> pa.ListArray:
    """Tagged sentences as Arrow; strings that tokens share are not copied before."""
    flat = [t for sentence in tagged for t in sentence]
    fields = [pa.array([t[i] for t in flat], _TOKEN[i].type) for i in range(4)]
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, tagged)]), pa.int32()), pa.StructArray.from_arrays(fields, fields=list(_TOKEN)))


def _behind(df: DataFrame, text: str, noise: bool, tagger: Tagger, made: Callable[[Iterator[list[list[Token]]], pa.Array], list[pa.Array]], columns: dict[str, str]) -> DataFrame:
    """df without `text`, with the columns that `made` gives of a slice's tagged sentences and where each document's begin."""
    body = F.coalesce(F.col(text), F.lit(""))
    if noise:
        body = F.array_join(F.filter(F.split(body, "\n"), lambda x: ~is_noise_line(x)), "\n")
    rest = [c for c in df.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, own in _slices(batch, len(rest)):
                found = own.flatten()
                each = (tagger(found[a:b].to_pylist()) for a, b in _cuts(_lengths(found)))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(rest)], *made(each, _starts(own))], [*rest, *columns])

    types = dict(df.dtypes)
    schema = ", ".join(f"`{c}` {kind}" for c, kind in [*((c, types[c]) for c in rest), *columns.items()])
    return df.select(*rest, sentences_of(body).alias("sentences")).mapInArrow(run, schema)


def tagged(df: DataFrame, tagger: Tagger, text: str = "text", noise: bool = False) -> DataFrame:
    """df without `text`, with `sentences`, each an array of tokens. With `noise` lines that are noise are left out before."""

    def made(each: Iterator[list[list[Token]]], starts: pa.Array) -> list[pa.Array]:
        return [pa.ListArray.from_arrays(starts, pa.concat_arrays([_tokens(x) for x in each] or [_tokens([])]))]

    return _behind(df, text, noise, tagger, made, {"sentences": f"array<array<{TOKEN}>>"})


_MINED = {"words": "array<string>", "lemmas": "array<string>", "pos": "array<string>", "sentences": "array<int>"}


def mined(df: DataFrame, tagger: Tagger, text: str = "text", noise: bool = False) -> DataFrame:
    """df without `text`, with what is mined of each document, place by place: words and lemmas (null where equal) in lower case, parts of speech, and numbers of sentences."""
    idle = set(IDLE)

    def made(each: Iterator[list[list[Token]]], starts: pa.Array) -> list[pa.Array]:
        words, lemmas, pos, sizes = [], [], [], []
        for some in each:
            flat = [t for sentence in some for t in sentence]
            # A token that stands in many places is looked at once.
            _, first, code = np.unique(np.fromiter(map(id, flat), np.int64, len(flat)), return_index=True, return_inverse=True)
            own = [flat[i] for i in first.tolist()]
            kept = np.array([not t[3] and t[2] not in idle for t in own], bool)[code]
            low = [t[0].lower() for t in own]
            at = pa.array(code[kept])
            words.append(pa.array(low, pa.string()).take(at))
            lemmas.append(pa.array([None if (x := t[1].lower()) == w else x for t, w in zip(own, low, strict=True)], pa.string()).take(at))
            pos.append(pa.array([t[2] for t in own], pa.string()).take(at))
            sizes.append(np.bincount(np.repeat(np.arange(len(some)), [len(x) for x in some])[kept], minlength=len(some)))
        sizes = np.concatenate([*sizes, np.zeros(0, np.int64)])
        first = starts.to_numpy()
        number = np.arange(len(sizes)) - np.repeat(first[:-1], np.diff(first))
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)])[first], pa.int32())
        joined = [pa.concat_arrays(x or [pa.array([], pa.string())]) for x in (words, lemmas, pos)]
        return [pa.ListArray.from_arrays(offsets, x) for x in (*joined, pa.array(np.repeat(number, sizes), pa.int32()))]

    return _behind(df, text, noise, tagger, made, _MINED)


def mined_tokens(sentence: Column) -> Column:
    """Tokens that are mined: words in lower case, without stop words and idle parts of speech."""
    kept = F.filter(sentence, lambda t: ~t["skip"] & ~t["pos"].isin(IDLE))
    return F.transform(kept, lambda t: F.struct(F.lower(t["text"]).alias("text"), F.lower(t["lemma"]).alias("lemma"), t["pos"].alias("pos")))


def _flat(docs: DataFrame) -> DataFrame:
    """Tagged documents in the form that `mined` gives; what has it already stays."""
    if set(_MINED) <= set(docs.columns):
        return docs
    token = lambda t, i: F.struct(t["text"].alias("words"), F.nullif(t["lemma"], t["text"]).alias("lemmas"), t["pos"].alias("pos"), i.alias("sentences"))
    all_of = F.flatten(F.transform("sentences", lambda s, i: F.transform(mined_tokens(s), lambda t: token(t, i))))
    rest = [c for c in docs.columns if c != "sentences"]
    return docs.select(*rest, all_of.alias("_gm_all")).select(*rest, *(F.col("_gm_all")[c].alias(c) for c in _MINED))


def _hashes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word, and the power by which what stands before it is multiplied: a phrase's hash depends on its string alone, wherever blanks are its words' own."""
    from pandas.util import hash_array

    of = lambda parts: hash_array(np.array(parts, dtype=object), categorize=False)
    found, power = of(words), np.full(len(words), _STEP, np.uint64)
    for i, w in enumerate(words):
        if " " in w:
            parts = of(w.split(" "))
            found[i], power[i] = parts[0], _STEP ** np.uint64(len(parts))
            for h in parts[1:]:
                found[i] = found[i] * _STEP + h
    return found, power


_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


class _Windows:
    """Windows of a slice of documents (words, sentences): where they begin, and their slots."""

    def __init__(self, words: pa.ListArray, sentences: pa.ListArray) -> None:
        self.starts = _starts(words).to_numpy()
        found = words.flatten().dictionary_encode()
        self.codes, self.words = found.indices.to_numpy(), found.dictionary
        self.doc = np.repeat(np.arange(len(words)), np.diff(self.starts))
        number = sentences.flatten().to_numpy()
        new = np.ones(len(number), bool)
        new[1:] = (self.doc[1:] != self.doc[:-1]) | (number[1:] != number[:-1])
        self.run = np.cumsum(new)

    def begin(self, n: int) -> np.ndarray:
        last = len(self.run) - n + 1
        return np.flatnonzero(self.run[:last] == self.run[n - 1 :]) if last > 0 else np.zeros(0, np.int64)

    def slots(self, begin: np.ndarray, n: int) -> np.ndarray:
        if not len(begin):
            return np.zeros(0, np.uint32)
        if not hasattr(self, "hashes"):
            self.hashes = _hashes(self.words.to_pylist())
        at, power = (x[self.codes] for x in self.hashes)
        h = at[begin]
        for k in range(1, n):
            h = h * power[begin + k] + at[begin + k]
        h = (h + np.uint64(n)) * _MIX
        return ((h ^ (h >> np.uint64(29))) * _STEP >> np.uint64(32)).astype(np.uint32)


def _joined(parts: list[pa.Array]) -> pa.Array:
    return pc.binary_join_element_wise(*parts, " ")


def _packed(numbers: np.ndarray) -> bytes:
    """Whole numbers of 32 bits by planes of bytes: of sorted ones' differences most are zeros."""
    return zlib.compress(np.ascontiguousarray(numbers, dtype="<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpacked(packed: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(packed), np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _frequent_slots(docs: DataFrame, sizes: range, least: int) -> DataFrame:
    """part, n and slots: those in which at least `least` windows of all documents are. A task holds a slice, FLUSH slots, or one part's counts."""
    width = SLOT_BITS - PART_BITS

    def told(waiting: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        slots, counts = np.unique(np.concatenate(waiting), return_counts=True)
        counts, edges = np.minimum(counts, least), np.searchsorted(slots, np.arange((1 << PART_BITS) + 1, dtype=np.uint64) << np.uint64(width))
        parts = [p for p in range(1 << PART_BITS) if edges[p] < edges[p + 1]]
        own = [slice(edges[p], edges[p + 1]) for p in parts]
        yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array([_packed(np.diff(slots[x], prepend=np.uint32(0))) for x in own], pa.binary()), pa.array([_packed(counts[x]) for x in own], pa.binary())], ["part", "slots", "counts"])

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held = [], 0
        for batch in batches:
            for part, words in _slices(batch, 0, COUNT_BYTES):
                of = _Windows(words, part.column(1))
                for n in sizes:
                    waiting.append(of.slots(of.begin(n), n))
                    held += len(waiting[-1])
                if held >= FLUSH:
                    yield from told(waiting)
                    waiting, held = [], 0
        if held:
            yield from told(waiting)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a part are neighbours."""
        now = None

        def done() -> Iterator[pa.RecordBatch]:
            found = np.sort(np.concatenate(reached))
            if len(found):
                yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([len(found)], pa.int64()), pa.array([_packed(np.diff(found, prepend=0))], pa.binary())], ["part", "n", "slots"])

        for batch in batches:
            for part, slots, more in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part != now:
                    yield from done() if now is not None else ()
                    now, counts, reached = part, np.zeros(1 << width, np.uint32), []
                at = np.cumsum(_unpacked(slots), dtype=np.int64) - (part << width)
                before = counts[at]
                counts[at] = after = np.minimum(before + _unpacked(more), least)
                reached.append(at[(before < least) & (after >= least)])
        yield from done() if now is not None else ()

    rows = _flat(docs).select("words", "sentences").mapInArrow(seen, "part int, slots binary, counts binary")
    return rows.repartition("part").sortWithinPartitions("part").mapInArrow(kept, "part int, n long, slots binary")


def _lookup(docs: DataFrame, sizes: range, least: int) -> tuple[np.ndarray, int]:
    """Bits that are set for frequent slots, by a slot's first bits, and how many bits those are. Its size is bounded, so all tasks get it whole."""
    with small_batches(docs.sparkSession):
        slots = settled(_frequent_slots(docs, sizes, least), "slots")
    kept = slots.agg(F.sum("n")).first()[0] or 0
    bits = min(MOST_BITS, max(LEAST_BITS, (16 * kept).bit_length()))

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, slots in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = np.zeros(1 << (bits - PART_BITS), bool)
                own[np.cumsum(_unpacked(slots), dtype=np.int64) >> (SLOT_BITS - bits)] = True
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([np.packbits(own).tobytes()], pa.binary())], ["part", "own"])

    out = np.zeros((1 << PART_BITS, 1 << (bits - PART_BITS - 3)), np.uint8)
    for row in slots.select("part", "slots").mapInArrow(drawn, "part int, own binary").toLocalIterator():
        out[row["part"]] = np.frombuffer(row["own"], np.uint8)
    return out.ravel(), bits


def candidate_counts(docs: DataFrame, key: str, source: str, sizes: range = range(2, 5), least: int = 1) -> DataFrame:
    """phrase, ngram_size, frequency, doc_count, pos_pattern and source_file of the first occurrence; one shuffle of phrases.

    docs: a row per document (key, source, and what `tagged` or `mined` gives). The first occurrence is the least by key and place.
    With `least` only phrases of that frequency or more are given; what can't reach it is not spelt. Long documents are best
    counted within `small_batches`.
    """
    flat = _flat(docs)
    passed = docs.sparkSession.sparkContext.broadcast(_lookup(flat, sizes, least)) if least > 1 else None

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _ordered(batch, 2):
                of = _Windows(part.column(2), part.column(4))
                tags = part.column(3).flatten()
                for n in sizes:
                    begin = of.begin(n)
                    if passed is not None:
                        table, bits = passed.value
                        slot = of.slots(begin, n) >> np.uint32(SLOT_BITS - bits)
                        begin = begin[(table[slot >> np.uint32(3)] >> (7 - (slot & np.uint32(7))).astype(np.uint8)) & 1 == 1]
                    if not len(begin):
                        continue
                    # By phrase and not by its words, which may have blanks of their own.
                    found = _joined([of.words.take(pa.array(of.codes[begin + k])) for k in range(n)]).dictionary_encode()
                    code, doc = found.indices.to_numpy().astype(np.int64), of.doc[begin]
                    first = np.unique(code, return_index=True)[1]
                    pairs = np.unique(code * part.num_rows + doc) // part.num_rows
                    own, at = pa.array(doc[first]), begin[first]
                    numbers = [pa.array(np.bincount(x), pa.int64()) for x in (code, pairs)]
                    columns = [found.dictionary, pa.array(np.full(len(first), n), pa.int32()), *numbers, part.column(0).take(own), pa.array(at - of.starts[doc[first]], pa.int32()), _joined([tags.take(pa.array(at + k)) for k in range(n)]), part.column(1).take(own)]
                    yield pa.RecordBatch.from_arrays(columns, ["phrase", "ngram_size", "frequency", "doc_count", "key", "place", "pos_pattern", "source_file"])

    types = dict(flat.dtypes)
    schema = f"phrase string, ngram_size int, frequency long, doc_count long, key {types[key]}, place int, pos_pattern string, source_file {types[source]}"
    rows = flat.select(F.col(key).alias("key"), F.col(source).alias("source"), "words", "pos", "sentences").mapInArrow(counted, schema)
    total = rows.groupBy("phrase", "ngram_size").agg(F.sum("frequency").alias("frequency"), F.sum("doc_count").alias("doc_count"), F.min_by(F.struct("pos_pattern", "source_file"), F.struct("key", "place")).alias("m"))
    return total.where(F.col("frequency") >= least).select("phrase", "ngram_size", "frequency", "doc_count", "m.*")


def lemma_counts(docs: DataFrame, key: str) -> DataFrame:
    """word, freq and the lemma of its first occurrence."""
    flat = _flat(docs)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _ordered(batch, 1):
                starts = _starts(part.column(1)).to_numpy()
                doc = np.repeat(np.arange(part.num_rows), np.diff(starts))
                words = part.column(1).flatten().dictionary_encode()
                _, first, code = np.unique(words.indices.to_numpy(), return_index=True, return_inverse=True)
                own = pa.array(doc[first])
                yield pa.RecordBatch.from_arrays([words.dictionary, pa.array(np.bincount(code), pa.int64()), part.column(0).take(own), pa.array(first - starts[doc[first]], pa.int32()), part.column(2).flatten().take(pa.array(first))], ["word", "freq", "key", "place", "lemma"])

    rows = flat.select(F.col(key).alias("key"), "words", "lemmas").mapInArrow(counted, f"word string, freq long, key {dict(flat.dtypes)[key]}, place int, lemma string")
    # A struct, as min_by passes over nulls.
    total = rows.groupBy("word").agg(F.sum("freq").alias("freq"), F.min_by(F.struct("lemma"), F.struct("key", "place")).alias("m"))
    return total.select("word", "freq", F.coalesce("m.lemma", "word").alias("lemma"))


def lexicon_components(candidates: DataFrame, words: DataFrame, common: DataFrame) -> DataFrame:
    """Keeps phrases with a component whose lemma is outside `common` (word); adds novel_components and common_components, as they stand in the phrase."""
    known = words.select("word", "lemma").join(common.select(F.col("word").alias("lemma"), F.lit(True).alias("known")).distinct(), "lemma", "left").select("word", "known")
    parts = candidates.select("phrase", "ngram_size", F.posexplode(F.split("phrase", " ")).alias("at", "word")).join(known, "word", "left")
    named = lambda c: F.transform(F.sort_array(F.collect_list(F.when(c, F.struct("at", "word")))), lambda x: x["word"])
    lists = parts.groupBy("phrase", "ngram_size").agg(named(F.col("known").isNull()).alias("novel_components"), named(F.col("known").isNotNull()).alias("common_components"))
    return candidates.join(lists.where(F.size("novel_components") > 0), ["phrase", "ngram_size"])
