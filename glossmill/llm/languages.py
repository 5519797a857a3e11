"""Language identification by prediction by partial matching (PPM).

Each language has a tree of byte contexts of order 0 to ORDER, counted over the words of a labelled sample. A word
is coded as its UTF-8 bytes and a closing blank, after an opening blank; contexts reach back to that blank at most,
so a word's code length depends on nothing but the word. A byte that the longest known context has seen costs
-log2(n / (N + D)) bits there, n being its count, N all counts and D the distinct bytes of the context; else the
escape D / (N + D) is paid and the next shorter context is asked, in which the bytes of the longer one are excluded.
Below order 0 the bytes not yet excluded are equally likely. So the chances of all bytes sum to one in every
context, and the code lengths are exact under statistics that are frozen once learnt (counts with their own
exclusion sums are stored for each context). A document's length in a language is the sum over its words; the
shortest wins, and the score is its share of 2^-length among all languages.

Words are runs of letters, lower-cased. Distinct words are coded once per worker, all new ones of a slice together.

Defined cases: null texts and texts without a letter are `und` with score 0, as are all where no language was
learnt; rows with a null language are not learnt from; of equal lengths the first language in order of names wins;
repeated rows get equal results; other columns are ignored; an empty table gives an empty result. The sample has
about TRAIN_BYTES of text, drawn by a hash of the row at any size; nothing but the text enters a prediction.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossmill.llm.common import map_texts, sliced, stored

#: Longest context in bytes; a context and its byte fill a 64-bit key.
ORDER = 5
#: Bound of the fit: expected characters of the sample, and the most languages (those with the most sampled text).
TRAIN_BYTES, MOST_LANGUAGES = 12_000_000, 256
#: A worker remembers the code lengths of at most so many distinct words, then starts anew.
REMEMBERED = 400_000
UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")
_BLANK = 0x20


def held_out(key: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(key.cast("string")), F.lit(5)) == 0, F.lit(False))


def word_grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each coded byte of the words: its word, its place in the word, and the bytes up to it (last ORDER + 1) as one key."""
    data = np.frombuffer(b"".join(w + b" " for w in words), np.uint8).astype(np.uint64)
    lengths = np.array([len(w) + 1 for w in words], np.int64)
    of = np.repeat(np.arange(len(words)), lengths)
    place = np.arange(len(data)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    key = data.copy()
    for back in range(1, ORDER + 1):
        earlier = np.full(len(data), _BLANK, np.uint64)
        earlier[back:] = data[: max(len(data) - back, 0)]
        earlier[place == back - 1] = _BLANK
        inside = place >= back - 1
        key[inside] |= earlier[inside] << np.uint64(8 * back)
    return of, place, key


def _at(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Index of each wanted key in the sorted keys, or -1."""
    if not len(keys):
        return np.full(len(wanted), -1)
    i = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[i] == wanted, i, -1)


@dataclass
class Order:
    """One order of one language's tree: counts by context and byte, and of each context N, D and the exclusion sum."""

    grams: np.ndarray
    counts: np.ndarray
    contexts: np.ndarray
    total: np.ndarray
    distinct: np.ndarray
    excluded: np.ndarray  # of the next shorter context's counts, those of bytes that this context has


@dataclass
class Model:
    """Trees by language; `name` tells workers' remembered words of different models apart."""

    languages: list[str]
    trees: list[list[Order]]
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    def code_lengths(self, words: list[bytes]) -> np.ndarray:
        """Bits of each word (rows) in each language (columns)."""
        out = np.zeros((len(words), len(self.languages)))
        if not words:
            return out
        of, place, key = word_grams(words)
        for j, tree in enumerate(self.trees):
            out[:, j] = np.bincount(of, _bits(tree, place, key), minlength=len(words))
        return out


def _bits(tree: list[Order], place: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Bits of each byte: the longest context is asked first, then shorter ones with the longer one's bytes excluded."""
    n = len(key)
    bits, open_ = np.zeros(n), np.ones(n, bool)
    gone, gone_distinct = np.zeros(n), np.zeros(n)  # counts and bytes excluded in the context asked next
    for k in range(len(tree) - 1, -1, -1):
        at = np.flatnonzero(open_ & (place >= k - 1)) if k else np.flatnonzero(open_)
        if not len(at):
            continue
        order = tree[k]
        gram = key[at] & np.uint64((1 << 8 * (k + 1)) - 1)
        context = _at(order.contexts, gram >> np.uint64(8))
        at, gram, context = at[context >= 0], gram[context >= 0], context[context >= 0]
        total, distinct = order.total[context] - gone[at], order.distinct[context] - gone_distinct[at]
        seen = _at(order.grams, gram)
        count = np.where(seen >= 0, order.counts[seen], 0) if len(order.counts) else np.zeros(len(at))
        some = distinct > 0  # else all its bytes are excluded, and the escape is certain
        share = np.where(count > 0, count, distinct) / np.where(some, total + distinct, 1)
        bits[at] -= np.where(some, np.log2(np.where(some, share, 1)), 0)
        open_[at[count > 0]] = False
        gone[at], gone_distinct[at] = order.excluded[context], order.distinct[context]
    rest = np.flatnonzero(open_)
    bits[rest] += np.log2(256 - gone_distinct[rest])
    return bits


def tree_of(grams: list[tuple[np.ndarray, np.ndarray]]) -> list[Order]:
    """A language's tree from (keys, counts) of each order."""
    out: list[Order] = []
    for k, (keys, counts) in enumerate(grams):
        by = np.argsort(keys)
        keys, counts = keys[by].astype(np.uint64), counts[by].astype(float)
        contexts, first = np.unique(keys >> np.uint64(8), return_index=True)
        total = np.add.reduceat(counts, first) if len(first) else np.zeros(0)
        distinct = np.diff(np.r_[first, len(keys)]).astype(float)
        excluded = np.zeros(len(contexts))
        if k and len(keys):
            shorter = out[k - 1]
            inner = _at(shorter.grams, keys & np.uint64((1 << 8 * k) - 1))
            excluded = np.add.reduceat(shorter.counts[inner], first)
        out.append(Order(keys, counts, contexts, total, distinct, excluded))
    return out


def sample(documents: DataFrame, key: str, text: str, label: str, size: int) -> DataFrame:
    """text and language of labelled rows that are not held out, of about `size` characters together at any input size."""
    usable = documents.where(F.col(label).isNotNull() & F.col(text).isNotNull() & ~held_out(F.col(key)))
    whole = usable.agg(F.sum(F.char_length(text)).alias("n")).first()["n"] or 0
    share = min(1.0, size / max(whole, 1))
    drawn = F.pmod(F.xxhash64(F.lit(13), key, text), F.lit(1 << 20)) < F.lit(int(np.ceil(share * (1 << 20))))
    return usable.where(drawn).select(F.col(text).alias("text"), F.col(label).cast("string").alias("lang"))


def word_counts(rows: DataFrame) -> DataFrame:
    """lang, word (UTF-8) and n over the rows; added up within tasks, then over all."""

    def work(batches):
        for batch in batches:
            found: dict[str, Counter] = {}
            for t, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found.setdefault(lang, Counter()).update(WORD.findall(t.lower()))
            for lang, words in found.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words), pa.string()), pa.array([w.encode() for w in words], pa.binary()), pa.array(list(words.values()), pa.int64())], ["lang", "word", "n"])

    return rows.mapInArrow(lambda batches: work(sliced(batches, 0)), "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def gram_counts(words: DataFrame) -> DataFrame:
    """lang, order, gram (context and byte as one number) and n."""

    def work(batches):
        for batch in batches:
            langs, texts = np.array(batch.column(0).to_pylist(), object), batch.column(1).to_pylist()
            n = np.array(batch.column(2).to_pylist(), np.int64)
            for lang in dict.fromkeys(langs):
                rows = np.flatnonzero(langs == lang)
                of, place, key = word_grams([texts[i] for i in rows])
                weight = n[rows][of]
                for k in range(ORDER + 1):
                    ok = place >= k - 1
                    grams, index = np.unique(key[ok] & np.uint64((1 << 8 * (k + 1)) - 1), return_inverse=True)
                    sums = np.bincount(index, weight[ok], minlength=len(grams)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(np.full(len(grams), k, np.int32)), pa.array(grams.astype(np.int64)), pa.array(sums)], ["lang", "order", "gram", "n"])

    return words.mapInArrow(work, "lang string, order int, gram long, n long").groupBy("lang", "order", "gram").agg(F.sum("n").alias("n"))


def fit(documents: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", size: int = TRAIN_BYTES) -> Model:
    """Learns a tree for each language from a sample of bounded size; the driver holds the trees, never the texts."""
    words = stored(word_counts(sample(documents, key, text, label, size)), "language-words")
    volume = words.groupBy("lang").agg(F.sum(F.octet_length("word") * F.col("n")).alias("size"))
    languages = sorted(r["lang"] for r in volume.orderBy(F.desc("size"), "lang").limit(MOST_LANGUAGES).collect())
    if not languages:
        return Model([], [])
    found = gram_counts(words.where(F.col("lang").isin(languages))).toArrow()
    langs, orders = found.column("lang").to_numpy(zero_copy_only=False), found.column("order").to_numpy()
    grams, n = found.column("gram").to_numpy(), found.column("n").to_numpy()
    trees = []
    for lang in languages:
        own = [np.flatnonzero((langs == lang) & (orders == k)) for k in range(ORDER + 1)]
        trees.append(tree_of([(grams[i], n[i]) for i in own]))
    return Model(languages, trees)


#: Of the model a worker uses just now: its name, each remembered word's row, and the rows of code lengths.
_known: tuple[str, dict[str, int], np.ndarray] = ("", {}, np.zeros((0, 0)))


def lengths_of(texts: list[str | None], model: Model) -> tuple[np.ndarray, list[bool]]:
    """Bits of each text in each language, and whether it has a letter."""
    global _known
    cut = [Counter(WORD.findall(t.lower())) if t else Counter() for t in texts]
    name, rows, table = _known
    fresh = list(set().union(*cut) - rows.keys()) if name == model.name else list(set().union(*cut))
    if name != model.name or len(rows) + len(fresh) > REMEMBERED:
        fresh = list(set().union(*cut))
        rows, table = {}, np.zeros((0, len(model.languages)))
    if fresh:
        rows.update(zip(fresh, range(len(rows), len(rows) + len(fresh)), strict=True))
        table = np.concatenate([table, *(model.code_lengths([w.encode() for w in fresh[i : i + 50_000]]) for i in range(0, len(fresh), 50_000))])
    _known = (model.name, rows, table)
    bits = np.zeros((len(texts), len(model.languages)))
    for i, words in enumerate(cut):
        if words:
            at = np.fromiter(map(rows.__getitem__, words), np.int64, len(words))
            bits[i] = np.fromiter(words.values(), float, len(words)) @ table[at]
    return bits, [any(c.isalpha() for w in words for c in w) for words in cut]


def predict(documents: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, lang_pred, score and bits (code length by language) of every row."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        m = shared.value
        bits, letters = lengths_of(batch.column(1).to_pylist(), m)
        langs, scores, lengths = [], [], []
        for row, ok in zip(bits, letters, strict=True):
            best = int(row.argmin()) if ok and m.languages else -1
            langs.append(m.languages[best] if best >= 0 else UNKNOWN)
            scores.append(float(1 / np.exp2(np.maximum(row[best] - row, -1000)).sum()) if best >= 0 else 0.0)
            lengths.append(list(zip(m.languages, row.tolist(), strict=True)) if best >= 0 else None)
        arrays = [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(lengths, pa.map_(pa.string(), pa.float64()))]
        return pa.RecordBatch.from_arrays(arrays, [key, "lang_pred", "score", "bits"])

    schema = f"{key} {dict(documents.dtypes)[key]}, lang_pred string, score double, bits map<string,double>"
    return map_texts(documents.select(key, text), work, schema, text)
