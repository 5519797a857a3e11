"""Toxicity by maximum-scoring segments of token log-odds.

Training takes a sample of labelled rows of bounded expected size. For every token, and for every opening of
PREFIX letters of a longer token, it counts the toxic and the clean texts that use it (a text counts once,
as words come in bursts); the log-odds between the two carry a Dirichlet prior, part flat and part drawn from
the pooled counts, and all those several standard deviations from zero are kept; there are no more than the
sample's texts have words. A text is then a sequence of scores: a token's log-odds
less a constant drift. A linear-time scan finds every maximal scoring segment. Extreme-value theory gives
each segment its expected number under clean text, K n exp(-lambda S); the evidence of the significant ones is
added up, and a logistic curve fitted on the sample maps the logarithm of that sum to a score from 0 to 1.

Defined cases: null and empty texts, and texts without a known token, have no segment and get the curve's
value at zero; a sample without both classes gives every row its prior rate; repeated rows score alike;
labels that are null or belong to no row are ignored; extra columns are ignored; an empty table gives an
empty result. Nothing but the text enters a score.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossmill.llm.common import map_texts, stored

#: Bound of the fit: expected rows of the sample.
TRAIN_ROWS = 20_000
#: A token longer than PREFIX letters backs off to its opening, kept under the key opening + "*".
PREFIX = 5
#: Prior (flat part, weight of the pooled share), least standard deviations of a kept token, range of a weight, drift.
FLAT, PRIOR, LEAST_Z, MOST_WEIGHT, DRIFT = 0.5, 2.0, 3.0, 6.0, 0.1
#: A segment counts if so few like it are expected in clean text.
LEAST_E = 0.1
TOXIC_AT = 0.7
WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    rate: float = 1.0  # lambda
    k: float = 1.0
    intercept: float = 0.0
    slope: float = 0.0


def maximal_segments(events: list[tuple[int, float]], drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """All maximal scoring segments, as (first, last, score), of a sequence that scores -drift except at events.

    events are (position, score) in order of position, scores already less the drift. Linear time: each
    candidate keeps the nearest earlier one with a lower left sum, and searches follow that chain.
    """
    found: list[tuple[int, int, float, float, int]] = []  # first, last, sum before, sum after, nearest lower
    total, at = 0.0, 0
    for position, score in events:
        before = total - drift * (position - at)
        total, at = before + score, position + 1
        if score <= 0:
            continue
        first, low, high = position, before, total
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= low:
                j = found[j][4]
            if j < 0 or found[j][3] >= high:
                found.append((first, position, low, high, j))
                break
            first, low = found[j][0], found[j][2]
            del found[j:]
    return [(a, b, high - low) for a, b, low, high, _ in found]


def events_of(text: str, weights: dict[str, float]) -> tuple[int, list[tuple[int, float]]]:
    """Number of tokens, and position and score of those that have a weight."""
    words, get, out = WORD.findall(text.lower()), weights.get, []
    for i, w in enumerate(words):
        s = get(w)
        if s is None and len(w) > PREFIX:
            s = get(w[:PREFIX] + "*")
        if s is not None:
            out.append((i, s - DRIFT))
    return len(words), out


def evidence(n: int, segments: list[tuple[int, int, float]], model: Model) -> float:
    """ln(1 + the sum over significant segments of lambda S - ln(K n))."""
    size = np.log(max(model.k * max(n, 1), 1e-12))
    each = [model.rate * s - size for _, _, s in segments]
    return float(np.log1p(sum(e for e in each if e > 0 and np.exp(-e) <= LEAST_E)))


def held_out(key: Column) -> Column:
    return F.pmod(F.crc32(key.cast("string")), F.lit(3)) == 1


def sample(documents: DataFrame, labels: DataFrame, key: str, text: str, label: str, rows: int) -> DataFrame:
    """text and y of labelled rows that are not held out; hashing keeps about `rows` of them at any size."""
    usable = labels.where(F.col(label).isNotNull() & ~held_out(F.col(key))).select(key, F.col(label).cast("int").alias("y"))
    share = min(1.0, rows / max(usable.count(), 1))
    chosen = usable.where(F.pmod(F.xxhash64(F.lit(7), key), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)))).groupBy(key).agg(F.max("y").alias("y"))
    return stored(documents.select(key, text).join(chosen, key).select(F.col(text).alias("text"), "y"), "toxicity-sample")


def token_counts(rows: DataFrame) -> DataFrame:
    """token, toxic and clean texts that use it, and its uses in clean texts; counted within tasks, then over all.

    The token "" counts all texts and all uses.
    """
    from collections import Counter

    def work(batches):
        texts, uses = (Counter(), Counter()), Counter()
        for batch in batches:
            for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = WORD.findall((t or "").lower())
                seen = set(words)
                texts[y].update(seen)
                texts[y].update({w[:PREFIX] + "*" for w in seen if len(w) > PREFIX})
                texts[y][""] += 1
                if not y:
                    uses.update(words)
                    uses[""] += len(words)
        tokens = list(texts[0].keys() | texts[1].keys())
        for at in range(0, len(tokens), 50_000):
            some = tokens[at : at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(some), *(pa.array([c[w] for w in some], pa.int64()) for c in (texts[1], texts[0], uses))], ["token", "toxic", "clean", "uses"])

    parts = rows.select("text", F.when(F.col("y") > 0, 1).otherwise(0).alias("y")).mapInArrow(work, "token string, toxic long, clean long, uses long")
    return parts.groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.sum("uses").alias("uses"))


def log_odds(counts: DataFrame) -> tuple[dict[str, float], list[tuple[float, float]]]:
    """Weights of the kept tokens, and pairs (chance in clean text, score) for extreme-value theory."""
    counts = counts.persist()
    try:
        whole = counts.where("token = ''").first()
        if whole is None or not whole["toxic"] or not whole["clean"]:
            return {}, []
        nt, nc, used = whole["toxic"], whole["clean"], max(whole["uses"], 1)
        prior = FLAT + PRIOR * (F.col("toxic") + F.col("clean")) / (nt + nc)
        side = lambda y, n: (F.col(y) + prior) / (n - F.col(y) + FLAT + PRIOR)
        odds = counts.where("token <> ''").select("token", "uses", (F.log(side("toxic", nt)) - F.log(side("clean", nc))).alias("d"), F.sqrt(1 / (F.col("toxic") + prior) + 1 / (F.col("clean") + prior)).alias("sd"))
        kept = odds.where(F.abs("d") >= LEAST_Z * F.col("sd")).orderBy("token").collect()
    finally:
        counts.unpersist()
    weights = {r["token"]: float(np.clip(r["d"], -MOST_WEIGHT, MOST_WEIGHT)) for r in kept}
    chances = [((r["uses"] + FLAT) / used, weights[r["token"]] - DRIFT) for r in kept if not r["token"].endswith("*")]
    return weights, chances


def karlin_rate(chances: list[tuple[float, float]]) -> float:
    """The positive root of E exp(lambda score) = 1 under clean text; mass beyond the kept tokens scores -drift."""
    p, s = (np.array(x, float) for x in zip(*(chances or [(0.0, 0.0)]), strict=True))
    rest = max(0.0, 1 - p.sum())
    excess = lambda x: float((p * np.exp(x * s)).sum() + rest * np.exp(-x * DRIFT) - 1)
    if not (s > 0).any() or float((p * s).sum() - rest * DRIFT) >= 0:
        return 1.0
    high = 1e-3
    while excess(high) <= 0 and high < 64:
        high *= 2
    low = high / 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) <= 0 else (low, mid)
    return min(low, 64.0)


def _logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Weighted logistic fit with a slight ridge on the slope."""
    a, b = 0.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a + b * x, -30, 30)))
        g = np.array([(n * (y - p)).sum() - 1e-3 * a, (n * (y - p) * x).sum() - 1e-2 * b])
        w = n * p * (1 - p)
        h = np.array([[w.sum() + 1e-3, (w * x).sum()], [(w * x).sum(), (w * x * x).sum() + 1e-2]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2 / max(np.abs(step).max(), 1e-9))
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(b)


def fit(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", rows: int = TRAIN_ROWS) -> Model:
    """Learns a model from a sample of about `rows` labelled rows that are not held out."""
    train = sample(documents, labels, key, text, label, rows)
    weights, chances = log_odds(token_counts(train))
    rate = karlin_rate(chances)

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        ns, best = [], []
        for t in batch.column(0).to_pylist():
            n, events = events_of(t or "", weights)
            ns.append(n)
            best.append(max((s for _, _, s in maximal_segments(events)), default=0.0))
        return pa.RecordBatch.from_arrays([pa.array(ns, pa.int64()), pa.array(best, pa.float64())], ["n", "s"])

    # Maximum likelihood of K for a Gumbel law with known rate, over clean texts.
    clean = map_texts(train.where("y <= 0").select("text"), scan, "n long, s double", "text")
    seen = clean.where("n > 0").agg(F.count("*").alias("m"), F.sum(F.col("n") * F.exp(-rate * F.col("s"))).alias("mass")).first()
    k = seen["m"] / seen["mass"] if seen["m"] and seen["mass"] else 1.0
    model = Model(weights, rate, k)

    def weigh(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for t in batch.column(0).to_pylist():
            n, events = events_of(t or "", weights)
            out.append(round(evidence(n, maximal_segments(events), model), 2))
        return pa.RecordBatch.from_arrays([pa.array(out, pa.float64()), batch.column(1)], ["x", "y"])

    cells = map_texts(train.select("text", F.when(F.col("y") > 0, 1).otherwise(0).alias("y")), weigh, "x double, y int", "text").groupBy("x", "y").count().collect()
    if not cells:
        return Model(weights, rate, k, -3.0, 0.0)
    x, y, n = (np.array(c, float) for c in zip(*((r["x"], r["y"], r["count"]) for r in sorted(cells)), strict=True))
    return Model(weights, rate, k, *_logistic(x, y, n))


def score(documents: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, score, predicted, evidence and the passages (first and last token, score) of every row."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores, evidences, passages = [], [], []
        for t in batch.column(1).to_pylist():
            n, events = events_of(t or "", model.weights)
            segments = maximal_segments(events) if events else []
            e = evidence(n, segments, model)
            size = np.log(max(model.k * max(n, 1), 1e-12))
            passages.append([{"first": a, "last": b, "score": s} for a, b, s in segments if np.exp(size - model.rate * s) <= LEAST_E])
            evidences.append(e)
            scores.append(float(1 / (1 + np.exp(-np.clip(model.intercept + model.slope * e, -30, 30)))))
        kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64())]))
        arrays = [batch.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= TOXIC_AT) for s in scores], pa.int32()), pa.array(evidences, pa.float64()), pa.array(passages, kind)]
        return pa.RecordBatch.from_arrays(arrays, [key, "score", "predicted", "evidence", "passages"])

    schema = f"{key} {dict(documents.dtypes)[key]}, score double, predicted int, evidence double, passages array<struct<first:int,last:int,score:double>>"
    return map_texts(documents.select(key, text), work, schema, text)


def keep_clean(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of df, with all columns, that the model doesn't predict toxic."""
    at = df.columns.index(text)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        clean = []
        for t in batch.column(at).to_pylist():
            n, events = events_of(t or "", model.weights)
            e = evidence(n, maximal_segments(events), model) if events else 0.0
            clean.append(float(1 / (1 + np.exp(-np.clip(model.intercept + model.slope * e, -30, 30)))) < TOXIC_AT)
        return batch.filter(pa.array(clean, pa.bool_()))

    return map_texts(df, work, df.schema, text)
