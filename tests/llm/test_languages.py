"""Byte context trees against a plain recursion, and predictions on held-out rows."""

import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from glossmill.llm import languages


def tree_model(words):
    """A model of one language from a list of words, by the library's own counting."""
    import numpy as np

    of, place, key = languages.word_grams([w.encode() for w in words])
    grams = []
    for k in range(languages.ORDER + 1):
        ok = place >= k - 1
        keys, counts = np.unique(key[ok] & np.uint64((1 << 8 * (k + 1)) - 1), return_counts=True)
        grams.append((keys, counts))
    return languages.Model(["x"], [languages.tree_of(grams)])


def plain_bits(word, words):
    """PPM with escape D / (N + D) and exclusions, from counts in dictionaries."""
    seen = defaultdict(Counter)
    for w in words:
        data = b" " + w.encode() + b" "
        for i in range(1, len(data)):
            for k in range(min(languages.ORDER, i) + 1):
                seen[data[i - k : i]][data[i]] += 1
    data, bits = b" " + word.encode() + b" ", []
    for i in range(1, len(data)):
        excluded, chance = set(), 1.0
        for k in range(min(languages.ORDER, i), -1, -1):
            left = {b: n for b, n in seen[data[i - k : i]].items() if b not in excluded}
            if not left:
                continue
            n, d = sum(left.values()), len(left)
            if data[i] in left:
                chance *= left[data[i]] / (n + d)
                break
            chance *= d / (n + d)
            excluded |= left.keys()
        else:
            chance /= 256 - len(excluded)
        bits.append(-math.log2(chance))
    return sum(bits)


def test_code_lengths_equal_the_plain_recursion():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcé") for _ in range(rng.randrange(1, 9)))
    words = [word() for _ in range(200)]
    model = tree_model(words)
    probe = [*words[:20], *(word() for _ in range(20)), "zzz", "abz", "ñandú", "a", "é" * 40]
    got = model.code_lengths([w.encode() for w in probe])[:, 0]
    assert all(abs(g - plain_bits(w, words)) < 1e-9 for g, w in zip(got, probe, strict=True))
    assert model.code_lengths([]).shape == (0, 1)


def test_the_chances_of_all_bytes_sum_to_one():
    import numpy as np

    model = tree_model(["abab", "abc", "bca", "cab", "aab"])
    for start in ("", "a", "ab", "abab", "zz", "cz"):
        head = start.encode()
        ends = [head + bytes([b]) for b in range(256)]
        of, place, key = languages.word_grams(ends)
        bits = languages._bits(model.trees[0], place, key)
        own = bits[np.array([np.flatnonzero((of == i) & (place == len(head)))[0] for i in range(256)])]
        assert abs(np.exp2(-own).sum() - 1) < 1e-9


DOCS = {"aa": ["lorem ipsum dolor sit amet", "dolor amet ipsum"], "bb": ["straße über köln größe", "über größe maß"], "cc": ["niño mañana españa año", "año niño piña"]}


def test_predictions(spark):
    rng = random.Random(6)
    rows = []
    for i in range(300):
        lang = rng.choice(sorted(DOCS))
        rows.append((i, " ".join(rng.choice(rng.choice(DOCS[lang]).split()) for _ in range(12)), lang if i % 17 else None, "s", 0.5))
    rows += [(1000, None, "aa", "s", 0.5), (1001, "", "aa", "s", 0.5), (1002, "12 + 3! ²", "aa", "s", 0.5), (1003, "ÜBER Größe", None, "s", 0.5), (1003, "ÜBER Größe", None, "s", 0.5), (None, "mañana", None, "s", 0.5), (1004, "lorem " * 200_000, None, "s", 0.5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score double")
    found = languages.predict(df, languages.fit(df))
    got = [(r.doc_id, r.lang_pred, r.score) for r in found.collect()]
    by_id = {i: (p, s) for i, p, s in got}
    assert len(got) == len(rows) and all(by_id[i] == ("und", 0.0) for i in (1000, 1001, 1002))
    assert by_id[1003][0] == "bb" and by_id[None][0] == "cc" and by_id[1004][0] == "aa" and all(0 <= s <= 1 for _, _, s in got)
    held = {r.doc_id for r in df.where(languages.held_out(F.col("doc_id"))).collect()}
    assert held == {i for i, *_ in rows if i is not None and zlib.crc32(str(i).encode()) % 5 == 0}
    right = [by_id[i][0] == lang for i, _, lang, *_ in rows if i in held and lang and i < 1000]
    assert sum(right) / len(right) >= 0.98
    assert [tuple(r) for r in languages.predict(df.limit(0), languages.fit(df)).collect()] == []
    blind = languages.fit(df.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in languages.predict(df, blind).collect()} == {"und"}


def test_held_out_rows_and_labels_teach_nothing(spark):
    rows = [(i, "alpha beta", "aa" if zlib.crc32(str(i).encode()) % 5 else "zz") for i in range(60)]
    model = languages.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["aa"]


def test_workers_tell_models_apart():
    first, second = tree_model(["aaa"] * 9), tree_model(["bbb"] * 9)
    a, b = languages.lengths_of(["aaa bbb"], first)[0], languages.lengths_of(["bbb"], second)[0]
    assert abs(a[0, 0] - plain_bits("aaa", ["aaa"] * 9) - plain_bits("bbb", ["aaa"] * 9)) < 1e-9
    assert abs(b[0, 0] - plain_bits("bbb", ["bbb"] * 9)) < 1e-9


@pytest.mark.parametrize("size", [400, 10_000_000])
def test_the_sample_is_bounded(spark, size):
    rows = [(i, "wörter " * 10, "aa") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    n = languages.sample(df, "doc_id", "text", "lang", size).count()
    assert n == 200 - sum(zlib.crc32(str(i).encode()) % 5 == 0 for i in range(200)) if size > 10_000 else 0 < n < 40
