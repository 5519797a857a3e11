"""Alignment of two tokenizers against both libraries and a plain loop."""

import bisect
import random
from collections import Counter
from hashlib import sha256

import pytest

from glossmill.llm import alignment


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a_path, b_path = alignment.paths()
    a = Tokenizer.from_file(a_path)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=b_path)


def brute_groups(text, libraries):
    a, b = libraries
    letters = alignment.byte_letters()
    if not text:
        return []
    raw, found = (" " + text).encode(), a.encode(" " + text, add_special_tokens=False)
    ids = b.encode(text)
    ta = [bytes(letters[c] for c in t) for t in found.tokens]
    tb = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in ids for p in [b.id_to_piece(i)]]
    if b"".join(ta) != raw or b"".join(tb) != raw:
        return []
    ends = [[len(b"".join(side[: n + 1])) for n in range(len(side))] for side in (ta, tb)]
    out, i, j = [], 0, 0
    for e in sorted(set(ends[0]) & set(ends[1])):
        n, m = bisect.bisect(ends[0], e), bisect.bisect(ends[1], e)
        out.append((found.ids[i:n], ids[j:m]))
        i, j = n, m
    return out


def brute(texts, libraries):
    docs = [brute_groups(t, libraries) for t in texts]
    links = [[(x, y) for a, b in g for x in a for y in b] for g in docs]
    count = Counter(p for own in links for p in set(own))
    best = {}
    for (x, _), n in count.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for g, own in zip(docs, links, strict=True):
        spelt = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(own), sum(count[p] == best[p[0]] for p in own), sum(count[p] for p in own), sha256(spelt.encode()).hexdigest() if g else ""))
    return out


ODD = ["a▁b", "a b\n\n c  d \n", "\t x", "", None, " ", "\n", "x \t y\r\n z", "<|endoftext|> hi <s>", "日本語 emoji 😀   x", "é" * 50 + " é", "a\x00b \x00", "  a  b", " lead  ", "Don't stop, it's 3.14!", "word.", "word. Word.", "word,.;", "²., x²."]


def texts_of(seed):
    rng = random.Random(seed)
    parts = ["a", " ", "\n", "\t", "é", "▁", "x1", "'s", "\r", "  ", "日", "<s>", "the", " the", " cat", ",", ". ", "\n\n"]
    return ODD + ["".join(rng.choices(parts, k=rng.randrange(1, 25))) for _ in range(150)] + ["the cat sat on the mat. " * n for n in (1, 1, 40)]


@pytest.mark.parametrize(("remembered", "hot"), [(250_000, 65_536), (40, 3)])
def test_against_both_libraries(spark, monkeypatch, libraries, remembered, hot):
    monkeypatch.setattr(alignment, "REMEMBERED", remembered)
    monkeypatch.setattr(alignment, "HOT_SHARE", hot)
    texts = texts_of(remembered)
    df = spark.createDataFrame([(i % 50 if i else None, t, 1, "x") for i, t in enumerate(texts)], "doc_id long, text string, row int, groups string").repartition(3)
    got = Counter(tuple(r) for r in alignment.align(df).collect())
    assert got == Counter((i % 50 if i else None, *w) for i, w in enumerate(brute(texts, libraries)))


def test_query_over_a_table(spark, tmp_path, libraries):
    import __spark_entry__ as e

    texts = ["the cat sat", "the cat sat", "a cat, the dog", None, "unrelated wordforms here"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    rows = e.queries()["op11_alignment"](spark, str(tmp_path))
    assert rows.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert {r.doc_id: tuple(r)[1:] for r in rows.collect()} == dict(enumerate(brute(texts, libraries)))
    assert alignment.align(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_long_texts_and_long_groups(spark, libraries):
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(3000)), "a" * 30_000, "".join(rng.choices("日本語中文", k=400)), "=" * 700 + "x" * 700]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: tuple(r)[1:] for r in alignment.align(df).collect()} == dict(enumerate(brute(texts, libraries)))


def test_the_alignment_spells_the_text(spark, libraries):
    a, b = libraries
    row = alignment.grouped(spark.createDataFrame([(1, "Hello wide world, hello")], "doc_id long, text string"), spell=True).first()
    sides = [[int(x) for g in row.alignment.split(";") for x in g.split("|")[k].split(",")] for k in (0, 1)]
    assert sides == [a.encode(" Hello wide world, hello").ids, b.encode("Hello wide world, hello")]
    assert sum(row.frequencies) == row.n_groups and set(row.groups) == set(row.alignment.split(";"))
    assert sha256(row.alignment.encode()).hexdigest() == row.groups_sha256
