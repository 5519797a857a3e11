"""The pipeline on a small corpus with planted cases, and registration."""

import random

import pandas as pd


def planted(tmp_path):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(3000)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    docs = [text(rng.randrange(60, 200)) + "\n" + text(40) for _ in range(200)]
    for i in range(0, 60, 3):
        parts = docs[i].split()
        for _ in range(6):
            parts[rng.randrange(len(parts))] = "vileword"
        docs[i] = " ".join(parts)
    passage = text(60)
    docs += [docs[100], docs[101].replace(" w1", " w2", 1), passage + " " + text(90), text(90) + " " + passage, "", None]
    n = len(docs)
    pd.DataFrame({"doc_id": range(n), "text": docs, "lang": "en", "source": [f"src{i % 3}" for i in range(n)], "n_chars": [len(t or "") for t in docs]}).to_parquet(tmp_path / "documents.parquet")
    pd.DataFrame({"doc_id": range(200), "quality": 1, "toxic": [int(i < 60 and i % 3 == 0) for i in range(200)]}).to_parquet(tmp_path / "labels.parquet")
    return docs, passage


def test_stages(spark, tmp_path):
    import corpus_pipeline as c
    from glossmill.llm import packing

    docs, passage = planted(tmp_path)
    now = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns, seen = now.columns, {}
    for name, stage in c.STAGES[:-1]:
        out = str(tmp_path / name.replace(" ", "_"))
        stage(spark, now, str(tmp_path)).write.parquet(out)
        now = spark.read.parquet(out)
        assert now.columns == columns
        seen[name] = {r.doc_id: r.text for r in now.collect()}
    toxic = {i for i in range(60) if i % 3 == 0}
    assert set(range(len(docs))) - set(seen["toxicity"]) == toxic
    assert set(seen["line dedup"]) == set(seen["toxicity"])
    gone = set(seen["line dedup"]) - set(seen["near dedup"])
    assert {200} <= gone | {i for i, t in seen["line dedup"].items() if not t} and not gone & set(range(60, 100))
    kept = [t or "" for t in seen["suffix dedup"].values()]
    assert sum(passage[:150] in t for t in kept) == 1
    rows = c.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in rows} == set(seen["suffix dedup"])
    encode = packing.encoder(packing.tokenizer_path())
    assert sum(r.length for r in rows) == sum(len(encode(t)) // 4 + 1 for t in kept)


def test_registration():
    import __spark_entry__ as e

    names = [n for n in e.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in e.queries() and set(e.oracle_sql()) <= set(e.queries())
