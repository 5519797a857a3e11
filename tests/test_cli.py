"""Commands on small files."""

import json

import pytest

from glossmill.__main__ import main


def lines(spark, path):
    return [json.loads(r.value) for r in spark.read.text(str(path)).collect()]


def test_mine_merge_bucket(spark, tmp_path, capsys):
    (tmp_path / "c.txt").write_text("♥".join(["customs duty applies here. other words"] * 4), encoding="utf-8")
    (tmp_path / "lex.tsv").write_text("# w\napplies\nhere\nother\nwords\n")
    main(["mine", "--input", str(tmp_path / "c.txt"), "--lexicon", str(tmp_path / "lex.tsv"), "--output", str(tmp_path / "m"), "--min-pmi", "0", "--max-ngram", "2"])
    got = {r["phrase"]: r for r in lines(spark, tmp_path / "m")}
    assert set(got) == {"customs duty", "duty applies"}
    assert (got["customs duty"]["frequency"], got["customs duty"]["doc_count"], got["customs duty"]["assoc_metric"]) == (4, 4, "log_likelihood")
    main(["merge", "--area", f"law:{tmp_path / 'm'}", "--area", f"origin:{tmp_path / 'm'}", "--output", str(tmp_path / "merged")])
    merged = lines(spark, tmp_path / "merged")
    assert {r["area_signature"] for r in merged} == {"F000F00"} and all(r["total_doc_count"] == 8 for r in merged)
    main(["bucket", "--input", str(tmp_path / "merged"), "--output", str(tmp_path / "b")])
    assert "bucket 3: 2" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        main(["merge", "--area", "nowhere:x", "--output", "y"])


def test_coverage(spark, tmp_path, capsys):
    (tmp_path / "root" / "expert").mkdir(parents=True)
    (tmp_path / "root" / "expert" / "a.txt").write_text("The customs duty.")
    (tmp_path / "lex.tsv").write_text("the\t1\n")
    (tmp_path / "p.tsv").write_text("customs duty\n")
    main(["coverage", "--corpus", str(tmp_path / "root"), "--lexicon", str(tmp_path / "lex.tsv"), "--phrases", str(tmp_path / "p.tsv"), "--output", str(tmp_path / "o")])
    row = spark.read.option("header", True).csv(str(tmp_path / "o")).first()
    assert (row.t1, row.t4, row.total, row.band) == ("1", "1", "2", "specialist")
    assert "expert" in capsys.readouterr().out


def test_statute_and_conflicts(spark, tmp_path, capsys):
    (tmp_path / "law.txt").write_text("Article 2. X\n1. Goods – things.\n", encoding="utf-8")
    main(["statute", "--input", str(tmp_path / "law.txt"), "--article", "2", "--output", str(tmp_path / "s")])
    assert lines(spark, tmp_path / "s")[0]["term_raw"] == "Goods"
    (tmp_path / "e.jsonl").write_text('{"id": 1, "lang": "en", "phrase": "goods", "definition": "a"}\n{"id": 2, "lang": "en", "phrase": "goods", "definition": "b"}\n')
    main(["conflicts", "--input", str(tmp_path / "e.jsonl")])
    assert "A: a | B: b" in capsys.readouterr().out
