"""Ingestion in stages: what runs, what is skipped, where it waits, and what the store holds then."""

import json

from glossmill import flows
from glossmill.__main__ import main
from glossmill.sources import snapshots
from glossmill.sources.markup import DEMO


def approve(folder, target):
    """A reviewer's file: all records that the stage has found, approved."""
    records = [json.loads(x) for p in sorted((folder / "definitions").glob("part-*")) for x in p.read_text().splitlines()]
    target.write_text("".join(json.dumps({**r, "approved": "true"}) + "\n" for r in records))
    return records


def test_markup_flow_resumes_behind_the_gate(spark, tmp_path):
    (tmp_path / "page.html").write_text(DEMO)
    ok = tmp_path / "ok.jsonl"
    flow = lambda **more: flows.markup_flow(str(tmp_path / "work"), input=str(tmp_path / "page.html"), lang="en", celex="32020R0001", domain="d", reviewed=str(ok), **more)
    assert flows.run(spark, flow()) == [("definitions", "waiting"), ("written", "not reached")]
    records = approve(tmp_path / "work", ok)
    assert {r["phrase"] for r in records} == {"goods", "carrier"}
    assert flows.run(spark, flow()) == [("definitions", "skipped"), ("written", "done")]
    assert flows.run(spark, flow()) == [("definitions", "skipped"), ("written", "skipped")]
    held = snapshots.read(spark, str(tmp_path / "work" / "store"), flows.STORE)
    assert sorted((r.phrase, r.lang) for r in held["rows"].collect()) == [("carrier", "en"), ("goods", "en")]
    assert held["concepts"].count() == 2 and snapshots.numbers(spark, str(tmp_path / "work" / "store")) == [1]
    # Another review is another input: the last stage runs again, on a new snapshot; the old one stays.
    ok.write_text(ok.read_text() + json.dumps({**records[0], "ord": 99, "approved": "true", "definition": "another", "clause": "9"}) + "\n")
    assert flows.run(spark, flow()) == [("definitions", "skipped"), ("written", "done")]
    assert snapshots.numbers(spark, str(tmp_path / "work" / "store")) == [1, 2]
    assert flows.run(spark, flow(article="7"))[0] == ("definitions", "waiting" if not ok.exists() else "done")


def test_half_a_snapshot_is_never_read(spark, tmp_path):
    folder = str(tmp_path / "held")
    snapshots.commit(spark, folder, {"t": spark.range(3)})
    (tmp_path / "held" / "snapshot-2" / "t").mkdir(parents=True)  # left by a lost driver
    assert snapshots.current(spark, folder).endswith("snapshot-1")
    last = snapshots.read(spark, folder, ["t"])["t"]
    snapshots.commit(spark, folder, {"t": last.unionByName(spark.range(3, 5))})
    assert snapshots.numbers(spark, folder) == [1, 3] and snapshots.read(spark, folder, ["t"])["t"].count() == 5
    assert snapshots.read(spark, str(tmp_path / "none"), ["t"]) is None


def test_groups_follow_their_clauses(spark):
    rows = [(1, "10", "en", "a", "x", "s", "true"), (2, "2", "en", "b", "y", "s", "true"), (3, "2", "lt", "c", "z", "s", "true"), (4, "x", "en", "d", "w", "s", "true"), (5, "1", "en", "e", "v", "s", "false")]
    got = flows.groups_of(spark.createDataFrame(rows, flows.FIELDS)).orderBy("g", "r").collect()
    assert [r.phrase for r in got] == ["b", "c", "a", "d"] and got[0].g == got[1].g


def test_ingest_command(spark, tmp_path, capsys):
    (tmp_path / "page.html").write_text(DEMO)
    args = ["ingest", "--source", "markup", "--input", str(tmp_path / "page.html"), "--folder", str(tmp_path / "w"), "--lang", "en", "--domain", "d"]
    main(args)
    assert "definitions: waiting" in capsys.readouterr().out
    approve(tmp_path / "w", tmp_path / "ok.jsonl")
    main([*args, "--reviewed", str(tmp_path / "ok.jsonl")])
    assert "written: done" in capsys.readouterr().out


def test_document_flow(spark, tmp_path):
    from tests.test_sources import _docx

    (tmp_path / "in").mkdir()
    _docx(tmp_path / "in" / "a.docx", [("Heading1", [("Article 2. Definitions", False, False)]), ("", [("1. Goods", True, False), (" – any thing.", False, False)]), ("", [("2. Carrier", True, False), (" – who carries.", False, False)])])
    flow = lambda **more: flows.document_flow(str(tmp_path / "w"), input=str(tmp_path / "in"), lang="en", domain="d", reviewed=str(tmp_path / "ok.jsonl"), **more)
    assert flows.run(spark, flow()) == [("corpus", "done"), ("definitions", "waiting"), ("written", "not reached")]
    assert {r["phrase"] for r in approve(tmp_path / "w", tmp_path / "ok.jsonl")} == {"goods", "carrier"}
    assert flows.run(spark, flow()) == [("corpus", "skipped"), ("definitions", "skipped"), ("written", "done")]
    assert snapshots.read(spark, str(tmp_path / "w" / "store"), flows.STORE)["rows"].count() == 2
