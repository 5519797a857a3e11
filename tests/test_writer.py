"""Upserts, review states and the sources around them on stated values."""

import json

import pytest

from glossmill.__main__ import main
from glossmill.operators import review, writer
from glossmill.sources import files

STAT = "ord long, phrase string, lang string, source_file string, frequency long, approved string"
ATT = "array<struct<area:string,doc_count:long,frequency:long,source_file:string>>"


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda r: [(x is not None, x) for x in r])


def test_statistical_records_open_and_join_concepts(spark):
    first = spark.createDataFrame([(1, "Customs Duty", "en", "a", 4, "true"), (2, "customs duty", "en", "b", 5, "true"), (3, "customs duty", "lt", None, 1, "true"), (4, None, "en", "c", 1, "true"), (5, "origin", "en", "c", 1, "rejected"), (6, "value", "en", "c", 1, None)], STAT)
    held = writer.upsert_statistical(writer.empty_store(spark), first.where(writer.approved()), "d")
    assert rows(held.concepts, "id", "scope", "status", "promotable", "first_seen_source", "area_signature") == [(1, "domain", "established", True, "a", None), (2, "document_specific", "emerging", False, "", None)]
    assert rows(held.phrases, "id", "phrase", "phrase_normalized", "phrase_base") == [(1, "Customs Duty", "customs duty", "customs"), (2, "customs duty", "customs duty", "customs")]
    assert rows(held.occurrences, "id", "source_doc", "clause_ref") == [(1, "a", "statistical_pmi_freq4"), (1, "b", "statistical_pmi_freq5"), (2, "", "statistical_pmi_freq1")]
    again = writer.upsert_statistical(held, spark.createDataFrame([(1, "CUSTOMS DUTY", "en", "c", 1, "true"), (2, "new one", "en", "a", 1, "true")], STAT), "d")
    assert rows(again.concepts, "id", "status") == [(1, "crystallized"), (2, "emerging"), (3, "emerging")]
    assert again.occurrences.count() == 5


def test_merged_records_keep_the_first_attestation_and_renew_signatures(spark):
    schema = f"ord long, phrase_normalized string, phrase_inflected string, lang string, approved string, attestation {ATT}"
    merged = [
        (1, "duty rate", "duty rates", "en", "true", [("law", 4, 9, "x"), ("origin", 2, 3, "y"), ("", 7, 7, "z"), (None, 7, 7, "z")]),
        (2, "duty rate", None, "en", "true", [("law", 40, 90, "x"), ("origin", 2, 3, None), ("origin", 2, 3, None)]),
        (3, "bare term", None, "en", "true", []),
        (4, "no list", None, "en", "true", None),
        (5, "not yet", None, "en", None, [("law", 1, 1, "x")]),
    ]
    statistical = spark.createDataFrame([(1, "Duty Rate", "en", "w", 2, "true")], STAT)
    held = writer.write_batch(writer.empty_store(spark), spark.createDataFrame(merged, schema), statistical, "d")
    assert rows(held.concepts, "id", "status", "first_seen_source", "area_signature") == [(1, "crystallized", "x", "A000F00"), (2, "emerging", "", "0000000"), (3, "emerging", "", "0000000")]
    assert rows(held.attestation, "id", "area", "doc_count", "source_file") == [(1, "law", 4, "x"), (1, "origin", 2, None), (1, "origin", 2, None), (1, "origin", 2, "y")]
    assert rows(held.phrases, "id", "phrase") == [(1, "duty rates"), (2, "bare term"), (3, "no list")]
    assert ("", "area:? freq7") not in rows(held.occurrences, "source_doc", "clause_ref") and ("z", "area:? freq7") in rows(held.occurrences, "source_doc", "clause_ref")


def test_empty_batch_leaves_the_store(spark):
    held = writer.upsert_statistical(writer.empty_store(spark), spark.createDataFrame([], STAT), "d")
    assert [x.count() for x in (held.concepts, held.phrases, held.occurrences, held.attestation)] == [0, 0, 0, 0]


def test_review(spark):
    found = spark.createDataFrame([(1, "A B", None, "true"), (2, "A B", "", "rejected"), (3, "x", "c d", None), (4, None, None, "no")], "i long, phrase string, phrase_normalized string, approved string")
    names = spark.createDataFrame([("a b", None), ("q", "c d")], "phrase string, phrase_normalized string")
    assert rows(review.name_overlap(found, names), "i") == [(1,), (2,), (3,)]
    labels = spark.createDataFrame([("c d", "tax")], "phrase string, domain string")
    assert rows(review.domain_matches(found, labels), "i", "other_domain") == [(3, "tax")]
    assert rows(review.state_counts(found, []), "total", "approved", "pending") == [(4, 1, 2)]
    with pytest.raises(ValueError, match="approved"):
        review.require_approved(found.where("i > 1"))
    assert review.require_approved(found).count() == 4
    some = spark.createDataFrame([("s", 1, 2.0), ("s", 2, 3.0), ("s", 3, 3.0), ("s", 4, None)], "g string, o long, v double")
    assert rows(review.control_row(some, "v", "o", ["g"]), "o", "v") == [(2, 3.0)]


def test_files_around_the_store(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"x": 1}\n\n  \n{"x": 2}\n')
    files.combine_jsonl(spark, [str(tmp_path / "a.jsonl"), str(tmp_path / "none.jsonl")], str(tmp_path / "all"))
    assert rows(spark.read.text(str(tmp_path / "all")), "value") == [('{"x": 1}',), ('{"x": 2}',)]
    files.combine_jsonl(spark, [str(tmp_path / "none.jsonl")], str(tmp_path / "nothing"))
    (tmp_path / "e.jsonl").write_text("\n".join(json.dumps(r) for r in [{"v1_id": 1, "eo_word": "a", "approved": True}, {"v1_id": 1, "eo_word": "b", "approved": True}, {"v1_id": 2, "eo_word": "", "approved": True}, {"v1_id": 3, "eo_word": "c", "approved": False}]))
    assert rows(files.enrichments(spark, str(tmp_path / "e.jsonl")), "v1_id", "eo_word") == [(1, "b")]
    assert files.enrichments(spark, str(tmp_path / "none.jsonl")).count() == 0
    for name in ("tax.db", "law.db", "u_statistical_candidates.jsonl", "u_ne_candidates.jsonl", "u_mwe_en.jsonl"):
        (tmp_path / name).write_text("")
    assert list(files.stores(spark, str(tmp_path))) == ["law", "tax"]
    assert files.named_entities(spark, str(tmp_path / "u_statistical_candidates.jsonl")).endswith("u_ne_candidates.jsonl")
    assert files.named_entities(spark, str(tmp_path / "u_mwe_en.jsonl")) is None


def test_write_and_quality_commands(spark, tmp_path, capsys):
    candidates = [{"phrase": "customs duty", "lang": "en", "source_file": "a", "frequency": 6, "pmi": 16.0, "approved": True}, {"phrase": "other", "lang": "en", "frequency": 1, "pmi": 1.0, "approved": None}]
    (tmp_path / "u_mwe.jsonl").write_text("\n".join(map(json.dumps, candidates)))
    (tmp_path / "u_ne.jsonl").write_text(json.dumps({"phrase": "Other"}))
    main(["quality", "--input", str(tmp_path / "u_mwe.jsonl")])
    assert capsys.readouterr().out.splitlines()[-3:] == ["high: 1 (1 approved, 0 pending)", "low: 1 (0 approved, 1 pending)", "named entities: 1"]
    main(["write", "--input", str(tmp_path / "u_mwe.jsonl"), "--domain", "d", "--output", str(tmp_path / "s1")])
    assert "concepts: 1, new: 1" in capsys.readouterr().out
    main(["write", "--input", str(tmp_path / "u_mwe.jsonl"), "--domain", "d", "--store", str(tmp_path / "s1"), "--output", str(tmp_path / "s2")])
    assert "concepts: 1, new: 0" in capsys.readouterr().out
    (tmp_path / "none.jsonl").write_text(json.dumps(candidates[1]))
    with pytest.raises(ValueError, match="approved"):
        main(["write", "--input", str(tmp_path / "none.jsonl"), "--domain", "d", "--output", str(tmp_path / "s3")])


def test_overrides_hold_on_write(spark):
    overrides = spark.createDataFrame([("en", "custom duty", "Customs Duty", "customs duty"), ("lt", "x y", "z", "z")], "lang string, phrase_normalized string, new_phrase string, new_normalized string")
    first = spark.createDataFrame([(1, "Customs Duty", "en", "a", 4, "true"), (2, "custom duty", "en", "b", 5, "true"), (3, "x y", "en", "c", 1, "true"), (4, "x y", "lt", "c", 1, "true")], STAT)
    held = writer.upsert_statistical(writer.empty_store(spark), first, "d", overrides)
    assert rows(held.phrases, "lang", "phrase", "phrase_normalized") == [("en", "Customs Duty", "customs duty"), ("en", "x y", "x y"), ("lt", "z", "z")]
    assert rows(held.concepts, "id", "status")[0] == (1, "established")
    merged = spark.createDataFrame([(1, "custom duty", None, "en", "true", [("law", 4, 9, "x")])], f"ord long, phrase_normalized string, phrase_inflected string, lang string, approved string, attestation {ATT}")
    after = writer.write_batch(held, merged, first.limit(0), "d", overrides)
    assert after.concepts.count() == 3 and rows(after.attestation, "id", "area") == [(1, "law")]


def test_seeds_pass_all_filters_and_the_guard(spark):
    from glossmill.operators import lexicon

    pool = spark.createDataFrame([(f"w{chr(97 + i // 26)}{chr(97 + i % 26)}k", 9) for i in range(30)] + [("anti", 9), ("cargo", 9), ("litre", 9), ("london", 9), ("rare", 1)], "token string, n long")
    none = spark.createDataFrame([], "word string")
    stops = spark.createDataFrame([("Cargo", "domain"), ("litre", "noise")], "word string, reason string")
    found = lexicon.seed_reasons(pool, none, none, names=spark.createDataFrame([("london",)], "word string"), stops=stops)
    reasons = {r.token: r.reason for r in found.collect()}
    assert [reasons[x] for x in ("anti", "cargo", "litre", "london", "rare", "waak")] == ["fragment", "manual_domain", "manual_noise", "name", "frequency", "kept"]
    existing = spark.createDataFrame([("WAAK", "en"), ("wabk", "lt")], "word string, lang string")
    new = lexicon.seeds(existing, found, "en", "pool")
    assert new.count() == 29 and rows(new.where("word = 'wabk'"), "pos", "tier", "lang") == [("PHRASE", 3, "en")]
    with pytest.raises(ValueError):
        lexicon.seeds(existing, found.where("token < 'wab'"), "en", "pool")
