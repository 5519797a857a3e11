"""Scans of SQLite stores, and what goes to SQLite."""

import sqlite3

from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNotNull, StringContains

from glossmill.operators import coverage, tokens
from glossmill.sources import sqlite, stores


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def made(path, tables):
    with sqlite3.connect(path) as db:
        for name, (columns, data) in tables.items():
            db.execute(f"create table {name} ({columns})")
            db.executemany(f"insert into {name} values ({', '.join('?' * (columns.count(',') + 1))})", data)
    return str(path)


def test_filters_and_columns_go_to_sqlite(spark, tmp_path):
    path = made(tmp_path / "a.db", {"t": ("k integer, s text, v real, n text", [(i, f"s{i % 3}", i / 2, None if i % 4 else "x") for i in range(40)])})
    assert sqlite.condition(EqualTo(("s",), "a")) == ('"s" = ?', ["a"]) and sqlite.condition(In(("k",), (1, 2))) == ('"k" in (?, ?)', [1, 2])
    assert sqlite.condition(IsNotNull(("n",))) == ('"n" is not null', []) and sqlite.condition(StringContains(("s",), "a")) is None and sqlite.condition(GreaterThan(("a", "b"), 1)) is None
    some = sqlite.read(spark, path, "t", ["k", "s", "n"])
    assert some.columns == ["k", "s", "n"]
    assert rows(some.where("s = 's1' and k > 10 and n is not null and k in (16, 28, 4)").select("k")) == [(16,), (28,)]
    assert rows(some.where("s like '%2' and n is null and k < 6").select("k")) == [(2,), (5,)]
    reader = sqlite.SqliteReader(some.schema, {"path": path, "dbtable": "t", "numpartitions": 3})
    assert list(reader.pushFilters([EqualTo(("s",), "s1"), StringContains(("s",), "1")])) == [StringContains(("s",), "1")]
    assert sum(len(list(reader.read(p))) for p in reader.partitions()) == 13


def test_tiers_phrases_inflections_and_synonyms(spark, tmp_path):
    lexicon = made(tmp_path / "lex.db", {
        "concept_lang": ("concept_id integer, lang text, word text, pos text, tier integer, source text", [(1, "en", "The", "D", 1, "s"), (1, "en", "the", "D", 2, "s"), (2, "en", "rule", "N", 3, "s"), (3, "lt", "yra", "V", 1, "s"), (4, "en", "old", "A", 4, "s")]),
        "inflected_forms": ("id integer, lang text, inflected_word text, lemma text", [(1, "en", "Is", "be"), (2, "en", "is", "is"), (3, "en", "are", "x"), (4, "en", "are", "be"), (5, "lt", "yra", "būti")]),
    })
    schema = {"mwe_lang": "mwe_id integer, lang text, phrase text, phrase_normalized text, definition_raw text", "mwe_conflict": "mwe_id_a integer, mwe_id_b integer, conflict_type text"}
    one = made(tmp_path / "one.db", {"mwe_lang": (schema["mwe_lang"], [(1, "en", "Customs Duty", "customs duty", None), (2, "en", "Import Tax", "import tax", None), (2, "lt", "mokestis", "mokestis", None)]), "mwe_conflict": (schema["mwe_conflict"], [(1, 2, "synonym"), (2, 1, "text_divergence")])})
    two = made(tmp_path / "two.db", {"mwe_lang": (schema["mwe_lang"], [(7, "en", "Levy", "levy", None), (8, "en", "import tax", "import tax", None)]), "mwe_conflict": (schema["mwe_conflict"], [(7, 8, "synonym")])})
    assert rows(stores.tier_words(spark, lexicon, "en")) == [("rule", 3), ("the", 1)]
    assert rows(stores.phrases(spark, [one, two, str(tmp_path / "none.db")], "en")) == [("customs duty",), ("import tax",), ("levy",)]
    assert rows(stores.inflections(spark, lexicon, "en")) == [("are", "be"), ("is", "be")]
    assert rows(stores.synonyms(spark, [one, two], "en")) == [("import tax", "Levy")] and rows(stores.synonyms(spark, [one], "en")) == [("import tax", "Customs Duty")]
    assert rows(stores.tier_words(spark, str(tmp_path / "none.db"), "en")) == rows(stores.synonyms(spark, [], "en")) == []
    docs = spark.createDataFrame([(1, "The import taxes are the rule. Import tax!")], "doc_id int, text string")
    found = coverage.cascade(tokens.token_runs(docs), stores.phrases(spark, [one], "en"), stores.tier_words(spark, lexicon, "en"), stores.inflections(spark, lexicon, "en").unionByName(spark.createDataFrame([("are", "the")], "inflected string, lemma string")), stores.tier_words(spark, None, "lt"), ["doc_id", "sent_idx", "run_idx"])
    assert [(r.unit, r.category, r.step) for r in found.orderBy("sent_idx", "pos").collect()] == [("the", "TIER1", "word"), ("import", "UNKNOWN", None), ("taxes", "UNKNOWN", None), ("are", "TIER1", "inflection"), ("the", "TIER1", "word"), ("rule", "TIER3", "word"), ("import tax", "TIER4", "text")]


def test_a_flat_lexicon_moves(spark, tmp_path):
    old = made(tmp_path / "old.db", {"vocabulary": ("id integer, word text, pos text, tier integer, source text, eo_word text", [(1, "dog", "N", 1, "a", "hundo"), (2, "hound", "N", 2, "b", "hundo"), (3, "cat", "N", 1, "a", None)])})
    target = str(tmp_path / "new.db")
    stores.migrated(spark, old, target)
    assert rows(stores.tier_words(spark, target, "en")) == [("cat", 1), ("dog", 1), ("hound", 2)]
    assert rows(sqlite.read(spark, target, "concepts").select("concept_id", "eo_status").orderBy("concept_id")) == [(1, "complete"), (3, "pending")]


def test_row_of_a_file(spark):
    files = spark.createDataFrame([("a.txt", "s", "The customs duty applies. Nothing; customs duty, rule rule! ... Zed rule."), ("b.txt", "s", None)], "filename string, stratum string, text string")
    phrases, lex = spark.createDataFrame([("customs duty",)], "phrase string"), spark.createDataFrame([("the", 1), ("rule", 3)], "word string, tier int")
    got = {r.filename: r.asDict() for r in coverage.file_rows(files, phrases, lex).collect()}
    assert list(got["a.txt"]) == coverage.FILE_ROW and len(coverage.FILE_ROW) == 19
    a = got["a.txt"]
    assert (a["total_tokens"], a["t1_count"], a["t3_count"], a["t4_count"], a["unknown_count"], a["n_sentences"]) == (9, 1, 3, 2, 3, 4)
    assert (a["distinct_t4"], a["cooccur_pairs"], a["t3_anchor_rate"], a["unknown_tokens"]) == (1, 0, round(2 / 3, 4), '["applies","nothing","zed"]')
    assert (got["b.txt"]["total_tokens"], got["b.txt"]["n_sentences"], got["b.txt"]["t3_anchor_rate"], got["b.txt"]["unknown_tokens"]) == (0, 0, None, "[]")
    assert coverage.file_rows(files.where(F.lit(False)), phrases, lex).count() == 0
