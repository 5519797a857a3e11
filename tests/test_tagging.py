"""The tagger boundary and what is counted behind it."""

from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from glossmill.operators import tagging

ENTRIES = {"duties": ("duty", "NOUN"), "customs": ("customs", "NOUN"), "import": ("import", "VERB"), "2": ("2", "NUM")}


def docs(spark):
    data = [(2, "b", "Customs duties apply. The customs duties, again!"), (1, "a", "Import customs duties 22 times"), (3, "c", None), (4, "d", "")]
    return tagging.tagged(spark.createDataFrame(data, "doc_id long, source string, text string"), tagging.dictionary_tagger(ENTRIES, lambda word: (word, "ADJ")))


def test_tokens_cross_the_boundary(spark):
    found = {r.doc_id: r.sentences for r in docs(spark).collect()}
    assert [[t.text for t in s] for s in found[2]] == [["Customs", "duties", "apply", "."], ["The", "customs", "duties", ",", "again", "!"]]
    assert found[2][1][0].skip and found[2][0][1].lemma == "duty" and found[3] == found[4] == [[]]
    mined = docs(spark).where("doc_id = 2").select(F.transform("sentences", tagging.mined_tokens).alias("m")).first().m
    assert [[(t.text, t.lemma) for t in s] for s in mined] == [[("customs", "customs"), ("duties", "duty"), ("apply", "apply")], [("customs", "customs"), ("duties", "duty"), ("again", "again")]]
    with pytest.raises(ValueError):
        tagging.dictionary_tagger({str(i): ("a", "X") for i in range(tagging.MOST_ENTRIES + 1)}, str)


def test_first_occurrence_comes_with_the_count(spark):
    rows = {r.phrase: r for r in tagging.candidate_counts(docs(spark), "doc_id", "source", range(2, 4)).collect()}
    r = rows["customs duties"]
    assert (r.frequency, r.doc_count, r.pos_pattern, r.source_file, r.ngram_size) == (3, 2, "NOUN NOUN", "a", 2)
    assert rows["import customs duties"].pos_pattern == "VERB NOUN NOUN" and "apply customs" not in rows
    assert Counter(r.ngram_size for r in rows.values()) == {2: 5, 3: 4}


def test_lemmas_decide_membership(spark):
    words = tagging.lemma_counts(docs(spark), "doc_id")
    assert {r.word: (r.freq, r.lemma) for r in words.collect()}["duties"] == (3, "duty")
    counts = tagging.candidate_counts(docs(spark), "doc_id", "source", range(2, 3))
    common = spark.createDataFrame([("duty",), ("again",)], "word string")
    got = {r.phrase: (r.novel_components, r.common_components) for r in tagging.lexicon_components(counts, words, common).collect()}
    assert got["customs duties"] == (["customs"], ["duties"]) and "duties again" not in got and got["duties apply"] == (["apply"], ["duties"])


def test_any_function_is_a_tagger(spark):
    def shout(sentences):
        return [[(w, w.upper(), "X", False) for w in s.split()] for s in sentences]

    df = spark.createDataFrame([(1, "a b\n12\nlong enough line c")], "k int, text string")
    row = tagging.tagged(df, shout, noise=True).first()
    assert [[t.lemma for t in s] for s in row.sentences] == [["LONG", "ENOUGH", "LINE", "C"]] and row.k == 1


def test_candidates_are_counted_once_however_often_they_are_read(spark, monkeypatch):
    from glossmill.plans import mining

    plans, stored = {}, mining.settled

    def seen(df, what):
        plans[what] = df._jdf.queryExecution().optimizedPlan().toString()
        return stored(df, what)

    monkeypatch.setattr(mining, "settled", seen)
    mining.tagged_candidates(spark, "/root/testdata/sf0.001")
    assert plans["tagged-counts"].count("sentences") > 0
    assert "sentences" not in plans["tagged-candidates"]


def test_a_tagger_gets_slices_of_bounded_bytes(spark):
    """A batch of 10,000 long documents used to be tagged, and held as rows of tokens, at once."""
    def sizes(sentences):
        told = str(sum(len(s) for s in sentences))
        return [[(s[:1], told, "X", False)] for s in sentences]

    text = ("a" * 99 + ". ") * 4000
    df = spark.createDataFrame([(k, text) for k in range(6)], "k int, text string").coalesce(1)
    rows = tagging.tagged(df, sizes).select("k", F.size("sentences").alias("n"), F.explode(F.flatten("sentences")).alias("t")).select("k", "n", F.col("t.lemma").cast("int").alias("told")).collect()
    assert max(r.told for r in rows) <= tagging.SLICE_BYTES and {r.n for r in rows} == {4001}
    assert Counter(r.k for r in rows) == {k: 4001 for k in range(6)}
    one = tagging.tagged(spark.createDataFrame([(1, text * 4)], "k int, text string"), sizes).select(F.explode(F.flatten("sentences")).alias("t")).select(F.col("t.lemma").cast("int")).collect()
    assert len(one) == 16001 and max(r[0] for r in one) <= tagging.SLICE_BYTES


def _plain(rows, tagger, sizes, least, order):
    """frequency, documents, pattern and file by phrase and size, by a plain loop."""
    found = {}
    for row in sorted(rows, key=lambda r: order(r[0])):
        seen = set()
        for sentence in tagger([s for s in (row[2] or "").split("|")]):
            kept = [t for t in sentence if not t[3] and t[2] not in tagging.IDLE]
            for n in sizes:
                for i in range(len(kept) - n + 1):
                    at = (" ".join(t[0].lower() for t in kept[i : i + n]), n)
                    x = found.setdefault(at, [0, 0, " ".join(t[2] for t in kept[i : i + n]), row[1]])
                    x[0] += 1
                    x[1] += at not in seen
                    seen.add(at)
    return {k: tuple(v) for k, v in found.items() if v[0] >= least}


@pytest.mark.parametrize("kind", ["long", "string", "double"])
def test_least_frequency_loses_no_phrase(spark, kind):
    """Counts by slots let through all phrases that reach the least frequency, those whose words have blanks too; firsts follow the key's order."""
    import random

    draw = random.Random(7)
    words = ["a", "b b", "b", "C", "é", "", "d", "2", "stop", "x " * 3]

    def tagger(sentences):
        return [[(w, w, "NUM" if w == "2" else f"P{i % 3}", w == "stop") for i, w in enumerate(s.split("~"))] if s else [] for s in sentences]

    keys = draw.sample(range(-50, 50), 60)
    make = {"long": int, "string": lambda k: f"é{k}", "double": lambda k: k / 4}[kind]
    rows = [(make(k), f"f{k}", "|".join("~".join(draw.choices(words, k=draw.randrange(9))) for _ in range(draw.randrange(5)))) for k in keys] + [(None, "none", "a~b~a~b"), (make(99), "nul", None)]
    order = lambda k: (k is not None, k.encode() if isinstance(k, str) else k)
    docs = spark.createDataFrame([(k, f, (t or "").replace("|", ". ")) for k, f, t in rows], f"k {kind}, f string, text string").repartition(3)
    asked = lambda sentences: tagger([s[:-1] if s.endswith(".") else s for s in sentences])
    for made in (tagging.tagged(docs, asked), tagging.mined(docs, asked)):
        for least in (1, 3, 5):
            got = {(r.phrase, r.ngram_size): (r.frequency, r.doc_count, r.pos_pattern, r.source_file) for r in tagging.candidate_counts(made, "k", "f", range(2, 4), least).collect()}
            assert got == _plain(rows, tagger, range(2, 4), least, order) and got


def test_mined_keeps_what_tagged_words_are(spark):
    data = [(2, "b", "Customs duties apply. The customs duties, again!"), (1, "a", "Import customs Duties 22 times"), (3, "c", None), (4, "d", "")]
    df, tagger = spark.createDataFrame(data, "doc_id long, source string, text string"), tagging.dictionary_tagger(ENTRIES, lambda word: (word, "ADJ"))
    own = tagging.mined(df, tagger)
    rows = {r.doc_id: r for r in own.collect()}
    assert rows[2].words == ["customs", "duties", "apply", "customs", "duties", "again"] and rows[2].sentences == [0, 0, 0, 1, 1, 1]
    assert rows[2].lemmas == [None, "duty", None, None, "duty", None] and rows[3].words == rows[4].words == []
    both = [sorted(map(tuple, tagging.lemma_counts(x, "doc_id").collect())) for x in (own, tagging.tagged(df, tagger))]
    assert both[0] == both[1] and ("duties", 3, "duty") in both[0]


def test_documents_are_handed_over_in_small_batches(spark, monkeypatch):
    """Batches of 10,000 documents were held outside the heap of an executor and again in each of its workers."""
    from glossmill.plans import mining

    name, told, stored = "spark.sql.execution.arrow.maxRecordsPerBatch", {}, mining.settled
    before = spark.conf.get(name)
    monkeypatch.setattr(mining, "settled", lambda df, what: told.update({what: int(spark.conf.get(name))}) or stored(df, what))
    mining.tagged_candidates(spark, "/root/testdata/sf0.001")
    assert all(told[x] <= tagging.BATCH_ROWS for x in ("tagged", "lemmas", "tagged-counts")) and spark.conf.get(name) == before
    with tagging.small_batches(spark, 10):
        rows = spark.range(95, numPartitions=1).mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["id"]) for b in batches), "id long").collect()
    assert [r.id for r in rows] == [10] * 9 + [5]
