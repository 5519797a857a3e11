"""Sources and sinks on files of their own."""

import io
import json
import zipfile

from pyspark.sql import functions as F

from glossmill.sources import docx, files, glossary, markup, sqlite
from glossmill.sources.html import corpus_lines


def test_delimited_and_jsonl(spark, tmp_path):
    (tmp_path / "c.txt").write_text("head♥first doc♥  ♥second doc", encoding="utf-8")
    assert [(r.doc_idx, r.text) for r in files.documents(spark, str(tmp_path / "c.txt")).orderBy("doc_idx").collect()] == [(0, "head"), (1, "first doc"), (3, "second doc")]
    (tmp_path / "a.jsonl").write_text('# note\n\n{"phrase": "a b", "approved": true}\n{"phrase": "c d", "approved": "rejected"}\n', encoding="utf-8")
    got = files.jsonl(spark, str(tmp_path / "a.jsonl"), files.SEED, comments=True).collect()
    assert [(r.phrase, r.approved) for r in got] == [("a b", "true"), ("c d", "rejected")]
    out = str(tmp_path / "out")
    seed = spark.createDataFrame([("a", "en"), ("b", None)], "phrase string, lang string")
    files.write_jsonl(seed, out)
    files.append_jsonl(spark, spark.createDataFrame([("a", "en"), ("c", "en"), ("c", "en")], "phrase string, lang string"), out, "phrase string, lang string", ["phrase"])
    assert sorted(r.phrase for r in spark.read.schema("phrase string, lang string").json(out).collect()) == ["a", "b", "c", "c"]


def test_text_tree(spark, tmp_path):
    (tmp_path / "root" / "novice").mkdir(parents=True)
    (tmp_path / "root" / "top.txt").write_text("top")
    (tmp_path / "root" / "novice" / "a.txt").write_text("one\ntwo")
    assert [tuple(r) for r in files.text_tree(spark, str(tmp_path / "root")).collect()] == [("novice", "a.txt", "one\ntwo")]


def test_pool_and_buckets(spark, tmp_path):
    files.write_pool(spark.createDataFrame([("x", 2), ("y", 9)], "token string, n int"), str(tmp_path / "p"))
    assert [tuple(r) for r in files.pool(spark, str(tmp_path / "p")).orderBy(F.desc("n")).collect()] == [(9, "y"), (2, "x")]
    df = spark.createDataFrame([("a b", 1, 3, 0.5, 0.1, 2)], "phrase string, n_areas int, total_doc_count int, area_specificity double, ne_risk double, bucket int")
    files.write_buckets(df, str(tmp_path / "b"))
    lines = spark.read.text(str(tmp_path / "b")).orderBy(F.desc(F.col("value").startswith("#"))).collect()
    assert lines[0].value == "# a b | areas=1 docs=3 spec=0.50 ne=0.10"
    assert json.loads(lines[1].value)["phrase"] == "a b"


def test_html_lines(spark):
    page = "<html><head><title>A title that is long enough</title></head><body><p>This line is long enough.</p><script>var x = 'not a line of text';</script><p>short</p></body></html>"
    assert spark.createDataFrame([(page,)], "h string").select(corpus_lines(F.col("h")).alias("x")).first().x == ["This line is long enough."]


def test_markup(spark):
    pages = spark.createDataFrame([("02020R0001-20221212", "en", markup.DEMO), ("x", "en", ""), ("y", "en", None)], "celex_id string, lang string, html string")
    got = markup.definitions(pages).orderBy("list_path").collect()
    assert [(r.list_path, r.term, r.definition, r.marker, r.n_sub_items) for r in got] == [("1", "goods", "any thing that moves", "B", 0), ("2", "carrier", ":", "M1", 1)]
    fields = {r.clause_num: r for r in markup.writer_fields(markup.definitions(pages)).collect()}
    assert fields["2"].definition_raw == "(a) a person who carries"
    assert fields["1"].first_seen_date == "2022-12-12"
    assert markup.article_list(pages).first().definition_count == 2


def test_markup_tables():
    html = (
        '<div id="docHtml"><p class="title-division-1">I</p><p class="title-article-norm">5 straipsnis</p><p class="stitle-article-norm">Apibrėžtys</p><p class="modref"><a title="32013R0952">▼B</a></p>'
        '<table><tbody><tr><td><p class="dlist-term">1)</p></td><td><p class="dlist-definition">„prekės“ – daiktai;</p></td></tr></tbody></table>'
        '<table><tr><td class="dlist-term">2)</td><td><p class="normal">„aktai“ –</p><p class="norm">visuma:</p><div class="grid-container"><div class="grid-list-column-1"><span>(a)</span></div><div class="grid-list-column-2"><p class="norm">kodeksas;</p></div></div></td></tr></table></div>'
    )
    layout, found = markup.articles(html, "lt")
    assert layout == "tablelayout"
    assert [(r["list_path"], r["term"], r["definition"], len(r["sub_items"])) for r in found[0]["records"]] == [("1", "prekės", "daiktai", 0), ("2", "aktai", "visuma:", 1)]
    assert markup.definitions_article(found, "lt")["number"] == "5"


def _docx(path, paragraphs):
    run = lambda t, b, i: f"<w:r><w:rPr>{'<w:b/>' if b else ''}{'<w:i/>' if i else ''}</w:rPr><w:t xml:space='preserve'>{t}</w:t></w:r>"
    body = "".join(f"<w:p>{f'<w:pPr><w:pStyle w:val={chr(34)}{s}{chr(34)}/></w:pPr>' if s else ''}{''.join(run(*r) for r in rs)}</w:p>" for s, rs in paragraphs)
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body>{body}</w:body></w:document>')
    path.write_bytes(data.getvalue())


def test_docx(spark, tmp_path):
    _docx(tmp_path / "a.docx", [("Heading1", [("7 straipsnis. Sąvokos", False, False)]), ("", [("Prekė", True, False), (" – daiktas.", False, False)]), ("", [("Nr. XII-12, 2020-01-02", False, True)]), ("", [("13 (1) - Title text", True, False)]), ("", [("", False, False)])])
    corpus, amendments = docx.convert(docx.paragraphs(spark, str(tmp_path)))
    assert [r.line for r in corpus.orderBy("para_idx").collect()] == ["7 straipsnis. Sąvokos", "**Prekė** – daiktas.", "13 (1) - Title text"]
    assert [r.line for r in amendments.collect()] == ["7 | Nr. XII-12 | 2020-01-02"]


def test_glossary(spark):
    table = [("TERMS", "x", 2), ("ADVANCE RULINGS\n(Décision anticipée)", "A decision.\nNotes:\n1. First note\n2. See the WTO Agreement", 2), ("", "more text", 2), ("RESILIENCE", "Ability", 3), ("(Résilience)", "", 3), ("BROKEN\n(Cassé", "left", 3), ("en deux)", "right", 4)]
    rows = spark.createDataFrame([("g", i, *r) for i, r in enumerate(table)], "document string, row_no int, left string, right string, page int")
    got = glossary.entries(rows, "2024-06").orderBy("entry_no", "lang").collect()
    assert [(r.lang, r.term_original) for r in got][:4] == [("en", "ADVANCE RULINGS"), ("fr", "Décision anticipée"), ("en", "RESILIENCE"), ("fr", "Résilience")]
    assert got[0].definition == "A decision." and got[0].notes[0] == "First note"
    assert got[0].source_ref.entry_id == "advance-rulings"
    assert got[4].repair == "page_break"


def test_sqlite(spark, tmp_path):
    path = str(tmp_path / "a.db")
    df = spark.createDataFrame([(i, f"w{i}", None if i % 2 else 1.5) for i in range(25)], "id long, word string, score double")
    sqlite.write(df, path, "t")
    back = sqlite.read(spark, path, "t")
    assert back.dtypes == [("id", "bigint"), ("word", "string"), ("score", "double")]
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_pages_are_parsed_in_slices_of_bounded_bytes():
    import pyarrow as pa

    from glossmill.sources import markup

    batch = pa.RecordBatch.from_pydict({"celex_id": [str(i) for i in range(40)], "html": [None, "x" * 3_000_000, *["y" * 100_000] * 38]})
    parts = list(markup._slices(batch))
    assert [r for p in parts for r in p.column("celex_id").to_pylist()] == [str(i) for i in range(40)]
    assert all(p.num_rows == 1 or sum(len(h or "") for h in p.column("html").to_pylist()) <= markup.SLICE_BYTES for p in parts)
