"""Queries: roots, lines of legal texts, web pages and lexicon loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmill.functions.scores import root_tier
from glossmill.functions.text import FLEXION, is_noise_line, slug, strip_flexion
from glossmill.operators import lexicon as lex
from glossmill.operators import morphology, ngrams, statutory
from glossmill.plans.common import MINED_SQL, UNI_SQL, documents, mined, read
from glossmill.plans.registry import query
from glossmill.scratch import settled
from glossmill.sources.html import corpus_lines

_NJ = "w1 AS (SELECT word, CASE WHEN word LIKE '%n' THEN left(word, length(word) - 1) ELSE word END AS a FROM uni), w2 AS (SELECT word, CASE WHEN a LIKE '%j' THEN left(a, length(a) - 1) ELSE a END AS b FROM w1)"
_FLEX = "CASE " + " ".join(f"WHEN b LIKE '%{e}' AND length(b) > {len(e)} THEN left(b, length(b) - {len(e)})" for e in FLEXION) + " ELSE b END"
_STEMS = f"{MINED_SQL}, {UNI_SQL}, {_NJ}, st AS (SELECT word, {_FLEX} AS stem FROM w2)"


def _stems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each distinct word and its stem. Words are stored, as Spark moves what is asked of stems before the count otherwise, and strips every use of a word."""
    return settled(ngrams.unigram_counts(mined(spark, sf_dir)).select("word"), "corpus-words").select("word", strip_flexion(F.col("word")).alias("stem"))


@query(f"WITH {_STEMS} SELECT word, stem FROM st")
def flexion_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stems(spark, sf_dir)


_S = "[" + ", ".join(f"'{x}'" for x in morphology.SUFFIXES) + "]"
_P = "[" + ", ".join(f"'{x}'" for x in morphology.PREFIXES) + "]"
_NUM = ", ".join(f"('{x}')" for x in morphology.NUMBER_ROOTS)
_ROOTS = f"""WITH RECURSIVE {_STEMS}, base AS (SELECT DISTINCT stem FROM st), num(stem) AS (VALUES {_NUM}), att AS (SELECT stem FROM base UNION SELECT stem FROM num),
    c AS (SELECT stem, 0 AS k, -length(a) AS neg, left(stem, length(stem) - length(a)) AS rest FROM att, unnest({_S}) AS s(a) WHERE stem LIKE '%' || a AND length(stem) - length(a) >= 3
        UNION ALL SELECT stem, 1, -length(a), substring(stem, length(a) + 1) FROM att, unnest({_P}) AS s(a) WHERE stem LIKE a || '%' AND length(stem) - length(a) >= 3),
    d AS (SELECT stem, min((k, neg, rest))[3] AS rest FROM c WHERE rest IN (SELECT stem FROM att) GROUP BY stem),
    walk AS (SELECT stem, stem AS root FROM base UNION ALL SELECT walk.stem, d.rest FROM walk JOIN d ON d.stem = walk.root),
    n AS (SELECT root, count(*) AS n FROM walk WHERE root NOT IN (SELECT stem FROM d) GROUP BY root),
    p AS (SELECT coalesce(n.root, num.stem) AS root, coalesce(n, 1)::BIGINT AS n FROM n FULL JOIN num ON num.stem = n.root)"""


@query(f"{_ROOTS} SELECT root, n AS productivity, CASE WHEN n >= 3 THEN 'core' WHEN n = 2 THEN 'extended' ELSE 'tail' END AS tier FROM p")
def root_productivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Affixes are peeled until none is left to peel."""
    return morphology.productivity(_stems(spark, sf_dir).select("stem").distinct())


@query(f"{_ROOTS} SELECT CASE WHEN n >= 3 THEN 'core' WHEN n = 2 THEN 'extended' ELSE 'tail' END AS tier, count(*) AS n_roots, sum(n)::BIGINT AS n_stems FROM p GROUP BY 1")
def root_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = morphology.productivity(_stems(spark, sf_dir).select("stem").distinct())
    return found.groupBy(root_tier(F.col("productivity")).alias("tier")).agg(F.count("*").alias("n_roots"), F.sum("productivity").alias("n_stems"))


def _decomposed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus' stems over the whole inventory of its own roots, tail roots among them."""
    stems = settled(_stems(spark, sf_dir).select("stem").distinct(), "corpus-stems")
    return morphology.decompose(stems, morphology.productivity(stems))


@query()
def decompose_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A search with memory, not expressible in SQL; tested against known analyses and a search over the whole inventory."""
    return _decomposed(spark, sf_dir)


@query()
def decomposition_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return morphology.decomposition_summary(_decomposed(spark, sf_dir))


@query("WITH r AS (SELECT p_partkey AS id, unnest(string_split(lower(p_name), ' ')) AS root FROM part) SELECT root, count(DISTINCT id) AS n_concepts FROM r GROUP BY root")
def root_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of a part's name stand for its roots."""
    rows = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("concept_id"), F.explode(F.split(F.lower("p_name"), " ")).alias("root"))
    return morphology.root_support(rows)


_LINES = "l AS (SELECT doc_id, i - 1 AS line_no, ls[i] AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents) d, unnest(range(1, len(ls) + 1)) AS u(i))"


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


@query(f"WITH {_LINES}, t AS (SELECT doc_id, line_no, trim(line, ' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12) || chr(160)) AS s FROM l) SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE length(s) < 10 OR regexp_full_match(s, '[0-9]+')) AS n_noise FROM t GROUP BY doc_id")
def noise_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.count_if(is_noise_line(F.col("line"))).alias("n_noise"))


@query(f"WITH {_LINES}, h AS (SELECT *, CASE WHEN length(line) < 60 THEN line END AS head FROM l) SELECT doc_id, line_no::INT AS line_no, last_value(head IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no) AS context FROM h")
def fill_forward_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short lines stand for headings here; each line carries the last one down."""
    rows = _lines(spark, sf_dir).withColumn("head", F.when(F.length("line") < 60, F.col("line")))
    return statutory.fill_forward(rows, ["doc_id"], "line_no", {"context": "head"}).select("doc_id", "line_no", "context")


@query(f"WITH {_LINES}, h AS (SELECT *, sum((length(line) < 60)::INT) OVER (PARTITION BY doc_id ORDER BY line_no) AS segment FROM l) SELECT doc_id, segment::BIGINT AS segment, count(*) AS n_lines, sum(length(line))::BIGINT AS n_chars FROM h GROUP BY ALL")
def article_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = statutory.segments(_lines(spark, sf_dir), ["doc_id"], "line_no", F.length("line") < 60)
    return rows.groupBy("doc_id", "segment").agg(F.count("*").alias("n_lines"), F.sum(F.length("line")).cast("long").alias("n_chars"))


@query(
    r"""WITH a AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script\s*>', '', 'g'), '(?is)<style\b.*?</style\s*>', '', 'g'), '(?is)<head\b.*?</head\s*>', '', 'g'), '(?is)<nav\b.*?</nav\s*>', '', 'g') AS h FROM pages),
    t AS (SELECT page_id, string_split(regexp_replace(h, '(?s)<[^>]*>', chr(10), 'g'), chr(10)) AS ls FROM a), u AS (SELECT page_id, trim(x.line, ' ' || chr(9) || chr(13) || chr(11) || chr(12) || chr(160)) AS line FROM t, unnest(ls) AS x(line))
    SELECT page_id, count(*) AS n_lines, sum(length(line))::BIGINT AS n_chars, md5(string_agg(line, chr(10) ORDER BY line)) AS lines_md5 FROM u WHERE length(line) >= 20 GROUP BY page_id"""
)
def html_to_corpus_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "pages").select("page_id", F.explode(corpus_lines(F.col("html"))).alias("line"))
    return rows.groupBy("page_id").agg(F.count("*").alias("n_lines"), F.sum(F.length("line")).cast("long").alias("n_chars"), F.md5(F.array_join(F.sort_array(F.collect_list("line")), "\n")).alias("lines_md5"))


@query("SELECT p_partkey, regexp_replace(regexp_replace(lower(regexp_replace(p_name, '\\([^)]*\\)', '', 'g')), '[^\\p{L}\\p{N}_]+', '-', 'g'), '^-+|-+$', '', 'g') AS entry_id FROM part")
def entry_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select("p_partkey", slug(F.col("p_name")).alias("entry_id"))


@query(
    "WITH v AS (SELECT p_partkey AS id, p_name AS word, p_brand AS pos, p_size AS tier, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_type END AS eo FROM part), k AS (SELECT *, coalesce('w:' || eo, 'i:' || id) AS key FROM v), c AS (SELECT key, min(id) AS concept_id, min_by(pos, id) AS eo_pos, any_value(eo) AS eo_word FROM k GROUP BY key) SELECT concept_id, eo_word, eo_pos, CASE WHEN eo_word IS NULL THEN 'pending' ELSE 'complete' END AS eo_status FROM c"
)
def migrate_concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("word"), F.col("p_brand").alias("pos"), F.col("p_size").alias("tier"), F.lit("v1").alias("source"), F.when(F.col("p_partkey") % 4 != 0, F.col("p_type")).alias("eo_word"))
    return lex.migrate_vocabulary(part)[0]


@query("WITH f AS (SELECT p_partkey AS id, lower(p_name) AS i, lower(p_type) AS l FROM part) SELECT i AS inflected, max_by(l, id) AS lemma FROM f WHERE i <> l GROUP BY i")
def inflection_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lex.inflection_map(read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("inflected_word"), F.col("p_type").alias("lemma")))


@query("WITH e AS (SELECT p_partkey AS id, p_brand AS b, p_size AS s FROM part), m(b, s, x, ord) AS (VALUES ('Brand#13', 7, 'exact', 1), ('Brand#13', NULL, 'loose', 2), ('Brand#22', NULL, 'other', 3)), a AS (SELECT b, min_by(x, ord) AS x FROM m GROUP BY b) SELECT e.id AS concept_id, coalesce(m.x, a.x) AS mapped FROM e JOIN a ON a.b = e.b LEFT JOIN m ON m.b = e.b AND m.s = e.s")
def word_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("concept_id"), F.col("p_brand").alias("word"), F.col("p_size").cast("string").alias("pos"), F.col("p_partkey").alias("ord"))
    mapping = spark.createDataFrame([("Brand#13", "7", "exact", 1), ("Brand#13", None, "loose", 2), ("Brand#22", None, "other", 3)], "word string, pos string, mapped string, ord int")
    return lex.map_words(entries, mapping).select("concept_id", "mapped")


# Documents as statutes: every second line becomes a numbered clause whose first two words are the term; the lines between continue it.
_TRIM = "trim({0}, ' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12) || chr(160))"
_CLAUSE_SQL = r"'^(\d+(?:\s\d+)?)\.\s+(.+)'"


@query(
    rf"""WITH l AS (SELECT doc_id, i - 1 AS line_no, replace(replace(ls[i], '(', ''), ')', '') AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents) d, unnest(range(1, len(ls) + 1)) AS u(i)),
    d AS (SELECT doc_id, line_no, {_TRIM.format("replace(" + _TRIM.format("CASE WHEN line_no % 2 = 0 THEN (line_no + 1) || '. ' || regexp_replace(line, '^([^ ]+ [^ ]+) ', chr(92) || '1 – ') ELSE line END").replace("chr(92) || '1 – '", "'" + chr(92) + "1 – '") + ", '**', '')")} AS line FROM l),
    k AS (SELECT *, regexp_matches(line, {_CLAUSE_SQL}) AS is_clause FROM d WHERE NOT regexp_matches(line, '(?i)^(?:Nr\.|Straipsnio|Papildyta|Ŝanĝoj|Aldonita|TAR pastaba|Noto pri|N-ro)') AND NOT regexp_matches(line, '(?i)publikigita en la TAR')),
    g AS (SELECT *, sum(is_clause::INT) OVER (PARTITION BY doc_id ORDER BY line_no) AS seg FROM k),
    c AS (SELECT doc_id, seg, list(line ORDER BY line_no) AS body FROM g WHERE seg > 0 GROUP BY ALL),
    r AS (SELECT doc_id, replace(regexp_extract(body[1], {_CLAUSE_SQL}, 1), ' ', '') AS clause_num, regexp_extract(body[1], {_CLAUSE_SQL}, 2) AS rest, list_filter(body[2:], lambda x: x <> '') AS more FROM c),
    p AS (SELECT *, least(nullif(strpos(rest, ' – '), 0), nullif(strpos(rest, ' - '), 0)) AS cut_at FROM r),
    f AS (SELECT doc_id, clause_num, {_TRIM.format("substring(rest, 1, cut_at - 1)")} AS term_raw, {_TRIM.format("substring(rest, cut_at + 3)")} AS behind, more FROM p WHERE cut_at > 0)
    SELECT doc_id::VARCHAR AS source_file, clause_num, term_raw, lower(term_raw) AS term_normalized, CASE WHEN regexp_matches(behind, '(?i)^as\s+defined\s+in\s+.') THEN 'by_reference' ELSE 'direct' END AS definition_type, md5(array_to_string(list_concat([behind], more), ' ')) AS definition_md5 FROM f"""
)
def definition_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Defined terms in the clauses of one article of each document."""
    lines = _lines(spark, sf_dir).withColumn("line", F.translate("line", "()", ""))
    clause = F.concat((F.col("line_no") + 1).cast("string"), F.lit(". "), F.regexp_replace("line", "^([^ ]+ [^ ]+) ", "$1 – "))
    body = lines.select(F.col("doc_id").cast("string").alias("source_file"), "line_no", F.when(F.col("line_no") % 2 == 0, clause).otherwise(F.col("line")).alias("line"))
    heads = documents(spark, sf_dir).select(F.col("doc_id").cast("string").alias("source_file"), F.lit(-1).alias("line_no"), F.lit("Article 2. Definitions").alias("line"))
    found = statutory.definitions(heads.unionByName(body), "2", "en")
    return found.select("source_file", "clause_num", "term_raw", "term_normalized", "definition_type", F.md5(F.col("definition_raw").cast("binary")).alias("definition_md5"))


# Documents as pages of law: each line with two words is a numbered item that defines them.
_LETTERS_SQL = "trim(regexp_replace(line, '[^A-Za-z]+', ' ', 'g'))"


@query(
    f"""WITH {_LINES}, w AS (SELECT doc_id, line_no, {_LETTERS_SQL} AS s FROM l), t AS (SELECT doc_id, line_no, string_split(s, ' ') AS ws FROM w WHERE s LIKE '% % %')
    SELECT doc_id::VARCHAR AS celex_id, 'divlayout' AS layout, '2' AS article_number, (line_no + 1)::VARCHAR AS number, ws[1] || ' ' || ws[2] AS term, lower(ws[1] || ' ' || ws[2]) AS term_normalized, md5(array_to_string(ws[3:], ' ')) AS definition_md5 FROM t"""
)
def html_definition_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Definitions read from a tree of markup."""
    from glossmill.sources.markup import definitions

    letters = F.trim(F.regexp_replace("line", "[^A-Za-z]+", " "))
    lines = _lines(spark, sf_dir).withColumn("s", letters).where(F.col("s").like("% % %"))
    item = F.concat(F.lit('<div class="grid-container"><div class="grid-list-column-1"><span>('), F.col("line_no") + 1, F.lit(')</span></div><div class="grid-list-column-2"><p class="norm">‘'), F.substring_index("s", " ", 2), F.lit("’ means "), F.expr("substring(s, length(substring_index(s, ' ', 2)) + 2)"), F.lit(";</p></div></div>"))
    pages = lines.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("line_no", item.alias("item")))).alias("items"))
    start = '<div id="docHtml"><div id="art_2" class="eli-subdivision"><p class="title-article-norm">Article 2</p><p class="stitle-article-norm">Definitions</p>'
    html = F.concat(F.lit(start), F.array_join(F.transform("items", lambda x: x["item"]), ""), F.lit("</div></div>"))
    found = definitions(pages.select(F.col("doc_id").cast("string").alias("celex_id"), F.lit("en").alias("lang"), html.alias("html")))
    number = F.regexp_extract("list_path", r"(\d+)", 1)
    return found.select("celex_id", "layout", "article_number", number.alias("number"), "term", "term_normalized", F.md5(F.col("definition").cast("binary")).alias("definition_md5"))
