"""Queries: coverage, expertise and co-occurrence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmill.functions.scores import quantised
from glossmill.operators import coverage, tokens
from glossmill.plans.common import LEXICON_SQL, PHRASES_SQL, RUNS_SQL, SPLIT_SQL, UNITS_SQL, benchmark_phrases, documents, lexicon, matches_sql, read, runs
from glossmill.plans.registry import query

KEYS = ["doc_id", "sent_idx", "run_idx"]
_BASE = f"WITH RECURSIVE {LEXICON_SQL}, {PHRASES_SQL}, {RUNS_SQL}, {matches_sql()}, {UNITS_SQL}"
_COUNTS = "c AS (SELECT doc_id, count(*) FILTER (WHERE category = 'TIER1') AS t1, count(*) FILTER (WHERE category = 'TIER2') AS t2, count(*) FILTER (WHERE category = 'TIER3') AS t3, count(*) FILTER (WHERE category = 'TIER4') AS t4, count(*) FILTER (WHERE category = 'UNKNOWN') AS unknown FROM units GROUP BY doc_id)"
_SUMMED = "s AS (SELECT *, t1 + t2 + t3 + t4 + unknown AS total, (t1 + t2)::DOUBLE / (t1 + t2 + t3 + t4 + unknown) AS common, t4::DOUBLE / (t1 + t2 + t3 + t4 + unknown) AS domain FROM c), r AS (SELECT *, CASE WHEN common > 0 THEN domain / common ELSE 0 END AS ratio, CASE WHEN common > 0 THEN domain / common ELSE domain END AS signal FROM s)"
_BAND = "CASE WHEN signal < 0.05 THEN 'general audience' WHEN signal < 0.20 THEN 'mixed audience' ELSE 'specialist' END"
_Q = "floor({0} * 10000 + 0.5)::BIGINT"


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs(spark, sf_dir)
    return coverage.with_summary(coverage.coverage_counts(found, benchmark_phrases(spark, sf_dir), lexicon(spark, sf_dir), KEYS, ["doc_id"]))


@query(f"{_BASE}, {_COUNTS}, {_SUMMED} SELECT doc_id, t1, t2, t3, t4, unknown, total, {_Q.format('common')} AS common_q, {_Q.format('domain')} AS domain_q, {_Q.format('ratio')} AS ratio_q, {_BAND} AS band FROM r")
def coverage_by_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: units of each document by vocabulary tier, and its expertise band."""
    c = _counts(spark, sf_dir)
    return c.select("doc_id", "t1", "t2", "t3", "t4", "unknown", "total", *[quantised(F.col(x)).alias(f"{x}_q") for x in ("common", "domain", "ratio")], "band")


@query(f"{_BASE}, {_COUNTS}, {_SUMMED} SELECT {_BAND} AS band, CASE WHEN common > 0 THEN 't4_vs_common' ELSE 't4_vs_total' END AS basis, count(*) AS n_docs, sum(t4)::BIGINT AS t4 FROM r GROUP BY ALL")
def coverage_signal_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counts(spark, sf_dir).groupBy("band", "basis").agg(F.count("*").alias("n_docs"), F.sum("t4").alias("t4"))


@query(f"{_BASE} SELECT doc_id, sent_idx, run_idx, pos, len, phrase AS matched_phrase FROM chosen")
def domain_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = coverage.phrase_matches(runs(spark, sf_dir), benchmark_phrases(spark, sf_dir), KEYS)
    return found.select(*[F.col(c).cast("long").alias(c) if c != "doc_id" else c for c in KEYS], F.col("pos").cast("long").alias("pos"), F.col("len"), F.col("phrase").alias("matched_phrase"))


_PER = "per AS (SELECT doc_id, sent_idx, count(*) AS n, count(*) FILTER (WHERE category = 'TIER4') AS n4, count(*) FILTER (WHERE category = 'TIER3') AS n3, count(*) FILTER (WHERE category = 'UNKNOWN') AS nu, count(DISTINCT CASE WHEN category = 'TIER4' THEN unit END) AS k FROM units GROUP BY doc_id, sent_idx), v AS (SELECT doc_id, count(DISTINCT CASE WHEN category = 'TIER4' THEN unit END) AS distinct_t4 FROM units GROUP BY doc_id), m AS (SELECT per.doc_id, count(*) AS n_sentences, sum(n)::BIGINT AS total, sum(n4)::BIGINT AS t4_units, sum(n3)::BIGINT AS t3_units, sum(nu)::BIGINT AS unknown_units, any_value(distinct_t4) AS distinct_t4, sum(k * (k - 1) // 2)::BIGINT AS pairs, count(*) FILTER (WHERE k >= 1) AS any_sentences, count(*) FILTER (WHERE k >= 2) AS multi_sentences, sum(CASE WHEN k >= 1 THEN n3 ELSE 0 END)::BIGINT AS anchored_t3 FROM per JOIN v USING (doc_id) GROUP BY per.doc_id)"
_RATES = f"{_Q.format('distinct_t4::DOUBLE / greatest(total, 1)')} AS variety_q, {_Q.format('pairs::DOUBLE / greatest(n_sentences, 1)')} AS cooccur_q, {_Q.format('multi_sentences::DOUBLE / greatest(any_sentences, 1)')} AS multi_q, CASE WHEN t3_units > 0 THEN {_Q.format('anchored_t3::DOUBLE / t3_units')} END AS anchor_rate_q"


def _measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = coverage.expertise(runs(spark, sf_dir), benchmark_phrases(spark, sf_dir), lexicon(spark, sf_dir), KEYS, ["doc_id"])
    share = lambda a, b: quantised(F.col(a).cast("double") / F.greatest(F.col(b), F.lit(1)))
    return m.withColumns({"variety_q": share("distinct_t4", "total"), "cooccur_q": share("pairs", "n_sentences"), "multi_q": share("multi_sentences", "any_sentences"), "anchor_rate_q": F.when(F.col("t3_units") > 0, share("anchored_t3", "t3_units"))})


@query(f"{_BASE}, {_PER} SELECT *, {_RATES} FROM m")
def expertise_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _measured(spark, sf_dir)


_MEANS = ["variety_q", "cooccur_q", "multi_q", "anchor_rate_q"]


@query(f"{_BASE}, {_PER}, z AS (SELECT *, {_RATES} FROM m) SELECT lang AS stratum, count(*) AS n_files, " + ", ".join(f"floor(avg({c}) + 0.5)::BIGINT AS {c}" for c in _MEANS) + " FROM z JOIN documents USING (doc_id) GROUP BY lang")
def stratum_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    strata = read(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("stratum"))
    return _measured(spark, sf_dir).join(strata, "doc_id").groupBy("stratum").agg(F.count("*").alias("n_files"), *[F.floor(F.avg(c) + 0.5).cast("long").alias(c) for c in _MEANS])


@query(
    f"{_BASE}, {_PER}, z AS (SELECT *, {_RATES} FROM m), u AS (SELECT lang, k.measure, CASE k.measure WHEN 'variety' THEN variety_q WHEN 'cooccur' THEN cooccur_q ELSE multi_q END AS v FROM z JOIN documents USING (doc_id), unnest(['variety', 'cooccur', 'multi']) AS k(measure)) "
    "SELECT measure, floor(avg(v) FILTER (WHERE lang = 'en') + 0.5)::BIGINT AS en, floor(avg(v) FILTER (WHERE lang = 'fr') + 0.5)::BIGINT AS fr, floor(avg(v) FILTER (WHERE lang = 'de') + 0.5)::BIGINT AS de, floor(avg(v) FILTER (WHERE lang = 'es') + 0.5)::BIGINT AS es FROM u GROUP BY measure"
)
def measure_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    strata = read(spark, sf_dir, "documents").select("doc_id", "lang")
    long = _measured(spark, sf_dir).join(strata, "doc_id").select("lang", F.expr("stack(3, 'variety', variety_q, 'cooccur', cooccur_q, 'multi', multi_q) as (measure, v)"))
    return long.groupBy("measure").pivot("lang", ["en", "fr", "de", "es"]).agg(F.floor(F.avg("v") + 0.5).cast("long"))


@query(f"{_BASE} SELECT unit AS token, count(*) AS n FROM units WHERE category = 'UNKNOWN' GROUP BY unit")
def unknown_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.unknown_counts(runs(spark, sf_dir), benchmark_phrases(spark, sf_dir), lexicon(spark, sf_dir), KEYS).withColumnRenamed("word", "token")


@query(
    f"{_BASE}, pool AS (SELECT unit AS token, count(*) AS n FROM units WHERE category = 'UNKNOWN' GROUP BY unit), one AS (SELECT DISTINCT unnest(string_split(phrase, ' ')) AS word FROM phrases) "
    "SELECT token, n, CASE WHEN n < 5 THEN 'frequency' WHEN length(token) < 3 THEN 'short' WHEN NOT regexp_full_match(token, '[a-z][a-z-]*[a-z]') THEN 'characters' WHEN lex.word IS NOT NULL THEN 'lexicon' WHEN one.word IS NOT NULL THEN 'domain' WHEN regexp_matches(token, '^(th|er|an)') THEN 'stem' WHEN token IN ('non', 'pre', 're', 'anti', 'sub', 'co', 'mis', 'de') THEN 'fragment' ELSE 'kept' END AS reason FROM pool LEFT JOIN lex ON lex.word = token LEFT JOIN one ON one.word = token"
)
def tier3_seed_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first failing rule of every unknown token; the stems are a parameter of the operator."""
    from glossmill.operators.lexicon import seed_reasons

    domain = benchmark_phrases(spark, sf_dir).select(F.explode(F.split("phrase", " ")).alias("word")).distinct()
    return seed_reasons(unknown_pool(spark, sf_dir), lexicon(spark, sf_dir).select("word"), domain, ["th", "er", "an"])


_CHAT_SENTS = "sents AS (SELECT conv_id, turn, i - 1 AS sent_idx, l[i] AS sentence FROM (SELECT conv_id, turn, " + SPLIT_SQL.format("text") + " AS l FROM conversations WHERE role = 'user') d, unnest(range(1, len(l) + 1)) AS u(i))"
_CHAT_RUNS = r"runs AS (SELECT conv_id, turn, sent_idx, j - 1 AS run_idx, regexp_extract_all(rs[j], '\p{L}+') AS words FROM (SELECT *, regexp_extract_all(lower(sentence), '\p{L}+(?:[ \t\n\r\x0B\f]+\p{L}+)*') AS rs FROM sents) s, unnest(range(1, len(rs) + 1)) AS u(j))"


@query(
    f"WITH RECURSIVE {LEXICON_SQL}, {PHRASES_SQL}, {_CHAT_SENTS}, {_CHAT_RUNS}, {matches_sql('conv_id, turn, sent_idx, run_idx')}, "
    "w AS (SELECT conv_id, turn, unnest(words) AS word FROM runs), a AS (SELECT conv_id, turn, count(*) AS n, count(*) FILTER (WHERE tier IN (1, 2)) AS c FROM w LEFT JOIN lex USING (word) GROUP BY ALL), "
    "x AS (SELECT conv_id, turn, count(*) AS t4 FROM chosen GROUP BY ALL), ins AS (SELECT conv_id, turn, unnest(string_split(phrase, ' ')) AS word FROM chosen), b AS (SELECT conv_id, turn, count(*) AS n, count(*) FILTER (WHERE tier IN (1, 2)) AS c FROM ins LEFT JOIN lex USING (word) GROUP BY ALL) "
    "SELECT a.conv_id, a.turn, coalesce(t4, 0) AS t4, a.c - coalesce(b.c, 0) AS common_units, a.n - coalesce(b.n, 0) + coalesce(t4, 0) AS total FROM a LEFT JOIN x ON x.conv_id = a.conv_id AND x.turn = a.turn LEFT JOIN b ON b.conv_id = a.conv_id AND b.turn = a.turn"
)
def chat_turn_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage of each user turn."""
    turns = read(spark, sf_dir, "conversations").where("role = 'user'").select("conv_id", "turn", "text")
    c = coverage.coverage_counts(tokens.token_runs(turns), benchmark_phrases(spark, sf_dir), lexicon(spark, sf_dir), ["conv_id", "turn", "sent_idx", "run_idx"], ["conv_id", "turn"])
    return c.select("conv_id", "turn", "t4", (F.col("t1") + F.col("t2")).alias("common_units"), (F.col("t1") + F.col("t2") + F.col("t3") + F.col("t4") + F.col("unknown")).alias("total"))


@query(f"{_BASE}, {_COUNTS}, {_SUMMED} SELECT quality, toxic, count(*) AS n_docs, sum(t4)::BIGINT AS t4, sum(total)::BIGINT AS total FROM r JOIN labels USING (doc_id) GROUP BY quality, toxic")
def quality_vs_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counts(spark, sf_dir).join(read(spark, sf_dir, "labels"), "doc_id").groupBy("quality", "toxic").agg(F.count("*").alias("n_docs"), F.sum("t4").alias("t4"), F.sum("total").alias("total"))


# The full cascade: lemmas from a suffix rule stand for a tagger's, a lexicon of English documents, inflections of the documents' own
# words, a fallback lexicon of French documents, and synonyms of phrases of three words.


def _lexicon_sql(name: str, lang: str) -> str:
    return (
        rf"{name}_dc AS (SELECT word, count(*) AS doc_count FROM (SELECT unnest(list_distinct(regexp_extract_all(lower(text), '\p{{L}}+'))) AS word FROM documents WHERE lang = '{lang}') x GROUP BY word), "
        f"{name} AS (SELECT word, CASE WHEN r <= 100 THEN 1 WHEN r <= 500 THEN 2 ELSE 3 END AS tier FROM (SELECT word, row_number() OVER (ORDER BY doc_count DESC, word) AS r FROM {name}_dc) x WHERE r <= 1000)"
    )


_K = "doc_id, sent_idx, run_idx"
_CASCADE = (
    f"WITH RECURSIVE {PHRASES_SQL}, {RUNS_SQL}, {_lexicon_sql('lex', 'en')}, {_lexicon_sql('fall', 'fr')}, "
    "infl AS (SELECT DISTINCT word AS inflected, left(word, length(word) - 2) AS lemma FROM lex_dc WHERE length(word) > 4 AND word LIKE '%ed'), "
    "lr AS (SELECT *, list_transform(words, lambda w: CASE WHEN length(w) > 3 AND w LIKE '%s' THEN left(w, length(w) - 1) ELSE w END) AS lemmas FROM runs), "
    "ph AS (SELECT phrase, n, string_split(phrase, ' ') AS p FROM phrases), "
    f"exact AS (SELECT {_K}, i - 1 AS pos, k.n AS len, 0 AS phase, o AS ord, 0 AS far, array_to_string((CASE WHEN o = 0 THEN words ELSE lemmas END)[i:i + k.n - 1], ' ') AS phrase FROM lr, unnest([0, 1]) AS w(o), unnest([2, 3]) AS k(n), unnest(range(1, len(words) - k.n + 2)) AS u(i)), "
    f"near AS (SELECT {_K}, i, words, lemmas, unnest(list_distinct([words[i + 1], lemmas[i + 1]])) AS second FROM lr, unnest(range(1, len(words))) AS u(i)), "
    f"opened AS (SELECT DISTINCT {_K}, i - 1 AS pos, n AS len, 1 AS phase, 2 AS ord, -length(p[1]) AS far, phrase FROM near JOIN ph ON p[2] = second WHERE ((starts_with(words[i], p[1]) AND words[i] <> p[1]) OR (starts_with(lemmas[i], p[1]) AND lemmas[i] <> p[1])) AND (n = 2 OR (i + 2 <= len(words) AND (words[i + 2] = p[3] OR lemmas[i + 2] = p[3])))), "
    f"hits AS (SELECT *, row_number() OVER (PARTITION BY {_K} ORDER BY pos, phase, len DESC, ord, far, phrase) AS k FROM (SELECT e.* FROM exact e JOIN phrases USING (phrase) UNION ALL SELECT * FROM opened) x), "
    f"walk AS (SELECT {_K}, k, pos, len, phrase, ord, TRUE AS chosen, pos + len AS free FROM hits WHERE k = 1 UNION ALL SELECT m.doc_id, m.sent_idx, m.run_idx, m.k, m.pos, m.len, m.phrase, m.ord, m.pos >= w.free, CASE WHEN m.pos >= w.free THEN m.pos + m.len ELSE w.free END FROM walk w JOIN hits m ON m.doc_id = w.doc_id AND m.sent_idx = w.sent_idx AND m.run_idx = w.run_idx AND m.k = w.k + 1), "
    f"chosen AS (SELECT {_K}, pos, len, phrase, ['text', 'lemma', 'opening'][ord + 1] AS step FROM walk WHERE chosen)"
)


def _lemmatised(spark: SparkSession, sf_dir: str) -> DataFrame:
    bare = lambda w: F.when((F.length(w) > 3) & w.endswith("s"), F.substring(w, F.lit(1), F.length(w) - 1)).otherwise(w)
    return runs(spark, sf_dir).withColumn("lemmas", F.transform("words", bare))


def _lexicon_of(spark: SparkSession, sf_dir: str, lang: str) -> tuple[DataFrame, DataFrame]:
    """Words by documents of a language, and the ranked lexicon of them (1,000 words)."""
    words = documents(spark, sf_dir, "text", "lang").where(F.col("lang") == lang).select(F.explode(F.array_distinct(tokens.words_of(F.col("text")))).alias("word"))
    counts = words.groupBy("word").agg(F.count("*").alias("doc_count"))
    return counts, F.broadcast(coverage.ranked_lexicon(counts))


@query(
    f"{_CASCADE}, words AS (SELECT doc_id, sent_idx, run_idx, i - 1 AS pos, words[i] AS word, lemmas[i] AS lemma FROM lr, unnest(range(1, len(words) + 1)) AS u(i)), "
    "covered AS (SELECT doc_id, sent_idx, run_idx, pos + d AS pos FROM chosen, unnest(range(0, len)) AS u(d)), "
    "free AS (SELECT w.doc_id, w.word, w.lemma, count(*) AS n FROM words w ANTI JOIN covered c ON c.doc_id = w.doc_id AND c.sent_idx = w.sent_idx AND c.run_idx = w.run_idx AND c.pos = w.pos GROUP BY ALL), "
    "tiers AS (SELECT f.*, least(a.tier, b.tier) AS own, v.tier AS via, least(x.tier, y.tier) AS back FROM free f LEFT JOIN lex a ON a.word = f.word LEFT JOIN lex b ON b.word = f.lemma LEFT JOIN infl g ON g.inflected = f.word LEFT JOIN infl h ON h.inflected = f.lemma LEFT JOIN lex v ON v.word = coalesce(g.lemma, h.lemma) LEFT JOIN fall x ON x.word = f.word LEFT JOIN fall y ON y.word = f.lemma), "
    "named AS (SELECT doc_id, n, CASE WHEN own <= 2 THEN 'TIER' || own WHEN via <= 2 THEN 'TIER' || via WHEN own = 3 THEN 'TIER3' WHEN back <= 2 THEN 'TIER' || back ELSE 'UNKNOWN' END AS category, CASE WHEN own <= 2 THEN 'word' WHEN via <= 2 THEN 'inflection' WHEN own = 3 THEN 'word' WHEN back <= 2 THEN 'fallback' END AS step FROM tiers) "
    "SELECT doc_id, category, step, sum(n)::BIGINT AS n FROM (SELECT doc_id, category, step, n FROM named UNION ALL SELECT doc_id, 'TIER4', step, 1 FROM chosen) z GROUP BY ALL"
)
def cascade_by_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units of each document by category and by the step of the cascade that decided."""
    counts, lex = _lexicon_of(spark, sf_dir, "en")
    forms = counts.where((F.length("word") > 4) & F.col("word").endswith("ed")).select(F.col("word").alias("inflected"), F.expr("left(word, length(word) - 2)").alias("lemma"))
    return coverage.cascade_counts(_lemmatised(spark, sf_dir), benchmark_phrases(spark, sf_dir), lex, forms, _lexicon_of(spark, sf_dir, "fr")[1], KEYS, ["doc_id"])


@query(f"{_CASCADE} SELECT doc_id, sent_idx::BIGINT AS sent_idx, run_idx::BIGINT AS run_idx, pos::BIGINT AS pos, len::INTEGER AS len, phrase AS matched_phrase, step, CASE WHEN len(string_split(phrase, ' ')) = 3 THEN array_to_string(string_split(phrase, ' ')[1:2], ' ') END AS synonym_of FROM chosen")
def cascade_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chosen phrases with the step that found them, and the canonical phrase of synonyms."""
    phrases = benchmark_phrases(spark, sf_dir)
    synonyms = phrases.where(F.size(F.split("phrase", " ")) == 3).select("phrase", F.substring_index("phrase", " ", 2).alias("canonical"))
    found = coverage.with_synonyms(coverage.phrase_matches(_lemmatised(spark, sf_dir), phrases, KEYS, inflected=True), synonyms)
    return found.select("doc_id", *[F.col(c).cast("long").alias(c) for c in ("sent_idx", "run_idx", "pos")], "len", F.col("phrase").alias("matched_phrase"), "step", "synonym_of")


@query(
    f"{_BASE}, {_PER}, {_COUNTS}, k AS (SELECT doc_id, to_json(list_sort(list(DISTINCT unit)))::VARCHAR AS unknown_tokens FROM units WHERE category = 'UNKNOWN' GROUP BY doc_id), "
    "ns AS (SELECT doc_id, source, len(list_filter(l, lambda x: trim(x, ' ') <> ''))::BIGINT AS n_sentences FROM (SELECT doc_id, source, " + SPLIT_SQL.format("coalesce(text, '')") + " AS l FROM documents) d), "
    "j AS (SELECT ns.doc_id, ns.source, ns.n_sentences, coalesce(t1, 0) AS t1, coalesce(t2, 0) AS t2, coalesce(t3, 0) AS t3, coalesce(t4, 0) AS t4, coalesce(unknown, 0) AS unknown, coalesce(distinct_t4, 0) AS d4, coalesce(pairs, 0) AS pairs, coalesce(any_sentences, 0) AS anys, coalesce(multi_sentences, 0) AS multi, coalesce(anchored_t3, 0) AS anchored FROM ns LEFT JOIN c USING (doc_id) LEFT JOIN m USING (doc_id)), "
    "q AS (SELECT *, t1 + t2 + t3 + t4 + unknown AS total FROM j), r AS (SELECT *, CASE WHEN total > 0 THEN (t1 + t2)::DOUBLE / total ELSE 0 END AS common, CASE WHEN total > 0 THEN t4::DOUBLE / total ELSE 0 END AS domain FROM q) "
    "SELECT r.doc_id::VARCHAR AS filename, source AS stratum, total::BIGINT AS total_tokens, t1::BIGINT AS t1_count, t2::BIGINT AS t2_count, t3::BIGINT AS t3_count, t4::BIGINT AS t4_count, unknown::BIGINT AS unknown_count, n_sentences, "
    f"{_Q.format('CASE WHEN common > 0 THEN domain / common ELSE 0 END')} AS t4_ratio_q, {_Q.format('common')} AS common_ratio_q, d4::BIGINT AS distinct_t4, {_Q.format('d4::DOUBLE / greatest(total, 1)')} AS t4_variety_q, pairs::BIGINT AS cooccur_pairs, "
    f"{_Q.format('pairs::DOUBLE / greatest(n_sentences, 1)')} AS cooccur_density_q, {_Q.format('multi::DOUBLE / greatest(anys, 1)')} AS multi_concept_ratio_q, {_Q.format('anchored::DOUBLE / greatest(n_sentences, 1)')} AS t3_anchor_density_q, "
    f"CASE WHEN t3 > 0 THEN {_Q.format('anchored::DOUBLE / t3')} END AS t3_anchor_rate_q, md5(coalesce(unknown_tokens, '[]')) AS unknown_md5 FROM r LEFT JOIN k USING (doc_id)"
)
def file_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row of each file: documents stand for files, sources for strata."""
    files = documents(spark, sf_dir, "doc_id", "source", "text").select(F.col("doc_id").cast("string").alias("filename"), F.col("source").alias("stratum"), "text")
    rows, rates = coverage.file_values(files, benchmark_phrases(spark, sf_dir), lexicon(spark, sf_dir)), coverage.SHARES
    return rows.select(*[c for c in coverage.FILE_ROW if c not in (*rates, "unknown_tokens")], *[quantised(F.col(c)).alias(f"{c}_q") for c in rates], F.md5(F.col("unknown_tokens").cast("binary")).alias("unknown_md5"))
