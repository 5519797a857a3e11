"""Queries: merging by area, signatures, name risk and review buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmill.functions import scores
from glossmill.operators import areas, ngrams, tokens
from glossmill.plans.common import AREA_SQL, MINED_SQL, area_of, benchmark_phrases, documents, read
from glossmill.plans.registry import query
from glossmill.scratch import settled

LEAST = 6
_COUNTS = ", ".join(f"sum(CASE WHEN area = '{a}' THEN doc_count ELSE 0 END)::BIGINT AS d_{a}" for a in scores.AREAS)
_TOP = "greatest(" + ", ".join(f"d_{a}" for a in scores.AREAS) + ")"
_SUM = "(" + " + ".join(f"d_{a}" for a in scores.AREAS) + ")"
_DIGITS = " || ".join(f"CASE WHEN {_TOP} > 0 THEN upper(to_hex(least(15, floor(16.0 * d_{a} / {_TOP})::BIGINT))) ELSE '0' END" for a in scores.AREAS)
_N = " + ".join(f"(d_{a} > 0)::INT" for a in scores.AREAS)
_DOM = f"CASE WHEN {_TOP} <= 0 THEN '{scores.CROSS_CUTTING}' " + " ".join(f"WHEN d_{a} = {_TOP} THEN '{a}'" for a in scores.AREAS) + " END"
_BASE = f"""WITH {MINED_SQL}, g AS (SELECT doc_id, {AREA_SQL} AS area, source, array_to_string(words[i:i + 1], ' ') AS phrase FROM mined, unnest(range(1, len(words))) AS u(i)),
    att AS (SELECT phrase, area, source AS source_file, count(DISTINCT doc_id)::BIGINT AS doc_count, count(*)::BIGINT AS frequency FROM g GROUP BY ALL),
    m AS (SELECT phrase, sum(doc_count)::BIGINT AS total_doc_count, sum(frequency)::BIGINT AS total_frequency, {_COUNTS} FROM att GROUP BY phrase HAVING sum(frequency) >= {LEAST}),
    merged AS (SELECT *, {_DIGITS} AS area_signature, CASE WHEN {_SUM} > 0 THEN {_TOP}::DOUBLE / {_SUM} ELSE 0 END AS area_specificity, {_N} AS n_areas, {_DOM} AS dominant_area FROM m)"""


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bigrams by source, counted in rows that each hold a whole document, so no row per document is shuffled."""
    stop = F.array(*[F.lit(w) for w in tokens.STOP_WORDS])
    words = F.transform(tokens.sentences_of(F.col("text")), lambda s: F.filter(tokens.words_of(s), lambda w: ~F.array_contains(stop, w)))
    rows = ngrams.document_ngrams(documents(spark, sf_dir, "text", "source"), "text", 2, words, ["source"])
    return rows.select("phrase", area_of(F.col("source")).alias("area"), F.col("source").alias("source_file"), "doc_count", "frequency")


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return areas.merge_candidates(_rows(spark, sf_dir)).where(F.col("total_frequency") >= LEAST)


@query(f"{_BASE} SELECT phrase, area, source_file, doc_count, frequency FROM att")
def area_attestation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return areas.attestation(_rows(spark, sf_dir))


@query(f"{_BASE} SELECT phrase, total_doc_count, total_frequency, area_signature, floor(area_specificity * 10000 + 0.5)::BIGINT AS specificity_q, dominant_area FROM merged")
def area_signature_specificity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir).select("phrase", "total_doc_count", "total_frequency", "area_signature", scores.quantised(F.col("area_specificity")).alias("specificity_q"), areas.dominant_area().alias("dominant_area"))


@query(
    f"{_BASE}, l AS (SELECT phrase, string_agg(area || ':' || source_file || ':' || doc_count || ':' || frequency, ';' ORDER BY doc_count DESC, area, source_file, frequency) AS attestation FROM att GROUP BY phrase) SELECT phrase, attestation FROM merged JOIN l USING (phrase)"
)
def merged_attestation(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = lambda x: F.concat_ws(":", x["area"], x["source_file"], x["doc_count"].cast("string"), x["frequency"].cast("string"))
    return _merged(spark, sf_dir).select("phrase", F.array_join(F.transform("attestation", item), ";").alias("attestation"))


@query(f"{_BASE} SELECT CASE WHEN n_areas = 0 THEN '0' WHEN n_areas = 1 THEN '1' WHEN n_areas <= 3 THEN '2-3' ELSE '4+' END AS areas, count(*) AS n FROM merged GROUP BY 1")
def area_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_areas")
    named = F.when(n == 0, "0").when(n == 1, "1").when(n <= 3, "2-3").otherwise("4+")
    return _merged(spark, sf_dir).withColumn("n_areas", areas.n_areas()).groupBy(named.alias("areas")).agg(F.count("*").alias("n"))


_COUNTRY = "|".join(scores.COUNTRY_TERMS)
_ORGS = "[" + ", ".join(f"'{x}'" for x in scores.ORGANISATIONS) + "]"
_RISK = f"least(1.0, CASE WHEN regexp_matches(lower(phrase), '{_COUNTRY}') THEN 0.30 ELSE 0 END + CASE WHEN len(list_intersect(string_split(lower(phrase), ' '), {_ORGS})) > 0 THEN 0.30 ELSE 0 END + CASE WHEN area_specificity = 1.0 AND total_doc_count <= 4 THEN 0.20 ELSE 0 END)"


def _risky(spark: SparkSession, sf_dir: str) -> DataFrame:
    risk = scores.ne_risk(F.lit(None).cast("string"), F.col("phrase"), F.col("phrase"), F.col("area_specificity"), F.col("total_doc_count"))
    return _merged(spark, sf_dir).withColumn("ne_risk", risk)


@query(f"{_BASE} SELECT phrase, floor({_RISK} * 10000 + 0.5)::BIGINT AS ne_risk_q FROM merged")
def ne_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _risky(spark, sf_dir).select("phrase", scores.quantised(F.col("ne_risk")).alias("ne_risk_q"))


@query(f"{_BASE}, r AS (SELECT {_RISK} AS risk FROM merged) SELECT count(*) FILTER (WHERE risk < 0.2) AS low, count(*) FILTER (WHERE risk >= 0.2 AND risk < 0.5) AS middle, count(*) FILTER (WHERE risk >= 0.5) AS high FROM r")
def ne_risk_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = F.col("ne_risk")
    return _risky(spark, sf_dir).agg(F.count_if(r < 0.2).alias("low"), F.count_if((r >= 0.2) & (r < 0.5)).alias("middle"), F.count_if(r >= 0.5).alias("high"))


@query(f"WITH names AS (SELECT lower(n_name) AS name FROM nation), p AS (SELECT p_partkey, lower(p_name) AS phrase FROM part), s AS (SELECT lower(s_name) AS s FROM supplier) SELECT n_name, regexp_matches(lower(n_name), '{_COUNTRY}') AS country, len(list_intersect(string_split(lower(n_name), ' '), {_ORGS})) > 0 AS organisation FROM nation")
def nation_name_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    low = F.lower("n_name")
    return read(spark, sf_dir, "nation").select("n_name", low.rlike(_COUNTRY).alias("country"), F.arrays_overlap(F.split(low, " "), F.array(*[F.lit(x) for x in scores.ORGANISATIONS])).alias("organisation"))


_PHRASES = r"bw AS (SELECT regexp_extract_all(lower(text), '\p{L}+') AS words FROM benchmark), phrases AS (SELECT DISTINCT array_to_string(words[i:i + n - 1], ' ') AS phrase FROM bw, unnest([2, 3]) AS k(n), unnest(range(1, len(words) - n + 2)) AS u(i))"
_PINNED = "pinned AS (SELECT 'item_' || item_id AS label, ' ' || trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')) AS hay FROM benchmark WHERE item_id < 3), low AS (SELECT phrase, string_agg(label, ',' ORDER BY label) AS appears_in, count(*) AS n_low FROM (SELECT phrase, trim(regexp_replace(lower(phrase), '[^a-z0-9]+', ' ', 'g')) AS needle FROM merged) x JOIN pinned ON contains(hay, needle) WHERE needle <> '' GROUP BY phrase)"


def _pinned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "benchmark").where("item_id < 3").select(F.concat(F.lit("item_"), "item_id").alias("label"), "text")


@query(f"{_BASE}, {_PINNED} SELECT phrase, appears_in FROM low")
def low_scorer_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = areas.low_scorers(_merged(spark, sf_dir).select("phrase"), _pinned(spark, sf_dir))
    return found.select("phrase", F.array_join("appears_in", ",").alias("appears_in"))


@query(
    f"""{_BASE}, {_PHRASES}, {_PINNED}, e AS (SELECT m.*, coalesce(n_low, 0) AS n_low, {_RISK} AS risk FROM merged m LEFT JOIN low USING (phrase) WHERE phrase NOT IN (SELECT phrase FROM phrases)),
    r AS (SELECT *, CASE WHEN n_areas >= 4 THEN 1 WHEN n_low > 0 THEN 2 WHEN n_areas >= 1 AND area_specificity >= 0.5 AND risk < 0.5 THEN 3 ELSE 4 END AS routed FROM e),
    k AS (SELECT *, row_number() OVER (PARTITION BY dominant_area, routed ORDER BY area_specificity DESC, total_doc_count DESC, phrase) AS rk FROM r)
    SELECT phrase, dominant_area, CASE WHEN routed = 3 AND rk > 30 THEN 4 ELSE routed END AS bucket FROM k"""
)
def review_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enrich, drop what the store knows, route, and spill beyond the best of each area."""
    fresh = settled(_risky(spark, sf_dir).join(benchmark_phrases(spark, sf_dir), "phrase", "left_anti"), "merged")
    low = areas.low_scorers(fresh.select("phrase"), _pinned(spark, sf_dir))
    return areas.route(fresh.join(low, "phrase", "left")).select("phrase", "dominant_area", "bucket")


@query(
    f"{_BASE}, {_PHRASES} SELECT (SELECT count(*) FROM merged) AS n_candidates, (SELECT count(*) FROM merged WHERE phrase IN (SELECT phrase FROM phrases)) AS n_known"
)
def already_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _merged(spark, sf_dir).join(benchmark_phrases(spark, sf_dir).withColumn("known", F.lit(1)), "phrase", "left")
    return found.agg(F.count("*").alias("n_candidates"), F.count("known").alias("n_known"))
