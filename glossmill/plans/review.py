"""Queries: upserts into the store, and the review of candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmill.functions.scores import AREAS, CROSS_CUTTING
from glossmill.operators import review, writer
from glossmill.plans.common import read
from glossmill.plans.registry import query

_STAT = """WITH p AS (SELECT p_partkey AS ord, p_name || ' ' || p_size AS phrase, p_type AS lang, p_brand AS source, p_partkey % 3 = 0 AS old FROM part),
    held AS (SELECT lower(phrase) AS k, lang, min(ord) AS id, min_by(source, ord) AS first FROM p WHERE old GROUP BY ALL),
    fresh AS (SELECT k, lang, (SELECT coalesce(max(id), 0) FROM held) + row_number() OVER (ORDER BY ord) AS id, first FROM (SELECT lower(phrase) AS k, lang, min(ord) AS ord, min_by(source, ord) AS first FROM p WHERE NOT old AND (lower(phrase), lang) NOT IN (SELECT k, lang FROM held) GROUP BY ALL) x),
    ids AS (SELECT * FROM held UNION ALL SELECT * FROM fresh),
    occ AS (SELECT id, source, old FROM p JOIN ids ON ids.k = lower(p.phrase) AND ids.lang = p.lang),
    n AS (SELECT id, CASE WHEN count(*) FILTER (NOT old) > 0 THEN count(DISTINCT source) ELSE 0 END AS n, count(*) AS n_occurrences FROM occ GROUP BY id)"""


def _statistical(spark: SparkSession, sf_dir: str) -> writer.Store:
    """A third of the parts is the store, one concept for each phrase; the rest are candidates."""
    part = read(spark, sf_dir, "part").select(F.col("p_partkey").cast("long").alias("ord"), F.concat_ws(" ", "p_name", F.col("p_size").cast("string")).alias("phrase"), F.col("p_type").alias("lang"), F.col("p_brand").alias("source_file"), F.col("p_size").alias("frequency"))
    old = part.where("ord % 3 = 0").withColumn("phrase_normalized", F.lower("phrase"))
    held = old.groupBy("phrase_normalized", "lang").agg(F.min("ord").alias("id"), F.min_by("source_file", "ord").alias("first_seen_source"), F.min_by("phrase", "ord").alias("phrase"))
    none = lambda c: F.lit(None).cast("string").alias(c)
    store = writer.Store(
        held.select("id", F.lit("document_specific").alias("scope"), F.lit("emerging").alias("status"), F.lit(False).alias("promotable"), "first_seen_source", F.lit("parts").alias("domain"), none("area_signature")),
        held.select("id", "lang", "phrase", "phrase_normalized", F.split("phrase_normalized", " ")[0].alias("phrase_base"), none("pos_pattern")),
        old.join(held.select("phrase_normalized", "lang", "id"), ["phrase_normalized", "lang"]).select("id", F.col("source_file").alias("source_doc"), F.col("lang").alias("source_lang"), none("clause_ref")),
        spark.createDataFrame([], writer.ATTESTATION),
    )
    return writer.upsert_statistical(store, part.where("ord % 3 <> 0"), "parts")


@query(f"{_STAT} SELECT id, CASE WHEN n >= 2 THEN 'domain' ELSE 'document_specific' END AS scope, CASE WHEN n >= 3 THEN 'crystallized' WHEN n >= 2 THEN 'established' ELSE 'emerging' END AS status, n >= 2 AS promotable, first AS first_seen_source FROM ids JOIN n USING (id)")
def statistical_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _statistical(spark, sf_dir).concepts.select("id", "scope", "status", "promotable", "first_seen_source")


@query(f"{_STAT} SELECT id, k AS phrase_normalized, lang, split_part(k, ' ', 1) AS phrase_base, n_occurrences FROM ids JOIN n USING (id)")
def statistical_upsert_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _statistical(spark, sf_dir)
    return store.phrases.select("id", "phrase_normalized", "lang", "phrase_base").join(store.occurrences.groupBy("id").agg(F.count("*").alias("n_occurrences")), "id")


_AREA = "CASE l_suppkey % 8 " + " ".join(f"WHEN {i} THEN '{a}'" for i, a in enumerate(AREAS)) + f" ELSE '{CROSS_CUTTING}' END"
_MERGED = f"""WITH l AS (SELECT l_partkey AS k, {_AREA} AS area, l_returnflag AS f, l_linenumber = 1 AS old, count(DISTINCT l_orderkey) AS d, count(*) AS freq FROM lineitem GROUP BY ALL),
    held AS (SELECT DISTINCT k, k + 1 AS id FROM l WHERE old),
    ids AS (SELECT k, id FROM held UNION ALL SELECT k, (SELECT coalesce(max(id), 0) FROM held) + row_number() OVER (ORDER BY k) FROM (SELECT DISTINCT k FROM l WHERE k NOT IN (SELECT k FROM held)) x),
    att AS (SELECT k, area, f, d, freq FROM l WHERE old UNION ALL SELECT k, area, f, d, freq FROM l WHERE NOT old AND (k, area, f) NOT IN (SELECT k, area, f FROM l WHERE old)),
    c AS (SELECT k, {', '.join(f"sum(CASE WHEN area = '{a}' THEN d ELSE 0 END) AS d_{a}" for a in AREAS)}, count(*) AS n_attestation FROM att GROUP BY k),
    t AS (SELECT *, greatest({', '.join(f'd_{a}' for a in AREAS)}) AS top FROM c),
    s AS (SELECT k, count(DISTINCT f) AS n, bool_or(NOT old) AS met FROM l GROUP BY k)"""
_SIGNATURE = " || ".join(f"CASE WHEN top > 0 THEN upper(to_hex(least(15, floor(16 * d_{a} / top))::BIGINT)) ELSE '0' END" for a in AREAS)


@query(f"{_MERGED} SELECT id, CASE WHEN met AND n >= 3 THEN 'crystallized' WHEN met AND n >= 2 THEN 'established' ELSE 'emerging' END AS status, CASE WHEN met THEN {_SIGNATURE} END AS area_signature, n_attestation FROM ids JOIN t USING (k) JOIN s USING (k)")
def merged_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First lines of orders are the store, all others merged candidates, a record for each part."""
    line = read(spark, sf_dir, "lineitem")
    area = F.element_at(F.array(*[F.lit(a) for a in [*AREAS, CROSS_CUTTING]]), (F.col("l_suppkey") % 8 + 1).cast("int"))
    rows = line.groupBy(F.col("l_partkey").cast("long").alias("k"), area.alias("area"), F.col("l_returnflag").alias("source_file"), (F.col("l_linenumber") == 1).alias("old")).agg(F.count_distinct("l_orderkey").alias("doc_count"), F.count("*").alias("frequency"))
    old, new = rows.where("old").withColumn("id", F.col("k") + 1), rows.where("not old")
    none = lambda c: F.lit(None).cast("string").alias(c)
    phrase = F.concat(F.lit("part "), F.col("k").cast("string"))
    held = old.groupBy("id", "k").agg(F.min("source_file").alias("first_seen_source"))
    store = writer.Store(
        held.select("id", F.lit("document_specific").alias("scope"), F.lit("emerging").alias("status"), F.lit(False).alias("promotable"), "first_seen_source", F.lit("lines").alias("domain"), none("area_signature")),
        held.select("id", F.lit("en").alias("lang"), phrase.alias("phrase"), phrase.alias("phrase_normalized"), F.lit("part").alias("phrase_base"), none("pos_pattern")),
        old.select("id", F.col("source_file").alias("source_doc"), F.lit("en").alias("source_lang"), none("clause_ref")),
        old.select("id", "area", "doc_count", "frequency", "source_file"),
    )
    item = F.struct((-F.col("doc_count")).alias("neg"), "area", "source_file", "frequency")
    listed = F.transform(F.sort_array(F.collect_list(item)), lambda x: F.struct(x["area"].alias("area"), (-x["neg"]).alias("doc_count"), x["frequency"].alias("frequency"), x["source_file"].alias("source_file")))
    merged = new.groupBy("k").agg(listed.alias("attestation")).select(F.col("k").alias("ord"), phrase.alias("phrase_normalized"), F.lit("en").alias("lang"), "attestation")
    after = writer.upsert_merged(store, merged, "lines")
    return after.concepts.select("id", "status", "area_signature").join(after.attestation.groupBy("id").agg(F.count("*").alias("n_attestation")), "id")


@query("SELECT o_orderpriority AS kind, count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS approved, count(*) FILTER (o_orderstatus NOT IN ('F', 'P')) AS pending FROM orders GROUP BY 1")
def review_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    return review.state_counts(read(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("kind"), F.when(status == "F", "true").when(status == "P", "rejected").alias("approved")), ["kind"])


_KEYED = "WITH p AS (SELECT p_partkey, p_size, p_type, lower(p_name || ' ' || p_size % 13) AS key FROM part)"


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as candidates, a third each with a null, an empty and a given normalised phrase."""
    phrase = F.concat_ws(" ", "p_name", (F.col("p_size") % 13).cast("string"))
    at = F.col("p_partkey") % 3
    return read(spark, sf_dir, "part").select("p_partkey", "p_size", "p_type", F.initcap(phrase).alias("phrase"), F.when(at == 1, "").when(at == 2, F.lower(phrase)).alias("phrase_normalized"))


@query(f"{_KEYED} SELECT p_partkey FROM p WHERE p_size <= 25 AND key IN (SELECT key FROM p WHERE p_size > 25)")
def named_entity_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _candidates(spark, sf_dir)
    return review.name_overlap(found.where("p_size <= 25"), found.where("p_size > 25")).select("p_partkey")


@query(f"{_KEYED}, o AS (SELECT key, min_by(p_type, p_partkey) AS other_domain FROM p WHERE p_size > 25 GROUP BY key) SELECT p_partkey, other_domain FROM p JOIN o USING (key) WHERE p_size <= 25")
def other_domain_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _candidates(spark, sf_dir)
    labels = found.where("p_size > 25").groupBy(review.candidate_key().alias("phrase")).agg(F.min_by("p_type", "p_partkey").alias("domain"))
    return review.domain_matches(found.where("p_size <= 25"), labels).select("p_partkey", "other_domain")


@query("SELECT p_partkey, regexp_extract(p_brand, '[0-9]+') || ',' || regexp_extract(p_name || p_size, '[0-9]+') AS numbers FROM part")
def low_scorer_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = F.array("p_brand", "p_type", F.concat("p_name", F.col("p_size").cast("string")))
    return read(spark, sf_dir, "part").select("p_partkey", F.array_join(review.label_numbers(labels), ",").alias("numbers"))


@query("SELECT o_orderpriority AS stratum, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders WHERE o_totalprice IS NOT NULL) x WHERE r = 1")
def control_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("stratum"), "o_orderkey", "o_totalprice")
    return review.control_row(rows, "o_totalprice", "o_orderkey", ["stratum"]).select("stratum", "o_orderkey")


@query("SELECT p_name AS variant, max_by(p_brand, (p_size, p_partkey)) AS canonical FROM part GROUP BY 1")
def later_store_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stores of a synonym map are the sizes, in their order."""
    maps = read(spark, sf_dir, "part").select(F.col("p_name").alias("variant"), F.col("p_brand").alias("canonical"), "p_size", "p_partkey")
    return review.later_wins(maps, "variant", "canonical", ["p_size", "p_partkey"])


@query("SELECT count(*) AS n_shared FROM (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'A' INTERSECT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R') x")
def validation_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = read(spark, sf_dir, "lineitem")
    return review.shared_count(line.where("l_returnflag = 'A'"), line.where("l_returnflag = 'R'"), "l_partkey")
