"""Queries: the domain store, lifecycle, conflicts, synonyms, overrides and decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmill.operators import definitions, store
from glossmill.plans.common import read
from glossmill.plans.registry import query


@query("SELECT l_partkey AS concept, count(DISTINCT l_suppkey) AS n_sources, CASE WHEN count(DISTINCT l_suppkey) >= 3 THEN 'crystallized' WHEN count(DISTINCT l_suppkey) >= 2 THEN 'established' ELSE 'emerging' END AS status FROM lineitem GROUP BY l_partkey")
def concept_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = read(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("concept"), F.col("l_suppkey").alias("source"))
    counts = store.source_counts(log, "concept", "source")
    return store.with_lifecycle(log.select("concept").distinct(), counts, "concept").select("concept", "n_sources", "status")


_DIVERGE = "n AS (SELECT {key} AS k, lower(trim({d})) AS norm, min({id}) AS id, min_by({d}, {id}) AS d FROM {t} GROUP BY ALL)"


@query(f"WITH {_DIVERGE.format(key='p_name', d='p_type', id='p_partkey', t='part')} SELECT a.k AS phrase, a.id AS id_a, b.id AS id_b, 'A: ' || left(a.d, 100) || ' | B: ' || left(b.d, 100) AS divergence_detail FROM n a JOIN n b ON a.k = b.k AND a.id < b.id")
def text_divergence_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = read(spark, sf_dir, "part").select(F.col("p_name").alias("phrase"), F.col("p_partkey").alias("id"), F.col("p_type").alias("definition"))
    return store.divergences(entries, ["phrase"], "id", "definition").select("phrase", "id_a", "id_b", "divergence_detail")


@query(
    "WITH p AS (SELECT p_partkey AS id, p_brand AS k, p_size % 2 AS side, CASE WHEN p_partkey % 7 = 0 THEN '' ELSE p_type END AS d FROM part), a AS (SELECT k, max_by(d, id) AS da FROM p WHERE side = 0 GROUP BY k) "
    "SELECT a.k AS phrase, p.id AS id_b, lower(trim(da)) = '' OR lower(trim(d)) = '' AS incomplete FROM a JOIN p ON p.k = a.k AND p.side = 1 WHERE lower(trim(da)) <> lower(trim(d))"
)
def cross_domain_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("phrase"), (F.col("p_size") % 2).alias("side"), F.when(F.col("p_partkey") % 7 == 0, "").otherwise(F.col("p_type")).alias("definition"))
    return store.cross_domain(part.where("side = 0"), part.where("side = 1"), ["phrase"], "id", "definition").select("phrase", "id_b", "incomplete")


@query("SELECT least(p_partkey, p_partkey % 97 + 1) AS a, greatest(p_partkey, p_partkey % 97 + 1) AS b FROM part WHERE p_partkey <> p_partkey % 97 + 1 GROUP BY ALL")
def synonym_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part")
    return store.synonym_edges(part.select(F.col("p_partkey").alias("a"), (F.col("p_partkey") % 97 + 1).alias("b")))


@query(
    "WITH e AS (SELECT least(p_partkey, p_partkey % 97 + 1) AS a, greatest(p_partkey, p_partkey % 97 + 1) AS b FROM part WHERE p_partkey <> p_partkey % 97 + 1 GROUP BY ALL), j AS (SELECT v.p_name AS variant, c.p_name AS canonical, a, b, row_number() OVER (PARTITION BY v.p_name ORDER BY a, b) AS r FROM e JOIN part c ON c.p_partkey = a JOIN part v ON v.p_partkey = b) SELECT variant, canonical FROM j WHERE r = 1"
)
def synonym_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    phrases = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("phrase"))
    return store.synonym_map(synonym_edges(spark, sf_dir), phrases)


@query(
    "WITH k AS (SELECT DISTINCT CASE WHEN p_partkey % 3 = 0 THEN p_size::VARCHAR ELSE p_brand END AS key FROM part) SELECT key, row_number() OVER (ORDER BY try_cast(key AS BIGINT) IS NULL, try_cast(key AS BIGINT), key) AS place FROM k"
)
def numeric_then_lexical_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of the distinct keys in their order: a range sort, and the sizes of its parts on the driver."""
    keys = read(spark, sf_dir, "part").select(F.when(F.col("p_partkey") % 3 == 0, F.col("p_size").cast("string")).otherwise(F.col("p_brand")).alias("key")).distinct()
    return store.placed(keys, store.numeric_then_text("key")).select("key", "place")


_OLD = "old AS (SELECT o_custkey AS k, o_orderpriority AS p FROM orders WHERE o_orderkey % 3 = 0), new AS (SELECT o_custkey AS k, o_orderpriority AS p FROM orders WHERE o_orderkey % 3 <> 0)"


def _batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All of orders in two: a third is the store, the rest the batch."""
    orders = read(spark, sf_dir, "orders")
    side = lambda held: orders.where(held).select(F.col("o_custkey").alias("k"), F.col("o_orderpriority").alias("p"))
    return side(F.col("o_orderkey") % 3 == 0), side(F.col("o_orderkey") % 3 != 0)


@query(f"WITH {_OLD} SELECT DISTINCT k, p FROM new WHERE (k, p) NOT IN (SELECT k, p FROM old)")
def insert_or_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.insert_or_ignore(*_batches(spark, sf_dir), ["k", "p"])


@query(f"WITH {_OLD} SELECT k, p FROM new WHERE (k, p) NOT IN (SELECT k, p FROM old)")
def append_except_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.append_except_keys(*_batches(spark, sf_dir), ["k", "p"])


_OVERRIDES = [("Brand#13", None, "first", 1), ("Brand#13", "STEEL", "second", 2), ("Brand#22", "BRASS", None, 3)]
_OVERRIDES_SQL = "o(p_brand, p_type, note, ord) AS (VALUES ('Brand#13', NULL, 'first', 1), ('Brand#13', 'STEEL', 'second', 2), ('Brand#22', 'BRASS', NULL, 3))"


@query(f"WITH {_OVERRIDES_SQL}, l AS (SELECT p_brand, p_type, note FROM o QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY ord DESC) = 1) SELECT p_partkey, part.p_brand, coalesce(l.p_type, part.p_type) AS p_type, coalesce(l.note, part.p_name) AS note FROM part LEFT JOIN l ON l.p_brand = part.p_brand")
def override_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    overrides = spark.createDataFrame(_OVERRIDES, "p_brand string, p_type string, note string, ord int")
    records = read(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", F.col("p_name").alias("note"))
    return store.apply_overrides(records, overrides, ["p_brand"], ["p_type", "note"])


@query("WITH m(brand, size, needle, ord) AS (VALUES ('Brand#13', NULL::INT, NULL, 1), (NULL, 7, NULL, 2), (NULL, NULL, 'steel', 3)) SELECT ord, count(p_partkey) AS n_matches FROM m LEFT JOIN part ON (brand IS NULL OR brand = p_brand) AND (size IS NULL OR size = p_size) AND (needle IS NULL OR contains(lower(p_type), needle)) GROUP BY ord")
def override_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that each override's optional criteria hold for; overrides are a short list."""
    rules = F.broadcast(spark.createDataFrame([("Brand#13", None, None, 1), (None, 7, None, 2), (None, None, "steel", 3)], "brand string, size int, needle string, ord int"))
    part = read(spark, sf_dir, "part")
    fits = store.optional_match([(F.col("brand"), F.col("p_brand")), (F.col("size"), F.col("p_size"))]) & (F.col("needle").isNull() | F.lower("p_type").contains(F.col("needle")))
    found = part.join(rules, fits).groupBy("ord").agg(F.count("*").alias("n_matches"))
    return rules.select("ord").join(found, "ord", "left").select("ord", F.coalesce("n_matches", F.lit(0)).alias("n_matches"))


@query(
    "WITH l AS (SELECT user_id AS record_key, CASE event_type WHEN 'click' THEN 'approve' WHEN 'purchase' THEN 'reject' WHEN 'refund' THEN 'undo' ELSE 'skip' END AS action, event_id AS ts FROM events), "
    "s AS (SELECT *, sum(CASE action WHEN 'undo' THEN -1 ELSE 1 END) OVER (PARTITION BY record_key ORDER BY ts) AS s FROM l), d AS (SELECT *, s - least(0, min(s) OVER (PARTITION BY record_key ORDER BY ts)) AS depth FROM s), "
    "m AS (SELECT *, min(depth) OVER (PARTITION BY record_key ORDER BY ts ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS later FROM d) "
    "SELECT record_key, max_by(action, ts) AS action FROM m WHERE action <> 'undo' AND coalesce(later, depth) >= depth GROUP BY record_key"
)
def decision_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    log = read(spark, sf_dir, "events").select(F.col("user_id").alias("record_key"), F.when(kind == "click", "approve").when(kind == "purchase", "reject").when(kind == "refund", "undo").otherwise("skip").alias("action"), F.col("event_id").alias("ts"))
    return store.decided(log)


_SRC = "CASE WHEN page_id % 5 = 0 THEN 'wco-glossary/' || page_id WHEN page_id % 5 = 1 THEN '' WHEN page_id % 5 = 2 THEN NULL ELSE url END"


@query(
    f"WITH p AS (SELECT page_id, {_SRC} AS s FROM pages) SELECT page_id, CASE WHEN starts_with(s, 'wco-glossary/') THEN 'wco_glossary' WHEN coalesce(s, '') <> '' THEN 'normative' ELSE 'statistical_mwe' END AS source_type, CASE WHEN coalesce(s, '') = '' THEN 'undefined' ELSE 'defined' END AS definition_status, CASE WHEN contains(coalesce(s, ''), '#') THEN split_part(s, '#', 1) ELSE s END AS authority FROM p"
)
def source_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("page_id") % 5
    source = F.when(m == 0, F.concat(F.lit("wco-glossary/"), "page_id")).when(m == 1, "").when(m == 2, F.lit(None)).otherwise(F.col("url"))
    return store.backfill_source(read(spark, sf_dir, "pages").select("page_id", source.alias("s")), "s").drop("s")


@query(
    "WITH s AS (SELECT p_partkey AS id, p_mfgr, p_brand AS phrase, p_type AS d FROM (SELECT *, CASE p_size % 2 WHEN 0 THEN 'en' ELSE 'lt' END AS p_mfgr FROM part) x WHERE p_partkey % 2 = 0), b AS (SELECT p_partkey // 4 AS g, p_mfgr, p_brand AS phrase, p_type AS d, p_partkey FROM (SELECT *, CASE p_size % 2 WHEN 0 THEN 'en' ELSE 'lt' END AS p_mfgr FROM part) x WHERE p_partkey % 2 = 1), "
    "f AS (SELECT p_mfgr, phrase, min(id) AS id, min_by(d, id) AS d FROM s GROUP BY ALL), c AS (SELECT b.g, min(f.id) AS cid FROM b JOIN f ON f.p_mfgr = b.p_mfgr AND f.phrase = b.phrase AND lower(trim(f.d)) = lower(trim(b.d)) GROUP BY b.g) "
    "SELECT b.p_partkey, CASE WHEN cid IS NULL THEN 'new' WHEN s.d IS NULL THEN 'add_lang' WHEN lower(trim(s.d)) = lower(trim(b.d)) THEN 'merge' ELSE 'conflict' END AS action FROM b LEFT JOIN c ON c.g = b.g LEFT JOIN s ON s.id = cid AND s.p_mfgr = b.p_mfgr"
)
def definition_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.when(F.col("p_size") % 2 == 0, "en").otherwise("lt").alias("lang"), F.col("p_brand").alias("phrase"), F.col("p_type").alias("definition"))
    batch = part.where("id % 2 = 1").withColumn("group", F.expr("id div 4")).withColumnRenamed("id", "p_partkey")
    return store.upsert_definitions(part.where("id % 2 = 0"), batch).select("p_partkey", "action")


# Definition groups: three parts make a group, with brand and size class as phrase and the type as definition;
# every seventh part is stored already.
_GROUPS = (
    "p AS (SELECT p_partkey, p_partkey // 3 AS g, CASE p_partkey % 3 WHEN 0 THEN 'en' WHEN 1 THEN 'fr' ELSE 'lt' END AS lang, lower(p_brand) || ' ' || (p_size % 4) AS phrase, p_type AS d, 'm' || (p_size % 6) AS p_mfgr FROM part), "
    "s AS (SELECT * FROM p WHERE p_partkey % 7 = 0), b AS (SELECT * FROM p WHERE p_partkey % 7 <> 0), "
    "hs AS (SELECT lang, phrase, arg_min(d, p_partkey) AS hd, min(p_partkey) AS hid FROM s GROUP BY ALL), hb AS (SELECT lang, phrase, arg_min(d, p_partkey) AS hd, arg_min(g, p_partkey) AS hg, min(p_partkey) AS hr FROM b GROUP BY ALL), "
    "h AS (SELECT lang, phrase, CASE WHEN hid IS NOT NULL THEN hs.hd ELSE hb.hd END AS hd, hid, CASE WHEN hid IS NULL THEN hg END AS hg, CASE WHEN hid IS NULL THEN hr END AS hr FROM hs FULL JOIN hb USING (lang, phrase)), "
    "m AS (SELECT g, hid, hg FROM b JOIN h USING (lang, phrase) WHERE lower(trim(d)) = lower(trim(hd)) AND (hid IS NOT NULL OR hg < g) QUALIFY row_number() OVER (PARTITION BY g ORDER BY p_partkey) = 1), "
    "c AS (SELECT DISTINCT b.g, m.hid AS id, CASE WHEN m.g IS NULL THEN b.g END AS root FROM b LEFT JOIN m ON m.g = b.g WHERE m.g IS NULL OR m.hid IS NOT NULL UNION ALL SELECT m.g, c.id, c.root FROM c JOIN m ON m.hid IS NULL AND m.hg = c.g), "
    "a AS (SELECT b.*, h.hd, c.id AS sid, c.root, CASE WHEN c.id IS NULL AND c.root = b.g THEN 'new' WHEN h.hid IS NULL AND h.hr >= b.p_partkey THEN 'add_lang' WHEN lower(trim(b.d)) = lower(trim(h.hd)) THEN 'merge' ELSE 'conflict' END AS action FROM b JOIN h USING (lang, phrase) JOIN c ON c.g = b.g), "
    "o AS (SELECT g, r, (SELECT max(p_partkey) FROM s) + row_number() OVER (ORDER BY g, r NULLS FIRST) AS id FROM (SELECT DISTINCT g, NULL AS r FROM a WHERE action = 'new' UNION ALL SELECT g, p_partkey FROM a WHERE action = 'conflict') x), "
    "w AS (SELECT a.*, coalesce(a.sid, og.id) AS gid, coalesce(ow.id, a.sid, og.id) AS id FROM a LEFT JOIN o og ON og.g = a.root AND og.r IS NULL LEFT JOIN o ow ON ow.g = a.g AND ow.r = a.p_partkey)"
)


def _definition_tables(spark: SparkSession, sf_dir: str) -> tuple[definitions.Definitions, DataFrame]:
    lang = F.when(F.col("p_partkey") % 3 == 0, "en").when(F.col("p_partkey") % 3 == 1, "fr").otherwise("lt")
    phrase = F.concat_ws(" ", F.lower("p_brand"), F.col("p_size") % 4)
    p = read(spark, sf_dir, "part").select("p_partkey", lang.alias("lang"), phrase.alias("phrase"), F.col("p_type").alias("definition"), F.concat(F.lit("m"), F.col("p_size") % 6).alias("source"))
    held = p.where("p_partkey % 7 = 0")
    rows = held.select(F.col("p_partkey").alias("seq"), F.col("p_partkey").alias("id"), "lang", "phrase", "definition")
    concepts = held.select(F.col("p_partkey").alias("id"), F.lit("document_specific").alias("scope"), F.lit("emerging").alias("status"), F.lit(False).alias("promotable"), F.col("source").alias("first_seen_source"), F.lit("parts").alias("domain"))
    store_ = definitions.Definitions(concepts, rows, held.select(F.col("p_partkey").alias("id"), "lang", "source"), spark.createDataFrame([], definitions.CONFLICT))
    return store_, p.where("p_partkey % 7 <> 0").withColumnRenamed("p_partkey", "r").withColumn("g", F.expr("r div 3"))


@query(f"WITH RECURSIVE {_GROUPS} SELECT p_partkey, action, id::BIGINT AS concept_id FROM w")
def definition_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What becomes of each record of the batch, in batch order, and its concept."""
    return definitions.actions(*_definition_tables(spark, sf_dir)).select(F.col("r").alias("p_partkey"), "action", F.col("id").alias("concept_id"))


@query(
    f"WITH RECURSIVE {_GROUPS}, l AS (SELECT id, max(p_partkey) AS last FROM w WHERE action = 'merge' GROUP BY id), "
    "n AS (SELECT id, count(DISTINCT p_mfgr) AS n FROM (SELECT l.id, w.p_mfgr FROM w JOIN l ON l.id = w.id WHERE w.p_partkey <= last UNION ALL SELECT l.id, s.p_mfgr FROM s JOIN l ON l.id = s.p_partkey) x GROUP BY id), "
    "k AS (SELECT p_partkey AS id, p_mfgr AS f FROM s UNION ALL SELECT id, arg_min(p_mfgr, p_partkey) FROM w WHERE action IN ('new', 'conflict') GROUP BY id) "
    "SELECT k.id::BIGINT AS id, CASE WHEN n >= 2 THEN 'domain' ELSE 'document_specific' END AS scope, CASE WHEN n >= 3 THEN 'crystallized' WHEN n = 2 THEN 'established' ELSE 'emerging' END AS status, f AS first_seen_source FROM k LEFT JOIN n ON n.id = k.id"
)
def definition_concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The concepts after the batch."""
    return definitions.write(*_definition_tables(spark, sf_dir), "parts").concepts.select("id", "scope", "status", "first_seen_source")


@query(
    f"WITH RECURSIVE {_GROUPS}, rw AS (SELECT p_partkey AS seq, p_partkey AS id, lang, phrase, d, FALSE AS fresh FROM s UNION ALL SELECT (SELECT max(p_partkey) FROM s) + p_partkey, id, lang, phrase, d, action = 'new' FROM w WHERE action <> 'merge'), "
    "ld AS (SELECT lang, phrase, lower(trim(d)) AS nd, arg_min(id, seq) AS id, arg_min(d, seq) AS d, min(seq) AS seq FROM rw GROUP BY ALL) "
    "SELECT gid::BIGINT AS id_a, id::BIGINT AS id_b, 'A: ' || left(hd, 100) || ' | B: ' || left(d, 100) AS detail FROM w WHERE action = 'conflict' UNION ALL "
    "SELECT ld.id::BIGINT, rw.id::BIGINT, 'A: ' || left(ld.d, 100) || ' | B: ' || left(rw.d, 100) FROM rw JOIN ld ON ld.lang = rw.lang AND ld.phrase = rw.phrase AND ld.seq < rw.seq AND ld.nd <> lower(trim(rw.d)) AND ld.id <> rw.id WHERE rw.fresh"
)
def definition_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conflicts that the batch brings."""
    return definitions.write(*_definition_tables(spark, sf_dir), "parts").conflicts


@query(
    "WITH p AS (SELECT p_partkey AS id, CASE WHEN p_size % 2 = 0 THEN 'en' ELSE 'lt' END AS lang, p_name AS phrase FROM part), h AS (SELECT lang, phrase, min(id) AS id FROM p GROUP BY ALL), "
    "q AS (SELECT DISTINCT a.lang, a.phrase AS canonical, CASE WHEN b.id % 11 = 0 THEN b.phrase || ' x' ELSE b.phrase END AS synonym FROM p a JOIN p b ON b.id = a.id + 1), k AS (SELECT least(p_partkey, p_size) AS lo, greatest(p_partkey, p_size) AS hi FROM part), "
    "n AS (SELECT q.*, a.id AS id_a, b.id AS id_b, least(a.id, b.id) AS lo, greatest(a.id, b.id) AS hi FROM q LEFT JOIN h a ON a.lang = q.lang AND a.phrase = q.canonical LEFT JOIN h b ON b.lang = q.lang AND b.phrase = q.synonym) "
    "SELECT lang, canonical, synonym, id_a, id_b, CASE WHEN id_a IS NULL THEN 'no canonical' WHEN id_b IS NULL THEN 'no synonym' WHEN id_a = id_b THEN 'one concept' WHEN EXISTS (SELECT 1 FROM k WHERE k.lo = n.lo AND k.hi = n.hi) THEN 'linked' WHEN row_number() OVER (PARTITION BY lo, hi ORDER BY lang, canonical, synonym) > 1 THEN 'repeated' END AS reason FROM n"
)
def synonym_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbouring parts' names as pairs of synonyms; every eleventh is no stored phrase."""
    part = read(spark, sf_dir, "part")
    phrases = part.select(F.col("p_partkey").alias("id"), F.when(F.col("p_size") % 2 == 0, "en").otherwise("lt").alias("lang"), F.col("p_name").alias("phrase"))
    other = phrases.select((F.col("id") - 1).alias("id"), F.when(F.col("id") % 11 == 0, F.concat("phrase", F.lit(" x"))).otherwise(F.col("phrase")).alias("synonym"))
    pairs = phrases.withColumnRenamed("phrase", "canonical").join(other, "id")
    return store.link_synonyms(phrases, pairs, part.select(F.col("p_partkey").alias("id_a"), F.col("p_size").cast("long").alias("id_b")))


@query("SELECT DISTINCT lang FROM documents INTERSECT SELECT DISTINCT lang FROM documents WHERE source = 'src1'")
def common_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("lang", "source")
    return store.common_values(docs, docs.where("source = 'src1'"), "lang")


@query("WITH p AS (SELECT p_partkey // 3 AS k, CASE p_partkey % 3 WHEN 0 THEN 'en' WHEN 1 THEN 'fr' ELSE 'lt' END AS lang, p_name, p_partkey FROM part) SELECT k, min_by(p_name, p_partkey) FILTER (WHERE lang = 'en') AS en, min_by(p_name, p_partkey) FILTER (WHERE lang = 'fr') AS fr, min_by(p_name, p_partkey) FILTER (WHERE lang = 'lt') AS lt FROM p GROUP BY k")
def cross_language_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("p_partkey") % 3
    rows = read(spark, sf_dir, "part").select(F.expr("p_partkey div 3").alias("k"), F.when(m == 0, "en").when(m == 1, "fr").otherwise("lt").alias("lang"), "p_name", F.col("p_partkey").alias("ord"))
    return store.paired_by_language(rows, "k", ["en", "fr", "lt"], "p_name")


@query(
    f"WITH {_DIVERGE.format(key='p_name', d='p_type', id='p_partkey', t='part')}, c AS (SELECT a.id AS id_a, b.id AS id_b FROM n a JOIN n b ON a.k = b.k AND a.id < b.id), "
    "ph AS (SELECT p_partkey AS id, 'en: ' || p_name AS phrases FROM part), src AS (SELECT l_partkey AS id, string_agg(DISTINCT l_suppkey::VARCHAR, ', ' ORDER BY l_suppkey::VARCHAR) AS sources FROM lineitem GROUP BY l_partkey) "
    "SELECT id_a, id_b, x.phrases AS phrases_a, y.phrases AS phrases_b, s.sources AS sources_a, t.sources AS sources_b FROM c JOIN ph x ON x.id = id_a JOIN ph y ON y.id = id_b LEFT JOIN src s ON s.id = id_a LEFT JOIN src t ON t.id = id_b"
)
def conflict_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = text_divergence_pairs(spark, sf_dir).select("id_a", "id_b")
    phrases = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.lit("en").alias("lang"), F.col("p_name").alias("phrase"))
    sources = read(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("id"), F.col("l_suppkey").cast("string").alias("source"))
    return store.conflict_details(pairs, phrases, sources).select("id_a", "id_b", "phrases_a", "phrases_b", "sources_a", "sources_b")


@query("SELECT source_type, count(*) AS n FROM (SELECT CASE WHEN page_id % 5 = 0 THEN 'wco_glossary' WHEN page_id % 5 IN (1, 2) THEN 'statistical_mwe' ELSE CASE WHEN coalesce(url, '') <> '' THEN 'normative' ELSE 'statistical_mwe' END END AS source_type FROM pages) x GROUP BY 1")
def source_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_backfill(spark, sf_dir).groupBy("source_type").agg(F.count("*").alias("n"))


_AREAS = "['law', 'tariff_regulation', 'non_tariff_regulation', 'customs_procedures', 'origin', 'classification', 'valuation', 'cross_cutting']"


@query(
    f"WITH r AS (SELECT l_partkey AS id, ({_AREAS})[l_suppkey % 8 + 1] AS area FROM lineitem), c AS (SELECT id, a.area, count(r.area) FILTER (WHERE r.area = a.area) AS d FROM r, unnest(({_AREAS})[1:7]) AS a(area) GROUP BY ALL), "
    f"m AS (SELECT id, max(d) AS top FROM c GROUP BY id), s AS (SELECT c.id, string_agg(CASE WHEN top > 0 THEN upper(to_hex(least(15, floor(16.0 * d / top)::BIGINT))) ELSE '0' END, '' ORDER BY list_position({_AREAS}, area)) AS sig FROM c JOIN m USING (id) GROUP BY c.id) SELECT p_partkey AS id, sig AS area_signature FROM part LEFT JOIN s ON s.id = p_partkey"
)
def signature_recompute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Concepts without attestation lose their signature."""
    from glossmill.functions.scores import AREAS, CROSS_CUTTING

    names = F.array(*[F.lit(x) for x in (*AREAS, CROSS_CUTTING)])
    rows = read(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("id"), F.get(names, (F.col("l_suppkey") % 8).cast("int")).alias("area"), F.lit(1).alias("doc_count"))
    concepts = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.lit("stale").alias("area_signature"))
    return store.recompute_signatures(concepts, rows, null_empty=True)


@query("WITH p AS (SELECT p_partkey AS id, p_name AS phrase, CASE WHEN p_size % 2 = 0 THEN p_brand END AS domain FROM part) SELECT phrase, min_by(coalesce(domain, 'store'), id) AS domain FROM p GROUP BY phrase")
def cross_domain_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part")
    return store.first_domain(part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("phrase"), F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).alias("domain"), F.lit("store").alias("store")))
