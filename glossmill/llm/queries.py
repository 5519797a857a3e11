"""The queries opN_<name> and the query pipeline, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmill.llm.common import table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from glossmill.llm.simhash import hex_of, near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", hex_of(found["fp"]).alias("fingerprint"), "component_id")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from glossmill.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"))


def op3_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    from glossmill.llm.media import media_columns

    return media_columns(table(spark, sf_dir, "documents")).drop("cosine_bits")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from glossmill.llm.urls import judge

    return judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from glossmill.llm.quality import quality

    judged = quality(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from glossmill.llm.pieces import digests

    return digests(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from glossmill.llm.warc import read_archive, write_archive

    return read_archive(write_archive(table(spark, sf_dir, "pages")))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from glossmill.llm.suffixes import dedup

    kept = dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from glossmill.llm.lines import dedup

    kept = dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_removed_lines", "n_removed_chunks", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from glossmill.llm.toxicity import fit, held_out, score

    documents = table(spark, sf_dir, "documents")
    found = score(documents, fit(documents, table(spark, sf_dir, "labels")))
    return found.select("doc_id", held_out(found["doc_id"]).alias("held_out"), "score", "predicted")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from glossmill.llm.alignment import align

    return align(table(spark, sf_dir, "documents"))


def op12_click_throttling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from glossmill.llm.throttle import throttle

    return throttle(table(spark, sf_dir, "clicks"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from glossmill.llm.languages import fit, held_out, predict

    documents = table(spark, sf_dir, "documents")
    found = predict(documents, fit(documents))
    return found.select("doc_id", held_out(found["doc_id"]).alias("held_out"), "lang_pred", "score")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpus_pipeline import run

    return run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_simhash, op2_packing, op3_media_columns, op4_url_filter, op5_quality_rules, op6_sentencepiece, op7_warc, op8_suffix_dedup, op9_line_dedup, op10_toxicity, op11_alignment, op12_click_throttling, op13_language_id, pipeline)
}

ORACLES: dict[str, str] = {
    "op8_suffix_dedup": """
        WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        w AS (SELECT doc_id, p, substring(h, 2 * p + 1, 200) AS s FROM b, unnest(range(0, greatest(length(h) // 2 - 99, 0))) AS u(p)),
        c AS (SELECT x FROM (SELECT hash(s) AS x FROM w) y GROUP BY x HAVING count(*) > 1),
        d AS (SELECT doc_id, p FROM (SELECT * FROM w WHERE hash(s) IN (SELECT x FROM c)) z QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, p) > 1),
        i AS (SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 100 THEN 0 ELSE 1 END AS fresh FROM d),
        g AS (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM i),
        s AS (SELECT doc_id, min(p) AS a, max(p) + 100 AS z FROM g GROUP BY doc_id, k),
        l AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS y FROM s),
        r AS (SELECT l.doc_id, count(*) AS n_spans, sum(z - a)::BIGINT AS n_removed, max(z) AS last, string_agg(substring(h, 2 * y + 1, 2 * (a - y)), '' ORDER BY a) AS kept FROM l JOIN b USING (doc_id) GROUP BY l.doc_id)
        SELECT b.doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
               sha256(unhex(coalesce(kept, '') || substring(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
        FROM b LEFT JOIN r USING (doc_id)
    """,
    "op7_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d FROM pages),
             h AS (SELECT d, n, max(page_id) AS holder FROM p WHERE n >= 1000 GROUP BY d, n)
        SELECT p.page_id, p.n::BIGINT AS payload_bytes, p.d AS payload_digest,
               CASE WHEN holder IS NOT NULL AND holder <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN holder IS NOT NULL AND holder <> page_id THEN holder END AS refers_to
        FROM p LEFT JOIN h ON p.d = h.d AND p.n = h.n
    """,
    "op5_quality_rules": r"""
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM t),
        win AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM w, unnest(range(1, len(ws) - 1)) AS u(i)),
        rep AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
        cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, unnest([0, 1, 2]) AS v(k) GROUP BY doc_id),
        b AS (SELECT w.doc_id, text, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
                     length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
                     (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls) AS n_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
                     len(list_filter(ls, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[*\x{2022}-]'))) AS n_bullets, len(list_filter(ls, lambda x: regexp_matches(x, '(\.\.\.|\x{2026})[\x20\x09-\x0D]*$'))) AS n_ellipses
              FROM w LEFT JOIN cov USING (doc_id)),
        f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT (base_failed OR word_chars NOT BETWEEN 2 * n_words AND 15 * n_words OR 10 * n_symbols > 3 * n_words
                    OR 10 * n_dup_lines > 7 * n_lines OR 100 * n_repeat_words > 45 * n_words
                    OR 2 * length(regexp_replace(text, '[^\p{L}]+', '', 'g')) < word_chars
                    OR 4 * word_chars < length(text) OR contains(lower(text), 'lorem ipsum')
                    OR 10 * n_bullets > 9 * n_lines OR 10 * n_ellipses > 3 * n_lines OR regexp_matches(text, '[^\x20\x09-\x0D]{1000}')) AS kept
        FROM f
    """,
}
