"""Inputs and SQL fragments that the queries share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmill.functions.scores import AREAS, CROSS_CUTTING
from glossmill.operators import coverage, tokens


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """df over as many partitions as there are cores at least. A scan that has as many, as any large table's does, stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spread(read(spark, sf_dir, "documents").select(*(columns or ("doc_id", "text"))))


def area_of(source: Column) -> Column:
    """src0 to src6 are the canonical areas in order, all others cross-cutting."""
    out = None
    for i, a in enumerate(AREAS):
        out = F.when(source == f"src{i}", a) if out is None else out.when(source == f"src{i}", a)
    return out.otherwise(CROSS_CUTTING)


def mined(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return tokens.mined_sentences(documents(spark, sf_dir, *(columns or ("doc_id", "text"))))


def benchmark_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domain phrases: distinct windows of two and three words in the benchmark's texts."""
    from glossmill.operators.ngrams import windows

    words = read(spark, sf_dir, "benchmark").select(tokens.words_of(F.col("text")).alias("words"))
    return words.select(F.explode(F.concat(windows(F.col("words"), 2), windows(F.col("words"), 3))).alias("phrase")).distinct()


def word_doc_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = documents(spark, sf_dir).select(F.explode(F.array_distinct(tokens.words_of(F.col("text")))).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("doc_count"))


def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 1,000 words in most documents: tier 1 to 100, tier 2 to 500, tier 3 the rest. Bounded, so it is broadcast."""
    return F.broadcast(coverage.ranked_lexicon(word_doc_counts(spark, sf_dir)))


def runs(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return tokens.token_runs(documents(spark, sf_dir, *(columns or ("doc_id", "text"))))


# SQL fragments: each is one or more common table expressions.

STOP_SQL = "[" + ", ".join(f"'{w}'" for w in tokens.STOP_WORDS) + "]"
SPLIT_SQL = r"string_split(regexp_replace({0}, '([.!?])[ \t\n\r\x0B\f]+', '\1' || chr(1), 'g'), chr(1))"
SENTENCES_SQL = (
    "sents AS (SELECT doc_id, source, lang, i - 1 AS sent_idx, l[i] AS sentence FROM (SELECT doc_id, source, lang, "
    + SPLIT_SQL.format("text")
    + " AS l FROM documents) d, unnest(range(1, len(l) + 1)) AS u(i))"
)
MINED_SQL = SENTENCES_SQL + r", mined AS (SELECT * FROM (SELECT doc_id, source, lang, sent_idx, list_filter(regexp_extract_all(lower(sentence), '\p{L}+'), lambda w: NOT list_contains(" + STOP_SQL + ", w)) AS words FROM sents) x WHERE len(words) > 0)"
UNI_SQL = "uni AS (SELECT word, count(*) AS freq FROM (SELECT unnest(words) AS word FROM mined) x GROUP BY word), tot AS (SELECT sum(freq) AS n FROM uni)"


def grams_sql(name: str, n: int, source: str = "mined", keep: str = "doc_id") -> str:
    return f"{name} AS (SELECT {keep}, array_to_string(words[i:i + {n - 1}], ' ') AS phrase FROM {source}, unnest(range(1, len(words) - {n} + 2)) AS u(i))"


PHRASES_SQL = (
    r"bw AS (SELECT regexp_extract_all(lower(text), '\p{L}+') AS words FROM benchmark), "
    "phrases AS (SELECT DISTINCT array_to_string(words[i:i + n - 1], ' ') AS phrase, n FROM bw, unnest([2, 3]) AS k(n), unnest(range(1, len(words) - n + 2)) AS u(i))"
)
LEXICON_SQL = (
    r"dc AS (SELECT word, count(*) AS doc_count FROM (SELECT unnest(list_distinct(regexp_extract_all(lower(text), '\p{L}+'))) AS word FROM documents) x GROUP BY word), "
    "lex AS (SELECT word, CASE WHEN r <= 100 THEN 1 WHEN r <= 500 THEN 2 ELSE 3 END AS tier FROM (SELECT word, row_number() OVER (ORDER BY doc_count DESC, word) AS r FROM dc) x WHERE r <= 1000)"
)
RUNS_SQL = SENTENCES_SQL + r", runs AS (SELECT doc_id, source, lang, sent_idx, j - 1 AS run_idx, regexp_extract_all(rs[j], '\p{L}+') AS words FROM (SELECT *, regexp_extract_all(lower(sentence), '\p{L}+(?:[ \t\n\r\x0B\f]+\p{L}+)*') AS rs FROM sents) s, unnest(range(1, len(rs) + 1)) AS u(j))"


def matches_sql(keys: str = "doc_id, sent_idx, run_idx") -> str:
    """Chosen matches of runs: (keys, pos, len, phrase), pos from 0; recursion walks each run's matches in order."""
    ks = [k.strip() for k in keys.split(",")]
    on = " AND ".join(f"m.{k} = w.{k}" for k in ks)
    return (
        f"cand AS (SELECT {keys}, i - 1 AS pos, n AS len, array_to_string(words[i:i + n - 1], ' ') AS phrase FROM runs, unnest([2, 3]) AS k(n), unnest(range(1, len(words) - n + 2)) AS u(i)), "
        f"hits AS (SELECT c.*, row_number() OVER (PARTITION BY {', '.join('c.' + k for k in ks)} ORDER BY c.pos, c.len DESC) AS k FROM cand c JOIN phrases p ON c.phrase = p.phrase), "
        f"walk AS (SELECT {keys}, k, pos, len, phrase, TRUE AS chosen, pos + len AS free FROM hits WHERE k = 1 "
        f"UNION ALL SELECT {', '.join('m.' + k for k in ks)}, m.k, m.pos, m.len, m.phrase, m.pos >= w.free, CASE WHEN m.pos >= w.free THEN m.pos + m.len ELSE w.free END FROM walk w JOIN hits m ON {on} AND m.k = w.k + 1), "
        f"chosen AS (SELECT {keys}, pos, len, phrase FROM walk WHERE chosen)"
    )


UNITS_SQL = (
    "words AS (SELECT doc_id, source, lang, sent_idx, run_idx, i - 1 AS pos, words[i] AS word FROM runs, unnest(range(1, len(words) + 1)) AS u(i)), "
    "covered AS (SELECT doc_id, sent_idx, run_idx, pos + d AS pos FROM chosen, unnest(range(0, len)) AS u(d)), "
    "units AS (SELECT doc_id, sent_idx, run_idx, pos, phrase AS unit, 'TIER4' AS category FROM chosen UNION ALL "
    "SELECT w.doc_id, w.sent_idx, w.run_idx, w.pos, w.word, CASE WHEN tier IS NULL THEN 'UNKNOWN' ELSE 'TIER' || tier END FROM words w LEFT JOIN lex ON lex.word = w.word WHERE NOT EXISTS (SELECT 1 FROM covered c WHERE c.doc_id = w.doc_id AND c.sent_idx = w.sent_idx AND c.run_idx = w.run_idx AND c.pos = w.pos))"
)
AREA_SQL = "CASE source " + " ".join(f"WHEN 'src{i}' THEN '{a}'" for i, a in enumerate(AREAS)) + f" ELSE '{CROSS_CUTTING}' END"
