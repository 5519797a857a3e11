"""Scans of a lexicon and of domain stores kept in SQLite files: tiers, phrases, inflections, synonyms, and the older flat lexicon.

A store's tables have the columns named in LEXICON and DOMAIN. Filters and the columns asked for go to SQLite; what comes back
is lower case. A file that does not exist has no rows. Several stores are read in order; where a key stands in more than one,
the later one wins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmill.operators.lexicon import inflection_map, migrate_vocabulary
from glossmill.sources import sqlite
from glossmill.sources.files import found

#: Tables and their columns.
LEXICON = {"concept_lang": "concept_id long, lang string, word string, pos string, tier long, source string", "inflected_forms": "id long, lang string, inflected_word string, lemma string"}
DOMAIN = {"mwe_lang": "mwe_id long, lang string, phrase string, phrase_normalized string, definition_raw string", "mwe_conflict": "mwe_id_a long, mwe_id_b long, conflict_type string"}
FLAT = {"vocabulary": "id long, word string, pos string, tier long, source string, eo_word string"}


def _table(spark: SparkSession, path: str | None, name: str, columns: list[str]) -> DataFrame:
    whole = {**LEXICON, **DOMAIN, **FLAT}[name]
    if path is None or not found(spark, path):
        return spark.createDataFrame([], whole).select(*columns)
    return sqlite.read(spark, path, name, columns)


def tier_words(spark: SparkSession, path: str | None, lang: str, tiers: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """word and tier of a language; of several tiers of a word the lowest."""
    rows = _table(spark, path, "concept_lang", ["lang", "word", "tier"]).where((F.col("lang") == lang) & F.col("tier").isin(*tiers))
    return rows.groupBy(F.lower("word").alias("word")).agg(F.min("tier").cast("int").alias("tier"))


def phrases(spark: SparkSession, paths: list[str], lang: str) -> DataFrame:
    """Distinct normalised phrases of a language over all stores."""
    rows = [_table(spark, p, "mwe_lang", ["lang", "phrase_normalized"]).where(F.col("lang") == lang).select(F.col("phrase_normalized").alias("phrase")) for p in paths]
    none = spark.createDataFrame([], "phrase string")
    return reduce(DataFrame.unionByName, rows, none).distinct()


def inflections(spark: SparkSession, path: str | None, lang: str) -> DataFrame:
    """inflected and lemma of a language, without forms of themselves; the last of a form wins."""
    rows = _table(spark, path, "inflected_forms", ["id", "lang", "inflected_word", "lemma"]).where(F.col("lang") == lang)
    return inflection_map(rows)


def synonyms(spark: SparkSession, paths: list[str], lang: str) -> DataFrame:
    """phrase (normalised, of the second concept) and canonical (of the first) of synonym links; later stores win."""

    def of(path: str) -> DataFrame:
        links = _table(spark, path, "mwe_conflict", ["mwe_id_a", "mwe_id_b", "conflict_type"]).where(F.col("conflict_type") == "synonym")
        named = _table(spark, path, "mwe_lang", ["mwe_id", "lang", "phrase", "phrase_normalized"]).where(F.col("lang") == lang)
        a, b = named.select(F.col("mwe_id").alias("mwe_id_a"), F.col("phrase").alias("canonical")), named.select(F.col("mwe_id").alias("mwe_id_b"), F.col("phrase_normalized").alias("phrase"))
        return links.join(a, "mwe_id_a").join(b, "mwe_id_b").groupBy("phrase").agg(F.max_by("canonical", F.struct("mwe_id_a", "mwe_id_b")).alias("canonical"))

    rows = [of(p).withColumn("store", F.lit(i)) for i, p in enumerate(paths)]
    if not rows:
        return spark.createDataFrame([], "phrase string, canonical string")
    return reduce(DataFrame.unionByName, rows).groupBy("phrase").agg(F.max_by("canonical", "store").alias("canonical"))


def migrated(spark: SparkSession, path: str, target: str) -> None:
    """An older flat lexicon (table vocabulary) as concepts and their words in another file."""
    concepts, words = migrate_vocabulary(_table(spark, path, "vocabulary", ["id", "word", "pos", "tier", "source", "eo_word"]))
    sqlite.write(concepts.select("concept_id", "eo_word", "eo_pos", "eo_status"), target, "concepts", "overwrite")
    sqlite.write(words.select("concept_id", F.lit("en").alias("lang"), "word", "pos", "tier", "source"), target, "concept_lang", "overwrite")
