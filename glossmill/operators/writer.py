"""Upserts of approved candidates into a store of concepts: snapshots in, snapshots out.

A store is four tables: concepts (CONCEPT), their phrases (PHRASE), where they occurred (OCCURRENCE) and their
documents by area (ATTESTATION). A record belongs to the concept, the least id of equals, that has its phrase and
language; the first record, by `ord`, of a phrase that no concept has opens one. Records without a phrase, a language
or an `ord` belong to none and are left out. Every step is a join or an aggregation by key; no table is gathered.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossmill.functions import scores
from glossmill.operators.areas import area_counts
from glossmill.operators.store import placed
from glossmill.scratch import settled

CONCEPT = "id long, scope string, status string, promotable boolean, first_seen_source string, domain string, area_signature string"
PHRASE = "id long, lang string, phrase string, phrase_normalized string, phrase_base string, pos_pattern string"
OCCURRENCE = "id long, source_doc string, source_lang string, clause_ref string"
ATTESTATION = "id long, area string, doc_count long, frequency long, source_file string"
KEY = ["phrase_normalized", "lang"]


@dataclass(frozen=True)
class Store:
    concepts: DataFrame
    phrases: DataFrame
    occurrences: DataFrame
    attestation: DataFrame


def approved() -> Column:
    """Only a plain true counts."""
    return F.coalesce(F.col("approved") == "true", F.lit(False))


def pending() -> Column:
    """Neither approved nor rejected."""
    return ~F.coalesce(F.col("approved").isin("true", "rejected"), F.lit(False))


def targets(store: Store, records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """records (ord, lang, phrase, phrase_normalized, pos_pattern, first_source, ...) with their concept's id; and the new phrases' rows."""
    held = store.phrases.groupBy(*KEY).agg(F.min("id").alias("id"))
    whole = records.dropna(subset=["ord", *KEY])
    opened = whole.join(held, KEY, "left_anti").groupBy(*KEY).agg(F.min_by(F.struct("ord", "phrase", "pos_pattern", "first_source"), "ord").alias("r")).select(*KEY, "r.*")
    top = store.concepts.agg(F.coalesce(F.max("id"), F.lit(0)).alias("top"))
    fresh = placed(opened, [F.col("ord"), *map(F.col, KEY)]).join(F.broadcast(top)).withColumn("id", F.col("top") + F.col("place"))
    fresh = settled(fresh.drop("top", "place", "ord"), "fresh")
    ids = held.unionByName(fresh.select(*KEY, "id"))
    return whole.join(ids, KEY), fresh


def upsert(store: Store, records: DataFrame, domain: str, signatures: bool) -> Store:
    """The store with records (as for `targets`, with occurrences and attestation as arrays of structs).

    Statuses rise with the distinct sources and never fall. An attestation row whose area and source file the
    concept has, or an earlier record brought, is ignored; one without an area is none. With `signatures` those
    of all concepts met are computed anew.
    """
    met, fresh = targets(store, records)
    met = settled(met, "met")
    phrases = store.phrases.unionByName(fresh.select("id", "lang", "phrase", "phrase_normalized", F.split("phrase_normalized", " ")[0].alias("phrase_base"), "pos_pattern"))
    seen = met.select("id", "lang", F.explode("occurrences").alias("o")).select("id", F.coalesce("o.source_doc", F.lit("")).alias("source_doc"), F.col("lang").alias("source_lang"), "o.clause_ref")
    occurrences = settled(store.occurrences.unionByName(seen), "occurrences")
    came = met.select("id", "ord", F.posexplode("attestation").alias("at", "a")).select("id", "ord", "at", "a.*").where("area <> ''")
    values = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    came = came.select("id", "ord", "at", "area", "source_file", values("doc_count"), values("frequency"))
    unique = ["id", "area", "source_file"]
    first = came.where("source_file is not null").groupBy(*unique).agg(F.min_by(F.struct("doc_count", "frequency"), F.struct("ord", "at")).alias("v")).select(*unique, "v.*").join(store.attestation.select(*unique), unique, "left_anti")
    attestation = settled(store.attestation.unionByName(first).unionByName(came.where("source_file is null").drop("ord", "at")), "attestation")
    new = fresh.select("id", F.lit("document_specific").alias("scope"), F.lit("emerging").alias("status"), F.lit(False).alias("promotable"), F.coalesce("first_source", F.lit("")).alias("first_seen_source"), F.lit(domain).alias("domain"), F.lit(None).cast("string").alias("area_signature"))
    touched = met.select("id").distinct()
    sources = occurrences.join(touched, "id", "left_semi").select("id", "source_doc").distinct().groupBy("id").agg(F.count("*").alias("n"))
    concepts = store.concepts.unionByName(new).join(sources, "id", "left")
    risen = F.coalesce(F.col("n") >= 2, F.lit(False))
    concepts = concepts.withColumns({"scope": F.when(risen, "domain").otherwise(F.col("scope")), "status": F.when(risen, scores.lifecycle(F.col("n"))).otherwise(F.col("status")), "promotable": risen | F.col("promotable")}).drop("n")
    if signatures:
        counts = touched.join(attestation, "id", "left").groupBy("id").agg(*[c.alias(f"d_{a}") for a, c in area_counts().items()])
        now = counts.select("id", scores.area_signature([F.col(f"d_{a}") for a in scores.AREAS]).alias("_now"))
        concepts = concepts.join(now, "id", "left").withColumn("area_signature", F.coalesce("_now", "area_signature")).drop("_now")
    return Store(settled(concepts, "concepts"), settled(phrases, "phrases"), occurrences, attestation)


def overridden(records: DataFrame, overrides: DataFrame | None) -> DataFrame:
    """records with the phrases that overrides (lang, phrase_normalized, new_phrase, new_normalized) give them, before they meet the store."""
    if overrides is None:
        return records
    one = overrides.groupBy("lang", "phrase_normalized").agg(F.last(F.struct("new_phrase", "new_normalized")).alias("_new"))
    found = records.join(one, ["lang", "phrase_normalized"], "left")
    return found.withColumns({"phrase": F.coalesce("_new.new_phrase", "phrase"), "phrase_normalized": F.coalesce("_new.new_normalized", "phrase_normalized")}).select(*records.columns)


def upsert_statistical(store: Store, candidates: DataFrame, domain: str, overrides: DataFrame | None = None) -> Store:
    """candidates (ord, phrase, lang, source_file, frequency): an occurrence for each; no attestation, no signatures."""
    note = F.concat(F.lit("statistical_pmi_freq"), F.coalesce("frequency", F.lit(0)).cast("string"))
    records = candidates.select(
        "ord", "lang", "phrase", F.lower("phrase").alias("phrase_normalized"), F.lit(None).cast("string").alias("pos_pattern"), F.col("source_file").alias("first_source"),
        F.array(F.struct(F.col("source_file").alias("source_doc"), note.alias("clause_ref"))).alias("occurrences"),
        F.expr("cast(array() as array<struct<area:string,doc_count:long,frequency:long,source_file:string>>)").alias("attestation"),
    )
    return upsert(store, overridden(records, overrides), domain, signatures=False)


def upsert_merged(store: Store, merged: DataFrame, domain: str, overrides: DataFrame | None = None) -> Store:
    """merged (ord, phrase_normalized, lang, attestation[, phrase, phrase_inflected, pos_pattern]): an occurrence for each row of the attestation."""
    given = lambda c: F.when(F.col(c) != "", F.col(c)) if c in merged.columns else F.lit(None).cast("string")
    note = lambda a: F.concat(F.lit("area:"), F.coalesce(a["area"], F.lit("?")), F.lit(" freq"), F.coalesce(a["frequency"], F.lit(0)).cast("string"))
    rows = F.coalesce("attestation", F.array())
    records = merged.select(
        "ord", "lang", F.coalesce(given("phrase"), given("phrase_inflected"), F.col("phrase_normalized")).alias("phrase"), "phrase_normalized", given("pos_pattern").alias("pos_pattern"), F.get(rows, F.lit(0))["source_file"].alias("first_source"),
        F.transform(rows, lambda a: F.struct(a["source_file"].alias("source_doc"), note(a).alias("clause_ref"))).alias("occurrences"),
        rows.alias("attestation"),
    )
    return upsert(store, overridden(records, overrides), domain, signatures=True)


def write_batch(store: Store, merged: DataFrame, statistical: DataFrame, domain: str, overrides: DataFrame | None = None) -> Store:
    """Approved merged candidates first, then approved statistical ones, which may meet the concepts just opened."""
    return upsert_statistical(upsert_merged(store, merged.where(approved()), domain, overrides), statistical.where(approved()), domain, overrides)


def empty_store(spark) -> Store:
    return Store(*[spark.createDataFrame([], schema) for schema in (CONCEPT, PHRASE, OCCURRENCE, ATTESTATION)])
