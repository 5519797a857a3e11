"""The domain store: snapshots in, snapshots out. Every write is a DataFrame to append or a new snapshot."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glossmill.functions import scores
from glossmill.functions.text import normalise_definition
from glossmill.scratch import settled


def insert_or_ignore(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of new to append: one per key, none whose key exists. A null in a key collides with nothing."""
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    fresh = new.where(whole).dropDuplicates(keys).unionByName(new.where(~whole))
    return fresh.join(existing.select(*keys).distinct(), keys, "left_anti")


def append_except_keys(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of new whose key does not exist; the batch itself is not deduplicated."""
    return new.join(existing.select(*keys).distinct(), keys, "left_anti")


def source_counts(occurrences: DataFrame, concept: str, source: str) -> DataFrame:
    """Distinct sources of each concept, from distinct pairs first so that no set is ever gathered."""
    return occurrences.select(concept, source).distinct().groupBy(concept).agg(F.count(source).alias("n_sources"))


def with_lifecycle(concepts: DataFrame, counts: DataFrame, concept: str) -> DataFrame:
    current = F.col("status") if "status" in concepts.columns else None
    joined = concepts.join(counts, concept, "left").withColumn("n_sources", F.coalesce("n_sources", F.lit(0)))
    return joined.withColumn("status", scores.lifecycle(F.col("n_sources"), current))


def divergences(entries: DataFrame, key: list[str], ident: str, definition: str) -> DataFrame:
    """Pairs (a < b) of entries of one key whose definitions differ.

    Pairs grow with the square of a key's entries only where the definitions themselves all differ: entries
    are grouped by definition first, and the pairs are between groups' smallest entries.
    """
    groups = entries.withColumn("_norm", normalise_definition(F.col(definition))).groupBy(*key, "_norm").agg(F.min(F.struct(ident, definition)).alias("x"))
    a = groups.select(*key, F.col(f"x.{ident}").alias("id_a"), F.substring(f"x.{definition}", 1, 100).alias("text_a"))
    b = groups.select(*key, F.col(f"x.{ident}").alias("id_b"), F.substring(f"x.{definition}", 1, 100).alias("text_b"))
    return a.join(b, key).where("id_a < id_b").withColumn("divergence_detail", F.concat(F.lit("A: "), F.coalesce("text_a", F.lit("")), F.lit(" | B: "), F.coalesce("text_b", F.lit(""))))


def cross_domain(a: DataFrame, b: DataFrame, key: list[str], ident: str, definition: str) -> DataFrame:
    """Entries of one key in two domains whose definitions differ; a's last entry (by id) stands for it."""
    last = a.groupBy(*key).agg(F.max_by(definition, ident).alias("definition_a"))
    joined = last.join(b.select(*key, F.col(ident).alias("id_b"), F.col(definition).alias("definition_b")), key)
    na, nb = normalise_definition(F.col("definition_a")), normalise_definition(F.col("definition_b"))
    return joined.where(na != nb).withColumn("incomplete", (na == "") | (nb == ""))


def synonym_edges(pairs: DataFrame) -> DataFrame:
    """Undirected edges without loops or repeats."""
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()


def synonym_map(edges: DataFrame, phrases: DataFrame) -> DataFrame:
    """phrase -> the phrase it stands for, one hop; the smallest edge wins."""
    left = phrases.select(F.col("id").alias("a"), F.col("phrase").alias("canonical"))
    right = phrases.select(F.col("id").alias("b"), F.col("phrase").alias("variant"))
    return edges.join(left, "a").join(right, "b").groupBy("variant").agg(F.min_by("canonical", F.struct("a", "b")).alias("canonical"))


def apply_overrides(records: DataFrame, overrides: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Replaces fields by the last override (by ord) of the record's key, where it states one."""
    last = overrides.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(f) for f in fields]), "ord").alias("o"))
    joined = records.join(last, keys, "left")
    return joined.withColumns({f: F.coalesce(F.col(f"o.{f}"), F.col(f)) for f in fields}).drop("o")


def optional_match(pairs: list[tuple[Column, Column]]) -> Column:
    """Criteria of an override: one that is null holds for every record."""
    return reduce(lambda a, b: a & b, [m.isNull() | (m == r) for m, r in pairs])


def numeric_then_text(key: str) -> list[Column]:
    """Sort keys: whole numbers first by value, then texts."""
    number = F.expr(f"try_cast(`{key}` as bigint)")
    return [number.isNull(), number, F.col(key)]


def placed(df: DataFrame, order: list[Column]) -> DataFrame:
    """df with `place`, 1 for the first row in the order. Rows stay dealt by range; only the parts' sizes are gathered."""
    ordered = settled(df.orderBy(*order).withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), "placed")
    sizes = sorted((r["_part"], r["n"], r["low"]) for r in ordered.groupBy("_part").agg(F.count("*").alias("n"), F.min("_at").alias("low")).collect())
    before, total = [], 0
    for part, n, low in sizes:
        before.append((part, total - low))
        total += n
    shifts = df.sparkSession.createDataFrame(before, "_part int, _shift long")
    return ordered.join(F.broadcast(shifts), "_part").withColumn("place", F.col("_at") + F.col("_shift") + 1).drop("_part", "_at", "_shift")


def link_synonyms(phrases: DataFrame, pairs: DataFrame, links: DataFrame) -> DataFrame:
    """pairs (lang, canonical, synonym) with id_a, id_b and reason: null where the pair is to be linked, else why it is not.

    A phrase's concept is the least id (id, lang, phrase) that has it. Reasons, the first that holds: no canonical, no synonym, one
    concept, linked (links: id_a, id_b, either way), repeated (a pair that names the same two concepts comes before it by its phrases).
    """
    held = phrases.groupBy("lang", "phrase").agg(F.min("id").alias("id"))
    side = lambda name, as_: held.select("lang", F.col("phrase").alias(name), F.col("id").alias(as_))
    named = pairs.select("lang", "canonical", "synonym").distinct().join(side("canonical", "id_a"), ["lang", "canonical"], "left").join(side("synonym", "id_b"), ["lang", "synonym"], "left")
    ends = lambda df: df.withColumn("_low", F.least("id_a", "id_b")).withColumn("_high", F.greatest("id_a", "id_b"))
    known = ends(links).select("_low", "_high", F.lit(True).alias("_known")).distinct()
    first = ends(named).where("id_a <> id_b").groupBy("_low", "_high").agg(F.min(F.struct("lang", "canonical", "synonym")).alias("_first"))
    found = ends(named).join(known, ["_low", "_high"], "left").join(first, ["_low", "_high"], "left")
    reason = F.when(F.col("id_a").isNull(), "no canonical").when(F.col("id_b").isNull(), "no synonym").when(F.col("id_a") == F.col("id_b"), "one concept").when(F.col("_known"), "linked").when(F.col("_first") != F.struct("lang", "canonical", "synonym"), "repeated")
    return found.select("lang", "canonical", "synonym", "id_a", "id_b", reason.alias("reason"))


def standing(log: DataFrame, by: list[str], order: str = "ts", action: str = "action") -> DataFrame:
    """The actions of a log that no undo has taken back. Each undo takes back the last action of its `by` that still stands, or nothing.

    Actions open brackets and undos close them. An action's depth is the running sum of both, held at zero from below; it is taken
    back if the depth falls below its own later on, which a running least depth from the end shows.
    """
    along = Window.partitionBy(*by).orderBy(order)
    behind = Window.partitionBy(*by).orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, -1)
    sums = log.withColumn("_sum", F.sum(F.when(F.col(action) == "undo", -1).otherwise(1)).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    depth = F.col("_sum") - F.least(F.lit(0), F.min("_sum").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    later = sums.withColumn("_depth", depth).withColumn("_later", F.min("_depth").over(behind))
    return later.where((F.col(action) != "undo") & (F.coalesce("_later", "_depth") >= F.col("_depth"))).drop("_sum", "_depth", "_later")


def decided(log: DataFrame, record: str = "record_key", session: list[str] | None = None) -> DataFrame:
    """State of each record from a log (record_key, action, ts): its last action that stands.

    Undos take back actions of their record; with `session` (columns) those of their session, whichever record they were on, and
    need no record themselves.
    """
    return standing(log, session or [record]).groupBy(record).agg(F.max_by("action", "ts").alias("action"))


def backfill_source(df: DataFrame, source: str) -> DataFrame:
    """source_type, definition_status and authority from the first source's name."""
    s = F.col(source)
    held = F.instr(F.coalesce(s, F.lit("")), "#") > 0
    return df.withColumns(
        {
            "source_type": F.when(s.startswith("wco-glossary/"), "wco_glossary").when(F.coalesce(s, F.lit("")) != "", "normative").otherwise("statistical_mwe"),
            "definition_status": F.when(F.coalesce(s, F.lit("")) == "", "undefined").otherwise("defined"),
            "authority": F.when(held, F.substring_index(s, "#", 1)).otherwise(s),
        }
    )


def upsert_definitions(store: DataFrame, batch: DataFrame) -> DataFrame:
    """Classifies a batch (group, lang, phrase, definition, source) against the store (id, lang, phrase, definition).

    action: merge (the same definition in that language), add_lang (the group's concept lacks the language),
    conflict (another definition) or new. A group's concept is the first stored row, by id, that has the
    phrase and language of one of its records with an equal definition.
    """
    first = store.groupBy("lang", "phrase").agg(F.min_by(F.struct("id", "definition"), "id").alias("s"))
    probe = batch.join(first, ["lang", "phrase"]).where(normalise_definition(F.col("definition")) == normalise_definition(F.col("s.definition")))
    concept = probe.groupBy("group").agg(F.min("s.id").alias("concept_id"))
    held = store.groupBy("id", "lang").agg(F.min("definition").alias("stored"))
    joined = batch.join(concept, "group", "left").join(held.select(F.col("id").alias("concept_id"), "lang", "stored"), ["concept_id", "lang"], "left")
    same = normalise_definition(F.col("definition")) == normalise_definition(F.col("stored"))
    action = F.when(F.col("concept_id").isNull(), "new").when(F.col("stored").isNull(), "add_lang").when(same, "merge").otherwise("conflict")
    return joined.withColumn("action", action)


def common_values(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    return a.select(column).intersect(b.select(column))


def paired_by_language(records: DataFrame, key: str, langs: list[str], value: str) -> DataFrame:
    """One row per key with the first value (by ord) of each language."""
    return records.groupBy(key).agg(*[F.min_by(F.when(F.col("lang") == x, F.col(value)), F.when(F.col("lang") == x, F.col("ord"))).alias(x) for x in langs])


def conflict_details(conflicts: DataFrame, phrases: DataFrame, sources: DataFrame) -> DataFrame:
    """conflicts (id_a, id_b) with the phrases, ordered by language, and the distinct sources of both sides."""
    named = phrases.groupBy("id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("lang", "phrase"))), lambda x: F.concat_ws(": ", x["lang"], x["phrase"])), "; ").alias("phrases"))
    seen = sources.select("id", "source").distinct().groupBy("id").agg(F.array_join(F.sort_array(F.collect_list("source")), ", ").alias("sources"))
    both = named.join(seen, "id", "left")
    out = conflicts
    for side in ("a", "b"):
        out = out.join(both.withColumnsRenamed({"id": f"id_{side}", "phrases": f"phrases_{side}", "sources": f"sources_{side}"}), f"id_{side}", "left")
    return out


def recompute_signatures(concepts: DataFrame, rows: DataFrame, null_empty: bool = False) -> DataFrame:
    """concepts (id, area_signature) with the signature of their attestation (id, area, doc_count)."""
    from glossmill.operators.areas import area_counts

    counts = rows.groupBy("id").agg(*[c.alias(f"d_{a}") for a, c in area_counts().items()])
    fresh = counts.select("id", scores.area_signature([F.col(f"d_{a}") for a in scores.AREAS]).alias("_fresh"))
    kept = F.lit(None).cast("string") if null_empty else F.col("area_signature")
    return concepts.join(fresh, "id", "left").withColumn("area_signature", F.coalesce("_fresh", kept)).drop("_fresh")


def first_domain(phrases: DataFrame) -> DataFrame:
    """phrase and the domain of its first concept (by id); without one, the name of the store."""
    return phrases.groupBy("phrase").agg(F.min_by(F.coalesce("domain", "store"), "id").alias("domain"))
