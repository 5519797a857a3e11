"""Groups of definitions written into a store, in batch order: snapshots in, snapshots out.

A group holds one concept's records in several languages. Groups are taken in order (g), their records by r. A group
meets the concept of the first of its records whose phrase and language have a row already and whose definition
equals that of the first such row; the row may be stored, or an earlier group of the same batch may have brought it.
A group that meets none opens a concept with all its records. In one that meets a concept a record adds its language
(no row has its phrase), merges (the first row's definition equals its own) or opens a concept of its own in conflict.

Batch order needs no loop over groups. Whatever a record's fate, its phrase has a row behind it, so the first row of a phrase
is the stored one or the batch's first record with it, and whether a group meets a concept follows from these heads alone.
Which concept that is may depend on what an earlier group has met, a chain of groups; chains are followed by pointer
doubling, in rounds that grow with the logarithm of the longest.

An override renames a record's phrase (and may give it another definition text) after the group has looked for its concept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossmill.functions import scores
from glossmill.functions.text import normalise_definition
from glossmill.operators.store import placed
from glossmill.scratch import settled

#: concepts as in the writer, rows in order of seq, occurrences, and conflicts of two concepts.
CONCEPT = "id long, scope string, status string, promotable boolean, first_seen_source string, domain string"
ROW = "seq long, id long, lang string, phrase string, definition string"
OCCURRENCE = "id long, lang string, source string"
CONFLICT = "id_a long, id_b long, detail string"
BATCH = "g long, r long, lang string, phrase string, definition string, source string"


@dataclass(frozen=True)
class Definitions:
    concepts: DataFrame
    rows: DataFrame
    occurrences: DataFrame
    conflicts: DataFrame


def empty(spark) -> Definitions:
    return Definitions(*[spark.createDataFrame([], schema) for schema in (CONCEPT, ROW, OCCURRENCE, CONFLICT)])


def renamed(batch: DataFrame, overrides: DataFrame | None) -> DataFrame:
    """batch with `asked` (the phrase a group looks by), `phrase` and `text` after overrides (lang, phrase, new_phrase, new_definition)."""
    out = batch.withColumn("asked", F.col("phrase")).withColumn("text", F.col("definition"))
    if overrides is None:
        return out
    last = overrides.groupBy("lang", "phrase").agg(F.last(F.struct("new_phrase", "new_definition")).alias("o"))
    return out.join(last, ["lang", "phrase"], "left").withColumns({"phrase": F.coalesce("o.new_phrase", "phrase"), "text": F.coalesce("o.new_definition", "definition")}).drop("o")


def heads(rows: DataFrame, batch: DataFrame) -> DataFrame:
    """The first row of each phrase and language: its concept where it is stored, else its group and record; and its definition."""
    held = rows.groupBy("lang", "phrase").agg(F.min_by(F.struct("id", "definition"), "seq").alias("s"))
    came = batch.groupBy("lang", "phrase").agg(F.min_by(F.struct("g", "r", F.col("text").alias("definition")), F.struct("g", "r")).alias("b"))
    both = held.join(came, ["lang", "phrase"], "full")
    stored = F.col("s").isNotNull()
    text = F.when(stored, F.col("s.definition")).otherwise(F.col("b.definition"))
    return both.select("lang", "phrase", F.col("s.id").alias("head_id"), F.when(~stored, F.col("b.g")).alias("head_g"), F.when(~stored, F.col("b.r")).alias("head_r"), text.alias("head_text"))


def met(batch: DataFrame, first: DataFrame) -> DataFrame:
    """g with `id`, the stored concept it meets, or `root`, the group that opened what it meets (itself where it opens one)."""
    asked = batch.join(first.withColumnRenamed("phrase", "asked"), ["lang", "asked"])
    fits = (normalise_definition(F.col("head_text")) == normalise_definition(F.col("definition"))) & (F.col("head_id").isNotNull() | (F.col("head_g") < F.col("g")))
    hit = asked.where(fits).groupBy("g").agg(F.min_by(F.struct(F.col("head_id").alias("id"), F.col("head_g").alias("root")), "r").alias("h"))
    found = batch.select("g").distinct().join(hit, "g", "left")
    opens = F.col("h").isNull()
    now = settled(found.select("g", F.col("h.id").alias("id"), F.when(opens, F.col("g")).otherwise(F.col("h.root")).alias("root"), (opens | F.col("h.id").isNotNull()).alias("known")), "groups-met")
    while not now.where("NOT known").isEmpty():
        target = now.select(F.col("g").alias("root"), F.col("id").alias("_id"), F.col("root").alias("_root"), F.col("known").alias("_known"))
        further = now.where("NOT known").drop("id", "known").join(target, "root").select("g", F.col("_id").alias("id"), F.col("_root").alias("root"), F.col("_known").alias("known"))
        now = settled(now.where("known").unionByName(further), "groups-met")
    return now.drop("known")


def actions(store: Definitions, batch: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """batch with action (new, add_lang, merge or conflict), id of the record's concept, and group_id of the group's."""
    records = settled(renamed(batch.dropna(subset=["g", "r", "lang", "phrase"]), overrides), "records")
    first = settled(heads(store.rows, records), "heads")
    groups = met(records, first)
    joined = records.join(first, ["lang", "phrase"]).join(groups.withColumnsRenamed({"id": "stored_id"}), "g")
    same = normalise_definition(F.col("head_text")) == normalise_definition(F.col("definition"))
    before = F.col("head_id").isNotNull() | (F.struct("head_g", "head_r") < F.struct("g", "r"))
    opens = F.col("stored_id").isNull() & (F.col("root") == F.col("g"))
    action = F.when(opens, "new").when(~before, "add_lang").when(same, "merge").otherwise("conflict")
    joined = settled(joined.withColumn("action", action), "actions")
    # Concepts are numbered in the order in which they are opened: a group's before those of its records.
    opened = joined.where("action = 'new'").select("g", F.lit(None).cast("long").alias("r")).distinct().unionByName(joined.where("action = 'conflict'").select("g", "r"))
    top = store.concepts.agg(F.coalesce(F.max("id"), F.lit(0)).alias("top"))
    numbered = settled(placed(opened, [F.col("g"), F.coalesce(F.col("r"), F.lit(-(1 << 62)))]).join(F.broadcast(top)).select("g", "r", (F.col("top") + F.col("place")).alias("number")), "numbers")
    of_group = numbered.where("r IS NULL").select(F.col("g").alias("root"), F.col("number").alias("opened_id"))
    own = numbered.where("r IS NOT NULL").select("g", "r", F.col("number").alias("own_id"))
    found = joined.join(of_group, "root", "left").join(own, ["g", "r"], "left").withColumn("group_id", F.coalesce("stored_id", "opened_id"))
    return found.withColumn("id", F.coalesce("own_id", "group_id")).select("g", "r", "lang", "phrase", "definition", "text", "source", "action", "id", "group_id", "head_text")


def write(store: Definitions, batch: DataFrame, domain: str, overrides: DataFrame | None = None) -> Definitions:
    """The store after a batch. Statuses rise with the distinct sources that a concept has when a record merges, and never fall.

    Conflicts: of a record's own concept with its group's; and of a new group's row with the first row of each other definition
    that its phrase had before.
    """
    done = settled(actions(store, batch, overrides), "written")
    new = done.where("action <> 'merge'")
    top = store.rows.agg(F.coalesce(F.max("seq"), F.lit(0)).alias("top"))
    fresh = settled(placed(new, [F.col("g"), F.col("r")]).join(F.broadcast(top)).withColumn("seq", F.col("top") + F.col("place")), "fresh-rows")
    rows = settled(store.rows.unionByName(fresh.select("seq", "id", "lang", "phrase", F.col("text").alias("definition"))), "rows")
    occurrences = settled(store.occurrences.unionByName(done.select("id", "lang", F.coalesce("source", F.lit("")).alias("source"))), "occurrences")
    first = done.where("action IN ('new', 'conflict')").groupBy("id").agg(F.min_by(F.coalesce("source", F.lit("")), F.struct("g", "r")).alias("first_seen_source"))
    opened = first.select("id", F.lit("document_specific").alias("scope"), F.lit("emerging").alias("status"), F.lit(False).alias("promotable"), "first_seen_source", F.lit(domain).alias("domain"))
    # Sources count as far as the last merge.
    last = done.where("action = 'merge'").groupBy("id").agg(F.max(F.struct("g", "r")).alias("last"))
    seen = done.select("id", F.coalesce("source", F.lit("")).alias("source"), F.struct("g", "r").alias("at")).join(last, "id").where("at <= last").select("id", "source")
    counted = seen.unionByName(store.occurrences.join(last, "id").select("id", "source")).distinct().groupBy("id").agg(F.count("*").alias("n"))
    concepts = store.concepts.unionByName(opened).join(counted, "id", "left")
    risen = F.coalesce(F.col("n") >= 2, F.lit(False))
    concepts = concepts.withColumns({"scope": F.when(risen, "domain").otherwise(F.col("scope")), "status": F.when(risen, scores.lifecycle(F.col("n"))).otherwise(F.col("status")), "promotable": risen | F.col("promotable")}).drop("n")
    short = lambda c: F.substring(F.coalesce(F.col(c), F.lit("")), 1, 100)
    detail = lambda a, b: F.concat(F.lit("A: "), short(a), F.lit(" | B: "), short(b)).alias("detail")
    inside = done.where("action = 'conflict'").select(F.col("group_id").alias("id_a"), F.col("id").alias("id_b"), detail("head_text", "text"))
    norm = normalise_definition(F.col("definition"))
    leads = rows.groupBy("lang", "phrase", norm.alias("_norm")).agg(F.min_by(F.struct("seq", "id", "definition"), "seq").alias("x")).select("lang", "phrase", "_norm", F.col("x.seq").alias("_seq"), F.col("x.id").alias("id_a"), F.col("x.definition").alias("_text"))
    across = fresh.where("action = 'new'").withColumn("_own", normalise_definition(F.col("definition"))).join(leads, ["lang", "phrase"]).where("_seq < seq AND _norm <> _own AND id_a <> id")
    conflicts = store.conflicts.unionByName(inside).unionByName(across.select("id_a", F.col("id").alias("id_b"), detail("_text", "text")))
    return Definitions(settled(concepts, "concepts"), rows, occurrences, settled(conflicts, "conflicts"))
