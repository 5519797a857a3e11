"""Ingestion in stages, from documents to the store, in one command that may be run again.

A stage writes its output and then a note with the fingerprint of all that went into it: its parameters, the files it reads
(path, length, time) and the fingerprints of the stages before. A later run skips stages whose note says the same, so it goes on
where the last one stopped. Behind the definitions stands the gate: without an approved record a flow waits for its review.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmill.operators import definitions, statutory
from glossmill.operators.writer import approved
from glossmill.sources import docx, files, markup, snapshots

STORE = ["concepts", "rows", "occurrences", "conflicts"]


@dataclass
class Stage:
    """run(spark, flow) writes flow.path(name). opens(spark, flow) tells whether the flow may go on behind it."""

    name: str
    run: Callable[[SparkSession, Flow], None]
    reads: tuple[str, ...] = ()
    opens: Callable[[SparkSession, Flow], bool] = lambda spark, flow: True


@dataclass
class Flow:
    folder: str
    stages: list[Stage]
    options: dict[str, str | None] = field(default_factory=dict)

    def path(self, stage: str) -> str:
        return f"{self.folder}/{stage}"


def state_of(spark: SparkSession, paths: list[str]) -> list[tuple[str, int, int]]:
    """Path, length and time of all files that patterns match; folders stand for what lies in them."""
    out = []
    for pattern in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        for status in fs.globStatus(path) or []:
            inner = list(fs.listStatus(status.getPath())) if status.isDirectory() else [status]
            out += [(s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in inner]
    return sorted(out)


def run(spark: SparkSession, flow: Flow) -> list[tuple[str, str]]:
    """Runs the stages that are due. Gives each stage's state: done, skipped (its note is still true), waiting (for approval) or not reached."""
    told: list[tuple[str, str]] = []
    before = ""
    for at, stage in enumerate(flow.stages):
        inputs = state_of(spark, [p for name in stage.reads if (p := flow.options.get(name))])
        mark = hashlib.sha256(json.dumps([stage.name, sorted((k, v) for k, v in flow.options.items() if v), inputs, before]).encode()).hexdigest()
        note = f"{flow.folder}/notes/{stage.name}"
        held = [r["value"] for r in spark.read.text(note).collect()] if files.found(spark, f"{note}/_SUCCESS") else []
        if held == [mark]:
            told.append((stage.name, "skipped"))
        else:
            stage.run(spark, flow)
            spark.createDataFrame([(mark,)], "value string").coalesce(1).write.mode("overwrite").text(note)
            told.append((stage.name, "done"))
        before = mark
        if not stage.opens(spark, flow):
            told[-1] = (stage.name, "waiting")
            return told + [(s.name, "not reached") for s in flow.stages[at + 1 :]]
    return told


FIELDS = "ord long, clause string, lang string, phrase string, definition string, source string, approved string"


def _corpus(spark: SparkSession, flow: Flow) -> None:
    corpus, amendments = docx.convert(docx.paragraphs(spark, flow.options["input"]))
    corpus.select("file", "para_idx", "line").write.mode("overwrite").parquet(flow.path("corpus"))
    amendments.write.mode("overwrite").parquet(f"{flow.path('corpus')}-amendments")


def _store_fields(records: DataFrame, clause: str, lang: str | None = None) -> DataFrame:
    """Records as definition groups take them; those of one clause are a group."""
    return records.select(F.monotonically_increasing_id().alias("ord"), F.col(clause).alias("clause"), F.lit(lang).alias("lang") if lang else F.col("lang"), F.col("term_normalized").alias("phrase"), F.col("definition_raw").alias("definition"), F.col("source_file").alias("source"), F.lit("false").alias("approved"))


def _statute(spark: SparkSession, flow: Flow) -> None:
    lines = spark.read.parquet(flow.path("corpus")).select(F.col("file").alias("source_file"), F.col("para_idx").alias("line_no"), "line")
    found = statutory.definitions(lines, flow.options.get("article") or "2", flow.options["lang"])
    _store_fields(found, "clause_num").write.mode("overwrite").json(flow.path("definitions"))


def _markup(spark: SparkSession, flow: Flow) -> None:
    pages = spark.read.text(flow.options["input"], wholetext=True).select(F.lit(flow.options.get("celex") or "").alias("celex_id"), F.lit(flow.options["lang"]).alias("lang"), F.col("value").alias("html"))
    found = markup.writer_fields(markup.definitions(pages, flow.options.get("article")))
    _store_fields(found, "clause_num").write.mode("overwrite").json(flow.path("definitions"))


def reviewed(spark: SparkSession, flow: Flow) -> DataFrame:
    """The definitions as reviewed: the file of the option `reviewed` where there is one, else as they were found."""
    given = flow.options.get("reviewed")
    path = given if given and files.found(spark, given) else flow.path("definitions")
    return spark.read.schema(FIELDS).json(path)


def any_approved(spark: SparkSession, flow: Flow) -> bool:
    return not reviewed(spark, flow).where(approved()).isEmpty()


def groups_of(records: DataFrame) -> DataFrame:
    """Approved records in the order of their clauses, numbered as groups: numbers in clauses count as numbers."""
    fine = records.where(approved())
    order = fine.groupBy("clause").agg(F.min("ord").alias("first"))
    number = F.coalesce(F.try_to_number(F.regexp_extract("clause", r"^(\d{1,9})", 1), F.lit("999999999")).cast("long"), F.lit(1 << 40))
    keyed = fine.join(order, "clause").withColumn("g", number * (1 << 20) + F.pmod("first", F.lit(1 << 20)))
    return keyed.select("g", F.col("ord").alias("r"), "lang", "phrase", "definition", "source")


def _write(spark: SparkSession, flow: Flow) -> None:
    folder = flow.options.get("store") or flow.path("store")
    held = snapshots.read(spark, folder, STORE)
    store = definitions.Definitions(**held) if held else definitions.empty(spark)
    after = definitions.write(store, groups_of(reviewed(spark, flow)), flow.options.get("domain") or "")
    snapshots.commit(spark, folder, {n: getattr(after, n) for n in STORE})


def document_flow(folder: str, **options: str | None) -> Flow:
    """docx paragraphs, the definitions of an article, review, store. Options: input, lang, article, domain, reviewed, store."""
    return Flow(folder, [Stage("corpus", _corpus, ("input",)), Stage("definitions", _statute, (), any_approved), Stage("written", _write, ("reviewed",))], options)


def markup_flow(folder: str, **options: str | None) -> Flow:
    """Pages of law, their definitions, review, store. Options: input, lang, celex, article, domain, reviewed, store."""
    return Flow(folder, [Stage("definitions", _markup, ("input",), any_approved), Stage("written", _write, ("reviewed",))], options)
