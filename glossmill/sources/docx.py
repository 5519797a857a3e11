"""Word-processor documents to a corpus: paragraphs with runs, then column rules."""

from __future__ import annotations

import io
import zipfile
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmill.operators.statutory import fill_forward

_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
PARAGRAPH = "file string, para_idx int, style string, runs array<struct<text:string,bold:boolean,italic:boolean>>"
#: Marks of amendments and article headings.
AMENDMENT_REFERENCE = r"Nr\.\s+[IVXLCDM\w]+-\d+"
AMENDMENT_KEYWORDS = ["paskelbta TAR", "Straipsnio pakeitimai", "Straipsnio dalies pakeitimai", "Straipsnio punkto pakeitimai"]
ARTICLE = r"(?i)^(\d+(?:\s+\d+)?)\s+straipsn"


def _flag(run: ElementTree.Element, name: str) -> bool | None:
    """On, off, or not stated."""
    found = run.find(f"{_W}rPr/{_W}{name}")
    return None if found is None else found.get(f"{_W}val", "1") not in ("0", "false", "off")


def parse(data: bytes) -> list[tuple[int, str, list[dict]]]:
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        body = ElementTree.fromstring(z.read("word/document.xml")).find(f"{_W}body")
        styles = {}
        if "word/styles.xml" in z.namelist():
            for s in ElementTree.fromstring(z.read("word/styles.xml")).iter(f"{_W}style"):
                name = s.find(f"{_W}name")
                styles[s.get(f"{_W}styleId")] = name.get(f"{_W}val") if name is not None else s.get(f"{_W}styleId")
    out = []
    for i, p in enumerate(body.findall(f"{_W}p")):
        style = p.find(f"{_W}pPr/{_W}pStyle")
        key = style.get(f"{_W}val") if style is not None else "Normal"
        runs = [{"text": "".join(t.text or "" if t.tag == f"{_W}t" else "\t" for t in r if t.tag in (f"{_W}t", f"{_W}tab")), "bold": _flag(r, "b"), "italic": _flag(r, "i")} for r in p.findall(f"{_W}r")]
        out.append((i, styles.get(key, key), runs))
    return out


def paragraphs(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.docx").load(path).select("path", "content")

    def work(batches):
        for pdf in batches:
            rows = [(f, i, style, runs) for f, data in zip(pdf["path"], pdf["content"], strict=True) for i, style, runs in parse(bytes(data))]
            yield pd.DataFrame(rows, columns=["file", "para_idx", "style", "runs"])

    return files.mapInPandas(work, PARAGRAPH)


def text_of(runs: Column) -> Column:
    return F.array_join(F.transform(runs, lambda r: r["text"]), "")


def _all_runs(runs: Column, flag: str) -> Column:
    some = F.filter(runs, lambda r: F.trim(r["text"]) != "")
    return (F.size(some) > 0) & F.forall(some, lambda r: F.coalesce(r[flag], F.lit(False)))


def classify(paras: DataFrame) -> DataFrame:
    """Adds text, kind (amendment, note, heading, definition, text) and out, the line for the corpus."""
    t = F.col("text")
    rows = paras.withColumn("text", text_of(F.col("runs")))
    keyword = F.lit(False)
    for k in AMENDMENT_KEYWORDS:
        keyword = keyword | t.contains(k)
    amendment = _all_runs(F.col("runs"), "italic") | t.rlike(AMENDMENT_REFERENCE) | keyword
    short = F.length(F.trim("text")).between(1, 79)
    heading = F.col("style").startswith("Heading") | (short & _all_runs(F.col("runs"), "bold") & ~t.contains(" – "))
    dash = F.instr(t, " – ")
    before = F.aggregate("runs", F.struct(F.lit(0).alias("at"), F.lit(False).alias("hit")), lambda s, r: F.struct((s["at"] + F.length(r["text"])).alias("at"), (s["hit"] | (F.coalesce(r["bold"], F.lit(False)) & (s["at"] < dash - 1) & (F.length(r["text"]) > 0))).alias("hit")), lambda s: s["hit"])
    term = F.trim(F.substring(t, F.lit(1), dash - 1))
    definition = (dash > 0) & before & (F.length(term) <= 120)
    kind = F.when(F.trim("text") == "", "blank").when(amendment, "amendment").when(t.startswith("TAR pastaba"), "note").when(heading, "heading").when(definition, "definition").otherwise("text")
    rows = rows.withColumn("kind", kind)
    out = F.when(F.col("kind") == "definition", F.concat(F.lit("**"), term, F.lit("**"), F.substring(t, dash, F.length(t)))).otherwise(t)
    return rows.withColumn("out", out)


def convert(paras: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(corpus lines, amendments as `ARTICLE | REFERENCE | DATE`)."""
    rows = classify(paras).withColumn("number", F.nullif(F.regexp_extract(F.trim("text"), ARTICLE, 1), F.lit("")))
    rows = fill_forward(rows, ["file"], "para_idx", {"article": "number"})
    corpus = rows.where(F.col("kind").isin("heading", "definition", "text")).select("file", "para_idx", F.col("out").alias("line"))
    named = lambda pattern: F.coalesce(F.nullif(F.regexp_extract("text", pattern, 1), F.lit("")), F.lit("?"))
    amendments = rows.where("kind = 'amendment'").select("file", "para_idx", F.concat_ws(" | ", F.coalesce("article", F.lit("?")), named(r"(Nr\.\s+[\w]+-\d+(?:-\d+)?)"), named(r"(\d{4}-\d{2}-\d{2})")).alias("line"))
    return corpus, amendments
