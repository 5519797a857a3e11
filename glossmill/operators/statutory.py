"""Defined terms in the numbered clauses of statutes, and the line operators they rest on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glossmill.functions.text import first_match, is_amendment_line, strip

#: Article headers, clauses, abbreviations and references by language.
HEADERS = {"lt": r"^(\d+)\s+straipsnis\.", "eo": r"^[Aa]rtikolo\s+(\d+)\.", "en": r"^[Aa]rticle\s+(\d+)\."}
CLAUSE = r"^(\d+(?:\s\d+)?)\.\s+(.+)"
ABBREVIATIONS = {
    "lt": [r"\(toliau[^)–-]*(?:–|-)\s*(.+?)\)"],
    "eo": [r"\(ĉi-poste\s+nomata(?:\s+[^)]+?)?\s*(?:–|-)\s+([^)]+?)\)", r"\(ĉi-poste\s+nomata\s+(.+?)\)"],
    "en": [],
}
REFERENCES = {
    "lt": [r"(?i)^kaip\s+ši\s+sąvoka\s+apibrėžta\s+(.+?)(?:\s*\(|[,.]|$)"],
    "eo": [r"(?i)^kiel\s+(?:difinita|difinite)\s+en\s+(.+?)(?:\s*\(|[,.]|$)", r"(?i)^kiel\s+ĉi\s+tiu\s+koncepto\s+estas\s+difinita\s+en\s+(.+?)(?:\s*\(|[,.]|$)"],
    "en": [r"(?i)^as\s+defined\s+in\s+(.+?)(?:\s*\(|[,.]|$)"],
}


def fill_forward(df: DataFrame, by: list[str], order: str, columns: dict[str, str]) -> DataFrame:
    """New columns that carry the last non-null value of a column down each group."""
    window = W.partitionBy(*by).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumns({new: F.last(old, ignorenulls=True).over(window) for new, old in columns.items()})


def segments(df: DataFrame, by: list[str], order: str, is_header: Column) -> DataFrame:
    """Adds segment: the number of headers so far in the group."""
    window = W.partitionBy(*by).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn("segment", F.sum(F.coalesce(is_header, F.lit(False)).cast("long")).over(window))


def article_lines(lines: DataFrame, article: str, lang: str) -> DataFrame:
    """Lines (source_file, line_no, line) of one article: behind its last header before the next other one."""
    number = F.nullif(F.regexp_extract(strip(F.col("line")), HEADERS[lang], 1), F.lit(""))
    file = W.partitionBy("source_file")
    marked = lines.withColumn("_n", number)
    marked = marked.withColumn("_first", F.min(F.when(F.col("_n") == article, F.col("line_no"))).over(file))
    marked = marked.withColumn("_end", F.min(F.when((F.col("_n") != article) & (F.col("line_no") > F.col("_first")), F.col("line_no"))).over(file))
    before = F.col("_end").isNull() | (F.col("line_no") < F.col("_end"))
    marked = marked.withColumn("_start", F.max(F.when((F.col("_n") == article) & before, F.col("line_no"))).over(file))
    return marked.where((F.col("line_no") > F.col("_start")) & before).drop("_n", "_first", "_end", "_start")


def separator_at(text: Column) -> Column:
    """Place (from 1) of the first dash between blanks outside parentheses, 0 if there is none.

    The text is cut at the dashes, and lengths and parentheses of the parts are added up: linear in the text.
    """
    count = lambda x, c: F.length(x) - F.length(F.replace(x, F.lit(c), F.lit("")))

    def step(s: Column, part: Column) -> Column:
        at, depth = s["at"] + F.length(part), s["depth"] + count(part, "(") - count(part, ")")
        found = F.when((s["found"] == 0) & (depth == 0), at + 1).otherwise(s["found"])
        return F.struct((at + 3).alias("at"), depth.alias("depth"), found.alias("found"))

    parts = F.split(text, " [–-] ", -1)
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("depth"), F.lit(0).alias("found"))
    return F.when(F.size(parts) > 1, F.aggregate(F.slice(parts, F.lit(1), F.size(parts) - 1), start, step, lambda s: s["found"])).otherwise(0)


def definitions(lines: DataFrame, article: str, lang: str) -> DataFrame:
    """One record per clause of the article that defines a term; clauses without a separator give none."""
    clean = article_lines(lines, article, lang).withColumn("line", F.replace(strip(F.col("line")), F.lit("**"), F.lit("")))
    clean = clean.where(~is_amendment_line(F.col("line")))
    cut = segments(clean, ["source_file"], "line_no", F.col("line").rlike(CLAUSE)).where("segment > 0")
    clauses = cut.groupBy("source_file", "segment").agg(F.transform(F.sort_array(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]).alias("body"))
    main = F.col("body")[0]
    parts = clauses.select(
        "source_file",
        F.replace(F.regexp_extract(main, CLAUSE, 1), F.lit(" "), F.lit("")).alias("clause_num"),
        main.alias("main"),
        F.regexp_extract(main, CLAUSE, 2).alias("rest"),
        F.filter(F.slice("body", 2, F.greatest(F.size("body"), F.lit(1))), lambda x: x != "").alias("more"),
    )
    parts = parts.withColumn("at", separator_at(F.col("rest"))).where("at > 0")
    term = strip(F.expr("substring(rest, 1, at - 1)"))
    first = strip(F.expr("substring(rest, at + 3)"))
    parts = parts.withColumn("term", term).withColumn("first", first)
    paren = F.instr("term", "(")
    raw = F.when(paren > 1, strip(F.expr("substring(term, 1, instr(term, '(') - 1)"))).otherwise(F.col("term"))
    law = first_match(F.col("first"), REFERENCES.get(lang, []))
    return parts.select(
        "source_file",
        F.lit(lang).alias("lang"),
        F.lit(article).alias("article"),
        "clause_num",
        raw.alias("term_raw"),
        F.lower(raw).alias("term_normalized"),
        F.regexp_replace(strip(first_match(F.col("main"), ABBREVIATIONS.get(lang, []))), '^"+|"+$', "").alias("abbrev"),
        F.array_join(F.concat(F.array("first"), "more"), " ").alias("definition_raw"),
        F.when(law.isNull(), "direct").otherwise("by_reference").alias("definition_type"),
        strip(law).alias("by_reference_law"),
        F.col("clause_num").alias("cross_lang_num"),
        F.lit("false").alias("approved"),
    )
