"""Command line: python -m glossmill COMMAND ..."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmill import flows
from glossmill.functions import scores
from glossmill.operators import areas, coverage, ngrams, review, statutory, store, tokens, writer
from glossmill.plans import reports
from glossmill.scratch import settled
from glossmill.sources import docx, files, markup


def mined_candidates(docs: DataFrame, common: DataFrame | None, known: DataFrame | None, least_frequency: int = 3, least_pmi: float = 2.0, most: int = 4, least_documents: int = 3, top: int = 500) -> DataFrame:
    """Candidates of documents (doc_idx, text): count, score, subsume, filter, rank.

    The subsuming side is never filtered: a phrase that a later filter drops may still subsume another.
    """
    words = tokens.mined_sentences(docs.select("doc_idx", "text")).persist()
    unigrams = ngrams.unigram_counts(words)
    total = ngrams.total_of(unigrams)
    counts = None
    for n in range(2, most + 1):
        part = ngrams.ngram_counts_with_documents(words, "doc_idx", n).where(F.col("frequency") >= least_frequency).withColumn("ngram_size", F.lit(n))
        counts = part if counts is None else counts.unionByName(part)
    scored = ngrams.scored_ngrams(counts, unigrams, total).where(F.col("pmi") >= least_pmi)
    pairs = ngrams.scored_bigrams(counts.where("ngram_size = 2"), unigrams, total).select("phrase", "g2")
    scored = scored.join(pairs, "phrase", "left").withColumn("association_score", F.coalesce("g2", "pmi")).withColumn("assoc_metric", F.when(F.col("g2").isNull(), "pmi").otherwise("log_likelihood"))
    kept = ngrams.without_subsumed(scored).where(ngrams.clean_components(F.split("phrase", " ")))
    if common is not None:
        kept = ngrams.lexicon_filter(kept, common)
    if known is not None:
        kept = kept.join(known.select("phrase").distinct(), "phrase", "left_anti")
    kept = kept.where(F.col("doc_count") >= least_documents)
    return kept.orderBy(F.desc("doc_count"), F.desc("association_score"), F.desc("frequency"), "ngram_size", "phrase").limit(top)


def _mine(spark: SparkSession, a: argparse.Namespace) -> None:
    common = files.phrase_table(spark, a.lexicon).select(F.lower("word").alias("word")) if a.lexicon else None
    known = files.phrase_table(spark, a.known).select(F.lower("word").alias("phrase")) if a.known else None
    files.write_jsonl(mined_candidates(files.documents(spark, a.input), common, known, a.min_freq, a.min_pmi, a.max_ngram, a.min_doc_count, a.top_n), a.output)


def measured(docs: DataFrame, keys: list[str], phrases: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Coverage and expertise of documents (keys, text)."""
    runs = tokens.token_runs(docs)
    parts = [*keys, "sent_idx", "run_idx"]
    counts = coverage.with_summary(coverage.coverage_counts(runs, phrases, lexicon, parts, keys))
    more = coverage.expertise(runs, phrases, lexicon, parts, keys).drop("total")
    return counts.join(more, keys)


def _coverage(spark: SparkSession, a: argparse.Namespace) -> None:
    docs = files.text_tree(spark, a.corpus)
    phrases = files.phrase_table(spark, a.phrases).select(F.lower("word").alias("phrase"))
    lexicon = spark.read.csv(a.lexicon, sep="\t", quote="", schema="word string, tier int").select(F.lower("word").alias("word"), "tier")
    found = measured(docs, ["stratum", "filename"], phrases, lexicon).persist()
    files.write_csv(found.orderBy("stratum", "filename"), a.output)
    print(reports.stratum_table(found.groupBy("stratum").agg(F.count("*").alias("files"), *[F.round(F.avg(c), 4).alias(c) for c in ("common", "domain", "signal")])))


def _merge(spark: SparkSession, a: argparse.Namespace) -> None:
    rows = None
    for pair in a.area:
        area, _, path = pair.partition(":")
        if area not in (*scores.AREAS, scores.CROSS_CUTTING) or not path:
            raise SystemExit(f"{pair}: expected AREA:PATH, AREA one of {', '.join((*scores.AREAS, scores.CROSS_CUTTING))}")
        part = files.jsonl(spark, path, files.CANDIDATE).select(F.coalesce("phrase_normalized", "phrase").alias("phrase"), F.lit(area).alias("area"), F.coalesce("source_file", F.lit(path)).alias("source_file"), "doc_count", "frequency", "pos_pattern", F.col("sample_context").alias("context"), F.monotonically_increasing_id().alias("ord"))
        rows = part if rows is None else rows.unionByName(part)
    merged = areas.merge_candidates(rows)
    files.write_jsonl(merged.orderBy(F.desc("area_specificity"), F.desc("total_doc_count"), "phrase"), a.output)


def _bucket(spark: SparkSession, a: argparse.Namespace) -> None:
    columns = "phrase string, total_doc_count long, total_frequency long, area_signature string, area_specificity double, pos_pattern string, " + ", ".join(f"d_{x} long" for x in scores.AREAS)
    merged = files.jsonl(spark, a.input, columns)
    enriched = merged.withColumn("ne_risk", scores.ne_risk(F.col("pos_pattern"), F.col("phrase"), F.col("phrase"), F.col("area_specificity"), F.col("total_doc_count")))
    if a.low_scorers:
        enriched = enriched.join(areas.low_scorers(enriched.select("phrase"), files.pinned_texts(spark, a.low_scorers)), "phrase", "left")
    routed = areas.route(enriched).persist()
    files.write_buckets(routed, a.output)
    print(reports.bucket_summary(routed))


def _statute(spark: SparkSession, a: argparse.Namespace) -> None:
    raw = spark.read.text(a.input, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)$", 1).alias("source_file"), F.posexplode(F.split("value", "\n")).alias("line_no", "line"))
    files.write_jsonl(statutory.definitions(raw, a.article, a.lang), a.output)


def _markup(spark: SparkSession, a: argparse.Namespace) -> None:
    pages = spark.read.text(a.input, wholetext=True).select(F.lit(a.celex).alias("celex_id"), F.lit(a.lang).alias("lang"), F.col("value").alias("html"))
    files.write_jsonl(markup.article_list(pages) if a.list else markup.definitions(pages, a.article), a.output)


def _docx(spark: SparkSession, a: argparse.Namespace) -> None:
    corpus, amendments = docx.convert(docx.paragraphs(spark, a.input))
    corpus.orderBy("file", "para_idx").select("line").write.mode("overwrite").text(a.output)
    amendments.orderBy("file", "para_idx").select("line").write.mode("overwrite").text(f"{a.output}-amendments")


def _conflicts(spark: SparkSession, a: argparse.Namespace) -> None:
    entries = spark.read.schema("id long, lang string, phrase string, definition string").json(a.input)
    print(reports.conflict_text(store.divergences(entries, ["lang", "phrase"], "id", "definition").orderBy("phrase", "id_a", "id_b")))


def _approve(spark: SparkSession, a: argparse.Namespace) -> None:
    """Approves all records of the languages, or the candidates of high confidence."""
    found = files.jsonl(spark, a.input, files.CANDIDATE, comments=True)
    chosen = F.col("lang").isin(a.lang) if a.lang else scores.confidence(F.col("frequency"), F.col("pmi")) == "high"
    files.write_jsonl(found.withColumn("approved", F.when(chosen, "true").otherwise(F.col("approved"))), a.output)


STORE = ("concepts", "phrases", "occurrences", "attestation")


def _write(spark: SparkSession, a: argparse.Namespace) -> None:
    """A new snapshot of the store (a folder of four tables) with the approved records; an error without any."""
    held = writer.empty_store(spark)
    if a.store:
        held = writer.Store(*[spark.read.parquet(f"{a.store}/{x}") for x in STORE])
    records = files.jsonl(spark, a.input, f"{files.CANDIDATE}, attestation array<struct<area:string,doc_count:long,frequency:long,source_file:string>>", comments=True)
    records = review.require_approved(settled(records.withColumn("ord", F.monotonically_increasing_id()), "records"))
    is_merged = F.col("attestation").isNotNull()
    after = writer.write_batch(held, records.where(is_merged), records.where(~is_merged & F.col("phrase").isNotNull()), a.domain)
    for name in STORE:
        getattr(after, name).write.mode("errorifexists").parquet(f"{a.output}/{name}")
    print(f"concepts: {after.concepts.count()}, new: {after.concepts.count() - held.concepts.count()}")


def _ingest(spark: SparkSession, a: argparse.Namespace) -> None:
    """From documents to the store; run again, it goes on where it stopped."""
    options = {"input": a.input, "lang": a.lang, "celex": a.celex, "article": a.article, "domain": a.domain, "reviewed": a.reviewed, "store": a.store}
    flow = (flows.markup_flow if a.source == "markup" else flows.document_flow)(a.folder, **options)
    for stage, state in flows.run(spark, flow):
        print(f"{stage}: {state}")


def _quality(spark: SparkSession, a: argparse.Namespace) -> None:
    """States and confidence of candidates, and how many are named entities as well."""
    found = files.jsonl(spark, a.input, files.CANDIDATE, comments=True)
    named = a.names or files.named_entities(spark, a.input)
    level = found.withColumn("confidence", scores.confidence(F.col("frequency"), F.col("pmi")))
    for row in sorted(review.state_counts(level, ["confidence"]).collect()):
        print(f"{row.confidence}: {row.total} ({row.approved} approved, {row.pending} pending)")
    overlap = review.name_overlap(found, files.jsonl(spark, named, "phrase string, phrase_normalized string")).count() if named else 0
    print(f"named entities: {overlap}")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="glossmill")
    commands = top.add_subparsers(dest="command", required=True)

    def add(name, run, *options):
        p = commands.add_parser(name)
        p.set_defaults(run=run)
        for flags, kw in options:
            p.add_argument(*flags, **kw)

    need = lambda name: (("--" + name,), {"required": True})
    may = lambda name, **kw: (("--" + name,), kw)
    add("mine", _mine, need("input"), need("output"), may("lexicon"), may("known"), may("top-n", type=int, default=500), may("min-freq", type=int, default=3), may("min-pmi", type=float, default=2.0), may("max-ngram", type=int, default=4, choices=range(2, 6)), may("min-doc-count", type=int, default=3))
    add("coverage", _coverage, need("corpus"), need("lexicon"), need("phrases"), need("output"))
    add("merge", _merge, (("--area",), {"action": "append", "required": True}), need("output"))
    add("bucket", _bucket, need("input"), need("output"), may("low-scorers", nargs="*"))
    add("statute", _statute, need("input"), need("article"), may("lang", choices=sorted(statutory.HEADERS), default="en"), need("output"))
    add("markup", _markup, need("input"), need("celex"), may("lang", default="en"), may("article"), may("list", action="store_true"), need("output"))
    add("docx", _docx, need("input"), need("output"))
    add("conflicts", _conflicts, need("input"))
    add("approve", _approve, need("input"), need("output"), may("lang", nargs="*"))
    add("write", _write, need("input"), need("domain"), need("output"), may("store"))
    add("ingest", _ingest, (("--source",), {"choices": ["docx", "markup"], "default": "docx"}), need("input"), need("folder"), need("lang"), need("domain"), may("celex"), may("article"), may("reviewed"), may("store"))
    add("quality", _quality, need("input"), may("names"))
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(SparkSession.builder.appName("glossmill").getOrCreate(), args)


if __name__ == "__main__":
    main()
