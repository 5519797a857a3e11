"""Text, JSON-lines, TSV and CSV sources and sinks with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmill.functions.text import is_noise_line, normalise
from glossmill.operators.tokens import split_documents

#: Every record kind states its columns; `approved` is text, as it knows three states.
CANDIDATE = "phrase string, phrase_normalized string, phrase_inflected string, lang string, ngram_size int, pos_pattern string, frequency long, doc_count long, pmi double, g2 double, association_score double, assoc_metric string, source_file string, extraction_method string, approved string, sample_context string, novel_components array<string>, common_components array<string>, all_components_common boolean"
MERGED = "phrase_normalized string, phrase_inflected string, pos_pattern string, lang string, total_doc_count long, total_frequency long, attestation array<struct<area:string,doc_count:long,frequency:long,source_file:string>>, area_signature string, area_specificity double, sample_context string, approved string, ne_risk double, appears_in_low_scorers array<string>"
DEFINITION = "record_type string, lang string, term string, term_normalized string, definition string, approved string, source_ref struct<celex_id:string,structural_path:string,list_path:string,url:string,layout:string,source:string,edition:string,entry_id:string,page:int>"
SEED = "phrase string, lang string, source_type string, definition_status string, approved string"
OVERRIDE = "match_on struct<phrase_normalized:string,lang:string,mwe_id:long,definition_contains:string>, override struct<phrase:string,phrase_normalized:string,definition_raw:string>, reason string, overridden_by string, override_date string"


def documents(spark: SparkSession, path: str) -> DataFrame:
    """Documents of files in which a mark stands between them: doc_idx and part."""
    whole = spark.read.text(path, wholetext=True).withColumn("file", F.col("_metadata.file_path"))
    return split_documents(whole).select("file", "doc_idx", F.col("part").alias("text"))


def lines(spark: SparkSession, path: str, keep_noise: bool = False) -> DataFrame:
    found = spark.read.text(path)
    return found if keep_noise else found.where(~is_noise_line(F.col("value")))


def jsonl(spark: SparkSession, path: str, schema: str, comments: bool = False) -> DataFrame:
    """Records of JSON lines; blank lines and, where asked, lines that start with # are left out."""
    raw = spark.read.text(path).where(F.trim("value") != "")
    if comments:
        raw = raw.where(~F.col("value").startswith("#"))
    return raw.select(F.from_json("value", schema).alias("r")).select("r.*")


def jsonl_keys(spark: SparkSession, path: str, schema: str, keys: list[str]) -> DataFrame:
    """Distinct keys; lines that are no records, or lack one, are left out."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path).select(*keys).dropna().distinct()


def text_tree(spark: SparkSession, root: str) -> DataFrame:
    """stratum (name of the folder), filename and text of all .txt files below the root, without those in it."""
    found = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").text(root, wholetext=True).select(F.col("value").alias("text"), F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))).alias("path"))
    base = root.rstrip("/").rsplit("/", 1)[-1]
    parts = found.withColumn("stratum", F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)).withColumn("filename", F.regexp_extract("path", r"([^/]+)$", 1))
    return parts.where(~F.col("path").rlike(rf"/{base}/[^/]+$")).select("stratum", "filename", "text")


def pinned_texts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """label and normalised text of a few given files."""
    found = spark.read.text(paths, wholetext=True)
    return found.select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+?)(?:\.[^./]*)?$", 1).alias("label"), normalise(F.col("value")).alias("text"))


def pool(spark: SparkSession, path: str) -> DataFrame:
    """n and token of lines `COUNT<tab>TOKEN`."""
    return spark.read.csv(path, sep="\t", quote="", schema="n int, token string").where("n is not null")


def phrase_table(spark: SparkSession, path: str) -> DataFrame:
    """word, pos and notes; comments and blank lines are left out, the part of speech is PHRASE by default."""
    raw = spark.read.csv(path, sep="\t", quote="", comment="#", schema="word string, pos string, notes string")
    return raw.where(F.trim("word") != "").select(F.trim("word").alias("word"), F.coalesce("pos", F.lit("PHRASE")).alias("pos"), "notes")


def overrides(spark: SparkSession, path: str) -> DataFrame:
    found = spark.read.text(path).where(F.trim("value") != "")
    numbered = found.select(F.from_json("value", OVERRIDE).alias("r"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("ord"))
    return numbered.select("r.match_on.*", F.col("r.override").alias("override"), "ord")


def record_kind(columns: list[str]):
    """Kind of a raw record by the keys that it has, in the order in which writers ask."""
    has = lambda c: F.col(c).isNotNull() if c in columns else F.lit(False)
    definition = has("record_type") & (F.col("record_type") == "definition") if "record_type" in columns else F.lit(False)
    glossary = F.coalesce(F.col("source_ref.source") == "wco-glossary", F.lit(False)) if "source_ref" in columns else F.lit(False)
    return F.when(definition & glossary, "glossary").when(definition, "markup").when(has("record_type"), "dropped").when(has("attestation"), "merged").when(has("phrase"), "statistical").otherwise("statutory")


def found(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a pattern matches, in order; none where nothing is there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    status = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(x.getPath().toString() for x in status or [])


def stores(spark: SparkSession, folder: str) -> dict[str, str]:
    """Name and path of each store (a .db file) in a folder."""
    return {x.rsplit("/", 1)[-1][:-3]: x for x in found(spark, f"{folder}/*.db")}


def named_entities(spark: SparkSession, path: str) -> str | None:
    """The file of named entities beside a file of candidates, where there is one."""
    folder, _, name = path.rpartition("/")
    stem = name.rsplit(".", 1)[0]
    for part, other in (("statistical_candidates", "ne_candidates"), ("mwe", "ne")):
        beside = f"{folder or '.'}/{stem.replace(part, other)}.jsonl"
        if part in stem and found(spark, beside):
            return beside
    return None


def enrichments(spark: SparkSession, path: str) -> DataFrame:
    """v1_id and eo_word of the enrichments that are approved and have a word; the last of an id wins. No file gives no rows."""
    schema = "v1_id long, eo_word string, approved string"
    if not found(spark, path):
        return spark.createDataFrame([], "v1_id long, eo_word string")
    fine = ~F.coalesce("approved", F.lit("")).isin("", "false", "0") & (F.coalesce("eo_word", F.lit("")) != "")
    rows = jsonl(spark, path, schema).withColumn("ord", F.monotonically_increasing_id())
    return rows.where(fine).groupBy("v1_id").agg(F.max_by("eo_word", "ord").alias("eo_word"))


# Sinks


def combine_jsonl(spark: SparkSession, paths: list[str], target: str) -> None:
    """The lines of all files that exist, without blank ones; of no file nothing is written but an empty folder."""
    there = [x for p in paths for x in found(spark, p)]
    rows = spark.read.text(there) if there else spark.createDataFrame([], "value string")
    rows.select(F.trim("value").alias("value")).where("value <> ''").write.mode("overwrite").text(target)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def append_jsonl(spark: SparkSession, df: DataFrame, path: str, schema: str, keys: list[str]) -> None:
    """Appends the records whose key is not there yet; the batch itself is not deduplicated."""
    from glossmill.operators.store import append_except_keys

    append_except_keys(jsonl_keys(spark, path, schema, keys), df, keys).write.mode("append").option("ignoreNullFields", "false").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_pool(df: DataFrame, path: str) -> None:
    """Lines `COUNT<tab>TOKEN`, the most frequent first; parts are in order."""
    df.orderBy(F.desc("n"), "token").select(F.concat_ws("\t", F.col("n").cast("string"), "token").alias("value")).write.mode("overwrite").text(path)


def write_buckets(df: DataFrame, path: str) -> None:
    """A folder for each bucket; before each record's JSON a line that sums it up."""
    comment = F.format_string("# %s | areas=%d docs=%d spec=%.2f ne=%.2f", "phrase", "n_areas", "total_doc_count", "area_specificity", "ne_risk")
    body = F.to_json(F.struct(*[F.col(c) for c in df.columns if c != "bucket"]))
    df.select("bucket", F.concat(comment, F.lit("\n"), body).alias("value")).write.mode("overwrite").partitionBy("bucket").text(path)
