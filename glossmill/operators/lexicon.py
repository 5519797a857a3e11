"""Lexicon building: seeding, loading, mapping and migration."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_FREQUENCY, LEAST_LENGTH, MOST_SURVIVORS, LEAST_SURVIVORS = 5, 3, 200, 20
#: Openings of domain words that keep a token out of the general tier.
DOMAIN_STEMS = [
    "tariff", "customs", "duty", "duties", "tax", "taxes", "import", "export", "declaration", "declarant", "valuation",
    "classif", "valuat", "origin", "territory", "territorial", "compliance", "complian", "preferenti", "transit",
    "warehous", "aeo", "ucc", "hs", "wco", "eu", "ec", "oj", "tradesm", "trader", "shipment", "consignment", "broker",
    "incoter", "freight", "exporter", "importer", "sanction", "restrict", "quota", "license", "licens", "certifi",
    "manifest", "harmonis", "harmoniz", "nomenclat", "ratific", "accession", "treaty", "conventi", "regulat", "directiv",
    "implement", "dual-use", "controll", "exemption", "deroga", "embargo", "tariffic", "duty-free", "drawback", "refund",
    "reimburs", "rebate", "levy", "levied", "dumping", "countervail", "valoric", "ad-valor", "duty-paid", "transhipment",
    "smuggl", "contraband", "ncts", "vat", "originating", "annex", "transitional", "cn",
]


#: Tokens that are parts of words.
FRAGMENTS = ["non", "pre", "re", "anti", "sub", "co", "mis", "de"]


def seed_reasons(pool: DataFrame, lexicon: DataFrame, domain: DataFrame, stems: list[str] = DOMAIN_STEMS, names: DataFrame | None = None, fragments: list[str] = FRAGMENTS, stops: DataFrame | None = None) -> DataFrame:
    """pool (token, n) with the first rule that rejects each token, or `kept`. stops: word and reason of what a second pass leaves out by hand."""
    t = F.lower("token")
    joined = pool.join(lexicon.select(F.col("word").alias("lex_word")).distinct(), t == F.col("lex_word"), "left").join(domain.select(F.col("word").alias("domain_word")).distinct(), t == F.col("domain_word"), "left")
    reason = (
        F.when(F.col("n") < LEAST_FREQUENCY, "frequency")
        .when(F.length(t) < LEAST_LENGTH, "short")
        .when(~t.rlike("^[a-z][a-z-]*[a-z]$"), "characters")
        .when(F.col("lex_word").isNotNull(), "lexicon")
        .when(F.col("domain_word").isNotNull(), "domain")
        .when(t.rlike("^(" + "|".join(stems) + ")"), "stem")
    )
    if names is not None:
        joined = joined.join(names.select(F.col("word").alias("name_word")).distinct(), t == F.col("name_word"), "left")
        reason = reason.when(F.col("name_word").isNotNull(), "name")
    if fragments:
        reason = reason.when(t.isin(fragments), "fragment")
    if stops is not None:
        joined = joined.join(stops.groupBy(F.lower("word").alias("stop_word")).agg(F.min("reason").alias("stop_reason")), t == F.col("stop_word"), "left")
        reason = reason.when(F.col("stop_word").isNotNull(), F.concat(F.lit("manual_"), F.col("stop_reason")))
    return joined.select("token", "n", reason.otherwise("kept").alias("reason"))


def seed_guard(seeded: DataFrame) -> int:
    """Number of kept tokens; raises where they are suspiciously few or many."""
    kept = seeded.where("reason = 'kept'").count()
    if not LEAST_SURVIVORS <= kept <= MOST_SURVIVORS:
        raise ValueError(f"{kept} survivors, expected {LEAST_SURVIVORS} to {MOST_SURVIVORS}")
    return kept


def seeds(existing: DataFrame, reasons: DataFrame, lang: str, source: str, tier: int = 3) -> DataFrame:
    """Rows to append for the tokens that were kept, none whose word the lexicon has in that language; an error where their number is suspicious."""
    seed_guard(reasons)
    kept = reasons.where("reason = 'kept'").select(F.col("token").alias("word"), F.lit(None).cast("string").alias("pos"))
    return load_phrases(existing, kept, tier, lang, source)


def load_phrases(existing: DataFrame, phrases: DataFrame, tier: int, lang: str, source: str) -> DataFrame:
    """Rows of phrases (word, pos) to append: one per word in lower case, none that exists in lang."""
    new = phrases.select(F.lower(F.trim("word")).alias("word"), F.coalesce("pos", F.lit("PHRASE")).alias("pos")).where("word <> ''").dropDuplicates(["word"])
    held = existing.where(F.col("lang") == lang).select(F.lower("word").alias("word")).distinct()
    return new.join(held, "word", "left_anti").withColumns({"lang": F.lit(lang), "tier": F.lit(tier), "source": F.lit(source)})


def map_words(entries: DataFrame, mapping: DataFrame) -> DataFrame:
    """entries (concept_id, word, pos, ord) with `mapped`: by word and part of speech, else by word; the first entry of a concept wins."""
    exact = mapping.where("pos is not null").select("word", "pos", F.col("mapped").alias("exact")).dropDuplicates(["word", "pos"])
    loose = mapping.groupBy("word").agg(F.min_by("mapped", "ord").alias("loose"))
    found = entries.join(exact, ["word", "pos"], "left").join(loose, "word", "left").withColumn("mapped", F.coalesce("exact", "loose")).where("mapped is not null")
    return found.groupBy("concept_id").agg(F.min_by(F.struct("word", "pos", "mapped"), "ord").alias("x")).select("concept_id", "x.*")


def inflection_map(forms: DataFrame) -> DataFrame:
    """inflected -> lemma, both in lower case; forms of themselves go, of several the last (by id) wins."""
    low = forms.select("id", F.lower("inflected_word").alias("inflected"), F.lower("lemma").alias("lemma"))
    return low.where("inflected <> lemma").groupBy("inflected").agg(F.max_by("lemma", "id").alias("lemma"))


def migrate_vocabulary(vocabulary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(concepts, concept_lang) of a flat vocabulary (id, word, pos, tier, source, eo_word).

    Rows that share eo_word are one concept, named by the smallest id, whose attributes it takes; rows
    without one are concepts by themselves.
    """
    keyed = vocabulary.withColumn("key", F.coalesce(F.concat(F.lit("w:"), "eo_word"), F.concat(F.lit("i:"), F.col("id").cast("string"))))
    concepts = keyed.groupBy("key").agg(F.min("id").alias("concept_id"), F.min_by("eo_word", "id").alias("eo_word"), F.min_by("pos", "id").alias("eo_pos"))
    concepts = concepts.withColumn("eo_status", F.when(F.col("eo_word").isNull(), "pending").otherwise("complete"))
    lang = keyed.join(concepts.select("key", "concept_id"), "key").groupBy("concept_id", "word", "pos").agg(F.min_by(F.struct("tier", "source"), "id").alias("x"))
    return concepts.drop("key"), lang.select("concept_id", "word", "pos", "x.tier", "x.source")


def derived_words(entries: DataFrame, known: DataFrame, suffixes: list[str] = ["ness", "less", "ful", "ment", "tion", "ing", "ed", "ly", "er"]) -> DataFrame:  # noqa: B006
    """Proposals for unmapped words: the root of a known word with the same stem and the ending of the part of speech."""
    stem = lambda c: F.regexp_replace(F.lower(c), "(" + "|".join(suffixes) + ")$", "")
    ending = F.when(F.col("pos") == "noun", "o").when(F.col("pos") == "adjective", "a").when(F.col("pos") == "adverb", "e").otherwise("i")
    roots = known.withColumn("stem", stem(F.col("word"))).groupBy("stem").agg(F.min_by("root", "word").alias("root"))
    return entries.withColumn("stem", stem(F.col("word"))).join(roots, "stem").select("word", "pos", "root", F.concat("root", ending).alias("proposed"), F.lit("low").alias("confidence"))


def add_missing_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Additive migration: absent columns as nulls of the given type."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns})
