"""Queries: counting, scoring and filtering of candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmill.functions import scores
from glossmill.functions.text import nominative_lt, normalise
from glossmill.operators import ngrams, tagging, tokens
from glossmill.plans.common import LEXICON_SQL, MINED_SQL, PHRASES_SQL, SENTENCES_SQL, UNI_SQL, benchmark_phrases, documents, grams_sql, lexicon, mined
from glossmill.plans.registry import query
from glossmill.scratch import settled

LEAST_FREQUENCY, LEAST_PMI, LEAST_DOCUMENTS, TOP = 5, 2.0, 3, 500
_LN2 = "ln(2.0)"


@query(f"WITH {SENTENCES_SQL} SELECT doc_id, count(*)::BIGINT AS n_sentences, sum(length(sentence))::BIGINT AS n_chars FROM sents GROUP BY doc_id")
def sentence_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tokens.sentences(documents(spark, sf_dir))
    return found.groupBy("doc_id").agg(F.count("*").alias("n_sentences"), F.sum(F.length("sentence")).cast("long").alias("n_chars"))


@query(f"WITH {MINED_SQL}, {UNI_SQL} SELECT word, freq::BIGINT AS freq, n::BIGINT AS total FROM uni, tot")
def unigram_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = ngrams.unigram_counts(mined(spark, sf_dir))
    return counts.join(F.broadcast(ngrams.total_of(counts)))


@query(
    f"WITH {MINED_SQL} SELECT n AS ngram_size, phrase, count(*)::BIGINT AS frequency FROM (SELECT n::INT AS n, array_to_string(words[i:i + n - 1], ' ') AS phrase FROM mined, unnest([2, 3, 4]) AS k(n), unnest(range(1, len(words) - n + 2)) AS u(i)) x GROUP BY ALL"
)
def ngram_counts_2_4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.ngram_counts(mined(spark, sf_dir))


def _bigrams(spark: SparkSession, sf_dir: str, least: int = LEAST_FREQUENCY) -> DataFrame:
    words = F.transform(tokens.sentences_of(F.col("text")), lambda s: F.filter(tokens.words_of(s), lambda w: ~w.isin(tokens.STOP_WORDS)))
    return ngrams.document_ngrams(documents(spark, sf_dir), "text", 2, words).where(F.col("frequency") >= least)


@query(f"WITH {MINED_SQL}, {grams_sql('g', 2)} SELECT phrase, count(*)::BIGINT AS frequency, count(DISTINCT doc_id)::BIGINT AS doc_count FROM g GROUP BY phrase")
def ngram_doc_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bigrams(spark, sf_dir, 1)


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    unigrams = settled(ngrams.unigram_counts(mined(spark, sf_dir)), "unigrams")
    return ngrams.scored_bigrams(_bigrams(spark, sf_dir), unigrams, ngrams.total_of(unigrams))


_SCORED_SQL = f"""{MINED_SQL}, {UNI_SQL}, {grams_sql('g', 2)},
    bc AS (SELECT phrase, count(*)::BIGINT AS frequency, count(DISTINCT doc_id)::BIGINT AS doc_count FROM g GROUP BY phrase HAVING count(*) >= {LEAST_FREQUENCY}),
    parts AS (SELECT phrase, frequency, doc_count, a.freq::DOUBLE AS f1, b.freq::DOUBLE AS f2, frequency::DOUBLE AS f12, n::DOUBLE AS n FROM bc JOIN uni a ON a.word = split_part(phrase, ' ', 1) JOIN uni b ON b.word = split_part(phrase, ' ', 2), tot),
    cells AS (SELECT *, f12 AS o11, f1 - f12 AS o12, f2 - f12 AS o21, n - f1 - f2 + f12 AS o22, f1 * f2 AS e11, f1 * (n - f2) AS e12, (n - f1) * f2 AS e21, (n - f1) * (n - f2) AS e22 FROM parts),
    scored AS (SELECT phrase, frequency, doc_count, ln(f12) / {_LN2} + ln(n) / {_LN2} - (ln(f1) / {_LN2} + ln(f2) / {_LN2}) AS pmi,
        2.0 * (CASE WHEN o11 > 0 AND e11 > 0 THEN o11 * ln(o11 * n / e11) ELSE 0 END + CASE WHEN o12 > 0 AND e12 > 0 THEN o12 * ln(o12 * n / e12) ELSE 0 END
             + CASE WHEN o21 > 0 AND e21 > 0 THEN o21 * ln(o21 * n / e21) ELSE 0 END + CASE WHEN o22 > 0 AND e22 > 0 THEN o22 * ln(o22 * n / e22) ELSE 0 END) AS g2 FROM cells)"""


@query(f"WITH {_SCORED_SQL} SELECT phrase, frequency, doc_count, floor(pmi * 1000 + 0.5)::BIGINT AS pmi_q, floor(g2 * 1000 + 0.5)::BIGINT AS g2_q FROM scored")
def bigram_pmi_g2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _scored(spark, sf_dir)
    return found.select("phrase", "frequency", "doc_count", scores.quantised(F.col("pmi"), 1000).alias("pmi_q"), scores.quantised(F.col("g2"), 1000).alias("g2_q"))


@query(
    f"""WITH {MINED_SQL}, {UNI_SQL}, {grams_sql('g', 3)}, c AS (SELECT phrase, count(*)::BIGINT AS frequency FROM g GROUP BY phrase HAVING count(*) >= {LEAST_FREQUENCY}),
    l AS (SELECT c.phrase, frequency, sum(ln(freq) / {_LN2}) AS logs FROM c, unnest(string_split(c.phrase, ' ')) AS u(word) JOIN uni ON uni.word = u.word GROUP BY ALL)
    SELECT phrase, frequency, floor((ln(frequency) / {_LN2} + 2 * ln(n::DOUBLE) / {_LN2} - logs) * 1000 + 0.5)::BIGINT AS pmi_q FROM l, tot"""
)
def trigram_pmi(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = mined(spark, sf_dir)
    counts = ngrams.ngram_counts(words, range(3, 4)).where(F.col("frequency") >= LEAST_FREQUENCY)
    unigrams = ngrams.unigram_counts(words)
    return ngrams.scored_ngrams(counts, unigrams, ngrams.total_of(unigrams)).select("phrase", "frequency", scores.quantised(F.col("pmi"), 1000).alias("pmi_q"))


@query(
    f"""WITH {MINED_SQL}, grams AS (SELECT phrase, count(*)::BIGINT AS frequency FROM (SELECT array_to_string(words[i:i + n - 1], ' ') AS phrase FROM mined, unnest([2, 3]) AS k(n), unnest(range(1, len(words) - n + 2)) AS u(i)) x GROUP BY phrase HAVING count(*) >= 8)
    SELECT phrase, frequency FROM grams x WHERE NOT EXISTS (SELECT 1 FROM grams y WHERE y.phrase <> x.phrase AND contains(y.phrase, x.phrase) AND y.frequency >= 0.5 * x.frequency)"""
)
def subsumption_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores are left equal here, so that only containment and frequency decide."""
    counts = settled(ngrams.ngram_counts(mined(spark, sf_dir), range(2, 4)).where("frequency >= 8").select("phrase", "frequency", F.lit(0.0).alias("pmi")), "counts")
    return ngrams.without_subsumed(counts).select("phrase", "frequency")


@query(
    f"""WITH {LEXICON_SQL}, {MINED_SQL}, {grams_sql('g', 2)}, c AS (SELECT phrase, count(*)::BIGINT AS frequency FROM g GROUP BY phrase HAVING count(*) >= {LEAST_FREQUENCY}),
    s AS (SELECT phrase, frequency, i, string_split(phrase, ' ')[i] AS w FROM c, unnest([1, 2]) AS u(i)),
    t AS (SELECT s.*, lex.word IS NULL AS new FROM s LEFT JOIN lex ON lex.word = s.w),
    a AS (SELECT phrase, frequency, coalesce(string_agg(w, ',' ORDER BY i) FILTER (WHERE new), '') AS novel, coalesce(string_agg(w, ',' ORDER BY i) FILTER (WHERE NOT new), '') AS common, bool_or(new) AS any_new, bool_or(length(w) <= 1) AS short FROM t GROUP BY phrase, frequency)
    SELECT phrase, frequency, novel, common FROM a WHERE any_new AND NOT short"""
)
def lexicon_filter_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = ngrams.ngram_counts(mined(spark, sf_dir), range(2, 3)).where(F.col("frequency") >= LEAST_FREQUENCY)
    fine = counts.where(ngrams.clean_components(F.split("phrase", " ")))
    found = ngrams.lexicon_filter(fine.select("phrase", "frequency"), lexicon(spark, sf_dir))
    return found.select("phrase", "frequency", F.array_join("novel_components", ",").alias("novel"), F.array_join("common_components", ",").alias("common"))


@query(f"WITH {PHRASES_SQL}, {MINED_SQL}, {grams_sql('g', 2)} SELECT phrase, count(*)::BIGINT AS frequency FROM g WHERE phrase NOT IN (SELECT phrase FROM phrases) GROUP BY phrase HAVING count(*) >= {LEAST_FREQUENCY}")
def known_phrase_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = ngrams.ngram_counts(mined(spark, sf_dir), range(2, 3)).where(F.col("frequency") >= LEAST_FREQUENCY)
    return counts.join(benchmark_phrases(spark, sf_dir), "phrase", "left_anti").select("phrase", "frequency")


_NOVEL_SQL = f"""{LEXICON_SQL}, {PHRASES_SQL}, {_SCORED_SQL}, cand AS (SELECT * FROM scored WHERE pmi >= {LEAST_PMI}),
    kept AS (SELECT * FROM cand x WHERE NOT EXISTS (SELECT 1 FROM cand y WHERE y.phrase <> x.phrase AND contains(y.phrase, x.phrase) AND y.frequency >= 0.5 * x.frequency AND y.pmi >= x.pmi - 2.0)),
    novel AS (SELECT * FROM kept WHERE (split_part(phrase, ' ', 1) NOT IN (SELECT word FROM lex) OR split_part(phrase, ' ', 2) NOT IN (SELECT word FROM lex)) AND length(split_part(phrase, ' ', 1)) > 1 AND length(split_part(phrase, ' ', 2)) > 1 AND phrase NOT IN (SELECT phrase FROM phrases) AND doc_count >= {LEAST_DOCUMENTS}),
    top AS (SELECT phrase, frequency, doc_count, floor(g2 * 100 + 0.5)::BIGINT AS score_q FROM novel ORDER BY doc_count DESC, floor(g2 * 100 + 0.5)::BIGINT DESC, frequency DESC, phrase LIMIT {TOP})"""


@query(f"WITH {_NOVEL_SQL} SELECT phrase, frequency, doc_count, score_q FROM top")
def mine_candidates_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole miner: count, score, subsume, filter by lexicon and known phrases, rank, limit."""
    # Stored, as both sides of the subsumption and the filters behind it read them.
    candidates = settled(_scored(spark, sf_dir).where(F.col("pmi") >= LEAST_PMI), "candidates")
    kept = ngrams.without_subsumed(candidates).where(ngrams.clean_components(F.split("phrase", " ")))
    novel = ngrams.lexicon_filter(kept, lexicon(spark, sf_dir)).join(benchmark_phrases(spark, sf_dir), "phrase", "left_anti").where(F.col("doc_count") >= LEAST_DOCUMENTS)
    ranked = novel.withColumn("score_q", scores.quantised(F.col("g2"), 100)).orderBy(F.desc("doc_count"), F.desc("score_q"), F.desc("frequency"), "phrase").limit(TOP)
    return ranked.select("phrase", "frequency", "doc_count", "score_q")


@query(
    f"""WITH {_NOVEL_SQL}, held AS (SELECT phrase, doc_id, sent_idx, sentence, row_number() OVER (PARTITION BY phrase ORDER BY doc_id, sent_idx, sentence) AS r FROM top JOIN sents ON contains(lower(sentence), phrase)),
    a AS (SELECT phrase, doc_id, sent_idx, sentence, greatest(1, strpos(lower(sentence), phrase) - 60) AS s, least(length(sentence), strpos(lower(sentence), phrase) + length(phrase) - 1 + 60) AS e FROM held WHERE r = 1)
    SELECT phrase, doc_id, sent_idx::INT AS sent_idx, CASE WHEN length(sentence) > 200 THEN (CASE WHEN s > 1 THEN '…' ELSE '' END) || substring(sentence, s, e - s + 1) || (CASE WHEN e < length(sentence) THEN '…' ELSE '' END) ELSE sentence END AS context FROM a"""
)
def sample_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A context for every ranked candidate."""
    return ngrams.sample_context(settled(mine_candidates_topk(spark, sf_dir), "ranked"), tokens.sentences(documents(spark, sf_dir)))


@query(f"WITH {_NOVEL_SQL} SELECT top.phrase, min(p.phrase) AS overlaps_known_term FROM top JOIN phrases p ON contains(top.phrase, p.phrase) OR contains(p.phrase, top.phrase) GROUP BY top.phrase")
def known_term_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.known_overlap(settled(mine_candidates_topk(spark, sf_dir), "ranked"), benchmark_phrases(spark, sf_dir).withColumnRenamed("phrase", "term"))


_LT_SQL = "CASE " + " ".join(f"WHEN word LIKE '%{e}' AND length(word) > {len(e)} THEN left(word, length(word) - {len(e)}) || '{r}'" for e, r in [("ių", "ys"), ("ės", "ė"), ("io", "is"), ("ui", "us"), ("os", "a"), ("ą", "as"), ("ę", "ė"), ("į", "is")]) + " ELSE word END"


@query(f"WITH {MINED_SQL}, {UNI_SQL} SELECT word, {_LT_SQL} AS nominative FROM uni")
def lt_endings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.unigram_counts(mined(spark, sf_dir)).select("word", nominative_lt(F.col("word")).alias("nominative"))


@query("SELECT doc_id, trim(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9]+', ' ', 'g')) AS normalised FROM documents")
def normalised_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", normalise(F.col("text")).alias("normalised"))


@query(
    f"WITH {MINED_SQL}, {UNI_SQL}, tag AS (SELECT word, CASE length(word) % 5 WHEN 0 THEN 'NOUN' WHEN 1 THEN 'ADJ' WHEN 2 THEN 'PROPN' WHEN 3 THEN 'ADP' ELSE 'VERB' END AS t FROM uni), {grams_sql('g', 3)}, "
    "c AS (SELECT phrase, count(*)::BIGINT AS frequency FROM g GROUP BY phrase HAVING count(*) >= 5), "
    "p AS (SELECT phrase, frequency, list_transform(string_split(phrase, ' '), lambda w: CASE length(w) % 5 WHEN 0 THEN 'NOUN' WHEN 1 THEN 'ADJ' WHEN 2 THEN 'PROPN' WHEN 3 THEN 'ADP' ELSE 'VERB' END) AS ts FROM c) "
    "SELECT phrase, frequency, array_to_string(ts, ' ') AS pos_pattern FROM p WHERE NOT list_contains(ts, 'VERB') AND ts[1] <> 'ADP' AND ts[3] <> 'ADP'"
)
def pos_shape_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags come from a dictionary table; here a rule on the length stands for it."""
    n = F.length
    tag = lambda w: F.when(n(w) % 5 == 0, "NOUN").when(n(w) % 5 == 1, "ADJ").when(n(w) % 5 == 2, "PROPN").when(n(w) % 5 == 3, "ADP").otherwise("VERB")
    counts = ngrams.ngram_counts(mined(spark, sf_dir), range(3, 4)).where("frequency >= 5")
    tagged = counts.select("phrase", "frequency", F.array_join(F.transform(F.split("phrase", " "), tag), " ").alias("pos_pattern"))
    return tagged.where(scores.pos_shape_ok(F.col("pos_pattern")))


@query(
    f"""WITH {_SCORED_SQL}, b AS (SELECT phrase, CASE WHEN frequency >= 5 AND pmi >= 15 THEN 'high' WHEN frequency >= 3 AND pmi >= 10 THEN 'medium' ELSE 'low' END AS confidence, len(list_intersect(string_split(phrase, ' '), ['html', 'css', 'class'])) > 0 AS noise FROM scored),
    a AS (SELECT count(*) FILTER (WHERE confidence = 'high') AS high, count(*) FILTER (WHERE confidence = 'medium') AS medium, count(*) FILTER (WHERE confidence = 'low') AS low, count(*) FILTER (WHERE confidence = 'high' AND noise) AS noise_in_high FROM b)
    SELECT high, medium, low, high > 0 AND noise_in_high = 0 AS auto_approve, greatest(1, medium // 6 + (high + 2) // 3)::BIGINT AS review_minutes FROM a"""
)
def confidence_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = _scored(spark, sf_dir).select("phrase", scores.confidence(F.col("frequency"), F.col("pmi")).alias("confidence"), scores.is_markup_noise(F.col("phrase")).alias("noise"))
    c = lambda name: F.count_if(F.col("confidence") == name)
    summed = rated.agg(c("high").alias("high"), c("medium").alias("medium"), c("low").alias("low"), F.count_if((F.col("confidence") == "high") & F.col("noise")).alias("noise_in_high"))
    return summed.select("high", "medium", "low", ((F.col("high") > 0) & (F.col("noise_in_high") == 0)).alias("auto_approve"), F.expr("greatest(1L, medium div 6 + (high + 2) div 3)").alias("review_minutes"))


def _rule(word: str) -> tuple[str, str]:
    """Stands for a tagger's model: the lemma drops a final s of longer words, the part of speech follows the length."""
    return (word[:-1] if len(word) > 3 and word.endswith("s") else word), ("NOUN", "ADJ", "PROPN", "ADP", "VERB")[len(word) % 5]


_TAG_SQL = "CASE length({0}) % 5 WHEN 0 THEN 'NOUN' WHEN 1 THEN 'ADJ' WHEN 2 THEN 'PROPN' WHEN 3 THEN 'ADP' ELSE 'VERB' END"


@query(
    f"""WITH {LEXICON_SQL}, {MINED_SQL}, {UNI_SQL}, g AS (SELECT doc_id, source, sent_idx, i, n::INT AS n, words[i:i + n - 1] AS ws FROM mined, unnest([2, 3]) AS k(n), unnest(range(1, len(words) - n + 2)) AS u(i)),
    c AS (SELECT array_to_string(ws, ' ') AS phrase, n AS ngram_size, any_value(ws) AS ws, count(*)::BIGINT AS frequency, count(DISTINCT doc_id)::BIGINT AS doc_count, min((doc_id, sent_idx, i, source))[4] AS source_file FROM g GROUP BY ALL HAVING count(*) >= {LEAST_FREQUENCY}),
    p AS (SELECT c.*, list_transform(ws, lambda w: {_TAG_SQL.format('w')}) AS ts FROM c), f AS (SELECT * FROM p WHERE NOT list_contains(ts, 'VERB') AND ts[1] <> 'ADP' AND ts[len(ts)] <> 'ADP'),
    e AS (SELECT f.phrase, f.ngram_size, u.i, ws[u.i] AS w FROM f, unnest(range(1, len(ws) + 1)) AS u(i)), t AS (SELECT e.*, lex.word IS NOT NULL AS common FROM e LEFT JOIN lex ON lex.word = CASE WHEN length(w) > 3 AND w LIKE '%s' THEN left(w, length(w) - 1) ELSE w END),
    a AS (SELECT phrase, ngram_size, coalesce(string_agg(w, ',' ORDER BY i) FILTER (WHERE NOT common), '') AS novel, coalesce(string_agg(w, ',' ORDER BY i) FILTER (WHERE common), '') AS common, bool_or(NOT common) AS any_new FROM t GROUP BY ALL),
    l AS (SELECT f.phrase, f.ngram_size, sum(ln(freq) / {_LN2}) AS logs FROM f, unnest(ws) AS u(w) JOIN uni ON uni.word = u.w GROUP BY ALL)
    SELECT f.phrase, f.ngram_size, frequency, doc_count, array_to_string(ts, ' ') AS pos_pattern, source_file, novel, common, floor((ln(frequency) / {_LN2} + (f.ngram_size - 1) * ln(n::DOUBLE) / {_LN2} - logs) * 1000 + 0.5)::BIGINT AS pmi_q FROM f JOIN a USING (phrase, ngram_size) JOIN l USING (phrase, ngram_size), tot WHERE any_new"""
)
def tagged_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of two and three words with the pattern and file of their first occurrence, filtered by part of speech and by lemma."""
    with tagging.small_batches(spark):
        docs = settled(tagging.mined(documents(spark, sf_dir, "doc_id", "source", "text"), tagging.dictionary_tagger({}, _rule)), "tagged")
        words = settled(tagging.lemma_counts(docs, "doc_id"), "lemmas")
        counts = tagging.candidate_counts(docs, "doc_id", "source", range(2, 4), LEAST_FREQUENCY).where(scores.pos_shape_ok(F.col("pos_pattern")))
        # Stored, as the components and the join behind them read them.
        counts = settled(counts, "tagged-counts")
    found = settled(tagging.lexicon_components(counts, words, lexicon(spark, sf_dir)), "tagged-candidates")
    scored = ngrams.scored_ngrams(found, words.select("word", "freq"), ngrams.total_of(words))
    joined = lambda c, name: F.array_join(c, ",").alias(name)
    return scored.select("phrase", "ngram_size", "frequency", "doc_count", "pos_pattern", "source_file", joined("novel_components", "novel"), joined("common_components", "common"), scores.quantised(F.col("pmi"), 1000).alias("pmi_q"))
