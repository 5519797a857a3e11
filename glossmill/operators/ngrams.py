"""N-gram counts, association scores and candidate filters."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossmill.functions import scores

#: Letters of a phrase by which it meets the strings of a text, and phrases that one automaton holds.
CUT, MOST_NEEDLES = 12, 200_000


def windows(words: Column, n: int) -> Column:
    """All windows of n neighbours, joined by blanks."""
    starts = F.slice(words, 1, F.greatest(F.size(words) - n + 1, F.lit(0)))
    made = F.transform(starts, lambda w, i: F.concat_ws(" ", w, *[F.get(words, i + k) for k in range(1, n)]))
    return F.coalesce(made, F.array().cast("array<string>"))


def places(df: DataFrame, keep: list[str], arrays: list[str], n: int) -> DataFrame:
    """keep, pos and at: a row for each place, with what stands there and up to n - 1 places behind (null beyond the end).

    Field k * n + i of `at` is place i of array k. Rows are made before strings are joined: inside arrays each window would be
    interpreted, which takes five times as long.
    """
    ahead = [F.slice(a, k, F.size(a)) for a in arrays for k in range(1, n + 1)]
    return df.select(*keep, F.posexplode(F.arrays_zip(*ahead)).alias("pos", "at"))


def window_at(fields: list[int]) -> Column:
    """The words of these fields of `at` joined by blanks; null where the last one is beyond the end."""
    return F.when(F.col("at")[str(fields[-1])].isNotNull(), F.concat_ws(" ", *[F.col("at")[str(i)] for i in fields]))


def unigram_counts(mined: DataFrame) -> DataFrame:
    return mined.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("freq"))


def ngram_counts(mined: DataFrame, sizes: range = range(2, 5)) -> DataFrame:
    """ngram_size, phrase, frequency. Counts are combined within tasks before the one shuffle."""
    found = places(mined, [], ["words"], max(sizes))
    grams = F.array(*[F.struct(F.lit(n).alias("ngram_size"), window_at(list(range(n))).alias("phrase")) for n in sizes])
    rows = found.select(F.explode(grams).alias("g")).where("g.phrase is not null")
    return rows.groupBy("g.ngram_size", "g.phrase").agg(F.count("*").alias("frequency"))


def ngram_counts_with_documents(mined: DataFrame, key: str, n: int) -> DataFrame:
    """phrase, frequency and doc_count in one shuffle.

    A document's windows are sorted within its row, so the first of equal ones is known there and stands for
    the document; no distinct aggregate is needed. mined has one row per sentence; rows of a key are gathered
    first, which a table that holds whole documents does without a shuffle.
    """
    grams = mined.select(key, F.explode(windows(F.col("words"), n)).alias("phrase"))
    return grams.groupBy("phrase", key).agg(F.count("*").alias("f")).groupBy("phrase").agg(F.sum("f").alias("frequency"), F.count("*").alias("doc_count"))


def document_ngrams(df: DataFrame, text: str, n: int, words_per_sentence: Column, by: list[str] | None = None) -> DataFrame:
    """phrase[, by], frequency, doc_count from rows that each hold a whole document: one shuffle."""
    by = by or []
    grams = F.sort_array(F.flatten(F.transform(words_per_sentence, lambda words: windows(words, n))))
    rows = df.select(*by, grams.alias("all")).select(*by, F.explode(F.transform("all", lambda g, i: F.struct(g.alias("phrase"), F.when((i > 0) & (F.get("all", i - 1) == g), 0).otherwise(1).alias("first")))).alias("g"))
    return rows.groupBy("g.phrase", *by).agg(F.count("*").alias("frequency"), F.sum("g.first").alias("doc_count"))


def scored_bigrams(counts: DataFrame, unigrams: DataFrame, total: DataFrame) -> DataFrame:
    """counts (phrase, frequency, ...) with pmi and g2. Filter by frequency before; unigrams, as many as there are words, are never broadcast."""
    one = unigrams.select(F.col("word").alias("w1"), F.col("freq").alias("f1")).hint("merge")
    two = unigrams.select(F.col("word").alias("w2"), F.col("freq").alias("f2")).hint("merge")
    parts = counts.withColumn("w1", F.split("phrase", " ")[0]).withColumn("w2", F.split("phrase", " ")[1])
    joined = parts.join(one, "w1").join(two, "w2").join(F.broadcast(total.select(F.col("total").cast("double").alias("n"))))
    f12, f1, f2, n = (F.col(c).cast("double") for c in ("frequency", "f1", "f2", "n"))
    return joined.withColumn("pmi", scores.pmi(f12, scores.log2(f1) + scores.log2(f2), 2, n)).withColumn("g2", scores.g_squared(f12, f1, f2, n)).drop("n")


def scored_ngrams(counts: DataFrame, unigrams: DataFrame, total: DataFrame) -> DataFrame:
    """counts (phrase, ngram_size, frequency, ...) with pmi for any size; a missing unigram drops the phrase."""
    words = counts.select("phrase", "ngram_size", F.explode(F.split("phrase", " ")).alias("word"))
    logs = words.join(unigrams.hint("merge"), "word").groupBy("phrase").agg(F.sum(scores.log2(F.col("freq").cast("double"))).alias("logs"), F.count("*").alias("found"))
    joined = counts.join(logs, "phrase").where("found = ngram_size").join(F.broadcast(total.select(F.col("total").cast("double").alias("n"))))
    return joined.withColumn("pmi", scores.pmi(F.col("frequency").cast("double"), F.col("logs"), F.col("ngram_size"), F.col("n"))).drop("logs", "found", "n")


def total_of(unigrams: DataFrame) -> DataFrame:
    return unigrams.agg(F.sum("freq").alias("total"))


def clean_components(words: Column) -> Column:
    """No component of one letter or of digits only."""
    return ~F.exists(words, lambda w: (F.length(w) <= 1) | w.rlike(r"^\d+$"))


def lexicon_filter(candidates: DataFrame, common: DataFrame) -> DataFrame:
    """Keeps phrases with a component outside `common` (word); adds novel_components and common_components."""
    parts = candidates.select("phrase", F.posexplode(F.split("phrase", " ")).alias("at", "word"))
    known = parts.join(common.select("word", F.lit(True).alias("known")), "word", "left")
    named = lambda c: F.transform(F.sort_array(F.collect_list(F.when(c, F.struct("at", "word")))), lambda x: x["word"])
    lists = known.groupBy("phrase").agg(named(F.col("known").isNull()).alias("novel_components"), named(F.col("known").isNotNull()).alias("common_components"))
    return candidates.join(lists.where(F.size("novel_components") > 0), "phrase")


def subsumed(candidates: DataFrame, share: float = 0.5, slack: float = 2.0) -> DataFrame:
    """phrase of candidates that another one contains as a substring, with enough frequency and score.

    Containment has no key to join on as a whole, so containers are cut into substrings, which meet the candidates by
    key. Only those are spelt that can be one: where a blank stands in it, a substring is the end of a word, whole words
    and the beginning of a word, and each distinct word knows which of its ends open a candidate and which of its
    beginnings close one. Both sides are shuffled, as the size of what is spelt can't be told before.
    """
    split = F.split("phrase", " ")
    words = candidates.select(F.explode(split).alias("word")).distinct()
    several = candidates.where(F.size(split) > 1)
    n = F.length("word")
    ends = F.transform(F.sequence(F.lit(1), n + 1), lambda i: F.substring(F.col("word"), i, n))
    beginnings = F.transform(F.sequence(F.lit(0), n), lambda k: F.substring(F.col("word"), F.lit(1), k))

    def named(kind: str, parts: Column, fit: DataFrame) -> DataFrame:
        return words.select("word", F.explode(F.array_distinct(parts)).alias("part")).join(fit.distinct().hint("merge"), "part").select("word", F.lit(kind).alias("kind"), "part")

    shown = named("end", ends, several.select(split[0].alias("part")))
    shown = shown.unionByName(named("beginning", beginnings, several.select(F.element_at(split, -1).alias("part"))))
    shown = shown.unionByName(named("inside", substrings(F.col("word")), candidates.where(F.size(split) == 1).select(F.col("phrase").alias("part"))))
    set_of = lambda kind: F.collect_set(F.when(F.col("kind") == kind, F.col("part"))).alias(kind)
    known = shown.groupBy("word").agg(set_of("end"), set_of("beginning"), set_of("inside"))
    whole = candidates.select(F.col("phrase").alias("container"), F.col("frequency").alias("fy"), F.col("pmi").alias("py")).distinct()
    placed = whole.select("*", F.posexplode(F.split("container", " ")).alias("at", "word")).join(known.hint("merge"), "word")
    rows = placed.groupBy("container", "fy", "py").agg(F.collect_list(F.struct("at", "end", "beginning", "inside")).alias("ws"))

    def between(a: Column, b: Column) -> Column:
        """Substrings from an end of word a to a beginning of word b."""
        middle = F.slice(F.split("container", " "), a["at"] + 2, F.greatest(b["at"] - a["at"] - 1, F.lit(0)))
        spelt = F.transform(a["end"], lambda x: F.transform(b["beginning"], lambda y: F.array_join(F.concat(F.array(x), middle, F.array(y)), " ")))
        return F.flatten(spelt)

    across = F.transform("ws", lambda a: F.flatten(F.transform(F.filter("ws", lambda b: b["at"] > a["at"]), lambda b: between(a, b))))
    parts = rows.select("container", "fy", "py", F.explode(F.array_distinct(F.concat(F.flatten(across), F.flatten(F.col("ws.inside"))))).alias("phrase")).where("phrase <> container")
    hit = candidates.join(parts.hint("merge"), "phrase").where((F.col("fy") >= share * F.col("frequency")) & (F.col("py") >= F.col("pmi") - slack))
    return hit.select("phrase").distinct()


def without_subsumed(candidates: DataFrame, share: float = 0.5, slack: float = 2.0) -> DataFrame:
    return candidates.join(subsumed(candidates, share, slack), "phrase", "left_anti")


def known_overlap(candidates: DataFrame, terms: DataFrame) -> DataFrame:
    """First term (by term) that contains a candidate or is contained in it.

    Both sides are cut into their substrings, which meet the other side whole by key: work grows with the lengths'
    squares and not with the product of the tables. A null contains nothing.
    """
    few, known = candidates.select("phrase").distinct(), terms.select("term").distinct()
    # Both sides are shuffled: what the substrings take up can't be told before.
    inside = few.select("phrase", F.explode(substrings(F.col("phrase"))).alias("term")).hint("merge").join(known, "term")
    around = known.select("term", F.explode(substrings(F.col("term"))).alias("phrase")).hint("merge").join(few, "phrase")
    return inside.unionByName(around).groupBy("phrase").agg(F.min("term").alias("overlaps_known_term"))


def substrings(text: Column) -> Column:
    """All distinct substrings that are not empty."""
    n = F.length(text)
    every = F.flatten(F.transform(F.sequence(F.lit(1), n), lambda i: F.transform(F.sequence(F.lit(1), n - i + 1), lambda k: F.substring(text, i, k))))
    return F.when(n > 0, F.array_distinct(every)).otherwise(F.array().cast("array<string>"))


def sample_context(candidates: DataFrame, sentences: DataFrame, width: int = 200, around: int = 60, most: int = MOST_NEEDLES) -> DataFrame:
    """The first sentence that holds each phrase as a string, cut to the phrase's surroundings where it is long.

    One pass over the sentences (doc_id, sent_idx, sentence) looks for all phrases at once, with an automaton of the
    candidates, at most `most` of them, else it is an error. Each Arrow batch sends one sentence for a phrase.
    """
    needles = [r["phrase"] for r in candidates.select("phrase").where("phrase <> ''").distinct().limit(most + 1).collect()]
    if len(needles) > most:
        raise ValueError(f"contexts are looked up for at most {most} phrases")

    def work(batches):
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for i, phrase in enumerate(needles):
            automaton.add_word(phrase, i)
        if needles:
            automaton.make_automaton()
        for batch in batches:
            best: dict[int, list[int]] = {}
            for place, hay in enumerate(batch.column(3).to_pylist()):
                if hay and needles:
                    for _, i in automaton.iter(hay):
                        best.setdefault(i, []).append(place)
            rows = batch.to_pylist()
            low = {i: min({(rows[j]["doc_id"], rows[j]["sent_idx"], rows[j]["sentence"]) for j in at}) for i, at in best.items()}
            out = [[needles[i] for i in low], *([x[k] for x in low.values()] for k in range(3))]
            kinds = [pa.string(), *(f.type for f in list(batch.schema)[:3])]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], ["phrase", "doc_id", "sent_idx", "sentence"])

    kinds = dict(sentences.dtypes)
    held = sentences.where("doc_id is not null").select("doc_id", "sent_idx", "sentence", F.lower("sentence").alias("hay")).mapInArrow(work, f"phrase string, doc_id {kinds['doc_id']}, sent_idx {kinds['sent_idx']}, sentence string")
    first = held.groupBy("phrase").agg(F.min(F.struct("doc_id", "sent_idx", "sentence")).alias("s")).select("phrase", "s.*")
    at, n = F.expr("locate(phrase, lower(sentence))"), F.length("phrase")
    start, stop = F.greatest(F.lit(1), at - around), F.least(F.length("sentence"), at + n - 1 + around)
    cut = F.concat(F.when(start > 1, "…").otherwise(""), F.substring("sentence", start, stop - start + 1), F.when(stop < F.length("sentence"), "…").otherwise(""))
    return first.withColumn("context", F.when(F.length("sentence") > width, cut).otherwise(F.col("sentence"))).select("phrase", "doc_id", "sent_idx", "context")
