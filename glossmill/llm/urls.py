"""URL filter: host rules, then word segmentation and naive Bayes.

A rule is a host with a path prefix and a verdict; it fits its host and all subdomains where the url's path
starts with its own, and of fitting rules the longest wins. Urls without a rule are judged by a multinomial
naive Bayes over the words of the host and the tokens of the path. Names in hosts are split by Viterbi over
unigram counts of words in the pages' own texts.

The model learns from all urls that rules decide, without what decided them: the host name and path prefix of the
rule that fired are no features there, so that it can't just learn the rules again. Counts stand in an exact table
by token, which meets the urls' tokens by key. A token that no ruled url has weighs nothing.

Defined cases: null urls and urls without "://" have an empty host and path, fit no rule and get the verdict
of the prior; null page texts give no words; names that no counted word covers stay whole or fall into
letters by the unigram model's unknown-word rate; ties are allowed, not blocked; repeated rows are judged alike;
other columns are ignored; an empty table gives an empty result. Words, names and tokens may have any length.
"""

from __future__ import annotations

import re
from collections import Counter
from math import log

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossmill.llm.common import cut, looked_up, map_texts, sliced

#: The rules as (host, path, verdict).
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
#: Pseudo-uses of each token in either class.
SMOOTHING = 1.0
#: Substrings of names up to this length meet the counted words as they are; longer words meet them by an opening of this length.
OPENING = 64
#: Host labels and path parts are cut at all else than letters and digits.
WORD = re.compile(r"[a-z]+")
TAG = re.compile(r"<(script|style)\b.*?</\1\s*>|<[^>]*>", re.DOTALL | re.IGNORECASE)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z in lower case, and path; both empty without "://"."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_for(host: Column, path: Column, rules: list[tuple[str, str, str]] = RULES) -> Column:
    """The longest fitting rule as struct(rule, verdict, name, prefix), or null. The list of rules is part of the query."""
    out = None
    for name, prefix, verdict in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(prefix)
        value = F.struct(F.lit(name + prefix).alias("rule"), F.lit(verdict).alias("verdict"), F.lit(name).alias("name"), F.lit(prefix).alias("prefix"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string,name:string,prefix:string>")


def word_counts(pages: DataFrame, html: str = "html") -> DataFrame:
    """word and uses over all page texts; counted within tasks, then over all."""

    def work(batches):
        counts: Counter = Counter()
        for batch in sliced(batches, 0):
            for t in batch.column(0).to_pylist():
                counts.update(WORD.findall(TAG.sub(" ", t or "").lower()))
            if len(counts) > 500_000:  # bounds a task's memory; the rest adds up after the shuffle
                yield _counted(counts)
                counts = Counter()
        yield _counted(counts)

    return pages.select(html).mapInArrow(work, "word string, uses long").groupBy("word").agg(F.sum("uses").alias("uses"))


def _counted(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(counts.keys()), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "uses"])


def split_name(name: str, uses: dict[str, int], total: int) -> list[str]:
    """The likeliest words: unigram Viterbi. An uncounted piece of n letters has 10 / (total * 10 ** n).

    Linear in the name besides the places of counted words: as an uncounted piece loses the same with each letter,
    its best start is carried along.
    """
    base, ten = log(max(total, 1)), log(10)
    ends: list[list[tuple[int, float]]] = [[] for _ in range(len(name) + 1)]
    for word, n in uses.items():
        at = name.find(word)
        while at >= 0 and word:
            ends[at + len(word)].append((at, log(n) - base))
            at = name.find(word, at + 1)
    best: list[tuple[float, int]] = [(0.0, 0)]
    open_, since = 0.0, 0  # best[since] + since * ten, the largest so far
    for stop in range(1, len(name) + 1):
        shown = [(open_ - stop * ten + ten - base, since), *((best[start][0] + p, start) for start, p in ends[stop])]
        best.append(max(shown, key=lambda x: (x[0], -x[1])))
        if best[stop][0] + stop * ten > open_:
            open_, since = best[stop][0] + stop * ten, stop
    words, stop = [], len(name)
    while stop:
        start = best[stop][1]
        words.append(name[start:stop])
        stop = start
    return words[::-1]


def segmented(hosts: DataFrame, counts: DataFrame) -> DataFrame:
    """host and words for distinct hosts. Only counts of substrings that occur in some name are looked up."""
    counts = cut(counts)
    total = counts.agg(F.sum("uses")).first()[0] or 0
    names = cut(hosts.select(F.explode(F.array_distinct(F.regexp_extract_all("host", F.lit("[a-z]+"), F.lit(0)))).alias("name")).distinct())
    n = F.length("name")
    starts = F.transform(F.sequence(F.lit(1), n), lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(OPENING), n - i + 1)), lambda k: F.substring(F.col("name"), i, k)))
    subs = names.select("name", F.explode(F.array_distinct(F.flatten(starts))).alias("word"))
    short = counts.where(F.length("word") <= OPENING).join(subs.groupBy("word").agg(F.count("*").alias("names")), "word")
    hit = looked_up(subs, cut(short), ["word"], "names", ["name"]).where("uses is not null").select("name", "word", "uses")
    long = counts.where(F.length("word") > OPENING).select(F.col("word").alias("whole"), "uses", F.substring("word", 1, OPENING).alias("word"))
    hit = hit.unionByName(subs.where(F.length("word") == OPENING).join(long, "word").where(F.col("name").contains(F.col("whole"))).select("name", F.col("whole").alias("word"), "uses").distinct())
    # A name's group is bounded by its own substrings.
    found = hit.groupBy("name").agg(F.collect_list(F.struct("word", "uses")).alias("found"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [split_name(name, {x["word"]: x["uses"] for x in found_ or []}, total) for name, found_ in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.string()))], ["name", "words"])

    split = map_texts(names.join(found, "name", "left").select("name", "found"), work, "name string, words array<string>", "name")
    # Names in the order of the host; digits stay as they are.
    parts = hosts.select("host", F.posexplode(F.regexp_extract_all("host", F.lit("[a-z]+|[0-9]+"), F.lit(0))).alias("at", "name"))
    split = cut(split.join(parts.groupBy("name").agg(F.count("*").alias("uses")), "name"))
    named = looked_up(parts, split, ["name"], "uses", ["host"]).groupBy("host").agg(F.sort_array(F.collect_list(F.struct("at", F.coalesce("words", F.array("name")).alias("words")))).alias("all"))
    return named.select("host", F.flatten(F.transform("all", lambda x: x["words"])).alias("words"))


def tokens_of(words: Column, path: Column) -> Column:
    """Features: h: words of the host and p: tokens of the path."""
    parts = F.regexp_extract_all(F.lower(path), F.lit("[a-z]+|[0-9]+"), F.lit(0))
    return F.concat(F.transform(F.coalesce(words, F.array().cast("array<string>")), lambda w: F.concat(F.lit("h:"), w)), F.transform(parts, lambda w: F.concat(F.lit("p:"), w)))


def scored(rows: DataFrame, train: Column) -> DataFrame:
    """rows (uid, tokens, verdict or null) with score, the log-odds of blocking learnt from the ruled rows of `train`."""
    ruled = rows.where(F.col("verdict").isNotNull() & train)
    each = rows.select("uid", F.explode("tokens").alias("token"))
    uses = lambda verdict: F.count_if(F.col("train") & (F.col("verdict") == verdict))
    marked = rows.select(F.explode("tokens").alias("token"), "verdict", (F.col("verdict").isNotNull() & train).alias("train"))
    table = cut(marked.groupBy("token").agg(F.count("*").alias("uses"), uses("block").alias("block"), uses("allow").alias("allow")))
    seen = table.where("block + allow > 0").agg(F.count("*").alias("v"), F.sum("block").alias("b"), F.sum("allow").alias("a")).first()
    blocked, allowed = ruled.agg(F.count_if(F.col("verdict") == "block"), F.count_if(F.col("verdict") == "allow")).first()
    prior, size = log((blocked + 1) / (allowed + 1)), max(seen["v"], 1) * SMOOTHING
    of = lambda c: F.log((F.col(c) + SMOOTHING) / ((seen[c[0]] or 0) + size))
    # A token that no ruled url has tells nothing.
    weights = table.where("block + allow > 0").select("token", "uses", (of("block") - of("allow")).alias("weight"))
    sums = looked_up(each, weights, ["token"], "uses", ["uid"]).groupBy("uid").agg(F.sum("weight").alias("sum"))
    # Sums of doubles differ in their last digits with the order of rows.
    return rows.join(sums, "uid", "left").withColumn("score", F.round(F.lit(prior) + F.coalesce("sum", F.lit(0.0)), 9)).drop("sum")


def judge(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", rules: list[tuple[str, str, str]] = RULES, train: Column | None = None) -> DataFrame:
    """key, host, path, rule, verdict, tokens and score of every page; `train` may leave ruled hosts out of the fit."""
    host, path = host_and_path(F.col(url))
    parsed = pages.select(F.col(key).alias("key"), host.alias("host"), path.alias("path")).withColumn("ruled", rule_for(F.col("host"), F.col("path"), rules))
    # Numbered rows are checkpointed, so the numbers stay.
    parsed = cut(parsed.withColumn("uid", F.monotonically_increasing_id()))
    # What is left of the host and the path without the rule that fired.
    rest = F.when(F.col("ruled").isNull(), F.col("host")).otherwise(F.expr("substring(host, 1, greatest(length(host) - length(ruled.name), 0))"))
    tail = F.when(F.col("ruled").isNull(), F.col("path")).otherwise(F.expr("substring(path, length(ruled.prefix) + 1)"))
    parsed = parsed.withColumn("rest", rest).withColumn("tail", tail)
    uses = parsed.where("rest <> ''").groupBy("rest").agg(F.count("*").alias("uses"))
    split = segmented(uses.select(F.col("rest").alias("host")), word_counts(pages, html)).withColumnRenamed("host", "rest").join(uses, "rest")
    named = looked_up(parsed, cut(split), ["rest"], "uses", ["uid"])
    rows = cut(named.select("uid", "key", "host", "path", F.col("ruled.rule").alias("rule"), F.col("ruled.verdict").alias("verdict"), tokens_of(F.col("words"), F.col("tail")).alias("tokens")))
    found = scored(rows, train if train is not None else F.lit(True))
    verdict = F.coalesce("verdict", F.when(F.col("score") > 0, "block").otherwise("allow"))
    return found.select(F.col("key").alias(key), "host", "path", "rule", verdict.alias("verdict"), "tokens", "score")
