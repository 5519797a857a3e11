"""Roots of an agglutinating language: productivity, tiers and decomposition of words."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossmill.functions.scores import root_tier
from glossmill.functions.text import strip_flexion
from glossmill.scratch import settled

#: Affixes and number roots of standard Esperanto.
SUFFIXES = ["aĉ", "ad", "aĵ", "an", "ant", "ar", "at", "ĉj", "ebl", "ec", "eg", "ej", "em", "end", "er", "estr", "et", "id", "ig", "iĝ", "il", "in", "ind", "ing", "int", "ism", "ist", "it", "nj", "obl", "on", "ont", "op", "ot", "uj", "ul", "um"]
PREFIXES = ["bo", "ĉef", "dis", "ek", "eks", "fi", "ge", "mal", "mem", "mis", "pra", "re", "vic", "ekster", "kontraŭ", "sen", "sub", "super", "trans"]
PREPOSITIONS = ["inter", "laŭ", "kun", "al", "el", "en", "sur", "tra", "pri", "pro", "per", "post", "antaŭ", "ĉirkaŭ", "preter"]
NUMBER_ROOTS = ["nul", "unu", "du", "tri", "kvar", "kvin", "ses", "sep", "ok", "naŭ", "dek", "cent", "mil"]
LEAST_STEM = 3


def parse_dictionary(lines: DataFrame) -> DataFrame:
    """stem and gloss from lines `head : gloss` (value, line_no); the first gloss of a stem wins."""
    head = F.trim(F.regexp_extract("value", r"^(.*?) : ", 1))
    gloss = F.trim(F.regexp_extract("value", r"^.*? : (.*)$", 1))
    fine = F.col("value").contains(" : ") & head.rlike("^[a-zĉĝĥĵŝŭ]+$")
    return lines.where(fine).select(strip_flexion(head).alias("stem"), gloss.alias("gloss"), "line_no").groupBy("stem").agg(F.min_by("gloss", "line_no").alias("gloss"))


def reduce_once(stems: DataFrame, attested: DataFrame) -> DataFrame:
    """stem and its reduction: the longest suffix, else the longest prefix, whose removal leaves an attested stem."""
    tries = []
    for rank, (kind, affixes) in enumerate((("suffix", SUFFIXES), ("prefix", PREFIXES))):
        for affix in affixes:
            n = len(affix)
            if kind == "suffix":
                fits, rest = F.col("stem").endswith(affix), F.substring(F.col("stem"), F.lit(1), F.length("stem") - n)
            else:
                fits, rest = F.col("stem").startswith(affix), F.substring(F.col("stem"), F.lit(n + 1), F.length("stem"))
            tries.append(F.when(fits & (F.length("stem") - n >= LEAST_STEM), F.struct(F.lit(rank).alias("rank"), F.lit(-n).alias("neg"), rest.alias("rest"))))
    shown = stems.select("stem", F.explode(F.array_compact(F.array(*tries))).alias("t"))
    left = shown.join(attested.select(F.col("stem").alias("rest")).distinct(), F.col("t.rest") == F.col("rest"), "left_semi")
    return left.groupBy("stem").agg(F.min("t").alias("t")).select("stem", F.col("t.rest").alias("reduced"))


def primitives(stems: DataFrame) -> DataFrame:
    """stem and the primitive root it comes down to, however many affixes it has.

    Each round joins the reductions with themselves, so a chain of n affixes takes log n rounds; as a reduction
    is shorter than its stem, the rounds end.
    """
    attested = settled(stems.select("stem").where("stem is not null").distinct(), "stems")
    numbers = stems.sparkSession.createDataFrame([(x,) for x in NUMBER_ROOTS], "stem string")
    known = attested.unionByName(numbers).distinct()
    step = settled(reduce_once(known, known), "reductions")
    while True:
        further = step.select(F.col("stem").alias("reduced"), F.col("reduced").alias("next"))
        step = settled(step.join(further, "reduced", "left").select("stem", F.coalesce("next", "reduced").alias("reduced"), F.col("next").isNotNull().alias("moved")), "reductions")
        if step.where("moved").isEmpty():
            break
        step = step.drop("moved")
    return attested.join(step, "stem", "left").select("stem", F.coalesce("reduced", "stem").alias("root"))


def productivity(stems: DataFrame) -> DataFrame:
    """root, productivity (stems that come down to it) and tier; number roots count once at least."""
    numbers = stems.sparkSession.createDataFrame([(x,) for x in NUMBER_ROOTS], "root string")
    counts = primitives(stems).groupBy("root").agg(F.count("*").alias("n"))
    counts = counts.join(numbers.withColumn("number", F.lit(1)), "root", "full").select("root", F.greatest(F.coalesce("n", F.lit(0)), F.coalesce("number", F.lit(0))).cast("long").alias("productivity"))
    return counts.withColumn("tier", root_tier(F.col("productivity")))


class Decomposer:
    """Splits a stem to prefixes, roots, connectors and suffixes over an inventory.

    roots: root -> (tier, productivity). A solid root (a number root, core, extended, or attested at least twice)
    is never split, wherever it stands. Other strings are an attested root as a whole, a prefix or a suffix with
    an analysable rest, or any root, a connector or none, and an analysable rest. The analysis with the best
    worst tier wins, then the one with the fewest parts, then the one with the longest first root; exact ties go
    to the whole, then prefixes, suffixes and roots, the longest first. Rests are shorter than what they are
    rests of, and are worked off a stack, so no depth is too deep.
    """

    RANK = {"core": 0, "extended": 1, "tail": 2}
    #: Analyses remembered before the memory starts anew.
    MOST = 200_000

    def __init__(self, roots: dict[str, tuple[str, int]], words: tuple[str, ...] = (), suffixes: list[str] = SUFFIXES, prefixes: list[str] | None = None, numbers: list[str] = NUMBER_ROOTS):
        self.words, self.numbers = set(words), set(numbers)
        self.roots = {**roots, **{n: ("core", max(1, roots[n][1] if n in roots else 1)) for n in numbers}}
        by_length = lambda some: sorted(set(some), key=lambda x: (-len(x), x))
        self.suffixes, self.prefixes = by_length(suffixes), by_length(prefixes if prefixes is not None else [*PREFIXES, *PREPOSITIONS])
        self.longest = max(map(len, self.roots), default=0)
        self.known: dict[str, tuple | None] = {}

    def solid(self, stem: str) -> bool:
        tier, n = self.roots.get(stem, ("", 0))
        return tier in ("core", "extended") or n >= 2

    def rank(self, root: str) -> int:
        return self.RANK[self.roots[root][0]]

    def _steps(self, stem: str) -> Iterator[tuple[str, str, str, str]]:
        """(kind, affix or root, connector, rest) of every way to take a part off."""
        for p in self.prefixes:
            if len(p) < len(stem) and stem.startswith(p):
                yield "prefix", p, "", stem[len(p) :]
        for x in self.suffixes:
            if len(x) < len(stem) and stem.endswith(x):
                yield "suffix", x, "", stem[: -len(x)]
        for i in range(min(len(stem) - 1, self.longest), 1, -1):
            if stem[:i] in self.roots:
                yield "root", stem[:i], "", stem[i:]
                if stem[i] in "oaei" and i + 1 < len(stem):
                    yield "root", stem[:i], stem[i], stem[i + 1 :]

    def _best(self, stem: str) -> tuple | None:
        """(worst rank, parts, -length of the first root, prefixes, roots, connectors, suffixes) from the rests' analyses."""
        shown = [(self.rank(stem), 1, -len(stem), (), (stem,), (), ())] if stem in self.roots else []
        for kind, part, joint, rest in self._steps(stem):
            r = self.known[rest]
            if r is None:
                continue
            rank, parts, first, prefixes, roots, joints, suffixes = r
            if kind == "prefix":
                shown.append((rank, parts + 1, first, (part, *prefixes), roots, joints, suffixes))
            elif kind == "suffix":
                shown.append((rank, parts + 1, first, prefixes, roots, joints, (*suffixes, part)))
            else:
                shown.append((max(rank, self.rank(part)), parts + 1, -len(part), prefixes, (part, *roots), (joint, *joints), suffixes))
        return min(shown, key=lambda x: x[:3]) if shown else None

    def analyse(self, stem: str) -> tuple | None:
        if len(self.known) > self.MOST:
            self.known.clear()
        stack = [stem]
        while stack:
            top = stack[-1]
            if top in self.known:
                stack.pop()
            elif self.solid(top):
                self.known[top] = (self.rank(top), 1, -len(top), (), (top,), (), ())
            else:
                open_ = [rest for *_, rest in self._steps(top) if rest not in self.known]
                if open_:
                    stack += open_
                else:
                    self.known[top] = self._best(top)
        return self.known[stem]

    def within(self, roots: dict[str, tuple[str, int]]) -> Decomposer:
        """Itself over other roots, what it remembers left behind."""
        self.roots = {**roots, **{n: ("core", max(1, roots[n][1] if n in roots else 1)) for n in self.numbers}}
        self.longest, self.known = max(map(len, self.roots), default=0), {}
        return self

    def decompose(self, stem: str) -> dict:
        stem = stem.strip().lower()
        nothing = {"prefixes": [], "roots": [], "connectors": [], "suffixes": [], "morphemes": 0, "head_tier": None, "category": None}
        if stem in self.words or (stem.endswith("n") and stem[:-1] in self.words):
            return {**nothing, "kind": "function_word", "morphemes": 1}
        r = self.analyse(stem) if stem else None
        if r is None:
            return {**nothing, "kind": "unresolved", "category": self.category(stem)}
        kind = "compound" if len(r[4]) > 1 else "simple" if r[1] == 1 else "derived"
        return {"kind": kind, "prefixes": list(r[3]), "roots": list(r[4]), "connectors": list(r[5]), "suffixes": list(r[6]), "morphemes": r[1], "head_tier": self.roots[r[4][-1]][0], "category": None}

    def category(self, stem: str) -> str:
        """Why a stem has no analysis: an artifact (up to two letters, a bare affix), a compound number or unknown."""
        if len(stem) <= 2 or stem in self.suffixes or stem in self.prefixes:
            return "artifact"
        opening = max((n for n in self.numbers if stem.startswith(n) and stem != n), key=len, default=None)
        return "compound_number" if opening and any(stem[len(opening) :].startswith(n) for n in self.numbers) else "unknown"


DECOMPOSED = "stem string, kind string, prefixes array<string>, roots array<string>, connectors array<string>, suffixes array<string>, morphemes int, head_tier string, category string"
ROOTS = "root string, tier string, productivity long"
#: Strings of stems up to this length meet the roots as they are; longer roots meet them by an opening of this length.
OPENING = 32
#: Roots that are broadcast at most; more of them meet the stems' strings in a shuffle.
MOST_BROADCAST = 400_000
FOUND = "root:string,tier:string,productivity:bigint"


def named_roots(roots: DataFrame) -> DataFrame:
    """root, tier and productivity in lower case, each root once."""
    named = roots.select(F.lower("root").alias("root"), "tier", F.coalesce("productivity", F.lit(0)).cast("long").alias("productivity"))
    return named.groupBy("root").agg(F.max_by(F.struct("tier", "productivity"), "productivity").alias("v")).select("root", "v.*")


def roots_within(stems: DataFrame, roots: DataFrame, few: bool = False) -> DataFrame:
    """stem and `found`, the named roots that stand somewhere in it; stems without any have null.

    A stem's own strings meet the roots by key, so the inventory may be of any size; `few` says that it is small enough
    for a broadcast.
    """
    low = stems.select("stem", F.lower(F.trim("stem")).alias("_low"))
    n = F.length("_low")
    openings = F.transform(F.sequence(F.lit(1), n), lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(OPENING), n - i + 1)), lambda k: F.substring(F.col("_low"), i, k)))
    parts = low.where(n > 0).select("stem", "_low", F.explode(F.array_distinct(F.flatten(openings))).alias("part"))
    keyed = roots.select("root", "tier", "productivity", F.substring("root", 1, OPENING).alias("part"))
    met = parts.join(keyed.hint("broadcast" if few else "merge"), "part").where((F.length("root") <= OPENING) | F.col("_low").contains(F.col("root")))
    found = met.groupBy("stem").agg(F.collect_list(F.struct("root", "tier", "productivity")).alias("found"))
    return stems.select("stem").join(found, "stem", "left")


def roots_needed(stems: DataFrame, named: DataFrame) -> DataFrame:
    """stem and `found`, those roots within it that its analysis can use.

    A solid root needs itself alone, as it is never split. Any other root is its own analysis of the last rank in one
    part, which only an analysis of solid roots can beat, so it needs those. All other stems need every root.
    """
    solid = F.col("tier").isin("core", "extended") | (F.col("productivity") >= 2) | F.col("root").isin(NUMBER_ROOTS)
    own = stems.select("stem", F.when(F.col("stem").rlike(r"^\p{L}+$"), F.lower("stem")).alias("root")).join(named.hint("merge"), "root", "left")
    itself = F.struct("root", "tier", "productivity")
    marked = settled(own.select("stem", F.when(F.col("tier").isNotNull(), itself).alias("itself"), (F.col("tier").isNotNull() & F.coalesce(solid, F.lit(False))).alias("solid")), "stems-and-roots")
    known = F.col("itself").isNotNull()
    bearing = named.where(solid)
    few = bearing.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST
    split = roots_within(marked.where(known & ~F.col("solid")), bearing, few).join(marked.select("stem", "itself"), "stem")
    split = split.select("stem", F.concat(F.coalesce("found", F.array().cast(f"array<struct<{FOUND}>>")), F.array("itself")).alias("found"))
    return marked.where("solid").select("stem", F.array("itself").alias("found")).unionByName(split).unionByName(roots_within(marked.where(~known), named))


def decompose(stems: DataFrame, roots: DataFrame, words: tuple[str, ...] = ()) -> DataFrame:
    """Each distinct stem once, over those roots (root, tier, productivity) within it that its analysis can use."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decomposer, columns = Decomposer({}, words), [c.split(" ")[0] for c in DECOMPOSED.split(", ")]
        for pdf in batches:
            out = []
            for stem, found in zip(pdf["stem"], pdf["found"], strict=True):
                own = {r["root"]: (r["tier"], r["productivity"]) for r in found} if found is not None else {}
                out.append({"stem": stem, **decomposer.within(own).decompose(stem)})
            yield pd.DataFrame(out, columns=columns)

    named = settled(named_roots(roots), "roots")
    return roots_needed(stems.select("stem").where("stem is not null").distinct(), named).mapInPandas(work, DECOMPOSED)


def concept_roots(concepts: DataFrame, decomposed: DataFrame) -> DataFrame:
    """concept_id, root, position, is_head: the last root is the head."""
    joined = concepts.join(decomposed, "stem")
    return joined.select("concept_id", F.posexplode("roots").alias("position", "root"), (F.size("roots") - 1).alias("last")).select("concept_id", "root", "position", (F.col("position") == F.col("last")).alias("is_head"))


def rebuilt_concepts(concepts: DataFrame, roots: DataFrame, words: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """The tables concepts and concept_root anew from concepts (concept_id, eo_word, ...) and an inventory, for a new snapshot.

    A concept gets the kind of its word (null without one), the tier of its head and its number of morphemes; earlier values go.
    """
    made = ["eo_kind", "eo_head_tier", "eo_morphemes"]
    stemmed = concepts.drop(*made).withColumn("stem", strip_flexion(F.lower(F.trim("eo_word"))))
    done = settled(decompose(stemmed.select("stem"), roots, words), "decomposed")
    values = done.select("stem", F.col("kind").alias("eo_kind"), F.col("head_tier").alias("eo_head_tier"), F.col("morphemes").alias("eo_morphemes"))
    return {"concepts": stemmed.join(values, "stem", "left").drop("stem"), "concept_root": concept_roots(stemmed.select("concept_id", "stem"), done)}


def decomposition_summary(decomposed: DataFrame) -> DataFrame:
    """Stems by kind, tier of the head (the last root) and category of what is unresolved."""
    return decomposed.groupBy("kind", "head_tier", "category").agg(F.count("*").alias("n"))


def root_support(concept_roots: DataFrame) -> DataFrame:
    """root and the number of distinct concepts that have it."""
    return concept_roots.select("root", "concept_id").distinct().groupBy("root").agg(F.count("*").alias("n_concepts"))


def write_inventory(counts: DataFrame, folder: str) -> None:
    """An inventory of roots (root, productivity, tier[, gloss]) as a folder, written by the tasks that hold the roots.

    roots: JSON lines in the order of the roots; list: the roots alone, one a line; affixes: one JSON document.
    """
    gloss = F.coalesce("gloss", F.lit("")) if "gloss" in counts.columns else F.lit("")
    ordered = settled(counts.select("root", gloss.alias("gloss"), F.col("productivity").alias("prod"), "tier").orderBy("root"), "inventory")
    ordered.write.json(f"{folder}/roots")
    ordered.select("root").write.text(f"{folder}/list")
    affixes = {"suffixes": SUFFIXES, "prefixes": [*PREFIXES, *PREPOSITIONS], "correlatives": [], "other": [], "number_roots": NUMBER_ROOTS}
    counts.sparkSession.createDataFrame([(json.dumps(affixes, ensure_ascii=False),)], "value string").write.text(f"{folder}/affixes")


def read_inventory(spark, folder: str) -> tuple[DataFrame, tuple[str, ...]]:
    """Roots (root, tier, productivity) and function words of such a folder; raises where a part is missing or roots have no tier."""
    found = json.loads("".join(r["value"] for r in spark.read.text(f"{folder}/affixes").collect()))
    missing = [k for k in ("suffixes", "prefixes", "correlatives", "other", "number_roots") if k not in found]
    if missing:
        raise ValueError(f"inventory: missing {', '.join(missing)}")
    roots = spark.read.schema("root string, gloss string, prod long, tier string").json(f"{folder}/roots")
    if not roots.where("root IS NULL OR tier IS NULL").isEmpty():
        raise ValueError("inventory: roots must state gloss, prod and tier")
    return roots.select("root", "tier", F.col("prod").alias("productivity")), tuple(w.lower() for w in (*found["correlatives"], *found["other"]))


def root_table(spark, roots: dict[str, tuple[str, int]]) -> DataFrame:
    """A stated inventory as a table of roots."""
    return spark.createDataFrame([(r, tier, n) for r, (tier, n) in roots.items()], ROOTS)


def load_inventory(document: str) -> tuple[dict[str, tuple[str, int]], tuple[str, ...]]:
    """Roots and function words of an inventory's JSON; raises where a key is missing or roots have no tier."""
    found = json.loads(document)
    missing = [k for k in ("roots", "suffixes", "prefixes", "correlatives", "other", "number_roots") if k not in found]
    if missing:
        raise ValueError(f"inventory: missing {', '.join(missing)}")
    if any(not isinstance(v, dict) or "tier" not in v for v in found["roots"].values()):
        raise ValueError("inventory: roots must state gloss, prod and tier")
    return {k.lower(): (v["tier"], int(v.get("prod", 0))) for k, v in found["roots"].items()}, tuple(w.lower() for w in (*found["correlatives"], *found["other"]))
