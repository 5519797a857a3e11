"""Association, area, risk and coverage formulas as column expressions."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The areas, in the order of the signature's digits.
AREAS = ["law", "tariff_regulation", "non_tariff_regulation", "customs_procedures", "origin", "classification", "valuation"]
CROSS_CUTTING = "cross_cutting"
#: Country and region terms (matched as substrings).
COUNTRY_TERMS = [
    "ireland", "irish", "ukraine", "ukrainian", "russia", "russian", "china", "chinese", "japan", "japanese", "korea",
    "korean", "india", "indian", "brazil", "brazilian", "germany", "german", "france", "french", "italy", "italian",
    "spain", "spanish", "portugal", "portuguese", "netherlands", "dutch", "belgium", "belgian", "poland", "polish",
    "lithuania", "lithuanian", "latvia", "latvian", "estonia", "estonian", "finland", "finnish", "sweden", "swedish",
    "denmark", "danish", "norway", "norwegian", "kingdom", "united kingdom", "uk", "eu", "european", "united states",
    "america", "american", "canada", "canadian", "mexico", "mexican", "africa", "african", "asia", "asian",
]
#: Organisations (matched as whole words).
ORGANISATIONS = ["afcfta", "ecowas", "asean", "ceta", "nafta", "usmca", "mercosur", "efta", "oecd", "wto", "wco", "un", "eu"]
#: Words of markup and style sheets.
MARKUP_WORDS = ["css", "flex", "display", "align", "font", "color", "border", "padding", "margin", "webkit", "html", "http", "www", "img", "javascript", "svg", "aria", "href", "src", "class"]
#: Part-of-speech shapes.
NOUN_LIKE, REJECT_ANY, REJECT_BOUNDARY = ["NOUN", "PROPN"], ["VERB", "AUX", "PRON", "DET", "ADV", "CCONJ", "SCONJ", "PART"], ["ADP", "DET"]


def quantised(x: Column, scale: int = 10_000) -> Column:
    """A whole number of units of 1/scale, rounded half up; the same in every engine."""
    return F.floor(x * scale + 0.5).cast("long")


def log2(x: Column) -> Column:
    return F.when(x > 0, F.ln(x) / F.ln(F.lit(2.0))).otherwise(0.0)


def pmi(joint: Column, sum_log2_parts: Column, size: Column | int, total: Column) -> Column:
    """log2 f + (n - 1) log2 N - sum of log2 f(w)."""
    return log2(joint) + ((size if isinstance(size, Column) else F.lit(size)) - 1) * log2(total) - sum_log2_parts


def g_squared(f12: Column, f1: Column, f2: Column, total: Column) -> Column:
    """Log-likelihood ratio over the four cells; cells without observed or expected count add nothing."""
    cells = [(f12, f1 * f2), (f1 - f12, f1 * (total - f2)), (f2 - f12, (total - f1) * f2), (total - f1 - f2 + f12, (total - f1) * (total - f2))]
    parts = [F.when((o > 0) & (e > 0), o * F.ln(o.cast("double") * total / e)).otherwise(0.0) for o, e in ((o, e.cast("double")) for o, e in cells)]
    return 2.0 * reduce(add, parts)


def pos_shape_ok(pattern: Column) -> Column:
    """Noun-phrase shapes; a null pattern passes."""
    tags = F.split(pattern, " ")
    allowed = F.array(*[F.lit(t) for t in [*NOUN_LIKE, "ADJ", "ADP"]])
    edge = lambda t: t.isin(REJECT_BOUNDARY)
    ok = (F.size(tags) >= 2) & F.forall(tags, lambda t: F.array_contains(allowed, t) & ~t.isin(REJECT_ANY)) & ~edge(F.element_at(tags, 1)) & ~edge(F.element_at(tags, -1)) & (F.size(F.filter(tags, lambda t: t == "ADP")) <= 1)
    return pattern.isNull() | ok


def area_signature(counts: list[Column]) -> Column:
    """One hexadecimal digit for each area: min(15, floor(16 D / max D))."""
    top = F.greatest(*counts)
    return F.concat(*[F.when(top > 0, F.hex(F.least(F.lit(15), F.floor(16 * c / top)).cast("long"))).otherwise("0") for c in counts])


def area_specificity(counts: list[Column]) -> Column:
    total = reduce(add, counts)
    return F.when(total > 0, F.greatest(*counts) / total).otherwise(0.0)


def ne_risk(pos: Column, surface: Column, phrase: Column, specificity: Column, total_doc_count: Column) -> Column:
    """Chance that a phrase is a name: weighted signals, at most 1."""
    tags = F.split(F.coalesce(pos, F.lit("")), " ")
    lower = F.lower(F.coalesce(phrase, F.lit("")))
    first = F.element_at(tags, 1) == "PROPN"
    parts = [
        F.when(first, 0.35).otherwise(0.0),
        F.when(first & F.forall(tags, lambda t: t == "PROPN"), 0.25).otherwise(0.0),
        F.when(F.coalesce(surface, phrase, F.lit("")).rlike(r"(?<![A-Za-z])[A-Z]{3,}(?![A-Za-z])"), 0.20).otherwise(0.0),
        F.when(lower.rlike("|".join(COUNTRY_TERMS)), 0.30).otherwise(0.0),
        F.when(F.arrays_overlap(F.split(lower, " "), F.array(*[F.lit(x) for x in ORGANISATIONS])), 0.30).otherwise(0.0),
        F.when((specificity == 1.0) & (total_doc_count <= 4), 0.20).otherwise(0.0),
    ]
    return F.least(F.lit(1.0), reduce(add, parts))


def confidence(frequency: Column, pmi_value: Column) -> Column:
    p = F.coalesce(pmi_value, F.lit(0.0))
    return F.when((frequency >= 5) & (p >= 15), "high").when((frequency >= 3) & (p >= 10), "medium").otherwise("low")


def is_markup_noise(phrase: Column) -> Column:
    return F.arrays_overlap(F.split(F.lower(phrase), " "), F.array(*[F.lit(w) for w in MARKUP_WORDS]))


def review_bucket(n_areas: Column, n_low_scorers: Column, specificity: Column, risk: Column) -> Column:
    return F.when(n_areas >= 4, 1).when(n_low_scorers > 0, 2).when((n_areas >= 1) & (specificity >= 0.5) & (risk < 0.5), 3).otherwise(4)


def lifecycle(n_sources: Column, current: Column | None = None) -> Column:
    """Never downgrades: below two sources the current status stays."""
    kept = current if current is not None else F.lit("emerging")
    return F.when(n_sources >= 3, "crystallized").when(n_sources >= 2, "established").otherwise(kept)


def root_tier(productivity: Column) -> Column:
    return F.when(productivity >= 3, "core").when(productivity == 2, "extended").otherwise("tail")


def coverage_columns(t1: Column, t2: Column, t3: Column, t4: Column, unknown: Column) -> dict[str, Column]:
    """total, common, domain, ratio, signal, basis and band of classified units."""
    total = t1 + t2 + t3 + t4 + unknown
    common = F.when(total > 0, (t1 + t2) / total).otherwise(0.0)
    domain = F.when(total > 0, t4 / total).otherwise(0.0)
    ratio = F.when(common > 0, domain / common).otherwise(0.0)
    signal = F.when(common > 0, domain / common).otherwise(domain)
    band = F.when(signal < 0.05, "general audience").when(signal < 0.20, "mixed audience").otherwise("specialist")
    return {"total": total, "common": common, "domain": domain, "ratio": ratio, "signal": signal, "basis": F.when(common > 0, "t4_vs_common").otherwise("t4_vs_total"), "band": band}
