"""Scalar functions against stated values."""

import math

import pytest
from pyspark.sql import functions as F

from glossmill.functions import scores, text


def one(spark, **columns):
    """A row of the given columns, evaluated."""
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


@pytest.mark.parametrize(
    ("phrase", "expected"),
    [("muitų principą", "muitų principas"), ("ekonominės veiklos", "ekonominės veikla"), ("muitų mokestį", "muitų mokestis"), ("os", "os"), ("kūnui", "kūnus"), ("", "")],
)
def test_nominative(spark, phrase, expected):
    assert one(spark, x=text.nominative_lt(F.lit(phrase))).x == expected


@pytest.mark.parametrize(("word", "stem"), [("patrojn", "patr"), ("vidas", "vid"), ("hundo", "hund"), ("o", "o"), ("kuri", "kur"), ("jn", ""), ("bele", "bel")])
def test_flexion(spark, word, stem):
    assert one(spark, x=text.strip_flexion(F.lit(word))).x == stem


def test_normalise(spark):
    r = one(spark, a=text.normalise(F.lit("  Dual-Use, ITEMS! é")), b=text.normalise(F.lit(None).cast("string")), c=text.normalise_definition(F.lit("  A b\n")), d=text.slug(F.lit("Time Release Study(TRS) / x")))
    assert (r.a, r.b, r.c, r.d) == ("dual use items", "", "a b", "time-release-study-x")


@pytest.mark.parametrize(("line", "noise"), [("", True), ("short", True), ("1234567890123", True), ("Nr. XII-100, long enough line", True), ("teksto publikigita en la TAR hodiaŭ", True), ("a line of real text", False)])
def test_noise(spark, line, noise):
    assert one(spark, x=text.is_noise_line(F.lit(line))).x is noise


def test_association(spark):
    f = lambda *xs: [F.lit(float(x)) for x in xs]
    f12, f1, f2, n = f(3, 3, 3, 11)
    r = one(spark, pmi=scores.pmi(f12, scores.log2(f1) + scores.log2(f2), 2, n), g2=scores.g_squared(f12, f1, f2, n), zero=scores.log2(F.lit(0.0)))
    assert math.isclose(r.pmi, math.log2(33 / 9), rel_tol=1e-9)
    assert abs(r.g2 - 12.89) < 0.1
    assert r.zero == 0.0


@pytest.mark.parametrize(
    ("counts", "signature", "specificity"),
    [((40, 0, 0, 0, 20, 5, 0), "F000820", 40 / 65), ((10, 0, 0, 0, 40, 0, 0), "4000F00", 0.8), ((3,) * 7, "FFFFFFF", 1 / 7), ((0,) * 7, "0000000", 0.0)],
)
def test_signature(spark, counts, signature, specificity):
    columns = [F.lit(c) for c in counts]
    r = one(spark, s=scores.area_signature(columns), p=scores.area_specificity(columns))
    assert r.s == signature
    assert math.isclose(r.p, specificity)


@pytest.mark.parametrize(
    ("pattern", "ok"),
    [("ADJ NOUN", True), ("NOUN ADP NOUN", True), ("PROPN NOUN", True), ("NOUN ADJ", True), (None, True), ("NOUN", False), ("VERB NOUN", False), ("ADP NOUN", False), ("NOUN ADP", False), ("NOUN ADP NOUN ADP NOUN", False), ("NOUN NUM", False), ("DET NOUN", False)],
)
def test_pos_shape(spark, pattern, ok):
    assert one(spark, x=scores.pos_shape_ok(F.lit(pattern).cast("string"))).x is ok


@pytest.mark.parametrize(("freq", "pmi", "tier"), [(5, 15.0, "high"), (4, 15.0, "medium"), (3, 10.0, "medium"), (2, 30.0, "low"), (9, None, "low"), (5, 14.9, "medium")])
def test_confidence(spark, freq, pmi, tier):
    assert one(spark, x=scores.confidence(F.lit(freq), F.lit(pmi).cast("double"))).x == tier


def test_name_risk(spark):
    risk = lambda pos, surface, phrase, spec, n: scores.ne_risk(F.lit(pos).cast("string"), F.lit(surface).cast("string"), F.lit(phrase), F.lit(spec), F.lit(n))
    r = one(spark, a=risk("PROPN PROPN", None, "customs duty", 0.5, 9), b=risk("NOUN", "WTO rules", "wto rules", 0.5, 9), c=risk(None, None, "neutral ground", 0.5, 9), d=risk(None, None, "plain words", 1.0, 4), e=risk("PROPN PROPN", "EU WTO", "eu wto", 1.0, 1))
    assert [round(x, 4) for x in r] == [0.6, 0.5, 0.3, 0.2, 1.0]


@pytest.mark.parametrize(("n", "current", "status"), [(1, "emerging", "emerging"), (2, "emerging", "established"), (3, "established", "crystallized"), (1, "crystallized", "crystallized")])
def test_lifecycle(spark, n, current, status):
    assert one(spark, x=scores.lifecycle(F.lit(n), F.lit(current))).x == status


@pytest.mark.parametrize(
    ("counts", "band", "basis"),
    [((0, 0, 0, 4, 0), "specialist", "t4_vs_total"), ((6, 1, 0, 1, 0), "mixed audience", "t4_vs_common"), ((10, 0, 0, 0, 2), "general audience", "t4_vs_common"), ((0, 0, 0, 0, 0), "general audience", "t4_vs_total")],
)
def test_bands(spark, counts, band, basis):
    r = one(spark, **scores.coverage_columns(*[F.lit(c) for c in counts]))
    assert (r.band, r.basis) == (band, basis)


@pytest.mark.parametrize(("args", "bucket"), [((4, 0, 0.9, 0.0), 1), ((2, 1, 0.9, 0.0), 2), ((1, 0, 0.5, 0.4), 3), ((1, 0, 0.5, 0.5), 4), ((0, 0, 0.9, 0.0), 4)])
def test_buckets(spark, args, bucket):
    assert one(spark, x=scores.review_bucket(*[F.lit(a) for a in args])).x == bucket
