"""Renderers of small results: the only place where rows come to the driver, each behind a bound."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_ROWS = 10_000


def _rows(df: DataFrame, most: int = MOST_ROWS) -> list:
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a report shows at most {most} rows")
    return rows


def percent(part: float, whole: float) -> str:
    return f"{100 * part / whole:.1f}%" if whole else "0.0%"


def coverage_text(summary: DataFrame) -> str:
    """A block for each row of coverage counts with their summary."""
    out = []
    for r in _rows(summary):
        out += [f"document {r['doc_id']}", *(f"  {name:<8}{r[key]:>8}  {percent(r[key], r['total'])}" for name, key in (("TIER1", "t1"), ("TIER2", "t2"), ("TIER3", "t3"), ("TIER4", "t4"), ("UNKNOWN", "unknown"))), f"  domain/common {r['ratio']:.2f} ({r['basis']}): {r['band']}"]
    return "\n".join(out)


def coverage_json(summary: DataFrame) -> str:
    return json.dumps([r.asDict() for r in _rows(summary)], ensure_ascii=False)


def conflict_text(conflicts: DataFrame) -> str:
    return "\n".join(f"{r['phrase']}: {r['id_a']} / {r['id_b']}\n  {r['divergence_detail']}" for r in _rows(conflicts))


def stratum_table(averages: DataFrame) -> str:
    rows = _rows(averages.orderBy("stratum"))
    names = averages.columns
    return "\n".join(["\t".join(names), *("\t".join("" if r[n] is None else str(r[n]) for n in names) for r in rows)])


def bucket_summary(routed: DataFrame) -> str:
    rows = _rows(routed.groupBy("bucket").agg(F.count("*").alias("n"), F.sort_array(F.collect_list(F.struct(-F.col("total_doc_count"), "phrase"))).alias("top")).select("bucket", "n", F.slice("top", 1, 5).alias("top")).orderBy("bucket"))
    return "\n".join(f"bucket {r['bucket']}: {r['n']} ({', '.join(x['phrase'] for x in r['top'])})" for r in rows)


def low_percent(value: float, control: float) -> str:
    """Ratio of two means; endless where the control is nothing."""
    return "∞" if control == 0 else f"{value / control:.2f}"
