"""Throttling as a stream against a loop that takes clicks one after the other."""

import random
import zlib
from collections import Counter
from datetime import datetime, timedelta

import numpy as np
import pytest

from glossmill.llm import throttle

SCHEMA = "click_id long, ts timestamp_ntz, arrived_at timestamp_ntz, client_id long, kind string, batch int, outcome string"
START = datetime(2024, 1, 1)


def us(t):
    return round((t - datetime(1970, 1, 1)) / timedelta(microseconds=1))


def plain(rows, batches):
    cost, rows = throttle.COST, [r for r in set(rows) if r[1] is not None and r[3] is not None]
    hours = [us(r[2]) // throttle.HOUR for r in rows if r[2] is not None]
    lo, hi = (min(hours), max(hours)) if hours else (0, 0)
    per = [[] for _ in range(batches)]
    for click, ts, arrived, client, *_ in rows:
        k = batches - 1
        if arrived is not None:
            moved = click is not None and zlib.crc32(str(click).encode()) % 7 == 0
            k = min(k, (us(arrived) // throttle.HOUR - lo) * batches // (hi - lo + 1) + moved)
        per[k].append((us(ts), click is not None, click or 0, client))
    seen, waiting, state, out = None, [], {}, Counter()
    for k in range(batches):
        w, final = None if seen is None else seen - throttle.DELAY, k == batches - 1
        for c in per[k]:
            if w is not None and c[0] < w:
                out[(c[2] if c[1] else None, "late", k, None, None, None)] += 1
            else:
                waiting.append(c)
        due = sorted(c for c in waiting if final or w is not None and c[0] < w)
        waiting = [c for c in waiting if not (final or w is not None and c[0] < w)]
        for ts, known, click, client in due:
            credit, last, start = state.get(client, (2 * cost, ts, None))
            credit = min(2 * cost, credit + ts - last)
            click = click if known else None
            if credit >= cost:
                state[client] = (credit - cost, ts, None)
                out[(click, "admitted", k, credit - cost, None, None)] += 1
            else:
                start = ts if start is None else start
                state[client] = (credit, ts, start)
                out[(click, "throttled", k, credit, start, ts + cost - credit)] += 1
        if per[k]:
            seen = max([c[0] for c in per[k]] + ([seen] if seen is not None else []))
    return out


def clicks(seed, n):
    """Bursts, long pauses, exact ticks, ties, late and repeated rows, nulls; one client has a third of all rows."""
    rng = random.Random(seed)
    at, rows = {}, []
    for i in range(n):
        client = 7 if rng.random() < 0.35 else rng.randrange(5)
        step = rng.choice([0, 1, 20, 300, 600, 600, 1200, 1201, 2000, 40_000]) + rng.choice([0, 0, 0.5])
        at[client] = at.get(client, START) + timedelta(seconds=step)
        arrived = at[client] + timedelta(hours=rng.choice([0, 0, 0, 1, 30, 60, 200]))
        rows.append((i, at[client], arrived, client, "a", 1, "x"))
    rows += rows[:20]
    rows += [(None, rows[5][1], rows[5][2], 7, None, None, None), (n, None, START, 1, "a", 1, "x"), (n + 1, START, START, None, "a", 1, "x"), (n + 2, rows[9][1], None, 2, "a", 1, "x"), (3, *rows[3][1:4], "other", 2, "y")]
    return rows


@pytest.mark.parametrize(("seed", "batches"), [(1, 12), (2, 5)])
def test_against_a_plain_loop(spark, seed, batches):
    rows = clicks(seed, 400)
    got = Counter(tuple(r) for r in throttle.throttle(spark.createDataFrame(rows, SCHEMA), batches).collect())
    assert got == plain(rows, batches)
    assert {o for _, o, *_ in got} == {"admitted", "throttled", "late"}


def test_query_registered_and_empty_tables(spark, tmp_path):
    import __spark_entry__ as e

    rows = clicks(3, 60)
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "clicks.parquet"))
    found = e.queries()["op12_click_throttling"](spark, str(tmp_path))
    assert found.columns == ["click_id", "outcome", "batch", "credit_after", "penalty_start_us", "penalty_end_us"]
    assert Counter(tuple(r) for r in found.collect()) == plain(rows, 12)
    assert throttle.throttle(spark.createDataFrame([], SCHEMA), 2).collect() == []


def test_settlement_in_parts_equals_the_whole():
    rng = random.Random(9)
    for _ in range(40):
        ts = np.sort(np.array([rng.randrange(0, 40 * throttle.COST) for _ in range(rng.randrange(1, 120))], np.int64))
        whole = throttle.settle(ts, 2 * throttle.COST, int(ts[0]), None)
        cut = rng.randrange(0, len(ts) + 1)
        a = throttle.settle(ts[:cut], 2 * throttle.COST, int(ts[0]), None)
        b = throttle.settle(ts[cut:], *a[4])
        for x, y, z in zip(whole[:4], a[:4], b[:4], strict=True):
            assert (x == np.concatenate([y, z])).all()
        assert whole[4] == b[4]


def test_one_round_for_each_admission(monkeypatch):
    rounds = []
    search = np.searchsorted
    monkeypatch.setattr(throttle.np, "searchsorted", lambda *a, **k: rounds.append(1) or search(*a, **k))
    ts = np.arange(0, 10 * throttle.COST, 1000, dtype=np.int64)
    admitted = throttle.settle(ts, 2 * throttle.COST, 0, None)[1]
    assert admitted.sum() == 11 and len(rounds) <= 11


def test_chains_restart_where_credit_is_full(spark):
    import pandas as pd

    c = throttle.COST
    lows = [0, c, 2 * c + 5, 5 * c, 6 * c + 1, 8 * c]
    stretches = pd.DataFrame({"client_id": 1, "stretch": [x // c for x in lows], "low": lows, "high": lows, "n": 1})
    found = throttle.chains(stretches, pd.DataFrame(columns=["client_id", "t0", "last", "alone"]))
    # Without a second click before t0 + COST credit is full again.
    assert found[~found["head"]]["t0"].tolist() == [0, c, 2 * c + 5, 5 * c, 6 * c + 1, 8 * c]
    busy = throttle.chains(stretches.assign(n=2), pd.DataFrame(columns=["client_id", "t0", "last", "alone"]))
    assert busy[~busy["head"]]["t0"].tolist() == [0, 0, 0, 5 * c, 5 * c, 8 * c]
