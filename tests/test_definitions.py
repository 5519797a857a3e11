"""Definition groups against a plain loop that takes them one after the other."""

import random

import pytest

from glossmill.operators import definitions


def norm(text):
    return (text or "").strip().lower()


def plain(store_rows, top, batch, overrides):
    """The same rules, record by record: rows in order of their writing as [id, lang, phrase, text]."""
    rows, out, conflicts, sources, status = [list(r) for r in store_rows], {}, [], {}, {}
    first = lambda lang, phrase: next((r for r in rows if r[1:3] == [lang, phrase]), None)
    for g in sorted({x[0] for x in batch}):
        group = sorted(x for x in batch if x[0] == g)
        hit = next((h[0] for _, _, lang, phrase, text, _ in group if (h := first(lang, phrase)) and norm(h[3]) == norm(text)), None)
        if hit is None:
            top += 1
            mine = top
        for _, r, lang, phrase, text, source in group:
            new_phrase, new_text = overrides.get((lang, phrase), (phrase, text))
            if hit is None:
                seen = set()
                for other in rows:
                    if other[1:3] == [lang, new_phrase] and other[0] != mine and norm(other[3]) != norm(text) and norm(other[3]) not in seen:
                        conflicts.append((other[0], mine))
                    seen |= {norm(other[3])} if other[1:3] == [lang, new_phrase] else set()
                rows.append([mine, lang, new_phrase, new_text])
                out[g, r] = ("new", mine)
                sources.setdefault(mine, []).append(source)
                continue
            head = first(lang, new_phrase)
            if head is None:
                rows.append([hit, lang, new_phrase, new_text])
                out[g, r] = ("add_lang", hit)
                sources.setdefault(hit, []).append(source)
            elif norm(head[3]) == norm(text):
                out[g, r] = ("merge", hit)
                sources.setdefault(hit, []).append(source)
                n = len(set(sources[hit]))
                status[hit] = "crystallized" if n >= 3 else "established" if n == 2 else status.get(hit, "emerging")
            else:
                top += 1
                rows.append([top, lang, new_phrase, new_text])
                conflicts.append((hit, top))
                out[g, r] = ("conflict", top)
                sources.setdefault(top, []).append(source)
    return out, rows, conflicts, status


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_batch_order_without_a_loop(spark, seed):
    rng = random.Random(seed)
    langs = ["en", "lt", "eo"]
    phrase = lambda: rng.choice("abcdefghijkl")
    text = lambda: rng.choice(["x", "X ", "y", "z", None])
    held = [(n, n, rng.choice(langs), phrase(), text()) for n in range(1, 6)]
    batch = [(g, r, lang, phrase(), text(), rng.choice(["s1", "s2", "s3", "s4"])) for g in range(30) for r, lang in enumerate(rng.sample(langs, rng.randrange(1, 4)))]
    overrides = {("en", "a"): ("b", "y"), ("lt", "c"): ("q", "z")}
    rows = spark.createDataFrame(held, definitions.ROW)
    concepts = spark.createDataFrame([(n, "document_specific", "emerging", False, "", "d") for n in range(1, 6)], definitions.CONCEPT)
    e = definitions.empty(spark)
    store = definitions.Definitions(concepts, rows, e.occurrences, e.conflicts)
    b = spark.createDataFrame(batch, definitions.BATCH)
    o = spark.createDataFrame([(lang, p, q, t) for (lang, p), (q, t) in overrides.items()], "lang string, phrase string, new_phrase string, new_definition string")
    want, want_rows, want_conflicts, want_status = plain([r[1:] for r in held], 5, batch, overrides)
    got = {(r.g, r.r): (r.action, r.id) for r in definitions.actions(store, b, o).collect()}
    assert got == want and {"new", "add_lang", "merge", "conflict"} >= {a for a, _ in want.values()} >= {"new", "merge", "conflict"}
    after = definitions.write(store, b, "d", o)
    assert [[r.id, r.lang, r.phrase, r.definition] for r in after.rows.orderBy("seq").collect()] == want_rows
    assert sorted((r.id_a, r.id_b) for r in after.conflicts.collect()) == sorted(want_conflicts)
    assert {r.id: r.status for r in after.concepts.where("status <> 'emerging'").collect()} == {i: s for i, s in want_status.items() if s != "emerging"}
    assert after.occurrences.count() == len(batch)


def test_a_long_chain_of_groups(spark):
    batch = [(g, r, "en" if r else "lt", f"p{g + r}", "d", f"s{g}") for g in range(40) for r in (0, 1)]
    batch = [(g, r, "en", phrase, text, s) for g, r, _, phrase, text, s in batch]
    got = definitions.write(definitions.empty(spark), spark.createDataFrame(batch, definitions.BATCH), "d")
    assert [(r.id, r.status, r.scope) for r in got.concepts.collect()] == [(1, "crystallized", "domain")]
    assert got.rows.count() == 41 and got.conflicts.count() == 0


def test_edges(spark):
    assert definitions.write(definitions.empty(spark), spark.createDataFrame([], definitions.BATCH), "d").concepts.count() == 0
    odd = [(1, 1, None, "a", "x", "s"), (1, 2, "en", None, "x", "s"), (None, 1, "en", "a", "x", "s"), (2, 1, "en", "a", None, None), (3, 1, "en", "a", "", "t")]
    got = definitions.write(definitions.empty(spark), spark.createDataFrame(odd, definitions.BATCH), "d")
    assert [(r.id, r.status) for r in got.concepts.collect()] == [(1, "established")]
