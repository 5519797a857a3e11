"""SimHash groups, suffix and line deduplication against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from glossmill.llm import lines, simhash, suffixes
from glossmill.llm.graph import components, least_reached

SCHEMA = "doc_id long, text string, lang string, fp string, k string"


def frame(spark, texts, parts=3):
    """Rows with extra columns, some of whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "en", "x", "y") for i, t in texts], SCHEMA).repartition(parts)


EDGES = [(900, None), (901, ""), (902, " \n\t "), (903, "one"), (904, "two words"), (905, "Same Text here today"), (906, "same text HERE today"), (907, None)]


def corpus(seed, n=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["é", "Straße", "日本"]
    para = [" ".join(rng.choice(words) for _ in range(rng.randrange(8, 60))) for _ in range(8)]
    docs = []
    for i in range(n):
        parts = [rng.choice(para) if rng.random() < 0.6 else " ".join(rng.choice(words) for _ in range(rng.randrange(1, 40))) for _ in range(rng.randrange(1, 6))]
        docs.append((i, "\n".join(parts)))
    docs.append((n, " ".join(rng.choice(words) for _ in range(6000))))
    docs += [(n + 1 + i, docs[3][1]) for i in range(4)]
    return docs


def brute_fingerprint(text, width):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    some = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    h = [xxhash.xxh64_intdigest(x, 42) for x in some]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(fps, radius):
    parent = {k: k for k in fps}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    keys = sorted(fps)
    for i in keys:
        for j in keys:
            if i < j and bin(fps[i] ^ fps[j]).count("1") <= radius:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {k: root(k) for k in keys}


def test_fingerprints_match_the_statement(spark):
    from pyspark.sql import functions as F

    docs = [*corpus(1, 10), *EDGES]
    got = {r.doc_id: r.h for r in simhash.near_duplicates(frame(spark, docs)).select("doc_id", simhash.hex_of(F.col("fp")).alias("h")).collect()}
    assert got == {i: f"{brute_fingerprint(t, 4):016x}" for i, t in docs}
    one = spark.createDataFrame([("b c d e",)], "t string").select(F.xxhash64("t").alias("x")).first().x
    assert brute_fingerprint("b C d E", 4) == one % 2**64


def test_components_of_near_duplicates(spark, monkeypatch):
    rng = random.Random(4)
    base = [f"t{rng.randrange(300)}" for _ in range(400)]
    docs = []
    for i in range(50):
        words = list(base) if i % 3 else [f"u{rng.randrange(300)}" for _ in range(300)]
        for _ in range(rng.randrange(0, 6)):
            words[rng.randrange(len(words))] = f"e{rng.randrange(9)}"
        docs.append((i, " ".join(words)))
    docs += EDGES
    for radius in (4, 9):
        want = brute_groups({i: brute_fingerprint(t, 4) for i, t in docs}, radius)
        if radius == 9:
            monkeypatch.setattr(simhash, "LARGE", 1)
            monkeypatch.setattr(simhash, "BLOCK", 7)
        got = {r.doc_id: r.component_id for r in simhash.near_duplicates(frame(spark, docs), radius=radius).collect()}
        assert got == want, radius


def test_blocks_of_a_hot_bucket(spark, monkeypatch):
    monkeypatch.setattr(simhash, "LARGE", 2)
    monkeypatch.setattr(simhash, "BLOCK", 5)
    rng = random.Random(8)
    fps = {0}
    while len(fps) < 60:
        fps.add(sum(1 << b for b in rng.sample(range(20), rng.randrange(0, 7))))
    nodes = spark.createDataFrame([(x,) for x in fps], "fp long")
    got = {r.node: r.label for r in components(simhash.links(nodes, 4)).collect()}
    want = brute_groups({x: x for x in fps}, 4)
    assert {x: got.get(x, x) for x in fps} == want


def test_allocation_is_a_pigeonhole():
    rng = np.random.default_rng(0)
    bits = (rng.random((500, 64)) < np.linspace(0.05, 0.95, 64)).astype(np.int64)
    both = bits.T @ bits
    for radius in (0, 3, 4, 8):
        groups, thresholds = simhash.plan(500, both, radius) if radius else ([list(range(64))], [0])
        assert sorted(b for g in groups for b in g) == list(range(64))
        assert sum(t + 1 for t in thresholds) == radius + 1


def test_empty_and_repeated(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(empty).collect() == []
    assert simhash.keep_one(empty).collect() == []
    assert suffixes.dedup(empty).collect() == []
    assert lines.dedup(empty).collect() == []
    twice = spark.createDataFrame([(1, "a b c d e", "l", "f", "k")] * 2, SCHEMA)
    assert [(r.doc_id, r.component_id) for r in simhash.near_duplicates(twice).collect()] == [(1, 1)] * 2


def test_verified_groups(spark):
    words = [f"w{i}" for i in range(120)]
    near, far = [*words], [*words]
    near[60] = "x"
    for i in range(0, 120, 8):
        far[i] = f"y{i}"
    docs = [(5, " ".join(words)), (6, " ".join(near)), (7, " ".join(far)), (8, " ".join(words)), *EDGES]
    got = {r.doc_id: r.group_id for r in simhash.similar_groups(frame(spark, docs), radius=64 // 4).collect()}
    assert got[6] == got[8] == 5 and got[7] == 7
    assert got[900] == got[901] == got[902] == got[907] == 900 and got[905] == got[906] == 905
    kept = simhash.keep_one(frame(spark, docs), radius=64 // 4)
    assert kept.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ")
    assert {r.doc_id for r in kept.collect()} == {5, 7, 900, 903, 904, 905}


def brute_similar(docs, width=5, least=0.8):
    sets = {i: set(zip(*(t.lower().split()[k:] for k in range(width)), strict=False)) for i, t in docs}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sorted(sets):
        for j in sorted(sets):
            if i < j and len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: root(i) for i in sets}


def similar_corpus(seed, families, copies, changes):
    rng = random.Random(seed)
    docs = []
    for f in range(families):
        base = [f"f{f}w{rng.randrange(500)}" for _ in range(200)]
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randrange(changes + 1)):
                words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
            docs.append((len(docs), " ".join(words)))
    return docs


def test_similar_groups_as_the_pipeline_runs_them(spark):
    docs = similar_corpus(21, 40, 2, 5)
    want = brute_similar(docs)
    assert {r.doc_id: r.group_id for r in simhash.similar_groups(frame(spark, docs)).collect()} == want
    assert {r.doc_id for r in simhash.keep_one(frame(spark, docs)).collect()} == set(want.values())


def test_similar_groups_in_large_buckets(spark, monkeypatch):
    for name, value in (("CROWD", 2), ("CROWD_BLOCK", 12), ("LARGE", 2)):
        monkeypatch.setattr(simhash, name, value)
    docs = similar_corpus(5, 3, 25, 16)
    want = brute_similar(docs)
    assert 3 < len(set(want.values())) < 60
    assert {r.doc_id: r.group_id for r in simhash.similar_groups(frame(spark, docs)).collect()} == want


def test_spanning_keeps_components():
    rng = np.random.default_rng(6)
    for _ in range(30):
        sets = [np.unique(rng.integers(0, 14, rng.integers(0, 14))).astype("<u8").tobytes() for _ in range(40)]
        ids = rng.permutation(40) + 100
        docs = {int(i): x for i, x in zip(ids, sets, strict=True)}
        want = brute_links(docs, [(a, b) for a in docs for b in docs if a < b and simhash.resemblance(docs[a], docs[b]) >= 0.6])
        known = [(a, b) for a in docs for b in docs if a < b < 110 and simhash.resemblance(docs[a], docs[b]) >= 0.6]
        labels = brute_links(docs, known)
        us, vs = simhash.spanning(ids, np.array([labels[int(i)] for i in ids]), sets, 0.6)
        assert all(simhash.resemblance(docs[int(a)], docs[int(b)]) >= 0.6 for a, b in zip(us, vs, strict=True))
        assert brute_links(docs, known + [(int(a), int(b)) for a, b in zip(us, vs, strict=True)]) == want


def brute_links(nodes, pairs):
    label = {i: i for i in nodes}
    for a, b in pairs:
        low, high = sorted((label[a], label[b]))
        label = {i: low if x == high else x for i, x in label.items()}
    return label


@pytest.mark.parametrize("one_task", [0, 250_000])
def test_components_of_a_long_path(spark, one_task):
    rng = random.Random(2)
    names = list(range(300))
    rng.shuffle(names)
    edges = [(names[i], names[i + 1]) for i in range(200)] + [(5, 5)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "u long, v long"), one_task=one_task).collect()}
    assert got == {n: min(names[:201]) for n in names[:201]}


def test_one_task_finds_the_components_of_any_graph():
    rng = np.random.default_rng(3)
    for n, m in ((2, 1), (30, 12), (400, 350), (400, 2_000)):
        u, v = rng.integers(-n, n, (2, m))
        label = {x: x for x in (*u.tolist(), *v.tolist())}
        for _ in label:
            for a, b in zip(u.tolist(), v.tolist(), strict=True):
                label[a] = label[b] = min(label[a], label[b])
        nodes, labels = least_reached(u, v)
        assert dict(zip(nodes.tolist(), labels.tolist(), strict=True)) == label


def brute_removed(docs, size=100):
    first = {}
    for i, t in sorted(docs, key=lambda d: d[0]):
        b = (t or "").encode()
        for p in range(len(b) - size + 1):
            first.setdefault(b[p : p + size], (i, p))
    out = {}
    for i, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - size + 1):
            if first[b[p : p + size]] != (i, p):
                gone[p : p + size] = b"\1" * size
        spans = sum(1 for j, g in enumerate(gone) if g and (j == 0 or not gone[j - 1]))
        out[i] = (len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g))
    return out


def test_suffix_dedup(spark):
    docs = [*corpus(7, 40), *EDGES, (910, "a" * 350), (911, "ab" * 150), (912, "q" + "ab" * 70), (913, ("abcdefghij" * 7 + "k") * 6)]
    want = brute_removed(docs)
    # Ranges so small that the shared passages' anchor strings are cut inside.
    for bucket_bytes in (suffixes.BUCKET, 20_000, 1_500):
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept_bytes)) for r in suffixes.dedup(frame(spark, docs), bucket_bytes=bucket_bytes).collect()}
        assert got == want, bucket_bytes
    text = {r.doc_id: r.text for r in suffixes.dedup(frame(spark, docs), replace=True).collect()}
    assert text == {i: None if t is None else want[i][3].decode(errors="ignore") for i, t in docs}


def test_suffix_rows_that_share_a_key(spark):
    a, b = "x1 " * 60, "other words " * 20
    rows = spark.createDataFrame([(1, a), (1, a), (1, b), (2, b)], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_bytes, r.n_removed) for r in suffixes.dedup(rows).collect())
    inside = {t: brute_removed([(0, t)])[0][1] for t in (a, b)}
    assert got == sorted([(1, 180, inside[a]), (1, 180, inside[a]), (1, 240, inside[b]), (2, 240, 240)])


def test_merge_of_runs():
    rng = random.Random(3)
    for k in (0, 1, 2, 5, 9):
        runs = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(0, 12))) for _ in range(k)]
        coded = [suffixes.front_code(r, suffixes.common_prefixes(r)) for r in runs]
        back = [suffixes.front_decode(*c) for c in coded]
        assert back == runs
        merged = suffixes.merge([(r, suffixes.common_prefixes(r).tolist()) for r in runs])
        strings = [runs[r][i] for r, i, _ in merged]
        assert strings == sorted(s for r in runs for s in r)
        assert [p for _, _, p in merged] == suffixes.common_prefixes(strings).tolist()


def passages(text):
    parts = (text or "").split("\n")
    held = [k for k, x in enumerate(parts) if x.strip()]
    return parts, [(a, b, "\n".join(parts[a : b + 1])) for a, b in zip(held, held[1:], strict=False)]


def brute_passages(docs):
    first, kept, out = {}, {}, {}
    docs = sorted(docs, key=lambda d: d[0])
    times = Counter(body for _, t in docs for _, _, body in passages(t)[1])
    for i, t in docs:
        for a, b, body in passages(t)[1]:
            if times[body] > 1 and first.setdefault(body, (i, a)) == (i, a):
                kept.setdefault(i, set()).update(range(a, b + 1))
    for i, t in docs:
        parts, found = passages(t)
        gone = set()
        for a, b, body in found:
            if times[body] > 1 and not kept.get(i, set()) & set(range(a, b + 1)):
                gone |= set(range(a, b + 1))
        out[i] = (None if t is None else "\n".join(x for k, x in enumerate(parts) if k not in gone), len(gone))
    return out


def lost_and_left(before, after):
    """Repeated passages of two lines of which no copy is left whole, and those that still stand more than once."""
    now = Counter(body for t in after for _, _, body in passages(t)[1])
    repeated = [body for body, n in Counter(body for t in before for _, _, body in passages(t)[1]).items() if n > 1]
    return [x for x in repeated if not now[x]], [x for x in repeated if now[x] > 1], len(repeated)


def test_every_repeated_passage_keeps_a_copy(spark):
    cases = [(1, "A\nB\nE"), (2, "A\nB\nC"), (3, "D\nB\nC"), (4, "x\nx\nx"), (5, "x\nx\nx\nx\nx"), (6, "q\nA\nB\nC\nr"), (7, "B\nC\nA\nB")]
    rng = random.Random(21)
    cases += [(i, "\n".join(rng.choice("abcdefg") for _ in range(rng.randrange(1, 9)))) for i in range(10, 60)]
    got = {r.doc_id: r.text for r in lines.dedup(frame(spark, cases)).collect()}
    assert lost_and_left([t for _, t in cases], got.values())[0] == []
    assert got[1] == "A\nB\nE" and got[2] == "A\nB\nC"


def test_passages_of_the_table_survive(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    before = [r.text for r in docs.collect()]
    lost, left, n = lost_and_left(before, [r.text for r in lines.dedup(docs).collect()])
    assert n > 100 and lost == [] and len(left) <= 0.1 * n


def test_all_repeated_passages_go(spark):
    rng = random.Random(13)
    line = lambda: " ".join(f"w{rng.randrange(900)}" for _ in range(9))
    shared = [[line() for _ in range(n)] for n in (2, 3, 5)]
    docs = [(i, "\n".join([line() for _ in range(4)] + rng.choice(shared) + [line() for _ in range(3)] + [""])) for i in range(30)]
    docs += [(i + 30, t) for i, t in corpus(9, 30)] + EDGES
    got = {r.doc_id: (r.text, r.n_removed_lines) for r in lines.dedup(frame(spark, docs)).collect()}
    assert got == brute_passages(docs)
    for passage in shared:
        assert sum("\n".join(passage) in (t or "") for t, _ in got.values()) == 1


def test_the_query_removes_all_repeated_passages(spark, tmp_path):
    import __spark_entry__ as e

    docs = [(1, "a b\nc d\ne f\n1"), (2, "x\na b\nc d\ne f\ny"), (3, "p\nq\nc d\ne f"), (4, "r\na b\nc d")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    rows = e.queries()["op9_line_dedup"](spark, str(tmp_path)).collect()
    assert {r.doc_id: r.n_removed_lines for r in rows} == {1: 0, 2: 3, 3: 2, 4: 2}


def test_line_windows():
    text = b"a b\n\nc d\n \n\ne f\nc d\n \n\ne f\n"
    parts, found = lines.windows(text)
    assert [b"\n".join(parts[a:b]) for a, b, _ in found] == [b"a b\n\nc d", b"c d\n \n\ne f", b"e f\nc d", b"c d\n \n\ne f"]
    assert found[1][2] == found[3][2] and len({h for _, _, h in found}) == 3
    alone = lines.windows(b"c d\n \n\ne f")[1]
    assert alone[0][2] == found[1][2] and lines.windows(b"c d\n\ne f")[1][0][2] != alone[0][2]
    rng = random.Random(1)
    base = [b"line %d" % rng.randrange(10**9) for _ in range(200)]
    hashes = lambda x: {h for _, _, h in lines.windows(b"\n".join(x))[1]}
    assert len(hashes(base) - hashes(base[:50] + [b"new"] + base[50:])) == 1


def test_line_dedup_of_repeated_keys_and_nulls(spark):
    rows = [(1, "a b\nc d"), (1, "x y\nc d"), (None, "p q\nx y\nc d"), (2, "a b\nc d\nz"), (2, "a b\nc d\nz")]
    got = sorted((r.text, r.n_removed_lines, r.n_removed_chunks) for r in lines.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    whole = ("a b\nc d\nz", 0, 0)  # its last two lines are the first copy in both rows
    assert got == sorted([("a b\nc d", 0, 0), ("", 2, 1), ("p q\nx y\nc d", 0, 0), whole, whole])


def test_hot_keys_are_looked_up_alike(spark, monkeypatch):
    from glossmill.llm import common

    monkeypatch.setattr(common, "HOT_LEAST", 3)
    left = spark.createDataFrame([(i, i % 7 if i % 2 else 0) for i in range(60)] + [(99, None), (98, 50)], "i long, k long")
    right = spark.createDataFrame([(k, 10 * k, 30 if k == 0 else 4 if k == 3 else 1) for k in range(7)], "k long, v long, uses long")
    got = {r.i: r.v for r in common.looked_up(left, right, ["k"], "uses", ["i"]).collect()}
    assert got == {**{i: 10 * (i % 7 if i % 2 else 0) for i in range(60)}, 99: None, 98: None}
    for least in (3, 1000):  # with hot keys, and without
        monkeypatch.setattr(common, "HOT_LEAST", least)
        assert {r.i: r.v for r in common.met(left, right, ["k"], "uses").collect()} == {i: v for i, v in got.items() if v is not None}


def test_keep_one_tells_rows_apart(spark):
    x, y = (" ".join(f"{c}{i}" for i in range(30)) for c in "xy")
    rows = spark.createDataFrame([(1, x), (2, x), (2, y), (None, y + " more"), (3, "z"), (3, "z")], "doc_id long, text string")
    assert sorted(((r.doc_id or 0, r.text) for r in simhash.keep_one(rows).collect())) == sorted([(1, x), (0, y + " more"), (3, "z"), (3, "z")])


def test_texts_stay_in_their_buckets_and_are_scanned_in_small_slices(spark):
    import tracemalloc

    held = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        passage = "".join(random.Random(1).choices("abcdefgh", k=300))
        done = suffixes.dedup(spark.createDataFrame([(i, f"{i} text {i * 7919} " + passage * (i % 2)) for i in range(20)], "doc_id long, text string"))
        plan = done._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.n_removed > 0 for r in done.collect()) == [False] * 11 + [True] * 9
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    # Only the lists of spans are shuffled.
    assert "Bucketed: true" in plan and not [line for line in plan.splitlines() if "Exchange" in line and "text#" in line]
    assert plan.count("SortMergeJoin") == 1 and plan.split("SortMergeJoin")[1].count("Exchange") == 1
    text = np.random.default_rng(3).integers(97, 123, suffixes.SCAN_BYTES, np.uint8).tobytes()
    tracemalloc.start()
    suffixes.runs_of([text[i : i + 2000] for i in range(0, len(text), 2000)])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6
