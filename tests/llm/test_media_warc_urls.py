"""Media, archives and urls."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from glossmill.llm import media, urls, warc


@pytest.mark.parametrize("kind", range(5))
def test_png_filters(kind):
    samples = np.random.default_rng(kind).integers(0, 256, 64 * 9, dtype=np.uint8).tobytes()
    assert media.decode_png(media.encode_png(samples, row_filter=kind)).tobytes() == samples


def test_png_mixed_filters_of_several_images():
    rng = np.random.default_rng(1)
    images, lined = [], []
    for n in (11, 1, 0, 90, 3):
        rows, kinds = rng.integers(0, 256, (n, 64)).astype(np.uint8), rng.integers(0, 5, n)
        images.append(rows)
        lined.append(np.concatenate([kinds[:, None].astype(np.uint8), media.filtered(rows)[kinds, np.arange(n)]], axis=1))
    for got, want in zip(media.unfilter(lined), images, strict=True):
        assert (got == want).all()
    with pytest.raises(ValueError):
        media.unfilter([np.full((1, 65), 5, np.uint8)])


def test_filters_by_the_letter():
    """Each filter sample by sample, and the choice for each row."""
    rows = np.frombuffer("The quick brown fox, the lazy dog and naïve façades. ".encode() * 20, np.uint8)[:960].reshape(-1, 64).astype(int)

    def guess(kind, y, x):
        a, b = rows[y][x - 1] if x else 0, rows[y - 1][x] if y else 0
        c = rows[y - 1][x - 1] if x and y else 0
        near = min((abs(a + b - c - v), i, v) for i, v in enumerate((a, b, c)))
        return (0, a, b, (a + b) // 2, near[2])[kind]

    want = [[[(rows[y][x] - guess(kind, y, x)) % 256 for x in range(64)] for y in range(len(rows))] for kind in range(5)]
    assert media.filtered(rows.astype(np.uint8)).tolist() == want
    raw = np.frombuffer(zlib.decompress(_idat(media.encode_png(rows.astype(np.uint8).tobytes()))), np.uint8).reshape(-1, 65)
    cost = [[sum(min(v, 256 - v) for v in row) for row in kind] for kind in want]
    assert raw[:, 0].tolist() == [min(range(5), key=lambda k: (cost[k][y], k)) for y in range(len(rows))]
    assert raw[:, 1:].tolist() == [want[k][y] for y, k in enumerate(raw[:, 0])]


def test_cosine_hash_by_the_letter():
    from math import cos, pi

    rows = np.random.default_rng(2).integers(0, 256, (77, 64)).astype(np.uint8)
    grid = [[float(np.mean([[int(rows[y][x]) for x in range(64 * j // 32, 64 * (j + 1) // 32)] for y in range(77 * i // 32, 77 * (i + 1) // 32)])) for j in range(32)] for i in range(32)]
    low = [round(sum(grid[y][x] * cos((2 * y + 1) * u * pi / 64) * cos((2 * x + 1) * v * pi / 64) for y in range(32) for x in range(32)), 6) for u in range(8) for v in range(8)]
    middle = sorted(low)[31:33]
    bits = "".join(str(int(v > sum(middle) / 2)) for v in low)
    assert media.cosine_hash(rows) == int(bits, 2).to_bytes(8, "big")


def _idat(data):
    at = data.index(b"IDAT")
    n = int.from_bytes(data[at - 4 : at], "big")
    return data[at + 4 : at + 4 + n]


@pytest.mark.parametrize("at", [1, 20, 45, -6])
def test_png_damage(at):
    data = bytearray(media.encode_png(b"x" * 128))
    data[at] ^= 1
    with pytest.raises(ValueError):
        media.decode_png(bytes(data))


def test_media_columns(spark):
    texts = [None, "", "a", "é" * 100, "x" * 64, "long " * 9000, "a"]
    df = spark.createDataFrame([(i, t, "m") for i, t in enumerate(texts)], "doc_id long, text string, media string")
    rows = {r.doc_id: r for r in media.media_columns(df).collect()}
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        whole = raw + b"\0" * (-len(raw) % 64 if raw else 64)
        r = rows[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(whole), hashlib.sha256(whole).hexdigest(), zlib.crc32(whole[-64:]))
        stored = media.encode_png(whole)
        assert (r.media_bytes, r.media_sha256) == (len(stored), hashlib.sha256(stored).hexdigest())
        assert r.feature == media.cosine_hash(np.frombuffer(whole, np.uint8).reshape(-1, 64)).hex() == bytes(r.cosine_bits).hex()
    assert rows[2][1:] == rows[6][1:] and rows[0][1:] == rows[1][1:]
    assert media.media_columns(df.limit(0)).collect() == []


def test_near_images_hash_near():
    text = "The quick brown fox jumps over the lazy dog. " * 200
    bits = lambda t: int.from_bytes(media.cosine_hash(media.decode_png(media.encode_png(media.padded(t.encode())))), "big")
    assert (bits(text) ^ bits(text.replace("lazy", "lucy", 1))).bit_count() <= 6


def test_archive(spark):
    body = "x" * 1200
    data = [(1, "http://a/\r\nX: y", body, "r"), (2, None, body, "r"), (3, "u", "small", "r"), (4, "u", "small", "r"), (5, "u", None, "r"), (6, "u", "é" * 500, "r"), (7, "u", "é" * 500, "r")]
    pages = spark.createDataFrame(data, "page_id long, url string, html string, records string")
    archive = warc.write_archive(pages)
    rows = {r.page_id: r for r in warc.read_archive(archive).collect()}
    assert {k: (r.record_type, r.refers_to) for k, r in rows.items()} == {1: ("revisit", 2), 2: ("response", None), 3: ("response", None), 4: ("response", None), 5: ("response", None), 6: ("revisit", 7), 7: ("response", None)}
    for i, _, h, _ in data:
        raw = (h or "").encode()
        assert (rows[i].payload_bytes, rows[i].payload_digest) == (len(raw), hashlib.sha1(raw).hexdigest())
    assert archive.payloads.count() == 4
    stream = b"".join(bytes(r.record) for r in warc.rebuild(archive).collect())
    parsed = warc.parse_stream(stream)
    assert len(parsed) == 7 and all("\n" not in f["WARC-Target-URI"] for f, _ in parsed)
    with pytest.raises(ValueError):
        warc.parse_record(stream[: stream.index(b"\r\n\r\n") + 4])
    assert warc.read_archive(warc.write_archive(pages.limit(0))).collect() == []


def test_archive_of_null_ids_and_hot_payloads(spark, monkeypatch):
    from glossmill.llm import common

    monkeypatch.setattr(common, "HOT_LEAST", 3)
    long, other = "y" * 1500, "z" * 1500
    data = [(i, "u", "" if i % 2 else long) for i in range(20)] + [(None, "u", long), (None, "u", other), (None, None, ""), (30, "u", "x" * 2_000_000)]
    rows = warc.read_archive(warc.write_archive(spark.createDataFrame(data, "page_id long, url string, html string"))).collect()
    got = sorted((r.page_id if r.page_id is not None else -1, r.payload_bytes, r.record_type, r.refers_to) for r in rows)
    want = [(i, 0 if i % 2 else 1500, "response" if i % 2 or i == 18 else "revisit", None if i % 2 or i == 18 else 18) for i in range(20)]
    want += [(-1, 1500, "revisit", 18), (-1, 1500, "response", None), (-1, 0, "response", None), (30, 2_000_000, "response", None)]
    assert got == sorted(want, key=lambda x: (x[0], x[1], x[2])) or sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize(
    ("url", "host", "path", "rule", "verdict"),
    [
        ("https://WWW.Example.org/es/1?x", "www.example.org", "/es/1", "example.org/es/", "block"),
        ("http://example.org/en/17", "example.org", "/en/17", "example.org/en/1", "block"),
        ("http://notexample.org/es/1", "notexample.org", "/es/1", "org/", "allow"),
        ("http://a.com/fr/#x", "a.com", "/fr/", "com/fr/", "allow"),
        ("http://a.com/de/x", "a.com", "/de/x", "com/de/", "block"),
        ("http://example.org", "example.org", "", None, None),
        ("x://h?q=http://a.org/", "h", "", None, None),
        ("no scheme", "", "", None, None),
        (None, "", "", None, None),
    ],
)
def test_rules(spark, url, host, path, rule, verdict):
    df = spark.createDataFrame([(url,)], "url string")
    h, p = urls.host_and_path(F.col("url"))
    r = df.select(h.alias("h"), p.alias("p")).select("h", "p", urls.rule_for(F.col("h"), F.col("p")).alias("r")).first()
    assert (r.h, r.p) == (host, path)
    assert (r.r.rule if r.r else None, r.r.verdict if r.r else None) == (rule, verdict)


def brute_split(name, uses, total):
    from math import log

    def cost(w):
        return log(uses[w]) - log(total) if w in uses else log(10) - log(total) - len(w) * log(10)

    best = None
    for mask in range(1 << (len(name) - 1)):
        cuts = [0, *(i + 1 for i in range(len(name) - 1) if mask >> i & 1), len(name)]
        words = [name[a:b] for a, b in zip(cuts, cuts[1:])]
        score = sum(map(cost, words))
        if best is None or score > best[0] + 1e-9:
            best = (score, words)
    return best


@pytest.mark.parametrize("name", ["cheappills", "spamfarm", "newsonline", "abcxyz", "pills"])
def test_segmentation(name):
    from math import log

    uses = {"cheap": 50, "pills": 20, "spam": 9, "farm": 30, "news": 80, "on": 200, "line": 40, "online": 60, "a": 100, "heap": 5}
    got = urls.split_name(name, uses, 1000)
    cost = sum(log(uses[w]) - log(1000) if w in uses else log(10) - log(1000) - len(w) * log(10) for w in got)
    assert "".join(got) == name
    assert abs(cost - brute_split(name, uses, 1000)[0]) < 1e-9


def test_long_words_in_long_names(spark):
    long = "q" + "ab" * 60
    counts = spark.createDataFrame([(long, 5), ("x", 3), ("cat", 9), ("q" + "ab" * 50, 2)], "word string, uses long")
    hosts = spark.createDataFrame([(f"cat{long}x.x7.net",), ("a" * 3000,), ("x.cat",)], "host string")
    got = {r.host: r.words for r in urls.segmented(hosts, counts).collect()}
    assert got[f"cat{long}x.x7.net"][:5] == ["cat", long, "x", "x", "7"] and got["x.cat"] == ["x", "cat"] and "".join(got["a" * 3000]) == "a" * 3000


def test_judge_against_counting_by_hand(spark):
    from math import log

    data = [(i, f"http://news{i % 3}.org/en/{i % 5}", "<p>cheap pills news online site</p>") for i in range(30)]
    data += [(100 + i, f"http://cheappills.com/de/casino/{i % 4}", "<p>news</p>") for i in range(20)] + [(150 + i, f"http://newssite.com/fr/a{i}", None) for i in range(6)]
    data += [(200, "http://cheappills.net/x", None), (201, "http://newsonline.net/en/3", ""), (202, None, None), (202, None, None), (203, "http://" + "a" * 300 + ".net/", "x"), (None, "http://com/", "x")]
    pages = spark.createDataFrame([(*d, "v", "u") for d in data], "page_id long, url string, html string, words string, uid string")
    rows = urls.judge(pages).collect()
    assert len(rows) == len(data)
    ruled = [r for r in rows if r.rule]
    assert all(t not in r.tokens for r in ruled for t in ("h:org", "h:com", "p:de", "p:fr")) and any("p:en" in r.tokens for r in ruled)
    uses = {v: [t for r in ruled if r.verdict == v for t in r.tokens] for v in ("block", "allow")}
    vocabulary = len(set(uses["block"]) | set(uses["allow"]))
    n = {v: sum(r.verdict == v for r in ruled) for v in uses}
    for r in rows:
        want = log((n["block"] + 1) / (n["allow"] + 1))
        for t in [t for t in r.tokens if t in uses["block"] or t in uses["allow"]]:
            want += log((uses["block"].count(t) + 1) / (len(uses["block"]) + vocabulary)) - log((uses["allow"].count(t) + 1) / (len(uses["allow"]) + vocabulary))
        assert abs(r.score - want) < 1e-8
        assert r.rule or r.verdict == ("block" if want > 0 else "allow")
    by_id = {r.page_id: r for r in rows}
    assert by_id[200].verdict == "block" and by_id[201].verdict == "allow" and by_id[202].host == "" and "h:cheap" in by_id[200].tokens
    assert urls.judge(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_verdicts_follow_bayes_and_unseen_tokens_do_not_vote(spark):
    from fractions import Fraction

    data = [(i, f"http://a{i % 3}.org/en/garden/{i % 4}", "garden") for i in range(24)] + [(50 + i, f"http://b{i % 2}.com/de/bets/{i % 3}", "bets") for i in range(8)]
    data += [(100, "http://zq0xv.net/", None), (101, "http://zq0xv.net/ooo/ppp/qqq/rrr/sss/ttt/uuu/vvv", None), (102, "http://zq0xv.net/bets/bets/ooo", None), (103, "http://zq0xv.net/garden/bets", None)]
    rows = {r.page_id: r for r in urls.judge(spark.createDataFrame(data, "page_id long, url string, html string")).collect()}
    assert rows[100].verdict == rows[101].verdict == "allow" and rows[100].score == rows[101].score and rows[102].verdict == "block"
    sides = {v: [r.tokens for r in rows.values() if r.rule and r.verdict == v] for v in ("block", "allow")}
    seen = {t for side in sides.values() for own in side for t in own}
    for r in rows.values():
        chance = {}
        for v, side in sides.items():
            bag = [t for own in side for t in own]
            chance[v] = Fraction(len(side) + 1)
            for t in r.tokens:
                if t in seen:
                    chance[v] *= Fraction(bag.count(t) + 1, len(bag) + len(seen))
        if not r.rule:
            assert r.verdict == ("block" if chance["block"] > chance["allow"] else "allow")


def test_media_are_decoded_in_slices_of_their_payload(spark, monkeypatch):
    import pyarrow as pa

    from glossmill.llm import common

    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3, 4]), pa.array([900, 900, 5000, None]), pa.array([b"a", b"b", b"c", b"d"])], ["k", "n_bytes", "media"])
    assert [x.num_rows for x in common.sliced(iter([batch]), "n_bytes", 1000)] == [1, 1, 1, 1]
    assert [x.num_rows for x in common.sliced(iter([batch]), "media", 1000)] == [4]


def test_rebuilding_records_shuffles_payloads_once(spark):
    rows = [(i, f"http://a/{i}", f"page {i} " + "x" * 1200) for i in range(20)]
    archive = warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"))
    # Counting and joining read the payloads' table alone; a join of it with the records' counts came before.
    assert archive.payloads.agg(F.sum("uses"), F.min("size")).first()[:] == (20, 1207)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = warc.rebuild(archive)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Join") == 1


def test_payloads_stay_in_their_buckets_when_records_are_rebuilt(spark):
    rows = [(i, f"http://x.org/{i}", f"{i % 20} " * 700) for i in range(50)]
    archive = warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"))
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rebuilt = warc.rebuild(archive)
        plan = rebuilt._jdf.queryExecution().executedPlan().toString()
        assert rebuilt.count() == 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert not [line for line in plan.splitlines() if "Exchange" in line and "payload" in line]
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
