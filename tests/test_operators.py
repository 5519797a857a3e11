"""Operators on small frames."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from glossmill.operators import areas, coverage, lexicon, morphology, ngrams, statutory, store, tokens

SENTENCES = [["darbo", "santykiai", "pajamos"], ["darbo", "santykiai", "turtas"], ["darbo", "santykiai", "esmė"], ["kitas", "žodis"]]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_counts_never_cross_sentences(spark):
    mined = spark.createDataFrame([(i, s) for i, s in enumerate(SENTENCES)], "sent_idx int, words array<string>")
    counts = {r.phrase: r.frequency for r in ngrams.ngram_counts(mined).collect()}
    assert counts["darbo santykiai"] == 3
    assert "pajamos darbo" not in counts
    unigrams = ngrams.unigram_counts(mined)
    assert ngrams.total_of(unigrams).first().total == 11
    scored = ngrams.scored_bigrams(ngrams.ngram_counts(mined, range(2, 3)).where("phrase = 'darbo santykiai'"), unigrams, ngrams.total_of(unigrams)).first()
    assert abs(scored.pmi - 1.8745) < 1e-3
    assert abs(scored.g2 - 12.89) < 0.1


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(["a", "b", "c"]), max_size=7), min_size=1, max_size=5))
def test_number_of_windows(spark, sentences):
    mined = spark.createDataFrame([(s,) for s in sentences], "words array<string>")
    expected = Counter((n, " ".join(s[i : i + n])) for s in sentences for n in (2, 3, 4) for i in range(len(s) - n + 1))
    assert {(r.ngram_size, r.phrase): r.frequency for r in ngrams.ngram_counts(mined).collect()} == dict(expected)


def test_document_counts_two_ways(spark):
    docs = spark.createDataFrame([(0, "alpha delta. " * 5), *[(i, "beta gamma") for i in range(1, 6)]], "doc_id int, text string")
    words = F.transform(tokens.sentences_of(F.col("text")), tokens.words_of)
    one = {r.phrase: (r.frequency, r.doc_count) for r in ngrams.document_ngrams(docs, "text", 2, words).collect()}
    two = {r.phrase: (r.frequency, r.doc_count) for r in ngrams.ngram_counts_with_documents(tokens.mined_sentences(docs, stop_words=[]), "doc_id", 2).collect()}
    assert one == two == {"alpha delta": (5, 1), "beta gamma": (5, 5)}


def test_stop_words_go_before_windows(spark):
    docs = spark.createDataFrame([(0, "release of the goods")], "doc_id int, text string")
    assert [r.phrase for r in ngrams.ngram_counts(tokens.mined_sentences(docs), range(2, 3)).collect()] == ["release goods"]


def test_what_containment_spells_is_never_broadcast(spark):
    df = spark.createDataFrame([(f"word{i} of{i}", 10, 1.0) for i in range(50)], "phrase string, frequency long, pmi double")
    terms = spark.createDataFrame([(f"term{i} of{i}",) for i in range(50)], "term string")
    words = spark.createDataFrame([("word1", 5)], "word string, freq long")
    spelt = [ngrams.subsumed(df), ngrams.known_overlap(df, terms), ngrams.scored_bigrams(df.drop("pmi"), words, ngrams.total_of(words)).drop("n")]
    assert [x._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin") for x in spelt] == [0, 0, 0]


def test_containment_equals_a_plain_search_of_strings(spark):
    made = ["a b", "aa b", "a ba", "ca b d", "c", "cab", " b", "b ", "a  b", "aa  bd", "", "a", "x aa b y", "ab ab", "bab aba", "é b", "né ba", "ca bx d", "b"]
    rows = [(p, 1 + i % 4, float(i % 3)) for i, p in enumerate(made)]
    wanted = {x for x, f, s in rows if x and any(y != x and x in y and g >= 0.5 * f and t >= s - 1.0 for y, g, t in rows)}
    found = ngrams.subsumed(spark.createDataFrame(rows, "phrase string, frequency long, pmi double"), slack=1.0)
    assert {r.phrase for r in found.collect()} == wanted


def test_cascade_counts_are_those_of_its_rows_and_join_no_run_again(spark):
    runs = spark.createDataFrame([(1, 0, ["taxes", "dutys", "free", "cats", "cat", "walked"], ["taxe", "duty", "free", "cat", "cat", "walked"]), (2, 0, ["none"], ["none"])], "d long, r int, words array<string>, lemmas array<string>")
    table = lambda rows, schema: spark.createDataFrame(rows, schema)
    phrases, lex, fall = table([("tax duty",), ("cat walked",)], "phrase string"), table([("cat", 1), ("walk", 2)], "word string, tier int"), table([("free", 1)], "word string, tier int")
    args = (runs, phrases, lex, table([("walked", "walk")], "inflected string, lemma string"), fall, ["d", "r"])
    counted = coverage.cascade_counts(*args, ["d"])
    rows = coverage.cascade(*args).groupBy("d", "category", "step").count()
    assert sorted(map(tuple, counted.collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)
    # Neither the runs nor their words cross a shuffle by the run's key.
    assert "SortMergeJoin" not in counted._jdf.queryExecution().executedPlan().toString()


def test_shares_of_a_file_are_not_rounded_twice(spark):
    # 57 of 800 is 0.07125, which lies just below the middle as a double: 712, but 713 if rounded to four places before.
    files = spark.createDataFrame([("f", "s", " ".join(["known"] * 57 + ["other"] * 743))], "filename string, stratum string, text string")
    phrases, lex = spark.createDataFrame([("no match",)], "phrase string"), spark.createDataFrame([("known", 1)], "word string, tier int")
    share = coverage.file_values(files, phrases, lex).select(F.floor(F.col("common_ratio") * 10000 + 0.5).alias("q")).first()
    assert (share.q, coverage.file_rows(files, phrases, lex).first().common_ratio) == (712, 0.0713)


def test_subsumption(spark):
    def survivors(frequency, pmi):
        df = spark.createDataFrame([("pajamų mokestis", 10, 3.0), ("gyventojų pajamų mokestis", frequency, pmi)], "phrase string, frequency int, pmi double")
        return {r.phrase for r in ngrams.without_subsumed(df).collect()}

    assert survivors(8, 4.0) == {"gyventojų pajamų mokestis"}
    assert len(survivors(4, 4.0)) == 2
    assert len(survivors(8, 0.5)) == 2
    chars = spark.createDataFrame([("tax rate", 4, 3.0), ("tax rates", 4, 3.0)], "phrase string, frequency int, pmi double")
    assert {r.phrase for r in ngrams.without_subsumed(chars).collect()} == {"tax rates"}


def test_lexicon_filter_and_overlap(spark):
    c = spark.createDataFrame([("customs duty", 3), ("big house", 4)], "phrase string, frequency int")
    common = spark.createDataFrame([("big",), ("house",), ("duty",)], "word string")
    r = ngrams.lexicon_filter(c, common).collect()
    assert [(x.phrase, x.novel_components, x.common_components) for x in r] == [("customs duty", ["customs"], ["duty"])]
    terms = spark.createDataFrame([("duty",), ("customs duty free",)], "term string")
    assert rows(ngrams.known_overlap(c, terms)) == [("customs duty", "customs duty free")]


def test_greedy_matches(spark):
    runs = spark.createDataFrame([(0, ["a", "b", "c", "a", "b", "x"]), (1, ["b", "c"])], "id int, words array<string>")
    phrases = spark.createDataFrame([("a b",), ("a b c",), ("b c",), ("x",)], "phrase string")
    got = rows(coverage.phrase_matches(runs, phrases, ["id"]).drop("step"))
    assert got == [(0, 0, 3, "a b c"), (0, 3, 2, "a b"), (0, 5, 1, "x"), (1, 0, 2, "b c")]


def test_coverage_counts_agree_with_units(spark):
    docs = spark.createDataFrame([(0, "The customs duty applies. The big customs, duty!"), (1, "Nothing here")], "doc_id int, text string")
    phrases = spark.createDataFrame([("customs duty",)], "phrase string")
    lex = spark.createDataFrame([("the", 1), ("big", 2), ("applies", 3)], "word string, tier int")
    runs = tokens.token_runs(docs)
    keys = ["doc_id", "sent_idx", "run_idx"]
    units = coverage.classify(runs, phrases, lex, keys)
    counts = coverage.coverage_counts(runs, phrases, lex, keys, ["doc_id"])
    named = {"TIER1": "t1", "TIER2": "t2", "TIER3": "t3", "TIER4": "t4", "UNKNOWN": "unknown"}
    by_unit = Counter((r.doc_id, named[r.category]) for r in units.collect())
    for r in counts.collect():
        assert {n: r[n] for n in named.values()} == {n: by_unit[r.doc_id, n] for n in named.values()}
    assert by_unit[0, "t4"] == 1  # the comma keeps the second pair apart
    assert by_unit[0, "unknown"] == 2


def test_expertise(spark):
    runs = spark.createDataFrame([(0, 0, 0, ["a", "b", "b", "c", "t"]), (0, 1, 0, ["t", "u"]), (0, 2, 0, [])], "doc_id int, sent_idx int, run_idx int, words array<string>")
    phrases, lex = spark.createDataFrame([("a",), ("b",), ("c",)], "phrase string"), spark.createDataFrame([("t", 3)], "word string, tier int")
    r = coverage.expertise(runs, phrases, lex, ["doc_id", "sent_idx", "run_idx"], ["doc_id"]).first()
    assert (r.pairs, r.any_sentences, r.multi_sentences, r.distinct_t4, r.t3_units, r.anchored_t3, r.n_sentences, r.total) == (3, 1, 1, 3, 2, 1, 2, 7)
    assert rows(coverage.unknown_counts(runs, phrases, lex, ["doc_id", "sent_idx", "run_idx"])) == [("u", 1)]


def cascade_of(spark, words, lemmas, phrases, tiers, forms=(), fallback=()):
    runs = spark.createDataFrame([(0, words, lemmas)], "id int, words array<string>, lemmas array<string>")
    table = lambda data, schema: spark.createDataFrame(list(data), schema)
    found = coverage.cascade(runs, table([(p,) for p in phrases], "phrase string"), table(tiers, "word string, tier int"), table(forms, "inflected string, lemma string"), table(fallback, "word string, tier int"), ["id"])
    return [tuple(r)[1:] for r in found.orderBy("pos").collect()]


def test_cascade_steps(spark):
    got = cascade_of(spark, ["individualia", "veikla", "yra", "gera"], ["individualias", "veikla", "būti", "geras"], ["individuali veikla"], [("geras", 2)])
    assert got == [(0, 2, "individuali veikla", "TIER4", "opening"), (2, 1, "yra", "UNKNOWN", None), (3, 1, "gera", "TIER2", "word")]
    # Exact goes before openings at one place, the longest first; lemmas count as well as words.
    got = cascade_of(spark, ["customs", "duties", "apply"], ["customs", "duty", "apply"], ["customs duty", "customs", "custom duties apply"], [])
    assert got == [(0, 2, "customs duty", "TIER4", "lemma"), (2, 1, "apply", "UNKNOWN", None)]
    # An earlier opening takes words from a later exact phrase.
    got = cascade_of(spark, ["goods", "entry", "point"], ["goods", "entry", "point"], ["good entry", "entry point"], [("point", 1)])
    assert got == [(0, 2, "good entry", "TIER4", "opening"), (2, 1, "point", "TIER1", "word")]
    # A word that equals the first word is no opening of itself; a phrase must fit in whole.
    assert cascade_of(spark, ["good", "entry"], ["good", "entry"], ["good exit", "good entry now"], []) == [(0, 1, "good", "UNKNOWN", None), (1, 1, "entry", "UNKNOWN", None)]
    # Tiers: word or lemma, then inflection for tiers 1 and 2, then tier 3, then the fallback.
    words = ["is", "ran", "walked", "odd", "chat", "rare"]
    got = cascade_of(spark, words, ["is", "run", "walked", "odd", "chat", "rare"], [], [("be", 1), ("run", 2), ("walked", 3), ("walk", 3), ("odd", 3)], [("is", "be"), ("walked", "walk"), ("odd", "be")], [("chat", 2), ("rare", 3)])
    assert [(c, s) for _, _, _, c, s in got] == [("TIER1", "inflection"), ("TIER2", "word"), ("TIER3", "word"), ("TIER1", "inflection"), ("TIER2", "fallback"), ("UNKNOWN", None)]


def test_cascade_against_a_plain_loop(spark):
    import random

    rng = random.Random(4)
    vocabulary = ["a", "ab", "abc", "b", "ba", "bac", "c", "ca"]
    for trial in range(6):
        words = [rng.choice(vocabulary) for _ in range(40)]
        lemmas = [w[:-1] if len(w) > 2 and rng.random() < 0.5 else w for w in words]
        phrases = sorted({" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 4))) for _ in range(14)})
        want, i = [], 0
        while i < len(words):
            best = None
            for n in (3, 2, 1):
                for step, side in (("text", words), ("lemma", lemmas)):
                    if best is None and i + n <= len(words) and " ".join(side[i : i + n]) in phrases:
                        best = (n, " ".join(side[i : i + n]), step)
            for n in (3, 2):
                fits = [p for p in phrases if best is None and len(p.split()) == n and i + n <= len(words) and any(s[i].startswith(p.split()[0]) and s[i] != p.split()[0] for s in (words, lemmas)) and all(x in (words[i + j], lemmas[i + j]) for j, x in enumerate(p.split()) if j)]
                if fits:
                    best = (n, min(fits, key=lambda p: (-len(p.split()[0]), p)), "opening")
            if best:
                want.append((i, best[0], best[1], "TIER4", best[2]))
            else:
                want.append((i, 1, words[i], "UNKNOWN", None))
            i += best[0] if best else 1
        assert cascade_of(spark, words, lemmas, phrases, []) == want, trial


def test_very_long_runs_are_matched(spark):
    words = ["x", "y"] * 20_000
    runs = spark.createDataFrame([(0, words)], "id int, words array<string>")
    assert coverage.phrase_matches(runs, spark.createDataFrame([("x y",)], "phrase string"), ["id"]).count() == 20_000


def test_merge_and_route(spark):
    data = [("alpha beta", "origin", "o", 40, 200, "NOUN NOUN", "ctx", 0), ("alpha beta", "law", "l", 20, 100, "NOUN NOUN", "longer context", 1), ("alpha beta", "cross_cutting", "x", 80, 410, "ADJ NOUN", "c", 2)]
    r = areas.merge_candidates(spark.createDataFrame(data, "phrase string, area string, source_file string, doc_count long, frequency long, pos_pattern string, context string, ord int")).first()
    assert (r.area_signature, r.total_doc_count, r.total_frequency, r.pos_pattern, r.sample_context) == ("8000F00", 140, 710, "NOUN NOUN", "longer context")
    assert abs(r.area_specificity - 2 / 3) < 1e-9
    assert [a.area for a in r.attestation] == ["cross_cutting", "origin", "law"]
    many = spark.createDataFrame([(f"t{i:02d}", "origin", "o", 1 + i, 3) for i in range(35)], "phrase string, area string, source_file string, doc_count long, frequency long")
    merged = areas.merge_candidates(many).withColumn("ne_risk", F.lit(0.0))
    buckets = Counter(x.bucket for x in areas.route(merged).collect())
    assert buckets == {3: 30, 4: 5}


def test_store(spark):
    old = spark.createDataFrame([("a", "1"), ("b", None)], "k string, s string")
    new = spark.createDataFrame([("a", "1"), ("c", "1"), ("c", "1"), ("b", None)], "k string, s string")
    assert Counter(tuple(r) for r in store.insert_or_ignore(old, new, ["k", "s"]).collect()) == {("c", "1"): 1, ("b", None): 1}
    assert Counter(r.k for r in store.append_except_keys(old.where("s is not null"), new.where("s is not null"), ["k"]).collect()) == {"c": 2}
    log = spark.createDataFrame([("r", "approve", 1), ("r", "reject", 2), ("r", "undo", 3), ("q", "undo", 1), ("q", "approve", 2)], "record_key string, action string, ts int")
    assert rows(store.decided(log)) == [("q", "approve"), ("r", "approve")]


def test_conflicts(spark):
    e = spark.createDataFrame([("p", 1, "Duty"), ("p", 2, " duty "), ("p", 3, "tax"), ("q", 4, "")], "phrase string, id int, definition string")
    got = store.divergences(e, ["phrase"], "id", "definition").collect()
    assert [(r.id_a, r.id_b, r.divergence_detail) for r in got] == [(1, 3, "A: Duty | B: tax")]
    b = spark.createDataFrame([("p", 9, ""), ("q", 8, None)], "phrase string, id int, definition string")
    assert rows(store.cross_domain(e, b, ["phrase"], "id", "definition").select("phrase", "incomplete")) == [("p", True)]
    edges = store.synonym_edges(spark.createDataFrame([(1, 2), (2, 1), (3, 3)], "a int, b int"))
    assert rows(edges) == [(1, 2)]


def test_upsert(spark):
    stored = spark.createDataFrame([(1, "en", "goods", "things"), (1, "lt", "prekės", "daiktai"), (2, "en", "carrier", "a person")], "id int, lang string, phrase string, definition string")
    batch = spark.createDataFrame([("g1", "en", "goods", "Things "), ("g1", "lt", "prekės", "kita"), ("g1", "fr", "biens", "choses"), ("g2", "en", "carrier", "other")], "group string, lang string, phrase string, definition string")
    assert {(r.group, r.lang): r.action for r in store.upsert_definitions(stored, batch).collect()} == {("g1", "en"): "merge", ("g1", "lt"): "conflict", ("g1", "fr"): "add_lang", ("g2", "en"): "new"}


ROOTS = {"patr": ("core", 5), "san": ("core", 9), "vapor": ("extended", 2), "ŝip": ("core", 4), "foo": ("tail", 2), "sin": ("core", 3), "odd": ("tail", 1), "klimat": ("tail", 1)}


def test_decomposition():
    d = morphology.Decomposer(ROOTS, ("kun",))
    got = d.decompose("malsanulej")
    assert (got["kind"], got["prefixes"], got["roots"], got["suffixes"], got["morphemes"], got["head_tier"]) == ("derived", ["mal"], ["san"], ["ul", "ej"], 4, "core")
    assert d.decompose("vaporŝip")["roots"] == ["vapor", "ŝip"]
    assert d.decompose("vaporoŝip")["connectors"] == ["o"]
    assert d.decompose("foosin")["roots"] == ["foo", "sin"]
    assert d.decompose("kun")["kind"] == d.decompose("kunn")["kind"] == "function_word"
    assert d.decompose("klimat")["kind"] == "simple" and d.decompose("klimat")["head_tier"] == "tail"
    assert d.decompose("odd")["roots"] == ["odd"] and d.decompose("")["kind"] == "unresolved"
    assert d.decompose("zzz")["category"] == "unknown" and d.decompose("x")["category"] == d.decompose("ism")["category"] == "artifact"
    assert d.decompose("dudekx")["category"] == "compound_number"


def test_solid_roots_are_never_split():
    d = morphology.Decomposer({"abcd": ("extended", 2), "ab": ("core", 9), "cd": ("core", 9), "xabcd": ("tail", 1)})
    assert d.decompose("abcd")["roots"] == ["abcd"]
    assert d.decompose("malabcd")["roots"] == ["abcd"]


def test_chains_of_any_length():
    got = morphology.Decomposer({"patr": ("core", 5)}).decompose("malmalmalmalpatr" + "inetegidar" * 40)
    assert got["roots"] == ["patr"] and got["prefixes"] == ["mal"] * 4 and len(got["suffixes"]) >= 160


def test_productivity_to_the_last_affix(spark):
    stems = spark.createDataFrame([("sanul",), ("san",), ("malsan",), ("tri",), (None,)], "stem string")
    roots = {r.root: (r.productivity, r.tier) for r in morphology.productivity(stems).collect()}
    assert roots["san"] == (3, "core") and roots["dek"] == (1, "tail") and len(roots) == 1 + len(morphology.NUMBER_ROOTS)
    chain = ["dom"]
    for suffix in ("et", "eg", "ul", "in", "ar", "ej", "ist", "id", "an", "il", "um", "aĉ"):
        chain.append(chain[-1] + suffix)
    got = {r.stem: r.root for r in morphology.primitives(spark.createDataFrame([(x,) for x in chain], "stem string")).collect()}
    assert got == {x: "dom" for x in chain}


def test_inventory(spark):
    import json

    import pytest

    counts = morphology.productivity(spark.createDataFrame([("san",), ("sanul",)], "stem string"))
    document = {"roots": {r.root: {"gloss": "", "prod": r.productivity, "tier": r.tier} for r in counts.collect()}, "suffixes": [], "prefixes": [], "correlatives": [], "other": [], "number_roots": []}
    roots, words = morphology.load_inventory(json.dumps(document))
    assert roots["san"] == ("extended", 2) and words == ()
    with pytest.raises(ValueError):
        morphology.load_inventory("{}")
    with pytest.raises(ValueError):
        morphology.load_inventory(json.dumps({**document, "roots": {"a": ["gloss"]}}))
    done = morphology.decompose(spark.createDataFrame([("sanul",), ("qq",)], "stem string"), morphology.root_table(spark, roots))
    assert {(r.kind, r.category): r.n for r in morphology.decomposition_summary(done).collect()} == {("derived", None): 1, ("unresolved", "artifact"): 1}


def test_inventory_as_a_folder(spark, tmp_path):
    import pytest

    counts = morphology.productivity(spark.createDataFrame([("san",), ("sanul",), ("ŝip",)], "stem string"))
    morphology.write_inventory(counts, str(tmp_path / "held"))
    roots, words = morphology.read_inventory(spark, str(tmp_path / "held"))
    assert {r.root: (r.tier, r.productivity) for r in roots.collect()} == {r.root: (r.tier, r.productivity) for r in counts.collect()} and words == ()
    listed = [r.value for r in spark.read.text(str(tmp_path / "held" / "list")).collect()]
    assert sorted(listed) == sorted(r.root for r in counts.collect())
    (tmp_path / "bad" / "affixes").mkdir(parents=True)
    (tmp_path / "bad" / "affixes" / "a.txt").write_text("{}")
    with pytest.raises(ValueError):
        morphology.read_inventory(spark, str(tmp_path / "bad"))


def test_roots_by_key_give_what_the_whole_inventory_gives(spark):
    import random

    rng = random.Random(8)
    syllables = ["san", "ul", "mal", "patr", "o", "a", "ŝip", "vap", "or", "ej", "re", "x", "dek", "du"]
    word = lambda n: "".join(rng.choice(syllables) for _ in range(n))
    stems = sorted({word(rng.randrange(1, 5)) for _ in range(300)} | {"a" * 80 + "san", "", " San "})
    inventory = {w: (rng.choice(["core", "extended", "tail", "tail"]), rng.randrange(1, 4)) for w in {word(rng.randrange(1, 3)) for _ in range(60)}} | {"a" * 40: ("tail", 1)}
    whole = morphology.Decomposer(inventory, ("dudu",))
    got = {r.stem: r.asDict() for r in morphology.decompose(spark.createDataFrame([(x,) for x in stems], "stem string"), morphology.root_table(spark, inventory), ("dudu",)).collect()}
    assert len(got) == len(stems)
    for stem in stems:
        want = whole.decompose(stem)
        assert {k: got[stem][k] for k in want} == want, stem


def test_undo_takes_back_the_last_action_that_stands(spark):
    import random

    rng = random.Random(2)
    log, stacks, sessions = [], {}, {}
    for ts in range(400):
        record, action = rng.randrange(6), rng.choice(["approve", "reject", "skip", "undo", "undo"])
        log.append((record % 2, record, action, ts))
        stack, whole = stacks.setdefault(record, []), sessions.setdefault(record % 2, [])
        if action == "undo":
            for some in (stack, whole):
                some and some.pop()
        else:
            stack.append(action)
            whole.append((record, action))
    table = spark.createDataFrame(log, "who long, record_key long, action string, ts long")
    assert {r.record_key: r.action for r in store.decided(table).collect()} == {k: s[-1] for k, s in stacks.items() if s}
    want = {}
    for whole in sessions.values():
        want.update(dict(whole))
    assert {r.record_key: r.action for r in store.decided(table, session=["who"]).collect()} == want
    nested = spark.createDataFrame([(1, "approve", 1), (1, "reject", 2), (1, "skip", 3), (1, "undo", 4), (1, "undo", 5), (2, "undo", 1), (2, "skip", 2)], "record_key long, action string, ts long")
    assert rows(store.decided(nested)) == [(1, "approve"), (2, "skip")]


def test_contexts_of_many_candidates(spark):
    texts = [(i, 0, f"Here is word{i} again") for i in range(10_500)]
    found = ngrams.sample_context(spark.createDataFrame([(f"word{i} a",) for i in range(10_500)], "phrase string"), spark.createDataFrame(texts, "doc_id long, sent_idx int, sentence string"))
    assert found.count() == 10_500
    import pytest

    with pytest.raises(ValueError):
        ngrams.sample_context(spark.createDataFrame([("a",), ("b",)], "phrase string"), spark.createDataFrame(texts, "doc_id long, sent_idx int, sentence string"), most=1)


def test_concept_roots(spark):
    done = morphology.decompose(spark.createDataFrame([("vaporŝip",), (None,)], "stem string"), morphology.root_table(spark, {"vapor": ("core", 3), "ŝip": ("core", 3)}))
    got = morphology.concept_roots(spark.createDataFrame([(7, "vaporŝip")], "concept_id int, stem string"), done)
    assert rows(got) == [(7, "vapor", 0, False), (7, "ŝip", 1, True)]


def test_statute(spark):
    lines = ["Article 2. Old", "1. Old – text.", "Article 2. Definitions", "1. Customs debt (CD) – the duty", "continued here", "Nr. XII-1 amended", "2 1. Goods (a – b) - as defined in Law X (2).", "1) a part", "3. No separator here", "Article 3. Other", "1. Not – this."]
    rows_ = spark.createDataFrame([("f", i, x) for i, x in enumerate(lines)], "source_file string, line_no int, line string")
    got = {r.clause_num: r for r in statutory.definitions(rows_, "2", "en").collect()}
    assert set(got) == {"1", "21"}
    assert (got["1"].term_raw, got["1"].definition_raw, got["1"].definition_type) == ("Customs debt", "the duty continued here", "direct")
    assert (got["21"].term_raw, got["21"].definition_type, got["21"].by_reference_law) == ("Goods", "by_reference", "Law X")
    lt = spark.createDataFrame([("f", 0, "2 straipsnis. X"), ("f", 1, "1. Mokestis (toliau – M) – kaip ši sąvoka apibrėžta Įstatyme.")], "source_file string, line_no int, line string")
    r = statutory.definitions(lt, "2", "lt").first()
    assert (r.abbrev, r.by_reference_law) == ("M", "Įstatyme")


def test_lexicon(spark):
    pool = spark.createDataFrame([("custom-made", 9), ("ab", 9), ("rare", 1), ("tariffs", 9), ("known", 9), ("x1y", 9)], "token string, n int")
    words = spark.createDataFrame([("known",)], "word string")
    none = spark.createDataFrame([], "word string")
    assert dict(rows(lexicon.seed_reasons(pool, words, none).select("token", "reason"))) == {"custom-made": "kept", "ab": "short", "rare": "frequency", "tariffs": "stem", "known": "lexicon", "x1y": "characters"}
    existing = spark.createDataFrame([("Duty Free", "en")], "word string, lang string")
    new = spark.createDataFrame([("duty free", None), ("Rules of origin", None), ("rules of origin", "NOUN")], "word string, pos string")
    assert lexicon.load_phrases(existing, new, 3, "en", "t").count() == 1
    v = spark.createDataFrame([(1, "big", "adj", 1, "s", "granda"), (2, "large", "adj", 2, "s", "granda"), (3, "odd", "adj", 2, "s", None)], "id int, word string, pos string, tier int, source string, eo_word string")
    concepts, lang = lexicon.migrate_vocabulary(v)
    assert (concepts.count(), lang.count()) == (2, 3)


def test_separator_outside_parentheses(spark):
    texts = ["a – b", "a (x – y) - b", "(a - b", "a) - b", "no dash", "", None, " - a", "a - - b", "x" * 5000 + " – y"]
    got = [r.at for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", statutory.separator_at(F.col("t")).alias("at")).orderBy("i").collect()]
    assert got == [2, 10, 0, 0, 0, 0, 0, 1, 2, 5001]


def test_synonyms_are_linked_or_told_why_not(spark):
    phrases = spark.createDataFrame([(1, "en", "a"), (1, "en", "a1"), (2, "en", "b"), (9, "en", "b"), (3, "en", "c"), (4, "lt", "a")], "id long, lang string, phrase string")
    pairs = spark.createDataFrame([("en", "a", "b"), ("en", "b", "a1"), ("en", "a", "a1"), ("en", "a", "zz"), ("en", "zz", "a"), ("en", "c", "a"), ("lt", "a", "b")], "lang string, canonical string, synonym string")
    got = {(r.lang, r.canonical, r.synonym): (r.id_a, r.id_b, r.reason) for r in store.link_synonyms(phrases, pairs, spark.createDataFrame([(1, 3)], "id_a long, id_b long")).collect()}
    assert got == {("en", "a", "b"): (1, 2, None), ("en", "b", "a1"): (2, 1, "repeated"), ("en", "a", "a1"): (1, 1, "one concept"), ("en", "a", "zz"): (1, None, "no synonym"), ("en", "zz", "a"): (None, 1, "no canonical"), ("en", "c", "a"): (3, 1, "linked"), ("lt", "a", "b"): (4, None, "no synonym")}


def test_concepts_are_rebuilt_into_a_new_snapshot(spark, tmp_path):
    from glossmill.sources import snapshots

    folder = str(tmp_path / "lexicon")
    concepts = spark.createDataFrame([(1, "vaporŝipo", "old"), (2, None, None), (3, "Malsanulejo", None)], "concept_id long, eo_word string, eo_kind string")
    snapshots.commit(spark, folder, {"concepts": concepts})
    held = snapshots.read(spark, folder, ["concepts"])
    snapshots.commit(spark, folder, morphology.rebuilt_concepts(held["concepts"], morphology.root_table(spark, ROOTS)))
    now = snapshots.read(spark, folder, ["concepts", "concept_root"])
    assert rows(now["concepts"].select("concept_id", "eo_kind", "eo_head_tier", "eo_morphemes").where("eo_kind is not null")) == [(1, "compound", "core", 2), (3, "derived", "core", 4)]
    assert now["concepts"].count() == 3 and rows(now["concept_root"]) == [(1, "vapor", 0, False), (1, "ŝip", 1, True), (3, "san", 0, True)]
    assert snapshots.numbers(spark, folder) == [1, 2]


def test_a_stem_meets_only_the_roots_that_its_analysis_can_use(spark):
    inventory = {"san": ("core", 9), "vapor": ("extended", 2), "vaporsan": ("tail", 1), "sanul": ("tail", 1), "por": ("tail", 1), "old": ("tail", 4), "oldsan": ("core", 3), "sanold": ("tail", 1)}
    stems = ["san", "vaporsan", "sanul", "oldsan", "sanold", "porsan", "sanporul", "du", "dusan", "SAN", "q"]
    named = morphology.named_roots(morphology.root_table(spark, inventory))
    table = spark.createDataFrame([(x,) for x in stems], "stem string")
    found = {r.stem: sorted(x["root"] for x in r.found or []) for r in morphology.roots_needed(table, named).collect()}
    assert found["san"] == ["san"] and found["oldsan"] == ["oldsan"]
    assert found["vaporsan"] == ["san", "vapor", "vaporsan"] and found["sanold"] == ["old", "san", "sanold"]
    assert found["porsan"] == ["por", "san"] and found["q"] == []
    whole = morphology.Decomposer(inventory)
    got = {r.stem: r.asDict() for r in morphology.decompose(table, morphology.root_table(spark, inventory)).collect()}
    assert got == {x: {"stem": x, **whole.decompose(x)} for x in stems}


def test_stems_are_made_of_distinct_words_not_of_every_use(spark, tmp_path):
    from glossmill.plans import lexicon as plans

    spark.createDataFrame([(1, "Domoj domojn domo. Domo domo!")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    asked = plans._stems(spark, str(tmp_path)).select("stem").distinct().where("stem is not null")
    plan = asked._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan
    assert rows(asked) == [("dom",)]


def test_matches_are_chosen_once_for_units_and_their_words(spark):
    runs = spark.createDataFrame([(0, 0, 0, ["a", "b", "c", "t"]), (0, 1, 0, ["t", "u"])], "doc_id int, sent_idx int, run_idx int, words array<string>")
    phrases, lex = spark.createDataFrame([("a b",), ("b c",)], "phrase string"), spark.createDataFrame([("a", 1), ("c", 2), ("t", 3)], "word string, tier int")
    counts = coverage.coverage_counts(runs, phrases, lex, ["doc_id", "sent_idx", "run_idx"], ["doc_id"])
    assert counts._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert rows(counts.select("t1", "t2", "t3", "t4", "unknown")) == [(0, 1, 2, 1, 1)]
