"""Operators of the training-data pipeline: brute force on small tables, odd rows, held-out accuracy."""

import collections
import hashlib
import math
import re
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from oracle import compare, connect
from riskloom.llm import bpe, classifier, common, context_mixing, exact_dedup, licenses, mixing, near_dedup, pii, quality_rules, toxicity
from riskloom.llm.queries import QUERIES, SQL
from riskloom.llm.training import lowest_hashes

TINY, SMALL = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x20\x09-\x0d]+")

LONG = "very long text " * 40_000
ODD = [
    (1, None, None, None), (2, "", "", "a"), (3, " \n\t ", "en", "a"), (4, LONG, "en", "b"), (5, "same words here for all of us today", "en", None),
    (5, "same words here for all of us today", "en", None), (6, "same words here for all of us today ", "en", "b"), (7, "Licensed under CC BY-NC 4.0.", "de", "b"),
    (8, "write to me.you@mail.example.com or +1 (499) 555-6503 from 10.0.0.1", "fr", "c"), (None, "no id at all", None, "c"), (9, "ÀÉ 😀 naïve \x00 it's", "fr", "c"),
]
# names that the operators use inside
CLASHES = "row size key target label words digest score kept part tree items n_chars text_sha256 run word place".split()


@pytest.fixture(scope="module")
def odd(spark):
    from pyspark.sql import functions as F

    base = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("bigint"))
    return base.withColumns({n: F.lit("x") for n in CLASHES if n != "n_chars"})


@pytest.fixture(scope="module")
def marks(spark):
    rows = [(i, i % 2, int(i % 5 == 0)) for i in range(1, 10)] + [(3, None, None), (None, 1, 1), (5, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def texts_of(spark, folder):
    return {r[0]: r[1] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(SMALL), QUERIES[name], SQL[name], SMALL) is None


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


# ---- near-duplicates -----------------------------------------------------------------------------------------------------------------


def brute_components(texts, k, percent):
    sets = {}
    for i, t in texts.items():
        w = WORD.findall(t.translate(LOW))
        sets[i] = frozenset(tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))) if w else frozenset()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids, holders = sorted(sets), collections.defaultdict(list)
    for i in ids:
        shared = collections.Counter(j for s in sets[i] for j in holders[s])
        for j, n in shared.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
        for s in sets[i]:
            holders[s].append(i)
    return {i: (len(sets[i]), root(i)) for i in ids}


def test_near_duplicates_equal_brute_force(spark):
    want = brute_components(texts_of(spark, SMALL), 3, 85)
    got = by_id(QUERIES["op1_near_dedup"](spark, SMALL))
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
    assert all(r["kept"] == (r["component_id"] == i) for i, r in got.items())


def family_texts(seed=4, n=150):
    """A base text, many copies that differ from it in a few words (and so more from each other), a chain, and strangers."""
    rng = np.random.default_rng(seed)
    base = [f"w{k}" for k in rng.integers(0, 5_000, 200)]
    out = [" ".join(base)]
    for _ in range(n):
        copy = list(base)
        for at in rng.choice(200, 4, replace=False):
            copy[at] = f"x{rng.integers(0, 10**9)}"
        out.append(" ".join(copy))
    chain = [f"c{k}" for k in range(120)]
    for step in range(12):
        out.append(" ".join(chain[step * 2:] + [f"d{k}" for k in range(step * 2)]))
    out += [" ".join(f"s{k}" for k in rng.integers(0, 10**6, 150)) for _ in range(50)]
    return dict(enumerate(out))


def test_star_shaped_families_and_chains(spark):
    texts = family_texts()
    for k, percent in ((3, 85), (5, 80)):
        want = brute_components(texts, k, percent)
        got = by_id(near_dedup.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), k, percent))
        assert {i: r["component_id"] for i, r in got.items()} == {i: c for i, (_, c) in want.items()}


def test_links_of_a_region_connect_what_is_alike():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, 40).astype(np.uint64) + np.uint64(40 * (i % 3))) for i in range(60)] + [np.array([], dtype=np.uint64)]
    links = list(near_dedup.region_links(list(range(61)), sets, 45))
    parent = list(range(61))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(61):
        for j in range(i):
            n = len(np.intersect1d(sets[i], sets[j]))
            if n and 100 * n >= 45 * (len(sets[i]) + len(sets[j]) - n):
                parent[root(i)] = root(j)
    want = len({root(x) for x in range(61)})
    assert len(links) == 61 - want and all(root(a) == root(b) for a, b in links) and 1 < want < 61


def star_family():
    """Texts that are each like the base only, so that no two others are alike."""
    rng = np.random.default_rng(9)
    base = [f"w{k}" for k in range(200)]
    texts = []
    for _ in range(300):
        copy = list(base)
        for at in rng.choice(np.arange(5, 195, 5), 5, replace=False):
            copy[at] = f"x{rng.integers(0, 10**9)}"
        texts.append(" ".join(copy))
    return dict(enumerate([*texts, " ".join(base)]))


@pytest.mark.parametrize("region_rows, region_items, pivots", [(20, 2_000, 32), (20, 1_000_000, 0), (4_000, 2_000, 1), (4_000, 1_000_000, 32)])
def test_regions_beyond_the_limits_are_finished(spark, monkeypatch, region_rows, region_items, pivots):
    monkeypatch.setattr(near_dedup, "REGION_ROWS", region_rows)
    monkeypatch.setattr(near_dedup, "REGION_ITEMS", region_items)
    monkeypatch.setattr(near_dedup, "PIVOTS", pivots)
    texts = star_family() if region_rows < 4_000 else {**star_family(), **{1_000 + i: t for i, t in family_texts().items()}}
    want = brute_components(texts, 3, 85)
    got = by_id(near_dedup.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), 3, 85))
    assert {i: r["component_id"] for i, r in got.items()} == {i: c for i, (_, c) in want.items()}


def test_ids_with_several_texts(spark):
    one, two = " ".join(f"a{k}" for k in range(60)), " ".join(f"b{k}" for k in range(60))
    rows = [(1, one), (1, two), (3, two + " more"), (4, one + " more"), (5, "something else altogether here now"), (5, "something else altogether here now"), (None, two), (-2, " ".join(f"c{k}" for k in range(60)))]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = collections.Counter((r["doc_id"], r["component_id"]) for r in near_dedup.near_duplicates(table, 3, 85).collect())
    assert got == collections.Counter({(1, 1): 2, (3, 1): 1, (4, 1): 1, (5, 5): 2, (None, 1): 1, (-2, -2): 1})
    left = collections.Counter(map(tuple, near_dedup.drop_near_duplicates(table, 3, 85).collect()))
    assert left == collections.Counter({(1, one): 1, (1, two): 1, rows[5]: 1, rows[7]: 1})


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 200)] + [(500, 501)], "a long, b long")
    got = {r["id"]: r["component"] for r in near_dedup.components(links).collect()}
    assert set(got.values()) == {1, 500} and got[200] == 1 and got[501] == 500


def test_near_duplicates_of_odd_rows(spark, odd):
    rows = near_dedup.near_duplicates(odd, 3, 85).collect()
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(ODD) and all(got[i]["n_shingles"] == 0 and got[i]["kept"] for i in (1, 2, 3))
    assert got[6]["component_id"] == 5 and not got[6]["kept"] and got[None]["kept"]
    assert near_dedup.drop_near_duplicates(odd, 3, 85).count() == len(ODD) - 2
    assert near_dedup.near_duplicates(odd.limit(0), 3, 85).count() == 0


# ---- quality, toxicity, licenses -----------------------------------------------------------------------------------------------------


def brute_rules(t):
    words = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    grams = collections.Counter(zip(words, words[1:], words[2:]))
    hit = {j + d for j in range(len(words) - 2) if grams[tuple(words[j:j + 3])] > 1 for d in range(3)}
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit), failed


def test_quality_rules_equal_brute_force(spark):
    texts, got = texts_of(spark, SMALL), by_id(QUERIES["op2_quality_rules"](spark, SMALL))
    for i, t in texts.items():
        r = got[i]
        assert tuple(r[n] for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) == brute_rules(t), i
        assert not (r["base_failed"] and r["kept"])
    marks = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    passed = [i for i in marks if not got[i]["base_failed"]]
    assert np.mean([got[i]["kept"] == bool(marks[i]) for i in passed]) > 0.95


def auc(score, truth):
    score, truth = np.array(score), np.array(truth)
    ranks = np.argsort(np.argsort(score)) + 1
    n1 = truth.sum()
    return (ranks[truth == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(truth) - n1))


def test_quality_does_not_depend_on_the_partitioning(spark, odd):
    from riskloom.llm.common import documents, labels

    docs = documents(spark, SMALL)
    model = quality_rules.fit_quality(docs, labels(spark, SMALL))
    one, two = (by_id(quality_rules.apply_rules(docs.repartition(n), model)) for n in (1, 7))
    assert one.keys() == two.keys() and all(one[i]["probability"] == pytest.approx(two[i]["probability"], abs=1e-8) and one[i]["kept"] == two[i]["kept"] for i in one)


@pytest.mark.parametrize("name, label, fold, least", [("op4_quality_classifier", "quality", lambda c: c % 5 == 0, 0.97), ("op6_toxicity", "toxic", lambda c: c % 4 == 2, 0.75)])
def test_held_out_accuracy(spark, name, label, fold, least):
    got = by_id(QUERIES[name](spark, SMALL))
    assert all(r["held_out"] == fold(zlib.crc32(str(i).encode())) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for i, r in got.items())
    marks = [(r["doc_id"], r[label]) for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()]
    held = [(got[i]["score"], y) for i, y in marks if got[i]["held_out"]]
    assert auc(*zip(*held)) > least


def test_classifiers_on_odd_rows_and_without_labels(spark, odd, marks):
    for fit, apply in ((toxicity.fit_toxicity, toxicity.score_toxicity), (classifier.fit_classifier, classifier.classify), (quality_rules.fit_quality, quality_rules.apply_rules)):
        for labels in (marks, marks.limit(0)):
            model = fit(odd, labels)
            rows = apply(odd, model).collect()
            assert len(rows) == len(ODD)
            assert apply(odd.limit(0), model).count() == 0
            if "kept" in rows[0]:
                assert not any(r["kept"] for r in rows if r["n_words"] < 50)
            else:
                assert all(0 <= r["score"] <= 1 for r in rows)
                assert len({r["score"] for r in rows if r["doc_id"] in (1, 2, 3)}) == 1
    assert toxicity.drop_toxic(odd, toxicity.fit_toxicity(odd, marks.limit(0))).columns == odd.columns


def brute_licenses(t):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", t.translate(LOW))
    at = [(j, label) for phrase, label in licenses.BASE_PHRASES for p in [phrase.split()] for j in range(len(words)) if words[j:j + len(p)] == p]
    places = [j for j, _ in at]
    return len(words), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at}))


def test_license_scan_equals_brute_force(spark):
    got = by_id(QUERIES["op5_license_scan"](spark, SMALL))
    for i, t in texts_of(spark, SMALL).items():
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_licenses(t), i
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and (r["score"] > 0) == bool(r["labels"])


def test_license_passages_with_changed_words(spark):
    notice = licenses.PASSAGES[1][0].split()
    rows = [(1, " ".join([*notice[:9], "extra", *notice[9:]])), (2, " ".join(notice[:5])), (3, "Under the MIT license, under the MIT License"), (4, "CC-BY-NC; gnu")]
    got = by_id(licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")))
    assert (got[1]["labels"], got[1]["base_labels"]) == ("apache-2", "") and got[2]["labels"] == "" and got[2]["score"] == 0
    assert (got[3]["n_base"], got[3]["first_word"], got[3]["last_word"]) == (2, 0, 4) and got[4]["base_labels"] == "cc-by-nc"


def test_license_scan_of_odd_rows(spark, odd):
    rows = licenses.scan_licenses(odd).collect()
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(ODD) and got[1]["labels"] == "" and got[7]["base_labels"] == "cc-by-nc" and got[4]["n_words"] == 120_000
    assert licenses.scan_licenses(odd.limit(0)).count() == 0


# ---- language model --------------------------------------------------------------------------------------------------------------


def test_language_model_base_and_gain(spark):
    texts = {i: t.translate(LOW) for i, t in texts_of(spark, SMALL).items()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in texts}
    counts = collections.Counter()
    for i, t in texts.items():
        if not held[i]:
            counts.update([*WORD.findall(t), None])
    total, distinct = sum(counts.values()), len(counts)
    got = by_id(QUERIES["op3_lm_scoring"](spark, SMALL))
    for i, t in texts.items():
        tokens, r = [*WORD.findall(t), None], got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(tokens), sum(counts[w] > 0 for w in tokens), total)
        assert math.isclose(r["base_score"], sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in tokens), rel_tol=1e-9)
        assert r["score"] < 0 and math.isclose(r["bits_per_byte"], -r["score"] / math.log10(2) / (sum(len(w.encode()) + 1 for w in tokens[:-1]) + 1), rel_tol=1e-9)
    assert sum(r["score"] for i, r in got.items() if held[i]) > sum(r["base_score"] for i, r in got.items() if held[i])


def test_bits_of_a_place_sum_to_one():
    """Probabilities of all next bytes after a prefix add up to 1."""
    words = [b"\x01" + w.encode() + b" " for w in "the then there to in inn".split()]
    size = int(context_mixing._OFFSETS[-1])
    zeros, ones = np.zeros(size, dtype=np.float32), np.zeros(size, dtype=np.float32)
    context_mixing.bit_counts(words, np.arange(1, 7), zeros, ones)
    model = context_mixing.learn_mixing(zeros, ones, words, np.arange(1.0, 7.0), stream=500)
    shorter = model.log10([b"\x01th"])[0]
    longer = model.log10([b"\x01th" + bytes([b]) for b in range(256)])
    assert math.isclose(np.sum(10**longer), 10**shorter, rel_tol=1e-6)


def test_language_model_of_odd_rows(spark, odd):
    rows = context_mixing.score_texts(odd).collect()
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(ODD) and got[1]["n_tokens"] == got[2]["n_tokens"] == 1 and got[4]["n_tokens"] == 120_001
    assert got[1]["score"] == got[3]["score"]
    assert context_mixing.score_texts(odd.limit(0)).count() == 0
    alone = spark.createDataFrame([(i, "only held out") for i in range(40) if zlib.crc32(str(i).encode()) % 5 == 1], "doc_id long, text string")
    assert {(r["n_known"], r["train_tokens"]) for r in context_mixing.score_texts(alone).collect()} == {(0, 0)}


def test_language_model_learns_from_all_words_and_texts(spark, monkeypatch):
    """Every training word moves weights and refinement by all its times, in whichever piece; states are found on all texts, however rows are dealt."""
    common.ship_package(spark)
    monkeypatch.setattr(context_mixing, "PIECE_WORDS", 40)
    words = [(b"\x01" + f"word{i * i}".encode(), 1 + i % 7) for i in range(150)]
    vocabulary = spark.createDataFrame([(bytearray(w), c) for w, c in [*words, (b"\x01unseen", 0)]], "word binary, c long")
    zeros = np.zeros(int(context_mixing._OFFSETS[-1]), dtype=np.float32)
    pieces = context_mixing._learn(vocabulary, zeros, zeros, len(words))
    bits = sum(8 * len(w) * c for w, c in words)  # the state's byte is not spelled, the space is
    assert len(pieces) == 4 and math.isclose(sum(p.seen.sum() for p in pieces), bits, rel_tol=1e-5)
    assert math.isclose(sum(p.met.sum() for p in pieces), bits * context_mixing.passes_of(len(words)), rel_tol=1e-5)
    texts = spark.createDataFrame([(i, ["abc cab", "xyz zyx", "mnop"][i % 3] + " q" * (i % 2)) for i in range(2_400)] + [(-1, "")], "doc_id long, text string")
    found = [context_mixing.find_states(texts.repartition(n)) for n in (1, 5)]
    assert (found[0] == found[1]).all()
    x = np.array([context_mixing.letter_shares(t.encode().split()) for _, t in texts.collect()])
    own = ((x[:, None] - found[0]) ** 2).sum(axis=2).argmin(axis=1)
    assert len(set(own)) == 7 and all(np.allclose(x[own == k].mean(axis=0), found[0][k], atol=1e-3) for k in range(7))


# ---- exact duplicates, mixing ----------------------------------------------------------------------------------------------------


def test_exact_duplicates_of_odd_rows(spark, odd):
    rows = exact_dedup.exact_duplicates(odd).collect()
    got = collections.defaultdict(list)
    for r in rows:
        got[r["doc_id"]].append(r)
    assert len(rows) == len(ODD) and sum(r["kept"] for r in rows) == 7
    assert got[6][0]["kept"] and {r["keep_id"] for r in got[5]} == {6} and {r["group_size"] for r in got[5]} == {3}  # the longest stays
    assert got[3][0]["kept"] and got[1][0]["keep_id"] == 3
    kept = exact_dedup.drop_exact_duplicates(odd)
    assert kept.columns == odd.columns and kept.count() == 7 and exact_dedup.exact_duplicates(odd.limit(0)).count() == 0
    twice = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, "c")], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in exact_dedup.drop_exact_duplicates(twice).collect()) == [1, 2]


def test_exact_duplicates_under_one_id(spark):
    rows = [(1, "a b"), (1, "ab"), (2, "x"), (3, "a  b"), (4, "x "), (4, " x"), (None, "y"), (None, "y")]
    left = sorted(map(tuple, exact_dedup.drop_exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert [r for r in left if r[0] != 4] == [(3, "a  b"), (None, "y")] and [r[0] for r in left].count(4) == 1 and len(left) == 3


def test_frequent_keys_are_found_and_few(spark):
    from pyspark.sql import functions as F

    df = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    got = {r["k"] for r in exact_dedup.frequent_keys(df, "k", counters=20).collect()}
    assert "hot" in got and len(got) <= 21


def test_mixing_of_odd_rows(spark, odd):
    rows = mixing.mix_sources(odd).collect()
    assert len(rows) == len(ODD) and all(r["taken"] <= 3 * r["size"] and r["target"] <= 3 * r["source_size"] for r in rows)
    assert math.isclose(sum({r["source"]: r["target"] for r in rows}.values()), sum(r["size"] for r in rows))
    assert sum(r["taken"] for r in rows) <= sum(r["size"] for r in rows)
    assert mixing.mixed_rows(odd).columns == odd.columns and mixing.mix_sources(odd.limit(0)).count() == 0


def test_mixing_comes_near_its_targets(spark):
    rows = mixing.mix_sources(spark.read.parquet(f"{SMALL}/documents.parquet")).collect()
    taken, target, largest = collections.Counter(), {}, collections.Counter()
    for r in rows:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    assert all(abs(taken[s] - target[s]) <= largest[s] + 1 for s in target)


def test_lm_tables_travel_compressed_and_are_built_alike():
    import pickle
    rng, size = np.random.default_rng(5), int(context_mixing._OFFSETS[-1])
    zeros, ones = np.zeros(size, dtype=np.float32), np.zeros(size, dtype=np.float32)
    words = [bytes([k % 8]) + w + b" " for w in (b"alpha", b"alpine", b"beta") for k in range(8)]
    context_mixing.bit_counts(words, rng.integers(1, 9, len(words)), zeros, ones)
    sent = pickle.dumps(context_mixing.Sent(context_mixing.Inputs.of, zeros, ones))
    assert len(sent) < 2_000_000  # 71 MB as arrays, on the disk of the driver and of every executor
    built, own = pickle.loads(sent).built, context_mixing.Inputs.of(zeros, ones)
    assert np.array_equal(built.stretched, own.stretched) and np.array_equal(built.trust, own.trust)
    slots = rng.integers(0, size, 1_000)
    for bit in (0, 1):
        n0, n1 = np.maximum(zeros[slots] - (bit == 0), 0), np.maximum(ones[slots] - (bit == 1), 0)
        assert np.allclose(own.stretched[2 * slots + bit], np.log((n1 + 0.2) / (n0 + 0.2)), atol=1e-5)


def test_lm_bytes_of_one_beginning_are_spelled_once():
    words = [bytes([g]) + w + b" " for g in (0, 3) for w in (b"counting", b"counts", b"count", b"", b"other")]
    each, once = context_mixing.Spelled.of(words), context_mixing.Spelled.of(words, once=True)
    assert once.slots.shape[1] < 0.7 * each.slots.shape[1]
    pick = (8 * once.spelled[:, None] + np.arange(8)).reshape(-1)
    assert np.array_equal(once.slots[:, pick], each.slots) and all(np.array_equal(getattr(once, n)[pick], getattr(each, n)) for n in ("bits", "places", "states"))


# ---- personal data ---------------------------------------------------------------------------------------------------------------

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_ok(kind, v):
    d = re.sub("[^0-9]", "", v)
    if kind == "ip":
        return all(int(x) <= 255 for x in v.split("."))
    if kind == "phone":
        return 9 <= len(d) <= 15
    return kind == "email" or 13 <= len(d) <= 19 and sum(sum(divmod(int(x) * (1 + j % 2), 10)) for j, x in enumerate(reversed(d))) % 10 == 0


def test_personal_data_rules_equal_plain_patterns(spark):
    odd_texts = ["a@b-c.d+x@e.f zz a@b.c.d@e.f", "1.2.3.4.5 300.1.1.1 01.002.3.4 99999999999.1.1.1", "4111 1111 1111 1111 41111111-1111-1111 4111111111111112",
                 "+1 (499) 555-6503 +49 12 +123456789012345678 ++1234567890 +1-2-3-4-5-6-7-8-9", "éà x@y.zz 😀 q@w.ee", "", None, "1" * 3000, "x@" * 50 + "a.b", "a" * 5000, "+1" + "(" * 500]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").union(spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(odd_texts)], "doc_id long, text string"))
    got = by_id(pii.personal_data_digest(docs))
    for i, t in docs.collect():
        spans = [(k, m.start(), m.end()) for k in PLAIN for m in re.finditer(PLAIN[k], t or "") if plain_ok(k, m.group())]
        text, r = ",".join("%s:%d:%d" % s for s in spans), got[i]
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest(), i
        assert tuple(r[f"n_{k}"] for k in PLAIN) == tuple(sum(s[0] == k for s in spans) for k in PLAIN)
        assert set(filter(None, text.split(","))) <= set(r["spans"].split(","))


def test_personal_data_of_odd_rows(spark, odd):
    rows = pii.find_personal_data(odd).collect()
    assert len(rows) == len(ODD) and [len(r["spans"]) for r in rows if r["doc_id"] == 8] == [3] and [r["spans"] for r in rows if r["doc_id"] == 1] == [[]]
    assert pii.find_personal_data(odd.limit(0)).count() == 0
    twice = spark.createDataFrame([(1, "x 10.0.0.1 y 10.0.0.2")] * 2, "doc_id long, text string")
    assert [[(s["start"], s["end"]) for s in r["spans"]] for r in pii.find_personal_data(twice).collect()] == [[(2, 10), (13, 21)]] * 2


def test_obfuscated_personal_data_is_added(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    values = ["jane.roe at example dot org", "4111.1111.1111.1111", "0049 30 5550 1234", "(499) 555-6503 12"]
    planted = [(10**6 + i, f"you can reach them by {v} or not") for i, v in enumerate(values)]
    refused = [(10**6 + 10, "you can reach them by 4111.1111.1111.1112 or not"), (10**6 + 11, "write to someone@nowhere or not")]
    got = by_id(pii.find_personal_data(docs.union(spark.createDataFrame(planted + refused, docs.schema))))
    added = {i: {t[s["start"]:s["end"]] for s in got[i]["spans"]} for i, t in planted + refused}
    assert all(v in added[10**6 + i] for i, v in enumerate(values[:3])), added
    assert not any(s["kind"] == "card" for s in got[10**6 + 10]["spans"]) and not got[10**6 + 11]["spans"], added


PLANTED = {
    "email": ["jane.roe at example dot org", "bob(at)example.org", "kim.lee [at] mail [dot] example [dot] com", "josé@example.com", "ann_b at firm dot net", "x.y.z(at)host-a.edu"],
    "ip": ["10[.]20[.]30[.]40", "172[.]16[.]254[.]1"],
    "card": ["4111.1111.1111.1111", "5500/0000/0000/0004", "4012.8888.8888.1881", "3530.1113.3330.0000"],
    "phone": ["001 (499) 555-6503", "0049 30 5550 1234", "001 663 555 6868", "(499) 555-6503 12", "499-555-6503", "212.555.0187"],
}
ORDINARY = ["look at the dot on the page", "ref (12) 345678 was closed", "we met at the dot com office", "a total of 4111.1111.1111.1112 units", "someone@nowhere wrote", "pages 10[.]20[.]999[.]40 of it",
            "arrive at noon dot then leave", "he stood at a dot in the middle", "item 0077672059906506 sold", "nr 9807915762804490 of the list", "version 10:20:30:40 of it"]


def test_planted_formats_are_added_and_ordinary_text_is_not(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    planted = [(10**6 + i, kind, f"you can reach them by {v} or not") for i, (kind, v) in enumerate((k, v) for k in PLANTED for v in PLANTED[k])]
    plain = [(2 * 10**6 + i, t) for i, t in enumerate(ORDINARY)]
    got = by_id(pii.find_personal_data(docs.union(spark.createDataFrame([(i, t) for i, _, t in planted] + plain, docs.schema))))
    for kind, values in PLANTED.items():
        missed = [t for (i, k, t), v in zip([p for p in planted if p[1] == kind], values) if not any(s["kind"] == kind and s["start"] <= t.index(v) and s["end"] >= t.index(v) + len(v) for s in got[i]["spans"])]
        assert len(missed) <= 0.1 * len(values), (kind, missed, [(k, t, got[i]["spans"]) for i, k, t in planted if k == kind])
    assert [(t, got[i]["spans"]) for i, t in plain if got[i]["spans"]] == []
    for i, _, t in planted:
        ends = sorted((s["start"], s["end"]) for s in got[i]["spans"])
        assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:])), (t, got[i]["spans"])
    added = [(i, s) for i, r in got.items() if i < 10**6 for s in r["spans"] if not s["base"]]
    texts = dict(docs.where(docs.doc_id.isin([i for i, _ in added])).collect())
    assert all(s["kind"] == "card" and plain_ok("card", texts[i][s["start"]:s["end"]]) for i, s in added), [(s, texts[i][s["start"]:s["end"]]) for i, s in added]


def test_lowest_hashes_bound_the_sample(spark):
    rows = spark.range(5000).selectExpr("xxhash64(id) AS h")
    every = sorted(r["h"] for r in rows.collect())
    for limit in (0, 1, 700, 4999):
        bound = lowest_hashes(rows, "h", limit)
        assert 0.9 * limit <= sum(h < bound for h in every) <= limit
    assert lowest_hashes(rows, "h", 5000) > every[-1] and lowest_hashes(rows.limit(0), "h", 5) > every[-1]
    narrow = spark.range(3000).selectExpr("id div 3 AS h")  # all in one group until the last bits, three rows to a value
    bound = lowest_hashes(narrow, "h", 100)
    assert 90 <= narrow.where(f"h < {bound}").count() <= 100


def test_personal_data_stays_in_the_jvm(spark):
    plan = pii.personal_data_digest(spark.read.parquet(f"{TINY}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    plan = mixing.mix_sources(spark.read.parquet(f"{TINY}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ---- byte-pair encoding ----------------------------------------------------------------------------------------------------------


def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(VOCABULARY)
    t.no_truncation()
    t.no_padding()
    return t


def test_encoding_equals_the_library(spark):
    texts, lib = texts_of(spark, TINY), library()
    got = by_id(bpe.encode_decode(spark.read.parquet(f"{TINY}/documents.parquet"), VOCABULARY))
    for i, t in texts.items():
        ids = lib.encode(t, add_special_tokens=False).ids
        assert got[i]["ids"] == ids and got[i]["decoded"] == lib.decode(ids, skip_special_tokens=False)


def test_encoding_of_odd_texts():
    lib, own = library(), bpe.WordBpe(VOCABULARY)
    rng = np.random.default_rng(2)
    texts = ["", " ", "<|endoftext|> a<|startoftext|>b <|x|>", "ΑΣ ΣΑΣ İSTANBUL ǅ ß", "it's they'RE I'll 'd x'tt", "Å é", "a\x85b\x1cc​d　e\xadf﻿g", "100 000 ½ ² Ⅷ 一二三", "!!!***&&& '''s", "🎉🎉 👨‍👩‍👧", "x" * 300, "ab" * 200]
    texts += ["".join(map(chr, rng.integers(32, 0x24F, 80))) for _ in range(300)] + ["".join(map(chr, rng.integers(0x4E00, 0x9FFF, 30))) for _ in range(50)]
    for t, ids in zip(texts, own.encode_all(texts)):
        assert ids == lib.encode(t, add_special_tokens=False).ids, t
        assert own.decode(ids) == lib.decode(ids, skip_special_tokens=False)


def test_encoding_of_odd_rows(spark, odd):
    rows = bpe.encode_decode(odd, VOCABULARY).collect()
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(ODD) and got[1]["ids"] == [] and got[1]["decoded"] == "" and len(got[4]["ids"]) == 120_000
    assert bpe.encode_decode(odd.limit(0), VOCABULARY).count() == 0


# ---- pipeline ----------------------------------------------------------------------------------------------------------------------


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, made, lib = docs.columns, {}, library()
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SMALL).persist()
        made[name] = ([tuple(r) for r in before.select("doc_id", "text", "source").collect()], docs)
        if name != "bpe":
            assert docs.columns == columns
    kept = {r["doc_id"] for r in made["toxicity"][1].collect()}
    marks = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    assert np.mean([i in kept for i, y in marks.items() if not y]) > 0.97 and np.mean([i in kept for i, y in marks.items() if y]) < 0.35
    groups = {}
    for i, t, _ in made["exact_dedup"][0]:
        key = re.sub("[\x20\x09-\x0d]", "", t)
        groups[key] = min(groups.get(key, (0, 1 << 60)), (-len(t), i))
    assert {r["doc_id"] for r in made["exact_dedup"][1].collect()} == {i for _, i in groups.values()}
    want = brute_components({i: t for i, t, _ in made["near_dedup"][0]}, 5, 80)
    assert {r["doc_id"] for r in made["near_dedup"][1].collect()} == {c for _, c in want.values()}
    mix = {r["doc_id"]: r["taken"] // max(r["size"], 1) for r in mixing.mix_sources(spark.createDataFrame(made["mixing"][0], "doc_id long, text string, source string")).collect()}
    assert collections.Counter(r["doc_id"] for r in made["mixing"][1].collect()) == {i: n for i, n in mix.items() if n}
    want = collections.Counter((i, tuple(lib.encode(t, add_special_tokens=False).ids)) for i, t, _ in made["bpe"][0])
    assert collections.Counter((r["doc_id"], tuple(r["ids"])) for r in made["bpe"][1].collect()) == want


def test_pipeline_runs_and_repeats(spark):
    first, again = ({(r["doc_id"], r["ids_sha256"]) for r in corpus_pipeline.run(spark, TINY).collect()} for _ in range(2))
    assert first and first == again


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_on_odd_rows(spark, odd, tmp_path, name, stage):
    spark.createDataFrame([(i, i % 2, 0) for i in range(1, 10)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = stage(spark, odd, str(tmp_path))
    assert out.count() > 0 and (name == "bpe" or out.columns == odd.columns)
    assert stage(spark, odd.limit(0), str(tmp_path)).count() == 0
