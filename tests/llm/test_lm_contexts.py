"""Contexts of the language model that cross words: counted over all training texts, whatever the runs and pieces."""

import collections
import math
import zlib

import numpy as np
import pytest

from riskloom.llm import context_mixing as cm

TRAIN = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 != 1]
HELD = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 1]


def words_of(rng, n):
    return " ".join("".join(rng.choice(list("abcdefghij"), 3)) for _ in range(n))


def rows_of(spark, texts):
    return spark.createDataFrame(texts, "doc_id long, text string").repartition(3)


def test_word_order_counts(spark):
    """A text with its words in another order has another score, and a text that occurs twice is told from one that occurs once."""
    rng = np.random.default_rng(3)
    texts = [words_of(rng, 60) for _ in range(60)]
    shuffled = " ".join(rng.permutation(texts[0].split()))
    ids = iter(TRAIN)
    twice, once = [(next(ids), t) for t in texts[:20] for _ in range(2)], [(next(ids), t) for t in texts[20:]]
    rows = [*twice, *once, (HELD[0], texts[0]), (HELD[1], shuffled), (HELD[2], words_of(rng, 60))]
    got = {r["doc_id"]: r["score"] / r["n_tokens"] for r in cm.score_texts(rows_of(spark, rows)).collect()}
    assert min(got[i] for i, _ in twice) > max(got[i] for i, _ in once) + 0.1
    assert got[HELD[0]] == pytest.approx(got[twice[0][0]]) and got[HELD[0]] > got[HELD[1]] + 0.5
    assert abs(got[HELD[1]] - got[HELD[2]]) < 1


def test_scores_do_not_depend_on_runs_and_pieces(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, (words_of(rng, 30) + " a b c") if i % 7 else None) for i in range(120)]
    score = lambda n: {r["doc_id"]: r["score"] for r in cm.score_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(n)).collect()}
    want = score(1)
    monkeypatch.setattr(cm, "RUN_WORDS", 40)  # a run closes after every text or two
    assert score(4) == pytest.approx(want, rel=1e-6)


def test_what_follows_two_words_is_counted_whole_and_is_proper():
    rng = np.random.default_rng(5)
    vocabulary = [b"w%d" % i for i in range(6)]
    hashes = cm.word_hashes(vocabulary)
    runs = [[rng.integers(0, 6, rng.integers(0, 9)).astype(np.int64) for _ in range(40)] for _ in range(3)]
    keys, counts = zip(*[cm.triple_keys(hashes, docs) for docs in runs]), collections.Counter()
    keys = list(keys)[0]
    for docs in runs:
        for d in docs:
            tokens = ["before", "start", *d.tolist(), "end"]
            counts.update(zip(tokens, tokens[1:], tokens[2:]))
    sent = [np.unique(k, return_counts=True) for k in keys]
    for packed, _ in sent:
        assert np.array_equal(cm.expand_keys(cm.squeeze_keys(packed)), packed)
    codes, share, rest = cm.discounted(np.concatenate([k for k, _ in sent]), np.concatenate([n for _, n in sent]))
    found = dict(zip(np.concatenate([k for k, _ in sent]).tolist(), codes))
    once, twice = (sum(c == k for c in counts.values()) for k in (1, 2))
    discount = (once + 1) / (once + 2 * twice + 1)
    pairs = collections.defaultdict(dict)
    for (a, b, w), c in counts.items():
        pairs[a, b][w] = c
    for docs, own in zip(runs, keys):
        at = iter(own.tolist())
        for d in docs:
            tokens = ["before", "start", *d.tolist(), "end"]
            for a, b, w in zip(tokens, tokens[1:], tokens[2:]):
                code, follow = found[next(at)], pairs[a, b]
                n = sum(follow.values())
                assert math.isclose(share[code], max(follow[w] - discount, 0) / n) and math.isclose(rest[code], discount * len(follow) / n)
    for follow in pairs.values():
        n = sum(follow.values())
        assert math.isclose(sum(max(c - discount, 0) / n for c in follow.values()) + discount * len(follow) / n, 1)
    unseen = cm.discounted(np.array([5, 9], dtype=np.uint64), np.zeros(2))
    assert unseen[1][unseen[0]].tolist() == [0, 0] and unseen[2][unseen[0]].tolist() == [1, 1]
    assert np.array_equal(cm.unpack_hashes(cm.pack_hashes(hashes)), hashes)
