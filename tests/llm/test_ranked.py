import random

import numpy as np
import pytest

from riskloom.llm import ranked


def brute(docs, items, k):
    """Everything scored, one document after the other."""
    split = [(key, ranked.terms_of(text)) for key, text in docs]
    n_docs, total = sum(bool(w) for _, w in split), sum(len(w) for _, w in split)
    out = {}
    for item, text in items:
        terms, scored = set(ranked.terms_of(text)), []
        for at, (key, words) in enumerate(split):
            score = 0
            for t in terms & set(words):
                m, tf = 10 + (90 * len(words) * n_docs) // total, words.count(t)
                score += ranked.weight(n_docs, sum(t in w for _, w in split)) * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, key is None, key, at))
        out[item] = [(r + 1, key, -score) for r, (score, _, key, _) in enumerate(sorted(scored)[:k])]
    return out


def found(spark, docs, items, k=10):
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    out = {item: [] for item, _ in items}
    for r in ranked.search(*frames, k=k).orderBy("item_id", "rank").collect():
        out[r.item_id].append((r["rank"], r.doc_id, r.score))
    return out


def corpus(n, seed, words=60):
    rng = random.Random(seed)
    # Some words are in most documents, most in a few.
    pool = [f"w{i}" for i in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    return [(i, " ".join(rng.choices(pool, weights, k=rng.choice([1, 5, 20, 80])))) for i in range(n)]


def test_terms():
    assert ranked.terms_of("Ab-cD_9 Été x") == ["ab".encode(), b"cd", b"9", "Été x".encode()]
    assert ranked.terms_of(None) == ranked.terms_of(" .!") == []


@pytest.mark.parametrize("shard, stretch", [(1 << 14, 64), (50, 4), (7, 2)])
def test_equals_scoring_everything(spark, monkeypatch, shard, stretch):
    monkeypatch.setattr(ranked, "SHARD_DOCS", shard)
    monkeypatch.setattr(ranked, "STRETCH", stretch)
    docs = corpus(300, 1) + [(900, None), (901, "..."), (902, "w0 w1 w2")]
    items = [(i, t) for i, t in corpus(12, 2)] + [(50, "w0"), (51, "nowhere"), (52, None)]
    assert found(spark, docs, items) == brute(docs, items, 10)


def test_ties_copies_nulls_and_repeated_ids(spark):
    docs = [(5, "a b"), (3, "a b"), (None, "a b"), (3, "a b"), (9, "c"), (8, "a b"), (7, "")] + [(100 + i, "z") for i in range(9)]
    items = [(1, "a"), (2, "a b a"), (3, "q")]
    got = found(spark, docs, items, k=4)
    assert got == brute(docs, items, 4)
    assert [key for _, key, _ in got[1]] == [3, 3, 5, 8]
    # An item with two rows has the terms of both.
    both = spark.createDataFrame([(1, "a"), (1, "c")], "item_id long, text string")
    rows = ranked.search(spark.createDataFrame(docs, "doc_id long, text string"), both).collect()
    assert {r.doc_id for r in rows} == {3, 5, 8, 9, None}


def test_blocks_of_queries_change_nothing(spark, monkeypatch):
    docs, items = corpus(80, 3), corpus(20, 4)
    want = found(spark, docs, items)
    monkeypatch.setattr(ranked, "BLOCK_CHARS", 300)
    assert found(spark, docs, items) == want


def test_skips_without_losing_ties():
    """Partial sums, bounds and the score of the last of the best, on lists made by hand."""
    rng = np.random.default_rng(5)
    for _ in range(200):
        n = int(rng.integers(1, 400))
        lists = [np.flatnonzero(rng.random(n) < p) for p in rng.choice([0.01, 0.05, 0.3, 0.9], 5)]
        worth = [rng.integers(1, 6, len(x)) for x in lists]
        starts = np.cumsum([0, *map(len, lists)])
        own = ranked.Lists(n, np.arange(5), starts, np.concatenate(lists), np.concatenate(worth))
        weights = rng.integers(1, 4, 5).tolist()
        total = np.zeros(n, np.int64)
        for x, s, w in zip(lists, worth, weights):
            total[x] += w * s
        k = int(rng.integers(1, 12))
        got = sorted(ranked.best_of(own, list(range(5)), weights, k, 1), key=lambda f: (-f[0], f[1]))
        want = sorted(((int(v), i) for i, v in enumerate(total) if v > 0), key=lambda f: (-f[0], f[1]))
        assert got[:k] == want[:k]
        floor = want[min(k, len(want)) - 1][0] if want else 1
        assert {f for f in got if f[0] >= floor} == {f for f in want if f[0] >= floor}


def test_odd_input(spark, odd, none):
    items = spark.createDataFrame([(1, "a one"), (2, None)], "item_id long, text string").selectExpr("*", "'x' as score", "1 as rank", "2 as doc")
    got = ranked.search(odd.withColumnRenamed("lang", "rank"), items).collect()
    assert {r.doc_id for r in got} == {4, 8, 9} and {r.item_id for r in got} == {1}
    assert ranked.search(none, items).collect() == []
    assert ranked.search(odd, items.filter("false")).collect() == []
