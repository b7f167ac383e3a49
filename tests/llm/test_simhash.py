"""Fingerprints, vantage-point trees and groups against all pairs."""

import random

import numpy as np
import pytest
import xxhash

from riskloom.llm import graph, simhash, vptree


def groups(items, near):
    parent = {i: i for i in items}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in items:
        for b in items:
            if a < b and near(a, b):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in items}


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200), (300, 5)]
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for e in edges for x in e}
    want = {n: 0 if n < 41 or n == 300 else 100 if n < 160 else 200 for n in nodes}
    assert got == {n: r for n, r in want.items() if n != r}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("goal,most", [(400, 16_384), (8, 16_384), (30, 25)])
def test_links_connect_all_pairs(spark, monkeypatch, goal, most):
    monkeypatch.setattr(vptree, "LEAF_GOAL", goal)
    monkeypatch.setattr(vptree, "LEAF_MOST", most)
    rng = random.Random(3)
    centres = [rng.getrandbits(64) for _ in range(40)]
    fps = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(7))) for c in centres for _ in range(12)}
    signed = {int(np.uint64(f).view(np.int64)): f for f in fps}
    items = spark.createDataFrame([(s, s) for s in signed], "id long, fp long")
    links = vptree.near_links(items, 4, 3, 1, len(signed)).collect()
    assert all((signed[r["a"]] ^ signed[r["b"]]).bit_count() == r["distance"] <= 4 for r in links)
    want = groups(sorted(signed), lambda a, b: (signed[a] ^ signed[b]).bit_count() <= 4)
    linked = {(min(r["a"], r["b"]), max(r["a"], r["b"])) for r in links}
    assert groups(sorted(signed), lambda a, b: (a, b) in linked) == want


def test_spanning_forest_takes_the_nearest():
    i, j, d = np.array([0, 0, 1, 2, 4]), np.array([1, 2, 2, 3, 5]), np.array([2, 1, 1, 3, 0])
    assert sorted(vptree.spanning_forest(6, i, j, d).tolist()) == [1, 2, 3, 4]


def test_odd_documents(spark, odd, none):
    rows = simhash.simhash_groups(odd).collect()
    texts = {(r["doc_id"], r["text"]) for r in odd.collect()}
    assert len(rows) == odd.count()
    got = {}
    for r in rows:
        got.setdefault(r["doc_id"], set()).add((int(r["fingerprint"], 16), r["component_id"]))
    for key, text in texts:
        assert slow_fingerprint(text) in {f for f, _ in got[key]}
    assert got[1] == got[2] == got[3] == got[6] == {(0, 1)}
    assert {c for _, c in got[8]} == {c for _, c in got[9]} == {8}
    assert simhash.simhash_groups(none).count() == 0
    gone = {tuple(r) for r in simhash.near_duplicates(odd).collect()}
    assert gone == {(1, 2), (1, 3), (1, 6), (8, 9)}
    assert simhash.near_duplicates(none).count() == 0


def test_near_duplicates_like_all_pairs(spark):
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(4000)]
    rows, key = [], 0
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([8, 40, 150, 400]))]
        for share in (0, 0, 0.004, 0.01, 0.02, 0.05, 0.2):
            rows.append((key, " ".join(rng.choice(vocabulary) if rng.random() < share else w for w in base)))
            key += 1
    shingles = {k: {tuple(t.split()[i:i + 5]) for i in range(max(1, len(t.split()) - 4))} for k, t in rows}
    near = lambda a, b: len(shingles[a] & shingles[b]) >= 0.8 * len(shingles[a] | shingles[b])
    want = groups(range(key), near)
    got = {r["doc_id"]: r["group_id"] for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {k: r for k, r in want.items() if k != r}


def shingles_of(text):
    return {tuple(text.split()[i:i + 5]) for i in range(max(1, len(text.split()) - 4))}


def five_near(rows):
    own = {k: shingles_of(t) for k, t in rows}
    return groups(sorted(own), lambda a, b: len(own[a] & own[b]) >= 0.8 * len(own[a] | own[b]))


def test_variants_of_an_original_that_are_not_near_to_one_another(spark, monkeypatch):
    rng = random.Random(5)
    rows, key = [], 0
    for _ in range(6):
        base = [f"w{rng.randrange(5000)}" for _ in range(300)]
        rows.append((key, " ".join(base)))
        key += 1
        for _ in range(30):
            copy = list(base)
            for at in rng.sample(range(5, 295), 6):
                copy[at] = f"w{rng.randrange(5000)}"
            rows.append((key, " ".join(copy)))
            key += 1
    want = {k: r for k, r in five_near(rows).items() if k != r}
    assert len(want) > 150
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["group_id"] for r in simhash.near_duplicates(df).collect()} == want
    # Several passes give the same.
    monkeypatch.setattr(simhash, "OPEN_FIRST", 1)
    monkeypatch.setattr(simhash, "OPEN_GROWTH", 3)
    assert {r["doc_id"]: r["group_id"] for r in simhash.near_duplicates(df).collect()} == want


def test_pairs_that_differ_in_one_stretch(spark):
    rng = random.Random(21)
    text = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    rows = []
    for k in range(0, 800, 2):
        base = text(400)
        at = rng.randrange(20, 330)
        changed = base + text(97) if k % 4 else base[:at] + text(38) + base[at + 38:]
        assert 0.8 <= len(shingles_of(" ".join(base)) & shingles_of(" ".join(changed))) / len(shingles_of(" ".join(base)) | shingles_of(" ".join(changed))) < 0.82
        rows += [(k, " ".join(base)), (k + 1, " ".join(changed))]
    got = {r["doc_id"]: r["group_id"] for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    print("found", len(got))
    assert set(got.items()) <= {(k + 1, k) for k in range(0, 800, 2)} and len(got) >= 398
