"""Nearest neighbours and I-Match fingerprints against brute force."""

import hashlib
import math
import os
import random

import numpy as np
import pytest

from riskloom.llm import imatch, neighbours
from riskloom.llm.queries import ORACLES, QUERIES
from tools import check

SF = "/root/testdata/sf0.001"


def brute(rows, k=5):
    ok = {i: np.array(v, float) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = {}
    for q in ok:
        if q % 50 == 0:
            near = [(-(ok[q] * ok[i]).sum() / (np.sqrt((ok[q] ** 2).sum()) * np.sqrt((ok[i] ** 2).sum())), i) for i in ok if i != q and len(ok[i]) == len(ok[q])]
            out[q] = [(r + 1, i, -s) for r, (s, i) in enumerate(sorted(near)[:k])]
    return out


@pytest.mark.parametrize("tile", [(4096, 16384), (7, 40)])
def test_neighbours_like_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(neighbours, "QUERY_ROWS", tile[0])
    monkeypatch.setattr(neighbours, "BASE_ROWS", tile[1])
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(700)]
    rows += [(i, rows[50][1]) for i in range(700, 900)]  # copies of a query: ties
    rows += [(1000, None), (1050, []), (1100, [0.0] * 8), (1150, [1.0, None] * 4), (1200, [float("nan")] * 8), (1250, [float("inf")] * 8)]
    rows += [(1300, [1.0, 2.0]), (1301, [2.0, 1.0]), (None, rows[0][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'x' as score", "'x' as id", "'x' as rank")
    got = {}
    for r in neighbours.nearest(df, lambda i: i % 50 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = brute(rows)
    assert set(got) == set(want)
    for q in want:
        own = sorted(got[q])
        assert [x[:2] for x in own] == [x[:2] for x in want[q]]
        assert [x[2] for x in own] == pytest.approx([x[2] for x in want[q]], abs=1e-14)
    assert neighbours.nearest(df.limit(0), lambda i: i % 50 == 0).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(5)
    a, b = neighbours.Quantised(rng.normal(size=(50, 16))), neighbours.Quantised(rng.normal(size=(70, 16)) * 100)
    near, off = a.bounds(b, slice(0, 50), slice(0, 70))
    true = (a.raw / a.norm[:, None]) @ (b.raw / b.norm[:, None]).T
    assert (np.abs(true - near) <= off).all() and off.max() < 0.05


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", ["op3_imatch", "op4_mix"])
def test_against_sql(spark, name):
    assert check.compare(QUERIES[name](spark, SF), check.views(SF), ORACLES[name])


def test_next_over_partitions(spark):
    keys = [(i, h) for i in (None, 3, 3, 7, 1, 90, 15, 22) for h in (1, 2)]
    keys = sorted({(imatch.NULL_ID if i is None else i, h) for i, h in keys})
    got = {(r["id"], r["hash"]): (r["next_id"], r["next_hash"]) for r in imatch.with_next(spark.createDataFrame(keys, "id long, hash long")).collect()}
    assert got == dict(zip(keys, keys[1:] + keys[:1]))


def test_imatch_odd_documents(spark, odd, none):
    docs = odd.filter("doc_id is null or doc_id <> 4").unionByName(odd.filter("doc_id = 4"))
    rows = imatch.fingerprint_and_edit(docs).collect()
    assert len(rows) == docs.count() and imatch.fingerprint_and_edit(none).count() == 0
    texts = sorted({(r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or "") for r in docs.collect()})
    edited = {}
    for at, (known, key, text) in enumerate(texts):
        after, n = texts[(at + 1) % len(texts)][2], len(text)
        edited[key if known else None] = (n, hashlib.sha256((text[:n - n // 2] + after[:n // 2]).encode()).hexdigest())
    for r in rows:
        assert (r["n_chars"], r["edited_sha256"]) == edited[r["doc_id"]]
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert len({r["fingerprint"] for r in rows if r["doc_id"] in (1, 2, 6)}) == 1
    alone = imatch.fingerprint_and_edit(docs.filter("doc_id = 10")).first()
    assert alone["near_next"] == 1.0


def test_likeness_follows_the_share_of_terms(spark):
    rng = random.Random(9)
    words = [f"t{i}" for i in range(3000)]
    rows, key = [], 0
    for _ in range(150):
        base = rng.sample(words, 80)
        for changed in (0, 8, 40):
            rows.append((key, " ".join(base[changed:] + rng.sample(words, changed))))
            key += 1
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in imatch.fingerprint_and_edit(df).collect()}
    mean = lambda off: np.mean([got[k + off]["near_next"] for k in range(0, key, 3)])
    assert mean(0) > 0.3 > mean(1) > 0.1 > mean(2)
