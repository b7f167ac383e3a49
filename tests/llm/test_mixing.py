"""Targets and quotas against the rules as they are told; documents of the mix against their word counts."""

import heapq
import random
from collections import Counter, defaultdict

import pytest

from riskloom.llm import mixing


def slow_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    full, target, total = set(), {}, 1.5 * sum(sizes.values())
    while True:
        open_ = [s for s in order if s not in full]
        rest, all_weight = total - sum(2 * sizes[s] for s in full), sum(weight[s] for s in open_)
        target = {s: 2.0 * sizes[s] if s in full else weight[s] * rest / all_weight for s in order}
        above = {s for s in open_ if target[s] > 2 * sizes[s]}
        if not above:
            return target
        full |= above


def highest(votes, seats, most):
    heap = [(-v, k) for k, v in votes.items() if v > 0 and most[k] > 0]
    heapq.heapify(heap)
    won = Counter({k: 0 for k in votes})
    while heap and seats > 0:
        _, k = heapq.heappop(heap)
        won[k] += 1
        seats -= 1
        if won[k] < most[k]:
            heapq.heappush(heap, (-votes[k] / (2 * won[k] + 1), k))
    return dict(won)


@pytest.mark.parametrize("seed", range(4))
def test_highest_quotients(spark, seed):
    rng = random.Random(seed)
    rows = []
    for g in range(5):
        for u in range(rng.randrange(1, 30)):
            v = rng.choice([0, 1, rng.randrange(1, 10), rng.randrange(1, 10**4)])
            rows.append((g, u, v, 2 * -(-v // 7)))
    seats = {g: round(sum(v for h, _, v, _ in rows if h == g) * rng.uniform(0, 0.2)) for g in range(5)}
    df = spark.createDataFrame([(*r, seats[r[0]]) for r in rows], "g long, u long, votes long, most long, seats long")
    got = {(r["g"], r["u"]): r["quota"] for r in mixing.apportion(df, ["g"], "u", "seats", "votes", "most").collect()}
    for g in range(5):
        want = highest({u: v for h, u, v, _ in rows if h == g}, seats[g], {u: m for h, u, _, m in rows if h == g})
        assert {u: got[g, u] for u in want} == want


def test_targets_and_takes(spark):
    rng = random.Random(5)
    rows = [(i, " ".join("w" for _ in range(rng.randrange(0, 90))), rng.choice(["a", "a", "a", "a", "b", "c", "d", None])) for i in range(900)]
    rows += [(900, " ".join("w" * 5000), "e"), (901, "one", "f"), (902, "", "g")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df, shard=2000).collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(t.split())
    targets, taken = slow_targets(sizes), Counter()
    for r in got:
        source = rows[r["doc_id"]][2]
        taken[source] += r["taken"]
        assert r["size"] == len(rows[r["doc_id"]][1].split()) and r["source_size"] == sizes[source]
        assert r["target"] == pytest.approx(targets[source], abs=1e-5)
        assert 0 <= r["taken"] <= 2 * r["size"]
    shards = {s: max(1, -(-n // 2000)) for s, n in sizes.items()}
    assert all(abs(taken[s] - targets[s]) <= (shards[s] + 2) * mixing.BLOCK for s in sizes)
    again = {r["doc_id"]: r["taken"] for r in mixing.mix(df.repartition(7), shard=2000).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in got}
    words = defaultdict(int)
    for r in mixing.mixed_documents(df, shard=2000).collect():
        words[r["doc_id"]] += len(r["text"].split())
    assert words == {k: v for k, v in again.items() if v}


def test_odd_documents(spark, odd, none):
    rows = mixing.mix(odd).collect()
    assert len(rows) == odd.count() and all(r["taken"] == 0 for r in rows if r["doc_id"] in (1, 2, 3, 6))
    out = mixing.mixed_documents(odd)
    assert out.columns == odd.columns and out.schema.simpleString() == odd.schema.simpleString()
    assert sum(len(r["text"].split()) for r in out.collect()) == sum(r["taken"] for r in rows)
    assert mixing.mix(none).count() == 0 and mixing.mixed_documents(none).count() == 0
