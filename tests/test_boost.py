"""Boosted trees against brute force, and Shapley values of deep and of many trees."""

import itertools
import math
import tracemalloc
from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector

from riskloom.operators import attribution as A
from riskloom.operators import boost as B
from riskloom.operators import learn as L
from riskloom.operators import metrics as M

CFG = B.TreeConfig(rounds=3, depth=3, step=0.3, subsample=1.0, columns=1.0, min_rows=2, min_hessian=0.0, bins=200)


def table(n=400, width=4, seed=1, missing=0.1):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, width)), 1)
    y = (x[:, 0] * x[:, 1] + x[:, 2] + rng.normal(scale=0.5, size=n) > 0.6).astype(float)
    x[rng.random(x.shape) < missing] = np.nan
    return x, y, rng.choice([1.0, 2.5], n)


def frame(spark, x, y, w=None, held=None):
    w = np.ones(len(y)) if w is None else w
    held = np.zeros(len(y), bool) if held is None else held
    rows = [(list(map(float, a)), float(b), float(c), bool(d)) for a, b, c, d in zip(x, y, w, held)]
    df = spark.createDataFrame(rows, "x array<double>, y double, w double, held boolean").repartition(1)
    return df.withColumn("features", array_to_vector("x"))


@pytest.fixture(autouse=True)
def checkpoints(spark):
    L.ensure_checkpoint_dir(spark)


def brute_tree(x, g, h, cfg):
    """Best leaf first, one split at a time, every threshold tried. {path: value} of the leaves."""
    def best(rows):
        found = None
        score = lambda r: g[r].sum() ** 2 / max(h[r].sum() + cfg.l2, 1e-12)
        for f in range(x.shape[1]):
            known = rows[~np.isnan(x[rows, f])]
            lost = rows[np.isnan(x[rows, f])]
            for at in [*np.unique(x[known, f])[1:], math.inf]:
                for missing_left in (False, True):
                    left = known[x[known, f] < at]
                    right = known[x[known, f] >= at]
                    left, right = (np.concatenate([left, lost]), right) if missing_left else (left, np.concatenate([right, lost]))
                    if min(len(left), len(right)) < cfg.min_rows or min(h[left].sum(), h[right].sum()) < cfg.min_hessian:
                        continue
                    gain = score(left) + score(right) - score(rows)
                    if gain > B.LEAST_GAIN and (found is None or gain > found[0] + 1e-9):
                        found = gain, left, right
        return found

    leaves = [(np.arange(len(g)), 0)]
    while len(leaves) < (cfg.leaves or 1 << cfg.depth):
        options = [(b[0], i, b) for i, (rows, d) in enumerate(leaves) if d < cfg.depth and (b := best(rows))]
        if not options:
            break
        _, i, (_, left, right) = max(options, key=lambda o: o[0])
        rows, d = leaves.pop(i)
        leaves += [(left, d + 1), (right, d + 1)]
    margin = np.zeros(len(g))
    for rows, _ in leaves:
        margin[rows] = -cfg.step * g[rows].sum() / max(h[rows].sum() + cfg.l2, 1e-12)
    return margin, sorted(len(r) for r, _ in leaves)


@pytest.mark.parametrize("cfg", [CFG, replace(CFG, leaves=5, depth=6), replace(CFG, leaves=12, depth=8, l2=0.0, min_rows=5), replace(CFG, depth=1)])
def test_equals_a_brute_force_ensemble(spark, cfg):
    x, y, w = table()
    model = B.fit(frame(spark, x, y, w), "features", "y", cfg, "w")
    share = (w * y).sum() / w.sum()
    margin = np.full(len(y), math.log(share / (1 - share)))
    for t in model.unpacked():
        p = 1 / (1 + np.exp(-margin))
        step, sizes = brute_tree(x, w * (p - y), w * p * (1 - p), cfg)
        margin = margin + step
        assert sorted(t["cover"][t["feature"] < 0].tolist()) == sizes
    assert np.allclose(model.margins(x), margin, atol=1e-6)


def test_leaf_wise_differs_from_level_wise(spark):
    x, y, w = table(800)
    level = B.fit(frame(spark, x, y, w), "features", "y", replace(CFG, depth=6, rounds=2), "w")
    leaf = B.fit(frame(spark, x, y, w), "features", "y", replace(CFG, depth=6, rounds=2, leaves=10), "w")
    counts = [[int((t["feature"] < 0).sum()) for t in m.unpacked()] for m in (level, leaf)]
    assert counts[1] == [10, 10] and min(counts[0]) > 10


def test_many_partitions_give_the_same_model(spark, monkeypatch):
    x, y, w = table(900, seed=3)
    cfg = B.TreeConfig(rounds=30, depth=4, step=0.2, min_hessian=1.0, patience=5, leaves=9)
    held = np.arange(900) >= 700
    df = frame(spark, x, y, w, held)
    one = B.fit(df, "features", "y", cfg, "w", "held")
    monkeypatch.setattr(B, "PARTITION_ROWS", 250)
    monkeypatch.setattr(B, "BLOCK_ROWS", 100)
    monkeypatch.setattr(B, "_blocks", lambda rows, cuts, own=B._blocks: own(rows.repartition(4, "row"), cuts))
    monkeypatch.setattr(B, "_in_one_task", None)
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 27))
    try:
        many = B.fit(df, "features", "y", cfg, "w", "held")
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert one.getOrDefault("trees") == many.getOrDefault("trees") and one.getOrDefault("precisions") == many.getOrDefault("precisions")


def test_patience_keeps_the_best_prefix(spark, monkeypatch):
    monkeypatch.setattr(B, "CHUNK", 4)
    x, y, w = table(600, seed=4)
    held = np.arange(600) % 3 == 0
    df = frame(spark, x, y, w, held)
    cfg = replace(CFG, rounds=200, step=0.5, patience=6, depth=4)
    model = B.fit(df, "features", "y", cfg, "w", "held")
    run, kept, scores = model.getOrDefault("roundsRun"), model.getNumTrees, model.getOrDefault("precisions")
    assert len(scores) == run < 200 and run - kept >= 6 and scores[kept - 1] == max(scores) and scores.index(max(scores)) == kept - 1
    margins = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y[held], model.margins(x[held]))], "y int, s double")
    assert M.avg_precision(margins, "y", "s").first()["avg_precision"] == pytest.approx(max(scores), abs=1e-12)


def test_rows_held_out_are_not_learned(spark):
    x, y, w = table(300)
    held = np.arange(300) < 100
    a = B.fit(frame(spark, x, y, w, held), "features", "y", replace(CFG, rounds=2), "w", "held")
    y2 = np.where(held, 1 - y, y)
    b = B.fit(frame(spark, x, y2, w, held), "features", "y", replace(CFG, rounds=2), "w", "held")
    assert [t["value"].tolist() for t in a.unpacked()][:1] == [t["value"].tolist() for t in b.unpacked()][:1]


def test_odd_tables(spark):
    x, y, _ = table(50)
    none = B.fit(frame(spark, x, y).where("false"), "features", "y", CFG)
    one = B.fit(frame(spark, x, np.ones(50)), "features", "y", CFG)
    constant = B.fit(frame(spark, np.ones((50, 4)), y), "features", "y", CFG)
    lost = B.fit(frame(spark, np.full((50, 4), np.nan), y), "features", "y", CFG)
    assert none.getNumTrees == one.getNumTrees == 0
    assert all((t["feature"] < 0).all() for m in (constant, lost) for t in m.unpacked())
    share = [r["probability"][1] for r in constant.transform(frame(spark, x, y)).collect()]
    assert np.allclose(share, y.mean(), atol=0.05) and len(share) == 50


def test_saved_and_loaded(spark, tmp_path):
    x, y, w = table(200)
    df = frame(spark, x, y, w)
    model = PipelineModel(stages=[B.fit(df, "features", "y", CFG, "w")])
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    rows = lambda m: [(r["prediction"], list(r["probability"])) for r in m.transform(df).collect()]
    assert rows(model) == rows(again)
    p = 1 / (1 + np.exp(-model.stages[0].margins(x)))
    assert np.allclose(sorted(r[1][1] for r in rows(model)), sorted(p))


def random_tree(rng, depth, width, full):
    t = B.Tree()

    def build(d, cover, lows):
        node = t.add(cover)
        if d == depth or cover < 2 or (not full and rng.random() < 0.2):
            t.value[node] = float(rng.normal())
            return node
        f = int(rng.integers(width))
        t.feature[node], t.bin[node], t.missing_left[node] = f, 0, bool(rng.integers(2))
        part = int(rng.integers(1, cover))
        thresholds[node] = float(rng.normal())
        t.left[node] = build(d + 1, part, lows)
        t.right[node] = build(d + 1, cover - part, lows)
        return node

    thresholds: dict[int, float] = {}
    build(0, 1 << (depth + 4), None)
    own = {k: np.array(v) for k, v in vars(t).items() if k != "bin"}
    own["threshold"] = np.array([thresholds.get(i, 0.0) for i in range(len(t.feature))])
    return own


def enumerated(trees, x):
    """Shapley values from all subsets; a split on an unknown feature weighs its sides by cover."""
    width = len(x)

    def value(t, known, node=0):
        if t["feature"][node] < 0:
            return t["value"][node]
        f, left, right = t["feature"][node], t["left"][node], t["right"][node]
        if f in known:
            goes_left = t["missing_left"][node] if math.isnan(x[f]) else x[f] <= t["threshold"][node]
            return value(t, known, left if goes_left else right)
        return sum(t["cover"][c] / t["cover"][node] * value(t, known, c) for c in (left, right))

    worth = {s: sum(value(t, s) for t in trees) for k in range(width + 1) for s in map(frozenset, itertools.combinations(range(width), k))}
    phi = []
    for j in range(width):
        rest = [i for i in range(width) if i != j]
        phi.append(sum(math.factorial(k) * math.factorial(width - k - 1) / math.factorial(width) * (worth[frozenset({*s, j})] - worth[frozenset(s)])
                       for k in range(width) for s in itertools.combinations(rest, k)))
    return phi, worth[frozenset()]


@pytest.mark.parametrize("n, depth, width", [(500, 6, 4), (1, 12, 5), (30, 4, 6)])
def test_shapley_values_equal_enumeration(n, depth, width, monkeypatch):
    rng = np.random.default_rng(depth)
    trees = [random_tree(rng, depth, width, depth < 12) for _ in range(n)]
    x = rng.normal(size=(3, width))
    x[0, 1] = np.nan
    groups, base = A.leaves_by_length(trees)
    monkeypatch.setattr(A, "CELLS", 1 << 12)
    phi = A.explain_rows(groups, x, width)
    for row, own in zip(x, phi):
        want, empty = enumerated(trees, row)
        assert np.allclose(own, want, atol=1e-8) and base == pytest.approx(empty)


def test_half_a_million_rows_need_no_job_for_each_level(spark):
    df = spark.range(520_000, numPartitions=4).selectExpr("array(id % 97, id % 31) as x", "cast(id % 97 > 60 and id % 31 > 9 as double) as y")
    df = df.withColumn("features", array_to_vector("x"))
    spark.sparkContext.setJobGroup("levels", "levels")
    try:
        model = B.fit(df, "features", "y", replace(CFG, rounds=8))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("levels"))
    assert model.getNumTrees == 8 and jobs < 8 * CFG.depth


@pytest.mark.parametrize("leaves, subsample", [(0, 0.7), (9, 1.0)])
def test_rows_kept_by_leaf_give_the_margins_of_the_tree(leaves, subsample, monkeypatch):
    monkeypatch.setattr(B, "COUNTED", 0.01)
    rng, sizes = np.random.default_rng(leaves), (12, 40, 5, 3)
    bins = np.stack([rng.integers(0, s, 3000) for s in sizes], axis=1).astype(np.uint8)
    y, held = (bins[:, 1] * bins[:, 0] > 150).astype(float), rng.random(3000) < 0.2
    blocks = [(np.arange(lo, lo + 1000), bins[lo:lo + 1000], y[lo:lo + 1000], np.ones(1000), held[lo:lo + 1000], np.zeros(1000), ()) for lo in (0, 1000, 2000)]
    cfg = replace(CFG, leaves=leaves, subsample=subsample, depth=5)
    whole, apart = B._shards(blocks, sizes, 2.0**30), [s for b in blocks for s in B._shards([b], sizes, 2.0**30)]
    for number in range(4):
        r, made = B._Round.of(cfg, number, 2.0**30, sizes), []
        for shards in (whole, apart):
            for s in shards:
                s.begin(r)
            grown = []
            tree = r.tree(lambda arrays, nodes: sum(s.histograms(r, arrays, nodes) for s in shards), grown)
            before = [s.margin.copy() for s in shards]
            for s in shards:
                s.end(tree, *grown)
            own = np.concatenate([s.margin - b for s, b in zip(shards, before)])
            assert np.allclose(own, np.array(tree.value)[B.descend(bins, tree.arrays())], atol=1e-12)
            made.append(vars(tree))
        assert made[0] == made[1] and len(made[0]["value"]) > 5


def test_precision_over_several_ranges(spark, monkeypatch):
    x, y, w = table(900, seed=5)
    held = np.arange(900) % 2 == 0
    df, cfg = frame(spark, x, y, w, held), replace(CFG, rounds=6)
    one = B.fit(df, "features", "y", cfg, "w", "held")
    monkeypatch.setattr(B, "RANKED_ROWS", 40)
    monkeypatch.setattr(B, "BLOCK_ROWS", 100)
    many = B.fit(df, "features", "y", cfg, "w", "held")
    assert one.getOrDefault("precisions") == many.getOrDefault("precisions") and len(set(one.getOrDefault("precisions"))) > 1


def test_shapley_values_take_little_memory():
    rng = np.random.default_rng(7)
    groups, _ = A.leaves_by_length([random_tree(rng, 6, 6, True) for _ in range(40)])
    tracemalloc.start()
    phi = A.explain_rows(groups, rng.normal(size=(2000, 6)), 6)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert phi.shape == (2000, 6) and peak < 30e6


def test_a_tree_takes_as_many_passes_as_it_has_levels(spark):
    x, y, w = table(2000, seed=8)
    bins = B.bin_numbers(x, [np.linspace(-2, 2, 40)] * 4)
    block = np.arange(2000), np.asfortranarray(bins), y, w, np.zeros(2000, bool), np.zeros(2000), ()
    r, asked = B._Round.of(replace(CFG, depth=6), 0, 2.0**28, (42,) * 4), []
    own = B._Drawn.of(block, r)

    def count(arrays, nodes):
        asked.append(len(nodes))
        total = np.zeros((len(nodes), len(r.columns), r.n_bins, 3), np.int64)
        own.add_to(total, r, arrays, nodes)
        return total

    tree = r.tree(count)
    shard = B._shards([block], r.sizes, r.unit)[0]
    shard.begin(r)
    assert tree.leaves() > 40 and len(asked) == 6
    assert vars(tree) == vars(r.tree(lambda arrays, nodes: shard.histograms(r, arrays, nodes)))
    assert np.allclose(B.after(block, tree.arrays(), np.array(tree.value))[5], np.array(tree.value)[B.descend(bins, tree.arrays())])
