"""Ranges and digits of any size give what plain aggregates give."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import digits as Q
from riskloom.operators import drift as D
from riskloom.operators import metrics as M
from riskloom.operators import running as R


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    n = 6000
    value = np.round(rng.lognormal(3, 1.5, n), 2)
    value[: n // 3] = 12.5  # a third of all rows share one value
    score = np.round(rng.random(n), 3)
    y = (rng.random(n) < 0.1 + 0.3 * score).astype(int)
    data = [(float(a), float(b), int(c), int(d), i % 3) for i, (a, b, c, d) in
            enumerate(zip(value, score, y, rng.integers(0, 2, n)))]
    return spark.createDataFrame(data, "value double, score double, y int, is_current int, grp int").repartition(5).cache()


@pytest.mark.parametrize("band_rows,digit,gathered", [(10, 11, 1 << 18), (10, 16, 50), (500_000, 16, 1 << 18), (3000, 5, 1 << 18)])
def test_quantiles_equal_percentile(rows, band_rows, digit, gathered, monkeypatch):
    monkeypatch.setattr(Q, "BAND_ROWS", band_rows)
    monkeypatch.setattr(Q, "DIGIT", digit)
    monkeypatch.setattr(Q, "GATHERED", gathered)
    probs = [0.0, 0.05, 0.25, 0.5, 0.8, 0.95, 1.0]
    wide = rows.agg(*[F.percentile(c, probs).alias(c) for c in ("value", "score")]).first()
    got = {(r["feature"], r["q"]): r["value"] for r in Q.exact_quantiles(rows, ["value", "score"], probs).collect()}
    assert len(got) == 14
    for i, q in enumerate(probs):
        for c in ("value", "score"):
            assert got[c, q] == pytest.approx(wide[c][i], abs=1e-12)


def test_quantiles_of_extreme_values(spark, monkeypatch):
    monkeypatch.setattr(Q, "BAND_ROWS", 1)
    values = [-1e300, -5e-324, 0.0, 5e-324, 1.0, 1.0 + 2**-52, 1.7e9, 1.7e9 + 1, 1e308, 1e308]
    df = spark.createDataFrame([(v,) for v in values], "a double")
    got = {r["q"]: r["value"] for r in Q.exact_quantiles(df, ["a"], [i / 9 for i in range(10)]).collect()}
    assert [got[i / 9] for i in range(10)] == values


def test_quantiles_of_empty_and_single(spark):
    df = spark.createDataFrame([(None, 4.0)], "a double, b double")
    got = {r["feature"]: r["value"] for r in Q.exact_quantiles(df, ["a", "b"], [0.5]).collect()}
    assert got == {"a": None, "b": 4.0}


def test_cuts_are_bounded_and_sorted(rows):
    cuts = R.range_cuts(rows, ["value", "score"], rows_per_range=500)
    assert all(0 < len(c) <= 24 and c == sorted(set(c)) for c in cuts.values())


def test_auc_does_not_depend_on_ranges(rows):
    cuts = R.range_cuts(rows, ["score"], rows_per_range=400)["score"]
    for by in ([], ["grp"]):
        one = sorted(map(tuple, M.auc_roc(rows, "y", "score", by, cuts=[]).collect()))
        many = sorted(map(tuple, M.auc_roc(rows, "y", "score", by, cuts=cuts).collect()))
        assert np.allclose(one, many)
    ap = [M.avg_precision(rows, "y", "score", cuts=c).first()[0] for c in ([], cuts)]
    assert ap[0] == pytest.approx(ap[1])


def test_curves_do_not_depend_on_ranges(rows):
    cuts = R.range_cuts(rows, ["score"], rows_per_range=400)["score"]
    for curve in (M.roc_curve, M.pr_curve):
        a = sorted(map(tuple, curve(rows, "y", "score", cuts=[]).na.fill(-1.0).collect()))
        b = sorted(map(tuple, curve(rows, "y", "score", cuts=cuts).na.fill(-1.0).collect()))
        assert np.allclose(a, b)


@pytest.mark.parametrize("band_rows,digit", [(1, 4), (1, 16), (100, 11), (500_000, 16)])
def test_ks_against_numpy(rows, band_rows, digit, monkeypatch):
    monkeypatch.setattr(Q, "FINER_ROWS", band_rows)
    monkeypatch.setattr(Q, "DIGIT", digit)
    pdf = rows.toPandas()
    got = {r["feature"]: r for r in D.ks_between(rows, ["value", "score", "grp"]).collect()}
    assert len(got) == 3
    for c, r in got.items():
        a, b = (np.sort(pdf.loc[pdf.is_current == s, c].to_numpy()) for s in (0, 1))
        at = np.concatenate([a, b])
        want = np.abs(np.searchsorted(a, at, "right") / len(a) - np.searchsorted(b, at, "right") / len(b)).max()
        assert r["ks_statistic"] == pytest.approx(want, abs=1e-12)
        assert (r["n_ref"], r["n_cur"]) == (len(a), len(b)) and r["ref_mean"] == pytest.approx(a.mean()) and r["cur_mean"] == pytest.approx(b.mean())


def test_ks_counts_far_fewer_than_it_reads(spark, monkeypatch):
    """Counters that leave the tasks, over all passes, for distinct values on both sides."""
    monkeypatch.setattr(Q, "FINER_ROWS", 1000)
    n = 40_000
    df = spark.range(n).select(*[(F.rand(s) * 1000 + F.when(F.col("id") % 2 == 0, s * 40.0).otherwise(0.0)).alias(f"x{s}") for s in (1, 2, 3)], (F.col("id") % 2).cast("int").alias("f"))
    df = df.cache()
    passes = []
    real = Q.count_digits

    def counted(*args, **kwargs):
        out = real(*args, **kwargs).cache()
        passes.append(out)
        return out

    monkeypatch.setattr(Q, "count_digits", counted)
    got = {r["feature"]: r["ks_statistic"] for r in D.ks_between(df, ["x1", "x2", "x3"], "f").collect()}
    assert sum(p.count() for p in passes) < 3 * n / 10 and len(passes) > 1
    pdf = df.toPandas()
    for c, d in got.items():
        a, b = (np.sort(pdf.loc[pdf.f == s, c].to_numpy()) for s in (0, 1))
        at = np.concatenate([a, b])
        assert d == pytest.approx(np.abs(np.searchsorted(a, at, "right") / len(a) - np.searchsorted(b, at, "right") / len(b)).max(), abs=1e-12)


def test_keys_keep_the_order():
    x = np.array([-np.inf, -1e300, -1.5, -5e-324, -0.0, 0.0, 5e-324, 1.0, 1.0 + 2**-52, 1e308, np.inf])
    keys = Q.keys_of(x)
    assert (np.diff(keys.astype(object)) >= 0).all() and len(set(keys.tolist())) == 10
    assert [Q.value_of(int(k)) for k in keys] == x.tolist()


def test_auc_against_ranks(rows):
    pdf = rows.toPandas()
    ranks = pdf["score"].rank().to_numpy()
    pos = pdf["y"].to_numpy() == 1
    p, n = pos.sum(), (~pos).sum()
    want = (ranks[pos].sum() - p * (p + 1) / 2) / (p * n)
    assert M.auc_roc(rows, "y", "score").first()[0] == pytest.approx(want)


def test_one_class_has_no_auc_but_four_cells(spark):
    df = spark.createDataFrame([(0, 0.2), (0, 0.7)], "y int, s double")
    assert M.auc_roc(df, "y", "s").first()[0] is None
    assert tuple(M.confusion(df, "y", "s").first()) == (0, 1, 0, 1)
    assert M.prf(M.confusion(df, "y", "s")).first()["recall"] == 0.0


def test_threshold_is_inclusive_and_empty_input(spark):
    df = spark.createDataFrame([(1, 0.5)], "y int, s double")
    assert M.confusion(df, "y", "s").first()["tp"] == 1
    row = M.evaluate(df.limit(0), "y", "s").first()
    assert (row["tp"], row["recall"], row["auc_roc"]) == (0, 0.0, None)


def test_metamorphic_scale_and_order(rows):
    base = D.ks_between(rows, ["value"]).first()["ks_statistic"]
    scaled = rows.withColumn("value", F.col("value") * 3 + 1).repartition(2)
    assert D.ks_between(scaled, ["value"]).first()["ks_statistic"] == pytest.approx(base, abs=1e-12)


def test_golden_costs(spark):
    cells = spark.createDataFrame([(9, 112, 109, 3770)], "tp long, fp long, fn long, tn long")
    assert M.business_cost(cells).first()["business_cost"] == 1202.0
    cells = spark.createDataFrame([(7, 279, 111, 3603)], "tp long, fp long, fn long, tn long")
    assert M.business_value(cells).first()["net_value"] == -2080.0


def test_histogram_last_bin_is_closed(spark):
    df = spark.createDataFrame([(0, 0.0), (0, 1.0), (0, 0.99)], "y int, s double")
    assert sorted(map(tuple, M.score_histogram(df, "y", "s", 10).collect())) == [(0, 0, 1), (0, 9, 2)]


def test_cut_points_of_many_crowded_bins(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=4000) * 1e-9 + k for k in range(12)] + [np.full(3000, 7.5), [np.nan, -np.inf, np.inf]])
    df = spark.createDataFrame([(float(v), float(-v)) for v in x], "a double, b double").repartition(3)
    cuts = R.range_cuts(df, ["a", "b"], 500)
    known = x[~np.isnan(x)]
    for c, values in (("a", known), ("b", -known)):
        sizes = np.bincount(np.searchsorted(np.array(cuts[c]), values, side="right"))
        assert (sizes > 500).sum() <= 1 and sizes.max() <= 3000 + 500 and len(cuts[c]) < 4 * len(known) / 500
