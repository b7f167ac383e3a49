"""P-values, reports and performance over time."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.functions import ks
from riskloom.operators import drift as D
from riskloom.operators import running


@pytest.mark.parametrize("d, p", [(0.096, 0.019894), (0.06, 0.329358), (0.044, 0.718919)])
def test_published_p_values(spark, d, p):
    df = spark.createDataFrame([(d, 500, 500)], "d double, n long, m long")
    row = df.select(
        ks.ks_pvalue(F.col("d"), F.col("n"), F.col("m"), "exact").alias("auto"), ks.equal_sizes(F.col("d"), F.col("n")).alias("closed"),
        ks.asymptotic(F.col("d"), F.col("n"), F.col("m")).alias("series"),
    ).first()
    assert round(row["auto"], 6) == p and round(row["closed"], 6) == p
    assert row["series"] == pytest.approx(p, rel=0.01)


@pytest.mark.parametrize("n, m", [(3, 5), (4, 4), (2, 7)])
def test_exact_p_value_by_enumeration(n, m):
    def distance(chosen):
        a = np.isin(np.arange(n + m), chosen)
        return np.abs(np.cumsum(a) / n - np.cumsum(~a) / m).max()

    all_d = np.array([distance(c) for c in itertools.combinations(range(n + m), n)])
    for d in np.unique(np.round(all_d, 9)):
        assert ks._band_probability(float(d), n, m) == pytest.approx((all_d >= d - 1e-9).mean())


def test_identical_samples_do_not_drift(spark):
    df = spark.range(300).select((F.col("id") % 17).cast("double").alias("x"))
    row = D.drift_report(df, df, ["x"]).first()
    assert (row["n_features_checked"], row["n_drifted_features"], row["max_ks_statistic"]) == (1, 0, 0.0)
    assert D.recommendation(D.drift_report(df, df, ["x"])).first()["recommendation"] == "none"


def test_shifted_sample_drifts(spark):
    df = spark.range(300).select((F.col("id") % 100).cast("double").alias("x"), F.col("id").cast("double").alias("same"))
    moved = df.withColumn("x", F.col("x") + 50)
    report = D.drift_report(df, moved, ["x", "same", "absent"])
    row = D.recommendation(report).first()
    assert row["drifted_features"] == ["x"] and row["n_features_checked"] == 2
    assert row["max_ks_statistic"] == 0.5 and row["recommendation"] == "retrain"


def test_thin_features_are_skipped(spark):
    ref = spark.range(50).select(F.col("id").cast("double").alias("x"))
    assert D.drift_report(ref, ref.limit(9), ["x"]).first()["n_features_checked"] == 0


def test_profile_skips_missing_values(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None), (float("nan"), None)], "a double, b double")
    rows = D.ref_profile(df, ["a", "b"]).collect()
    assert [(r["feature"], r["n"], r["mean"], r["std"], r["p50"]) for r in rows] == [("a", 2, 2.0, 1.0, 2.0)]


def test_windows_closed_and_compat(spark):
    df = spark.range(101).select(F.col("id").alias("t"))
    counts = {r["window"]: r["count"] for r in D.time_windows(df, "t").groupBy("window").count().collect()}
    assert counts == {1: 20, 2: 20, 3: 20, 4: 20, 5: 21}
    assert D.time_windows(df, "t", compat=True).count() == 100


def test_window_performance_skips_thin_windows(spark):
    rows = [(t, int(t % 10 == 0), 0.9 if t % 10 == 0 else 0.1) for t in range(500)] + [(999, 1, 0.9)]
    df = spark.createDataFrame(rows, "t long, y int, s double")
    out = D.window_performance(df, "t", "y", "s", cuts=[]).orderBy("window").collect()
    assert [r["window"] for r in out] == [1, 2, 3]
    assert out[0]["recall"] == 1.0 and out[0]["auc_roc"] == 1.0


def test_performance_drop_needs_two_windows(spark):
    one = spark.createDataFrame([(1, 0.9)], "window int, recall double")
    two = spark.createDataFrame([(2, 0.8), (1, 0.9)], "window int, recall double")
    assert D.performance_drop(one).first()["performance_drop"] is False
    assert D.performance_drop(two).first()["performance_drop"] is True
    assert D.performance_drop(one.limit(0)).first()["performance_drop"] is False


@pytest.mark.parametrize("rows", [1_000_000, 40])
def test_saved_reference_gives_the_same_scores(spark, tmp_path, monkeypatch, rows):
    monkeypatch.setattr(running.range_cuts, "__defaults__", (rows,))
    ref = spark.range(300).select((F.col("id") % 50).cast("double").alias("x"), F.sqrt("id").alias("y"), F.lit(1.0).alias("only"))
    cur = spark.range(200).select((F.col("id") % 70).cast("double").alias("x"), F.sqrt(F.col("id") + 9).alias("y"))
    D.save_reference(ref, ["x", "y", "only"], str(tmp_path / "ref"))
    get = lambda df: sorted(map(tuple, D.feature_scores(df).collect()))
    assert get(D.ks_saved(str(tmp_path / "ref"), cur)) == get(D.ks_two_sample(ref, cur, ["x", "y"]))
    nothing = D.drift_summary(D.feature_scores(D.ks_saved(str(tmp_path / "ref"), cur.limit(0)))).first()
    assert (nothing["n_features_checked"], nothing["drift_detected"]) == (0, False)
