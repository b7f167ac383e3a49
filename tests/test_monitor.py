"""Rates, buckets, sustained conditions, silence, routing, retraining and streams."""

import glob
import random

import pytest
from pyspark.sql import functions as F

from riskloom.operators import drift as D
from riskloom.operators import monitor as M
from riskloom.operators import retrain as R
from riskloom.streaming import streams as S


def at(df):
    return df.withColumn("ts", F.timestamp_seconds("sec"))


def test_sliding_counts_every_event_in_each_window(spark):
    df = at(spark.createDataFrame([(s,) for s in (0, 59, 60, 299, 300)], "sec long"))
    out = {r["window_start"]: r["n"] for r in M.rate(df, "ts", 300, 60).collect()}
    assert sum(out.values()) == 25 and out[0] == 4 and out[60] == 3
    with pytest.raises(ValueError):
        M.rate(df, "ts", 300, 70)


@pytest.mark.parametrize("values, phi, want", [
    ([0.05] * 100, 0.5, 0.075), ([10.0] * 3, 0.95, 1.0), ([0.05, 0.3], 0.5, 0.1), ([], 0.5, None),
])
def test_bucket_quantile(spark, values, phi, want):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    edges = [0.025, 0.1, 0.5, 1.0] if values and values[0] == 0.05 and len(values) > 2 else [0.1, 0.5, 1.0]
    got = M.bucket_quantile(M.bucket_arrays(df, "v", edges), edges, phi).first()["quantile"]
    if values == [0.05] * 100:
        want = 0.025 + 0.075 * 0.5
    assert got == want or got == pytest.approx(want)


def test_sustained_needs_the_whole_span(spark):
    on = [1, 1, 1, 0, 1, 1, 1, 1, 0, 1]
    df = spark.createDataFrame([(60 * i, bool(v)) for i, v in enumerate(on)], "t long, v boolean")
    out = M.sustained(df, "t", F.col("v"), 180, 60).collect()
    assert [(r["active_since"], r["fired_at"], r["steps"]) for r in out] == [(240, 420, 4)]


def test_gap_in_evaluations_ends_a_stretch(spark):
    df = spark.createDataFrame([(0, True), (60, True), (600, True)], "t long, v boolean")
    assert M.sustained(df, "t", F.col("v"), 120, step=540).count() == 1
    assert M.sustained(df, "t", F.col("v"), 120, step=60).count() == 0


def test_default_rules(spark):
    rows = [("fraud_recall_current", "m", 60 * i, 0.79) for i in range(12)]
    rows += [("feature_drift_score", "V1", 60 * i, 0.3) for i in range(3)] + [("up", "api", 0, 0.0), ("up", "api", 60, 0.0)]
    series = spark.createDataFrame(rows, "metric string, labels string, t long, value double")
    fired = {r["alertname"] for r in M.evaluate_rules(series, 60).collect()}
    assert fired == {"FraudRecallDrop", "FraudRecallWarning", "FeatureDriftDetected", "SevereFeatureDrift", "FraudAPIDown"}


def test_silence_needs_more_than_the_gap(spark):
    df = at(spark.createDataFrame([("a", s) for s in (0, 60, 120, 181)] + [("b", 0), ("b", 300)], "src string, sec long"))
    out = sorted((r["src"], r["silent_from"], r["silent_until"]) for r in M.source_silence(df, "ts", ["src"], 60).collect())
    assert out == [("a", 120, 181), ("b", 0, 300)]


def test_one_notification_per_repeat_interval(spark):
    hours = [0, 1, 2.9, 3, 7]
    df = spark.createDataFrame([("A", "c", int(h * 3600)) for h in hours], "alertname string, category string, t long")
    out = sorted((r["slot"], r["n_alerts"]) for r in M.alert_groups(df, "t").collect())
    assert out == [(0, 3), (1, 1), (2, 1)]
    # Two alerts a minute apart belong together wherever they fall, and silence before does not matter.
    times = [0, 10_790, 10_800 + 9000, 10_800 + 9060, 500_000, 510_799, 510_800]
    df = spark.createDataFrame([("A", "c", t) for t in times], "alertname string, category string, t long")
    out = sorted((r["notified_at"], r["n_alerts"]) for r in M.alert_groups(df, "t").collect())
    assert out == [(0, 2), (19_800, 2), (500_000, 2), (510_800, 1)]


def test_notifications_equal_a_plain_loop(spark):
    rng = random.Random(6)
    rows = [(f"g{g}", rng.randrange(0, 4_000_000 if g else 300_000)) for g in range(6) for _ in range([800, 1, 5, 60, 300, 2][g])] + [("g1", None)]
    rows += [("hot", 20 * i) for i in range(3000)] + [(None, 7)]
    out = {(r["k"], r["slot"]): (r["notified_at"], r["n_alerts"]) for r in M.alert_groups(spark.createDataFrame(rows, "k string, t long"), "t", ["k"], 10_800).collect()}
    want = {}
    for g in {r[0] for r in rows}:
        slot = -1
        for t in sorted(t for k, t in rows if k == g and t is not None):
            if slot < 0 or t - want[g, slot][0] >= 10_800:
                slot += 1
                want[g, slot] = t, 0
            want[g, slot] = want[g, slot][0], want[g, slot][1] + 1
    assert {k: v for k, v in out.items() if k[0] is not None} == {k: v for k, v in want.items() if k[0] is not None}


def test_routes(spark):
    rows = [("FraudRecallDrop", "critical"), ("FeatureDriftDetected", "warning"), ("HighAPILatency", "warning"), ("FeatureDriftDetected", "critical"), ("x", None)]
    df = spark.createDataFrame(rows, "alertname string, severity string")
    out = sorted((r["alertname"], r["severity"] or "", r["receiver"]) for r in M.route_alerts(df).collect())
    assert out == [("FeatureDriftDetected", "critical", "critical-receiver"), ("FeatureDriftDetected", "warning", "drift-receiver"),
                   ("FraudRecallDrop", "critical", "critical-receiver"), ("HighAPILatency", "warning", "default-receiver"), ("x", "", "default-receiver")]
    both = (M.Route("a", (("severity", "critical"),), True), M.Route("b", (("alertname", "FeatureDriftDetected"),)), M.Route("c", ()))
    out = sorted((r["alertname"], r["severity"] or "", r["receiver"]) for r in M.route_alerts(df, both).collect())
    assert [o[2] for o in out] == ["a", "b", "b", "a", "c", "c", "c"]
    assert {r["receiver"] for r in M.route_alerts(df, ()).collect()} == {"default-receiver"}


def test_retrain_events_ignore_the_rest(spark):
    rows = [("FraudRecallDrop", "firing"), ("FeatureDriftDetected", None), ("HighErrorRate", "firing"), ("FraudRecallDrop", "resolved")]
    df = spark.createDataFrame(rows, "alertname string, status string")
    out = sorted((r["alertname"], r["event_type"]) for r in M.retrain_events(df).collect())
    assert out == [("FeatureDriftDetected", "drift-detected"), ("FraudRecallDrop", "model-performance-drop")]


@pytest.mark.parametrize("name, recall, drift, days, want", [
    ("hybrid", 0.79, 0.5, 9, (True, ["recall_low"], "high")),
    ("hybrid", 0.80, 0.16, 9, (True, ["drift_high"], "medium")),
    ("hybrid", 0.80, 0.15, 7, (True, ["period_over"], "scheduled")),
    ("hybrid", 0.80, 0.15, 6, (False, [], "none")),
    ("threshold_only", 0.7, 0.2, 99, (True, ["recall_low", "drift_high"], "high")),
    ("threshold_only", 0.9, 0.1, 99, (False, [], "none")),
    ("periodic_only", 0.1, 0.9, 6, (False, [], "none")),
    ("periodic_only", 0.9, 0.0, 7, (True, ["period_over"], "scheduled")),
])
def test_policy(spark, name, recall, drift, days, want):
    df = spark.createDataFrame([(recall, drift, days)], "r double, k double, d int")
    row = df.select(R.retrain_policy(F.col("r"), F.col("k"), F.col("d"), name).alias("p")).first()["p"]
    assert tuple(row) == want


def test_reason_names_its_figures(spark):
    rows = [(0.79, 0.5, 9), (0.80, 0.16, 9), (0.9, 0.15, 7), (0.9, 0.1, 6)]
    df = spark.createDataFrame(rows, "r double, k double, d int").coalesce(1)
    got = [r[0] for r in df.select(R.retrain_reason(F.col("r"), F.col("k"), F.col("d"))).collect()]
    assert got == ["recall drop: 0.7900 < 0.8", "drift exceeded: 0.1600 > 0.15", "periodic: 7d since last retrain", ""]


@pytest.fixture(scope="module")
def healthy(spark):
    return spark.range(1, 91).select(
        F.lit("m").alias("model_id"), F.col("id").alias("day"), F.lit(0.9).alias("recall"), F.lit(0.01).alias("ks_score"))


def test_fold_counts_days(healthy):
    n = lambda compat: R.retrain_fold(healthy, compat=compat).where("retrained").count()
    assert (n(True), n(False)) == (11, 12)
    first = R.retrain_fold(healthy, compat=True).where("retrained").agg(F.min("day")).first()[0]
    assert first == 8


def test_summary_and_winners(spark):
    rows = [("a", 0.9, True), ("a", 0.7, False), ("b", 0.8, False), ("b", 0.8, False)]
    summary = R.daily_summary(spark.createDataFrame(rows, "strategy string, recall double, retrained boolean"))
    got = {r["strategy"]: r for r in summary.collect()}
    assert got["a"]["recall_std"] == 0.1 and got["a"]["days_below_threshold"] == 1 and got["a"]["total_cost"] == 1.0
    assert tuple(R.strategy_winners(summary).first()) == ("a", "b", "b")


def write_parts(df, folder, column, parts):
    """One file per part, so that the stream sees several micro-batches."""
    for i, condition in enumerate(parts):
        df.where(condition).coalesce(1).write.mode("append").parquet(f"{folder}/{i:02d}")


def test_retrain_stream_keeps_state_between_batches(spark, healthy, tmp_path):
    write_parts(healthy, str(tmp_path), "day", [F.col("day") <= 30, F.col("day").between(31, 60), F.col("day") > 60])
    source = S.file_stream(spark, f"{tmp_path}/*", "*.parquet", healthy.schema, files_per_trigger=1)
    out = S.run_available(S.retrain_stream(source, ["model_id"], F.lit(False), 7, "model_id string"), "retrain")
    batch = R.retrain_fold(healthy).select("model_id", "day", "retrained")
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, batch.collect()))


def test_alert_stream_spans_batches(spark, tmp_path):
    steps = spark.range(20).select(F.lit("k").alias("key"), (F.col("id") * 60).alias("t"), (F.col("id") % 9 != 8).alias("on"))
    write_parts(steps, str(tmp_path), "t", [F.col("t") < 300, F.col("t").between(300, 700), F.col("t") > 700])
    source = S.file_stream(spark, f"{tmp_path}/*", "*.parquet", steps.schema, files_per_trigger=1)
    out = S.run_available(S.alert_stream(source, ["key"], 300, 60, "key string"), "alerts")
    batch = M.sustained(steps, "t", F.col("on"), 300, 60, ["key"]).select("key", "active_since", "fired_at")
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, batch.collect()))
    assert out.count() == 2


def test_windowed_counts_match_closed_windows(spark, tmp_path):
    df = at(spark.range(0, 7200, 30).select(F.col("id").alias("sec"), (F.col("id") % 2 == 0).alias("f")))
    df.write.parquet(str(tmp_path / "ev"))
    source = S.file_stream(spark, str(tmp_path / "ev"), "*.parquet", df.schema, "ts")
    out = S.run_available(S.windowed_counts(source, "ts", "10 minutes", "10 minutes"), "counts")
    got = {r["window_start"]: r["n"] for r in out.collect()}
    assert got and all(n == 20 for n in got.values()) and max(got) + 600 <= 7170 - 600


def test_drift_stream_scores_every_batch(spark, tmp_path):
    ref = spark.range(100).select(F.col("id").cast("double").alias("x"))
    moved = ref.select((F.col("x") + 60).alias("x"))
    ref.coalesce(1).write.parquet(f"{tmp_path}/in/00")
    moved.coalesce(1).write.parquet(f"{tmp_path}/in/01")
    source = S.file_stream(spark, f"{tmp_path}/in/*", "*.parquet", ref.schema, files_per_trigger=1)
    out = S.drift_stream(source, ref, ["x"], f"{tmp_path}/out")
    assert sorted((r["ks_statistic"], r["drifted"]) for r in out.collect()) == [(0.0, False), (0.6, True)]


@pytest.mark.parametrize("parts,per_trigger", [(1, 1), (10, 1), (10, 10)])
def test_window_drift_does_not_depend_on_files(spark, tmp_path, parts, per_trigger):
    rows = at(spark.range(0, 4000).select((F.col("id") * 10).alias("sec"), F.when(F.col("id") < 2000, F.col("id") % 97).otherwise(F.col("id") % 61).cast("double").alias("x"),
                                          F.when(F.col("id") % 5 > 0, F.sqrt("id")).alias("y")))
    ref = spark.range(700).select((F.col("id") % 80).cast("double").alias("x"), F.sqrt(F.col("id") * 3).alias("y"))
    path = f"{tmp_path}/events.parquet"
    rows.repartitionByRange(parts, "sec").write.parquet(path)
    stream, close = S.closed_stream(S.table_stream(spark, path, rows.schema, per_trigger), "ts", "closing")
    out = S.window_drift_stream(stream, "ts", "10000 seconds", "12 hours", ref, ["x", "y"], f"{tmp_path}/out", close=close)
    got = {(r["window_start"], r["feature"]): tuple(r[c] for c in ("ks_statistic", "p_value", "ref_mean", "curr_mean")) for r in out.collect()}
    want = {}
    for w in range(4):
        part = rows.where((F.col("sec") >= w * 10_000) & (F.col("sec") < (w + 1) * 10_000))
        for r in D.feature_scores(D.ks_two_sample(ref, part, ["x", "y"])).collect():
            want[w * 10_000, r["feature"]] = tuple(r[c] for c in ("ks_statistic", "p_value", "ref_mean", "curr_mean"))
    assert got == want and len(got) == 8


def test_scores_without_a_label_are_counted(spark, tmp_path):
    # Not at second 0, which is the watermark that Spark begins with.
    scores = at(spark.range(0, 7200, 10).select((F.col("id") + 86400).alias("sec"), F.col("id").alias("event_id"), (F.col("id") % 100 / 100).alias("probability")))
    scores.select("event_id", "probability", "ts").repartitionByRange(3, "event_id").write.parquet(f"{tmp_path}/scores.parquet")
    labels = scores.where("event_id % 30 <> 0").select("event_id", (F.col("event_id") % 7 == 0).cast("int").alias("y"), "ts")
    labels.repartitionByRange(3, "event_id").write.parquet(f"{tmp_path}/labels.parquet")

    def source(name, schema, time):
        stream, close = S.closed_stream(S.table_stream(spark, f"{tmp_path}/{name}.parquet", schema), "ts", name)
        return stream.withColumn("event_id", F.coalesce("event_id", F.lit(-1))).withColumnRenamed("ts", time), close

    left, close_left = source("scores", scores.select("event_id", "probability", "ts").schema, "scored_at")
    right, close_right = source("labels", labels.schema, "labelled_at")
    out = S.run_available(S.live_recall(left, right, "event_id", "1 hour", "10 minutes"), "recall", close=lambda: (close_left(), close_right()))
    got = {r["window_start"]: (r["tp"] + r["fp"] + r["fn"] + r["tn"], r["unlabelled"]) for r in out.collect()}
    assert got == {86400: (240, 120), 90000: (240, 120)}


@pytest.mark.parametrize("parts,per_trigger", [(1, 1), (6, 1), (6, 100)])
def test_streams_are_complete_on_files_and_folders(spark, tmp_path, parts, per_trigger):
    rows = at(spark.range(0, 40_000, 37).select((F.col("id") + 5).alias("sec"), (F.col("id") % 3).alias("k")))
    path = f"{tmp_path}/events.parquet"
    rows.repartitionByRange(parts, "sec").write.parquet(path)
    if parts == 1:
        path = next(p for p in glob.glob(f"{path}/*.parquet"))
    stream, close = S.closed_stream(S.table_stream(spark, path, rows.schema, per_trigger), "ts", "closing")
    counts = S.run_available(S.windowed_counts(stream, "ts", "10 minutes", "6 hours"), "counts", close=close)
    want = rows.groupBy((F.col("sec") - F.col("sec") % 600).alias("w")).count()
    assert sorted((r["window_start"], r["n"]) for r in counts.collect()) == sorted(map(tuple, want.collect()))
    stream, close = S.closed_stream(S.table_stream(spark, path, rows.schema, per_trigger), "ts", "closing")
    told = S.run_available(S.first_alerts(stream, "ts", "6 hours", "k long", ["k"], 3600), "first", close=close)
    batch = M.alert_groups(rows, "sec", ["k"], 3600).select("k", "notified_at")
    assert sorted(map(tuple, told.collect())) == sorted(map(tuple, batch.collect()))


def test_a_stream_without_files_is_an_error(spark, tmp_path):
    (tmp_path / "none").mkdir()
    with pytest.raises(Exception):
        S.table_stream(spark, f"{tmp_path}/none", spark.range(1).schema)


def test_waiting_alerts_cost_state_by_the_minute_not_by_the_row():
    calls = []

    class State(dict):
        containsKey = dict.__contains__
        getValue = dict.__getitem__
        removeKey = dict.pop

        def updateValue(self, k, v):
            calls.append(k)
            self[k] = v

    class Handle:
        state = State()
        getValueState = lambda self, *a: None
        getMapState = lambda self, *a: self.state
        registerTimer = lambda self, t: None

    import pandas as pd
    told = S.NotifyProcessor(["k"], 3600)
    told.init(Handle())
    chunk = pd.DataFrame({"us": [s * 1_000_000 for s in range(300)] * 4})
    list(told.handleInputRows(("a",), iter([chunk] * 20), None))
    assert len(calls) == 5 and all(v == ((1 << 60) - 1,) for v in Handle.state.values())
