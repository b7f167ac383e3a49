"""Two-sample distribution drift, performance over time and the recommendation drawn from both."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.ks import ks_pvalue
from riskloom.functions.shape import as_double, ratio
from riskloom.operators.digits import ks_distance, narrow, quantiles_of
from riskloom.operators.metrics import auc_of_counts, recall, score_counts
from riskloom.operators.running import RANGE, melt_ranged, range_cuts, running_sums

PROFILE_QUANTILES = {"p5": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95}
CURRENT = "is_current"


def ref_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, mean, std, p5, p25, p50, p75, p95, n)`` for every column with data."""
    rows = narrow(df, columns)
    row = rows.agg(*[
        F.struct(F.avg(f"c{i}").alias("mean"), F.stddev_pop(f"c{i}").alias("std"), F.count(f"c{i}").alias("n")).alias(f"c{i}")
        for i in range(len(columns))
    ])
    entries = F.array(*[
        F.struct(F.lit(c).alias("feature"), *[F.col(f"c{i}")[f].alias(f) for f in ("mean", "std", "n")]) for i, c in enumerate(columns)
    ])
    moments = row.select(F.inline(entries)).where(F.col("n") > 0)
    quantiles = quantiles_of(rows, columns, list(PROFILE_QUANTILES.values())).groupBy("feature").agg(*[
        F.max(F.when(F.col("q") == q, F.col("value"))).alias(name) for name, q in PROFILE_QUANTILES.items()
    ])
    return moments.join(quantiles, "feature").select(
        "feature", "mean", "std", *PROFILE_QUANTILES, "n"
    )


def sides(reference: DataFrame, current: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Both samples in one frame with an ``is_current`` flag; only columns both have are kept."""
    shared = [c for c in columns if c in reference.columns and c in current.columns]
    cast = [as_double(c).alias(c) for c in shared]
    return reference.select(*by, *cast, F.lit(0).alias(CURRENT)).unionByName(
        current.select(*by, *cast, F.lit(1).alias(CURRENT))
    )


def ks_between(df: DataFrame, columns: Sequence[str], flag: str = CURRENT, min_n: int = 1) -> DataFrame:
    """Largest distance between the distribution functions of rows with flag 0 and rows with flag 1.

    Rows ``(feature, ks_statistic, n_ref, n_cur, ref_mean, cur_mean)``; features with fewer than ``min_n`` values on a side are left out.
    Counters per stretch of values are shuffled, and only stretches that may hold the largest distance are counted any finer.
    """
    return ks_distance(df, columns, flag, min_n)


def _ks_of_counts(counted: DataFrame, columns: Sequence[str], ranged: bool, min_n: int) -> DataFrame:
    cum = running_sums(counted, ["feature"], "value", ["ref", "cur"], ranged)
    # Counts and means come from the counted values, so the input is read once.
    totals = counted.groupBy("feature").agg(
        F.sum("ref").alias("n_ref"), F.sum("cur").alias("n_cur"),
        F.sum(F.col("value") * F.col("ref")).alias("sum_ref"), F.sum(F.col("value") * F.col("cur")).alias("sum_cur"),
    ).where((F.col("n_ref") >= min_n) & (F.col("n_cur") >= min_n))
    gap = F.abs(ratio(F.col("cum_ref"), F.col("n_ref")) - ratio(F.col("cum_cur"), F.col("n_cur")))
    # One totals row per feature.
    widest = cum.join(F.broadcast(totals), "feature").groupBy("feature").agg(
        F.max(gap).alias("ks_statistic"), *[F.first(c).alias(c) for c in totals.columns if c != "feature"]
    )
    name = F.get(F.array(*[F.lit(c) for c in columns]), F.col("feature"))
    return widest.select(
        name.alias("feature"), "ks_statistic", "n_ref", "n_cur", ratio(F.col("sum_ref"), F.col("n_ref")).alias("ref_mean"),
        ratio(F.col("sum_cur"), F.col("n_cur")).alias("cur_mean"),
    )


def ks_two_sample(reference: DataFrame, current: DataFrame, columns: Sequence[str], min_n: int = 1) -> DataFrame:
    both = sides(reference, current, columns)
    return ks_between(both, [c for c in columns if c in both.columns], CURRENT, min_n)


def save_reference(reference: DataFrame, columns: Sequence[str], path: str) -> None:
    """Write the reference as counts per column, value range and value, with the ranges; it is ranked once, however often it is used."""
    cuts = range_cuts(reference, columns)
    counts = melt_ranged(reference, cuts).groupBy("feature", RANGE, "value").agg(F.count(F.lit(1)).alias("n"))
    counts.write.mode("overwrite").parquet(f"{path}/counts")
    ranges = [(i, c, cuts[c]) for i, c in enumerate(columns)]
    reference.sparkSession.createDataFrame(ranges, "position int, feature string, cuts array<double>").write.mode("overwrite").parquet(f"{path}/ranges")


def ks_saved(path: str, current: DataFrame, min_n: int = 1) -> DataFrame:
    """As :func:`ks_between`, against a saved reference. Columns that ``current`` lacks, and an empty ``current``, give no rows."""
    spark = current.sparkSession
    ranges = spark.read.parquet(f"{path}/ranges").orderBy("position").collect()  # one row for each column
    cuts = {r["feature"]: list(r["cuts"]) for r in ranges}
    wide = current.select(*[as_double(c).alias(c) if c in current.columns else F.lit(None).cast("double").alias(c) for c in cuts])
    keys = ["feature", RANGE, "value"]
    batch = melt_ranged(wide, cuts).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    saved = spark.read.parquet(f"{path}/counts")
    zero = F.lit(0).cast("bigint")
    both = saved.select(*keys, F.col("n").alias("ref"), zero.alias("cur")).unionByName(batch.select(*keys, zero.alias("ref"), F.col("n").alias("cur")))
    counted = both.groupBy(*keys).agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur"))
    return _ks_of_counts(counted, list(cuts), any(cuts.values()), max(1, min_n))


def ks_windows(path: str, counts: DataFrame, by: Sequence[str], min_n: int = 1) -> DataFrame:
    """As :func:`ks_saved` for many samples at once: ``counts`` has ``(*by, feature, value, n)``, feature being the column's position.

    The reference is ranked once for all samples, at its own values and theirs. Between two values of a sample only the reference rises, so
    the distance is largest at a value of the sample or just before it.
    """
    spark, by = counts.sparkSession, list(by)
    ranges = spark.read.parquet(f"{path}/ranges").orderBy("position").collect()  # one row for each column
    cuts = F.get(F.array(*[F.array(*map(F.lit, r["cuts"])).cast("array<double>") for r in ranges]), F.col("feature"))
    ranged = any(r["cuts"] for r in ranges)
    cur = counts.withColumn(RANGE, F.size(F.filter(cuts, lambda c: c <= F.col("value"))))
    keys = ["feature", RANGE, "value"]
    saved = spark.read.parquet(f"{path}/counts").select(*keys, F.col("n").alias("ref"))
    points = saved.unionByName(cur.select(*keys, F.lit(0).cast("bigint").alias("ref"))).groupBy(*keys).agg(F.sum("ref").alias("ref"))
    below = running_sums(points, ["feature"], "value", ["ref"], ranged)
    own = running_sums(cur, [*by, "feature"], "value", ["n"], ranged)
    totals = saved.groupBy("feature").agg(F.sum("ref").alias("n_ref"), F.sum(F.col("value") * F.col("ref")).alias("sum_ref"))
    sums = cur.groupBy(*by, "feature").agg(F.sum("n").alias("n_cur"), F.sum(F.col("value") * F.col("n")).alias("sum_cur"))
    # One row per feature, and one per sample and feature.
    sums = sums.join(F.broadcast(totals), "feature").where((F.col("n_ref") >= min_n) & (F.col("n_cur") >= min_n))
    gap = lambda a, b: F.abs(ratio(a, F.col("n_ref")) - ratio(b, F.col("n_cur")))
    widest = F.greatest(gap(F.col("cum_ref"), F.col("cum_n")), gap(F.col("cum_ref") - F.col("ref"), F.col("cum_n") - F.col("n")))
    met = own.join(below, keys).join(sums, [*by, "feature"]).groupBy(*by, "feature").agg(
        F.max(widest).alias("ks_statistic"), *[F.first(c).alias(c) for c in ("n_ref", "n_cur", "sum_ref", "sum_cur")])
    name = F.get(F.array(*[F.lit(r["feature"]) for r in ranges]), F.col("feature"))
    return met.select(*by, name.alias("feature"), "ks_statistic", "n_ref", "n_cur", ratio(F.col("sum_ref"), F.col("n_ref")).alias("ref_mean"),
                      ratio(F.col("sum_cur"), F.col("n_cur")).alias("cur_mean"))


def feature_scores(ks: DataFrame, alpha: float = 0.05, method: str = "asymptotic", by: Sequence[str] = ()) -> DataFrame:
    """P-value and verdict per feature, and per sample where ``by`` tells them apart."""
    scored = ks.withColumn("p_value", ks_pvalue(F.col("ks_statistic"), F.col("n_ref"), F.col("n_cur"), method))
    return scored.select(
        *by, "feature", F.round("ks_statistic", 4).alias("ks_statistic"), F.round("p_value", 6).alias("p_value"),
        (F.col("p_value") < alpha).alias("drifted"), F.round("ref_mean", 4).alias("ref_mean"),
        F.round("cur_mean", 4).alias("curr_mean"),
    )


def drift_summary(scores: DataFrame) -> DataFrame:
    """One row: features checked and drifted, all drifted names in order, largest statistic and the flag."""
    drifted = F.sort_array(F.collect_list(F.when(F.col("drifted"), F.col("feature"))))
    return scores.agg(
        F.count(F.lit(1)).alias("n_features_checked"),
        F.count_if("drifted").alias("n_drifted_features"),
        drifted.alias("drifted_features"),
        F.coalesce(F.max("ks_statistic"), F.lit(0.0)).alias("max_ks_statistic"),
        F.coalesce(F.bool_or("drifted"), F.lit(False)).alias("drift_detected"),
    )


def drift_report(reference: DataFrame, current: DataFrame, columns: Sequence[str], alpha: float = 0.05,
                 min_n: int = 10, method: str = "asymptotic") -> DataFrame:
    return drift_summary(feature_scores(ks_two_sample(reference, current, columns, min_n), alpha, method))


def profile_match(profile: DataFrame, current: DataFrame, columns: Sequence[str], min_n: int = 10) -> DataFrame:
    """Reference features that the batch also has with at least ``min_n`` values, with both means."""
    row = current.agg(*[
        F.struct(F.count(as_double(c)).alias("n_cur"), F.avg(as_double(c)).alias("curr_mean")).alias(c)
        for c in columns
    ])
    entries = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c)["n_cur"].alias("n_cur"), F.col(c)["curr_mean"].alias("curr_mean"))
        for c in columns
    ])
    batch = row.select(F.inline(entries)).where(F.col("n_cur") >= min_n)
    return profile.join(batch, "feature")


def recommendation(summary: DataFrame, critical: float = 0.25) -> DataFrame:
    return summary.withColumn(
        "recommendation",
        F.when(F.col("max_ks_statistic") > critical, "retrain").when(F.col("drift_detected"), "watch").otherwise("none"),
    )


# -- performance over time -------------------------------------------------------------------------------------


def time_windows(df: DataFrame, time_col: str, n: int = 5, compat: bool = False) -> DataFrame:
    """Add ``window`` (from 1), ``t_start`` and ``t_end`` for ``n`` equal spans between the extremes of time.

    The bucket is arithmetic on the row, so no range join is needed. The last span also holds the latest row;
    with ``compat`` every span is half-open and rows past the last one drop out.
    """
    span = df.agg(F.struct(F.min(time_col).alias("lo"), F.max(time_col).alias("hi")).alias("s")).scalar()
    width = F.greatest(F.floor((span["hi"] - span["lo"]) / n), F.lit(1))
    index = F.floor((F.col(time_col) - span["lo"]) / width)
    out = df.where(F.col(time_col).isNotNull()).withColumn("window", index.cast("int") + 1)
    out = out.where(F.col("window") <= n) if compat else out.withColumn("window", F.least("window", F.lit(n)))
    start = span["lo"] + (F.col("window") - 1) * width
    return out.withColumn("t_start", start.cast("bigint")).withColumn("t_end", (start + width).cast("bigint"))


def window_performance(df: DataFrame, time_col: str, label: str, score: str, n: int = 5, min_n: int = 50,
                       min_pos: int = 5, threshold: float = 0.5, compat: bool = False,
                       cuts: list[float] | None = None) -> DataFrame:
    """Rows, positive rate, recall and AUC per time span; thin spans are left out.

    Counts per score give all four numbers, so the rows are shuffled once.
    """
    keys = ["window", "t_start", "t_end"]
    spanned = time_windows(df, time_col, n, compat)
    counted, ranged = score_counts(spanned, label, score, keys, cuts)
    cum = running_sums(counted, keys, "score", ["neg"], ranged)
    hit = F.col("score") >= threshold
    pos_hit = F.coalesce(F.sum(F.when(hit, F.col("pos"))), F.lit(0))
    pos_missed = F.coalesce(F.sum(F.when(~hit, F.col("pos"))), F.lit(0))
    out = cum.groupBy(*keys).agg(
        F.sum(F.col("pos") + F.col("neg")).alias("n_samples"),
        F.sum("pos").alias("positives"),
        recall(pos_hit, pos_missed).alias("recall"),
        F.coalesce(auc_of_counts(), F.lit(0.0)).alias("auc_roc"),
    )
    return out.where((F.col("n_samples") >= min_n) & (F.col("positives") >= min_pos)).select(
        *keys, "n_samples", F.round(F.col("positives") / F.col("n_samples"), 4).alias("fraud_rate"),
        F.round("recall", 4).alias("recall"), F.round("auc_roc", 4).alias("auc_roc"),
    )


def performance_drop(windows: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """Whether recall fell by more than ``tolerance`` from the first to the last span; false below two spans."""
    first, last = F.min_by("recall", "window"), F.max_by("recall", "window")
    return windows.agg(
        first.alias("first_recall"), last.alias("last_recall"),
        F.coalesce((F.count(F.lit(1)) >= 2) & (first - last > tolerance), F.lit(False)).alias("performance_drop"),
    )


def importance_join(early: DataFrame, late: DataFrame) -> DataFrame:
    """Importances of both periods side by side, for features known to both."""
    joined = early.select("feature", F.col("importance").alias("early")).join(
        late.select("feature", F.col("importance").alias("late")), "feature"
    )
    return joined.select(
        "feature", F.round("early", 6).alias("early"), F.round("late", 6).alias("late"),
        F.round(F.col("late") - F.col("early"), 6).alias("delta"),
    )


def topk_shift(shifts: DataFrame, k: int = 10) -> DataFrame:
    return shifts.orderBy(F.abs("delta").desc(), "feature").limit(k)
