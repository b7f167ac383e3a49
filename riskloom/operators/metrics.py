"""Classification metrics over ``(label, score)`` rows, overall or per group.

Ranking metrics count positives and negatives per distinct score first (combined before the shuffle), then
accumulate over the scores with :func:`running_sums`, so ties are exact and no group is sorted in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.shape import ratio
from riskloom.operators.running import RANGE, range_cuts, running_sums, with_ranges


def confusion(df: DataFrame, label: str, score: str, threshold: float = 0.5, by: Sequence[str] = ()) -> DataFrame:
    """tp, fp, fn, tn at ``score >= threshold``; all four cells exist even with one class."""
    hit, real = F.col(score) >= threshold, F.col(label) == 1
    return df.groupBy(*by).agg(
        F.count_if(hit & real).alias("tp"), F.count_if(hit & ~real).alias("fp"),
        F.count_if(~hit & real).alias("fn"), F.count_if(~hit & ~real).alias("tn"),
    )


def precision(tp: Column, fp: Column) -> Column:
    return ratio(tp, tp + fp)


def recall(tp: Column, fn: Column) -> Column:
    return ratio(tp, tp + fn)


def prf(cells: DataFrame) -> DataFrame:
    """Precision, recall, F1 and false-positive rate of confusion rows; an empty denominator gives 0."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return cells.select(
        "*",
        precision(tp, fp).alias("precision"),
        recall(tp, fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        (fp / F.greatest(fp + tn, F.lit(1))).alias("fpr"),
    )


def specificity(cells: DataFrame) -> DataFrame:
    return cells.withColumn("specificity", 1.0 - F.col("fp") / F.greatest(F.col("fp") + F.col("tn"), F.lit(1)))


def business_cost(cells: DataFrame, fn_cost: float = 10.0, fp_cost: float = 1.0) -> DataFrame:
    return cells.withColumn("business_cost", F.lit(fn_cost) * F.col("fn") + F.lit(fp_cost) * F.col("fp"))


def business_value(cells: DataFrame, per_tp: float = 500.0, per_fp: float = 20.0) -> DataFrame:
    saved, wasted = F.col("tp") * F.lit(per_tp), F.col("fp") * F.lit(per_fp)
    return cells.select(
        "*", saved.alias("fraud_loss_saved"), wasted.alias("false_alarm_cost"), (saved - wasted).alias("net_value")
    )


def score_counts(df: DataFrame, label: str, score: str, by: Sequence[str] = (),
                 cuts: list[float] | None = None) -> tuple[DataFrame, bool]:
    """``(*by, value_range, score, pos, neg)`` per distinct score, and whether the scores were cut into ranges."""
    if cuts is None:
        cuts = range_cuts(df, [score])[score]
    rows = df.where(F.col(score).isNotNull() & F.col(label).isNotNull()).select(
        *by, F.col(score).cast("double").alias("score"), (F.col(label) == 1).cast("int").alias("y")
    )
    rows = with_ranges(rows, {"score": cuts}).withColumnRenamed("score__range", RANGE)
    counted = rows.groupBy(*by, RANGE, "score").agg(
        F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg")
    )
    return counted, bool(cuts)


def auc_roc(df: DataFrame, label: str, score: str, by: Sequence[str] = (),
            cuts: list[float] | None = None) -> DataFrame:
    """Area under the ROC curve with average ranks on ties; null when a class is missing."""
    return _auc(*score_counts(df, label, score, by, cuts), by)


def _auc(counted: DataFrame, ranged: bool, by: Sequence[str] = ()) -> DataFrame:
    return running_sums(counted, by, "score", ["neg"], ranged).groupBy(*by).agg(auc_of_counts().alias("auc_roc"))


def auc_of_counts() -> Column:
    """Aggregate over rows ``(pos, neg, cum_neg)`` in ascending score order."""
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    below = F.col("cum_neg").cast("double") - F.lit(0.5).cast("double") * neg
    return ratio(F.sum(pos * below), F.sum(pos) * F.sum(neg), default=None)


def avg_precision(df: DataFrame, label: str, score: str, by: Sequence[str] = (),
                  cuts: list[float] | None = None) -> DataFrame:
    """Sum of precision times recall step over descending scores."""
    return _average_precision(*score_counts(df, label, score, by, cuts), by)


def _average_precision(counted: DataFrame, ranged: bool, by: Sequence[str] = ()) -> DataFrame:
    cum = running_sums(counted, by, "score", ["pos", "neg"], ranged, descending=True)
    at = precision(F.col("cum_pos"), F.col("cum_neg"))
    return cum.groupBy(*by).agg(
        ratio(F.sum(F.col("pos").cast("double") * at), F.sum("pos"), default=None).alias("avg_precision")
    )


def _curve_counts(df, label, score, by, cuts):
    """Descending running counts with the totals of each group beside them."""
    counted, ranged = score_counts(df, label, score, by, cuts)
    cum = running_sums(counted, by, "score", ["pos", "neg"], ranged, descending=True)
    totals = counted.groupBy(*by).agg(F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg"))
    if by:
        return cum.join(totals, list(by)), totals
    whole = totals.select(F.struct("all_pos", "all_neg").alias("t")).scalar()
    return cum.select("*", whole["all_pos"].alias("all_pos"), whole["all_neg"].alias("all_neg")), totals


def roc_curve(df: DataFrame, label: str, score: str, by: Sequence[str] = (),
              cuts: list[float] | None = None) -> DataFrame:
    """One point per distinct score, and the origin at an infinite threshold."""
    points, totals = _curve_counts(df, label, score, by, cuts)
    curve = points.select(
        *by, F.col("score").alias("threshold"),
        ratio(F.col("cum_neg"), F.col("all_neg")).alias("fpr"), ratio(F.col("cum_pos"), F.col("all_pos")).alias("tpr"),
    )
    origin = totals.select(
        *by, F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return curve.unionByName(origin)


def pr_curve(df: DataFrame, label: str, score: str, by: Sequence[str] = (),
             cuts: list[float] | None = None) -> DataFrame:
    """Precision and recall per distinct score, the share of positives as baseline, and the end point (1, 0)."""
    points, totals = _curve_counts(df, label, score, by, cuts)
    baseline = ratio(F.col("all_pos"), F.col("all_pos") + F.col("all_neg")).alias("baseline")
    curve = points.select(
        *by, F.col("score").alias("threshold"), precision(F.col("cum_pos"), F.col("cum_neg")).alias("precision"),
        ratio(F.col("cum_pos"), F.col("all_pos")).alias("recall"), baseline,
    )
    end = totals.select(
        *by, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"),
        baseline,
    )
    return curve.unionByName(end)


def score_histogram(df: DataFrame, label: str, score: str, bins: int = 50, lo: float | None = None,
                    hi: float | None = None) -> DataFrame:
    """Counts per class and equal-width bin between the class's own extremes, or between ``lo`` and ``hi``.

    Bins are numbered from 0; the last one includes its upper edge.
    """
    rows = df.where(F.col(score).isNotNull()).select(
        F.col(label).alias("label"), F.col(score).cast("double").alias("score")
    )
    if lo is None or hi is None:
        limits = rows.groupBy("label").agg(F.min("score").alias("lo"), F.max("score").alias("hi"))
        rows = rows.join(limits, "label")
    else:
        rows = rows.where(F.col("score").between(lo, hi)).select(
            "*", F.lit(float(lo)).alias("lo"), F.lit(float(hi)).alias("hi")
        )
    step = ratio(F.col("score") - F.col("lo"), F.col("hi") - F.col("lo")) * bins
    bucket = F.least(F.floor(step), F.lit(bins - 1)).cast("int")
    return rows.groupBy("label", bucket.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def cells_of_counts(counted: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The confusion row of counts per score."""
    def total(column: str, hit: Column) -> Column:
        return F.coalesce(F.sum(F.when(hit, F.col(column))), F.lit(0)).cast("bigint")

    hit = F.col("score") >= threshold
    return counted.agg(
        total("pos", hit).alias("tp"), total("neg", hit).alias("fp"), total("pos", ~hit).alias("fn"),
        total("neg", ~hit).alias("tn"),
    )


def evaluate(df: DataFrame, label: str, score: str, threshold: float = 0.5, fn_cost: float = 10.0,
             fp_cost: float = 1.0, cuts: list[float] | None = None) -> DataFrame:
    """One row with every evaluation metric.

    All of them come from the counts per score, whose shuffle is shared, so the rows are scored once.
    """
    counted, ranged = score_counts(df, label, score, (), cuts)
    cells = business_cost(prf(cells_of_counts(counted, threshold)), fn_cost, fp_cost)
    return cells.select(
        "*", _auc(counted, ranged).scalar().alias("auc_roc"), _average_precision(counted, ranged).scalar().alias("avg_precision"),
        ratio(F.col("tp") + F.col("fn"), F.col("tp") + F.col("fn") + F.col("fp") + F.col("tn")).alias("positive_rate"),
    )


def batch_rate(df: DataFrame, flag: str) -> DataFrame:
    """Batch size and share of flagged rows; an empty batch has rate 0."""
    rate = F.coalesce(F.avg(F.col(flag).cast("double")), F.lit(0.0))
    return df.agg(F.count(F.lit(1)).alias("n_transactions"), F.round(rate, 4).alias("fraud_rate"))
