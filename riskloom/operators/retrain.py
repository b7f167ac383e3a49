"""Retraining policy, its day-by-day fold per model, and the comparison of policies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
RECALL_THRESHOLD = 0.80
DRIFT_THRESHOLD = 0.15
PERIOD_DAYS = 7
STRATEGIES = ("threshold_only", "periodic_only", "hybrid")


def retrain_policy(recall: Column, drift: Column, days: Column, name: str = "hybrid",
                   recall_threshold: float = RECALL_THRESHOLD, drift_threshold: float = DRIFT_THRESHOLD,
                   period_days: int = PERIOD_DAYS) -> Column:
    """Struct ``(retrain, reasons, urgency)`` for one observation; reasons are codes: recall_low, drift_high, period_over."""
    low, drifted, due = recall < recall_threshold, drift > drift_threshold, days >= period_days
    codes = F.array(F.when(low, "recall_low"), F.when(drifted, "drift_high"), F.when(due, "period_over"))
    if name == "threshold_only":
        reasons = F.array_compact(F.slice(codes, 1, 2))
        urgency = F.when(low | drifted, "high").otherwise("none")
    elif name == "periodic_only":
        reasons = F.array_compact(F.slice(codes, 3, 1))
        urgency = F.when(due, "scheduled").otherwise("none")
    else:
        # The most urgent one alone.
        reasons = F.slice(F.array_compact(codes), 1, 1)
        urgency = F.when(low, "high").when(drifted, "medium").when(due, "scheduled").otherwise("none")
    return F.struct((F.size(reasons) > 0).alias("retrain"), reasons.alias("reasons"), urgency.alias("urgency"))


def retrain_reason(recall: Column, drift: Column, days: Column, recall_threshold: float = RECALL_THRESHOLD,
                   drift_threshold: float = DRIFT_THRESHOLD, period_days: int = PERIOD_DAYS) -> Column:
    """The most urgent reason of the hybrid policy with its figures, empty without one."""
    return (
        F.when(recall < recall_threshold, F.format_string(f"recall drop: %.4f < {recall_threshold}", recall))
        .when(drift > drift_threshold, F.format_string(f"drift exceeded: %.4f > {drift_threshold}", drift))
        .when(days >= period_days, F.format_string("periodic: %dd since last retrain", days))
        .otherwise("")
    )


def retrain_fold(daily: DataFrame, name: str = "hybrid", keys: Sequence[str] = ("model_id",), compat: bool = False,
                 **policy) -> DataFrame:
    """Apply the policy day by day: the counter returns to zero on a retrain and grows by one otherwise.

    ``daily`` holds ``(*keys, day, recall, ks_score)``. Days of one model are sequential, and only they: a group
    is as long as the model's life in days. With ``compat`` the counter is read before the day is added to it,
    so a period of 7 retrains on every eighth day.
    """
    days = F.sort_array(F.collect_list(F.struct("day", "recall", "ks_score")))
    per_model = daily.groupBy(*keys).agg(days.alias("days"))
    shift = 0 if compat else 1

    def step(state: Column, today: Column) -> Column:
        counter = state["counter"] + shift
        decision = retrain_policy(today["recall"], today["ks_score"], counter, name, **policy)
        entry = F.struct(
            today["day"].alias("day"), today["recall"].alias("recall"), today["ks_score"].alias("ks_score"),
            decision["retrain"].alias("retrained"), F.array_join(decision["reasons"], ", ").alias("retrain_reason"),
            decision["urgency"].alias("urgency"),
        )
        after = F.when(decision["retrain"], F.lit(0)).otherwise(state["counter"] + 1)
        return F.struct(after.alias("counter"), F.array_append(state["log"], entry).alias("log"))

    log_type = (
        "array<struct<day:bigint,recall:double,ks_score:double,retrained:boolean,retrain_reason:string,urgency:string>>"
    )
    start = F.struct(F.lit(0).alias("counter"), F.array().cast(log_type).alias("log"))
    folded = F.aggregate("days", start, step, lambda s: s["log"])
    return per_model.select(*keys, F.inline(folded))


def daily_summary(log: DataFrame, keys: Sequence[str] = ("strategy",), recall_threshold: float = RECALL_THRESHOLD,
                  retrain_cost: float = 1.0) -> DataFrame:
    retrains = F.count_if("retrained")
    spread = F.stddev_pop("recall")
    return log.groupBy(*keys).agg(
        retrains.alias("n_retrains"),
        F.round(retrains * F.lit(retrain_cost), 2).alias("total_cost"),
        F.round(F.avg("recall"), 4).alias("avg_recall"),
        F.round(F.min("recall"), 4).alias("min_recall"),
        F.round(F.max("recall"), 4).alias("max_recall"),
        F.round(spread, 4).alias("recall_std"),
        F.count_if(F.col("recall") < recall_threshold).alias("days_below_threshold"),
        F.round(1.0 - spread, 4).alias("stability_score"),
    )


def strategy_winners(summary: DataFrame) -> DataFrame:
    """Best average recall, best stability and lowest cost; ties go to the first name."""
    def best(column: str, sign: int) -> Column:
        return F.min_by("strategy", F.struct(F.lit(sign) * F.col(column), F.col("strategy")))

    return summary.agg(
        best("avg_recall", -1).alias("best_recall"),
        best("stability_score", -1).alias("most_stable"),
        best("total_cost", 1).alias("lowest_cost"),
    )
