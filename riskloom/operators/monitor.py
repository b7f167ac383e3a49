"""Batch queries over metric events: rates, histograms, sustained conditions, silence and alert routing.

Sliding windows are sums of panes: events are first counted per slide step (combined before the shuffle, a
handful of rows per series), and only the panes are spread over the windows they belong to.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.shape import ratio
from riskloom.session import cut_lineage

# Upper bucket edges in seconds and in probability, and the alert rules
# (name, metric, comparison, threshold, hold in seconds, severity, category).
LATENCY_EDGES = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0)
SCORE_EDGES = (0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
ALERT_RULES = (
    ("FraudRecallDrop", "fraud_recall_current", "<", 0.80, 300, "critical", "model_performance"),
    ("FraudRecallWarning", "fraud_recall_current", "<", 0.85, 600, "warning", "model_performance"),
    ("FeatureDriftDetected", "feature_drift_score", ">", 0.1, 120, "warning", "data_drift"),
    ("SevereFeatureDrift", "feature_drift_score", ">", 0.25, 120, "critical", "data_drift"),
    ("HighMissingValueRate", "feature_missing_value_rate", ">", 0.3, 300, "warning", "data_quality"),
    ("HighErrorRate", "error_ratio", ">", 0.05, 120, "critical", "system"),
    ("HighAPILatency", "latency_p95", ">", 1.0, 300, "warning", "system"),
    ("FraudAPIDown", "up", "==", 0.0, 60, "critical", "system"),
)
RETRAIN_EVENTS = {
    "FraudRecallDrop": "model-performance-drop",
    "FeatureDriftDetected": "drift-detected",
    "SevereFeatureDrift": "drift-detected",
}


def epoch(ts: str | Column) -> Column:
    """Whole seconds since 1970 of a timestamp, rounded down."""
    return F.floor(F.unix_micros(F.col(ts).cast("timestamp") if isinstance(ts, str) else ts) / 1_000_000)


def pane(ts: str, seconds: int) -> Column:
    """Start of the fixed span of ``seconds`` that holds ``ts``, in epoch seconds."""
    at = epoch(ts)
    return (at - F.pmod(at, F.lit(seconds))).cast("bigint")


def counts(df: DataFrame, ts: str, seconds: int, labels: Sequence[str] = ()) -> DataFrame:
    """Events per fixed span and label set."""
    return df.groupBy(pane(ts, seconds).alias("window_start"), *labels).agg(F.count(F.lit(1)).alias("n"))


def sliding(panes: DataFrame, sums: Sequence[str], seconds: int, slide: int, labels: Sequence[str] = ()) -> DataFrame:
    """Sum panes of length ``slide`` into windows of length ``seconds`` that start at every slide step."""
    if seconds % slide:
        raise ValueError("the window length must be a multiple of the slide")
    starts = F.sequence(F.col("window_start") - (seconds - slide), F.col("window_start"), F.lit(slide).cast("bigint"))
    return (
        panes.select(*labels, *sums, F.explode(starts).alias("window_start"))
        .groupBy("window_start", *labels).agg(*[F.sum(s).alias(s) for s in sums])
    )


def increase(df: DataFrame, ts: str, seconds: int, slide: int, labels: Sequence[str] = ()) -> DataFrame:
    """Events per sliding window."""
    return sliding(counts(df, ts, slide, labels), ["n"], seconds, slide, labels)


def rate(df: DataFrame, ts: str, seconds: int, slide: int, labels: Sequence[str] = ()) -> DataFrame:
    """Events per second over each sliding window."""
    windows = increase(df, ts, seconds, slide, labels)
    return windows.select("window_start", *labels, "n", (F.col("n") / seconds).alias("per_second"))


def error_ratio(df: DataFrame, ts: str, seconds: int, slide: int, is_error: Column) -> DataFrame:
    """Share of errors per sliding window, summed over all labels."""
    panes = df.groupBy(pane(ts, slide).alias("window_start")).agg(
        F.count_if(is_error).alias("errors"), F.count(F.lit(1)).alias("total")
    )
    windows = sliding(panes, ["errors", "total"], seconds, slide)
    return windows.withColumn("error_ratio", ratio(F.col("errors"), F.col("total")))


def missing_rate(df: DataFrame, columns: Sequence[str], ts: str, seconds: int) -> DataFrame:
    """Missing share per span and column; wide aggregate first, long form from the few result rows."""
    wide = df.groupBy(pane(ts, seconds).alias("window_start")).agg(
        F.count(F.lit(1)).alias("n"), *[F.count(F.col(c)).alias(c) for c in columns]
    )
    entries = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("present")) for c in columns])
    return wide.select("window_start", "n", F.inline(entries)).select(
        "window_start", "feature", (1.0 - F.col("present") / F.col("n")).alias("missing_rate")
    )


# -- histograms ------------------------------------------------------------------------------------------------


def bucket_arrays(df: DataFrame, value: str | Column, edges: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """One row per group: ``counts[i]`` is the number of values up to ``edges[i]``; the last entry is the total."""
    v = F.col(value) if isinstance(value, str) else value
    cumulative = [F.count_if(v <= float(e)) for e in edges] + [F.count(v)]
    return df.groupBy(*by).agg(F.array(*cumulative).alias("counts"))


def bucket_counts(df: DataFrame, value: str | Column, edges: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Cumulative histogram rows ``(*by, le, n)``; the open bucket has an infinite edge."""
    arrays = bucket_arrays(df, value, edges, by)
    les = F.array(*[F.lit(float(e)) for e in (*edges, float("inf"))])
    return arrays.select(*by, F.inline(F.arrays_zip(les.alias("le"), F.col("counts").alias("n"))))


def bucket_quantile(arrays: DataFrame, edges: Sequence[float], phi: float, by: Sequence[str] = ()) -> DataFrame:
    """Quantile of a bucketed series, linear inside the first bucket that reaches the rank.

    A rank in the open bucket yields the highest edge; the first bucket starts at 0.
    """
    les = F.array(*[F.lit(float(e)) for e in edges])
    n = F.col("counts")
    total = F.element_at(n, -1)
    rank = F.lit(float(phi)) * total
    # Buckets that do not reach the rank come first, as the counts never fall.
    k = F.size(F.filter(n, lambda c: c < rank))
    upper = F.get(les, k)
    lower = F.when(k > 0, F.get(les, k - 1)).otherwise(F.lit(0.0))
    before = F.when(k > 0, F.get(n, k - 1)).otherwise(F.lit(0))
    inside = F.get(n, k) - before
    interpolated = lower + (upper - lower) * ratio(rank - before, inside, default=None)
    value = F.when(total == 0, F.lit(None)).when(k >= len(edges), F.lit(float(edges[-1]))).otherwise(interpolated)
    return arrays.select(*by, value.alias("quantile"))


# -- conditions over time --------------------------------------------------------------------------------------


def sustained(df: DataFrame, time_col: str, condition: Column, hold: int | Column, step: int,
              keys: Sequence[str] = ()) -> DataFrame:
    """Stretches in which ``condition`` holds at every evaluation for at least ``hold`` seconds.

    ``hold`` is a number, or one of the ``keys`` where it differs between them.

    ``df`` has one row per evaluation step and key, so a key has as many rows as there were steps, whatever the
    traffic behind them. Evaluations more than ``step`` seconds apart do not belong to one stretch: a missing one ends it.
    """
    marked = df.select(*keys, F.col(time_col).alias("__t"), F.coalesce(condition, F.lit(False)).alias("__on"))
    order = Window.partitionBy(*keys).orderBy("__t")
    broken = ~F.coalesce(F.lag("__on").over(order), F.lit(False)) | (F.col("__t") - F.lag("__t").over(order) > step)
    starts = marked.withColumn("__new", (F.col("__on") & broken).cast("int"))
    island = F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, 0))
    spans = (
        starts.withColumn("__island", island).where("__on").groupBy(*keys, "__island")
        .agg(F.min("__t").alias("active_since"), F.max("__t").alias("last_true"), F.count(F.lit(1)).alias("steps"))
    )
    held = spans.where(F.col("last_true") - F.col("active_since") >= hold)
    return held.select(*keys, "active_since", (F.col("active_since") + hold).alias("fired_at"), "last_true", "steps")


def evaluate_rules(series: DataFrame, step: int, rules: Sequence[tuple] = ALERT_RULES) -> DataFrame:
    """Firing alerts from ``(metric, labels, t, value)``; ``labels`` is a string naming the series.

    Every sample meets the few rules of its metric in one pass, so the series is computed once for all rules.
    """
    fields = ("alertname", "rule_metric", "op", "threshold", "hold", "severity", "category")
    table = F.array(*[
        F.struct(*[F.lit(float(v) if f == "threshold" else v).alias(f) for f, v in zip(fields, rule)]) for rule in rules
    ])
    judged = series.select("metric", "labels", "t", "value", F.inline(table)).where(F.col("metric") == F.col("rule_metric"))
    value, threshold = F.col("value"), F.col("threshold")
    condition = (
        F.when(F.col("op") == "<", value < threshold).when(F.col("op") == ">", value > threshold).otherwise(value == threshold)
    )
    keys = ["alertname", "severity", "category", "hold", "labels"]
    return sustained(judged, "t", condition, F.col("hold"), step, keys).drop("hold")


def source_silence(df: DataFrame, ts: str, keys: Sequence[str], gap: int) -> DataFrame:
    """Stretches longer than ``gap`` seconds without a row of a source.

    Inside one span of length ``gap`` no such stretch fits, so first and last row per span suffice. A source
    with any number of rows is reduced to its spans before the shuffle.
    """
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    ends = df.groupBy(*keys, pane(ts, gap).alias("__span")).agg(F.min(at).alias("__first"), F.max(at).alias("__last"))
    order = Window.partitionBy(*keys).orderBy("__span")
    following = ends.withColumn("__next", F.lead("__first").over(order))
    silent = (F.col("__next") - F.col("__last")) / 1_000_000
    return following.where(silent > gap).select(
        *keys, F.floor(F.col("__last") / 1_000_000).alias("silent_from"),
        F.floor(F.col("__next") / 1_000_000).alias("silent_until"), silent.alias("silent_seconds"),
    )


# -- alerts ----------------------------------------------------------------------------------------------------


def alert_groups(alerts: DataFrame, time_col: str, keys: Sequence[str] = ("alertname", "category"),
                 repeat: int = 3 * 3600) -> DataFrame:
    """``(*keys, slot, notified_at, n_alerts)``: one notification for the alerts of a group within ``repeat`` seconds.

    The interval starts at the notification, and the next one is due at the first alert after it has run out; ``slot`` counts them
    from 0. From every time there is a pointer to the first one ``repeat`` or more later. The notifications are what is reached from a
    group's first time; pointers are doubled, so their number of rounds is the logarithm of the longest group. Nothing is sorted by more
    than a stretch of ``repeat`` seconds.
    """
    at = F.col(time_col).cast("bigint") if dict(alerts.dtypes)[time_col] in ("int", "smallint", "tinyint") else F.col(time_col)
    group = F.struct(*[F.col(k).alias(k) for k in keys]).alias("k")
    span = lambda t: F.floor(t / repeat)
    times = cut_lineage(alerts.where(F.col(time_col).isNotNull()).groupBy(group, at.alias("t")).agg(F.count(F.lit(1)).alias("n")), "times")
    # The first time at or after t + repeat lies in that moment's span, or is the first one of the next span that has any.
    asked = times.select("k", "t", (F.col("t") + repeat).alias("at"), F.lit(True).alias("asks"))
    known = times.select("k", "t", F.col("t").alias("at"), F.lit(False).alias("asks"))
    later = Window.partitionBy("k", "s").orderBy(F.desc("at"), "asks").rowsBetween(Window.unboundedPreceding, 0)
    both = asked.unionByName(known).withColumn("s", span(F.col("at"))).withColumn("same", F.min(F.when(~F.col("asks"), F.col("at"))).over(later))
    firsts = times.groupBy("k", span(F.col("t")).alias("s")).agg(F.min("t").alias("first"))
    probes = both.where("asks").select("k", "s").distinct().withColumn("first", F.lit(None).cast(times.schema["t"].dataType))
    spans = firsts.unionByName(probes).groupBy("k", "s").agg(F.min("first").alias("first"))
    after = Window.partitionBy("k").orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("k", "s", F.min("first").over(after).alias("beyond"))
    pointers = both.where("asks").join(spans, ["k", "s"]).select("k", "t", F.coalesce("same", "beyond").alias("next")).where("next is not null")
    pointers = cut_lineage(pointers, "pointers")
    told = cut_lineage(times.groupBy("k").agg(F.min("t").alias("t")).withColumn("slot", F.lit(0).cast("bigint")), "told")
    step = 1
    while True:
        more = cut_lineage(told.join(pointers, ["k", "t"]).select("k", F.col("next").alias("t"), (F.col("slot") + step).alias("slot")), "told")
        if more.isEmpty():
            break
        told = cut_lineage(told.unionByName(more), "told")
        far = pointers.select("k", F.col("t").alias("next"), F.col("next").alias("far"))
        pointers = cut_lineage(pointers.join(far, ["k", "next"]).select("k", "t", F.col("far").alias("next")), "pointers")
        step *= 2
    # A notification's alerts lie in its own span and the next one.
    wide = told.withColumnRenamed("t", "notified_at").withColumn("s", F.explode(F.array(span(F.col("notified_at")), span(F.col("notified_at")) + 1)))
    own = wide.join(times.withColumn("s", span(F.col("t"))), ["k", "s"]).where((F.col("t") >= F.col("notified_at")) & (F.col("t") < F.col("notified_at") + repeat))
    return own.groupBy("k", "slot", "notified_at").agg(F.sum("n").alias("n_alerts")).select(
        *[F.col("k")[c].alias(c) for c in keys], "slot", "notified_at", "n_alerts")


@dataclass(frozen=True)
class Route:
    """Where alerts with these values go; ``goes_on`` lets the routes behind it match as well."""

    receiver: str
    match: tuple[tuple[str, str], ...]
    goes_on: bool = False


# Fixed values.
DEFAULT_RECEIVER = "default-receiver"
ROUTES = (
    Route("critical-receiver", (("severity", "critical"),), True),
    Route("drift-receiver", (("severity", "warning"), ("alertname", "FeatureDriftDetected")), True),
)


def route_alerts(alerts: DataFrame, routes: Sequence[Route] = ROUTES, default: str = DEFAULT_RECEIVER) -> DataFrame:
    """Alerts with their ``receiver``, one row for each: routes are tried in order up to the first match that doesn't go on.

    What no route matches goes to the default. A missing value matches nothing.
    """
    open_, receivers = F.lit(True), []
    for r in routes:
        hit = open_
        for column, value in r.match:
            hit = hit & F.coalesce(F.col(column) == value, F.lit(False))
        receivers.append(F.when(hit, F.lit(r.receiver)))
        if not r.goes_on:
            open_ = open_ & ~hit
    found = F.array_compact(F.array(*receivers)) if receivers else F.array().cast("array<string>")
    return alerts.withColumn("receiver", F.explode(F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(default)))))


def retrain_events(alerts: DataFrame, mapping: dict[str, str] = RETRAIN_EVENTS) -> DataFrame:
    """Firing alerts that ask for retraining, with the event they raise; all others are ignored."""
    event = F.lit(None).cast("string")
    for name, raised in mapping.items():
        event = F.when(F.col("alertname") == name, F.lit(raised)).otherwise(event)
    return alerts.where(F.coalesce(F.col("status"), F.lit("firing")) == "firing").withColumn(
        "event_type", event
    ).where(F.col("event_type").isNotNull())
