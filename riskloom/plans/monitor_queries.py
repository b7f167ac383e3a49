"""Metric streams as batch queries: counts, rates, histograms, sustained alerts, silence and routing."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import drift, monitor
from riskloom.plans.drift_queries import KS_TAIL_SQL
from riskloom.plans.fixtures import EVENTS_SQL, metric_events
from riskloom.plans.registry import query
from riskloom.sources import requests

HOUR = 3600


def pane_sql(seconds):
    return f"(sec - sec % {seconds})"


def sliding_sql(seconds, slide, what, labels=""):
    """Every event counted in each window it belongs to, straight from the definition."""
    comma = f", {labels}" if labels else ""
    return f"""
, spread as (select {pane_sql(slide)} - unnest(range(0, {seconds}, {slide})) as window_start, * from ev),
win as (select window_start{comma}, {what} from spread group by window_start{comma})
"""


@query("request_counts", EVENTS_SQL + f"""
select {pane_sql(HOUR)} as window_start, endpoint, status, count(*) as n from ev group by 1, 2, 3""")
def _(spark, sf):
    return monitor.counts(metric_events(spark, sf), "ts", HOUR, ["endpoint", "status"])


def bucket_sql(value, edges, by, source="ev"):
    rows = [f"select {by}, {e}::double as le, count(*) filter ({value} <= {e}::double) as n from {source} group by {by}"
            for e in edges]
    rows.append(f"select {by}, 'infinity'::double, count({value}) from {source} group by {by}")
    return " union all ".join(rows)


@query("latency_histogram", EVENTS_SQL + bucket_sql("latency", monitor.LATENCY_EDGES, "endpoint"))
def _(spark, sf):
    return monitor.bucket_counts(metric_events(spark, sf), "latency", monitor.LATENCY_EDGES, ["endpoint"])


@query("score_buckets", EVENTS_SQL + bucket_sql("score", monitor.SCORE_EDGES, "endpoint"))
def _(spark, sf):
    return monitor.bucket_counts(metric_events(spark, sf), "score", monitor.SCORE_EDGES, ["endpoint"])


@query("detected_count", EVENTS_SQL + f"""
select {pane_sql(HOUR)} as window_start, count(*) filter (score >= 0.5) as detected, count(*) as n from ev group by 1""")
def _(spark, sf):
    at = monitor.pane("ts", HOUR).alias("window_start")
    return metric_events(spark, sf).groupBy(at).agg(
        F.count_if(F.col("score") >= 0.5).alias("detected"), F.count(F.lit(1)).alias("n")
    )


@query("counter_rate", EVENTS_SQL + sliding_sql(6 * HOUR, HOUR, "count(*) as n", "endpoint") + f"""
select window_start, endpoint, n, round(n / {6 * HOUR}.0::double, 8) as per_second from win""")
def _(spark, sf):
    out = monitor.rate(metric_events(spark, sf), "ts", 6 * HOUR, HOUR, ["endpoint"])
    return out.withColumn("per_second", F.round("per_second", 8))


@query("counter_rate_minutes", EVENTS_SQL + sliding_sql(300, 60, "count(*) as n") + """
select window_start, n, round(n / 300.0::double, 8) as per_second from win""")
def _(spark, sf):
    return monitor.rate(metric_events(spark, sf), "ts", 300, 60).withColumn("per_second", F.round("per_second", 8))


@query("counter_increase", EVENTS_SQL + sliding_sql(HOUR, 600, "count(*) as n", "status") + """
select window_start, status, n from win""")
def _(spark, sf):
    return monitor.increase(metric_events(spark, sf), "ts", HOUR, 600, ["status"])


def quantile_sql(phi):
    """Bucket rows with their predecessors; the first bucket that reaches the rank is interpolated."""
    edges = monitor.LATENCY_EDGES
    return f"""
, b as ({bucket_sql("latency", edges, "endpoint")}),
o as (select *, lag(n, 1, 0) over w as before, lag(le, 1, 0) over w as lower_, max(n) over (partition by endpoint) as total
      from b window w as (partition by endpoint order by le)),
q as (select * from o where n >= {phi}::double * total qualify row_number() over (partition by endpoint order by le) = 1)
select endpoint, {phi}::double as phi, round(case when isinf(le) then {edges[-1]}::double
       else lower_ + (le - lower_) * ({phi}::double * total - before) / (n - before) end, 6) as quantile from q"""


@query("bucket_quantile", EVENTS_SQL + ", p50 as (select * from (" + EVENTS_SQL + quantile_sql(0.5) + ")), p95 as (select * from ("
       + EVENTS_SQL + quantile_sql(0.95) + ")), p99 as (select * from (" + EVENTS_SQL + quantile_sql(0.99) + """))
select * from p50 union all select * from p95 union all select * from p99""")
def _(spark, sf):
    arrays = monitor.bucket_arrays(metric_events(spark, sf), "latency", monitor.LATENCY_EDGES, ["endpoint"])
    out = None
    for phi in (0.5, 0.95, 0.99):
        one = monitor.bucket_quantile(arrays, monitor.LATENCY_EDGES, phi, ["endpoint"]).select(
            "endpoint", F.lit(phi).alias("phi"), F.round("quantile", 6).alias("quantile")
        )
        out = one if out is None else out.unionByName(one)
    return out


@query("error_ratio", EVENTS_SQL + sliding_sql(6 * HOUR, HOUR, "count(*) filter (status = '500') as errors, count(*) as total") + """
select window_start, errors, total, round(errors / total, 6) as error_ratio from win""")
def _(spark, sf):
    out = monitor.error_ratio(metric_events(spark, sf), "ts", 6 * HOUR, HOUR, F.col("status") == "500")
    return out.withColumn("error_ratio", F.round("error_ratio", 6))


@query("missing_rate_window", EVENTS_SQL + f"""
, m as (select {pane_sql(24 * HOUR)} as window_start, nullif(event_id % 3, 0) as a, nullif(endpoint, 'view') as b from ev)
select window_start, 'a' as feature, round(1 - count(a) / count(*), 6) as missing_rate from m group by 1
union all select window_start, 'b', round(1 - count(b) / count(*), 6) from m group by 1""")
def _(spark, sf):
    df = metric_events(spark, sf).select(
        "ts", F.nullif(F.col("event_id") % 3, F.lit(0)).alias("a"), F.nullif(F.col("endpoint"), F.lit("view")).alias("b")
    )
    out = monitor.missing_rate(df, ["a", "b"], "ts", 24 * HOUR)
    return out.withColumn("missing_rate", F.round("missing_rate", 6))


@query("missing_features", EVENTS_SQL + "select event_id % 24 as hour_slot, count(*) as n from ev where endpoint = 'view' group by 1")
def _(spark, sf):
    sent = F.when(F.col("endpoint") == "view", F.lit('{"k": null, "j": 1}')).otherwise(F.lit('{"k": 2}'))
    df = metric_events(spark, sf).select((F.col("event_id") % 24).alias("hour_slot"), sent.alias("body"))
    gone = requests.missing_features(df, "body", "hour_slot")
    return gone.groupBy("hour_slot").agg(F.count(F.lit(1)).alias("n"))


HOURLY_SQL = EVENTS_SQL + f"""
, hourly as (select {pane_sql(HOUR)} as t, count(*) filter (status = '500') / count(*) as ratio from ev group by 1),
isl as (select t, t // {HOUR} - row_number() over (order by t) as g from hourly where ratio > 0.25),
spans as (select min(t) as active_since, max(t) as last_true, count(*) as steps from isl group by g)
"""


def hourly_ratio(spark, sf):
    at = monitor.pane("ts", HOUR).alias("t")
    return metric_events(spark, sf).groupBy(at).agg(
        (F.count_if(F.col("status") == "500") / F.count(F.lit(1))).alias("ratio")
    )


@query("sustained_alert", HOURLY_SQL + f"""
select active_since, active_since + {2 * HOUR} as fired_at, last_true, steps from spans
where last_true - active_since >= {2 * HOUR}""")
def _(spark, sf):
    return monitor.sustained(hourly_ratio(spark, sf), "t", F.col("ratio") > 0.25, 2 * HOUR, HOUR)


RULES = (
    ("HighErrorRate", "error_ratio", ">", 0.25, 2 * HOUR, "critical", "system"),
    ("FeatureDriftDetected", "error_ratio", ">", 0.2, 3 * HOUR, "warning", "data_drift"),
    ("FraudRecallDrop", "recall", "<", 0.5, HOUR, "critical", "model_performance"),
)


def alert_series(spark, sf):
    """Hourly error ratio per user group and hourly share of high scores, as metric series."""
    at = monitor.pane("ts", HOUR).alias("t")
    ev = metric_events(spark, sf).withColumn("labels", F.concat(F.lit("group="), (F.col("user_id") % 3).cast("string")))
    rows = ev.groupBy(at, "labels").agg(
        (F.count_if(F.col("status") == "500") / F.count(F.lit(1))).alias("error_ratio"),
        (F.count_if(F.col("score") >= 0.5) / F.count(F.lit(1))).alias("recall"),
    )
    return rows.unpivot(["t", "labels"], ["error_ratio", "recall"], "metric", "value")


def fired_alerts(spark, sf):
    return monitor.evaluate_rules(alert_series(spark, sf), HOUR, RULES)


def rule_sql(name, metric, op, threshold, hold, severity, category):
    return f"""
select '{name}' as alertname, '{severity}' as severity, '{category}' as category, labels, min(t) as active_since,
       min(t) + {hold} as fired_at, max(t) as last_true, count(*) as steps
from (select *, t // {HOUR} - row_number() over (partition by labels order by t) as g
      from series where metric = '{metric}' and "value" {op} {threshold})
group by labels, g having max(t) - min(t) >= {hold}"""


ALERTS_SQL = EVENTS_SQL + f"""
, agg as (select {pane_sql(HOUR)} as t, 'group=' || (user_id % 3) as labels,
                 count(*) filter (status = '500') / count(*) as e, count(*) filter (score >= 0.5) / count(*) as r
          from ev group by 1, 2),
series as (select t, labels, 'error_ratio' as metric, e as "value" from agg union all select t, labels, 'recall', r from agg),
alerts as (""" + " union all ".join(rule_sql(*r) for r in RULES) + ")"


@query("alert_rules", ALERTS_SQL + "select * from alerts")
def _(spark, sf):
    return fired_alerts(spark, sf)


@query("alert_groups", ALERTS_SQL.replace("with ev", "with recursive ev", 1) + f"""
, told as (
  select alertname, category, min(fired_at) as notified_at from alerts group by 1, 2
  union all
  select a.alertname, a.category, min(a.fired_at) from told join alerts a on a.alertname = told.alertname and a.category = told.category
         and a.fired_at >= told.notified_at + {3 * HOUR} group by 1, 2)
select alertname, category, row_number() over (partition by alertname, category order by notified_at) - 1 as slot, notified_at,
       (select count(*) from alerts a where a.alertname = told.alertname and a.category = told.category
               and a.fired_at >= told.notified_at and a.fired_at < told.notified_at + {3 * HOUR}) as n_alerts
from told""")
def _(spark, sf):
    return monitor.alert_groups(fired_alerts(spark, sf), "fired_at")


@query("alert_routes", ALERTS_SQL + """
select alertname, labels, fired_at, 'critical-receiver' as receiver from alerts where severity = 'critical'
union all select alertname, labels, fired_at, 'drift-receiver' from alerts where severity = 'warning' and alertname = 'FeatureDriftDetected'
union all select alertname, labels, fired_at, 'default-receiver' from alerts
where severity <> 'critical' and not (severity = 'warning' and alertname = 'FeatureDriftDetected')""")
def _(spark, sf):
    return monitor.route_alerts(fired_alerts(spark, sf)).select("alertname", "labels", "fired_at", "receiver")


@query("retrain_events", ALERTS_SQL + """
select alertname, labels, fired_at, case when alertname = 'FraudRecallDrop' then 'model-performance-drop' else 'drift-detected' end
       as event_type from alerts where alertname in ('FraudRecallDrop', 'FeatureDriftDetected', 'SevereFeatureDrift')""")
def _(spark, sf):
    firing = fired_alerts(spark, sf).withColumn("status", F.lit("firing"))
    return monitor.retrain_events(firing).select("alertname", "labels", "fired_at", "event_type")


@query("source_silence", """
with ev as (select event_type as endpoint, epoch_us(ts) as us from events),
g as (select endpoint, us, lead(us) over (partition by endpoint order by us) as nxt from ev)
select endpoint, cast(floor(us / 1000000) as bigint) as silent_from, cast(floor(nxt / 1000000) as bigint) as silent_until,
       round((nxt - us) / 1000000, 6) as silent_seconds from g where nxt - us > 7200::bigint * 1000000""")
def _(spark, sf):
    out = monitor.source_silence(metric_events(spark, sf), "ts", ["endpoint"], 2 * HOUR)
    return out.withColumn("silent_seconds", F.round("silent_seconds", 6))


@query("drift_gauge", """
with long as (select 'latency' as feature, value / 100.0::double as value, case when ts < timestamp '2024-01-21' then 0 else 1 end as cur from events
  union all select 'user_id', user_id::double, case when ts < timestamp '2024-01-21' then 0 else 1 end from events)
""" + KS_TAIL_SQL + """
select feature, ks_statistic, ks_statistic > 0.1 as warning, ks_statistic > 0.25 as critical from scores""")
def _(spark, sf):
    ev = metric_events(spark, sf)
    cut = F.lit("2024-01-21").cast("timestamp")
    ks = drift.ks_two_sample(ev.where(F.col("ts") < cut), ev.where(F.col("ts") >= cut), ["latency", "user_id"])
    stat = F.round("ks_statistic", 4)
    return ks.select("feature", stat.alias("ks_statistic"), (stat > 0.1).alias("warning"), (stat > 0.25).alias("critical"))
