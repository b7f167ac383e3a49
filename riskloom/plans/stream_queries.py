"""Streams over the events table: each runs over all of it and is closed, so the oracles are those of the batch queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import retrain
from riskloom.plans.drift_queries import KS_TAIL_SQL, fold_sql
from riskloom.plans.fixtures import DAILY_SQL, EVENTS_SQL, daily_models, metric_events, scratch, table
from riskloom.plans.learn_queries import TX_FEATURES, trained
from riskloom.plans.monitor_queries import HOURLY_SQL, HOUR
from riskloom.plans.registry import query
from riskloom.streaming import streams

DELAY = "1 hour"


def events_stream(spark, sf):
    stream = streams.table_stream(spark, f"{sf}/events.parquet", table(spark, sf, "events").schema)
    return stream.select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("endpoint"), "user_id",
        F.when(F.col("event_type") == "error", "500").otherwise("200").alias("status"),
        (F.col("value") / (F.col("value") + 50.0)).alias("score"),
    )


def closed_events(spark, sf):
    """The events and what closes them; the closing row has an event time and nothing else."""
    return streams.closed_stream(events_stream(spark, sf), "ts", "closing")


@query("stream_counts", EVENTS_SQL + f"""
select sec - sec % {HOUR} as window_start, endpoint, count(*) as n, count(*) filter (score >= 0.5) as detected from ev
group by 1, 2""")
def _(spark, sf):
    detected = F.count_if(F.col("score") >= 0.5)
    events, close = closed_events(spark, sf)
    return streams.run_available(
        streams.windowed_counts(events, "ts", "1 hour", DELAY, ["endpoint"], detected=detected), "counts", close=close
    )


@query("live_recall_fpr", EVENTS_SQL + f"""
, labelled as (select *, case when event_id % 7 <> 3 then status end as known from ev)
select sec - sec % 86400 as window_start, count(*) filter (score >= 0.5 and known = '500') as tp,
       count(*) filter (score >= 0.5 and known <> '500') as fp, count(*) filter (score < 0.5 and known = '500') as fn,
       count(*) filter (score < 0.5 and known <> '500') as tn, count(*) filter (known is null) as unlabelled,
       round(tp / nullif(tp + fn, 0), 6) as recall, round(fp / nullif(fp + tn, 0), 6) as fpr
from labelled group by 1""")
def _(spark, sf):
    """One in seven events never gets a label."""
    events, close_scores = closed_events(spark, sf)
    closing_id = F.coalesce("event_id", F.lit(-1))
    scores = events.select(closing_id.alias("event_id"), F.col("ts").alias("scored_at"), F.col("score").alias("probability"))
    later = F.col("ts") + F.make_dt_interval(mins=(F.coalesce("event_id", F.lit(0)) % 50).cast("int"))
    events, close_labels = closed_events(spark, sf)
    labels = events.where(F.col("event_id").isNull() | (F.col("event_id") % 7 != 3)).select(
        closing_id.alias("event_id"), later.alias("labelled_at"), (F.col("status") == "500").cast("int").alias("y")
    )

    def close():
        close_scores()
        close_labels()

    out = streams.run_available(streams.live_recall(scores, labels, "event_id", "1 day", DELAY), "recall", close=close)
    return out.withColumns({c: F.round(c, 6) for c in ("recall", "fpr")})


@query("score_stream")
def _(spark, sf):
    model, _, test = trained(spark, sf)
    folder = scratch(spark, "requests")
    test.select("tid", *TX_FEATURES).write.parquet(folder)
    source = streams.file_stream(spark, folder, "*.parquet", spark.read.parquet(folder).schema)
    return streams.run_available(streams.score_stream(model, source, TX_FEATURES, "tid"), "scored")


@query("drift_stream", """
with base as (select value / (value + 50.0::double) as score, user_id::double as user_id, ts from events),
long as (select 'score' as feature, score as value, 1 as cur from base union all select 'user_id', user_id, 1 from base
  union all select 'score', score, 0 from base where ts < timestamp '2024-01-11'
  union all select 'user_id', user_id, 0 from base where ts < timestamp '2024-01-11')
""" + KS_TAIL_SQL + "select feature, ks_statistic, p_value, p_value < 0.05 as drifted, ref_mean, curr_mean from scores")
def _(spark, sf):
    reference = metric_events(spark, sf).where(F.col("ts") < F.lit("2024-01-11").cast("timestamp"))
    scores = streams.drift_stream(
        events_stream(spark, sf), reference, ["score", "user_id"], scratch(spark, "gauges"), "asymptotic"
    )
    return scores.drop("batch")


@query("drift_window_stream", """
with base as (select value / (value + 50.0::double) as score, user_id::double as user_id, ts,
                     cast(floor(epoch_us(ts) / 1000000) as bigint) // 432000 * 432000 as w from events),
cells as (select 'score' as f, score as value, w, ts from base union all select 'user_id', user_id, w, ts from base),
long as (select f || ':' || w as feature, value, 1 as cur from cells
  union all select c.f || ':' || x.w, c.value, 0 from cells c, (select distinct w from base) x where c.ts < timestamp '2024-01-11')
""" + KS_TAIL_SQL + """
select split_part(feature, ':', 1) as feature, split_part(feature, ':', 2)::bigint as window_start, ks_statistic, p_value, p_value < 0.05 as drifted,
       ref_mean, curr_mean from scores""")
def _(spark, sf):
    """Five days at a time against the first ten days."""
    reference = metric_events(spark, sf).where(F.col("ts") < F.lit("2024-01-11").cast("timestamp"))
    events, close = closed_events(spark, sf)
    return streams.window_drift_stream(events, "ts", "5 days", DELAY, reference, ["score", "user_id"], scratch(spark, "windows"), close=close)


@query("alert_stream", HOURLY_SQL + f"""
select 'error_ratio' as metric, active_since, active_since + {2 * HOUR} as fired_at from spans
where last_true - active_since >= {2 * HOUR}""")
def _(spark, sf):
    errors = F.count_if(F.col("status") == "500")
    events, close = closed_events(spark, sf)
    hourly = streams.windowed_counts(events, "ts", "1 hour", DELAY, errors=errors)
    steps = hourly.select(
        F.lit("error_ratio").alias("metric"), F.col("window_start").alias("t"),
        (F.col("errors") / F.col("n") > 0.25).alias("on"),
    )
    return streams.run_available(streams.alert_stream(steps, ["metric"], 2 * HOUR, HOUR, "metric string"), "alerts", close=close)


@query("silence_stream", """
with g as (select event_type as endpoint, epoch_us(ts) as us,
                  lead(epoch_us(ts)) over (partition by event_type order by ts) as nxt from events)
select endpoint, cast(floor(us / 1000000) as bigint) as silent_from from g where nxt - us > 7200::bigint * 1000000""")
def _(spark, sf):
    return streams.run_available(
        streams.silence_stream(events_stream(spark, sf), "ts", ["endpoint"], 2 * HOUR, DELAY, "endpoint string"), "silence"
    )


@query("first_alert_stream", f"""
with recursive alerts as (
  select 'HighErrorRate' as alertname, 'user' || (user_id % 10) as category, cast(floor(epoch_us(ts) / 1000000) as bigint) as t
  from events where event_type = 'error'),
told as (
  select alertname, category, min(t) as notified_at from alerts group by 1, 2
  union all
  select a.alertname, a.category, min(a.t) from told join alerts a on a.alertname = told.alertname and a.category = told.category
         and a.t >= told.notified_at + {3 * HOUR} group by 1, 2)
select * from told""")
def _(spark, sf):
    events, close = closed_events(spark, sf)
    # The closing row passes the filter, so that it moves the watermark; its own time is never reached.
    alerts = events.where((F.col("status") == "500") | F.col("event_id").isNull()).select(
        F.lit("HighErrorRate").alias("alertname"), F.concat(F.lit("user"), F.col("user_id") % 10).alias("category"), "ts"
    )
    first = streams.first_alerts(alerts, "ts", DELAY, "alertname string, category string")
    return streams.run_available(first, "first", close=close)


@query("retrain_stream", DAILY_SQL + fold_sql("hybrid", False) + "select model_id, day, retrained from fold")
def _(spark, sf):
    folder = scratch(spark, "daily")
    daily_models(spark, sf).write.parquet(folder)
    source = streams.file_stream(spark, folder, "*.parquet", spark.read.parquet(folder).schema)
    urgent = (F.col("recall") < retrain.RECALL_THRESHOLD) | (F.col("ks_score") > retrain.DRIFT_THRESHOLD)
    return streams.run_available(
        streams.retrain_stream(source, ["model_id"], urgent, retrain.PERIOD_DAYS, "model_id string"), "retrain"
    )
