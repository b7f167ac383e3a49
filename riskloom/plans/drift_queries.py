"""Distribution drift, performance over time and retraining."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions.ks import equal_sizes, ks_pvalue
from riskloom.operators import drift, prepare, retrain
from riskloom.plans.data_queries import PROFILE_SQL
from riskloom.plans.fixtures import DAILY_SQL, TX_SQL, daily_models, scored, table, tx
from riskloom.plans.registry import query
from riskloom.plans.prepare_queries import halves

DRIFT_COLUMNS = ("amt", "card1", "card2", "d1", "d15", "v1", "v3", "v5")
LINE_FEATURES = ("l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                 "l_orderkey")

KS_TAIL_SQL = """
, n as (select feature, sum(1 - cur) as n_ref, sum(cur) as n_cur, avg(value) filter (cur = 0) as ref_mean,
               avg(value) filter (cur = 1) as cur_mean from long where value is not null group by feature),
h as (select feature, value, sum(1 - cur) as r, sum(cur) as c from long where value is not null group by 1, 2),
cdf as (select feature, value, sum(r) over w as cr, sum(c) over w as cc from h
        window w as (partition by feature order by value)),
ks as (select feature, max(abs(cr / n_ref - cc / n_cur)) as d, any_value(n_ref)::double as n_ref,
              any_value(n_cur)::double as n_cur, any_value(ref_mean) as ref_mean, any_value(cur_mean) as cur_mean
       from cdf join n using (feature) group by feature),
pv as (select *, d * sqrt(n_ref * n_cur / (n_ref + n_cur)) as z from ks),
scores as (
  select feature, round(d, 4) as ks_statistic,
         round(case when z < 0.2 then 1.0::double else greatest(0, least(1, list_sum(list_transform(range(1, 101),
           lambda k: (case when k % 2 = 1 then 2.0::double else -2.0::double end) * exp(-2.0::double * k * k * z * z))))) end, 6) as p_value,
         round(ref_mean, 4) as ref_mean, round(cur_mean, 4) as curr_mean, n_ref, n_cur, d from pv)
"""
TX_LONG_SQL = TX_SQL + ", long as (" + " union all ".join(
    f"select '{c}' as feature, {c}::double as value, case when dt <= cut_dt then 0 else 1 end as cur from tx, cut"
    for c in DRIFT_COLUMNS) + ")"
LINE_LONG_SQL = ("with lcut as (select quantile_cont(epoch(l_shipdate)::double, 0.7) as at_ from lineitem), long as ("
                 + " union all ".join(
                     f"select '{c}' as feature, {c}::double as value, "
                     "case when epoch(l_shipdate)::double <= at_ then 0 else 1 end as cur from lineitem, lcut"
                     for c in LINE_FEATURES) + ")")


def flagged_tx(spark, sf):
    df = tx(spark, sf, "dt", *DRIFT_COLUMNS)
    cut = prepare.split_point(df, "dt", 0.2)
    return df.withColumn(drift.CURRENT, F.when(F.col("dt") <= cut, 0).otherwise(1)).drop("dt")


@query("ref_profile", PROFILE_SQL + """
select feature, round(mean, 4) as mean, round(std, 4) as std, round(p5, 4) as p5, round(p25, 4) as p25,
       round(p50, 4) as p50, round(p75, 4) as p75, round(p95, 4) as p95, n from prof""")
def _(spark, sf):
    train, _ = halves(spark, sf, "amt", "card1", "v1", "v4")
    out = drift.ref_profile(train, ["amt", "card1", "v1", "v4"])
    return out.select("feature", *[F.round(c, 4).alias(c) for c in out.columns if c not in ("feature", "n")], "n")


@query("ks_two_sample", TX_LONG_SQL + KS_TAIL_SQL + """
select feature, round(d, 8) as ks_statistic, cast(n_ref as bigint) as n_ref, cast(n_cur as bigint) as n_cur from scores""")
def _(spark, sf):
    ks = drift.ks_between(flagged_tx(spark, sf), DRIFT_COLUMNS)
    return ks.select("feature", F.round("ks_statistic", 8).alias("ks_statistic"), "n_ref", "n_cur")


@query("ks_lineitem", LINE_LONG_SQL + KS_TAIL_SQL + """
select feature, ks_statistic, p_value, p_value < 0.05 as drifted, ref_mean, curr_mean from scores""")
def _(spark, sf):
    shipped = F.unix_seconds(F.col("l_shipdate").cast("timestamp")).cast("double").alias("shipped")
    df = table(spark, sf, "lineitem").select(*LINE_FEATURES, shipped)
    late = (F.col("shipped") > prepare.split_point(df, "shipped", 0.3)).cast("int")
    ks = drift.ks_between(df.select(*LINE_FEATURES, late.alias(drift.CURRENT)), LINE_FEATURES)
    return drift.feature_scores(ks, method="asymptotic")


@query("ks_pvalue", TX_LONG_SQL + KS_TAIL_SQL + "select feature, p_value, p_value < 0.05 as drifted from scores")
def _(spark, sf):
    ks = drift.ks_between(flagged_tx(spark, sf), DRIFT_COLUMNS)
    return drift.feature_scores(ks, method="asymptotic").select("feature", "p_value", "drifted")


@query("ks_pvalue_exact", TX_LONG_SQL + KS_TAIL_SQL + """
, e as (select feature, cast(round(d * 500) as int) as h from scores),
p as (select feature, round(case when h = 0 then 1.0::double else greatest(0, least(1, 2 * list_sum(list_transform(
        range(1, 500 // greatest(h, 1) + 1), lambda k: (case when k % 2 = 1 then 1.0::double else -1.0::double end)
        * exp(2 * lgamma(501) - lgamma(501 - k * h) - lgamma(501 + k * h)))))) end, 6) as p_closed from e)
select feature, p_closed, p_closed as p_paths from p""")
def _(spark, sf):
    """The statistic, cut to steps of 1/500, judged as if it came from two samples of 500: both exact forms agree."""
    ks = drift.ks_between(flagged_tx(spark, sf), DRIFT_COLUMNS)
    step = F.round(F.col("ks_statistic") * 500) / 500
    return ks.select(
        "feature", F.round(equal_sizes(step, F.lit(500)), 6).alias("p_closed"),
        F.round(ks_pvalue(step, F.lit(500), F.lit(500), "exact"), 6).alias("p_paths"),
    )


@query("drift_report", TX_LONG_SQL + KS_TAIL_SQL + """
select count(*) as n_features_checked, count(*) filter (p_value < 0.05) as n_drifted_features,
       coalesce(string_agg(feature, ',' order by feature) filter (p_value < 0.05), '') as drifted_features,
       max(ks_statistic) as max_ks_statistic, bool_or(p_value < 0.05) as drift_detected from scores where n_ref >= 10 and n_cur >= 10""")
def _(spark, sf):
    train, test = halves(spark, sf, *DRIFT_COLUMNS)
    out = drift.drift_report(train, test, DRIFT_COLUMNS, method="asymptotic")
    return out.withColumn("drifted_features", F.array_join("drifted_features", ","))


@query("recommendation", LINE_LONG_SQL + KS_TAIL_SQL + """
select max(ks_statistic) as max_ks_statistic, bool_or(p_value < 0.05) as drift_detected,
       case when max(ks_statistic) > 0.25 then 'retrain'
            when bool_or(p_value < 0.05) then 'watch'
            else 'none' end as recommendation from scores""")
def _(spark, sf):
    shipped = F.unix_seconds(F.col("l_shipdate").cast("timestamp")).cast("double").alias("shipped")
    early, late = prepare.temporal_split(table(spark, sf, "lineitem").select(*LINE_FEATURES, shipped), "shipped", 0.3)
    out = drift.recommendation(drift.drift_report(early, late, LINE_FEATURES, method="asymptotic"))
    return out.select("max_ks_statistic", "drift_detected", "recommendation")


WINDOW_SQL = TX_SQL + """
, span as (select min(dt) as lo, (max(dt) - min(dt)) // 5 as w from tx),
win as (select cast(least((dt - lo) // w + 1, 5) as int) as k, lo, w, y, score from scored, span),
h as (select k, score, sum(y)::double as pos, sum(1 - y)::double as neg from win group by 1, 2),
up as (select *, sum(neg) over (partition by k order by score) as cum_neg from h),
auc as (select k, sum(pos * (cum_neg - 0.5::double * neg)) / nullif(sum(pos) * sum(neg), 0) as auc from up group by k),
perf as (
  select win.k as "window", any_value(lo) + (win.k - 1) * any_value(w) as t_start, any_value(lo) + win.k * any_value(w) as t_end,
         count(*) as n_samples, round(sum(y) / count(*), 4) as fraud_rate,
         round(coalesce(count(*) filter (y = 1 and score >= 0.5) / nullif(sum(y), 0), 0), 4) as recall,
         round(coalesce(any_value(auc), 0), 4) as auc_roc
  from win join auc on win.k = auc.k group by win.k having count(*) >= 50 and sum(y) >= 5)
"""


@query("window_performance", WINDOW_SQL + "select * from perf")
def _(spark, sf):
    return drift.window_performance(scored(spark, sf, "dt"), "dt", "y", "score")


@query("performance_drop", WINDOW_SQL + """
select min_by(recall, "window") as first_recall, max_by(recall, "window") as last_recall,
       count(*) >= 2 and min_by(recall, "window") - max_by(recall, "window") > 0.05 as performance_drop from perf""")
def _(spark, sf):
    return drift.performance_drop(drift.window_performance(scored(spark, sf, "dt"), "dt", "y", "score"))


@query("topk_shift", TX_SQL + """
, e as (select productcd as feature, avg(amt) / 1000000 as importance from train group by 1),
l as (select productcd as feature, avg(amt) / 1000000 as importance from test group by 1)
select feature, round(e.importance, 6) as early, round(l.importance, 6) as late,
       round(l.importance - e.importance, 6) as delta from e join l using (feature)
order by abs(round(l.importance - e.importance, 6)) desc, feature limit 3""")
def _(spark, sf):
    train, test = halves(spark, sf, "amt", "productcd")
    weight = (F.avg("amt") / 1000000).alias("importance")
    tables = [x.groupBy(F.col("productcd").alias("feature")).agg(weight) for x in (train, test)]
    return drift.topk_shift(drift.importance_join(*tables), 3)


# -- retraining ------------------------------------------------------------------------------------------------

POLICY_SQL = {
    "threshold_only": "recall < 0.8 or ks_score > 0.15",
    "periodic_only": "days >= 7",
    "hybrid": "recall < 0.8 or ks_score > 0.15 or days >= 7",
}


def fold_sql(name, compat):
    """Day by day: ``days`` is the counter the policy sees, ``c`` the counter after the day."""
    seen = lambda c: c if compat else f"{c} + 1"
    policy = lambda c: POLICY_SQL[name].replace("days", f"({seen(c)})")
    return f"""
, num as (select *, row_number() over (partition by model_id order by day) as i from daily),
fold as (
  select model_id, day, recall, ks_score, i, {seen('0')} as seen, {policy('0')} as retrained,
         case when {policy('0')} then 0 else 1 end as c from num where i = 1
  union all
  select n.model_id, n.day, n.recall, n.ks_score, n.i, {seen('f.c')},
         {policy('f.c').replace('recall', 'n.recall').replace('ks_score', 'n.ks_score')},
         case when {policy('f.c').replace('recall', 'n.recall').replace('ks_score', 'n.ks_score')} then 0 else f.c + 1 end
  from fold f join num n on n.model_id = f.model_id and n.i = f.i + 1)
"""


@query("retrain_policy", DAILY_SQL + """
select model_id, day, recall < 0.8 or ks_score > 0.15 or day >= 7 as retrain,
       case when recall < 0.8 then 'high' when ks_score > 0.15 then 'medium' when day >= 7 then 'scheduled'
            else 'none' end as urgency,
       case when recall < 0.8 then format('recall drop: {:.4f} < 0.8', recall)
            when ks_score > 0.15 then format('drift exceeded: {:.4f} > 0.15', ks_score)
            when day >= 7 then format('periodic: {}d since last retrain', day) else '' end as reason
from daily""")
def _(spark, sf):
    seen = F.col("recall"), F.col("ks_score"), F.col("day")
    rows = daily_models(spark, sf).select("model_id", "day", retrain.retrain_policy(*seen).alias("d"), retrain.retrain_reason(*seen).alias("reason"))
    return rows.select("model_id", "day", "d.retrain", "d.urgency", "reason")


@query("retrain_policy_threshold", DAILY_SQL + """
select model_id, day, recall < 0.8 or ks_score > 0.15 as retrain,
       case when recall < 0.8 or ks_score > 0.15 then 'high' else 'none' end as urgency,
       cast((recall < 0.8)::int + (ks_score > 0.15)::int as int) as n_reasons from daily""")
def _(spark, sf):
    decision = retrain.retrain_policy(F.col("recall"), F.col("ks_score"), F.col("day"), "threshold_only")
    rows = daily_models(spark, sf).select("model_id", "day", decision.alias("d"))
    return rows.select("model_id", "day", "d.retrain", "d.urgency", F.size("d.reasons").alias("n_reasons"))


@query("retrain_fold", DAILY_SQL + fold_sql("hybrid", False) + """
select model_id, day, recall, ks_score, retrained,
       case when not retrained then 'none' when recall < 0.8 then 'high' when ks_score > 0.15 then 'medium' else 'scheduled' end
       as urgency from fold""")
def _(spark, sf):
    return retrain.retrain_fold(daily_models(spark, sf)).drop("retrain_reason")


@query("retrain_fold_compat", DAILY_SQL + fold_sql("periodic_only", True) + """
select model_id, day, retrained from fold""")
def _(spark, sf):
    folded = retrain.retrain_fold(daily_models(spark, sf), "periodic_only", compat=True)
    return folded.select("model_id", "day", "retrained")


def strategy_logs(spark, sf):
    daily = daily_models(spark, sf)
    out = None
    for name in retrain.STRATEGIES:
        log = retrain.retrain_fold(daily, name).select(F.lit(name).alias("strategy"), "day", "recall", "retrained")
        out = log if out is None else out.unionByName(log)
    return out


SUMMARY_SQL = DAILY_SQL + "".join(
    fold_sql(name, False).replace("num as", f"num_{name} as").replace("from num", f"from num_{name}")
    .replace("join num n", f"join num_{name} n").replace("fold as", f"fold_{name} as").replace("from fold f", f"from fold_{name} f")
    for name in POLICY_SQL) + ", summary as (" + " union all ".join(
    f"""select '{name}' as strategy, count(*) filter (retrained) as n_retrains,
        cast(count(*) filter (retrained) as double) as total_cost, round(avg(recall), 4) as avg_recall,
        round(min(recall), 4) as min_recall, round(max(recall), 4) as max_recall, round(stddev_pop(recall), 4) as recall_std,
        count(*) filter (recall < 0.8) as days_below_threshold, round(1 - stddev_pop(recall), 4) as stability_score
        from fold_{name}""" for name in POLICY_SQL) + ")"


@query("daily_log_summary", SUMMARY_SQL + "select * from summary")
def _(spark, sf):
    return retrain.daily_summary(strategy_logs(spark, sf))


@query("strategy_winners", SUMMARY_SQL + """
select (select strategy from summary order by avg_recall desc, strategy limit 1) as best_recall,
       (select strategy from summary order by stability_score desc, strategy limit 1) as most_stable,
       (select strategy from summary order by total_cost, strategy limit 1) as lowest_cost""")
def _(spark, sf):
    return retrain.strategy_winners(retrain.daily_summary(strategy_logs(spark, sf)))
