"""Classification metrics over a deterministic score, and model selection helpers."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from riskloom.operators import features, learn, metrics, prepare, registry
from riskloom.plans.fixtures import TX_SQL, scored, table, tx
from riskloom.plans.registry import query
from riskloom.plans.prepare_queries import halves

CELLS_SQL = TX_SQL + """
, cells as (select count(*) filter (score >= 0.5 and y = 1) as tp, count(*) filter (score >= 0.5 and y = 0) as fp,
                   count(*) filter (score < 0.5 and y = 1) as fn, count(*) filter (score < 0.5 and y = 0) as tn from scored)
"""
GROUPED_SQL = TX_SQL + """
, h as (select score, sum(y)::double as pos, sum(1 - y)::double as neg from scored group by score),
up as (select *, sum(neg) over (order by score) as cum_neg from h),
down as (select *, sum(pos) over (order by score desc) as tp, sum(neg) over (order by score desc) as fp from h),
tot as (select sum(pos) as p, sum(neg) as n from h)
"""


def cells(spark, sf):
    return metrics.confusion(scored(spark, sf), "y", "score")


@query("confusion", CELLS_SQL + "select * from cells")
def _(spark, sf):
    return cells(spark, sf)


@query("prf_metrics", CELLS_SQL + """
select *, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) as precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) as recall,
       round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) as f1, round(fp / greatest(fp + tn, 1), 6) as fpr
from cells""")
def _(spark, sf):
    out = metrics.prf(cells(spark, sf))
    return out.select("tp", "fp", "fn", "tn", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1", "fpr")])


@query("specificity", CELLS_SQL + "select tp, fp, fn, tn, round(1 - fp / greatest(fp + tn, 1), 6) as specificity from cells")
def _(spark, sf):
    return metrics.specificity(cells(spark, sf)).withColumn("specificity", F.round("specificity", 6))


@query("business_cost", CELLS_SQL + "select tp, fp, fn, tn, 10.0::double * fn + fp as business_cost from cells")
def _(spark, sf):
    return metrics.business_cost(cells(spark, sf))


@query("business_value", CELLS_SQL + """
select tp, fp, fn, tn, tp * 500.0::double as fraud_loss_saved, fp * 20.0::double as false_alarm_cost,
       tp * 500.0::double - fp * 20.0::double as net_value from cells""")
def _(spark, sf):
    return metrics.business_value(cells(spark, sf))


@query("auc_roc", GROUPED_SQL + """
select round(sum(pos * (cum_neg - 0.5::double * neg)) / (sum(pos) * sum(neg)), 6) as auc_roc from up""")
def _(spark, sf):
    return metrics.auc_roc(scored(spark, sf), "y", "score").select(F.round("auc_roc", 6).alias("auc_roc"))


@query("auc_roc_by_segment", TX_SQL + """
, h as (select pemail, score, sum(tx.y)::double as pos, sum(1 - tx.y)::double as neg
        from scored join tx using (tid) group by 1, 2),
up as (select *, sum(neg) over (partition by pemail order by score) as cum_neg from h)
select pemail, round(sum(pos * (cum_neg - 0.5::double * neg)) / (sum(pos) * sum(neg)), 6) as auc_roc from up group by pemail""")
def _(spark, sf):
    return metrics.auc_roc(scored(spark, sf, "pemail"), "y", "score", ["pemail"]).withColumn("auc_roc", F.round("auc_roc", 6))


@query("avg_precision", GROUPED_SQL + "select round(sum(pos * tp / (tp + fp)) / sum(pos), 6) as avg_precision from down")
def _(spark, sf):
    out = metrics.avg_precision(scored(spark, sf), "y", "score")
    return out.select(F.round("avg_precision", 6).alias("avg_precision"))


@query("roc_curve", GROUPED_SQL + """
select score as threshold, round(fp / n, 6) as fpr, round(tp / p, 6) as tpr from down, tot
union all select 'infinity'::double, 0, 0""")
def _(spark, sf):
    out = metrics.roc_curve(scored(spark, sf), "y", "score")
    return out.select("threshold", F.round("fpr", 6).alias("fpr"), F.round("tpr", 6).alias("tpr"))


@query("pr_curve", GROUPED_SQL + """
select score as threshold, round(tp / (tp + fp), 6) as precision, round(tp / p, 6) as recall, round(p / (p + n), 6) as baseline
from down, tot union all select null, 1, 0, round(p / (p + n), 6) from tot""")
def _(spark, sf):
    out = metrics.pr_curve(scored(spark, sf), "y", "score")
    return out.select("threshold", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "baseline")])


@query("score_histogram", TX_SQL + """
, lim as (select y, min(score) as lo, max(score) as hi from scored group by y)
select scored.y as label, cast(least(floor((score - lo) / (hi - lo) * 50), 49) as int) as bin, count(*) as n
from scored join lim on scored.y = lim.y group by 1, 2""")
def _(spark, sf):
    return metrics.score_histogram(scored(spark, sf), "y", "score")


@query("score_histogram_fixed", TX_SQL + """
select y as label, cast(least(floor(score / 1.0::double * 10), 9) as int) as bin, count(*) as n from scored group by 1, 2""")
def _(spark, sf):
    return metrics.score_histogram(scored(spark, sf), "y", "score", 10, 0.0, 1.0)


@query("evaluation", GROUPED_SQL + """
, cells as (select count(*) filter (score >= 0.5 and y = 1) as tp, count(*) filter (score >= 0.5 and y = 0) as fp,
                   count(*) filter (score < 0.5 and y = 1) as fn, count(*) filter (score < 0.5 and y = 0) as tn from scored)
select tp, fp, fn, tn, round(tp / nullif(tp + fn, 0), 4) as recall, 10.0::double * fn + fp as business_cost,
  (select round(sum(pos * (cum_neg - 0.5::double * neg)) / (sum(pos) * sum(neg)), 4) from up) as auc_roc,
  (select round(sum(pos * tp / (tp + fp)) / sum(pos), 4) from down) as avg_precision,
  round((tp + fn) / (tp + fp + fn + tn), 6) as positive_rate
from cells""")
def _(spark, sf):
    out = metrics.evaluate(scored(spark, sf), "y", "score")
    return out.select("tp", "fp", "fn", "tn", F.round("recall", 4).alias("recall"), "business_cost",
                      F.round("auc_roc", 4).alias("auc_roc"), F.round("avg_precision", 4).alias("avg_precision"),
                      F.round("positive_rate", 6).alias("positive_rate"))


@query("batch_rate", TX_SQL + """
select count(*) as n_transactions, round(count(*) filter (score >= 0.5) / count(*), 4) as fraud_rate from scored""")
def _(spark, sf):
    flagged = scored(spark, sf).select((F.col("score") >= 0.5).alias("is_fraud"))
    return metrics.batch_rate(flagged, "is_fraud")


# -- selection -------------------------------------------------------------------------------------------------

POSITION_SQL = """
with imp as (
  select cast(p - 1 as int) as position, 'f' || lpad(cast(p - 1 as varchar), 2, '0') as feature,
         round(var_pop(x::double), 10) as importance
  from (select unnest(embedding) as x, unnest(range(1, 65)) as p from embeddings) group by 1, 2),
top as (select * from imp order by importance desc, feature limit 10)
"""


def position_importance(spark, sf):
    rows = features.array_variances(table(spark, sf, "embeddings"), "embedding")
    return rows.select(
        "position", F.concat(F.lit("f"), F.lpad(F.col("position").cast("string"), 2, "0")).alias("feature"),
        F.round("variance", 10).alias("importance"),
    )


@query("topk_importance", POSITION_SQL + "select position, feature, importance from top")
def _(spark, sf):
    return learn.topk_importance(position_importance(spark, sf), 10)


@query("restore_order", POSITION_SQL + """
select cast(row_number() over (order by position) as int) as rank, position from top""")
def _(spark, sf):
    ordered = learn.restore_order(learn.topk_importance(position_importance(spark, sf), 10))
    ranked = ordered.select(F.posexplode("positions").alias("rank", "position"))
    return ranked.select((F.col("rank") + 1).alias("rank"), "position")


def variants(spark, sf):
    """Metric rows of the score at three thresholds, as stand-ins for three models."""
    rows = scored(spark, sf)
    out = None
    for name, threshold in (("strict", 0.5), ("medium", 0.3), ("wide", 0.2)):
        row = metrics.business_cost(metrics.prf(metrics.confusion(rows, "y", "score", threshold)))
        row = row.select(F.lit(name).alias("model"), "recall", "tp", "fp", "business_cost")
        out = row if out is None else out.unionByName(row)
    return out


VARIANT_SQL = TX_SQL + ", var as (" + " union all ".join(
    f"""select '{name}' as model, count(*) filter (score >= {t} and y = 1) as tp, count(*) filter (score >= {t} and y = 0) as fp,
        count(*) filter (score < {t} and y = 1) as fn from scored""" for name, t in
    (("strict", 0.5), ("medium", 0.3), ("wide", 0.2))) + ")"


@query("winner", VARIANT_SQL + """
select model, round(tp / (tp + fn), 6) as recall from var order by tp / (tp + fn) desc, model limit 1""")
def _(spark, sf):
    return learn.winner(variants(spark, sf)).withColumn("recall", F.round("recall", 6))


@query("cost_delta", VARIANT_SQL + """
select round(b.tp / (b.tp + b.fn) - a.tp / (a.tp + a.fn), 4) as delta_recall,
       (10.0::double * a.fn + a.fp) - (10.0::double * b.fn + b.fp) as delta_cost,
       a.tp * 500.0::double - a.fp * 20.0::double as standard_net_value,
       b.tp * 500.0::double - b.fp * 20.0::double as sensitive_net_value
from var a, var b where a.model = 'strict' and b.model = 'wide'""")
def _(spark, sf):
    return learn.cost_comparison(variants(spark, sf), "strict", "wide")


@query("class_weight_col", TX_SQL + """
, w as (select (count(*) - sum(y)) / sum(y) * 10 as spw from train)
select tid, y, round(case when y = 1 then spw else 1 end, 6) as class_weight from train, w""")
def _(spark, sf):
    train, _ = halves(spark, sf, "tid", "y")
    out = learn.class_weight(train, "y", 10.0)
    return out.select("tid", "y", F.round(learn.WEIGHT, 6).alias("class_weight"))


@query("validation_tail", TX_SQL + """
, v as (select quantile_cont(dt, 0.85) as v_dt from train)
select dt > v_dt as is_validation, count(*) as n, cast(sum(y) as bigint) as positives, min(dt) as first_dt
from train, v group by 1""")
def _(spark, sf):
    train, _ = halves(spark, sf, "y")
    return learn.validation_tail(train, "dt").groupBy("is_validation").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("positives"), F.min("dt").alias("first_dt")
    )


# -- gate and registry -----------------------------------------------------------------------------------------

RUNS_SQL = TX_SQL + """
, runs as (select row_number() over (order by pemail) as version, pemail as model, '/models/' || pemail as path,
                  round(0.8::double + sum(y) / count(*), 4) as fraud_recall, round(avg(amt) / 1000000, 4) as auc_roc
           from tx where pemail is not null group by pemail)
"""


def runs(spark, sf):
    rows = tx(spark, sf, "y", "amt", "pemail").where(F.col("pemail").isNotNull()).groupBy("pemail").agg(
        F.round(F.lit(0.8) + F.sum("y") / F.count(F.lit(1)), 4).alias("fraud_recall"),
        F.round(F.avg("amt") / 1000000, 4).alias("auc_roc"),
    )
    # One row per segment, as in a registry.
    version = rows.withColumn("version", F.row_number().over(Window.orderBy("pemail")).cast("bigint"))
    return version.select("version", F.col("pemail").alias("model"), F.concat(F.lit("/models/"), "pemail").alias("path"),
                          "fraud_recall", "auc_roc")


@query("deploy_gate", RUNS_SQL + """
select model, fraud_recall, case when fraud_recall >= 0.85 then 'deployed' else 'rejected' end as status,
       0.85::double as recall_threshold,
       case when fraud_recall >= 0.85 then 'recall_reached' else 'recall_too_low' end as message
from runs""")
def _(spark, sf):
    out = registry.deploy_gate(runs(spark, sf))
    return out.select("model", "fraud_recall", "status", F.col("recall_threshold").cast("double").alias("recall_threshold"),
                      "message")


@query("registry_promote", RUNS_SQL + """
, d as (select *, case when fraud_recall >= 0.85 then 'deployed' else 'rejected' end as status from runs),
r as (select *, row_number() over (partition by status order by version desc) as k from d)
select version, model, status, case when status = 'rejected' then 'rejected' when k = 1 then 'champion' else 'archived' end
       as state from r""")
def _(spark, sf):
    decided = registry.deploy_gate(runs(spark, sf))
    columns = ["version", "model", "path", "fraud_recall", "auc_roc", "status", "message"]
    history = decided.where(F.col("version") <= 2).select(*columns)
    state = registry.promote(history, decided.where(F.col("version") > 2))
    return state.select("version", "model", "status", "state")


@query("temporal_split_sketch")
def _(spark, sf):
    rows = prepare.with_split(tx(spark, sf, "y", "dt"), "dt", exact=False)
    return rows.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
