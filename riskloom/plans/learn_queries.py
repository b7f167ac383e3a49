"""Training, scoring, comparison and attribution on the transaction view and on the embeddings, with the default settings.

What trains can't be written in SQL. The ``*_holds`` queries check what must hold of the results whatever the model.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from riskloom.functions.shape import ratio
from riskloom.operators import attribution, learn, neighbours, prepare, registry
from riskloom.plans import stages
from riskloom.plans.data_queries import wide_names
from riskloom.plans.fixtures import TX_SQL, identity, scratch, table, tx
from riskloom.plans.prepare_queries import halves
from riskloom.plans.registry import QUERIES, query
from riskloom.session import cut_lineage
from riskloom.sources import models, requests

TX_FEATURES = ("amt", "card2", "d1", "d15", "addr2", "urgent", "open")
EMBEDDING = ("embedding",)


def labelled_tx(spark, sf):
    """Training and test rows with numeric features only, written once for all passes of the learners."""
    df = tx(spark, sf, "tid", "y", "dt", "amt", "productcd", "card2", "addr2", "m1", "d1", "d15").select(
        "tid", "y", "dt", "amt",
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("card2", "d1", "d15", "addr2")],
        (F.col("productcd") == "1-URGENT").cast("double").alias("urgent"),
        (F.col("m1") == "F").cast("int").alias("_open"),
        ((F.xxhash64("tid") % 4) == 0).alias("_hidden"),
    )
    # A quarter of the open flags is hidden, so that the label cannot be read off the features.
    df = df.withColumn("open", F.when(F.col("_hidden"), 0.0).otherwise(F.coalesce(F.col("_open"), F.lit(2)).cast("double")))
    written = cut_lineage(prepare.with_split(df.drop("_open", "_hidden"), "dt"), "labelled")
    return tuple(written.where(F.col("split") == s) for s in ("train", "test"))


def embedding_rows(spark, sf):
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), "embedding", (F.col("label") == 0).cast("int").alias("y")
    )


def embedding_split(spark, sf):
    """Training rows, and every fifth row, which is only scored."""
    rows = embedding_rows(spark, sf)
    return rows.where(F.col("id") % 5 != 0), rows.where(F.col("id") % 5 == 0)


def gbt_on_tx(spark, sf, cfg=learn.TreeConfig(), ratio=10.0):
    """A model of the transaction view, stopped on its latest training rows, and the rows it was trained on and those it was not."""
    train, test = labelled_tx(spark, sf)
    rows = learn.validation_tail(learn.class_weight(train, "y", ratio), "dt")
    return learn.train_gbt(rows, TX_FEATURES, "y", cfg, learn.WEIGHT, learn.VALIDATION), train, test


def embedding_validation(rows):
    """Weights, and the rows with the largest ids for early stopping."""
    return learn.validation_tail(learn.class_weight(rows, "y"), "id")


def ensemble_holds(spark, model, cfg, n, positives):
    """What the settings promise of an ensemble, and that the prefix kept is the best of those tried."""
    gbt = attribution.gbt_stage(model)
    run, kept, scores = gbt.getOrDefault("roundsRun"), gbt.getNumTrees, gbt.getOrDefault("precisions")
    leaves = [int((t["feature"] < 0).sum()) for t in gbt.unpacked()]
    return spark.createDataFrame([(
        n, positives, len(scores) == run and kept == scores.index(max(scores)) + 1, run == cfg.rounds or run - kept >= cfg.patience,
        1 <= max(leaves) <= (cfg.leaves or 2 ** cfg.depth),
    )], "n long, positives long, best_prefix boolean, waited boolean, leaves_bounded boolean")


HELD_OUT = "select count(*) as n, cast(sum(y) as bigint) as positives, true as best_prefix, true as waited, true as leaves_bounded from test"


@query("train_gbt")
def _(spark, sf):
    model, _, test = gbt_on_tx(spark, sf)
    return learn.compare({"gbt": model}, test, TX_FEATURES, "y")


@query("train_gbt_holds", TX_SQL + HELD_OUT)
def _(spark, sf):
    model, _, test = gbt_on_tx(spark, sf)
    row = learn.compare({"gbt": model}, test, TX_FEATURES, "y").first()
    return ensemble_holds(spark, model, learn.TreeConfig(), row["tp"] + row["fp"] + row["fn"] + row["tn"], row["tp"] + row["fn"])


@query("train_gbt_leafwise")
def _(spark, sf):
    model, _, test = gbt_on_tx(spark, sf, learn.LEAFWISE)
    return learn.compare({"gbt_leafwise": model}, test, TX_FEATURES, "y")


@query("train_gbt_leafwise_holds", TX_SQL + HELD_OUT)
def _(spark, sf):
    model, _, test = gbt_on_tx(spark, sf, learn.LEAFWISE)
    row = learn.compare({"gbt_leafwise": model}, test, TX_FEATURES, "y").first()
    return ensemble_holds(spark, model, learn.LEAFWISE, row["tp"] + row["fp"] + row["fn"] + row["tn"], row["tp"] + row["fn"])


def rf_hybrid(spark, sf):
    train, test = embedding_split(spark, sf)
    return learn.train_rf_hybrid(embedding_validation(train), EMBEDDING, "y", 50, weight=learn.WEIGHT, validation=learn.VALIDATION), test


@query("train_rf_hybrid")
def _(spark, sf):
    model, test = rf_hybrid(spark, sf)
    return learn.compare({"rf_hybrid": model}, test, EMBEDDING, "y")


@query("train_rf_hybrid_holds", """
select count(*) as n, cast(sum((label = 0)::int) as bigint) as positives, true as best_prefix, true as waited, true as leaves_bounded, 50 as chosen
from embeddings where vec_id % 5 = 0""")
def _(spark, sf):
    model, test = rf_hybrid(spark, sf)
    row = learn.compare({"rf_hybrid": model}, test, EMBEDDING, "y").first()
    holds = ensemble_holds(spark, model, learn.TreeConfig(), row["tp"] + row["fp"] + row["fn"] + row["tn"], row["tp"] + row["fn"])
    return holds.withColumn("chosen", F.lit(len(set(attribution.selected_names(model, learn.feature_names(test, EMBEDDING))))))


@query("rf_importance")
def _(spark, sf):
    train, _ = labelled_tx(spark, sf)
    return learn.rf_importance(train, TX_FEATURES, "y")


@query("importance_shift")
def _(spark, sf):
    early, late = labelled_tx(spark, sf)
    return learn.importance_shift(early, late, TX_FEATURES, "y")


@query("importance_shift_holds", TX_SQL + """
select 7 as n, true as sums_to_zero, true as is_difference, true as in_order from train having count(*) > 0""")
def _(spark, sf):
    """Importances of either period sum to 1, so the moves sum to 0; the largest moves come first."""
    moved = [abs(r["delta"]) for r in QUERIES["importance_shift"](spark, sf).collect()]  # k rows
    return QUERIES["importance_shift"](spark, sf).agg(
        F.count(F.lit(1)).cast("int").alias("n"), (F.abs(F.sum("delta")) < 1e-4).alias("sums_to_zero"),
        F.bool_and(F.abs(F.col("late") - F.col("early") - F.col("delta")) < 1e-5).alias("is_difference"),
    ).withColumn("in_order", F.lit(moved == sorted(moved, reverse=True)))


@query("smote", TX_SQL + """
, c as (select cast(sum((label = 0)::int) as bigint) as pos, cast(sum((label <> 0)::int) as bigint) as neg from embeddings)
select 0 as label, false as synthetic, neg as n from c union all select 1, false, pos from c
union all select 1, true, neg - pos from c""")
def _(spark, sf):
    rows = neighbours.smote(embedding_rows(spark, sf), "embedding", "y", "id")
    return rows.groupBy("label", "synthetic").agg(F.count(F.lit(1)).alias("n"))


@query("smote_points")
def _(spark, sf):
    rows = neighbours.smote(embedding_rows(spark, sf), "embedding", "y", "id").where("synthetic")
    return rows.select("id", F.round(F.get("vec", F.lit(0)), 6).alias("first"), F.size("vec").alias("dims"))


@query("nearest_neighbours", """
with v as (select vec_id, embedding::double[] as e from embeddings where label = 0),
d as (select a.vec_id as id, b.vec_id as nbr, list_distance(a.e, b.e) as dist from v a join v b on a.vec_id <> b.vec_id),
r as (select *, row_number() over (partition by id order by dist, nbr) as rank from d)
select id, nbr, round(dist, 6) as dist, cast(rank as int) as rank from r where rank <= 5""")
def _(spark, sf):
    minority = table(spark, sf, "embeddings").where(F.col("label") == 0)
    found = neighbours.nearest_neighbours(minority, "vec_id", "embedding", 5)
    return found.select("id", "nbr", F.round("dist", 6).alias("dist"), "rank")


@query("neighbours_lsh_holds", """
select count(*) as n, true as five_each, true as recall_reached, true as same_distances from embeddings""")
def _(spark, sf):
    """Hashing finds at least 90 % of the exact neighbours of all vectors, five for everyone, at the same distances."""
    rows = table(spark, sf, "embeddings")
    near = cut_lineage(neighbours.nearest_neighbours(rows, "vec_id", "embedding", 5, method="lsh"), "hashed")
    exact = cut_lineage(neighbours.nearest_neighbours(rows, "vec_id", "embedding", 5), "exact")
    both = exact.join(near.select("id", "nbr", F.col("dist").alias("found")), ["id", "nbr"], "left")
    each = both.groupBy("id").agg(F.count("found").alias("hits"), F.bool_and(F.col("found").isNull() | (F.abs(F.col("found") - F.col("dist")) < 1e-9)).alias("same"))
    return each.join(near.groupBy("id").agg(F.count(F.lit(1)).alias("k")), "id").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(F.col("k") == 5).alias("five_each"), (F.avg(F.col("hits") / 5.0) >= 0.9).alias("recall_reached"),
        F.bool_and("same").alias("same_distances"),
    )


@query("smote_points_holds", """
select sum((label <> 0)::int) - sum((label = 0)::int) as n, true as even, true as on_segment from embeddings""")
def _(spark, sf):
    """Every synthetic point lies between its base and one of the base's five nearest positives; bases serve equally often."""
    rows = cut_lineage(embedding_rows(spark, sf).where("y = 1").select("id", F.col("embedding").cast("array<double>").alias("x")), "positives")
    made = cut_lineage(neighbours.smote(embedding_rows(spark, sf), "embedding", "y", "id").where("synthetic").select("id", F.col("vec").alias("v")), "made")
    made = made.withColumn("row", F.monotonically_increasing_id())
    near = neighbours.nearest_neighbours(rows, "id", "x", 5).select("id", "nbr")
    length = lambda a, b: F.sqrt(F.aggregate(F.zip_with(a, b, lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda t, e: t + e))
    tried = made.join(near, "id").join(rows, "id").join(rows.select(F.col("id").alias("nbr"), F.col("x").alias("z")), "nbr")
    excess = length("x", "v") + length("v", "z") - length("x", "z")
    points = tried.groupBy("row", "id").agg((F.min(excess) < 1e-6).alias("between"))
    bases = points.groupBy("id").agg(F.count(F.lit(1)).alias("times"), F.bool_and("between").alias("between"))
    return bases.agg(F.sum("times").alias("n"), (F.max("times") - F.min("times") <= 1).alias("even"), F.bool_and("between").alias("on_segment"))


def trained(spark, sf):
    return gbt_on_tx(spark, sf, ratio=1.0)


@query("score_batch")
def _(spark, sf):
    model, _, test = trained(spark, sf)
    return learn.score_batch(model, test, TX_FEATURES, "tid")


@query("score_batch_holds", TX_SQL + """
select count(*) as n, count(distinct tid) as ids, true as decided, true as banded, true as in_range from test""")
def _(spark, sf):
    model, _, test = trained(spark, sf)
    p = F.col("fraud_probability")
    return learn.score_batch(model, test, TX_FEATURES, "tid").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("tid").alias("ids"),
        # The decision is taken before rounding, so a score that rounds to the threshold may go either way.
        F.bool_and((F.col("is_fraud") == (p >= 0.5)) | (p == 0.5)).alias("decided"),
        F.bool_and((F.col("confidence") == requests.confidence_band(p)) | p.isin(0.5, 0.8)).alias("banded"),
        F.bool_and(p.between(0, 1)).alias("in_range"),
    )


@query("model_comparison_holds", TX_SQL + " union all ".join(f"""
select '{m}' as model, count(*) as n, cast(sum(y) as bigint) as positives, true as cost_agrees, true as in_range from test"""
    for m in ("gbt", "gbt_leafwise", "rf_hybrid")))
def _(spark, sf):
    return comparison_holds(cut_lineage(QUERIES["model_comparison"](spark, sf), "results"))


@query("model_io_holds", TX_SQL + """
select count(*) as n, true as same_scores, 'gbt' as kind, 'amt,card2,d1,d15,addr2,urgent,open' as features from test""")
def _(spark, sf):
    """A loaded model scores as the saved one, and says what it is."""
    model, _, test = trained(spark, sf)
    path = f"{scratch(spark, 'saved')}/model"
    models.save_model(model, path, "gbt", TX_FEATURES, {"rounds": float(attribution.gbt_stage(model).getNumTrees)})
    about = models.model_info(spark, path)
    before = learn.score_batch(model, test, TX_FEATURES, "tid").select("tid", F.col("fraud_probability").alias("saved"))
    after = learn.score_batch(PipelineModel.load(path), test, about["features"], "tid")
    return before.join(after, "tid").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(F.col("saved") == F.col("fraud_probability")).alias("same_scores"),
    ).select("*", F.lit(about["kind"]).alias("kind"), F.lit(",".join(about["features"])).alias("features"))


@query("rf_importance_holds", TX_SQL + """
select 7 as n, count(*) > 0 as sums_to_one, true as positive, 'addr2,amt,card2,d1,d15,open,urgent' as features, 'urgent' as largest from train""")
def _(spark, sf):
    table_ = QUERIES["rf_importance"](spark, sf)
    return table_.agg(
        F.count(F.lit(1)).alias("n"), (F.abs(F.sum("importance") - 1) < 1e-9).alias("sums_to_one"),
        F.bool_and(F.col("importance") >= 0).alias("positive"), F.array_join(F.sort_array(F.collect_list("feature")), ",").alias("features"),
        F.max_by("feature", "importance").alias("largest"),
    )


@query("score_requests", """
with b as (select event_id // 7 as batch, event_id from events)
select batch, row_number() over (partition by batch order by event_id) - 1 as index, 0.1::double as fraud_probability,
       false as is_fraud, 'low' as confidence, 0.0::double as batch_rate from b""")
def _(spark, sf):
    """Requests of up to seven feature maps each, answered while no model is loaded, with the share of positives per request."""
    events = table(spark, sf, "events").select(F.floor(F.col("event_id") / 7).alias("batch"), "event_id", "props")
    ordered = F.array_sort(F.collect_list(F.struct("event_id", "props")))
    bodies = events.groupBy("batch").agg(F.concat(F.lit("["), F.array_join(F.transform(ordered, lambda x: x["props"]), ","), F.lit("]")).alias("body"))
    scored = learn.score_requests(None, bodies, "body", ["k"], ["batch"])
    rate = scored.groupBy("batch").agg(F.avg(F.col("is_fraud").cast("double")).alias("batch_rate"))
    return scored.join(rate, "batch")


@query("score_without_model", TX_SQL + """
select tid, 0.1::double as fraud_probability, false as is_fraud, 'low' as confidence from tx""")
def _(spark, sf):
    return learn.score_batch(None, tx(spark, sf, "tid", "amt"), ["amt"], "tid")


@query("attribution_report")
def _(spark, sf):
    model, _, test = trained(spark, sf)
    return attribution.attribution(model, test, TX_FEATURES, TX_FEATURES, "tid")


@query("mean_abs_attribution")
def _(spark, sf):
    model, train, _ = trained(spark, sf)
    return attribution.mean_abs_attribution(attribution.shap_values(model, train, TX_FEATURES, "tid"), TX_FEATURES)


@query("topk_attribution")
def _(spark, sf):
    model, train, _ = trained(spark, sf)
    return attribution.attribution(model, train, TX_FEATURES, TX_FEATURES, "tid", method="native", k=5)


@query("attribution_holds", TX_SQL + """
select count(*) as n, true as adds_up, 7 as features, true as in_order, true as native_sums_to_one from test""")
def _(spark, sf):
    """Base and contributions of every row add up to its log-odds; the report is sorted, native importances are shares."""
    model, _, test = trained(spark, sf)
    values = cut_lineage(attribution.shap_values(model, test, TX_FEATURES, "tid"), "shap")
    p = learn.probability(model, test, TX_FEATURES, "p", keep=["tid"])
    total = F.col("base") + F.aggregate("phi", F.lit(0.0), lambda a, x: a + x)
    report = [r["mean_abs_shap"] for r in attribution.topk_attribution(attribution.mean_abs_attribution(values, TX_FEATURES)).collect()]
    native = attribution.native_importance(model, test, TX_FEATURES).agg(F.sum("mean_abs_shap").alias("s")).first()["s"]
    return values.join(p.withColumnRenamed("tid", "id"), "id").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(F.abs(total - F.ln(F.col("p") / (1 - F.col("p")))) < 1e-6).alias("adds_up"),
    ).select("*", F.lit(len(report)).alias("features"), F.lit(report == sorted(report, reverse=True)).alias("in_order"),
             F.lit(abs(native - 1) < 1e-9).alias("native_sums_to_one"))


@query("permutation_importance")
def _(spark, sf):
    model, _, test = trained(spark, sf)
    return attribution.permutation_importance(model, test, TX_FEATURES, "y", "tid")


@query("seeded_sample", TX_SQL + """
select tid, amt from tx order by ('0x' || substr(md5('42:' || tid::varchar), 1, 15))::bigint, tid limit 1000""")
def _(spark, sf):
    return attribution.seeded_sample(tx(spark, sf, "tid", "amt"), "tid", 1000)


@query("model_comparison")
def _(spark, sf):
    train, test = labelled_tx(spark, sf)
    rows = cut_lineage(learn.validation_tail(learn.class_weight(train, "y"), "dt"), "weighted")
    marks = learn.WEIGHT, learn.VALIDATION
    return learn.compare({
        "gbt": learn.train_gbt(rows, TX_FEATURES, "y", learn.TreeConfig(), *marks),
        "gbt_leafwise": learn.train_gbt(rows, TX_FEATURES, "y", learn.LEAFWISE, *marks),
        "rf_hybrid": learn.train_rf_hybrid(rows, TX_FEATURES, "y", 5, learn.TreeConfig(), *marks),
    }, test, TX_FEATURES, "y")


@query("imbalance_comparison")
def _(spark, sf):
    train, test = embedding_split(spark, sf)
    rows = cut_lineage(embedding_validation(train), "weighted")
    made = neighbours.smote(rows.where(~F.col(learn.VALIDATION)), "embedding", "y", "id")
    # The rows for early stopping stay as they are.
    balanced = cut_lineage(made.select(F.col("vec").alias("embedding"), F.col("label").alias("y"), F.lit(False).alias(learn.VALIDATION)).unionByName(
        rows.where(learn.VALIDATION).select(F.col("embedding").cast("array<double>"), "y", learn.VALIDATION)), "smote")
    return learn.compare({
        "class_weight": learn.train_gbt(rows, EMBEDDING, "y", learn.TreeConfig(), learn.WEIGHT, learn.VALIDATION),
        "smote": learn.train_gbt(balanced, EMBEDDING, "y", learn.TreeConfig(), None, learn.VALIDATION),
    }, test, EMBEDDING, "y")


def comparison_holds(results):
    """Confusion counts of all rows held out, and metrics that follow from them."""
    recall = F.round(ratio(F.col("tp"), F.col("tp") + F.col("fn")), 4)
    return results.select(
        "model", (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("n"), (F.col("tp") + F.col("fn")).alias("positives"),
        ((F.col("business_cost") == 10 * F.col("fn") + F.col("fp")) & (F.col("recall") == recall)).alias("cost_agrees"),
        (F.col("auc_roc").between(0, 1) & F.col("precision").between(0, 1)).alias("in_range"),
    )


@query("imbalance_comparison_holds", " union all ".join(f"""
select '{m}' as model, count(*) as n, cast(sum((label = 0)::int) as bigint) as positives, true as cost_agrees, true as in_range
from embeddings where vec_id % 5 = 0""" for m in ("class_weight", "smote")))
def _(spark, sf):
    return comparison_holds(cut_lineage(QUERIES["imbalance_comparison"](spark, sf), "results"))


def cost_results(spark, sf):
    train, test = labelled_tx(spark, sf)
    fit = lambda ratio: learn.train_gbt(
        learn.validation_tail(learn.class_weight(train, "y", ratio), "dt"), TX_FEATURES, "y", learn.TreeConfig(), learn.WEIGHT, learn.VALIDATION)
    return cut_lineage(learn.compare({"standard": fit(1.0), "cost_sensitive": fit(10.0)}, test, TX_FEATURES, "y"), "results")


@query("cost_comparison")
def _(spark, sf):
    return learn.cost_comparison(cost_results(spark, sf), "standard", "cost_sensitive")


@query("cost_comparison_holds", TX_SQL + """
select count(*) as n, true as follows, true as net_follows from test""")
def _(spark, sf):
    """The comparison follows from the confusion counts of both models."""
    results = cost_results(spark, sf)
    rows = {r["model"]: r for r in results.collect()}  # two rows
    a, b = rows["standard"], rows["cost_sensitive"]
    net = lambda r: 500.0 * r["tp"] - 20.0 * r["fp"]
    return learn.cost_comparison(results, "standard", "cost_sensitive").select(
        F.lit(a["tp"] + a["fp"] + a["fn"] + a["tn"]).alias("n"),
        ((F.abs(F.col("delta_recall") - (b["recall"] - a["recall"])) < 1e-4) & (F.col("delta_cost") == a["business_cost"] - b["business_cost"])).alias("follows"),
        ((F.col("standard_net_value") == net(a)) & (F.col("sensitive_net_value") == net(b))).alias("net_follows"),
    )


@query("model_io")
def _(spark, sf):
    model, _, test = trained(spark, sf)
    base = scratch(spark, "registry")
    models.save_model(model, f"{base}/models/1", "gbt", TX_FEATURES)
    recall = learn.compare({"gbt": model}, test, TX_FEATURES, "y").select(
        F.lit(1).cast("bigint").alias("version"), "model", F.lit(f"{base}/models/1").alias("path"),
        F.col("recall").alias("fraud_recall"), "auc_roc",
    )
    models.append_decision(registry.deploy_gate(recall, min_recall=0.0), f"{base}/decisions")
    loaded = models.load_champion(spark, f"{base}/decisions")
    return learn.score_batch(loaded, test, TX_FEATURES, "tid")


@query("class_balance", TX_SQL + "select round(sum(y) / count(*), 6) as rate from train")
def _(spark, sf):
    train, _ = halves(spark, sf, "y")
    return learn.positive_share(train, "y").withColumn("rate", F.round("rate", 6))


@query("all_stages")
def _(spark, sf):
    cfg = stages.StageConfig(min_recall=0.5)
    named = wide_names(tx(spark, sf)).withColumn("TransactionDT", F.col("TransactionDT").cast("bigint"))
    decision = stages.run_stages(named, wide_names(identity(spark, sf)), scratch(spark, "stages"), cfg=cfg)
    return decision.select("model", "fraud_recall", "auc_roc", "status")
