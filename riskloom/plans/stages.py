"""The batch job end to end: check, split, prepare, derive, train, evaluate, gate and register.

A plain driver function. Every stage writes its result to storage, so a failed run leaves what it finished, and the
executors can be lost between stages.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom import schema as S
from riskloom.operators import attribution, features, learn, metrics, neighbours, prepare, quality, registry
from riskloom.session import cut_lineage
from riskloom.sources import models, tables

MODEL_TYPES = ("gbt", "gbt_leafwise", "rf_hybrid")


@dataclass(frozen=True)
class StageConfig:
    model_type: str = "gbt"
    imbalance: str = "class_weight"  # or "smote"
    cost_sensitive: bool = True
    fn_cost: float = 10.0
    fp_cost: float = 1.0
    test_size: float = 0.2
    min_recall: float = registry.RECALL_GATE
    top_features: int = 50
    trees: learn.TreeConfig = field(default_factory=learn.TreeConfig)
    forest_trees: int = 50
    forest_depth: int = 8


def prepared(transactions: DataFrame, identity: DataFrame, cfg: StageConfig) -> tuple[DataFrame, DataFrame, dict]:
    """Training and test rows with every feature; the latest training rows are marked for early stopping first."""
    # Written: the split, the validation cut, the medians and the maps each read it.
    joined = cut_lineage(tables.join_identity(tables.normalize_nulls(transactions), tables.normalize_nulls(identity)), "joined")
    train, test = prepare.temporal_split(joined, test_size=cfg.test_size)
    train, test, fitted = prepare.prepare(learn.validation_tail(train), test, keep=(learn.VALIDATION, S.KEY))
    return features.add_features(train), features.add_features(test), fitted


def balanced(train: DataFrame, names: list[str], cfg: StageConfig) -> DataFrame:
    """Weights, or synthetic positives; the two are never stacked on each other."""
    if cfg.imbalance != "smote":
        ratio = cfg.fn_cost / cfg.fp_cost if cfg.cost_sensitive else 1.0
        return learn.class_weight(train, S.LABEL, ratio)
    # Validation rows stay as they are: only the rows trained on are resampled.
    fit_rows = train.where(~F.col(learn.VALIDATION)).select(
        F.col(S.KEY).cast("bigint").alias("row"), F.array(*[F.col(c).cast("double") for c in names]).alias("vec"), S.LABEL
    )
    made = neighbours.smote(cut_lineage(fit_rows, "minority"), "vec", S.LABEL, "row")
    resampled = made.select(
        *[F.get("vec", F.lit(i)).alias(c) for i, c in enumerate(names)], F.col("label").alias(S.LABEL),
        F.lit(False).alias(learn.VALIDATION),
    )
    held = train.where(learn.VALIDATION).select(*[F.col(c).cast("double").alias(c) for c in names], S.LABEL, learn.VALIDATION)
    return resampled.unionByName(held).withColumn(learn.WEIGHT, F.lit(1.0))


def train_model(train: DataFrame, names: list[str], cfg: StageConfig) -> PipelineModel:
    rows = cut_lineage(balanced(train, names, cfg), "balanced")
    if cfg.model_type == "rf_hybrid":
        return learn.train_rf_hybrid(rows, names, S.LABEL, cfg.top_features, cfg.trees, learn.WEIGHT, learn.VALIDATION,
                                     cfg.forest_trees, cfg.forest_depth)
    if cfg.model_type not in MODEL_TYPES:
        raise ValueError(f"unknown model type {cfg.model_type}; choose one of {', '.join(MODEL_TYPES)}")
    return learn.train_gbt(rows, names, S.LABEL, cfg.trees, learn.WEIGHT, learn.VALIDATION)


def run_stages(transactions: DataFrame, identity: DataFrame, path: str, run: int = 1,
               cfg: StageConfig = StageConfig()) -> DataFrame:
    """Run everything, leaving reports, data, model, metrics and the decision under ``path``; returns the decision.

    A failed quality check is reported and does not stop the run.
    """
    log = f"{path}/metrics"
    run_id = f"run-{run}"
    report = quality.quality_report(transactions, identity)
    tables.write_report(report, f"{path}/{run_id}/quality")
    tables.log_metrics(transactions.sparkSession.read.schema(report.schema).json(f"{path}/{run_id}/quality"), log, run_id, "validate")

    train, test, fitted = prepared(transactions, identity, cfg)
    train = cut_lineage(train, "train")
    tables.FitTables.save(fitted, f"{path}/{run_id}/fitted")
    candidates = [c for c in train.columns if c not in (S.LABEL, S.KEY, learn.VALIDATION)]
    names = features.variance_filter(train, candidates)
    columns = [*names, S.LABEL]
    tables.write_dataset(
        train.select(*columns, F.lit("train").alias("split")).unionByName(test.select(*columns, F.lit("test").alias("split"))),
        f"{path}/{run_id}/features",
    )
    test = transactions.sparkSession.read.parquet(f"{path}/{run_id}/features").where(F.col("split") == "test")

    importance = learn.rf_importance(train, names, S.LABEL, cfg.forest_trees, cfg.forest_depth)
    learn.topk_importance(importance, cfg.top_features).coalesce(1).write.mode("overwrite").json(f"{path}/{run_id}/importance")

    model = train_model(train, names, cfg)
    weights = {str(r[S.LABEL]): float(r["w"]) for r in learn.class_weight(train, S.LABEL, cfg.fn_cost / cfg.fp_cost if cfg.cost_sensitive else 1.0)
               .groupBy(S.LABEL).agg(F.first(learn.WEIGHT).alias("w")).collect()} if cfg.imbalance != "smote" else {}
    models.save_model(model, f"{path}/{run_id}/model", cfg.model_type, names, weights=weights)
    top = attribution.attribution(model, test.withColumn("row", F.monotonically_increasing_id()), names, names, "row")
    top.coalesce(1).write.mode("overwrite").json(f"{path}/{run_id}/attribution")

    scored = cut_lineage(learn.probability(model, test, names, "p", keep=[S.LABEL]), "scored")
    result = cut_lineage(metrics.evaluate(scored, S.LABEL, "p", fn_cost=cfg.fn_cost, fp_cost=cfg.fp_cost), "result")
    tables.log_metrics(result, log, run_id, "evaluate")

    decision = registry.deploy_gate(result.select(
        F.lit(run).cast("bigint").alias("version"), F.lit(cfg.model_type).alias("model"),
        F.lit(f"{path}/{run_id}/model").alias("path"), F.round("recall", 6).alias("fraud_recall"),
        F.round("auc_roc", 6).alias("auc_roc"),
    ), cfg.min_recall)
    models.append_decision(decision, f"{path}/decisions")
    return decision
