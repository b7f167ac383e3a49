"""Class weights, boosted trees, random forests, importances, scoring and model comparison."""

from __future__ import annotations

import tempfile
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler, VectorSizeHint, VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom import schema as S
from riskloom.functions.shape import ratio
from riskloom.operators import boost, metrics
from riskloom.operators.boost import LEAFWISE, TreeConfig
from riskloom.operators.drift import importance_join, topk_shift
from riskloom.operators.digits import exact_quantiles
from riskloom.session import cut_lineage
from riskloom.sources.requests import confidence_band, explode_batch, feature_value

WEIGHT = "class_weight"
VALIDATION = "is_validation"
FEATURES = "features"
TRAINING_ROWS = 200_000  # rows in a partition of the learners
NO_MODEL_PROBABILITY = 0.1  # fixed value: answer without any model


# -- weights and validation rows -------------------------------------------------------------------------------


def class_counts(df: DataFrame, label: str = S.LABEL) -> DataFrame:
    """``n_pos, n_neg, weight`` with ``weight = n_neg / max(n_pos, 1)``."""
    pos, neg = F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)
    return df.agg(pos.alias("n_pos"), neg.alias("n_neg"), (neg / F.greatest(pos, F.lit(1))).alias("weight"))


def class_weight(df: DataFrame, label: str = S.LABEL, cost_ratio: float = 1.0) -> DataFrame:
    """Add a weight column: positives weigh ``n_neg / n_pos * cost_ratio``, negatives 1."""
    base = class_counts(df, label).select("weight").scalar()
    return df.withColumn(WEIGHT, F.when(F.col(label) == 1, base * cost_ratio).otherwise(F.lit(1.0)))


def balanced_weight(df: DataFrame, label: str = S.LABEL) -> DataFrame:
    """Add a weight column with which both classes carry half of the total."""
    n = class_counts(df, label).select(F.struct("n_pos", "n_neg").alias("n")).scalar()
    total = n["n_pos"] + n["n_neg"]
    own = F.when(F.col(label) == 1, n["n_pos"]).otherwise(n["n_neg"])
    return df.withColumn(WEIGHT, total / (2.0 * own))


def validation_tail(df: DataFrame, time_col: str = S.TIME, fraction: float = 0.15) -> DataFrame:
    """Mark the latest ``fraction`` of rows by time for early stopping."""
    cut = exact_quantiles(df, [time_col], [1.0 - fraction]).select("value").scalar()
    return df.withColumn(VALIDATION, F.coalesce(F.col(time_col) > cut, F.lit(False)))


# -- training --------------------------------------------------------------------------------------------------


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Long boosting runs cut their lineage there; a cluster must set ``spark.checkpoint.dir``, a local run may not."""
    if spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir():
        return
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="riskloom-checkpoint-"))


def vectorized(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Turn an array feature column into the vector the learners read; other columns stay."""
    if _is_array(df, features):
        return df.withColumn(features[0], array_to_vector(F.col(features[0]).cast("array<double>")))
    return df


def _is_array(df: DataFrame, features: Sequence[str]) -> bool:
    return len(features) == 1 and isinstance(df.schema[features[0]].dataType, T.ArrayType)


def _assembler(df: DataFrame, features: Sequence[str]) -> PipelineModel:
    """Features to one vector. An array column states its length once, so that streams can be scored as well."""
    stages = []
    if _is_array(df, features):
        size = df.agg(F.max(F.size(features[0])).alias("n")).first()["n"]
        stages.append(VectorSizeHint(inputCol=features[0], size=size, handleInvalid="optimistic"))
    stages.append(VectorAssembler(inputCols=list(features), outputCol=FEATURES, handleInvalid="keep"))
    return PipelineModel(stages=stages)


def _training_columns(df: DataFrame, features: Sequence[str], label: str, *extra: str | None) -> DataFrame:
    named = [c for c in extra if c]
    rows = df.select(*features, F.col(label).cast("double").alias(label), *named)
    # The learners sample by partition. Partitions from the number of rows, and a fixed order in them, give one model on any cores.
    parts = max(8, -(-rows.count() // TRAINING_ROWS))
    dealt = rows.repartition(parts, F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])).sortWithinPartitions(*rows.columns)
    return vectorized(dealt, features)


def train_gbt(df: DataFrame, features: Sequence[str], label: str = S.LABEL, cfg: TreeConfig = TreeConfig(),
              weight: str | None = None, validation: str | None = None) -> PipelineModel:
    """Boosted trees; with a validation column, the prefix of the ensemble with the best average precision on its rows."""
    ensure_checkpoint_dir(df.sparkSession)
    rows = _training_columns(df, features, label, weight, validation)
    assembler = _assembler(df, features)
    model = boost.fit(assembler.transform(rows), FEATURES, label, cfg, weight, validation)
    return PipelineModel(stages=[*assembler.stages, model])


def _forest(df: DataFrame, features: Sequence[str], label: str, trees: int, depth: int, seed: int):
    weighted = balanced_weight(df, label)
    rows = _assembler(df, features).transform(_training_columns(weighted, features, label, WEIGHT))
    return RandomForestClassifier(
        featuresCol=FEATURES, labelCol=label, weightCol=WEIGHT, numTrees=trees, maxDepth=depth, seed=seed
    ).fit(rows)


def feature_names(df: DataFrame, features: Sequence[str]) -> list[str]:
    """Names by vector position; an array column counts as ``<name>_0``, ``<name>_1`` and so on."""
    if _is_array(df, features):
        size = df.agg(F.max(F.size(features[0])).alias("n")).first()["n"] or 0
        return [f"{features[0]}_{i}" for i in range(size)]
    return list(features)


def importance_table(spark: SparkSession, names: Sequence[str], importances) -> DataFrame:
    rows = [(i, n, float(v)) for i, (n, v) in enumerate(zip(names, importances.toArray()))]
    return spark.createDataFrame(rows, "position int, feature string, importance double")


def rf_importance(df: DataFrame, features: Sequence[str], label: str = S.LABEL, trees: int = 50, depth: int = 8,
                  seed: int = 42) -> DataFrame:
    """``(position, feature, importance)`` of a balanced random forest."""
    model = _forest(df, features, label, trees, depth, seed)
    return importance_table(df.sparkSession, feature_names(df, features), model.featureImportances)


def topk_importance(importances: DataFrame, k: int = 50) -> DataFrame:
    return importances.orderBy(F.col("importance").desc(), "feature").limit(k)


def restore_order(top: DataFrame) -> DataFrame:
    """Selected positions in ascending order as one array; at most k numbers."""
    return top.agg(F.sort_array(F.collect_list("position")).alias("positions"))


def train_rf_hybrid(df: DataFrame, features: Sequence[str], label: str = S.LABEL, k: int = 50,
                    cfg: TreeConfig = TreeConfig(), weight: str | None = None, validation: str | None = None,
                    trees: int = 100, forest_depth: int = 10) -> PipelineModel:
    """A forest picks the ``k`` most important features, boosted trees are trained on those alone."""
    importances = rf_importance(df, features, label, trees, forest_depth, cfg.seed)
    chosen = restore_order(topk_importance(importances, k)).first()["positions"]
    ensure_checkpoint_dir(df.sparkSession)
    rows = _training_columns(df, features, label, weight, validation)
    assembler = _assembler(df, features)
    slicer = VectorSlicer(inputCol=FEATURES, outputCol="selected", indices=chosen)
    model = boost.fit(slicer.transform(assembler.transform(rows)), "selected", label, cfg, weight, validation)
    return PipelineModel(stages=[*assembler.stages, slicer, model])


def importance_shift(early: DataFrame, late: DataFrame, features: Sequence[str], label: str = S.LABEL, k: int = 10,
                     trees: int = 30, depth: int = 5) -> DataFrame:
    """Features whose importance moved most between two periods; empty if either period has one class only."""
    tables = []
    for period in (early, late):
        filled = period.select(F.col(label), *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features])
        counts = class_counts(filled, label).first()
        if not counts["n_pos"] or not counts["n_neg"]:
            return early.sparkSession.createDataFrame(
                [], "feature string, early double, late double, delta double"
            )
        tables.append(rf_importance(filled, features, label, trees, depth))
    return topk_shift(importance_join(*tables), k)


# -- scoring ---------------------------------------------------------------------------------------------------


def probability(model: PipelineModel | None, df: DataFrame, features: Sequence[str], output: str = "probability",
                keep: Sequence[str] = ()) -> DataFrame:
    """``(*keep, probability)``; works on batches and on streams."""
    if model is None:
        return df.select(*keep, F.lit(NO_MODEL_PROBABILITY).alias(output))
    rows = vectorized(df.select(*dict.fromkeys([*keep, *features])), features)
    if output in rows.columns:
        raise ValueError(f"column {output} is taken")
    scored = model.transform(rows)
    return scored.select(*keep, vector_to_array("probability")[1].alias(output))


def decide(scored: DataFrame, probability_col: str = "probability", threshold: float = 0.5,
           keep: Sequence[str] = ()) -> DataFrame:
    p = F.col(probability_col)
    return scored.select(
        *keep, F.round(p, 6).alias("fraud_probability"), (p >= threshold).alias("is_fraud"),
        confidence_band(p).alias("confidence"),
    )


def score_batch(model: PipelineModel | None, df: DataFrame, features: Sequence[str], id_col: str,
                threshold: float = 0.5) -> DataFrame:
    """``(id, fraud_probability, is_fraud, confidence)`` for every row."""
    return decide(probability(model, df, features, keep=[id_col]), threshold=threshold, keep=[id_col])


def score_requests(model: PipelineModel | None, requests: DataFrame, json_col: str, features: Sequence[str], keep: Sequence[str] = (),
                   threshold: float = 0.5) -> DataFrame:
    """``(*keep, index, fraud_probability, is_fraud, confidence)`` for every object of JSON arrays of feature maps.

    Features are taken by name; an absent, null or non-numeric one is 0.
    """
    objects = explode_batch(requests, json_col, keep)
    typed = objects.select(*keep, "index", *[feature_value(F.col("features"), n).alias(n) for n in features])
    return decide(probability(model, typed, features, keep=[*keep, "index"]), threshold=threshold, keep=[*keep, "index"])


# -- comparisons -----------------------------------------------------------------------------------------------


def metric_row(model: PipelineModel, test: DataFrame, features: Sequence[str], label: str, name: str,
               fn_cost: float = 10.0, fp_cost: float = 1.0) -> DataFrame:
    # Written, so that the trees are walked once, however many metrics are read off the scores.
    scored = cut_lineage(probability(model, test, features, output="p", keep=[label]), "scores")
    row = metrics.evaluate(scored, label, "p", fn_cost=fn_cost, fp_cost=fp_cost)
    return row.select(
        F.lit(name).alias("model"), *[F.round(c, 4).alias(c) for c in ("precision", "recall", "f1", "auc_roc")],
        "tp", "fp", "fn", "tn", "business_cost",
    )


def compare(models: dict[str, PipelineModel], test: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """One metric row per model."""
    rows = [metric_row(m, test, features, label, name) for name, m in models.items()]
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out


def winner(results: DataFrame, metric: str = "recall", name: str = "model") -> DataFrame:
    """Name of the best row; ties go to the smaller name."""
    best = F.min_by(F.struct(name, metric), F.struct(-F.col(metric), F.col(name)))
    return results.agg(best.alias("best")).select("best.*")


def cost_comparison(results: DataFrame, standard: str, sensitive: str, per_tp: float = 500.0,
                    per_fp: float = 20.0) -> DataFrame:
    """Recall gained, cost saved and net values of cost-sensitive over standard training."""
    valued = metrics.business_value(results, per_tp, per_fp)

    def of(model: str, column: str) -> Column:
        return F.max(F.when(F.col("model") == model, F.col(column)))

    return valued.agg(
        F.round(of(sensitive, "recall") - of(standard, "recall"), 4).alias("delta_recall"),
        (of(standard, "business_cost") - of(sensitive, "business_cost")).alias("delta_cost"),
        of(standard, "net_value").alias("standard_net_value"), of(sensitive, "net_value").alias("sensitive_net_value"),
    )


def positive_share(df: DataFrame, label: str) -> DataFrame:
    return df.agg(ratio(F.count_if(F.col(label) == 1), F.count(label)).alias("rate"))
