"""Deployment gate and the append-only model registry."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RECALL_GATE = 0.85  # fixed value
REGISTRY_FIELDS = "version bigint, model string, path string, fraud_recall double, auc_roc double, status string, message string"


def deploy_gate(metrics: DataFrame, min_recall: float = RECALL_GATE) -> DataFrame:
    """``deployed`` where recall reaches the gate, ``rejected`` elsewhere; ``message`` is a code for why, beside the numbers."""
    recall = F.col("fraud_recall")
    passes = F.coalesce(recall, F.lit(0.0)) >= min_recall
    code = F.when(recall.isNull(), "no_recall").when(passes, "recall_reached").otherwise("recall_too_low")
    return metrics.select(
        "*", F.when(passes, "deployed").otherwise("rejected").alias("status"), F.lit(min_recall).alias("recall_threshold"), code.alias("message"))


def registry_state(registry: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """The latest deployed version is the champion, earlier ones are archived, the rest was rejected.

    A registry has one row per decision, so ranking it in one window is fine.
    """
    # Two decisions on one version: the better one counts, then the smaller path.
    order = Window.partitionBy(*keys, F.col("status") == "deployed").orderBy(F.col("version").desc(), F.col("fraud_recall").desc(), "path")
    rank = F.row_number().over(order)
    state = F.when(F.col("status") != "deployed", "rejected").when(rank == 1, "champion").otherwise("archived")
    return registry.withColumn("state", state)


def promote(registry: DataFrame, decision: DataFrame) -> DataFrame:
    """The registry with the decisions appended and every state derived anew."""
    return registry_state(registry.unionByName(decision.select(*registry.columns)))


def champion(registry: DataFrame) -> DataFrame:
    return registry_state(registry).where(F.col("state") == "champion")
