"""Saving models with their metadata, and loading the champion or the first fallback."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from riskloom.operators.registry import REGISTRY_FIELDS, champion

ABOUT = "about"


def save_model(model: PipelineModel, path: str, kind: str = "", features: Sequence[str] = (), metrics: dict[str, float] | None = None,
               weights: dict[str, float] | None = None) -> None:
    """The model, and beside it what one has to know to use it: kind, features in order, class weights and metrics."""
    model.write().overwrite().save(path)
    about = {"kind": kind, "features": list(features), "weights": weights or {}, "metrics": metrics or {}}
    spark = SparkSession.active()
    spark.createDataFrame([(json.dumps(about, sort_keys=True),)], "value string").coalesce(1).write.text(f"{path}/{ABOUT}")


def model_info(spark: SparkSession, path: str) -> dict:
    """Kind, features in order, weights and metrics as they were saved with the model; one line is read."""
    return json.loads(spark.read.text(f"{path}/{ABOUT}").first()["value"])


def append_decision(decision: DataFrame, registry_path: str) -> None:
    """One row per training run; nothing is ever overwritten, so the history survives a crash."""
    columns = [f.split()[0] for f in REGISTRY_FIELDS.split(", ")]
    decision.select(*columns).write.mode("append").parquet(registry_path)


def load_champion(spark: SparkSession, registry_path: str, fallbacks: Sequence[str] = ()) -> PipelineModel | None:
    """The current champion, else the first fallback that loads, else None (scoring then answers a constant)."""
    paths = []
    try:
        row = champion(spark.read.schema(REGISTRY_FIELDS).parquet(registry_path)).select("path").first()
        paths = [row["path"]] if row else []
    except AnalysisException:
        pass
    for path in [*paths, *fallbacks]:
        try:
            spark.read.text(f"{path}/metadata").limit(1).count()
        except AnalysisException:
            continue
        return PipelineModel.load(path)
    return None
