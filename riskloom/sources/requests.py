"""Scoring requests: JSON feature maps to typed rows, by feature name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def feature_map(json_col: str | Column) -> Column:
    """JSON object to ``map<string, string>``; text that is not an object gives null."""
    return F.from_json(json_col, "map<string,string>")


def feature_value(features: Column, name: str) -> Column:
    """A feature as double; absent, null and non-numeric values are 0."""
    number = F.try_element_at(features, F.lit(name)).try_cast("double")
    return F.coalesce(F.when(~F.isnan(number), number), F.lit(0.0))


def parse_requests(df: DataFrame, json_col: str, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One typed column per feature name, taken by name whatever the order in the JSON text."""
    parsed = df.select(*keep, feature_map(json_col).alias("__features"))
    return parsed.select(*keep, *[feature_value(F.col("__features"), n).alias(n) for n in names])


def explode_batch(df: DataFrame, json_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """A JSON array of feature objects to one row per object with its index."""
    parsed = df.select(*keep, F.from_json(json_col, "array<map<string,string>>").alias("__batch"))
    return parsed.select(*keep, F.posexplode("__batch").alias("index", "features"))


def missing_features(df: DataFrame, json_col: str, ts: str) -> DataFrame:
    """Features sent as null, one row each."""
    parsed = df.select(ts, F.explode(feature_map(json_col)).alias("feature", "value"))
    return parsed.where(F.col("value").isNull()).select(ts, "feature")


def pad_select(features: Column, indices: Sequence[int]) -> Column:
    """The elements of an array at ``indices``; if the array is shorter than the selection, the array padded by zeros."""
    n = len(indices)
    chosen = F.array(*[F.get(features, F.lit(i)) for i in indices])
    padded = F.concat(features, F.array_repeat(F.lit(0.0), F.lit(n) - F.size(features)))
    return F.when(F.size(features) >= n, chosen).otherwise(padded)


def confidence_band(probability: str | Column) -> Column:
    p = F.col(probability) if isinstance(probability, str) else probability
    return F.when(p >= 0.8, "high").when(p >= 0.5, "medium").otherwise("low")
