"""Scans with declared schemas, missing-value normalisation, sinks, fitted tables and the metric log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom import schema as S


def read_transactions(spark: SparkSession, path: str, fmt: str = "parquet",
                      schema: T.StructType | None = None) -> DataFrame:
    """Scan with a declared schema; CSV gets a header and no inference pass. Parquet may bring its own schema."""
    if fmt == "csv":
        return spark.read.schema(schema or S.transaction_schema()).csv(path, header=True)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.format(fmt).load(path)


def read_identity(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_transactions(spark, path, fmt, S.identity_schema() if fmt == "csv" else None)


def normalize_nulls(df: DataFrame, tokens: Sequence[str] = S.NULL_TOKENS) -> DataFrame:
    """NaN in numbers and the usual tokens in text become NULL, in one ``select``."""
    def clean(field: T.StructField):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            return F.when(~F.isnan(c), c).alias(field.name)
        if isinstance(field.dataType, T.StringType):
            return F.when(~F.trim(c).isin(*tokens), c).alias(field.name)
        return c

    return df.select(*[clean(f) for f in df.schema.fields])


def join_identity(transactions: DataFrame, identity: DataFrame, key: str = S.KEY) -> DataFrame:
    """Keep every transaction; identity columns are null where there is none."""
    return transactions.join(identity, key, "left")


def write_dataset(df: DataFrame, path: str, partition_by: Sequence[str] = ("split",), mode: str = "overwrite") -> None:
    """Parquet, one folder per split, so that reading one split reads only its files."""
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """JSON of a report; reports have a handful of rows, so one file is right."""
    df.coalesce(1).write.mode("overwrite").json(path)


class FitTables:
    """Fitted tables of one preparation, one Parquet folder each."""

    @staticmethod
    def save(fitted: dict[str, DataFrame], path: str) -> None:
        for name, table in fitted.items():
            table.write.mode("overwrite").parquet(f"{path}/{name}")

    @staticmethod
    def load(spark: SparkSession, path: str, names: Sequence[str]) -> dict[str, DataFrame]:
        return {name: spark.read.parquet(f"{path}/{name}") for name in names}


def metric_rows(df: DataFrame, run_id: str, stage: str) -> DataFrame:
    """``(run_id, stage, metric, value)``: one row per numeric or boolean column of a one-row report."""
    kept = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.NumericType, T.BooleanType))]
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in kept])
    return wide.unpivot([], kept, "metric", "value").select(
        F.lit(run_id).alias("run_id"), F.lit(stage).alias("stage"), "metric", "value"
    )


def log_metrics(df: DataFrame, path: str, run_id: str, stage: str) -> None:
    metric_rows(df, run_id, stage).write.mode("append").partitionBy("stage").parquet(path)
