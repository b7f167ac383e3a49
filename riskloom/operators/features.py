"""Derived features over wide columns or over one array column, and the variance filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom import schema as S
from riskloom.functions.shape import ratio


def array_sum(values: Column) -> Column:
    """Sum of the non-null elements, 0 for none."""
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + F.coalesce(x.cast("double"), F.lit(0.0)))


def array_mean(values: Column) -> Column:
    return ratio(array_sum(values), F.size(F.array_compact(values)), default=None)


def array_std(values: Column) -> Column:
    """Sample deviation of the non-null elements in two folds, 0 for fewer than two."""
    present = F.array_compact(values)
    n = F.size(present)
    mean = array_mean(values)
    squares = F.aggregate(
        F.transform(present, lambda x: x.cast("double") - mean), F.lit(0.0), lambda a, d: a + d * d
    )
    return F.when(n > 1, F.sqrt(squares / (n - 1))).otherwise(F.lit(0.0))


def group_stats(values: Column, name: str) -> list[Column]:
    return [
        array_sum(values).alias(f"{name}_sum"),
        array_mean(values).alias(f"{name}_mean"),
        array_std(values).alias(f"{name}_std"),
    ]


def v_group_columns(columns: Sequence[str], groups: dict[str, tuple[int, int]] = S.V_GROUPS) -> list[Column]:
    """Sum, mean and deviation per V group from separate columns; groups without columns are left out."""
    present = set(columns)
    out = []
    for name, (first, last) in groups.items():
        members = [f"V{i}" for i in range(first, last + 1) if f"V{i}" in present]
        if members:
            out += group_stats(F.array(*[F.col(c).cast("double") for c in members]), name)
    return out


def v_group_slices(array: str, groups: dict[str, tuple[int, int]] = S.V_GROUPS) -> list[Column]:
    """The same from one array column, which keeps the row narrow enough for code generation."""
    out = []
    for name, (first, last) in groups.items():
        out += group_stats(F.slice(F.col(array), first, last - first + 1), name)
    return out


def total_missing(columns: Sequence[str]) -> Column:
    flags = [F.col(c).cast("bigint") for c in columns if c.endswith("_missing")]
    return sum(flags[1:], flags[0]).alias("total_v_missing")


def interaction(a: str, b: str) -> Column:
    return (F.col(a) * F.col(b)).alias(f"{a}_{b}_interact")


def row_sum_mean(columns: Sequence[str], name: str) -> list[Column]:
    """Row-wise sum and mean over the non-null values."""
    values = [F.col(c).cast("double") for c in columns]
    total = sum((F.coalesce(v, F.lit(0.0)) for v in values[1:]), F.coalesce(values[0], F.lit(0.0)))
    count = sum((v.isNotNull().cast("int") for v in values[1:]), values[0].isNotNull().cast("int"))
    return [total.alias(f"{name}_sum"), ratio(total, count, default=None).alias(f"{name}_mean")]


def abs_ratio(numerator: str, denominator: str, eps: float = 1e-6) -> Column:
    return (F.col(numerator) / (F.abs(F.col(denominator)) + F.lit(eps))).alias(f"{numerator}_{denominator}_ratio")


def amount_time_features(amount: str = S.AMOUNT, time_col: str = S.TIME) -> list[Column]:
    """Opt-in: log amount, hour of day and day of week."""
    seconds = F.col(time_col).cast("bigint")
    return [
        F.log1p(F.col(amount)).alias("amount_log1p"),
        F.floor(F.pmod(seconds, F.lit(86400)) / 3600).cast("int").alias("hour"),
        F.pmod(F.floor(seconds / 86400), F.lit(7)).cast("int").alias("day_of_week"),
    ]


def add_features(df: DataFrame) -> DataFrame:
    """Every derived feature whose inputs are present, in one ``select``."""
    present = set(df.columns)
    derived = v_group_columns(df.columns)
    if any(c.endswith("_missing") for c in df.columns):
        derived.append(total_missing(df.columns))
    if {"card1", "card2"} <= present:
        derived.append(interaction("card1", "card2"))
    counts = [f"C{i}" for i in range(1, 15) if f"C{i}" in present]
    if counts:
        derived += row_sum_mean(counts, "C")
    if {"D1", "D15"} <= present:
        derived.append(abs_ratio("D1", "D15"))
    return df.select("*", *derived)


def variances(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, variance)``: population variances from one scan."""
    row = df.agg(*[F.var_pop(F.col(c).cast("double")).alias(c) for c in columns])
    entries = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("variance")) for c in columns])
    return row.select(F.inline(entries))


def variance_filter(df: DataFrame, columns: Sequence[str], min_variance: float = 0.01) -> list[str]:
    """Columns whose population variance exceeds the threshold, in their given order."""
    kept = {r["feature"] for r in variances(df, columns).where(F.col("variance") > min_variance).collect()}
    return [c for c in columns if c in kept]


def array_variances(df: DataFrame, array: str) -> DataFrame:
    """``(position, variance)`` of one array column; positions start at 0. Combined before the shuffle."""
    return (
        df.select(F.posexplode(array).alias("position", "value"))
        .groupBy("position").agg(F.var_pop(F.col("value").cast("double")).alias("variance"))
    )
