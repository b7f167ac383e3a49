"""Wide to long and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def melt(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (), name: str = "feature",
         value: str = "value") -> DataFrame:
    """One row per (row, column) with the value as double; nulls and NaN are left out."""
    wide = df.select(*keep, *[as_double(c).alias(c) for c in columns])
    long = wide.unpivot(list(keep), list(columns), name, value)
    return long.where(F.col(value).isNotNull())


def as_double(column: str) -> Column:
    """Numeric column as double with NaN read as missing."""
    number = F.col(column).cast("double")
    return F.when(~F.isnan(number), number)


def row_to_long(row: DataFrame, columns: Sequence[str], fields: Sequence[str], name: str = "feature") -> DataFrame:
    """Turn one row of structs, one per column, into rows ``(name, *fields)``."""
    entries = F.array(*[F.struct(F.lit(c).alias(name), *[F.col(c)[f].alias(f) for f in fields]) for c in columns])
    return row.select(F.inline(entries))


def ratio(numerator: Column, denominator: Column, default: float | None = 0.0) -> Column:
    """Division that yields ``default`` on a zero or missing denominator."""
    quotient = numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))
    return quotient if default is None else F.coalesce(quotient, F.lit(float(default)))


def keyed_hash(column: str | Column, seed: int) -> Column:
    """A number below 2**60 from seed and value: the first 15 hex digits of an MD5, which other engines have as well."""
    value = F.col(column) if isinstance(column, str) else column
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(value.cast("string"), F.lit("")))), 1, 15), 16, 10).cast("bigint")
