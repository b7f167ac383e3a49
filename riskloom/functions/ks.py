"""P-values of the two-sample Kolmogorov-Smirnov statistic as column expressions."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

TERMS = 100


def asymptotic(d: Column, n: Column, m: Column) -> Column:
    """Kolmogorov series at ``d * sqrt(nm / (n + m))``. Below 0.2 the series has not converged, and p is 1."""
    n, m = n.cast("double"), m.cast("double")
    z = d * F.sqrt(n * m / (n + m))
    terms = F.transform(
        F.sequence(F.lit(1), F.lit(TERMS)),
        lambda k: F.when(k % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0)) * F.exp(F.lit(-2.0) * k * k * z * z),
    )
    series = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
    return F.when(z < 0.2, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))


def _band_probability(d: float, n: int, m: int) -> float:
    """Share of monotone lattice paths from (0, 0) to (n, m) that reach a distance of ``d`` from the diagonal.

    Paths that stay inside the band are counted one row at a time: a row is the running sum of the row above
    it. Each row is scaled to a maximum of 1, and the logarithm of the scale is kept beside it.
    """
    if d <= 0:
        return 1.0
    limit = np.rint(d * n * m) - 0.5  # distances are multiples of 1 / (n m)
    j = np.arange(m + 1)
    paths = np.where(j * n < limit, 1.0, 0.0)
    log_scale = 0.0
    for i in range(1, n + 1):
        paths = np.cumsum(np.where(np.abs(i * m - j * n) < limit, paths, 0.0))
        paths[np.abs(i * m - j * n) >= limit] = 0.0
        top = paths.max()
        if top <= 0.0:
            return 1.0
        paths /= top
        log_scale += np.log(top)
    if paths[m] <= 0.0:
        return 1.0
    log_all = math.lgamma(n + m + 1) - math.lgamma(n + 1) - math.lgamma(m + 1)
    return float(min(1.0, max(0.0, -math.expm1(np.log(paths[m]) + log_scale - log_all))))


@F.pandas_udf(DoubleType())
def exact(d: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    """Exact two-sided p-value, one per feature, in n * m steps; null where a sample is empty."""
    out = []
    for x, a, b in zip(d, n, m):
        known = pd.notna(x) and pd.notna(a) and pd.notna(b) and min(a, b) > 0
        out.append(_band_probability(float(x), int(a), int(b)) if known else None)
    return pd.Series(out, dtype="float64")


def equal_sizes(d: Column, n: Column) -> Column:
    """Closed form for two samples of the same size: alternating sum of C(2n, n - kh) / C(2n, n), h = round(d n).

    The quotient of binomials is the product of (n - j + i) / (n + i) over i = 1..j with j = kh.
    """
    h = F.round(d * n).cast("int")

    def term(k: Column) -> Column:
        j = k * h
        quotient = F.aggregate(
            F.sequence(F.lit(1), j), F.lit(1.0),
            lambda a, i: a * ((n - j + i).cast("double") / (n + i).cast("double")),
        )
        return F.when(k % 2 == 1, quotient).otherwise(-quotient)

    top = F.greatest(F.floor(n / F.greatest(h, F.lit(1))).cast("int"), F.lit(1))
    total = F.aggregate(F.transform(F.sequence(F.lit(1), top), term), F.lit(0.0), lambda a, x: a + x)
    return F.when(h <= 0, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2.0 * total)))


def ks_pvalue(d: Column, n: Column, m: Column, method: str = "asymptotic") -> Column:
    """Two-sided p-value, 'asymptotic' or 'exact'. The method is the caller's choice at every sample size."""
    if method not in ("asymptotic", "exact"):
        raise ValueError(f"unknown method {method}")
    return asymptotic(d, n, m) if method == "asymptotic" else exact(d, n.cast("bigint"), m.cast("bigint"))
