"""Exact quantiles and two-sample distances from counts of digits, in a few passes whose shuffles follow counters, not rows.

A double becomes a 64-bit key of the same order. A pass counts, in every task first, the next DIGIT bits of the keys below some prefixes
of each column; all ranks of all columns share it. For quantiles, the prefix of a rank grows by the digit that holds it. For the
Kolmogorov-Smirnov distance, prefixes are branched and bounded: from the gap of the two distribution functions at the edges of a stretch of
keys, the gap inside differs by the stretch's own mass at most, so only stretches that can beat the best edge are looked into. When few
rows are left under the prefixes, the pass takes all remaining bits and is the last.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.shape import as_double, ratio
from riskloom.session import cut_lineage

DIGIT = 16
#: Bits of a finer look into a stretch that may hold the largest distance, and rows from which on single keys are counted.
FINER, FINER_ROWS = 6, 50_000
#: Under the wanted prefixes with no more rows than this, single keys are counted.
BAND_ROWS = 500_000
#: Distinct counters that a task gathers before it merges them.
GATHERED = 1 << 18
SIDE = "__side"

_TOP = np.uint64(1 << 63)


def keys_of(x: np.ndarray) -> np.ndarray:
    """Unsigned keys in the order of the values; both zeros have one key."""
    bits = (x + 0.0).view(np.uint64)
    return np.where(bits & _TOP, ~bits, bits | _TOP)


def value_of(key: int) -> float:
    """The value of a key."""
    bits = key ^ (1 << 63) if key >> 63 else key ^ ((1 << 64) - 1)
    return float(np.array(bits, np.uint64).view(np.float64))


def narrow(df: DataFrame, columns: Sequence[str], side: str | None = None) -> DataFrame:
    """The columns as c0, c1, ... of doubles, written once: every pass reads them again. NaN counts as missing."""
    flag = [F.col(side).cast("int").alias(SIDE)] if side else []
    return cut_lineage(df.select(*[as_double(c).alias(f"c{i}") for i, c in enumerate(columns)], *flag), "digits")


class _Counters:
    """Counts per (column, prefix, digit) and side, with the smallest and the largest key; merged whenever they become many."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, column: int, prefix: np.ndarray, digit: np.ndarray, key: np.ndarray, side: np.ndarray) -> None:
        ones = np.ones(len(key), np.int64)
        self.parts.append(self._merged(np.full(len(key), column, np.int32), prefix.astype(np.int64), digit, ones - side, ones * side, key, key))
        self.size += len(self.parts[-1][0])
        if self.size > GATHERED:
            self.parts = [self.all()]
            self.size = len(self.parts[0][0])
            if self.size > GATHERED // 2:
                self.size = 0  # they don't merge any further: wait for as many again

    @staticmethod
    def _merged(column, prefix, digit, a, b, low, high):
        order = np.lexsort((digit, prefix, column))
        column, prefix, digit, a, b, low, high = (c[order] for c in (column, prefix, digit, a, b, low, high))
        new = np.concatenate([[True], (np.diff(column) != 0) | (np.diff(prefix) != 0) | (digit[1:] != digit[:-1])]) if len(digit) else np.zeros(0, bool)
        at = np.flatnonzero(new)
        if not len(at):
            return column, prefix, digit, a, b, low, high
        return (column[at], prefix[at], digit[at], np.add.reduceat(a, at), np.add.reduceat(b, at),
                np.minimum.reduceat(low, at), np.maximum.reduceat(high, at))

    def all(self) -> tuple[np.ndarray, ...]:
        return self._merged(*(np.concatenate(c) for c in zip(*self.parts)))


def _signed(keys: np.ndarray) -> np.ndarray:
    """Keys as signed numbers of the same order."""
    return (keys ^ _TOP).view(np.int64)


def count_digits(rows: DataFrame, width: int, prefixes: dict[int, list[int]] | None, done: int, bits: int, sided: bool = False) -> DataFrame:
    """(column, prefix, digit, a, b, low, high): rows of either side per digit, and the outermost keys.

    ``prefixes`` are sorted numbers of the first ``done`` bits for each wanted column, ``prefix`` the place among them; None: all columns, no
    bits yet. Digits are signed numbers in the order of the keys, and so are low and high.
    """
    wanted = {c: np.array(p, np.uint64) for c, p in (prefixes or {c: [0] for c in range(width)}).items() if len(p)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = _Counters()
        for batch in batches:
            side = batch.column(width).to_numpy(zero_copy_only=False).astype(float) if sided else np.zeros(batch.num_rows)
            for c, own in wanted.items():
                x = batch.column(c).to_numpy(zero_copy_only=False).astype(float)
                known = ~(np.isnan(x) | np.isnan(side))
                key, on = keys_of(x[known]), side[known].astype(np.int64)
                if done:
                    head = key >> np.uint64(64 - done)
                    at = np.minimum(np.searchsorted(own, head), len(own) - 1)
                    hit = own[at] == head
                    key, on, at = key[hit], on[hit], at[hit]
                else:
                    at = np.zeros(len(key), np.int64)
                if not len(key):
                    continue
                if bits == 64:
                    digit = _signed(key)
                else:
                    digit = ((key >> np.uint64(64 - done - bits)) & np.uint64((1 << bits) - 1)).astype(np.int64)
                counters.add(c, at, digit, key, on)
        if counters.parts:
            column, prefix, digit, a, b, low, high = counters.all()
            yield pa.RecordBatch.from_pydict({"column": column, "prefix": prefix, "digit": digit, "a": a, "b": b, "low": _signed(low), "high": _signed(high)})

    counted = rows.mapInArrow(run, "column int, prefix long, digit long, a long, b long, low long, high long")
    return counted.groupBy("column", "prefix", "digit").agg(
        F.sum("a").alias("a"), F.sum("b").alias("b"), F.min("low").alias("low"), F.max("high").alias("high"))


def _unsigned(number: int) -> int:
    return number + (1 << 63)


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Linear-interpolated quantiles, exact at any size: rows ``(feature, q, value)``; null for a column without values."""
    return quantiles_of(narrow(df, columns), columns, probs)


def quantiles_of(rows: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """As :func:`exact_quantiles`, of rows that are :func:`narrow` already."""
    spark, width = rows.sparkSession, len(columns)
    counts = rows.agg(*[F.count(f"c{i}").alias(f"c{i}") for i in range(width)]).first()
    wanted = {(i, float(q)): float(q) * (counts[i] - 1) if counts[i] else None for i in range(width) for q in probs}
    # (column, rank) -> (key's first bits, rows below them); a rank between two values needs both.
    open_ranks = {(i, r): (0, 0) for (i, _), at in wanted.items() if at is not None for r in (math.floor(at), math.ceil(at))}
    inside = sum(counts[i] for i in {c for c, _ in open_ranks})
    values: dict[tuple[int, int], float] = {}
    done = 0
    while open_ranks:
        bits = 64 - done if inside <= BAND_ROWS else min(DIGIT, 64 - done)
        prefixes: dict[int, list[int]] = {}
        for (i, _), (head, _) in open_ranks.items():
            prefixes.setdefault(i, []).append(head)
        prefixes = {i: sorted(set(heads)) for i, heads in prefixes.items()}
        place = {(i, head): p for i, heads in prefixes.items() for p, head in enumerate(heads)}
        # A row for each rank: its column, its prefix, and how many rows under the prefix come before it.
        asked = [(i, place[i, head], rank - below, rank) for (i, rank), (head, below) in open_ranks.items()]
        ranks = spark.createDataFrame(asked, "column int, prefix long, at long, rank long")
        counted = count_digits(rows, width, prefixes if done else None, done, bits)
        upto = Window.partitionBy("column", "prefix").orderBy("digit").rowsBetween(Window.unboundedPreceding, 0)
        cum = counted.withColumn("upto", F.sum("a").over(upto))
        found = cum.join(F.broadcast(ranks), ["column", "prefix"]).where((F.col("upto") > F.col("at")) & (F.col("upto") - F.col("a") <= F.col("at")))
        still, bins = {}, {}
        for r in found.select("column", "prefix", "rank", "digit", "a", "upto", "low", "high").collect():
            key = r["column"], r["rank"]
            if r["low"] == r["high"]:
                values[key] = value_of(_unsigned(r["low"]))
                continue
            head, below = open_ranks[key]
            longer = head << bits | r["digit"]
            still[key] = longer, below + r["upto"] - r["a"]
            bins[r["column"], longer] = r["a"]
        open_ranks, inside, done = still, sum(bins.values()), done + bits
    out = []
    for (i, q), at in wanted.items():
        value = None
        if at is not None:
            share = at - math.floor(at)
            low, high = values[i, math.floor(at)], values[i, math.ceil(at)]
            value = (1 - share) * low + share * high if share else low
        out.append((columns[i], q, value))
    return spark.createDataFrame(out, "feature string, q double, value double")


def ks_distance(df: DataFrame, columns: Sequence[str], flag: str, min_n: int = 1) -> DataFrame:
    """``(feature, ks_statistic, n_ref, n_cur, ref_mean, cur_mean)`` of the rows with flag 0 and those with flag 1.

    Features with fewer than ``min_n`` values on a side are left out; rows with another flag take no part.
    """
    spark, width = df.sparkSession, len(columns)
    rows = narrow(df.where(F.col(flag).isin(0, 1)), columns, flag)
    on = F.col(SIDE) == 1
    sums = rows.agg(*[f(F.when(on if s else ~on, F.col(f"c{i}"))).alias(f"{f.__name__}{s}_{i}") for i in range(width) for s in (0, 1) for f in (F.count, F.sum)]).first()
    n = {i: (sums[f"count0_{i}"], sums[f"count1_{i}"]) for i in range(width)}
    fit = [i for i in range(width) if min(n[i]) >= max(1, min_n)]
    best = {i: 0.0 for i in fit}
    # (column, key's first bits) -> rows of either side below them.
    open_stretches = {(i, 0): (0, 0) for i in fit}
    inside, done = sum(sum(n[i]) for i in fit), 0
    while open_stretches:
        bits = 64 - done if inside <= FINER_ROWS else min(FINER if done else DIGIT, 64 - done)
        prefixes: dict[int, list[int]] = {}
        for i, head in sorted(open_stretches):
            prefixes.setdefault(i, []).append(head)
        # A row for each open stretch: its column's totals and best gap, and what lies below it.
        before = spark.createDataFrame(
            [(i, p, *open_stretches[i, head], *n[i], best[i]) for i, heads in prefixes.items() for p, head in enumerate(heads)],
            "column int, prefix long, a0 long, b0 long, n_a long, n_b long, best double")
        counted = count_digits(rows, width, prefixes if done else {i: [0] for i in fit}, done, bits, True).join(before, ["column", "prefix"])
        upto = Window.partitionBy("column", "prefix").orderBy("digit").rowsBetween(Window.unboundedPreceding, 0)
        cum = counted.select("*", (F.col("a0") + F.sum("a").over(upto)).alias("a1"), (F.col("b0") + F.sum("b").over(upto)).alias("b1"))
        gap = lambda a, b: ratio(a, F.col("n_a")) - ratio(b, F.col("n_b"))
        edge = F.abs(gap(F.col("a1"), F.col("b1")))
        low = gap(F.col("a1") - F.col("a"), F.col("b1") - F.col("b"))
        bound = F.greatest(low + F.col("a") / F.col("n_a"), F.col("b") / F.col("n_b") - low)
        judged = cum.select("column", "prefix", "digit", "a", "b", "a1", "b1", (F.col("low") < F.col("high")).alias("many"), edge.alias("edge"), bound.alias("bound"), "best")
        top = judged.groupBy("column").agg(F.greatest(F.max("edge"), F.max("best")).alias("top"))
        judged = judged.drop("best").join(F.broadcast(top), "column")  # a row for each column
        # What can still beat the best edge, and the edge itself.
        kept = judged.where((F.col("many") & (F.col("bound") > F.col("top"))) | (F.col("edge") == F.col("top"))).collect()
        still, inside = {}, 0
        for r in kept:
            i = r["column"]
            best[i] = max(best[i], r["top"])
            if r["many"] and r["bound"] > r["top"]:
                still[i, prefixes[i][r["prefix"]] << bits | r["digit"]] = r["a1"] - r["a"], r["b1"] - r["b"]
                inside += r["a"] + r["b"]
        open_stretches, done = still, done + bits
    out = [(columns[i], best[i], *n[i], sums[f"sum0_{i}"] / n[i][0], sums[f"sum1_{i}"] / n[i][1]) for i in fit]
    return spark.createDataFrame(out, "feature string, ks_statistic double, n_ref long, n_cur long, ref_mean double, cur_mean double")
