"""Nearest neighbours by a block matrix join: queries against all rows, exact, by cosine.

Vectors are scaled to length 1 and quantised to int8 with a scale of their own; the length of what quantising loses bounds the error
of every product. Rows are dealt into query blocks and base slices, and each pair of block and slice is one tile: a product of int8
matrices (exact in single precision) gives every similarity up to its bound. A pair whose upper bound misses the k-th best
lower bound is out; the rest are computed from the original vectors in double precision and kept in a heap per query. The tiles'
lists are merged per query. The block is bounded in rows, so a task's memory does not grow with the table.
"""

from __future__ import annotations

from collections.abc import Callable
from heapq import heappush, heappushpop

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

QUERY_ROWS, BASE_ROWS, CHUNK = 4096, 16384, 2048


#: 127 * 127 * 1024 < 2^24.
EXACT_DIMENSIONS = 1024


def usable(vec: Column) -> Column:
    """Not null, no component null or not finite, and not zero."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return vec.isNotNull() & F.forall(vec, finite) & F.exists(vec, lambda x: x != 0)


class Quantised:
    """Unit vectors as int8 rows (held as whole numbers in single precision) with scales and error bounds."""

    def __init__(self, vectors: np.ndarray):
        self.raw = vectors
        self.norm = np.sqrt((vectors * vectors).sum(axis=1))
        unit = vectors / self.norm[:, None]
        self.scale = np.abs(unit).max(axis=1) / 127
        self.rows = np.rint(unit / self.scale[:, None]).astype(np.int8).astype(np.float32)
        self.error = np.sqrt(((unit - self.rows * self.scale[:, None]) ** 2).sum(axis=1)) + 1e-12

    def bounds(self, base: "Quantised", own: slice, other: slice) -> tuple[np.ndarray, np.ndarray]:
        """Similarities of quantised vectors, and how far the true ones may be off."""
        # In single precision sums of whole numbers are exact for so many dimensions, so longer vectors are multiplied in slices.
        near = np.zeros((len(self.rows[own]), len(base.rows[other])))
        for lo in range(0, self.rows.shape[1], EXACT_DIMENSIONS):
            near += self.rows[own, lo:lo + EXACT_DIMENSIONS] @ base.rows[other, lo:lo + EXACT_DIMENSIONS].T
        near *= self.scale[own][:, None] * base.scale[other][None, :]
        off = self.error[own][:, None] + (1 + self.error[own])[:, None] * base.error[other][None, :] + 1e-9
        return near, off

    def exact(self, base: "Quantised", i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return (self.raw[i] * base.raw[j]).sum(axis=1) / (self.norm[i] * base.norm[j])


def search_tile(query_ids: np.ndarray, queries: np.ndarray, base_ids: np.ndarray, base: np.ndarray, k: int) -> list[tuple]:
    """(query id, base id, score): the k best of the tile for each query; ties go to the smaller id, the query's own id is left out."""
    q, b = Quantised(queries), Quantised(base)
    heaps: list[list] = [[] for _ in query_ids]
    floor = np.full(len(query_ids), -2.0)  # k lower bounds seen so far are at least this
    for lo in range(0, len(query_ids), CHUNK // 4):
        own = slice(lo, lo + CHUNK // 4)
        for start in range(0, len(base_ids), CHUNK):
            other = slice(start, start + CHUNK)
            near, off = q.bounds(b, own, other)
            self_pair = query_ids[own][:, None] == base_ids[other][None, :]
            lower = np.where(self_pair, -2.0, near - off)
            if lower.shape[1] > k:
                floor[own] = np.maximum(floor[own], np.partition(lower, -k, axis=1)[:, -k])
            i, j = np.nonzero((near + off >= floor[own][:, None]) & ~self_pair)
            if not len(i):
                continue
            score = q.exact(b, i + lo, j + start)
            order = np.lexsort((base_ids[j + start], -score, i))
            i, j, score = i[order], j[order], score[order]
            first = np.searchsorted(i, i)  # where the rows of the same query begin
            top = np.arange(len(i)) - first < k
            for a, c, s in zip(i[top] + lo, base_ids[j[top] + start], score[top]):
                item = (float(s), -int(c))
                if len(heaps[a]) < k:
                    heappush(heaps[a], item)
                else:
                    heappushpop(heaps[a], item)
    return [(int(query_ids[a]), -c, s) for a, heap in enumerate(heaps) for s, c in heap]


def nearest(vectors: DataFrame, is_query: Callable[[Column], Column], k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The k nearest rows of each query by cosine: query_id, rank (from 1), ``id_col``, score; fewer if there are fewer rows.

    ``is_query`` says of an id whether its row is a query. Vectors that are null or zero, or that hold null or non-finite components, and rows without an id take no part. Rows that
    repeat an id count as one, with the smallest of their vectors. Only vectors of the same length are compared.
    """
    known = (vectors.filter(F.col(id_col).isNotNull() & usable(F.col(vec_col)))
             .groupBy(F.col(id_col).alias("id")).agg(F.min(F.col(vec_col).cast("array<double>")).alias("vec")))
    n = known.count()
    slices, blocks = max(1, -(-n // BASE_ROWS)), max(1, -(-known.filter(is_query(F.col("id"))).count() // QUERY_ROWS))
    spread = lambda parts, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    dim = F.size("vec").alias("dim")
    queries = known.filter(is_query(F.col("id"))).select("id", "vec", dim, spread(blocks, "query").alias("block"), every(slices).alias("slice"))
    base = known.select("id", "vec", dim, every(blocks).alias("block"), spread(slices, "base").alias("slice"))

    def tile(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": [], "id": [], "score": []})
        left, right = left.sort_values("id"), right.sort_values("id")
        rows = search_tile(left["id"].to_numpy(), np.stack(left["vec"]), right["id"].to_numpy(), np.stack(right["vec"]), k)
        return pd.DataFrame(rows, columns=["query_id", "id", "score"])

    keys = ["dim", "block", "slice"]
    found = queries.groupBy(*keys).cogroup(base.groupBy(*keys)).applyInPandas(tile, "query_id long, id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    return (found.withColumn("rank", F.row_number().over(best).cast(T.IntegerType())).filter(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias(id_col), "score"))
