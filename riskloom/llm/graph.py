"""Connected components of an edge table, by alternating stars; nothing is collected but the two numbers that show convergence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.texts import write_once


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root: the smallest node reachable, for every node of an edge that isn't its own root.

    Nodes are whole numbers; loops and repeated edges do no harm. Each round links every node to the smallest of its larger
    neighbourhood, then of its smaller one, and is written to the shared folder, so a lost executor costs one round at most. The
    smallest neighbours are an aggregate that is combined before the shuffle; the join beside it may have a hot node, which adaptive
    execution splits. Rounds grow with the logarithm of a component's diameter.
    """
    e = write_once(edges.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).filter("u <> v").distinct(), "edges")
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = write_once(large, "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))).distinct()
        e = write_once(small, "edges")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
