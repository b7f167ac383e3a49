"""Token counts for every context limit from one exact histogram of encoded lengths.

Documents are counted by encoded length, which the map side combines; the histogram has as many rows as there are different
lengths. Suffix sums over it answer what every limit keeps and loses. The sums run in two steps, within spans of lengths and over
the spans' totals, so no task holds all lengths.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.llm.bpe import Vocabulary, encode_documents

SPAN = 1024


def length_histogram(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """n_tokens, docs: how many documents have each encoded length. A null text counts as empty; repeated rows count each time."""
    return encode_documents(docs, vocabulary, id_col, text_col, with_ids=False).groupBy("n_tokens").agg(F.count(F.lit(1)).alias("docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """For every length L that occurs, taken as a context limit:

    docs and tokens of exactly that length; docs_longer and tokens_longer beyond it; docs_within and tokens_within; tokens_kept, the
    total when every document is cut to L tokens; tokens_lost by the cut;
    quantile, the share of documents no longer than L. An empty histogram has no rows.
    """
    spans = (histogram.withColumn("span", F.floor(F.col("n_tokens") / SPAN).cast("long"))
             .withColumn("tokens", F.col("n_tokens") * F.col("docs")))
    totals = spans.groupBy("span").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t"))
    up = Window.orderBy("span").rowsBetween(Window.unboundedPreceding, -1)  # a row for each span of lengths, not for each document
    every = Window.orderBy("span").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = totals.select(
        "span", F.coalesce(F.sum("d").over(up), F.lit(0)).alias("d0"), F.coalesce(F.sum("t").over(up), F.lit(0)).alias("t0"),
        F.sum("d").over(every).alias("all_docs"), F.sum("t").over(every).alias("all_tokens"),
    )
    within = Window.partitionBy("span").orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    x = spans.select("*", F.sum("docs").over(within).alias("d1"), F.sum("tokens").over(within).alias("t1")).join(before, "span")
    x = x.withColumns({"docs_within": F.col("d0") + F.col("d1"), "tokens_within": F.col("t0") + F.col("t1")})
    x = x.withColumns({"docs_longer": F.col("all_docs") - F.col("docs_within"), "tokens_longer": F.col("all_tokens") - F.col("tokens_within")})
    kept = F.col("tokens_within") + F.col("n_tokens") * F.col("docs_longer")
    return x.select(
        "n_tokens", "docs", "tokens", "docs_within", "tokens_within", "docs_longer", "tokens_longer", kept.alias("tokens_kept"),
        (F.col("all_tokens") - kept).alias("tokens_lost"), (F.col("docs_within") / F.col("all_docs")).alias("quantile"),
    )


def at_limit(sums: DataFrame, limit: int) -> DataFrame:
    """One row: what any context ``limit`` keeps, also one that is no document's length. No rows: zeros."""
    within = F.when(F.col("n_tokens") <= limit, F.col("tokens"))
    longer = F.when(F.col("n_tokens") > limit, F.col("docs"))
    return sums.agg(
        F.coalesce(F.sum(longer), F.lit(0)).alias("docs_longer"),
        (F.coalesce(F.sum(within), F.lit(0)) + F.lit(limit) * F.coalesce(F.sum(longer), F.lit(0))).alias("tokens_kept"),
    )


def quantile(sums: DataFrame, share: float) -> DataFrame:
    """One row: the smallest length that at least ``share`` of the documents do not exceed; null without documents."""
    return sums.filter(F.col("quantile") >= share).agg(F.min("n_tokens").alias("n_tokens"))
