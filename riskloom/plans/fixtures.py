"""Transactions, identity, metric and request views over the star-schema tables, and the same views in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import work_dir

LINE_COLUMNS = ("c1", "v1", "v2", "v3", "v4", "v5")
CUSTOMER_COLUMNS = ("addr1", "pemail")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def line_measures(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).cast("double").alias("c1"), F.sum("l_quantity").alias("v1"),
        F.avg("l_discount").alias("v2"), F.max("l_tax").alias("v3"), F.avg("l_extendedprice").alias("v4"),
        F.min("l_extendedprice").alias("v5"),
    )


def tx_columns() -> dict[str, Column]:
    return {
        "tid": F.col("o_orderkey"),
        "y": F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT"), 1).otherwise(0),
        "dt": F.timestamp_diff("SECOND", F.expr("timestamp_ntz'1995-01-01 00:00:00'"), F.col("o_orderdate")),
        "amt": F.col("o_totalprice"),
        "productcd": F.col("o_orderpriority"),
        "card1": F.col("o_custkey").cast("double"),
        "card2": F.nullif(F.col("o_custkey") % 7, F.lit(0)).cast("double"),
        "addr1": F.col("c_nationkey").cast("double"),
        "addr2": F.nullif(F.col("o_custkey") % 11, F.lit(3)).cast("double"),
        "pemail": F.nullif(F.col("c_mktsegment"), F.lit("HOUSEHOLD")),
        "m1": F.when(F.col("o_orderstatus") == "F", "T").when(F.col("o_orderstatus") == "O", "F"),
        "d1": F.nullif(F.col("o_orderkey") % 30, F.lit(0)).cast("double"),
        "d15": F.nullif(F.col("o_orderkey") % 17, F.lit(0)).cast("double"),
        **{c: F.col(c) for c in LINE_COLUMNS},
    }


TX_ORDER = ("tid", "y", "dt", "amt", "productcd", "card1", "card2", "addr1", "addr2", "pemail", "m1", "c1", "d1", "d15",
            "v1", "v2", "v3", "v4", "v5")


def score_column() -> Column:
    """A score between 0 and 1 from plain arithmetic, the same in every engine, with many ties."""
    return F.floor(
        (F.lit(0.45) * (F.col("amt") / (F.col("amt") + 150000.0))
         + F.when(F.col("productcd") == "1-URGENT", 0.3).otherwise(0.0)
         + F.when(F.col("m1").isNull(), 0.2).otherwise(0.0)) * 1000
    ) / 1000.0


def tx(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """The transaction view with the named columns; tables no column needs are not joined."""
    columns = columns or TX_ORDER
    df = table(spark, sf, "orders")
    if any(c in CUSTOMER_COLUMNS for c in columns):
        df = df.join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    if any(c in LINE_COLUMNS for c in columns):
        df = df.join(line_measures(spark, sf), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    known = tx_columns()
    return df.select(*[known[c].alias(c) for c in columns])


def scored(spark: SparkSession, sf: str, *extra: str) -> DataFrame:
    """``(y, score, *extra)`` of the transaction view."""
    base = tx(spark, sf, *dict.fromkeys(("y", "amt", "productcd", "m1", *extra)))
    return base.select("y", score_column().alias("score"), *extra)


def identity(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey")
    return (
        table(spark, sf, "orders").where(key % 10 < 3)
        .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            key.alias("tid"), F.col("c_acctbal").alias("id_01"),
            F.when(key % 3 == 0, "desktop").when(key % 3 == 1, "mobile").alias("devicetype"),
            F.when(key % 4 == 0, "T").when(key % 4 == 1, "F").when(key % 4 == 2, "T").alias("id_12"),
        )
    )


def metric_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events as requests: type as endpoint, type 'error' as status 500, value in milliseconds x 10 as latency."""
    return table(spark, sf, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("endpoint"),
        F.when(F.col("event_type") == "error", "500").otherwise("200").alias("status"),
        (F.col("value") / 100.0).alias("latency"), (F.col("value") / (F.col("value") + 50.0)).alias("score"), "user_id",
    )


def daily_models(spark: SparkSession, sf: str) -> DataFrame:
    """One model per event type: daily recall and drift figures from the day's events."""
    day = F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")).cast("bigint") + 1
    values = F.col("value")
    return table(spark, sf, "events").groupBy(F.col("event_type").alias("model_id"), day.alias("day")).agg(
        (F.floor((F.lit(0.6) + F.lit(0.6) * F.count_if(values > 20.0) / F.count(F.lit(1))) * 10000) / 10000.0)
        .alias("recall"),
        (F.floor((F.lit(0.4) * F.count_if(values > 80.0) / F.count(F.lit(1)) + 0.01) * 10000) / 10000.0)
        .alias("ks_score"),
    )


def scratch(spark: SparkSession, tag: str) -> str:
    return work_dir(spark, tag)


# -- the same views for the oracle -----------------------------------------------------------------------------

TX_SQL = """
with li as (
  select l_orderkey, count(*)::double c1, sum(l_quantity) v1, avg(l_discount) v2, max(l_tax) v3,
         avg(l_extendedprice) v4, min(l_extendedprice) v5
  from lineitem group by l_orderkey),
tx as (
  select o_orderkey as tid,
         case when o_orderstatus = 'P' and o_orderpriority = '1-URGENT' then 1 else 0 end as y,
         date_diff('second', timestamp '1995-01-01', o_orderdate) as dt,
         o_totalprice as amt, o_orderpriority as productcd,
         cast(o_custkey as double) card1, cast(nullif(o_custkey % 7, 0) as double) card2,
         cast(c_nationkey as double) addr1, cast(nullif(o_custkey % 11, 3) as double) addr2,
         nullif(c_mktsegment, 'HOUSEHOLD') as pemail,
         case o_orderstatus when 'F' then 'T' when 'O' then 'F' end as m1,
         c1, cast(nullif(o_orderkey % 30, 0) as double) d1, cast(nullif(o_orderkey % 17, 0) as double) d15,
         v1, v2, v3, v4, v5
  from orders join customer on o_custkey = c_custkey left join li on l_orderkey = o_orderkey),
cut as (select quantile_cont(dt, 0.8) as cut_dt from tx),
train as (select tx.* from tx, cut where dt <= cut_dt),
test as (select tx.* from tx, cut where dt > cut_dt),
ident as (
  select o_orderkey as tid, c_acctbal as id_01,
         case o_orderkey % 3 when 0 then 'desktop' when 1 then 'mobile' end as devicetype,
         case o_orderkey % 4 when 0 then 'T' when 1 then 'F' when 2 then 'T' end as id_12
  from orders join customer on o_custkey = c_custkey where o_orderkey % 10 < 3),
scored as (
  select tid, y, dt, amt, floor((0.45::double * (amt / (amt + 150000.0::double))
         + case when productcd = '1-URGENT' then 0.3::double else 0.0::double end
         + case when m1 is null then 0.2::double else 0.0::double end) * 1000) / 1000.0::double as score
  from tx)
"""

EVENTS_SQL = """
with ev as (
  select event_id, ts, event_type as endpoint, case when event_type = 'error' then '500' else '200' end as status,
         value / 100.0::double as latency, value / (value + 50.0::double) as score, user_id,
         cast(floor(epoch_us(ts) / 1000000) as bigint) as sec
  from events)
"""

DAILY_SQL = """
with recursive daily as (
  select event_type as model_id, date_diff('day', date '2024-01-01', cast(ts as date)) + 1 as day,
         floor((0.6::double + 0.6::double * count(*) filter (value > 20.0) / count(*)) * 10000) / 10000.0::double as recall,
         floor((0.4::double * count(*) filter (value > 80.0) / count(*) + 0.01::double) * 10000) / 10000.0::double as ks_score
  from events group by 1, 2)
"""
