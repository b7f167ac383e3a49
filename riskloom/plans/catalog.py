"""All registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators import prepare
from riskloom.plans import (  # noqa: F401
    data_queries, drift_queries, learn_queries, metric_queries, monitor_queries, prepare_queries, stream_queries,
)
from riskloom.plans.fixtures import TX_SQL, identity, tx
from riskloom.plans.registry import ORACLES, QUERIES, query
from riskloom.sources.tables import join_identity

UTC = ("spark.sql.session.timeZone", "UTC")


@query("flagship", TX_SQL + """
, g as (select avg(y) as rate from train),
m as (select coalesce(pemail, '_unknown_') as domain, count(*) as train_rows,
             (sum(y) + 10 * any_value(g.rate)) / (count(*) + 10) as enc from train, g group by 1)
select m.domain, count(*) as test_rows, cast(sum(y) as bigint) as test_positives,
       count(ident.tid) as with_identity, round(any_value(enc), 8) as encoded_rate
from test left join ident on test.tid = ident.tid join m on coalesce(pemail, '_unknown_') = m.domain
group by m.domain""")
def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Encoded training-period rate per mail domain beside what the test period brought."""
    train, test = prepare.temporal_split(tx(spark, sf, "tid", "y", "dt", "pemail"), "dt")
    known = identity(spark, sf).select("tid", F.lit(1).alias("known"))
    domain = F.coalesce("pemail", F.lit(prepare.UNKNOWN_TARGET)).alias("domain")
    fitted = prepare.target_fit(train, ["pemail"], "y")
    encoded = prepare.target_encode(join_identity(test, known, "tid").select("*", domain), fitted, ["pemail"])
    return encoded.groupBy("domain").agg(
        F.count(F.lit(1)).alias("test_rows"), F.sum("y").alias("test_positives"),
        F.count("known").alias("with_identity"), F.round(F.max("pemail"), 8).alias("encoded_rate"),
    )


def _in_utc(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        spark.conf.set(*UTC)
        return fn(spark, sf)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _in_utc(fn) for name, fn in QUERIES.items()}


def oracles() -> dict[str, str]:
    return dict(ORACLES)
