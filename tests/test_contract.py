"""The driver contract, and a cross-section of queries against their oracle at the smallest scale."""

import os

import pytest

import __spark_entry__ as entry
from tools import check

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
SAMPLE = (
    "flagship", "dq_report", "dq_duplicate_keys", "save_fit_maps", "parse_requests", "one_hot", "v_group_agg", "roc_curve",
    "ks_two_sample", "window_performance", "bucket_quantile", "counter_rate", "alert_rules", "strategy_winners",
    "nearest_neighbours", "registry_promote",
)


def test_oracles_belong_to_queries():
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries)
    assert len(queries) > 120 and len(oracles) > 110


@needs_data
def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["domain", "test_rows", "test_positives", "with_identity", "encoded_rate"]
    assert df.count() == 5


@needs_data
@pytest.mark.parametrize("name", SAMPLE)
def test_against_oracle(spark, name):
    assert check.compare(entry.queries()[name](spark, SF), check.views(SF), entry.oracle_sql()[name])
