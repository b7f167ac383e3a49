"""Checks pass and fail where they should, and never raise."""

import pytest
from pyspark.sql import functions as F

from riskloom.operators import quality as Q

FIELDS = "TransactionID long, isFraud int, TransactionDT long, TransactionAmt double, ProductCD string, V1 double"


@pytest.fixture(scope="module")
def good(spark):
    rows = [(1000 + i, int(i % 25 == 0), 100 + i, 10.0 + i, "WHC"[i % 3], None if i % 3 == 0 else 1.0) for i in range(500)]
    return spark.createDataFrame(rows, FIELDS)


def verdict(df, cfg=Q.QualityConfig()):
    return {r["check"]: r for r in Q.all_checks(df, cfg).collect()}


def test_good_data_passes_everything(good):
    assert all(r["passed"] for r in verdict(good).values())
    assert len(verdict(good)) == 8


def test_missing_column_is_an_issue(good, spark):
    df = good.drop("TransactionAmt")
    found = verdict(df)
    assert not found["required_columns"]["passed"]
    assert not found["positive_amount"]["passed"]
    report = Q.quality_report(df, good.select("TransactionID")).first()
    assert not report["validation_passed"]
    assert "positive_amount" in report["issues"]


def test_missing_label_and_key(good):
    found = verdict(good.drop("isFraud", "TransactionID"))
    assert not found["binary_label"]["passed"] and not found["label_rate"]["passed"]
    assert not found["duplicate_keys"]["passed"] and found["duplicate_keys"]["n_bad"] == 0


@pytest.mark.parametrize("value, failing", [(0, "label_rate"), (1, "label_rate"), (2, "binary_label")])
def test_label_values(good, value, failing):
    assert not verdict(good.withColumn("isFraud", F.lit(value)))[failing]["passed"]


def test_null_labels_are_not_bad(good):
    df = good.withColumn("isFraud", F.when(F.col("TransactionID") % 2 == 0, F.col("isFraud")))
    assert verdict(df)["binary_label"]["passed"]


def test_all_null_column_is_a_warning(good):
    df = good.withColumn("V1", F.lit(None).cast("double"))
    report = Q.quality_report(df, good).first()
    assert report["warnings"] == ["missing_audit"] and report["validation_passed"]
    assert [r["column"] for r in Q.missing_audit(df).collect()] == ["V1"]


def test_exactly_the_limit_is_not_over_it(spark):
    df = spark.createDataFrame([(1.0 if i < 5 else None,) for i in range(100)], "x double")
    assert Q.missing_audit(df, 0.95).count() == 0


def test_negative_amount_is_a_warning(good):
    df = good.withColumn("TransactionAmt", F.when(F.col("TransactionID") == 1000, -100.0).otherwise(F.col("TransactionAmt")))
    row = verdict(df)["positive_amount"]
    assert not row["passed"] and row["severity"] == "warning" and row["n_bad"] == 1


def test_duplicates_count_rows_beyond_the_first(good):
    df = good.unionByName(good.limit(3)).unionByName(good.limit(3))
    assert verdict(df)["duplicate_keys"]["n_bad"] == 6


def test_null_keys_are_one_group(spark):
    df = spark.createDataFrame([(None,), (None,), (1,)], "k int")
    assert Q.duplicate_keys(df, ["k"]).first()["n_bad"] == 1


def test_too_few_rows(good):
    assert not verdict(good.limit(1))["min_rows"]["passed"]


def test_empty_frame(good):
    found = verdict(good.limit(0))
    assert not found["min_rows"]["passed"] and found["duplicate_keys"]["passed"]


def test_top_missing_orders_ties_by_name(spark):
    df = spark.createDataFrame([(None, None, 1)], "b int, a int, c int")
    assert [r["column"] for r in Q.top_missing(df, 2).collect()] == ["a", "b"]
