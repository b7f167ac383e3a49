"""The whole job on a small labelled table."""

import random

from pyspark.sql import functions as F

from riskloom.operators.learn import TreeConfig
from riskloom.plans.stages import StageConfig, run_stages
from riskloom.sources import models


def test_all_stages_with_smote_and_forest(spark, tmp_path):
    rng = random.Random(2)
    rows, ident = [], []
    for i in range(600):
        y = int(i % 15 == 0)
        rows.append((i, y, 1000 + i, rng.lognormvariate(3, 1) + 50 * y, "WHC"[i % 3], float(i % 40), None if i % 7 == 0 else 2.5 * (i % 3),
                     ["a.com", "b.com", None][i % 3], rng.random() + y, rng.choice(["T", "F", None]), None if i % 4 == 0 else rng.gauss(y, 1)))
        if i % 3 == 0:
            ident.append((i, rng.choice(["mobile", "desktop"]), rng.random(), rng.choice(["T", "F"])))
    tx = spark.createDataFrame(rows, "TransactionID long, isFraud int, TransactionDT long, TransactionAmt double, ProductCD string, "
                                     "card1 double, card5 double, P_emaildomain string, C1 double, M1 string, V1 double")
    identity = spark.createDataFrame(ident, "TransactionID long, DeviceType string, id_01 double, id_12 string")
    cfg = StageConfig(model_type="rf_hybrid", imbalance="smote", min_recall=0.0, top_features=4, forest_trees=3, forest_depth=3,
                      trees=TreeConfig(rounds=3, depth=2, step=0.5, min_rows=1))
    row = run_stages(tx, identity, str(tmp_path), cfg=cfg).first()
    assert row["status"] == "deployed" and 0.0 <= row["fraud_recall"] <= 1.0
    logged = {r["metric"] for r in spark.read.parquet(f"{tmp_path}/metrics").where("stage = 'evaluate'").collect()}
    assert {"recall", "auc_roc", "business_cost"} <= logged
    written = spark.read.parquet(f"{tmp_path}/run-1/features")
    assert {r["split"]: r["count"] for r in written.groupBy("split").count().collect()} == {"train": 480, "test": 120}
    assert not [c for c in written.columns if "." in c]
    assert written.where(F.col("C1").isNull()).count() == 0
    assert models.load_champion(spark, f"{tmp_path}/decisions") is not None
    assert spark.read.json(f"{tmp_path}/run-1/attribution").count() <= 4
    about = models.model_info(spark, f"{tmp_path}/run-1/model")
    assert about["kind"] == "rf_hybrid" and "TransactionAmt" in about["features"] and "TransactionID" not in about["features"]
