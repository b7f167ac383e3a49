"""Imputation, encoding, split and scaling properties."""

import math
import random

import pytest
from pyspark.sql import functions as F

from riskloom import schema as S
from riskloom.operators import features as FE
from riskloom.operators import prepare as P
from riskloom.sources import tables


@pytest.fixture(scope="module")
def full(spark):
    rng = random.Random(7)
    rows = []
    for i in range(1000):
        hole = lambda share, v: None if rng.random() < share else v
        rows.append((
            i, int(rng.random() < 0.05), rng.randint(1, 15_000_000), rng.lognormvariate(4, 1), "WHC"[i % 3],
            float(rng.randint(1, 50)), hole(0.1, float(rng.randint(1, 9))), hole(0.1, 300.0), hole(0.1, 80.0),
            hole(0.2, rng.choice(["a.com", "b.com"])), rng.choice(["a.com", "c.com"]), rng.random(), hole(0.25, rng.random()),
            hole(0.2, rng.choice("TF")), hole(0.4, rng.gauss(0, 1)), hole(0.4, rng.gauss(0, 1)), hole(0.5, "mobile"),
        ))
    return spark.createDataFrame(rows, (
        "TransactionID long, isFraud int, TransactionDT long, TransactionAmt double, ProductCD string, card1 double, "
        "card2 double, addr1 double, addr2 double, P_emaildomain string, R_emaildomain string, C1 double, D1 double, "
        "M1 string, V1 double, V2 double, DeviceType string"))


def test_split_is_disjoint_and_ordered(full):
    train, test = P.temporal_split(full)
    assert train.count() + test.count() == 1000
    assert train.agg(F.max("TransactionDT")).first()[0] <= test.agg(F.min("TransactionDT")).first()[0]
    assert abs(test.count() - 200) <= 2


def test_split_ties_go_to_training(spark):
    df = spark.createDataFrame([(t,) for t in (1, 2, 3, 3, 3)], "t long")
    train, test = P.temporal_split(df, "t")
    assert (train.count(), test.count()) == (5, 0)


def test_indicators_are_taken_before_filling(full):
    out = P.impute(full, P.median_fit(full, ["V1", "V2"]), ["V1", "V2"])
    row = out.agg(F.sum("V1_missing").alias("flags"), F.count("V1").alias("n")).first()
    assert row["n"] == 1000 and row["flags"] == full.where("V1 is null").count()


def test_median_skips_nulls_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,)], "x double")
    assert P.median_fit(df, ["x"]).first()["fill"] == 2.0


def test_nan_is_filled_too(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "x double")
    assert [r["x"] for r in P.impute(df, P.median_fit(df, ["x"])).collect()] == [1.0, 2.0, 3.0]


def test_mode_ties_and_empty_column(spark):
    df = spark.createDataFrame([(5.0, None), (2.0, None), (5.0, None), (2.0, None), (9.0, None)], "a double, b double")
    assert P.fill_values(P.mode_fit(df, ["a", "b"])) == {"a": 2.0, "b": 0.0}


def test_frequencies_sum_to_one_and_unseen_gets_one_over_n(spark, full):
    fitted = P.freq_fit(full, ["card1", "card2"])
    sums = {r["feature"]: r["s"] for r in fitted.groupBy("feature").agg(F.sum("freq").alias("s")).collect()}
    assert all(math.isclose(s, 1.0) for s in sums.values())
    unseen = spark.createDataFrame([(-1.0,), (None,)], "card1 double")
    assert [r[0] for r in P.freq_encode(unseen, fitted, ["card1"], 1000).collect()] == [0.001, 0.001]


def test_target_encoding_orders_and_smooths(spark):
    rows = [("bad.com", int(i % 5 != 0)) for i in range(500)] + [("good.com", int(i % 20 == 0)) for i in range(500)]
    rows += [("rare.com", 1)]
    df = spark.createDataFrame(rows, "P_emaildomain string, isFraud int")
    rate = {r["value"]: r["rate"] for r in P.target_fit(df, ["P_emaildomain"]).collect()}
    assert rate["bad.com"] > rate["good.com"]
    assert rate["rare.com"] < 1.0
    assert all(0.0 <= r <= 1.0 for r in rate.values())


def test_unseen_domain_gets_the_global_rate(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), (None, 0), (None, 0)], "P_emaildomain string, isFraud int")
    fitted = P.target_fit(df, ["P_emaildomain"])
    new = spark.createDataFrame([("zzz",)], "P_emaildomain string")
    assert P.target_encode(new, fitted, ["P_emaildomain"]).first()[0] == 0.25


def test_out_of_fold_ignores_the_own_label(spark):
    rows = [(i, "solo" if i == 0 else "crowd", int(i == 0)) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, d string, y int")
    out = {r["id"]: r["d"] for r in P.target_encode_out_of_fold(df, ["d"], "id", "y").collect()}
    assert len(out) == 200
    assert out[0] == 0.0  # the only positive row is alone in its category


def test_one_hot_names_unknown_and_unseen(spark):
    train = spark.createDataFrame([("x", 3.0), (None, 4.0)], "c string, n double")
    fitted = P.one_hot_fit(train, ["c", "n"])
    test = spark.createDataFrame([("new", None)], "c string, n double")
    out = P.one_hot(test, fitted)
    assert out.columns == ["c_unknown", "c_x", "n_3", "n_4"]
    assert tuple(out.first()) == (0, 0, 0, 0)


def test_one_hot_names_are_free_of_dots(spark):
    df = spark.createDataFrame([("a.b", 1.5), ("a_b", 2.0)], "c string, n double")
    out = P.one_hot(df, P.one_hot_fit(df, ["c", "n"]))
    assert out.columns == ["c_a_b", "c_a_b__2", "n_1_5", "n_2"]
    assert [tuple(r) for r in out.collect()] == [(1, 0, 1, 0), (0, 1, 0, 1)]


def test_one_hot_refuses_too_many_categories(spark):
    df = spark.range(20).select(F.col("id").cast("string").alias("c"))
    with pytest.raises(ValueError):
        P.one_hot_fit(df, ["c"], max_categories=10)


def test_scaler_uses_population_deviation_and_keeps_constants(spark):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0)], "a double, b double")
    rows = P.scale(df, P.scaler_fit(df, ["a", "b"])).collect()
    assert [tuple(r) for r in rows] == [(-1.0, 0.0), (1.0, 0.0)]


def test_flag_encoding(spark):
    df = spark.createDataFrame([("T",), ("F",), (None,)], "m string")
    assert [r[0] for r in P.flag_encode(df, ["m"]).collect()] == [1, 0, 0]


def test_align_adds_drops_and_orders(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    out = P.align_schema(df, ["b", "z"])
    assert out.columns == ["b", "z"] and tuple(out.first()) == (2, 0)


def test_whole_stage(full):
    train, test = P.temporal_split(full)
    ready, held_out, fitted = P.prepare(train, test)
    assert ready.columns == held_out.columns
    assert not [c for c, t in ready.dtypes if t == "string"]
    assert {"V1_missing", "ProductCD_C", "DeviceType_unknown"} <= set(ready.columns)
    row = ready.agg(F.avg("C1").alias("m"), F.stddev_pop("C1").alias("s")).first()
    assert abs(row["m"]) < 1e-9 and math.isclose(row["s"], 1.0)
    nulls = ready.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in ready.columns]).first()
    assert not any(nulls)


def test_fit_tables_round_trip(spark, full, tmp_path):
    fitted = {"freq": P.freq_fit(full, ["card1"])}
    tables.FitTables.save(fitted, str(tmp_path / "fit"))
    loaded = tables.FitTables.load(spark, str(tmp_path / "fit"), ["freq"])["freq"]
    assert sorted(map(tuple, loaded.collect())) == sorted(map(tuple, fitted["freq"].collect()))


def test_csv_scan_and_null_tokens(spark, tmp_path):
    path = str(tmp_path / "tx.csv")
    names = S.transaction_schema().names
    cells = {"TransactionID": "7", "isFraud": "1", "TransactionDT": "5", "TransactionAmt": "2.5", "ProductCD": "nan", "M1": "T"}
    with open(path, "w") as f:
        f.write(",".join(names) + "\n" + ",".join(cells.get(n, "") for n in names) + "\n")
    df = tables.normalize_nulls(tables.read_transactions(spark, path, "csv"))
    row = df.first()
    assert len(df.columns) == 394 and len(S.identity_schema()) == 41
    assert (row["TransactionID"], row["ProductCD"], row["M1"], row["V1"]) == (7, None, "T", None)


def test_roles_by_whole_name(spark):
    df = spark.createDataFrame([], "D1 double, DeviceType string, DeviceInfo string, V12 double, V1_missing int, id_01 double, id_12 string")
    groups = S.column_groups(df)
    assert groups["d"] == ["D1"] and groups["v"] == ["V12"]
    assert groups["id_numeric"] == ["id_01"] and groups["id_flag"] == ["id_12"]


def test_wide_and_array_groups_agree(spark):
    values = [0.5, None, 2.0, -1.0, 3.5]
    wide = spark.createDataFrame([values], ", ".join(f"V{i} double" for i in range(1, 6)))
    array = spark.createDataFrame([(values,)], "v array<double>")
    a = wide.select(FE.v_group_columns(wide.columns)).first()
    b = array.select(FE.v_group_slices("v", {"V_g1": (1, 5)})).first()
    assert tuple(a) == tuple(b)
    assert a["V_g1_sum"] == 5.0 and a["V_g1_mean"] == 1.25
    assert math.isclose(a["V_g1_std"], 1.9364916731037085)


def test_single_value_group_has_zero_deviation(spark):
    df = spark.createDataFrame([(4.0,)], "V1 double")
    assert df.select(FE.v_group_columns(["V1"])).first()["V_g1_std"] == 0.0


def test_variance_filter_is_strict(spark):
    df = spark.createDataFrame([(0.0, 0.0, 1.0), (0.2, 2.0, 1.0)], "a double, b double, c double")
    assert FE.variance_filter(df, ["a", "b", "c"]) == ["b"] or FE.variance_filter(df, ["a", "b", "c"], 0.0099) == ["a", "b"]
    assert FE.variance_filter(df, ["b", "a"], 0.0) == ["b", "a"]


def test_add_features_takes_what_is_there(spark):
    df = spark.createDataFrame([(2.0, 3.0, 1.0, -1.0, 1)], "card1 double, card2 double, D1 double, D15 double, V9_missing int")
    row = FE.add_features(df).first()
    assert row["card1_card2_interact"] == 6.0 and row["total_v_missing"] == 1
    assert math.isclose(row["D1_D15_ratio"], 1.0 / (1.0 + 1e-6))


def test_one_hot_keeps_clashing_names_apart(spark):
    df = spark.createDataFrame([("a.b",), ("a_b",), ("c",), (None,)], "k string")
    rows = [r.asDict() for r in P.one_hot(df, P.one_hot_fit(df, ["k"])).collect()]
    assert list(rows[0]) == ["k_a_b", "k_a_b__2", "k_c", "k_unknown"]
    assert [sum(r.values()) for r in rows] == [1] * 4 and len({tuple(r.values()) for r in rows}) == 4
    many = spark.range(3000).select(F.col("id").cast("string").alias("k"))
    assert P.one_hot_fit(many, ["k"]).count() == 3000


def test_one_hot_names_are_unique(spark):
    rows = [("a.b", "x"), ("a_b", "y"), ("a_b__2", "z")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "k string, m string, K_A_B int")
    out = P.one_hot(df, P.one_hot_fit(df, ["k"]))
    assert out.columns == ["m", "K_A_B", "k_a_b__2", "k_a_b__3", "k_a_b__2__2"] and len(out.collect()) == 3
    both = spark.createDataFrame([("a_b", "b", 1)], "k string, k_a string, id int")
    assert P.one_hot(both, P.one_hot_fit(both, ["k", "k_a"])).columns == ["id", "k_a_b", "k_a_b__2"]


def test_one_hot_vector_of_a_wide_column(spark):
    df = spark.range(100_000).select("id", F.concat(F.lit("v"), "id").alias("wide"), F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("few"))
    index = P.one_hot_index(df, ["few", "wide"]).cache()
    rows = index.orderBy("index").collect()
    assert [r["index"] for r in rows] == list(range(100_003))
    assert [(r["feature"], r["value"]) for r in rows] == [("few", v) for v in ("1", "2", "unknown")] + [("wide", v) for v in sorted(f"v{i}" for i in range(100_000))]
    place = {(r["feature"], r["value"]): r["index"] for r in rows}
    some = spark.createDataFrame([(5, "v7", 1), (6, "new", None), (7, "v99999", 9), (None, "v1", 2)], "id long, wide string, few long")
    out = {r["id"]: (r["flags"].size, r["flags"].indices.tolist()) for r in P.one_hot_vector(some, index, ["few", "wide"], "id").collect()}
    assert out == {5: (100_003, sorted([place["few", "1"], place["wide", "v7"]])), 6: (100_003, [place["few", "unknown"]]),
                   7: (100_003, [place["wide", "v99999"]]), None: (100_003, sorted([place["few", "2"], place["wide", "v1"]]))}
