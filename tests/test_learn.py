"""Weights, learners, scoring, neighbours, over-sampling, attribution and registry."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import attribution as A
from riskloom.operators import learn as L
from riskloom.operators import neighbours as N
from riskloom.operators import registry as G
from riskloom.sources import models, requests

QUICK = L.TreeConfig(rounds=6, depth=3, step=0.3, min_hessian=1.0)
FEATURES = [f"f{i}" for i in range(6)]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(600):
        y = int(i % 20 == 0)
        x = rng.normal(size=6)
        x[:3] += 2.0 * y
        rows.append((i, y, i * 10, *map(float, x)))
    return spark.createDataFrame(rows, "id long, y int, t long, " + ", ".join(f"{f} double" for f in FEATURES)).cache()


@pytest.fixture(scope="module")
def model(data):
    return L.train_gbt(L.class_weight(data, "y"), FEATURES, "y", QUICK, L.WEIGHT)


def test_class_weight_and_cost(data, spark):
    assert tuple(L.class_counts(data, "y").first()) == (30, 570, 19.0)
    weights = {r["y"]: r[L.WEIGHT] for r in L.class_weight(data, "y", 10.0).select("y", L.WEIGHT).distinct().collect()}
    assert weights == {0: 1.0, 1: 190.0}
    none = spark.createDataFrame([(0,)], "y int")
    assert L.class_counts(none, "y").first()["weight"] == 1.0


def test_balanced_weight_sums_to_rows(data):
    sums = L.balanced_weight(data, "y").groupBy("y").agg(F.sum(L.WEIGHT).alias("s")).collect()
    assert all(math.isclose(r["s"], 300.0) for r in sums)


def test_validation_tail_is_latest(data):
    tail = L.validation_tail(data, "t")
    row = tail.where(L.VALIDATION).agg(F.count(F.lit(1)).alias("n"), F.min("t").alias("t")).first()
    assert row["n"] == 90 and row["t"] == 5100


def test_model_learns_and_costs_raise_recall(data, model):
    plain = L.compare({"m": model}, data, FEATURES, "y").first()
    assert plain["recall"] > 0.5 and plain["auc_roc"] > 0.8
    costly = L.train_gbt(L.class_weight(data, "y", 10.0), FEATURES, "y", QUICK, L.WEIGHT)
    assert L.compare({"m": costly}, data, FEATURES, "y").first()["recall"] >= plain["recall"]


def test_early_stopping_and_hybrid(data):
    marked = L.validation_tail(L.class_weight(data, "y"), "t")
    stopped = L.train_gbt(marked, FEATURES, "y", L.TreeConfig(rounds=30, depth=2, step=1.0), L.WEIGHT, L.VALIDATION)
    assert 1 <= A.gbt_stage(stopped).getNumTrees <= 30
    hybrid = L.train_rf_hybrid(L.class_weight(data, "y"), FEATURES, "y", 3, QUICK, L.WEIGHT, trees=5, forest_depth=3)
    assert len(A.selected_names(hybrid, FEATURES)) == 3
    assert L.compare({"h": hybrid}, data, FEATURES, "y").first()["recall"] > 0.5


def test_importances_find_the_signal(data):
    top = L.topk_importance(L.rf_importance(data, FEATURES, "y", trees=10, depth=4), 3)
    assert {r["feature"] for r in top.collect()} == {"f0", "f1", "f2"}
    assert L.restore_order(top).first()["positions"] == [0, 1, 2]


def test_importance_shift_of_one_class_is_empty(data):
    assert L.importance_shift(data, data.where("y = 0"), FEATURES, "y").count() == 0


def test_scores_bands_and_constant(data, model):
    rows = L.score_batch(model, data, FEATURES, "id").collect()
    assert len(rows) == 600
    for r in rows:
        p = r["fraud_probability"]
        assert 0.0 <= p <= 1.0
        assert r["confidence"] == ("high" if p >= 0.8 else "medium" if p >= 0.5 else "low")
        assert r["is_fraud"] == (p >= 0.5)
    first = L.score_batch(None, data, FEATURES, "id").first()
    assert tuple(first)[1:] == (0.1, False, "low")


def test_shap_sums_to_the_log_odds(data, model):
    values = A.shap_values(model, data, FEATURES, "id").withColumn(
        "total", F.col("base") + F.aggregate("phi", F.lit(0.0), lambda a, x: a + x)
    )
    both = values.join(L.probability(model, data, FEATURES, "p", keep=["id"]), "id").collect()
    assert len(both) == 600
    for r in both:
        assert r["total"] == pytest.approx(math.log(r["p"] / (1 - r["p"])), abs=1e-6)


def test_shap_equals_the_definition(data, model):
    """Shapley values by enumerating all subsets, the tree value of a subset weighing unknown splits by cover."""
    gbt = A.gbt_stage(model)
    nodes = gbt.nodes()
    trees = [nodes[nodes.tree == t].set_index("node").to_dict("index") for t in range(gbt.getNumTrees)]

    def expected(tree, x, known, number=0):
        node = tree[number]
        if node["left"] < 0:
            return node["prediction"]
        if node["feature"] in known:
            side = node["left"] if x[int(node["feature"])] <= node["threshold"] else node["right"]
            return expected(tree, x, known, side)
        return sum(tree[c]["cover"] / node["cover"] * expected(tree, x, known, c) for c in (node["left"], node["right"]))

    def value(x, known):
        return sum(expected(t, x, known) for t in trees)

    got = {r["id"]: r["phi"] for r in A.shap_values(model, data.where("id in (0, 7)"), FEATURES, "id").collect()}
    for row in data.where("id in (0, 7)").collect():
        x = [row[f] for f in FEATURES]
        for j in range(6):
            others = [i for i in range(6) if i != j]
            phi = 0.0
            for size in range(6):
                share = math.factorial(size) * math.factorial(5 - size) / math.factorial(6)
                for subset in itertools.combinations(others, size):
                    phi += share * (value(x, {*subset, j}) - value(x, set(subset)))
            assert got[row["id"]][j] == pytest.approx(phi, abs=1e-9)


def test_attribution_reports(data, model):
    shap = A.attribution(model, data, FEATURES, FEATURES, "id", k=3).collect()
    native = A.attribution(model, data, FEATURES, FEATURES, "id", method="native", k=3).collect()
    assert {r["feature"] for r in shap} == {r["feature"] for r in native} == {"f0", "f1", "f2"}


def test_permutation_keeps_values_and_finds_signal(data, model):
    loss = {r["feature"]: r["auc_loss"] for r in A.permutation_importance(model, data, FEATURES[:6], "y", "id").collect()}
    assert max(loss, key=loss.get) in ("f0", "f1", "f2")


def test_hash_rank_is_dense(data):
    ranks = sorted(r[0] for r in N.hash_rank(data, "id", 1).select("__rank").collect())
    assert ranks == list(range(600))


def test_sample_is_stable(data):
    a = sorted(r["id"] for r in A.seeded_sample(data, "id", 50).collect())
    b = sorted(r["id"] for r in A.seeded_sample(data.repartition(7), "id", 50).collect())
    assert a == b and len(a) == 50


@pytest.mark.parametrize("chunk_rows", [25, 4000])
def test_neighbours_equal_brute_force(spark, chunk_rows):
    rng = np.random.default_rng(11)
    x = np.concatenate([rng.normal(size=(200, 4)), rng.normal(8, 0.5, size=(60, 4)), np.ones((90, 4))])  # many copies
    df = spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(x)], "id long, v array<double>")
    got = {}
    for r in N.nearest_neighbours(df, "id", "v", 5, chunk_rows=chunk_rows).collect():
        got.setdefault(r["id"], {})[r["rank"]] = (r["dist"], r["nbr"])
    dist = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(dist, np.inf)
    for i in range(len(x)):
        order = sorted(range(len(x)), key=lambda j: (dist[i, j], j))[:5]
        assert [got[i][r][1] for r in range(1, 6)] == order
        assert np.allclose([got[i][r][0] for r in range(1, 6)], dist[i, order])


def test_hashed_neighbours_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 16)) * 3
    x = np.concatenate([centres[rng.integers(0, 40, 1200)] + rng.normal(size=(1200, 16)), np.ones((60, 16)), np.full((1, 16), 900.0)])
    df = spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(x)], "id long, v array<double>")
    monkeypatch.setattr(N, "BUCKET_ROWS", 40)
    run = lambda d: sorted(tuple(r) for r in N.nearest_neighbours(d, "id", "v", 5, chunk_rows=100, method="lsh").collect())
    got = run(df)
    assert got == run(df.repartition(5))
    dist = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(dist, np.inf)
    hits = 0
    for i in range(len(x)):
        mine = [r for r in got if r[0] == i]
        assert [r[3] for r in sorted(mine, key=lambda r: r[3])] == [1, 2, 3, 4, 5]  # also the one far from all others
        assert np.allclose([r[2] for r in mine], [dist[i, r[1]] for r in mine])
        hits += len({r[1] for r in mine} & set(sorted(range(len(x)), key=lambda j: (dist[i, j], j))[:5]))
    assert hits >= 0.9 * 5 * len(x)


def test_hashed_neighbours_of_few_points(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, [0.0]), (3, [5.0])], "id long, v array<double>")
    got = sorted((r["id"], r["nbr"], r["rank"]) for r in N.nearest_neighbours(df, "id", "v", 5, method="lsh").collect())
    assert got == [(1, 2, 1), (1, 3, 2), (2, 1, 1), (2, 3, 2), (3, 1, 1), (3, 2, 2)]
    assert N.nearest_neighbours(df.limit(0), "id", "v", method="lsh").count() == 0
    with pytest.raises(ValueError):
        N.nearest_neighbours(df, "id", "v", method="guess")


def test_smote_reaches_parity_and_keeps_the_rest(spark, data):
    df = data.select("id", "y", F.array(*FEATURES).alias("v"))
    out = N.smote(df, "v", "y", "id").cache()
    counts = {(r["label"], r["synthetic"]): r["count"] for r in out.groupBy("label", "synthetic").count().collect()}
    assert counts == {(0, False): 570, (1, False): 30, (1, True): 540}
    again = N.smote(df.repartition(3), "v", "y", "id")
    key = lambda d: sorted(tuple(r["vec"]) for r in d.where("synthetic").collect())
    assert np.allclose(key(out), key(again))
    pos = np.array([r["v"] for r in df.where("y = 1").collect()])
    made = np.array(key(out))
    assert (made >= pos.min(0) - 1e-9).all() and (made <= pos.max(0) + 1e-9).all()


def test_smote_without_enough_positives(spark):
    df = spark.createDataFrame([(1, 1, [0.0]), (2, 0, [1.0]), (3, 0, [2.0])], "id long, y int, v array<double>")
    assert N.smote(df, "v", "y", "id").count() == 3


def test_gate_registry_and_champion(spark, model, data, tmp_path):
    runs = spark.createDataFrame(
        [(1, "a", "/x", 0.90, 0.9), (2, "b", "/y", 0.84, 0.9), (3, "c", str(tmp_path / "m"), 0.85, 0.9)],
        "version long, model string, path string, fraud_recall double, auc_roc double")
    decided = G.deploy_gate(runs)
    states = {r["version"]: r["state"] for r in G.registry_state(decided).collect()}
    assert states == {1: "archived", 2: "rejected", 3: "champion"}
    models.save_model(model, str(tmp_path / "m"), "gbt", FEATURES, {"auc_roc": 0.9}, {"1": 4.0})
    assert models.model_info(spark, str(tmp_path / "m")) == {
        "kind": "gbt", "features": list(FEATURES), "metrics": {"auc_roc": 0.9}, "weights": {"1": 4.0}}
    models.append_decision(decided, str(tmp_path / "decisions"))
    loaded = models.load_champion(spark, str(tmp_path / "decisions"))
    a = L.score_batch(model, data, FEATURES, "id").orderBy("id").collect()
    assert a == L.score_batch(loaded, data, FEATURES, "id").orderBy("id").collect()
    assert models.load_champion(spark, str(tmp_path / "nothing")) is None
    assert models.load_champion(spark, str(tmp_path / "nothing"), ["/none", str(tmp_path / "m")]) is not None


def test_winner_and_cost_comparison(spark):
    rows = spark.createDataFrame(
        [("standard", 0.0593, 1389.0, 7, 279), ("sensitive", 0.6356, 2765.0, 75, 2335)],
        "model string, recall double, business_cost double, tp long, fp long")
    assert L.winner(rows).first()["model"] == "sensitive"
    out = L.cost_comparison(rows, "standard", "sensitive").first()
    assert tuple(out) == (0.5763, -1376.0, -2080.0, -9200.0)


@pytest.mark.parametrize("body, want", [
    ('{"a": 1.5, "b": null}', (1.5, 0.0)), ('{"b": "x", "a": "2"}', (2.0, 0.0)), ("{}", (0.0, 0.0)), ("junk", (0.0, 0.0)),
    ('{"a": "NaN", "b": 3}', (0.0, 3.0)),
])
def test_requests_by_name(spark, body, want):
    df = spark.createDataFrame([(body,)], "body string")
    assert tuple(requests.parse_requests(df, "body", ["a", "b"]).first()) == want


def test_batches_and_padding(spark):
    df = spark.createDataFrame([('[{"a": 1}, {"a": 2}]',), ("[]",)], "body string")
    assert [r["index"] for r in requests.explode_batch(df, "body").collect()] == [0, 1]
    arrays = spark.createDataFrame([([1.0, 2.0, 3.0],), ([5.0],)], "x array<double>")
    picked = [r[0] for r in arrays.select(requests.pad_select(F.col("x"), [2, 0])).collect()]
    assert picked == [[3.0, 1.0], [5.0, 0.0]]


def test_requests_from_json_arrays(spark):
    bodies = [(1, '[{"a": 1, "b": "2.5"}, {"b": null, "c": 9}]'), (2, "[]"), (3, None), (4, "no json")]
    rows = L.score_requests(None, spark.createDataFrame(bodies, "id long, body string"), "body", ["a", "b"], ["id"]).collect()
    assert sorted((r["id"], r["index"], r["fraud_probability"], r["is_fraud"]) for r in rows) == [(1, 0, 0.1, False), (1, 1, 0.1, False)]
