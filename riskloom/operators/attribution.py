"""Which features drive the scores: Shapley values of boosted trees, permutation and native importance.

Shapley values follow the path-dependent tree algorithm. For a leaf with d features on its path, extending a polynomial by one feature
after the other gives the weight of all subsets by size, and unwinding a feature takes it out again: O(d^2) for a row and leaf. Leaves
with the same number of features are computed together, for a stretch of rows at a time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, fields

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.shape import keyed_hash
from riskloom.operators.boost import BoostedTrees
from riskloom.operators.learn import importance_table, probability, vectorized
from riskloom.operators.metrics import auc_roc
from riskloom.operators.neighbours import hash_rank


#: Numbers in the arrays that a task works on at once, so few that they stay in a core's cache.
CELLS = 1 << 15


def gbt_stage(model: PipelineModel) -> BoostedTrees:
    return next(s for s in model.stages if isinstance(s, BoostedTrees))


@dataclass(frozen=True)
class Leaves:
    """Leaves whose paths have the same number of features: [leaf, place on the path], and the value of each leaf."""

    feature: np.ndarray
    low: np.ndarray  # a row agrees with a place if its value is above low and at most high
    high: np.ndarray
    missing: np.ndarray  # whether a missing value agrees
    share: np.ndarray  # rows that take the same turns, as a share of those that come to them
    value: np.ndarray


def leaves_by_length(trees: Sequence[dict[str, np.ndarray]]) -> tuple[list[Leaves], float]:
    """The leaves of all trees by the number of features on their paths, and the expected sum of the trees."""
    found: dict[int, list[tuple]] = {}
    base = 0.0
    for t in trees:
        feature, left, right, threshold, cover, value, missing_left = (t[k].tolist() for k in (
            "feature", "left", "right", "threshold", "cover", "value", "missing_left"))
        stack: list[tuple[int, dict]] = [(0, {})]
        while stack:
            node, path = stack.pop()
            if feature[node] < 0:
                base += value[node] * math.prod(p[3] for p in path.values())
                if path:
                    found.setdefault(len(path), []).append((list(path), *zip(*path.values()), value[node]))
                continue
            f, at = feature[node], threshold[node]
            low, high, missing, share = path.get(f, (-math.inf, math.inf, True, 1.0))
            for child, is_left in ((left[node], True), (right[node], False)):
                bounds = (low, min(high, at)) if is_left else (max(low, at), high)
                own = share * (cover[child] / cover[node] if cover[node] else 0.5)
                stack.append((child, {**path, f: (*bounds, missing and missing_left[node] == is_left, own)}))
    return [Leaves(*(np.array(c) for c in zip(*rows))) for _, rows in sorted(found.items())], base


def contributions(leaves: Leaves, x: np.ndarray, width: int) -> np.ndarray:
    """[row, feature]: what these leaves contribute to each feature's Shapley value."""
    n, d = len(x), leaves.feature.shape[1]
    weight = [math.factorial(k) * math.factorial(d - k - 1) / math.factorial(d) for k in range(d)]
    agrees = []
    for i in range(d):
        v = x[:, leaves.feature[:, i]]
        agrees.append(np.where(np.isnan(v), leaves.missing[:, i], (v > leaves.low[:, i]) & (v <= leaves.high[:, i])).astype(float))
    # subsets[k]: over all ways to take k of the path's features as known, what is left of the others' shares.
    subsets = [np.ones((n, len(leaves.value)))]
    for i in range(d):
        z = leaves.share[:, i]
        longer = [subsets[0] * z]
        longer += [subsets[k] * z + subsets[k - 1] * agrees[i] for k in range(1, i + 1)]
        subsets = [*longer, subsets[i] * agrees[i]]
    out = np.zeros(n * width)
    row = np.arange(n)[:, None] * width
    for i in range(d):
        z = leaves.share[:, i]
        # Without feature i: if the row agrees, from the largest subset down; if not, the feature was only ever a factor.
        above, on = subsets[d], weight[d - 1] * subsets[d]
        for k in range(d - 1, 0, -1):
            above = subsets[k] - z * above
            on = on + weight[k - 1] * above
        off = sum(weight[k] * subsets[k] for k in range(d)) / z
        phi = np.where(agrees[i] == 1, (1 - z) * on, -z * off) * leaves.value
        out += np.bincount((row + leaves.feature[:, i]).ravel(), phi.ravel(), n * width)
    return out.reshape(n, width)


def explain_rows(groups: Sequence[Leaves], x: np.ndarray, width: int) -> np.ndarray:
    """Shapley values of rows of features, in pieces of bounded size."""
    phi = np.zeros((len(x), width))
    for g in groups:
        leaves_at_once = max(1, min(len(g.value), CELLS // 16))
        rows_at_once = max(1, CELLS // leaves_at_once)
        for a in range(0, len(g.value), leaves_at_once):
            part = Leaves(*(getattr(g, f.name)[a:a + leaves_at_once] for f in fields(g)))
            for lo in range(0, len(x), rows_at_once):
                phi[lo:lo + rows_at_once] += contributions(part, x[lo:lo + rows_at_once], width)
    return phi


def shap_values(model: PipelineModel, df: DataFrame, features: Sequence[str], id_col: str) -> DataFrame:
    """``(id, base, phi)``: one array of contributions to the log-odds per row; base plus their sum is the score."""
    gbt = gbt_stage(model)
    groups, base = leaves_by_length(gbt.unpacked())
    base += gbt.getOrDefault("base")
    width = gbt.numFeatures
    rows = PipelineModel(stages=[s for s in model.stages if s is not gbt]).transform(
        vectorized(df.select(*dict.fromkeys([id_col, *features])), features)
    )
    column = gbt.getFeaturesCol()
    plain = rows.select(F.col(id_col).cast("bigint").alias("id"), vector_to_array(column).alias("x"))

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            phi = explain_rows(groups, np.stack(batch["x"].to_numpy()).astype(float), width)
            yield pd.DataFrame({"id": batch["id"], "base": base, "phi": list(phi)})

    return plain.mapInPandas(explain, "id bigint, base double, phi array<double>")


def mean_abs_attribution(values: DataFrame, names: Sequence[str]) -> DataFrame:
    """``(feature, mean_abs_shap)`` over all explained rows."""
    labels = F.array(*[F.lit(n) for n in names])
    return (
        values.select(F.posexplode("phi").alias("position", "value")).groupBy("position")
        .agg(F.avg(F.abs("value")).alias("mean_abs_shap"))
        .select(F.get(labels, F.col("position")).alias("feature"), "mean_abs_shap")
    )


def topk_attribution(attribution: DataFrame, k: int = 20) -> DataFrame:
    return attribution.orderBy(F.col("mean_abs_shap").desc(), "feature").limit(k)


def seeded_sample(df: DataFrame, id_col: str, n: int = 1000, seed: int = 42) -> DataFrame:
    """The ``n`` rows with the smallest hash of id and seed: fixed for any partitioning."""
    return df.orderBy(keyed_hash(id_col, seed), id_col).limit(n)


def selected_names(model: PipelineModel, names: Sequence[str]) -> list[str]:
    """Names behind the vector the boosted trees read, after a slicer if there is one."""
    for stage in model.stages:
        if stage.hasParam("indices"):
            return [names[i] for i in stage.getOrDefault("indices")]
    return list(names)


def native_importance(model: PipelineModel, df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The trees' own importances under the column name of the attribution report."""
    table = importance_table(df.sparkSession, selected_names(model, names), gbt_stage(model).featureImportances)
    return table.select("feature", F.col("importance").alias("mean_abs_shap"))


def permutation_importance(model: PipelineModel, df: DataFrame, features: Sequence[str], label: str, id_col: str,
                           seed: int = 42) -> DataFrame:
    """Loss of ROC AUC when one feature's values are dealt to other rows.

    Values are exchanged by joining on ranks in two hash orders, so the whole column is permuted without any
    global sort. One scoring per feature.
    """
    def auc(rows: DataFrame) -> float:
        return auc_roc(probability(model, rows, features, "p", keep=[label]), label, "p").first()["auc_roc"] or 0.0

    whole = auc(df)
    here = hash_rank(df.select(*dict.fromkeys([id_col, label, *features])), id_col, seed)
    losses = []
    for i, feature in enumerate(features):
        dealt = hash_rank(df.select(id_col, feature), id_col, seed + 1 + i).select(
            "__rank", F.col(feature).alias("__dealt")
        )
        mixed = here.join(dealt, "__rank").drop(feature).withColumnRenamed("__dealt", feature)
        losses.append((feature, whole - auc(mixed)))
    return df.sparkSession.createDataFrame(losses, "feature string, auc_loss double")


def attribution(model: PipelineModel, df: DataFrame, features: Sequence[str], names: Sequence[str], id_col: str,
                method: str = "shap", k: int = 20) -> DataFrame:
    """Top features by mean absolute contribution over all rows of ``df``, or by the trees' own importances."""
    if method == "native":
        return topk_attribution(native_importance(model, df, names), k)
    values = shap_values(model, df, features, id_col)
    return topk_attribution(mean_abs_attribution(values, selected_names(model, names)), k)
