"""Split, impute, encode and scale. Statistics are fitted on the training period and kept in small tables.

``*_fit`` returns a table. Fits with one number per column are read back as literals when applied (their size
is the number of columns); frequency and target maps grow with the data and are always joined.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom import schema as S
from riskloom.functions.shape import keyed_hash, melt, ratio
from riskloom.operators.digits import exact_quantiles
from riskloom.session import cut_lineage

UNKNOWN_TARGET = "_unknown_"
UNKNOWN_CATEGORY = "unknown"


# -- split -----------------------------------------------------------------------------------------------------


def split_point(df: DataFrame, time_col: str = S.TIME, test_size: float = 0.2, exact: bool = True) -> Column:
    """The ``1 - test_size`` quantile of time as a scalar subquery."""
    if exact:
        return exact_quantiles(df, [time_col], [1.0 - test_size]).select("value").scalar()
    return df.agg(F.percentile_approx(time_col, 1.0 - test_size, 10_000).alias("value")).scalar()


def with_split(df: DataFrame, time_col: str = S.TIME, test_size: float = 0.2, exact: bool = True) -> DataFrame:
    """Add ``split``: 'train' up to and including the split point, 'test' after it; rows without time drop out."""
    cut = split_point(df, time_col, test_size, exact)
    return df.where(F.col(time_col).isNotNull()).withColumn(
        "split", F.when(F.col(time_col) <= cut, "train").otherwise("test")
    )


def temporal_split(df: DataFrame, time_col: str = S.TIME, test_size: float = 0.2,
                   exact: bool = True) -> tuple[DataFrame, DataFrame]:
    cut = split_point(df, time_col, test_size, exact)
    return df.where(F.col(time_col) <= cut), df.where(F.col(time_col) > cut)


# -- fits with one number per column ---------------------------------------------------------------------------


def median_fit(df: DataFrame, columns: Sequence[str], accuracy: int | None = None) -> DataFrame:
    """``(feature, fill)``: exact medians, or sketched ones when ``accuracy`` is given."""
    if accuracy is None:
        return exact_quantiles(df, columns, [0.5]).select("feature", F.col("value").alias("fill"))
    return (
        melt(df, columns).groupBy("feature")
        .agg(F.percentile_approx("value", 0.5, accuracy).alias("fill"))
    )


def mode_fit(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, fill)``: the most frequent value, the smallest on ties, 0 for an empty column.

    Counting per value first keeps the state of each task at the values it owns.
    """
    counts = melt(df, columns).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    modes = counts.groupBy("feature").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"))
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "feature string")
    return names.join(modes, "feature", "left").select(
        "feature", F.coalesce("mode", F.lit(0.0)).alias("fill")
    )


def fill_values(fitted: DataFrame) -> dict[str, float]:
    return {r["feature"]: r["fill"] for r in fitted.collect()}


def impute(df: DataFrame, fitted: DataFrame, indicators: Sequence[str] = ()) -> DataFrame:
    """Fill missing values with the fitted ones; ``<column>_missing`` flags what was missing before.

    One ``select`` for all columns, so the plan stays flat however wide the row is.
    """
    fills = fill_values(fitted)
    flagged = set(indicators)
    missing = lambda c: F.col(c).isNull() | F.isnan(F.col(c).cast("double"))
    filled = [
        F.when(missing(c), F.lit(fills[c])).otherwise(F.col(c).cast("double")).alias(c)
        if fills.get(c) is not None else F.col(c)
        for c in df.columns
    ]
    flags = [missing(c).cast("int").alias(f"{c}_missing") for c in df.columns if c in flagged]
    return df.select(*filled, *flags)


def flag_encode(df: DataFrame, columns: Sequence[str], truthy: str = "T", fill: str = "F") -> DataFrame:
    """1 where the value equals ``truthy``; missing values count as ``fill``."""
    wanted = set(columns)
    return df.select(*[
        (F.coalesce(F.col(c), F.lit(fill)) == truthy).cast("int").alias(c) if c in wanted else F.col(c)
        for c in df.columns
    ])


def scaler_fit(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, mean, std)`` with the population deviation."""
    row = df.agg(*[
        F.struct(F.avg(F.col(c).cast("double")).alias("mean"), F.stddev_pop(F.col(c).cast("double")).alias("std"))
        .alias(c) for c in columns
    ])
    entries = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c)["mean"].alias("mean"), F.col(c)["std"].alias("std"))
        for c in columns
    ])
    return row.select(F.inline(entries))


def scale(df: DataFrame, fitted: DataFrame) -> DataFrame:
    """``(x - mean) / std``; a constant column divides by 1."""
    stats = {r["feature"]: (r["mean"], r["std"]) for r in fitted.collect()}
    return df.select(*[
        ((F.col(c).cast("double") - stats[c][0]) / (stats[c][1] or 1.0)).alias(c)
        if c in stats and stats[c][0] is not None else F.col(c)
        for c in df.columns
    ])


# -- maps ------------------------------------------------------------------------------------------------------


def freq_fit(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, value, freq)``: each value's share of the non-null rows of its column."""
    counts = melt(df, columns).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("feature").agg(F.sum("n").alias("total"))
    return counts.join(totals, "feature").select(
        "feature", "value", (F.col("n") / F.col("total")).alias("freq")
    )


def freq_encode(df: DataFrame, fitted: DataFrame, columns: Sequence[str], train_rows: Column | int) -> DataFrame:
    """Replace values by their training share; unseen and missing ones become ``1 / train_rows``.

    The map is written first: its size is then known before the rows are planned, and a map below the broadcast threshold never
    makes them move. A larger one is joined by key; missing values, which match nothing, do not take part, and adaptive execution
    splits hot values (map keys are unique, so nothing is multiplied).
    """
    fitted = cut_lineage(fitted, "map")
    default = F.lit(1.0) / (F.lit(train_rows) if isinstance(train_rows, int) else train_rows)
    for c in columns:
        lookup = fitted.where(F.col("feature") == c).select(
            F.col("value").alias("__value"), F.col("freq").alias("__freq")
        )
        df = df.join(lookup, F.col(c).cast("double") == F.col("__value"), "left").select(
            *[F.coalesce("__freq", default).alias(c) if x == c else F.col(x) for x in df.columns]
        )
    return df


def target_fit(df: DataFrame, columns: Sequence[str], label: str = S.LABEL, k: float = 10.0) -> DataFrame:
    """``(feature, value, rate, global_rate)`` with ``rate = (positives + k * global) / (rows + k)``."""
    entries = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.coalesce(F.col(c), F.lit(UNKNOWN_TARGET)).alias("value"))
        for c in columns
    ])
    counts = (
        df.select(label, F.inline(entries)).groupBy("feature", "value")
        .agg(F.sum(F.col(label).cast("double")).alias("positives"), F.count(label).alias("n"))
    )
    overall = counts.groupBy("feature").agg((F.sum("positives") / F.sum("n")).alias("global_rate"))
    smoothed = (F.col("positives") + k * F.col("global_rate")) / (F.col("n") + k)
    return counts.join(overall, "feature").select("feature", "value", smoothed.alias("rate"), "global_rate")


def target_encode(df: DataFrame, fitted: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace categories by their smoothed rate; unseen ones get the global rate. The map is written first, as above."""
    fitted = cut_lineage(fitted, "map")
    overall = fitted.agg(F.first("global_rate").alias("g")).scalar()
    for c in columns:
        lookup = fitted.where(F.col("feature") == c).select(
            F.col("value").alias("__value"), F.col("rate").alias("__rate")
        )
        key = F.coalesce(F.col(c), F.lit(UNKNOWN_TARGET))
        df = df.join(lookup, key == F.col("__value"), "left").select(
            *[F.coalesce("__rate", overall).alias(c) if x == c else F.col(x) for x in df.columns]
        )
    return df


def target_encode_out_of_fold(df: DataFrame, columns: Sequence[str], id_col: str, label: str = S.LABEL,
                              k: float = 10.0, folds: int = 5, seed: int = 42) -> DataFrame:
    """Encode every training row by the rates of the other folds, so its own label does not leak in.

    One grouped pass per column: the other folds' sums are the totals less the row's own fold.
    """
    fold = F.pmod(keyed_hash(id_col, seed), F.lit(folds)).alias("__fold")
    df = df.select("*", fold)
    fold_totals = df.groupBy("__fold").agg(F.sum(F.col(label).cast("double")).alias("__fp"), F.count(label).alias("__fn"))
    grand = fold_totals.agg(F.struct(F.sum("__fp").alias("p"), F.sum("__fn").alias("n")).alias("s")).scalar()
    rest_rate = fold_totals.select(
        "__fold", ratio(grand["p"] - F.col("__fp"), grand["n"] - F.col("__fn")).alias("__g")
    )
    df = df.join(F.broadcast(rest_rate), "__fold")  # one row per fold
    for c in columns:
        key = F.coalesce(F.col(c), F.lit(UNKNOWN_TARGET)).alias("__key")
        per_fold = df.groupBy(key, "__fold").agg(
            F.sum(F.col(label).cast("double")).alias("__p"), F.count(label).alias("__n")
        )
        totals = per_fold.groupBy("__key").agg(F.sum("__p").alias("__tp"), F.sum("__n").alias("__tn"))
        rest = per_fold.join(totals, "__key").select(
            "__key", "__fold", (F.col("__tp") - F.col("__p")).alias("__rp"), (F.col("__tn") - F.col("__n")).alias("__rn")
        )
        kept = [x for x in df.columns]
        rate = (F.col("__rp") + k * F.col("__g")) / (F.col("__rn") + k)
        df = df.withColumn("__key", key).join(rest, ["__key", "__fold"], "left").select(
            *[rate.alias(c) if x == c else F.col(x) for x in kept]
        )
    return df.drop("__fold", "__g")


# -- one-hot ---------------------------------------------------------------------------------------------------


def _category(column: str, dtype: T.DataType) -> Column:
    """Whole numbers print without decimals, so the column name does not depend on the storage type."""
    value = F.col(column)
    text = value.cast("string")
    if isinstance(dtype, T.NumericType):
        whole = value.cast("bigint")
        text = F.when(whole.cast("double") == value.cast("double"), whole.cast("string")).otherwise(text)
    return F.coalesce(text, F.lit(UNKNOWN_CATEGORY))


def _flag_name(column: str, value: str) -> str:
    """``<column>_<value>``; dots and backquotes, which Spark reads as syntax, become underscores."""
    return re.sub(r"[.`]", "_", f"{column}_{value}")


def one_hot_fit(df: DataFrame, columns: Sequence[str], max_categories: int | None = None) -> DataFrame:
    """``(feature, value)``: the categories seen, missing values being 'unknown'. A limit may be set, and is an error beyond it."""
    types = {f.name: f.dataType for f in df.schema.fields}
    entries = F.array(*[
        F.struct(F.lit(c).alias("feature"), _category(c, types[c]).alias("value")) for c in columns
    ])
    fitted = df.select(F.inline(entries)).distinct()
    if max_categories is None:
        return fitted
    counts = fitted.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_categories)
    wide = [r["feature"] for r in counts.collect()]
    if wide:
        raise ValueError(f"more than {max_categories} categories in {sorted(wide)}")
    return fitted


def one_hot(df: DataFrame, fitted: DataFrame) -> DataFrame:
    """Replace each fitted column by 0/1 columns ``<column>_<value>`` in sorted order; unseen values set none.

    Names that clash, with each other or with a column that stays, keep columns of their own: the later ones get ``__2``, ``__3``, ... added.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    seen: dict[str, list[str]] = {}
    for row in fitted.orderBy("feature", "value").collect():
        seen.setdefault(row["feature"], []).append(row["value"])
    kept = [c for c in df.columns if c not in seen]
    taken = {c.lower() for c in kept}
    flags = []
    for c in df.columns:
        for value in seen.get(c, []):
            base, n = _flag_name(c, value), 1
            name = base
            while name.lower() in taken:
                n += 1
                name = f"{base}__{n}"
            taken.add(name.lower())
            flags.append((_category(c, types[c]) == value).cast("int").alias(name))
    return df.select(*[F.col(f"`{c}`") for c in kept], *flags)


def one_hot_index(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, value, index)``: every category with its place in the vector of :func:`one_hot_vector`, a row each.

    Places run by feature in the given order, then by value. They come from counts per range of values, so a column may have any number of
    categories; nothing of them reaches the driver.
    """
    order = F.create_map(*[x for i, c in enumerate(columns) for x in (F.lit(c), F.lit(i))])
    fitted = cut_lineage(one_hot_fit(df, columns).withColumn("place", order[F.col("feature")]), "categories")
    # Sorted over the cluster; a partition's first place is the number of rows in those before it.
    dealt = cut_lineage(fitted.repartitionByRange("place", "value").sortWithinPartitions("place", "value").withColumn("row", F.monotonically_increasing_id()), "sorted")
    part, at = F.shiftright("row", 33), F.col("row").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = dealt.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    # One row for each partition.
    return dealt.withColumn("part", part).join(F.broadcast(before), "part").select("feature", "value", (F.col("first") + at).alias("index"))


def one_hot_vector(df: DataFrame, index: DataFrame, columns: Sequence[str], id_col: str, output: str = "flags") -> DataFrame:
    """Add ``output``: a sparse vector with a 1 for the category of each column; values that ``index`` lacks set none.

    Rows go long, one for each column, meet the dictionary by (feature, value), and come together again by ``id_col``, which must be unique.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    size = index.count()
    entries = F.array(*[F.struct(F.lit(c).alias("feature"), _category(c, types[c]).alias("value")) for c in columns])
    long = df.select(F.col(id_col).alias("__id"), F.inline(entries))
    places = long.join(index, ["feature", "value"]).groupBy("__id").agg(F.sort_array(F.collect_list("index")).alias("__at"))  # one for each column at most
    joined = df.join(places, F.col(id_col).eqNullSafe(F.col("__id")), "left").drop("__id")

    @F.udf(VectorUDT())
    def sparse(at):
        return Vectors.sparse(size, at or [], [1.0] * len(at or []))

    return joined.withColumn(output, sparse("__at")).drop("__at")


# -- schema ----------------------------------------------------------------------------------------------------


def drop_columns(df: DataFrame, names: Sequence[str] = (S.KEY, S.TIME), strings: bool = True) -> DataFrame:
    """Drop identifiers and whatever text is left."""
    text = {f.name for f in df.schema.fields if strings and isinstance(f.dataType, T.StringType)}
    return df.select(*[c for c in df.columns if c not in names and c not in text])


def align_schema(df: DataFrame, columns: Sequence[str], fill: float = 0) -> DataFrame:
    """Exactly ``columns`` in this order: absent ones hold ``fill``, others drop out."""
    present = set(df.columns)
    return df.select(*[F.col(c) if c in present else F.lit(fill).alias(c) for c in columns])


# -- the whole stage -------------------------------------------------------------------------------------------


def prepare(train: DataFrame, test: DataFrame, label: str = S.LABEL, key: str = S.KEY, time_col: str = S.TIME,
            smoothing: float = 10.0, scaled: bool = True,
            keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame, dict[str, DataFrame]]:
    """All preparation steps in order, fitted on ``train``; returns both sides and the fitted tables.

    Columns in ``keep`` pass through unchanged. The cleaned and the encoded rows are each written once, so that no fit repeats the joins before it.
    """
    groups = S.column_groups(train)
    medians = median_fit(train, groups["v"] + groups["c"] + groups["d"] + groups["id_numeric"]
                         + [c for c in ("addr1", "addr2") if c in train.columns])
    fills = medians.unionByName(mode_fit(train, groups["mode"])) if groups["mode"] else medians
    fills = cut_lineage(fills, "fills")

    def clean(df: DataFrame) -> DataFrame:
        df = impute(df, fills, indicators=groups["v"])
        df = flag_encode(df, groups["m"], fill="missing")
        return cut_lineage(flag_encode(df, groups["id_flag"]), "clean")

    train, test = clean(train), clean(test)
    fitted = {"fills": fills}
    if groups["frequency"]:
        fitted["freq"] = cut_lineage(freq_fit(train, groups["frequency"]), "freq")
        rows = train.count()
        train, test = (freq_encode(x, fitted["freq"], groups["frequency"], rows) for x in (train, test))
    if groups["target"]:
        fitted["target"] = cut_lineage(target_fit(train, groups["target"], label, smoothing), "target")
        train, test = (target_encode(x, fitted["target"], groups["target"]) for x in (train, test))
    if groups["one_hot"]:
        fitted["one_hot"] = one_hot_fit(train, groups["one_hot"])
        train, test = (one_hot(x, fitted["one_hot"]) for x in (train, test))
    train = drop_columns(train, [c for c in (key, time_col) if c not in keep])
    test = align_schema(test, train.columns)
    if scaled:
        train = cut_lineage(train, "encoded")
        fitted["scaler"] = scaler_fit(train, [c for c in train.columns if c != label and c not in keep])
        train, test = scale(train, fitted["scaler"]), scale(test, fitted["scaler"])
    return train, test, fitted
