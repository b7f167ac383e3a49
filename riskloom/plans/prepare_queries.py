"""Imputation, encoding, scaling and derived features."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions.shape import melt
from riskloom.operators import features, learn, prepare
from riskloom.plans.fixtures import TX_SQL, identity, scored, table, tx
from riskloom.plans.data_queries import wide_names
from riskloom.plans.registry import query
from riskloom.session import cut_lineage
from riskloom.sources import requests, tables

MEDIANS = ("v1", "v2", "v3", "v4", "v5", "c1", "d1", "d15", "addr1", "addr2")


def halves(spark, sf, *columns):
    return prepare.temporal_split(tx(spark, sf, *dict.fromkeys(("dt", *columns))), "dt")


def median_sql(columns):
    return ", med as (select " + ", ".join(f"quantile_cont({c}, 0.5) as {c}" for c in columns) + " from train)"


# -- fits ------------------------------------------------------------------------------------------------------


@query("median_fit", TX_SQL + " union all ".join(
    f"select '{c}' as feature, round(quantile_cont({c}, 0.5), 6) as fill from train" for c in MEDIANS))
def _(spark, sf):
    train, _ = halves(spark, sf, *MEDIANS)
    return prepare.median_fit(train, MEDIANS).withColumn("fill", F.round("fill", 6))


@query("mode_fit", TX_SQL + """
select 'card1' as feature, card1 as fill from (select card1 from train where card1 is not null group by 1
  order by count(*) desc, card1 limit 1)
union all
select 'card2', card2 from (select card2 from train where card2 is not null group by 1
  order by count(*) desc, card2 limit 1)""")
def _(spark, sf):
    train, _ = halves(spark, sf, "card1", "card2")
    return prepare.mode_fit(train, ["card1", "card2"])


@query("freq_fit", TX_SQL + " union all ".join(
    f"""select '{c}' as feature, {c} as value, round(count(*) / (select count({c}) from train), 8) as freq
        from train where {c} is not null group by {c}""" for c in ("card1", "card2", "addr1", "addr2")))
def _(spark, sf):
    columns = ["card1", "card2", "addr1", "addr2"]
    train, _ = halves(spark, sf, *columns)
    return prepare.freq_fit(train, columns).withColumn("freq", F.round("freq", 8))


@query("target_fit", TX_SQL + """
, g as (select avg(y) as rate from train)
select 'pemail' as feature, coalesce(pemail, '_unknown_') as value,
       round((sum(y) + 10 * any_value(g.rate)) / (count(*) + 10), 8) as rate,
       round(any_value(g.rate), 8) as global_rate from train, g group by 2
union all
select 'productcd', productcd, round((sum(y) + 10 * any_value(g.rate)) / (count(*) + 10), 8),
       round(any_value(g.rate), 8) from train, g group by 2""")
def _(spark, sf):
    train, _ = halves(spark, sf, "y", "pemail", "productcd")
    fitted = prepare.target_fit(train, ["pemail", "productcd"], "y")
    return fitted.select("feature", "value", F.round("rate", 8).alias("rate"),
                         F.round("global_rate", 8).alias("global_rate"))


@query("class_counts", TX_SQL + """
select cast(sum(y) as bigint) as n_pos, count(*) - cast(sum(y) as bigint) as n_neg,
       round((count(*) - sum(y)) / greatest(sum(y), 1), 6) as weight from train""")
def _(spark, sf):
    train, _ = halves(spark, sf, "y")
    return learn.class_counts(train, "y").withColumn("weight", F.round("weight", 6))


@query("scaler_fit", TX_SQL + " union all ".join(
    f"select '{c}' as feature, round(avg({c}), 4) as mean, round(stddev_pop({c}), 4) as std from train"
    for c in ("amt", "card1", "d1", "v1", "v4")))
def _(spark, sf):
    columns = ["amt", "card1", "d1", "v1", "v4"]
    train, _ = halves(spark, sf, *columns)
    fitted = prepare.scaler_fit(train, columns)
    return fitted.select("feature", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"))


# -- transforms ------------------------------------------------------------------------------------------------


@query("missing_indicator", TX_SQL + """
select tid, (v1 is null)::int as v1_missing, (d1 is null)::int as d1_missing, (card2 is null)::int as card2_missing
from tx""")
def _(spark, sf):
    df = tx(spark, sf, "tid", "v1", "d1", "card2")
    flagged = prepare.impute(df, prepare.mode_fit(df.limit(0), ["v1"]), ["v1", "d1", "card2"])
    return flagged.select("tid", "v1_missing", "d1_missing", "card2_missing")


@query("median_impute", TX_SQL + median_sql(("v1", "v4", "c1", "d1", "addr2")) + """
select tid, coalesce(t.v1, med.v1) as v1, round(coalesce(t.v4, med.v4), 8) as v4, coalesce(t.c1, med.c1) as c1,
       coalesce(t.d1, med.d1) as d1, coalesce(t.addr2, med.addr2) as addr2 from test t, med""")
def _(spark, sf):
    columns = ["v1", "v4", "c1", "d1", "addr2"]
    train, test = halves(spark, sf, "tid", *columns)
    out = prepare.impute(test, prepare.median_fit(train, columns))
    return out.select("tid", "v1", F.round("v4", 8).alias("v4"), "c1", "d1", "addr2")


@query("mode_impute", TX_SQL + """
select tid, card1, coalesce(card2, (select card2 from train where card2 is not null group by 1
  order by count(*) desc, card2 limit 1)) as card2 from tx""")
def _(spark, sf):
    train, _ = halves(spark, sf, "card1", "card2")
    df = tx(spark, sf, "tid", "card1", "card2")
    return prepare.impute(df, prepare.mode_fit(train, ["card1", "card2"]))


@query("flag_encode", TX_SQL + """
select tx.tid, case when m1 = 'T' then 1 else 0 end as m1, case when id_12 = 'T' then 1 else 0 end as id_12
from tx left join ident on tx.tid = ident.tid""")
def _(spark, sf):
    df = tables.join_identity(tx(spark, sf, "tid", "m1"), identity(spark, sf).select("tid", "id_12"), "tid")
    return prepare.flag_encode(prepare.flag_encode(df, ["m1"], fill="missing"), ["id_12"])


@query("freq_encode", TX_SQL + ", n as (select count(*) as rows_ from train)" + "".join(
    f", f_{c} as (select {c}, count(*) / (select count({c}) from train) as freq from train where {c} is not null group by {c})"
    for c in ("card1", "card2", "addr2")) + """
select tx.tid, round(coalesce(a.freq, 1.0::double / rows_), 8) as card1, round(coalesce(b.freq, 1.0::double / rows_), 8) as card2,
       round(coalesce(c.freq, 1.0::double / rows_), 8) as addr2
from tx left join f_card1 a on tx.card1 = a.card1 left join f_card2 b on tx.card2 = b.card2
left join f_addr2 c on tx.addr2 = c.addr2, n""")
def _(spark, sf):
    columns = ["card1", "card2", "addr2"]
    train, _ = halves(spark, sf, *columns)
    rows = train.agg(F.count(F.lit(1)).alias("n")).scalar()
    out = prepare.freq_encode(tx(spark, sf, "tid", *columns), prepare.freq_fit(train, columns), columns, rows)
    return out.select("tid", *[F.round(c, 8).alias(c) for c in columns])


@query("target_encode", TX_SQL + """
, g as (select avg(y) as rate from train),
m as (select coalesce(pemail, '_unknown_') as k, (sum(y) + 10 * any_value(g.rate)) / (count(*) + 10) as enc
      from train, g group by 1)
select tx.tid, round(coalesce(enc, g.rate), 8) as pemail
from tx left join m on coalesce(tx.pemail, '_unknown_') = m.k, g""")
def _(spark, sf):
    train, _ = halves(spark, sf, "y", "pemail")
    fitted = prepare.target_fit(train, ["pemail"], "y")
    out = prepare.target_encode(tx(spark, sf, "tid", "pemail"), fitted, ["pemail"])
    return out.select("tid", F.round("pemail", 8).alias("pemail"))


@query("target_encode_out_of_fold", TX_SQL + """
, f as (select tid, y, coalesce(pemail, '_unknown_') as k, ('0x' || substr(md5('42:' || tid::varchar), 1, 15))::bigint % 5 as fold from train),
g as (select fold, ((select sum(y) from f) - sum(y)) / ((select count(*) from f) - count(*)) as rate from f group by 1),
own as (select k, fold, sum(y) as p, count(*) as n from f group by 1, 2),
every as (select k, sum(y) as p, count(*) as n from f group by 1)
select f.tid, round((every.p - own.p + 10 * g.rate) / (every.n - own.n + 10), 8) as pemail
from f join own on f.k = own.k and f.fold = own.fold join every on f.k = every.k join g on f.fold = g.fold""")
def _(spark, sf):
    train, _ = halves(spark, sf, "tid", "y", "pemail")
    out = prepare.target_encode_out_of_fold(train, ["pemail"], "tid", "y")
    return out.select("tid", F.round("pemail", 8).alias("pemail"))


@query("one_hot", TX_SQL + """
select tx.tid,
  (productcd = '1-URGENT')::int as "productcd_1-URGENT", (productcd = '2-HIGH')::int as "productcd_2-HIGH",
  (productcd = '3-MEDIUM')::int as "productcd_3-MEDIUM",
  (productcd = '4-NOT SPECIFIED')::int as "productcd_4-NOT SPECIFIED", (productcd = '5-LOW')::int as "productcd_5-LOW",
  (coalesce(devicetype, 'unknown') = 'desktop')::int as devicetype_desktop,
  (coalesce(devicetype, 'unknown') = 'mobile')::int as devicetype_mobile,
  (coalesce(devicetype, 'unknown') = 'unknown')::int as devicetype_unknown
from tx left join ident on tx.tid = ident.tid""")
def _(spark, sf):
    base = tx(spark, sf, "tid", "dt", "productcd")
    df = tables.join_identity(base, identity(spark, sf).select("tid", "devicetype"), "tid")
    train, _ = prepare.temporal_split(df, "dt")
    fitted = prepare.one_hot_fit(train, ["productcd", "devicetype"])
    return prepare.one_hot(df, fitted).drop("dt")


@query("one_hot_vector", TX_SQL + """
, cats as (select distinct 0 as place, card1::bigint::varchar as value from train union select distinct 1, productcd from train),
idx as (select *, row_number() over (order by place, value) - 1 as i from cats),
long as (select tid, 0 as place, card1::bigint::varchar as value from tx union all select tid, 1, productcd from tx)
select tid, coalesce(string_agg(i::varchar, ',' order by i), '') as at, (select count(*) from idx) as size
from long left join idx using (place, value) group by tid""")
def _(spark, sf):
    """Customers and priorities as one sparse vector; customers that the training period lacks set nothing."""
    df = tx(spark, sf, "tid", "dt", "card1", "productcd")
    train, _ = prepare.temporal_split(df, "dt")
    index = cut_lineage(prepare.one_hot_index(train, ["card1", "productcd"]), "index")
    flags = F.col("flags")
    told = F.udf(lambda v: [",".join(map(str, v.indices.tolist())), str(v.size)], "array<string>")
    out = prepare.one_hot_vector(df, index, ["card1", "productcd"], "tid").select("tid", told(flags).alias("v"))
    return out.select("tid", F.get("v", F.lit(0)).alias("at"), F.get("v", F.lit(1)).cast("bigint").alias("size"))


@query("one_hot_documents", """
select doc_id, (lang = 'de')::int as lang_de, (lang = 'en')::int as lang_en, (lang = 'es')::int as lang_es,
       (lang = 'fr')::int as lang_fr, quality, toxic
from documents join labels using (doc_id)""")
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    labelled = docs.join(table(spark, sf, "labels"), "doc_id")
    return prepare.one_hot(labelled, prepare.one_hot_fit(docs, ["lang"]))


@query("standard_scale", TX_SQL + """
, s as (select avg(amt) ma, stddev_pop(amt) sa, avg(v1) mv, stddev_pop(v1) sv from train)
select tid, round((amt - ma) / sa, 6) as amt, round((v1 - mv) / sv, 6) as v1 from test, s""")
def _(spark, sf):
    train, test = halves(spark, sf, "tid", "amt", "v1")
    out = prepare.scale(test, prepare.scaler_fit(train, ["amt", "v1"]))
    return out.select("tid", F.round("amt", 6).alias("amt"), F.round("v1", 6).alias("v1"))


STAGE = {"TransactionAmt": "amt", "C1": "c1", "D1": "d1", "card1": "card1", "P_emaildomain": "pemail", "V1_missing": "v1_missing",
         "M1": "m1", "ProductCD_1-URGENT": "urgent"}


@query("prepare_stage", TX_SQL + """
, med as (select quantile_cont(c1, 0.5) as c1, quantile_cont(d1, 0.5) as d1 from train),
f as (select card1, count(*) / (select count(card1) from train) as freq from train group by card1),
g as (select avg(y) as rate, count(*) as rows_ from train),
m as (select coalesce(pemail, '_unknown_') as k, (sum(y) + 10 * any_value(g.rate)) / (count(*) + 10) as enc from train, g group by 1),
enc as (
  select dt <= cut_dt as is_train, amt, coalesce(t.c1, med.c1) as c1, coalesce(t.d1, med.d1) as d1,
         coalesce(freq, 1.0::double / rows_) as card1, coalesce(enc, g.rate) as pemail, (t.v1 is null)::int as v1_missing,
         (coalesce(m1, 'missing') = 'T')::int as m1, (productcd = '1-URGENT')::int as urgent
  from tx t left join f on t.card1 = f.card1 left join m on coalesce(t.pemail, '_unknown_') = m.k, med, g, cut),
s as (select """ + ", ".join(f"avg({c}) as m_{c}, stddev_pop({c}) as s_{c}" for c in STAGE.values()) + """ from enc where is_train)
select """ + ", ".join(f'round(({c} - m_{c}) / s_{c}, 5) as "{n}"' for n, c in STAGE.items()) + """,
       round((c1 - m_c1) / s_c1, 5) as "C_sum" from enc, s where not is_train""")
def _(spark, sf):
    df = wide_names(tables.join_identity(tx(spark, sf), identity(spark, sf), "tid"))
    train, test = prepare.temporal_split(df)
    train, test, _ = prepare.prepare(train, test)
    return features.add_features(test).select(*[F.round(F.col(f"`{c}`"), 5).alias(c) for c in (*STAGE, "C_sum")])


# -- derived features ------------------------------------------------------------------------------------------


def slice_sql(first, last, name):
    part = f"list_transform(embedding[{first}:{last}], lambda x: x::double)"
    n = last - first + 1
    mean = f"(list_sum({part}) / {n})"
    return (f"coalesce(nullif(round(list_sum({part}), 4), 0), 0) as {name}_sum, "
            f"coalesce(nullif(round({mean}, 5), 0), 0) as {name}_mean, round(sqrt((list_sum(list_transform({part}, lambda x: x * x)) - {n} * {mean} * {mean}) / {n - 1}), 5) as {name}_std")


GROUPS = {"V_g1": (1, 11), "V_g2": (12, 34), "V_g3": (35, 52), "V_g4": (53, 64)}


@query("v_group_agg", "select vec_id, " + ", ".join(slice_sql(a, b, g) for g, (a, b) in GROUPS.items())
       + " from embeddings")
def _(spark, sf):
    df = table(spark, sf, "embeddings")
    out = df.select("vec_id", *features.v_group_slices("embedding", GROUPS))
    # A sum just below zero rounds to -0.0, which is written as 0 here.
    shown = {c: F.round(c, 4 if c.endswith("_sum") else 5) for c in out.columns if c != "vec_id"}
    return out.select("vec_id", *[F.when(r == 0, 0.0).otherwise(r).alias(c) for c, r in shown.items()])


@query("v_group_wide", TX_SQL + """
select tid, round(list_sum(x), 6) as "V_g1_sum", round(list_avg(x), 6) as "V_g1_mean",
       round(coalesce(case when len(x) > 1 then list_stddev_samp(x) end, 0), 6) as "V_g1_std"
from (select tid, list_filter([v1, v3, v5], lambda e: e is not null) as x from tx) where len(x) > 0
union all
select tid, 0, null, 0 from tx where v1 is null and v3 is null and v5 is null""")
def _(spark, sf):
    df = tx(spark, sf, "tid", "v1", "v3", "v5").withColumnsRenamed({"v1": "V1", "v3": "V3", "v5": "V5"})
    out = df.select("tid", *features.v_group_columns(df.columns))
    return out.select("tid", *[F.round(c, 6).alias(c) for c in out.columns if c != "tid"])


@query("total_missing", TX_SQL + """
select tid, cast((v1 is null)::int + (v2 is null)::int + (d1 is null)::int + (card2 is null)::int as bigint)
       as total_v_missing from tx""")
def _(spark, sf):
    df = tx(spark, sf, "tid", "v1", "v2", "d1", "card2")
    flags = [F.col(c).isNull().cast("int").alias(f"{c}_missing") for c in ("v1", "v2", "d1", "card2")]
    flagged = df.select("tid", *flags)
    return flagged.select("tid", features.total_missing(flagged.columns))


@query("card_interaction", TX_SQL + "select tid, card1 * card2 as card1_card2_interact from tx")
def _(spark, sf):
    return tx(spark, sf, "tid", "card1", "card2").select("tid", features.interaction("card1", "card2"))


@query("c_sum_mean", TX_SQL + """
select tid, coalesce(c1, 0) + coalesce(d1, 0) + coalesce(d15, 0) as "C_sum",
       round((coalesce(c1, 0) + coalesce(d1, 0) + coalesce(d15, 0))
         / nullif((c1 is not null)::int + (d1 is not null)::int + (d15 is not null)::int, 0), 8) as "C_mean" from tx""")
def _(spark, sf):
    df = tx(spark, sf, "tid", "c1", "d1", "d15")
    out = df.select("tid", *features.row_sum_mean(["c1", "d1", "d15"], "C"))
    return out.withColumn("C_mean", F.round("C_mean", 8))


@query("d_ratio", TX_SQL + "select tid, round(d1 / (abs(d15) + 1e-6), 8) as d1_d15_ratio from tx")
def _(spark, sf):
    df = tx(spark, sf, "tid", "d1", "d15")
    return df.select("tid", features.abs_ratio("d1", "d15")).withColumn("d1_d15_ratio", F.round("d1_d15_ratio", 8))


@query("amount_time_features", TX_SQL + """
select tid, round(ln(1 + amt), 6) as amount_log1p, cast((((dt % 86400) + 86400) % 86400) // 3600 as int) as hour,
       cast(((cast(floor(dt / 86400) as bigint) % 7) + 7) % 7 as int) as day_of_week from tx""")
def _(spark, sf):
    df = tx(spark, sf, "tid", "amt", "dt")
    out = df.select("tid", *features.amount_time_features("amt", "dt"))
    return out.withColumn("amount_log1p", F.round("amount_log1p", 6))


@query("variance_filter", """
select position, round(variance, 8) as variance from (
  select cast(p - 1 as int) as position, var_pop(x::double) as variance
  from (select unnest(embedding) as x, unnest(range(1, 65)) as p from embeddings) group by 1) where variance > 0.0156""")
def _(spark, sf):
    kept = features.array_variances(table(spark, sf, "embeddings"), "embedding").where(F.col("variance") > 0.0156)
    return kept.select("position", F.round("variance", 8).alias("variance"))


@query("variance_filter_wide", TX_SQL + """
, s as (select avg(amt) ma, stddev_pop(amt) sa, avg(v1) mv, stddev_pop(v1) sv from train)
select 'amt' as feature, round(var_pop((amt - ma) / sa), 6) as variance from train, s
union all select 'v1', round(var_pop((v1 - mv) / sv), 6) from train, s""")
def _(spark, sf):
    train, _ = halves(spark, sf, "amt", "v1", "v3")
    scaled = prepare.scale(train, prepare.scaler_fit(train, ["amt", "v1"]))
    kept = features.variance_filter(scaled, ["amt", "v1", "v3"])
    return features.variances(scaled, kept).withColumn("variance", F.round("variance", 6))


# -- request features ------------------------------------------------------------------------------------------


@query("confidence_band", TX_SQL + """
select tid, case when score >= 0.8 then 'high' when score >= 0.5 then 'medium' else 'low' end as confidence from scored""")
def _(spark, sf):
    return scored(spark, sf, "tid").select("tid", requests.confidence_band("score").alias("confidence"))


@query("feature_coerce", """
select event_id, coalesce(try_cast(json_extract_string(props, '$.k') as double), 0.0::double) as k,
       0.0::double as kind, value from events""")
def _(spark, sf):
    feature_map = F.map_concat(
        requests.feature_map("props"), F.create_map(F.lit("kind"), F.col("event_type"),
                                                    F.lit("value"), F.col("value").cast("string"))
    )
    df = table(spark, sf, "events").select("event_id", feature_map.alias("m"))
    return df.select("event_id", *[
        requests.feature_value(F.col("m"), n).alias(n) for n in ("k", "kind", "value")
    ])


@query("pad_select", """
select vec_id, round(embedding[4]::double, 6) as a, round(embedding[1]::double, 6) as b,
       round(embedding[1]::double, 6) as short_a, 0.0::double as short_c
from embeddings""")
def _(spark, sf):
    df = table(spark, sf, "embeddings")
    chosen = requests.pad_select(F.col("embedding").cast("array<double>"), [3, 0])
    short = requests.pad_select(F.slice(F.col("embedding").cast("array<double>"), 1, 2), [0, 1, 2])
    return df.select(
        "vec_id", F.round(F.get(chosen, F.lit(0)), 6).alias("a"), F.round(F.get(chosen, F.lit(1)), 6).alias("b"),
        F.round(F.get(short, F.lit(0)), 6).alias("short_a"), F.get(short, F.lit(2)).alias("short_c"),
    )


@query("melt_features", TX_SQL + """
select feature, count(*) as n, round(sum(value), 2) as total from (
  select 'card2' as feature, card2 as value from tx union all select 'd1', d1 from tx union all select 'v1', v1 from tx)
where value is not null group by feature""")
def _(spark, sf):
    long = melt(tx(spark, sf, "card2", "d1", "v1"), ["card2", "d1", "v1"])
    return long.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))
