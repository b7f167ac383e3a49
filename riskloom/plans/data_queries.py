"""Sources, sinks, quality checks, projections and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import drift, prepare, quality
from riskloom.plans.fixtures import TX_ORDER, TX_SQL, identity, scratch, table, tx
from riskloom.plans.registry import query
from riskloom.schema import column_groups, numeric_columns
from riskloom.sources import requests, tables

CFG = quality.QualityConfig(
    key="tid", label="y", time="dt", amount="amt", required=("tid", "y", "dt", "amt", "productcd"),
    v_columns=("v1", "v2", "v3", "v4", "v5"),
)


# -- sources and sinks -----------------------------------------------------------------------------------------


@query("scan_transactions", TX_SQL + """
select tid, y, dt, amt, productcd, card1, card2, addr1, addr2, pemail, m1, c1, d1, d15, v1, round(v2, 8) v2, v3,
       round(v4, 8) v4, v5 from tx""")
def _(spark, sf):
    df = tx(spark, sf)
    return df.select(*[
        F.round(c, 8).alias(c) if c in ("v2", "v4") else F.col(c) for c in TX_ORDER
    ])


@query("scan_csv", "select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders")
def _(spark, sf):
    """Header CSV with a declared schema: no pass over the file to infer one."""
    folder = scratch(spark, "csv")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    orders.write.csv(folder, header=True)
    return tables.read_transactions(spark, folder, "csv", orders.schema)


@query("normalize_nulls", """
select o_orderkey as tid, case when o_orderkey % 5 = 0 then null else o_totalprice end as amt,
       case o_orderstatus when 'P' then null when 'O' then null else 'F' end as status
from orders""")
def _(spark, sf):
    raw = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("tid"),
        F.when(F.col("o_orderkey") % 5 == 0, float("nan")).otherwise(F.col("o_totalprice")).alias("amt"),
        F.when(F.col("o_orderstatus") == "P", "nan").when(F.col("o_orderstatus") == "O", "N/A")
        .otherwise(F.col("o_orderstatus")).alias("status"),
    )
    return tables.normalize_nulls(raw)


@query("dataset_stats", TX_SQL + """
select count(*) as total_transactions, cast(sum(y) as bigint) as fraud_count,
       round(sum(y) / count(*), 6) as fraud_rate, 19 as tx_columns, 4 as id_columns,
       round(100 * (19 * count(*) - count(tid) - count(y) - count(dt) - count(amt) - count(productcd) - count(card1)
         - count(card2) - count(addr1) - count(addr2) - count(pemail) - count(m1) - count(c1) - count(d1) - count(d15)
         - count(v1) - count(v2) - count(v3) - count(v4) - count(v5)) / (19.0::double * count(*)), 4) as overall_missing_pct
from tx""")
def _(spark, sf):
    return quality.dataset_stats(tx(spark, sf), len(identity(spark, sf).columns), "y")


@query("write_split", TX_SQL + """
select split, count(*) as n, cast(sum(y) as bigint) as positives, min(dt) as first_dt, max(dt) as last_dt from (
  select 'train' as split, y, dt from train union all select 'test', y, dt from test) group by split""")
def _(spark, sf):
    path = scratch(spark, "split")
    tables.write_dataset(prepare.with_split(tx(spark, sf, "tid", "y", "dt"), "dt"), path)
    return spark.read.parquet(path).groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("positives"), F.min("dt").alias("first_dt"),
        F.max("dt").alias("last_dt"),
    )


@query("save_fit_maps", TX_SQL + """
select 'freq' as kind, 'card1' as feature, cast(card1 as varchar) as value,
       round(count(*) / (select count(card1) from train), 8) as number
from train where card1 is not null group by card1
union all
select 'target', 'pemail', coalesce(pemail, '_unknown_'),
       round((sum(y) + 10 * (select avg(y) from train)) / (count(*) + 10), 8)
from train group by 2, 3""")
def _(spark, sf):
    path = scratch(spark, "fit")
    train, _ = prepare.temporal_split(tx(spark, sf, "y", "dt", "card1", "pemail"), "dt")
    tables.FitTables.save(
        {"freq": prepare.freq_fit(train, ["card1"]), "target": prepare.target_fit(train, ["pemail"], "y")}, path
    )
    loaded = tables.FitTables.load(spark, path, ["freq", "target"])
    freq = loaded["freq"].select(
        F.lit("freq").alias("kind"), "feature", F.col("value").cast("string").alias("value"), F.col("freq").alias("number")
    )
    target = loaded["target"].select(F.lit("target").alias("kind"), "feature", "value", F.col("rate").alias("number"))
    return freq.unionByName(target).withColumn("number", F.round("number", 8))


@query("load_fit_maps", TX_SQL + """
, f as (select card1, count(*) / (select count(card1) from train) as freq from train group by card1),
g as (select avg(y) as rate, count(*) as rows_ from train),
m as (select coalesce(pemail, '_unknown_') as k, (sum(y) + 10 * any_value(g.rate)) / (count(*) + 10) as enc from train, g group by 1)
select test.tid, round(coalesce(freq, 1.0::double / rows_), 8) as card1, round(coalesce(enc, g.rate), 8) as pemail
from test left join f on test.card1 = f.card1 left join m on coalesce(test.pemail, '_unknown_') = m.k, g""")
def _(spark, sf):
    path = scratch(spark, "fit")
    train, test = prepare.temporal_split(tx(spark, sf, "tid", "y", "dt", "card1", "pemail"), "dt")
    tables.FitTables.save(
        {"freq": prepare.freq_fit(train, ["card1"]), "target": prepare.target_fit(train, ["pemail"], "y")}, path
    )
    maps = tables.FitTables.load(spark, path, ["freq", "target"])
    rows = train.agg(F.count(F.lit(1)).alias("n")).scalar()
    out = prepare.target_encode(prepare.freq_encode(test, maps["freq"], ["card1"], rows), maps["target"], ["pemail"])
    return out.select("tid", F.round("card1", 8).alias("card1"), F.round("pemail", 8).alias("pemail"))


@query("metric_log", TX_SQL + """
select 'r1' as run_id, 'ingest' as stage, u.metric, u.value from (
  select cast(count(*) as double) as total_transactions, cast(sum(y) as double) as fraud_count,
         round(sum(y) / count(*), 6) as fraud_rate from tx) s,
  lateral (values ('total_transactions', total_transactions), ('fraud_count', fraud_count),
                  ('fraud_rate', fraud_rate)) u(metric, value)""")
def _(spark, sf):
    path = scratch(spark, "metrics")
    stats = quality.dataset_stats(tx(spark, sf, "tid", "y"), 4, "y")
    tables.log_metrics(stats.select("total_transactions", "fraud_count", "fraud_rate"), path, "r1", "ingest")
    return spark.read.parquet(path).select("run_id", "stage", "metric", "value")


@query("parse_requests", """
select event_id, coalesce(try_cast(json_extract_string(props, '$.k') as double), 0.0::double) as k,
       0.0::double as absent
from events""")
def _(spark, sf):
    return requests.parse_requests(table(spark, sf, "events"), "props", ["k", "absent"], keep=["event_id"])


# -- checks ----------------------------------------------------------------------------------------------------


def check_sql(name: str, severity: str, passed: str, n_bad: str, observed: str, source: str = "tx") -> str:
    return (f"select '{name}' as \"check\", '{severity}' as severity, {passed} as passed, "
            f"cast({n_bad} as bigint) as n_bad, round(cast({observed} as double), 6) as observed from {source}")


def rounded(df):
    return df.withColumn("observed", F.round("observed", 6))


EMPTY_SQL = " + ".join(f"(case when count(*) > 0 and count({c}) = 0 then 1 else 0 end)" for c in CFG.required)


@query("dq_required_columns", TX_SQL + check_sql("required_columns", "issue", f"{EMPTY_SQL} = 0", EMPTY_SQL, EMPTY_SQL))
def _(spark, sf):
    return quality.required_columns(tx(spark, sf), CFG.required)


@query("dq_binary_label", TX_SQL + check_sql(
    "binary_label", "issue", "count(*) filter (y not in (0, 1)) = 0", "count(*) filter (y not in (0, 1))",
    "count(*) filter (y not in (0, 1))"))
def _(spark, sf):
    return rounded(quality.run_checks(tx(spark, sf, "y"), [quality.binary_label("y")]))


@query("dq_label_rate", "with src as (select case when event_type = 'error' then 1 else 0 end as y from events) "
       + check_sql("label_rate", "issue", "avg(y) between 0.001 and 0.2",
                   "case when avg(y) between 0.001 and 0.2 then 0 else 1 end", "avg(y)", "src"))
def _(spark, sf):
    y = F.when(F.col("event_type") == "error", 1).otherwise(0).alias("y")
    return rounded(quality.run_checks(table(spark, sf, "events").select(y), [quality.label_rate("y")]))


@query("dq_positive_amount", TX_SQL + check_sql(
    "positive_amount", "warning", "count(*) filter (amt <= 0) = 0", "count(*) filter (amt <= 0)",
    "count(*) filter (amt <= 0)"))
def _(spark, sf):
    return rounded(quality.run_checks(tx(spark, sf, "amt"), [quality.positive("amt", "positive_amount")]))


@query("dq_positive_time", TX_SQL + check_sql(
    "positive_time", "warning", "count(*) filter (dt <= 0) = 0", "count(*) filter (dt <= 0)",
    "count(*) filter (dt <= 0)"))
def _(spark, sf):
    return rounded(quality.run_checks(tx(spark, sf, "dt"), [quality.positive("dt", "positive_time")]))


MISSING_SQL = ", missing as (" + " union all ".join(
    f"select '{c}' as \"column\", 1 - count({c}) / count(*) as missing from tx" for c in TX_ORDER) + ")"


@query("dq_missing_audit", TX_SQL + MISSING_SQL + """
select "column", round(missing, 6) as missing from missing where missing > 0.3""")
def _(spark, sf):
    return quality.missing_audit(tx(spark, sf), 0.3).withColumn("missing", F.round("missing", 6))


@query("dq_duplicate_keys", check_sql(
    "duplicate_keys", "issue", "coalesce(sum(n - 1), 0) = 0", "coalesce(sum(n - 1), 0)", "coalesce(sum(n - 1), 0)",
    "(select count(*) as n from lineitem group by l_orderkey, l_linenumber)"))
def _(spark, sf):
    return rounded(quality.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]))


@query("dq_min_rows", check_sql(
    "min_rows", "issue", "count(*) >= 100", "greatest(100 - count(*), 0)", "count(*)", "orders"))
def _(spark, sf):
    return rounded(quality.run_checks(table(spark, sf, "orders"), [quality.min_rows()]))


@query("dq_top_missing", TX_SQL + MISSING_SQL + """
select "column", round(missing, 4) as missing from missing order by missing.missing desc, "column" limit 10""")
def _(spark, sf):
    return quality.top_missing(tx(spark, sf))


@query("dq_group_missing", TX_SQL + MISSING_SQL + """
select 'v' as grp, round(avg(missing), 6) as missing from missing where "column" in ('v1', 'v2', 'v3', 'v4', 'v5')
union all select 'all', round(avg(missing), 6) from missing""")
def _(spark, sf):
    df = tx(spark, sf)
    out = quality.group_missing(df, {"v": CFG.v_columns, "all": df.columns})
    return out.withColumn("missing", F.round("missing", 6))


REPORT_SQL = TX_SQL + """
, dup as (select coalesce(sum(n - 1), 0) as extra from (select count(*) as n from tx group by tid)),
s as (select count(*) filter (y not in (0, 1)) as bad_y, avg(y) as rate, count(*) filter (amt <= 0) as bad_amt,
             count(*) filter (dt <= 0) as bad_dt, count(*) as n from tx)
select 1 + (bad_y = 0)::int + (rate between 0.001 and 0.2)::int + (bad_amt = 0)::int + (bad_dt = 0)::int + 1
         + (extra = 0)::int + (n >= 100)::int as checks_passed,
       8 as checks_total,
       round((1 + (bad_y = 0)::int + (rate between 0.001 and 0.2)::int + (bad_amt = 0)::int + (bad_dt = 0)::int + 1
         + (extra = 0)::int + (n >= 100)::int) / 8.0::double, 4) as pass_rate,
       (bad_y > 0)::int + (rate not between 0.001 and 0.2)::int + (extra > 0)::int + (n < 100)::int as n_issues,
       (bad_amt > 0)::int + (bad_dt > 0)::int as n_warnings, n as tx_rows, (select count(*) from ident) as id_rows,
       round(rate, 6) as fraud_rate,
       (bad_y = 0) and (rate between 0.001 and 0.2) and (extra = 0) and (n >= 100) as validation_passed
from s, dup"""


def flat(report):
    return report.select(
        "checks_passed", "checks_total", "pass_rate", F.size("issues").alias("n_issues"),
        F.size("warnings").alias("n_warnings"), "dataset_stats.tx_rows", "dataset_stats.id_rows",
        "dataset_stats.fraud_rate", "validation_passed",
    )


@query("dq_report", REPORT_SQL)
def _(spark, sf):
    return flat(quality.quality_report(tx(spark, sf), identity(spark, sf), CFG))


@query("write_report", REPORT_SQL)
def _(spark, sf):
    path = scratch(spark, "report")
    report = quality.quality_report(tx(spark, sf), identity(spark, sf), CFG)
    tables.write_report(report, path)
    return flat(spark.read.schema(report.schema).json(path))


# -- projections -----------------------------------------------------------------------------------------------


def wide_names(df):
    """The view under the reference column names, so that roles are found by name."""
    names = {"tid": "TransactionID", "y": "isFraud", "dt": "TransactionDT", "amt": "TransactionAmt",
             "productcd": "ProductCD", "pemail": "P_emaildomain", "devicetype": "DeviceType"}
    return df.select(*[
        F.col(c).alias(names.get(c, c.upper() if c[0] in "vcdm" and c[1:].isdigit() else c)) for c in df.columns
    ])


GROUP_MEMBERS = {
    "v": {f"V{i}": f"v{i}" for i in range(1, 6)}, "c": {"C1": "c1"}, "d": {"D1": "d1", "D15": "d15"}, "m": {"M1": "m1"},
    "id": {"id_01": "id_01", "id_12": "id_12"}, "id_numeric": {"id_01": "id_01"}, "id_flag": {"id_12": "id_12"},
    "frequency": {c: c for c in ("card1", "card2", "addr1", "addr2")}, "target": {"P_emaildomain": "pemail"},
    "one_hot": {"ProductCD": "productcd", "DeviceType": "devicetype"}, "mode": {"card1": "card1", "card2": "card2"},
}


@query("column_groups", TX_SQL + ", wide as (select tx.*, id_01, devicetype, id_12 from tx left join ident on tx.tid = ident.tid) "
       + " union all ".join(f"select '{g}' as grp, '{name}' as \"column\", round(1 - count({c}) / count(*), 6) as missing from wide"
                            for g, members in GROUP_MEMBERS.items() for name, c in members.items()))
def _(spark, sf):
    df = wide_names(tables.join_identity(tx(spark, sf), identity(spark, sf), "tid"))
    rates = quality.missing_fractions(df)
    groups = [(g, c) for g, cols in column_groups(df).items() for c in cols]
    roles = spark.createDataFrame(groups, "grp string, column string")
    return rates.join(roles, "column").select("grp", "column", F.round("missing", 6).alias("missing"))


@query("numeric_columns", TX_SQL + " union all ".join(
    f"select '{c}' as \"column\", count({c}) as n from tx" for c in TX_ORDER
    if c not in ("y", "dt", "productcd", "pemail", "m1")))
def _(spark, sf):
    df = tx(spark, sf)
    columns = numeric_columns(df, ("y", "dt"))
    row = df.agg(*[F.count(c).alias(c) for c in columns])
    return row.unpivot([], columns, "column", "n")


@query("temporal_split", TX_SQL + """
select split, count(*) as n, cast(sum(y) as bigint) as positives, min(dt) as first_dt, max(dt) as last_dt from (
  select 'train' as split, y, dt from train union all select 'test', y, dt from test) group by split""")
def _(spark, sf):
    return prepare.with_split(tx(spark, sf, "y", "dt"), "dt").groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("positives"), F.min("dt").alias("first_dt"),
        F.max("dt").alias("last_dt"),
    )


@query("drop_columns", TX_SQL + """
select y, amt, card1, card2, addr1, addr2, c1, d1, d15, v1, v3, v5 from tx""")
def _(spark, sf):
    df = tx(spark, sf, *[c for c in TX_ORDER if c not in ("v2", "v4")])
    return prepare.drop_columns(df, ("tid", "dt"))


@query("align_schema", TX_SQL + """
select amt, 0 as productcd_new, card1, 0 as extra from test""")
def _(spark, sf):
    _, test = prepare.temporal_split(tx(spark, sf, "dt", "amt", "productcd", "card1"), "dt")
    return prepare.align_schema(test, ["amt", "productcd_new", "card1", "extra"])


@query("concat_columns", TX_SQL + """
select tid, amt, case when m1 = 'T' then 1 else 0 end as m1_t, case when m1 = 'F' then 1 else 0 end as m1_f from tx""")
def _(spark, sf):
    m1 = F.coalesce(F.col("m1"), F.lit("unknown"))
    return tx(spark, sf, "tid", "amt", "m1").select(
        "tid", "amt", (m1 == "T").cast("int").alias("m1_t"), (m1 == "F").cast("int").alias("m1_f")
    )


# -- joins -----------------------------------------------------------------------------------------------------


@query("join_identity", TX_SQL + """
select tx.tid, tx.amt, id_01, devicetype, id_12 from tx left join ident on tx.tid = ident.tid""")
def _(spark, sf):
    return tables.join_identity(tx(spark, sf, "tid", "amt"), identity(spark, sf), "tid")


@query("freq_map_join", TX_SQL + """
, f as (select card1, count(*) / (select count(card1) from train) as freq from train where card1 is not null group by card1)
select test.tid, round(coalesce(freq, 1.0::double / (select count(*) from train)), 8) as card1
from test left join f on test.card1 = f.card1""")
def _(spark, sf):
    train, test = prepare.temporal_split(tx(spark, sf, "tid", "dt", "card1"), "dt")
    rows = train.agg(F.count(F.lit(1)).alias("n")).scalar()
    out = prepare.freq_encode(test, prepare.freq_fit(train, ["card1"]), ["card1"], rows)
    return out.select("tid", F.round("card1", 8).alias("card1"))


@query("target_map_join", TX_SQL + """
, g as (select avg(y) as rate from train),
m as (select coalesce(pemail, '_unknown_') as k, (sum(y) + 10 * any_value(g.rate)) / (count(*) + 10) as enc
      from train, g group by 1)
select test.tid, round(coalesce(enc, g.rate), 8) as pemail
from test left join m on coalesce(test.pemail, '_unknown_') = m.k, g""")
def _(spark, sf):
    train, test = prepare.temporal_split(tx(spark, sf, "tid", "y", "dt", "pemail"), "dt")
    out = prepare.target_encode(test, prepare.target_fit(train, ["pemail"], "y"), ["pemail"])
    return out.select("tid", F.round("pemail", 8).alias("pemail"))


PROFILE_SQL = TX_SQL + ", prof as (" + " union all ".join(
    f"""select '{c}' as feature, avg({c}) as mean, stddev_pop({c}) as std, quantile_cont({c}, 0.05) as p5,
        quantile_cont({c}, 0.25) as p25, quantile_cont({c}, 0.5) as p50, quantile_cont({c}, 0.75) as p75,
        quantile_cont({c}, 0.95) as p95, count({c}) as n from train""" for c in ("amt", "card1", "v1", "v4")) + ")"


@query("ref_profile_join", PROFILE_SQL + """
select p.feature, round(p.mean, 4) as ref_mean, c.n_cur, round(c.m, 4) as curr_mean from prof p join (
  select 'amt' as feature, count(amt) as n_cur, avg(amt) as m from test
  union all select 'v1', count(v1), avg(v1) from test
  union all select 'd1', count(d1), avg(d1) from test) c on p.feature = c.feature where c.n_cur >= 10""")
def _(spark, sf):
    train, test = prepare.temporal_split(tx(spark, sf, "dt", "amt", "card1", "d1", "v1", "v4"), "dt")
    out = drift.profile_match(drift.ref_profile(train, ["amt", "card1", "v1", "v4"]), test, ["amt", "v1", "d1"])
    return out.select(
        "feature", F.round("mean", 4).alias("ref_mean"), "n_cur", F.round("curr_mean", 4).alias("curr_mean")
    )


@query("importance_join", TX_SQL + """
, e as (select productcd as feature, avg(amt) / 1000000 as importance from train group by 1),
l as (select productcd as feature, avg(amt) / 1000000 as importance from test where productcd <> '5-LOW' group by 1)
select feature, round(e.importance, 6) as early, round(l.importance, 6) as late,
       round(l.importance - e.importance, 6) as delta from e join l using (feature)""")
def _(spark, sf):
    train, test = prepare.temporal_split(tx(spark, sf, "dt", "amt", "productcd"), "dt")
    weight = (F.avg("amt") / 1000000).alias("importance")
    early = train.groupBy(F.col("productcd").alias("feature")).agg(weight)
    late = test.where(F.col("productcd") != "5-LOW").groupBy(F.col("productcd").alias("feature")).agg(weight)
    return drift.importance_join(early, late)


@query("time_bucket_join", TX_SQL + """
, span as (select min(dt) as lo, (max(dt) - min(dt)) // 5 as w from tx)
select tid, cast(least((dt - lo) // w + 1, 5) as int) as "window",
       lo + (least((dt - lo) // w + 1, 5) - 1) * w as t_start, lo + least((dt - lo) // w + 1, 5) * w as t_end
from tx, span""")
def _(spark, sf):
    return drift.time_windows(tx(spark, sf, "tid", "dt"), "dt").select("tid", "window", "t_start", "t_end")
