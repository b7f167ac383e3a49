"""Data-quality checks: rows ``(check, severity, passed, n_bad, observed)``; none of them raises.

All checks that need no grouping come from one aggregate over one scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom import schema as S
from riskloom.functions.shape import ratio, row_to_long

CHECK_FIELDS = "check string, severity string, passed boolean, n_bad bigint, observed double"


@dataclass(frozen=True)
class Check:
    """A check answered by global aggregates: how many rows are bad, and the number the verdict rests on."""

    name: str
    severity: str
    n_bad: Column
    observed: Column
    passed: Column | None = None

    def entry(self) -> Column:
        passed = self.n_bad == 0 if self.passed is None else self.passed
        return F.struct(
            F.lit(self.name).alias("check"), F.lit(self.severity).alias("severity"), passed.alias("passed"),
            self.n_bad.cast("bigint").alias("n_bad"), self.observed.cast("double").alias("observed"),
        )


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All ``checks`` in a single pass."""
    return df.agg(F.array(*[c.entry() for c in checks]).alias("checks")).select(F.inline("checks"))


def binary_label(label: str = S.LABEL) -> Check:
    """Every non-null label is 0 or 1."""
    bad = F.count_if(~F.col(label).isin(0, 1))
    return Check("binary_label", "issue", bad, bad)


def label_rate(label: str = S.LABEL, lo: float = 0.001, hi: float = 0.20) -> Check:
    """The mean label lies in ``[lo, hi]``; an all-null label passes, as no bound is violated."""
    rate = F.avg(F.col(label).cast("double"))
    outside = F.coalesce((rate < lo) | (rate > hi), F.lit(False))
    return Check("label_rate", "issue", outside.cast("int"), rate, ~outside)


def positive(column: str, name: str) -> Check:
    """No value is zero or negative; nulls do not count."""
    bad = F.count_if(F.col(column) <= 0)
    return Check(name, "warning", bad, bad)


def min_rows(n: int = 100) -> Check:
    rows = F.count(F.lit(1))
    return Check("min_rows", "issue", F.greatest(F.lit(n) - rows, F.lit(0)), rows, rows >= n)


def missing_fractions(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, missing)`` for every column, from one scan."""
    columns = list(columns or df.columns)
    rows = F.count(F.lit(1))
    row = df.agg(*[F.struct(ratio(rows - F.count(F.col(f"`{c}`")), rows).alias("missing")).alias(c) for c in columns])
    return row_to_long(row, columns, ["missing"], "column")


def missing_audit(df: DataFrame, max_fraction: float = 0.95) -> DataFrame:
    """Columns whose missing fraction exceeds ``max_fraction``."""
    return missing_fractions(df).where(F.col("missing") > max_fraction)


def missing_check(df: DataFrame, max_fraction: float = 0.95) -> Check:
    rows = F.count(F.lit(1))
    over = sum((ratio(rows - F.count(F.col(f"`{c}`")), rows) > max_fraction).cast("int") for c in df.columns)
    return Check("missing_audit", "warning", over, over)


def top_missing(df: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` columns with the most missing values; ties go to the smaller name."""
    return (
        missing_fractions(df).orderBy(F.col("missing").desc(), "column").limit(k)
        .select("column", F.round("missing", 4).alias("missing"))
    )


def group_missing(df: DataFrame, groups: dict[str, Sequence[str]]) -> DataFrame:
    """Mean of the column missing rates for each named group of columns."""
    members = [(g, c) for g, cols in groups.items() for c in cols]
    rates = missing_fractions(df, list(dict.fromkeys(c for _, c in members)))
    entry = F.array(*[F.struct(F.lit(g).alias("grp"), F.lit(c).alias("member")) for g, c in members])
    return (
        rates.select("missing", "column", F.inline(entry)).where(F.col("column") == F.col("member"))
        .groupBy("grp").agg(F.avg("missing").alias("missing"))
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows beyond the first of each key, nulls being one key. The count is combined before the shuffle."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    extra = F.coalesce(F.sum(F.col("n") - 1), F.lit(0))
    return per_key.agg(F.array(Check("duplicate_keys", "issue", extra, extra).entry()).alias("checks")).select(
        F.inline("checks")
    )


def required_columns(df: DataFrame, columns: Sequence[str] = S.REQUIRED_COLUMNS) -> DataFrame:
    """A required column fails if the table lacks it, or if the table has rows and none of them a value in it."""
    absent = [c for c in columns if c not in df.columns]
    empty = [F.when((F.count(F.lit(1)) > 0) & (F.count(c) == 0), 1).otherwise(0) for c in columns if c in df.columns]
    bad = sum(empty, F.lit(len(absent))).cast("bigint")
    return df.agg(F.array(Check("required_columns", "issue", bad, bad).entry()).alias("checks")).select(F.inline("checks"))


@dataclass(frozen=True)
class QualityConfig:
    key: str = S.KEY
    label: str = S.LABEL
    time: str = S.TIME
    amount: str = S.AMOUNT
    required: Sequence[str] = S.REQUIRED_COLUMNS
    min_rate: float = 0.001
    max_rate: float = 0.20
    max_missing: float = 0.95
    rows: int = 100
    v_columns: Sequence[str] = field(default_factory=tuple)


def planned_checks(df: DataFrame, cfg: QualityConfig) -> list[Check]:
    """The checks one scan answers. One whose column is absent fails as an issue."""
    present = set(df.columns)
    planned = [
        (cfg.label, binary_label(cfg.label), "binary_label"),
        (cfg.label, label_rate(cfg.label, cfg.min_rate, cfg.max_rate), "label_rate"),
        (cfg.amount, positive(cfg.amount, "positive_amount"), "positive_amount"),
        (cfg.time, positive(cfg.time, "positive_time"), "positive_time"),
    ]
    checks = [c if column in present else Check(name, "issue", F.lit(1), F.lit(None), F.lit(False))
              for column, c, name in planned]
    return [*checks, missing_check(df, cfg.max_missing), min_rows(cfg.rows)]


def key_check(df: DataFrame, cfg: QualityConfig) -> DataFrame:
    """The duplicate check, which needs its own grouping; an absent key leaves it unanswered."""
    if cfg.key in df.columns:
        return duplicate_keys(df, [cfg.key])
    return df.sparkSession.createDataFrame([("duplicate_keys", "issue", False, 0, None)], CHECK_FIELDS)


def all_checks(df: DataFrame, cfg: QualityConfig = QualityConfig()) -> DataFrame:
    """The eight checks as rows."""
    return (
        required_columns(df, cfg.required).unionByName(run_checks(df, planned_checks(df, cfg)))
        .unionByName(key_check(df, cfg))
    )


def quality_report(df: DataFrame, identity: DataFrame, cfg: QualityConfig = QualityConfig()) -> DataFrame:
    """One row: counts, pass rate, verdict, failed checks by severity and dataset statistics.

    Checks and statistics share one scan; the duplicate check adds one grouping by key.
    """
    rows = F.count(F.lit(1))
    v_columns = list(cfg.v_columns) or S.column_groups(df)["v"]
    present = F.struct(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    rate = F.avg(F.col(cfg.label).cast("double")) if cfg.label in df.columns else F.lit(None).cast("double")
    scan = df.agg(
        F.array(*[c.entry() for c in planned_checks(df, cfg)]).alias("scanned"), rows.alias("tx_rows"),
        rate.alias("rate"), present.alias("present"),
    )
    absent = [c for c in cfg.required if c not in df.columns]
    named = F.struct(
        F.lit("required_columns").alias("check"), F.lit("issue").alias("severity"), F.lit(not absent).alias("passed"),
        F.lit(len(absent)).cast("bigint").alias("n_bad"), F.lit(float(len(absent))).alias("observed"),
    )
    keys = key_check(df, cfg).select(F.struct("check", "severity", "passed", "n_bad", "observed").alias("c")).scalar()
    checks = F.concat(F.array(named), F.col("scanned"), F.array(keys))

    def failed(severity: str) -> Column:
        # An unanswerable duplicate check counts as not passed, yet is no issue.
        bad = F.filter("checks", lambda c: ~c["passed"] & (c["n_bad"] > 0) & (c["severity"] == severity))
        return F.sort_array(F.transform(bad, lambda c: c["check"]))

    def mean_missing(columns: Sequence[str]) -> Column:
        if not columns:
            return F.lit(None).cast("double")
        counts = F.array(*[F.col("present")[c] for c in columns])
        share = F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, n: a + n)
        return F.round(1.0 - ratio(share, F.col("tx_rows") * len(columns), default=1.0), 4)

    judged = scan.select("*", checks.alias("checks")).select(
        "*", F.size(F.filter("checks", lambda c: c["passed"])).alias("checks_passed"), F.size("checks").alias("checks_total"),
        failed("issue").alias("issues"), failed("warning").alias("warnings"),
    )
    return judged.select(
        "checks_passed", "checks_total",
        F.round(F.col("checks_passed") / F.col("checks_total"), 4).alias("pass_rate"),
        "issues", "warnings",
        F.struct(
            "tx_rows", F.lit(len(df.columns)).alias("tx_columns"),
            identity.agg(rows.alias("n")).scalar().alias("id_rows"), F.lit(len(identity.columns)).alias("id_columns"),
            F.round("rate", 6).alias("fraud_rate"), mean_missing(df.columns).alias("overall_missing_pct"),
            mean_missing(v_columns).alias("v_feature_missing_pct"),
        ).alias("dataset_stats"),
        (F.size("issues") == 0).alias("validation_passed"),
    )


def dataset_stats(df: DataFrame, identity_columns: int, label: str = S.LABEL) -> DataFrame:
    """Rows, positives, positive rate, column counts and the overall missing share, in one scan."""
    rows = F.count(F.lit(1))
    missing = sum(ratio(rows - F.count(F.col(f"`{c}`")), rows) for c in df.columns) / len(df.columns)
    positives = F.coalesce(F.sum(F.col(label).cast("bigint")), F.lit(0))
    return df.agg(
        rows.alias("total_transactions"),
        positives.alias("fraud_count"),
        F.round(ratio(positives, rows), 6).alias("fraud_rate"),
        F.lit(len(df.columns)).alias("tx_columns"),
        F.lit(identity_columns).alias("id_columns"),
        F.round(missing * 100, 4).alias("overall_missing_pct"),
    )
