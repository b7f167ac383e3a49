"""Declared schemas and column roles of the two input tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import types as T

KEY = "TransactionID"
LABEL = "isFraud"
TIME = "TransactionDT"
AMOUNT = "TransactionAmt"

# Fixed values.
REQUIRED_COLUMNS = ("TransactionID", "isFraud", "TransactionDT", "TransactionAmt", "ProductCD")
NULL_TOKENS = ("", "nan", "NaN", "NA", "N/A", "null", "NULL", "None")
FREQUENCY_COLUMNS = ("card1", "card2", "addr1", "addr2")
TARGET_COLUMNS = ("P_emaildomain", "R_emaildomain")
ONE_HOT_COLUMNS = ("ProductCD", "card3", "card4", "card5", "card6", "DeviceType")
MODE_COLUMNS = ("card1", "card2", "card3", "card5")
V_GROUPS = {"V_g1": (1, 11), "V_g2": (12, 34), "V_g3": (35, 52), "V_g4": (53, 74), "V_g5": (75, 94)}

GROUP_PATTERNS = {
    "v": r"^V\d+$",
    "c": r"^C\d+$",
    "d": r"^D\d+$",
    "m": r"^M\d+$",
    "id": r"^id_\d+$",
    "indicator": r"_missing$",
}


def _numbered(prefix: str, last: int, dtype: T.DataType, width: int = 0) -> list[T.StructField]:
    return [T.StructField(f"{prefix}{str(i).zfill(width)}", dtype) for i in range(1, last + 1)]


def transaction_schema() -> T.StructType:
    """394 columns: head, card, address, distance, mail, counts, deltas, matches and the V block."""
    head = [
        T.StructField(KEY, T.LongType()),
        T.StructField(LABEL, T.IntegerType()),
        T.StructField(TIME, T.LongType()),
        T.StructField(AMOUNT, T.DoubleType()),
        T.StructField("ProductCD", T.StringType()),
    ]
    for name in ("card1", "card2", "card3", "card4", "card5", "card6"):
        text = name in ("card4", "card6")
        head.append(T.StructField(name, T.StringType() if text else T.DoubleType()))
    head += [T.StructField(c, T.DoubleType()) for c in ("addr1", "addr2", "dist1", "dist2")]
    head += [T.StructField(c, T.StringType()) for c in TARGET_COLUMNS]
    return T.StructType(
        head
        + _numbered("C", 14, T.DoubleType())
        + _numbered("D", 15, T.DoubleType())
        + _numbered("M", 9, T.StringType())
        + _numbered("V", 339, T.FloatType())
    )


def identity_schema() -> T.StructType:
    fields = [
        T.StructField(KEY, T.LongType()),
        T.StructField("DeviceType", T.StringType()),
        T.StructField("DeviceInfo", T.StringType()),
    ]
    for field in _numbered("id_", 38, T.StringType(), width=2):
        numeric = int(field.name[3:]) <= 11
        fields.append(T.StructField(field.name, T.DoubleType() if numeric else T.StringType()))
    return T.StructType(fields)


def column_groups(df: DataFrame) -> dict[str, list[str]]:
    """Columns by role, in schema order. Whole-name patterns keep ``DeviceType`` out of the D group."""
    groups = {role: [c for c in df.columns if re.search(p, c)] for role, p in GROUP_PATTERNS.items()}
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    groups["id_numeric"] = [c for c in groups["id"] if c not in text]
    groups["id_flag"] = [c for c in groups["id"] if c in text]
    present = set(df.columns)
    groups["frequency"] = [c for c in FREQUENCY_COLUMNS if c in present]
    groups["target"] = [c for c in TARGET_COLUMNS if c in present]
    groups["one_hot"] = [c for c in ONE_HOT_COLUMNS if c in present]
    groups["mode"] = [c for c in MODE_COLUMNS if c in present and c not in text]
    return groups


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = (LABEL, TIME)) -> list[str]:
    """Numeric feature columns in schema order, without label and time."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude]
