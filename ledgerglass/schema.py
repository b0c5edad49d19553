"""Transaction schema and column checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T

DAY_US = 86_400_000_000

TRANSACTIONS = T.StructType(
    [
        T.StructField("trans_date_trans_time", T.TimestampType()),
        T.StructField("cc_num", T.LongType()),
        T.StructField("merchant", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("amt", T.DecimalType(18, 2)),
        T.StructField("first", T.StringType()),
        T.StructField("last", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("street", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("zip", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("long", T.DoubleType()),
        T.StructField("city_pop", T.LongType()),
        T.StructField("job", T.StringType()),
        T.StructField("dob", T.DateType()),
        T.StructField("trans_num", T.StringType()),
        T.StructField("unix_time", T.LongType()),
        T.StructField("merch_lat", T.DoubleType()),
        T.StructField("merch_long", T.DoubleType()),
        T.StructField("is_fraud", T.IntegerType()),
    ]
)

# Columns that are never model inputs.
NON_FEATURES = (
    "_c0",
    "Unnamed: 0",
    "trans_date_trans_time",
    "cc_num",
    "merchant",
    "category",
    "first",
    "last",
    "street",
    "city",
    "state",
    "zip",
    "job",
    "dob",
    "unix_time",
    "job_category",
    "trans_date",
    "trans_num",
    "is_fraud",
)


def require_columns(df: DataFrame, *columns: str) -> None:
    """Raise ``ValueError`` naming every column the table lacks."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing from the table: {', '.join(missing)}")


def feature_columns(df: DataFrame, exclude=NON_FEATURES) -> list[str]:
    """All columns of the table except the excluded ones, in table order."""
    dropped = set(exclude)
    return [c for c in df.columns if c not in dropped]


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of the columns with a numeric type."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
