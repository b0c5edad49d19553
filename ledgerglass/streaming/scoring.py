"""Scoring transactions as they arrive.

Only the features that depend on a single row and on fitted tables are valid on an
unbounded table; the card and merchant windows are batch operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerglass.functions.numbers import to_class
from ledgerglass.operators.models import predict
from ledgerglass.plans.features import Fitted, local_features


def read_stream(spark: SparkSession, path: str, schema) -> DataFrame:
    """New parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).parquet(path)


def score(df: DataFrame, model, features: list[str], threshold: float = 0.5) -> DataFrame:
    """Score and class of every row of a stream or table."""
    return predict(model, df, features).withColumn("predicted", to_class("predictions", threshold))


def score_stream(df: DataFrame, gaz: DataFrame, fitted: Fitted, model, features: list[str]) -> DataFrame:
    """Row-local features and scores of a transaction stream."""
    return score(local_features(df, gaz, fitted), model, features)
