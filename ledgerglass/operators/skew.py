"""Separating keys that are too big for one task."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F, types as T

from ledgerglass.sources.stage import stage

MAX_ROWS_PER_KEY = 2_000_000


def count_keys(df: DataFrame, key: str) -> DataFrame:
    """(key, n_rows), combined on the map side."""
    return df.groupBy(key).agg(F.count("*").alias("n_rows"))


def hot_keys(counts: DataFrame, key: str, max_rows: int = MAX_ROWS_PER_KEY) -> DataFrame | None:
    """From a table with ``n_rows`` per key: the keys with more rows than that, or None.

    At most ``rows / max_rows`` keys can come back, so the list is small by construction.
    """
    found = counts.where(F.col("n_rows") > max_rows).select(F.col(key).alias("_hot")).collect()
    if not found:
        return None
    schema = T.StructType([T.StructField("_hot", counts.schema[key].dataType)])
    return counts.sparkSession.createDataFrame(found, schema)


def split_hot(df: DataFrame, key: str, hot: DataFrame | None) -> tuple[DataFrame, DataFrame | None]:
    """(rows of ordinary keys, rows of hot keys or None)."""
    if hot is None:
        return df, None
    same = F.col(key).eqNullSafe(F.col("_hot"))
    return (
        df.join(F.broadcast(hot), same, "left_anti"),
        df.join(F.broadcast(hot), same, "left_semi"),
    )


def join_per_key(df: DataFrame, table: DataFrame, key: str, hot: DataFrame | None) -> DataFrame:
    """Left join with a table of one row per key.

    Rows of hot keys meet a broadcast of just those keys' rows, so no task of the shuffle
    join receives a hot key.
    """
    ordinary, heavy = split_hot(df, key, hot)
    joined = ordinary.join(table, key, "left")
    if heavy is None:
        return joined
    few = table.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col("_hot")), "left_semi")
    return joined.unionByName(heavy.join(F.broadcast(few), key, "left"))


def join_salted(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    how: str = "inner",
    max_rows: int = MAX_ROWS_PER_KEY,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Join on equal columns (left name: right name, dropped) where a key may hold a large part of the left rows.

    Rows of a key with more than ``max_rows`` are dealt over several tasks, and each of them gets a copy of the
    key's right rows. The list of such keys has at most rows / ``max_rows`` entries, which bounds its broadcast.
    ``how`` is inner, left, left_semi or left_anti. ``counts`` is a table of ``n_rows`` per key, if the caller has one;
    without it the left rows are read once more to count them.
    """
    names = list(on)
    counts = left.groupBy(*names).agg(F.count("*").alias("n_rows")) if counts is None else counts
    parts = F.ceil(F.col("n_rows") / max(max_rows, 1)).cast("int").alias("_parts")
    found = counts.where(F.col("n_rows") > max_rows).select(*[F.col(c).alias(f"_hot_{c}") for c in names], parts).collect()
    same = reduce(and_, [F.col(a) == F.col(b) for a, b in on.items()])
    if not found:
        return left.join(right, same, how).drop(*on.values())
    schema = T.StructType([*[T.StructField(f"_hot_{c}", left.schema[c].dataType) for c in names], T.StructField("_parts", T.IntegerType())])
    hot = F.broadcast(left.sparkSession.createDataFrame(found, schema))
    parts = F.coalesce("_parts", F.lit(1))
    is_left = reduce(and_, [F.col(c) == F.col(f"_hot_{c}") for c in names])
    is_right = reduce(and_, [F.col(b) == F.col(f"_hot_{a}") for a, b in on.items()])
    dealt = left.join(hot, is_left, "left").withColumn("_salt", F.pmod(F.xxhash64(*left.columns) + F.monotonically_increasing_id(), parts).cast("int"))
    dealt = dealt.drop(*[f"_hot_{c}" for c in names], "_parts")
    copied = right.join(hot, is_right, "left").withColumn("_copy", F.explode(F.sequence(F.lit(0), parts - 1)))
    copied = copied.drop(*[f"_hot_{c}" for c in names], "_parts")
    return dealt.join(copied, same & (F.col("_salt") == F.col("_copy")), how).drop(*on.values(), "_salt", "_copy")


def settle_small(df: DataFrame) -> DataFrame:
    """A fitted table, staged once and joined without a hint.

    The planner knows the size of a staged table: it broadcasts one below its threshold and shuffles a larger one.
    """
    return stage(df)
