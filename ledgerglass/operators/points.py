"""Map points."""

from __future__ import annotations

from math import pi

from pyspark.sql import DataFrame, functions as F

from ledgerglass.operators.running import rank_within
from ledgerglass.operators.skew import MAX_ROWS_PER_KEY, join_salted
from ledgerglass.sources.stage import stage

# Fixed value: how far points at the same place are moved apart, in degrees.
RADIUS = 0.001


def spread_points(
    df: DataFrame,
    lat: str = "lat",
    long: str = "long",
    row_id: str = "trans_num",
    max_rows: int = MAX_ROWS_PER_KEY,
) -> DataFrame:
    """Points that share a place are put on a small circle around it; single points stay."""
    sizes = stage(df.groupBy(F.col(lat).alias("_lat"), F.col(long).alias("_long")).agg(F.count("*").alias("_n")))
    counts = sizes.select(F.col("_lat").alias(lat), F.col("_long").alias(long), F.col("_n").alias("n_rows"))
    ranked = rank_within(df, [lat, long], F.col(row_id), "_i")
    placed = join_salted(ranked, sizes, {lat: "_lat", long: "_long"}, "left", max_rows, counts)
    angle = 2 * pi * F.col("_i") / F.col("_n")
    shared = F.col("_n") > 1
    return placed.select(
        *df.columns,
        F.when(shared, F.col(lat) + RADIUS * F.sin(angle)).otherwise(F.col(lat)).alias("lat_adjusted"),
        F.when(shared, F.col(long) + RADIUS * F.cos(angle)).otherwise(F.col(long)).alias("long_adjusted"),
    )
