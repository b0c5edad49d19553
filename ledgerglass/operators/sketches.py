"""Sketches of a column per day that are stored, and merged for any range of days.

Both sketches are tables of counters, so merging is a grouped sum or maximum in Spark and a merge equals the sketch
of all rows at once, counter by counter.

* Quantiles: counts of values in buckets that grow by ``(1 + error) / (1 - error)``; a quantile's relative error is at
  most ``error`` (negative values have buckets of their own, values below ``SMALLEST`` in size count as 0).
* Distinct values: 2^bits registers with the greatest rank of a hash; the estimate's standard error is about
  ``1.04 / sqrt(2^bits)``.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import log

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ledgerglass.operators.running import running_totals

ERROR = 0.01
BITS = 12
SMALLEST = 1e-9


def _gamma(error: float) -> float:
    if not 0 < error < 1:
        raise ValueError("error must lie between 0 and 1")
    return (1 + error) / (1 - error)


def quantile_sketch(df: DataFrame, value: str, groups: Sequence[str], error: float = ERROR) -> DataFrame:
    """(groups, bucket, n): bucket numbers grow with the value, 0 holds zeros. Nulls and NaN are no values."""
    x = F.col(value).cast("double")
    # rounding keeps a value at a bucket's border on one side, whatever the library's logarithm
    size = (F.ceil(F.round(F.log(F.abs(x) / SMALLEST) / log(_gamma(error)), 9)) + 1).cast("int")
    bucket = F.when(F.abs(x) < SMALLEST, 0).otherwise(F.signum(x).cast("int") * size)
    return df.where(x.isNotNull() & ~F.isnan(x)).groupBy(*groups, bucket.alias("bucket")).agg(F.count("*").alias("n"))


def merge_quantiles(sketch: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """The sketch over coarser groups (or over everything)."""
    return sketch.groupBy(*groups, "bucket").agg(F.sum("n").alias("n"))


def estimate_quantiles(sketch: DataFrame, probabilities: Sequence[float], groups: Sequence[str] = (), error: float = ERROR) -> DataFrame:
    """(groups, probability, quantile): the value of rank ``floor(p (n - 1))``, to within the relative error."""
    gamma = _gamma(error)
    placed = running_totals(sketch, list(groups), "bucket", {"_below": ("sum", "n")})
    total = F.sum("n").over(W.partitionBy(*groups)) if groups else None
    if total is None:
        placed = placed.withColumn("_size", sketch.agg(F.sum("n")).scalar())
    else:
        placed = placed.withColumn("_size", total)
    spread = placed.withColumn("probability", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])))
    at = F.floor(F.col("probability") * (F.col("_size") - 1))
    # the middle of a bucket, in relative terms
    size = F.pow(F.lit(gamma), F.abs("bucket") - 1) * SMALLEST * 2 / (1 + gamma)
    middle = F.when(F.col("bucket") == 0, 0.0).otherwise(F.signum("bucket") * size)
    hit = (F.col("_below") <= at) & (at < F.col("_below") + F.col("n"))
    return spread.where(hit).select(*groups, "probability", middle.alias("quantile"))


def _hash(value: str) -> Column:
    return F.md5(F.col(value).cast("string").cast("binary"))


def distinct_sketch(df: DataFrame, value: str, groups: Sequence[str], bits: int = BITS) -> DataFrame:
    """(groups, register, rank): per register the greatest place of the first set bit of a 48-bit hash."""
    if not 4 <= bits <= 16:
        raise ValueError("bits must lie in 4 to 16")
    digest = _hash(value)
    register = F.conv(F.substring(digest, 1, 4), 16, 10).cast("int").bitwiseAND((1 << bits) - 1)
    rest = F.conv(F.substring(digest, 5, 12), 16, 10).cast("long")
    rank = F.when(rest == 0, 49).otherwise(49 - F.length(F.bin(rest)))
    rows = df.where(F.col(value).isNotNull()).select(*groups, register.alias("register"), rank.cast("int").alias("rank"))
    return rows.groupBy(*groups, "register").agg(F.max("rank").alias("rank"))


def merge_distinct(sketch: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    return sketch.groupBy(*groups, "register").agg(F.max("rank").alias("rank"))


def estimate_distinct(sketch: DataFrame, groups: Sequence[str] = (), bits: int = BITS) -> DataFrame:
    """(groups, estimate): harmonic mean of the registers, linear counting while many are empty."""
    m = 1 << bits
    alpha = 0.7213 / (1 + 1.079 / m)
    used = F.count("*").cast("double")
    raw = alpha * m * m / (F.sum(F.pow(F.lit(2.0), -F.col("rank"))) + (m - used))
    linear = m * F.log(m / F.greatest(m - used, F.lit(0.5)))
    estimate = F.when((raw <= 2.5 * m) & (used < m), linear).otherwise(raw)
    return sketch.groupBy(*groups).agg(F.when(used > 0, estimate).otherwise(0.0).alias("estimate"))
