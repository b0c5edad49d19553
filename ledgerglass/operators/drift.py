"""Month-over-month drift tests."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from ledgerglass.functions.dates import month_of
from ledgerglass.operators.running import range_count, with_range
from ledgerglass.operators.skew import settle_small
from ledgerglass.sources.stage import stage

#: Samples of up to so many rows get the exact p-value; its work grows with the product of their sizes.
EXACT_TO = 100


def kolmogorov_p(statistic: Column, n1: Column, n2: Column, terms: int = 100) -> Column:
    """Asymptotic two-sample p-value of a KS statistic."""
    lam = statistic * F.sqrt(n1.cast("double") * n2 / (n1 + n2))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda acc, j: acc + F.when(j % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * j * j * lam * lam),
    )
    return F.when(lam < 0.04, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2 * series)))


@F.pandas_udf(T.DoubleType())
def _exact_p(statistic: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
    return pd.Series([exact_ks_p(d, int(a), int(b)) for d, a, b in zip(statistic, n1, n2, strict=True)], dtype="float64")


def exact_ks_p(statistic: float, n1: int, n2: int) -> float:
    """P(KS >= statistic) for two samples of one continuous distribution, by counting lattice paths.

    Every order of the two samples is a path from (0, 0) to (n1, n2), and all are equally likely. The paths that
    stay within ``|i / n1 - j / n2| < statistic`` are counted row by row, as shares of all paths so far.
    """
    if n1 == 0 or n2 == 0:
        return 1.0
    reach = round(statistic * n1 * n2)  # the statistic is a multiple of 1 / (n1 n2)
    if reach <= 0:
        return 1.0
    j = np.arange(n2 + 1)
    inside = np.zeros(n2 + 1)
    for i in range(n1 + 1):
        keep = np.abs(i * n2 - j * n1) < reach
        if i == 0:
            inside[:] = np.where(np.cumprod(keep), 1.0, 0.0)
            continue
        # shares: of the paths to (i, j), i / (i + j) come from (i - 1, j) and j / (i + j) from (i, j - 1)
        low, high = np.flatnonzero(keep)[[0, -1]] if keep.any() else (1, 0)
        fresh, left = np.zeros(n2 + 1), 0.0
        for k in range(low, high + 1):
            left = inside[k] * i / (i + k) + left * k / (i + k)
            fresh[k] = left
        inside = fresh
    return float(min(1.0, max(0.0, 1.0 - inside[n2])))


def ks_p_value(statistic: Column, n1: Column, n2: Column, exact_to: int = EXACT_TO) -> Column:
    """The exact p-value while both samples have at most ``exact_to`` rows, else the asymptotic one."""
    small = F.greatest(n1, n2) <= exact_to
    some = lambda c: F.when(small, c)
    exact = _exact_p(F.coalesce(some(statistic), F.lit(0.0)), F.coalesce(some(n1), F.lit(0)).cast("long"), F.coalesce(some(n2), F.lit(0)).cast("long"))
    return F.when(small, exact).otherwise(kolmogorov_p(statistic, n1, n2))


def _month_pairs(months: DataFrame, lags: Sequence[int]) -> DataFrame:
    """(month, other, lag): every month with the existing ones ``lag`` months before."""
    wanted = months.select("month", F.explode(F.array(*[F.lit(k) for k in lags])).alias("lag")).withColumn(
        "other", F.trunc(F.add_months("month", -F.col("lag")), "month")
    )
    return wanted.join(months.select(F.col("month").alias("other")), "other", "left_semi")


def ks_drift(
    df: DataFrame,
    features: Sequence[str] = ("amt", "is_fraud"),
    lags: Sequence[int] = (1, 2, 3),
    ts: str = "trans_date_trans_time",
    alpha: float = 0.05,
    exact_to: int = EXACT_TO,
) -> DataFrame:
    """KS statistic, p-value and flag for each feature, month and earlier month.

    Rows are counted per (month, feature, value) once; the pairs are formed from those counts.
    """
    present = df.dropna(subset=list(features))
    side = lambda f: F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value"))
    counts = (
        present.select(month_of(ts).alias("month"), F.inline(F.array(*[side(f) for f in features])))
        .groupBy("month", "feature", "value")
        .agg(F.count("*").alias("_n"))
    )
    counts = stage(counts)
    sizes = settle_small(counts.where(F.col("feature") == features[0]).groupBy("month").agg(F.sum("_n").alias("_size")))
    pairs = _month_pairs(sizes.select("month"), lags)
    # a month takes part in a pair as the newer or as the older side
    sides = settle_small(
        pairs.select(
            "month",
            "lag",
            F.inline(
                F.array(
                    F.struct(F.col("month").alias("_side"), F.lit(1).alias("_new")),
                    F.struct(F.col("other").alias("_side"), F.lit(0).alias("_new")),
                )
            ),
        )
        .join(sizes.withColumnRenamed("month", "_side"), "_side")
        .select("month", "lag", "_side", "_new", "_size")
    )
    keys = ["month", "lag", "feature"]
    place = [*keys, "_range"]
    counted = lambda n: (
        (n * F.col("_new")).alias("_a"),
        (n * (1 - F.col("_new"))).alias("_b"),
    )
    ranged = with_range(counts, "value", "_range", range_count(df), ("month", "feature"))
    ranged = ranged.withColumnRenamed("month", "_side")
    # what both sides have in the earlier ranges, from one row per (month, feature, range)
    earlier = W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_side", "feature", "_range")
        .agg(F.sum("_n").alias("_n"))
        .join(sides, "_side")
        .select(*place, *counted(F.col("_n")))
        .groupBy(*place)
        .agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
        .select(
            *place,
            F.coalesce(F.sum("_a").over(earlier), F.lit(0)).alias("_a_before"),
            F.coalesce(F.sum("_b").over(earlier), F.lit(0)).alias("_b_before"),
        )
    )
    # the default frame takes in all rows of an equal value
    within = W.partitionBy(*place).orderBy("value")
    walked = (
        ranged.join(sides, "_side")
        .select(*place, "value", *counted(F.col("_n")))
        .join(offsets, place)
        .select(
            *keys,
            (F.col("_a_before") + F.sum("_a").over(within)).alias("_a_upto"),
            (F.col("_b_before") + F.sum("_b").over(within)).alias("_b_upto"),
        )
    )
    both = sides.groupBy("month", "lag").agg(
        F.max(F.when(F.col("_new") == 1, F.col("_size"))).alias("_n_new"),
        F.max(F.when(F.col("_new") == 0, F.col("_size"))).alias("_n_old"),
    )
    gap = F.abs(F.col("_a_upto") / F.col("_n_new") - F.col("_b_upto") / F.col("_n_old"))
    p = ks_p_value(F.col("ks"), F.col("_n_new"), F.col("_n_old"), exact_to)
    return (
        walked.join(both, ["month", "lag"])
        .groupBy(*keys, "_n_new", "_n_old")
        .agg(F.max(gap).alias("ks"))
        .select(*keys, "ks", p.alias("p_value"))
        .withColumn("drift", F.col("p_value") < alpha)
    )


def kl_drift(
    df: DataFrame,
    feature: str = "amt",
    bins: int = 20,
    epsilon: float = 1e-6,
    lag: int = 1,
    ts: str = "trans_date_trans_time",
) -> DataFrame:
    """Kullback-Leibler divergence of each month from an earlier one over shared equal bins.

    Every bin gets ``epsilon`` added to its count, so that empty bins stay finite.
    """
    x = F.col(feature).cast("double")
    present = stage(df.where(F.col(feature).isNotNull()).select(ts, feature))
    low, high = present.agg(F.min(x), F.max(x)).first()
    low = 0.0 if low is None else low
    width = ((high - low) / bins if high is not None else 0.0) or 1.0
    number = F.least(F.floor((x - low) / width), F.lit(bins - 1)).cast("int")
    counts = settle_small(
        present.groupBy(month_of(ts).alias("month"), number.alias("bin")).agg(F.count("*").alias("_n"))
    )
    months = counts.groupBy("month").agg(F.sum("_n").alias("_size"))
    pairs = _month_pairs(months.select("month"), (lag,))
    older = months.select(F.col("month").alias("other"), F.col("_size").alias("_old_size"))
    grid = (
        pairs.join(months, "month")
        .join(older, "other")
        .withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
        .join(counts, ["month", "bin"], "left")
        .join(counts.select(F.col("month").alias("other"), "bin", F.col("_n").alias("_old")), ["other", "bin"], "left")
    )
    share = lambda n, size: (F.coalesce(n, F.lit(0)) + epsilon) / (F.col(size) + epsilon * bins)
    p, q = share("_n", "_size"), share("_old", "_old_size")
    return grid.groupBy("month", "other").agg(F.sum(p * F.log(p / q)).alias("kl"))
