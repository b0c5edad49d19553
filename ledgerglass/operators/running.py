"""Running totals and exact order statistics that do not rely on one task per group.

A plain ``Window.partitionBy(g).orderBy(v)`` puts a whole group into one task. Here the
order column is cut into ranges of about equal size, each (group, range) is windowed by
itself, and the totals of the earlier ranges are added from a small table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from math import isqrt
from operator import or_

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from ledgerglass.sources.stage import stage

SAMPLE_PER_RANGE = 16


def range_count(df: DataFrame) -> int:
    """As many ranges as the session has shuffle partitions, within 8 to 4096."""
    conf = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    return max(8, min(4096, int(conf)))


def range_cuts(
    df: DataFrame, order: str, ranges: int, block: int, groups: Sequence[str] = ()
) -> tuple[Column, Column]:
    """Sorted cut points that split the rows into ranges of about equal size, and every
    ``block``-th of them, both as constants.

    One job keeps the rows with the smallest hash of (groups, order), a uniform sample of
    at most ``SAMPLE_PER_RANGE * ranges`` values, and only every 16th of them comes back.
    (groups, order) should be unique or pre-aggregated.
    """
    kind = T.ArrayType(df.schema[order].dataType)
    sample = (
        df.select(F.col(order).alias("_v"), F.xxhash64(*groups, order).alias("_h"))
        .orderBy("_h", "_v")
        .limit(SAMPLE_PER_RANGE * ranges)
        .agg(F.sort_array(F.collect_list("_v")).alias("_s"))
    )
    cuts = sample.select(
        F.filter("_s", lambda v, i: (i % SAMPLE_PER_RANGE == 0) & (i > 0)).alias("_cuts")
    )
    found = cuts.select(
        F.to_json("_cuts").alias("cuts"),
        F.to_json(F.filter("_cuts", lambda c, i: (i + 1) % block == 0)).alias("coarse"),
    ).first()
    return F.from_json(F.lit(found.cuts), kind), F.from_json(F.lit(found.coarse), kind)


def with_range(
    df: DataFrame, order: str, name: str, ranges: int, groups: Sequence[str] = ()
) -> DataFrame:
    """Number the ranges of the order column from 0 upwards, by a two-level search of the cuts."""
    value, block = F.col(order), max(2, isqrt(ranges))
    cuts, coarse = range_cuts(df, order, ranges, block, groups)
    first = F.size(F.filter(coarse, lambda c: c <= value)) * block
    return df.withColumn("_first", first).withColumn(
        name,
        F.col("_first")
        + F.size(F.filter(F.slice(cuts, F.col("_first") + 1, F.lit(block - 1)), lambda c: c <= value)),
    ).drop("_first")


def _combine(kind: str, earlier: Column, within: Column) -> Column:
    if kind == "sum":
        return F.coalesce(earlier, F.lit(0)) + F.coalesce(within, F.lit(0))
    return F.greatest(earlier, within)


def running_totals(
    df: DataFrame,
    groups: Sequence[str],
    order: str,
    measures: Mapping[str, tuple[str, str]],
    ranges: int | None = None,
    staged: bool = False,
) -> DataFrame:
    """Totals over the rows strictly before each row, per group, by the order column.

    ``measures`` maps an output name to (``sum`` or ``max``, input column). The order
    column may be a struct; (groups, order) must be unique, which makes it the caller's
    job to pre-aggregate equal values or to add a tie-break. The input is read three
    times (cuts, totals, rows), so it is written once first unless it is ``staged`` already.
    """
    ranges = ranges or range_count(df)
    df = df if staged else stage(df)
    cut = with_range(df, order, "_range", ranges, groups)
    keys = [*groups, "_range"]
    totals = cut.groupBy(*keys).agg(
        *[getattr(F, kind)(col).alias(f"_t_{name}") for name, (kind, col) in measures.items()]
    )
    earlier = W.partitionBy(*groups).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        *[
            getattr(F, kind)(f"_t_{name}").over(earlier).alias(f"_e_{name}")
            for name, (kind, _) in measures.items()
        ],
    )
    # as one value, which is never null, the keys deal the rows once for the join and the window
    cut = cut.withColumn("_cell", F.struct(*keys)).drop(*keys)
    offsets = offsets.withColumn("_k_cell", F.struct(*[F.col(f"_k_{k}").alias(k) for k in keys]))
    within = W.partitionBy("_cell").orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    joined = cut.join(offsets, F.col("_cell") == F.col("_k_cell"), "left")
    return joined.select(
        *[F.col("_cell").getField(c).alias(c) if c in groups else F.col(c) for c in df.columns],
        *[
            _combine(kind, F.col(f"_e_{name}"), getattr(F, kind)(col).over(within)).alias(name)
            for name, (kind, col) in measures.items()
        ],
    )


def rank_within(
    df: DataFrame, groups: Sequence[str], order: Column, name: str = "rank"
) -> DataFrame:
    """Position from 0 within each group; the order expression must be unique in it."""
    keyed = df.withColumns({"_order": order, "_one": F.lit(1).cast("bigint")})
    return running_totals(keyed, groups, "_order", {name: ("sum", "_one")}).drop("_order", "_one")


def quantiles(
    df: DataFrame, value: str, probabilities: Sequence[float], groups: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """Exact quantiles with linear interpolation: one row per (group, probability).

    Equal values are counted first, so the shuffle carries distinct values only. A row counts ``weight`` times, if given.
    """
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*groups, F.col(value).cast("double").alias("_value"))
        .agg((F.count("*") if weight is None else F.sum(weight)).alias("_n"))
    )
    counts = stage(counts)
    placed = running_totals(counts, groups, "_value", {"_below": ("sum", "_n")}, staged=True)
    sizes = counts.groupBy(*groups).agg(F.sum("_n").alias("_size"))
    if groups:
        same = F.lit(True)
        sizes = sizes.select(*[F.col(g).alias(f"_s_{g}") for g in groups], "_size")
        for g in groups:
            same = same & F.col(g).eqNullSafe(F.col(f"_s_{g}"))
        placed = placed.join(sizes, same)
    else:
        placed = placed.withColumn("_size", sizes.scalar())
    spread = placed.withColumn("probability", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])))
    spot = (F.col("_size") - 1) * F.col("probability")
    holds = lambda at: (F.col("_below") <= at) & (at < F.col("_below") + F.col("_n"))
    low, high = F.floor(spot), F.ceil(spot)
    picked = spread.where(holds(low) | holds(high)).groupBy(*groups, "probability").agg(
        F.max(F.when(holds(low), F.col("_value"))).alias("_low"),
        F.max(F.when(holds(high), F.col("_value"))).alias("_high"),
        F.max(spot - low).alias("_part"),
    )
    return picked.select(
        *groups,
        "probability",
        (F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_part")).alias("quantile"),
    )


def quantiles_of(df: DataFrame, wanted: Mapping[str, Sequence[float]]) -> DataFrame:
    """Exact quantiles (column_name, probability, quantile) of several columns, from one count of their values."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in wanted]).unpivot([], list(wanted), "column_name", "_x")
    every = sorted({float(p) for ps in wanted.values() for p in ps})
    asked = [(F.col("column_name") == c) & F.col("probability").isin([float(p) for p in ps]) for c, ps in wanted.items()]
    return quantiles(long, "_x", every, ("column_name",)).where(reduce(or_, asked))


def dense_codes(df: DataFrame, value: str, name: str = "code") -> DataFrame:
    """(value, code): the distinct non-null values numbered from 0 in sorted order."""
    distinct = df.select(value).where(F.col(value).isNotNull()).distinct()
    return rank_within(distinct, (), F.col(value), name)
