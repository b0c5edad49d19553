"""Table profiles, rates, frequencies and distribution summaries."""

from __future__ import annotations

from collections.abc import Sequence
from math import sqrt

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ledgerglass.functions.dates import epoch_us
from ledgerglass.functions.numbers import cents, ratio
from ledgerglass.operators import comoments
from ledgerglass.operators.running import quantiles, quantiles_of
from ledgerglass.operators.skew import MAX_ROWS_PER_KEY, hot_keys, join_per_key, settle_small
from ledgerglass.schema import DAY_US, numeric_columns
from ledgerglass.sources.stage import stage


def key_totals(df: DataFrame, key: str) -> DataFrame:
    """Count and sum of the amount per key."""
    return df.groupBy(key).agg(
        F.count("amt").alias("n"), (F.sum(cents("amt")) / 100).alias("total_amount")
    )


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """One row with the number of distinct values of each column."""
    count = F.approx_count_distinct if approximate else F.countDistinct
    return df.agg(*[count(c).alias(f"n_{c}") for c in columns])


def daily_fraud_stats(
    df: DataFrame,
    ts: str = "trans_date_trans_time",
    fraud: str = "is_fraud",
    card: str = "cc_num",
) -> DataFrame:
    """Transactions, frauds and distinct defrauded cards per day, in one pass."""
    is_fraud = F.col(fraud) == 1
    n = F.count("*")
    return df.groupBy(F.to_date(ts).alias("trans_date")).agg(
        n.alias("num_transactions"),
        (n / 100).alias("num_transactions_scaled"),
        F.count_if(is_fraud).alias("num_fraud_transactions"),
        F.countDistinct(F.when(is_fraud, F.col(card))).alias("num_fraud_cards"),
    )


def mean_sparsity(df: DataFrame, ts: str = "trans_date_trans_time") -> DataFrame:
    """Distinct dates over the mean count and mean amount, per card and per merchant."""
    dates = df.select(F.countDistinct(F.to_date(ts))).scalar()
    out = df.agg(
        F.countDistinct("cc_num").alias("_cards"),
        F.countDistinct("merchant").alias("_merchants"),
        F.count(F.when(F.col("cc_num").isNotNull(), F.col("amt"))).alias("_n_card"),
        F.count(F.when(F.col("merchant").isNotNull(), F.col("amt"))).alias("_n_merchant"),
        F.sum(F.when(F.col("cc_num").isNotNull(), cents("amt"))).alias("_sum_card"),
        F.sum(F.when(F.col("merchant").isNotNull(), cents("amt"))).alias("_sum_merchant"),
    ).withColumn("_dates", dates)
    per = lambda keys, total: ratio(F.col("_dates").cast("double") * F.col(keys), total)
    return out.select(
        per("_cards", "_n_card").alias("card_count_sparsity"),
        per("_merchants", "_n_merchant").alias("merchant_count_sparsity"),
        (per("_cards", "_sum_card") * 100).alias("card_amount_sparsity"),
        (per("_merchants", "_sum_merchant") * 100).alias("merchant_amount_sparsity"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequencies in descending order, equal ones by value."""
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def top_values(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    return value_counts(df, column).limit(n)


def rates_by_dimension(df: DataFrame, dimensions: dict[str, Column], label: str = "is_fraud") -> DataFrame:
    """Long table (dimension, value, n, share, fraud_rate) for several dimensions at once.

    One scan: rows are first counted per combination of the dimensions, and the dimensions
    are then GROUPING SETS over those few counts.
    """
    names = list(dimensions)
    cells = (
        df.select(*[c.cast("string").alias(n) for n, c in dimensions.items()], label)
        .groupBy(*names)
        .agg(F.count("*").alias("_n"), F.count(label).alias("_known"), F.sum(F.col(label).cast("bigint")).alias("_bad"))
    )
    # grouping_id has one bit per name, set where the name is rolled up
    full = (1 << len(names)) - 1
    bit = {n: full ^ (1 << (len(names) - 1 - i)) for i, n in enumerate(names)}
    counted = cells.groupingSets([[n] for n in names], *names).agg(
        F.grouping_id().alias("_set"),
        F.sum("_n").alias("n"),
        ratio(F.sum("_bad"), F.sum("_known")).alias("fraud_rate"),
    )
    dimension, value = None, None
    for n in names:
        hit = F.col("_set") == bit[n]
        dimension = F.when(hit, n) if dimension is None else dimension.when(hit, n)
        value = F.when(hit, F.col(n)) if value is None else value.when(hit, F.col(n))
    long = counted.select(dimension.alias("dimension"), value.alias("value"), "n", "fraud_rate")
    # over the counts, which are one row per value
    total = F.sum("n").over(W.partitionBy("dimension"))
    return long.select("dimension", "value", "n", (F.col("n") / total).alias("share"), "fraud_rate")


def first_fraud(df: DataFrame, ts: str = "trans_date_trans_time") -> DataFrame:
    """Time of the first fraud of every card that has one."""
    return df.where("is_fraud = 1").groupBy("cc_num").agg(F.min(ts).alias("first_fraud_date"))


def with_first_fraud(df: DataFrame, ts: str = "trans_date_trans_time", max_rows: int = MAX_ROWS_PER_KEY) -> DataFrame:
    """Every row with its card's first fraud time; null means never.

    One aggregate gives both the first fraud and the row count of a card; rows of cards above the limit
    meet a broadcast of those cards' rows.
    """
    cards = stage(
        df.groupBy("cc_num").agg(
            F.min(F.when(F.col("is_fraud") == 1, F.col(ts))).alias("first_fraud_date"), F.count("*").alias("n_rows")
        )
    )
    return join_per_key(df, cards.drop("n_rows"), "cc_num", hot_keys(cards, "cc_num", max_rows))


def active_after_fraud(df: DataFrame, days: int = 3, ts: str = "trans_date_trans_time") -> DataFrame:
    """Share of all cards with an honest transaction more than ``days`` after their first fraud.

    A card qualifies if its last honest transaction does, so one aggregate per card is enough.
    """
    cards = df.groupBy("cc_num").agg(
        F.max(F.when(F.col("is_fraud") == 0, epoch_us(ts))).alias("_last_honest"),
        F.min(F.when(F.col("is_fraud") == 1, epoch_us(ts))).alias("_first_fraud"),
    )
    active = F.col("_last_honest") > F.col("_first_fraud") + days * DAY_US
    return cards.where("cc_num IS NOT NULL").agg(
        F.count("*").alias("n_cards"),
        F.count_if(active).alias("n_active"),
        ratio(F.count_if(active), F.count("*")).alias("active_share"),
    )


def class_means(df: DataFrame, columns: Sequence[str], label: str = "is_fraud") -> DataFrame:
    return df.groupBy(label).agg(*[F.avg(c).alias(f"mean_{c}") for c in columns])


def imbalance(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Negatives, positives and their ratio."""
    neg, pos = F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)
    return df.agg(neg.alias("negatives"), pos.alias("positives"), ratio(neg, pos).alias("imbalance_ratio"))


def monetary_loss(df: DataFrame, predicted: str = "predicted", label: str = "is_fraud") -> DataFrame:
    """Amount of the frauds that were predicted honest."""
    missed = (F.col(predicted) == 0) & (F.col(label) == 1)
    return df.agg((F.coalesce(F.sum(F.when(missed, cents("amt"))), F.lit(0)) / 100).alias("loss"))


def correlations(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation (a, b, r) of all column pairs; a row lacking a value is left out
    of the pairs it lacks. One scan, however many columns."""
    return comoments.correlations(df, list(columns or numeric_columns(df)))


def column_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value, x, known, n): each distinct value of each column as text and as a double (null unless numeric), and its count.

    One scan; each task counts the values of all columns before anything is sent.
    """
    names, numeric = list(columns), numeric_columns(df)
    full = (1 << len(names)) - 1  # grouping_id has one bit per name, set where the name is rolled up
    cells = df.groupingSets([[c] for c in names], *names).agg(F.grouping_id().alias("_set"), F.count("*").alias("_n"))
    own = {c: F.col("_set") == full ^ (1 << (len(names) - 1 - i)) for i, c in enumerate(names)}
    pick = lambda value: F.coalesce(*[F.when(own[c], value(c)) for c in names])
    return cells.select(
        pick(F.lit).alias("column_name"),
        pick(lambda c: F.col(c).cast("string")).alias("value"),
        pick(lambda c: F.col(c).cast("double") if c in numeric else F.lit(None).cast("double")).alias("x"),
        pick(lambda c: F.col(c).isNotNull()).alias("known"),
        F.col("_n").alias("n"),
    )


def frequent_values(df: DataFrame, columns: Sequence[str], support: float = 0.05, counts: DataFrame | None = None) -> DataFrame:
    """(column_name, value, n): every value that more than ``support`` of the rows hold, with its exact count.

    A heavy-hitter summary of all columns names at most ``1 / support`` candidates a column, so the candidates are
    broadcast; a second pass counts them. With ``counts``, a staged ``column_counts``, every value is counted already.
    """
    if counts is not None:
        counted = counts.where(F.col("value").isNotNull()).groupBy("column_name", "value").agg(F.sum("n").alias("n"))
        return counted.where(F.col("n") > support * df.count())
    texts = stage(df.select(*[F.col(c).cast("string").alias(c) for c in columns]))
    summary = texts.stat.freqItems(list(columns), support)
    named = lambda c: F.transform(F.col(f"`{c}_freqItems`"), lambda v: F.struct(F.lit(c).alias("_c"), v.alias("_v")))
    candidates = summary.select(F.inline(F.flatten(F.array(*[named(c) for c in columns])))).where("_v IS NOT NULL")
    long = texts.unpivot([], list(columns), "column_name", "value")
    counted = long.join(F.broadcast(candidates), (F.col("column_name") == F.col("_c")) & (F.col("value") == F.col("_v")), "left_semi")
    return counted.groupBy("column_name", "value").agg(F.count("*").alias("n")).where(F.col("n") > support * texts.count())


def table_profile(df: DataFrame, approximate: bool = False, support: float = 0.05, top: int = 3) -> DataFrame:
    """Long (column_name, stat, value, text): type and counts of every column, moments and quartiles of numeric ones,
    and up to ``top`` values that more than ``support`` of the rows hold (``value`` is their count).

    Exact distinct counts, quartiles and frequent values all come from one count of every column's values; approximate
    distinct counts need none, and then quartiles and frequent values take passes of their own.
    """
    df = stage(df)
    counts = None if approximate else stage(column_counts(df, df.columns))
    numeric = numeric_columns(df)
    stats = {}
    for c in df.columns:
        stats[c, "count"] = F.count(c)
        stats[c, "missing"] = F.count_if(F.col(c).isNull())
        if approximate:
            stats[c, "distinct"] = F.approx_count_distinct(c)
        if c in numeric:
            x = F.col(c).cast("double")
            stats[c, "mean"], stats[c, "std"] = F.avg(x), F.stddev_samp(x)
            stats[c, "min"], stats[c, "max"] = F.min(x), F.max(x)
    names = list(stats)
    one = df.agg(*[stats[k].cast("double").alias(f"s{i}") for i, k in enumerate(names)])
    row = lambda c, s, value, text: F.struct(F.lit(c).alias("column_name"), F.lit(s).alias("stat"), value.alias("value"), text.alias("text"))
    nothing = F.lit(None)
    rows = [row(c, s, F.col(f"s{i}"), nothing.cast("string")) for i, (c, s) in enumerate(names)]
    rows += [row(c, "type", nothing.cast("double"), F.lit(t)) for c, t in df.dtypes]
    out = one.select(F.inline(F.array(*rows)))
    if counts is not None:
        found = counts.agg(*[F.count_if((F.col("column_name") == c) & F.col("known")).cast("double").alias(f"d{i}") for i, c in enumerate(df.columns)])
        out = out.unionByName(found.select(F.inline(F.array(*[row(c, "distinct", F.col(f"d{i}"), nothing.cast("string")) for i, c in enumerate(df.columns)]))))
    if numeric:
        names_of = F.when(F.col("probability") == 0.25, "q1").when(F.col("probability") == 0.5, "median").otherwise("q3")
        if counts is None:
            quartiles = quantiles_of(df, {c: (0.25, 0.5, 0.75) for c in numeric})
        else:
            quartiles = quantiles(counts, "x", (0.25, 0.5, 0.75), ("column_name",), weight="n")
        out = out.unionByName(quartiles.select("column_name", names_of.alias("stat"), F.col("quantile").alias("value"), nothing.cast("string").alias("text")))
    place = F.row_number().over(W.partitionBy("column_name").orderBy(F.desc("n"), "value"))  # at most 1 / support rows each
    frequent = frequent_values(df, df.columns, support, counts).withColumn("_place", place).where(F.col("_place") <= top)
    return out.unionByName(
        frequent.select("column_name", F.concat(F.lit("frequent_"), "_place").alias("stat"), F.col("n").cast("double").alias("value"), F.col("value").alias("text"))
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """One row: how many rows repeat an earlier identical row."""
    return (
        df.groupBy(*df.columns)
        .agg((F.count("*") - 1).alias("_extra"))
        .agg(F.coalesce(F.sum("_extra"), F.lit(0)).alias("n_duplicates"))
    )


def _equal_bins(df: DataFrame, bins: dict[str, int]) -> list[tuple[Column, Column]]:
    """Per column (bin number 0..bins-1, left edge) over its own range; the maximum is in the last bin.

    One pass finds the ranges of all columns.
    """
    ends = df.agg(*[f(c).cast("double") for c in bins for f in (F.min, F.max)]).first()
    out = []
    for i, (column, n) in enumerate(bins.items()):
        low, high = ends[2 * i], ends[2 * i + 1]
        low = 0.0 if low is None else low
        width = ((high - low) / n if high is not None else 0.0) or 1.0
        number = F.least(F.floor((F.col(column).cast("double") - low) / width), F.lit(n - 1)).cast("int")
        out.append((number, F.lit(low) + number * F.lit(width)))
    return out


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Counts over equal-width bins."""
    values = stage(df.select(F.col(column).cast("double").alias("x")).where("x IS NOT NULL"))
    ((number, edge),) = _equal_bins(values, {"x": bins})
    return values.groupBy(number.alias("bin")).agg(F.min(edge).alias("bin_start"), F.count("*").alias("n"))


def _points(df: DataFrame, x: str, y: str) -> DataFrame:
    """The rows with both values, written once: their range and their cells are two passes."""
    if x == y:
        raise ValueError("a grid needs two columns")
    both = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    return stage(both.where("x IS NOT NULL AND y IS NOT NULL"))


def density2d(df: DataFrame, x: str, y: str, x_bins: int = 20, y_bins: int = 20) -> DataFrame:
    """Counts over a rectangular grid."""
    points = _points(df, x, y)
    (xn, _), (yn, _) = _equal_bins(points, {"x": x_bins, "y": y_bins})
    return points.groupBy(xn.alias("x_bin"), yn.alias("y_bin")).agg(F.count("*").alias("n"))


def hex_density(df: DataFrame, x: str, y: str, cells: int = 20) -> DataFrame:
    """Counts over hexagonal cells: (row, column, x_centre, y_centre, n), ``cells`` of them along x.

    The centres form two rectangular lattices, the second moved by half a cell both ways; even rows belong to the
    first. A point belongs to the nearest centre, the first lattice's at equal distance.
    """
    points = _points(df, x, y)
    ends = points.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()
    low_x, low_y = ends[0] or 0.0, ends[2] or 0.0
    tall = max(1, int(cells / sqrt(3)))
    wide_x, wide_y = ((ends[1] or 0.0) - low_x) / cells or 1.0, ((ends[3] or 0.0) - low_y) / tall or 1.0
    u, v = (F.col("x") - low_x) / wide_x, (F.col("y") - low_y) / wide_y
    own = {"_u": F.floor(u + 0.5), "_v": F.floor(v + 0.5), "_s": F.floor(u), "_t": F.floor(v)}
    placed = points.select(u.alias("_x"), v.alias("_y"), *[c.cast("int").alias(n) for n, c in own.items()])
    near = F.pow(F.col("_x") - F.col("_u"), 2) + 3 * F.pow(F.col("_y") - F.col("_v"), 2)
    other = F.pow(F.col("_x") - F.col("_s") - 0.5, 2) + 3 * F.pow(F.col("_y") - F.col("_t") - 0.5, 2)
    first = near <= other
    cell = placed.select(
        F.when(first, 2 * F.col("_v")).otherwise(2 * F.col("_t") + 1).alias("row"), F.when(first, F.col("_u")).otherwise(F.col("_s")).alias("column")
    )
    shift = F.when(F.col("row") % 2 == 0, 0.0).otherwise(0.5)
    return (
        cell.groupBy("row", "column")
        .agg(F.count("*").alias("n"))
        .select(
            "row",
            "column",
            (F.lit(low_x) + (F.col("column") + shift) * wide_x).alias("x_centre"),
            (F.lit(low_y) + F.col("row") / 2 * wide_y).alias("y_centre"),
            "n",
        )
    )


def box_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """Quartiles per group, and the extreme values within 1.5 times the quartile range."""
    present = df.where(F.col(group).isNotNull() & F.col(value).isNotNull())
    at = lambda p: F.max(F.when(F.col("probability") == p, F.col("quantile")))
    quartiles = settle_small(
        quantiles(present, value, (0.25, 0.5, 0.75), (group,))
        .groupBy(group)
        .agg(at(0.25).alias("q1"), at(0.5).alias("median"), at(0.75).alias("q3"))
    )
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    x = F.col(value).cast("double")
    return (
        present.join(quartiles, group)
        .groupBy(group, "q1", "median", "q3")
        .agg(
            F.min(F.when(x >= F.col("q1") - reach, x)).alias("low_whisker"),
            F.max(F.when(x <= F.col("q3") + reach, x)).alias("high_whisker"),
            F.count("*").alias("n"),
        )
    )


def preview(df: DataFrame, order: str, n: int = 5) -> DataFrame:
    return df.orderBy(order).limit(n)


def time_slice(df: DataFrame, start: str, end: str, ts: str = "trans_date_trans_time") -> DataFrame:
    """Rows with start <= time <= end."""
    return df.where(F.col(ts).between(F.to_timestamp(F.lit(start)), F.to_timestamp(F.lit(end))))
