"""Event-time windows per card and per merchant.

Every rolling total is the difference of two running totals, ``F(t) - F(t - W)``. A
frame that starts at UNBOUNDED PRECEDING is extended row by row, so the cost per key is
linear, where a sliding frame would re-add its whole content for every row. All windows
of one operator share a single exchange and sort. Sums are kept as integers (cents, and
miles times 2**20), so that the differences are exact.

Keys with too many rows for one task take a second way (see ``running_totals``) with the
same results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ledgerglass.functions.dates import epoch_us
from ledgerglass.functions.numbers import cents, ratio
from ledgerglass.operators.running import running_totals
from ledgerglass.operators.skew import MAX_ROWS_PER_KEY, count_keys, hot_keys, join_per_key, settle_small, split_hot
from ledgerglass.schema import DAY_US, require_columns
from ledgerglass.sources.stage import small_methods, stage

DISTANCE_SCALE = 1 << 20  # a power of two, so that scaling back is exact
TIES = ("amt", "distance")  # order rows of one time and id, so that results do not depend on the input's order
CARD_WINDOWS = (7, 30, 90, 180)
RISK_WINDOWS = (1, 7, 30)


def _cumulative_at(
    events: DataFrame, probes: DataFrame, key: str, sums: Sequence[str]
) -> DataFrame:
    """For each probe (key, _at, _row, _tag): totals of the key's events up to ``_at``, inclusive.

    ``events`` has (key, _at, _row, *sums). Both are laid on one time line and walked with
    range-cut running totals; an event at the time of a probe comes before it.
    """
    line = (
        events.select(key, "_at", F.lit(0).alias("_kind"), "_row", F.lit(0).alias("_tag"), *sums)
        .unionByName(
            probes.select(key, "_at", F.lit(1).alias("_kind"), "_row", "_tag"),
            allowMissingColumns=True,
        )
        .withColumn("_order", F.struct("_at", "_kind", "_row", "_tag"))
    )
    totals = running_totals(line, [key], "_order", {f"{c}_upto": ("sum", c) for c in sums})
    return totals.where("_kind = 1").select("_row", "_tag", *[f"{c}_upto" for c in sums])


def _by_tag(df: DataFrame, tags: Sequence[int], sums: Sequence[str]) -> DataFrame:
    """One row per ``_row`` with a column ``{sum}_{tag}`` for every tag."""
    return df.groupBy("_row").agg(
        *[
            F.max(F.when(F.col("_tag") == tag, F.col(f"{c}_upto"))).alias(f"{c}_{tag}")
            for c in sums
            for tag in tags
        ]
    )


def _card_measures(df: DataFrame, wide: bool) -> tuple[DataFrame, list[str]]:
    """Integer measure columns; wide sums for keys whose totals may pass 64 bits.

    A row without a time is in nobody's window, so it measures 0.
    """
    number = "decimal(38,0)" if wide else "bigint"
    made = {
        "_n": F.when(F.col("amt").isNotNull(), 1).otherwise(0).cast("bigint"),
        "_cents": cents("amt").cast(number),
        "_nd": F.when(F.col("distance").isNotNull(), 1).otherwise(0).cast("bigint"),
        "_miles": F.round(F.col("distance") * DISTANCE_SCALE).cast("bigint").cast(number),
    }
    timed = F.col("_at").isNotNull()
    return df.withColumns({c: F.when(timed, x).otherwise(F.lit(0).cast("bigint" if c in ("_n", "_nd") else number)) for c, x in made.items()}), list(made)


def _card_totals_ordinary(df: DataFrame, key: str, row_id: str, windows: Sequence[int]) -> DataFrame:
    """Adds ``_prev_at`` and, per window, ``{measure}_{w}``: the total over the window that
    ends at the card's previous transaction."""
    df, sums = _card_measures(df, wide=False)
    in_order = W.partitionBy(key).orderBy("_at", row_id, *TIES)
    before = in_order.rowsBetween(W.unboundedPreceding, -1)
    by_time = W.partitionBy(key).orderBy("_at")
    walked = df.select(
        "*",
        F.lag("_at").over(in_order).alias("_prev_at"),
        *[F.sum(c).over(before).alias(f"{c}_before") for c in sums],
    )
    tails = walked.select(
        "*",
        *[
            F.sum(c).over(by_time.rangeBetween(W.unboundedPreceding, -w * DAY_US)).alias(f"{c}_tail_{w}")
            for c in sums
            for w in windows
        ],
    )
    return tails.select(
        *df.columns,
        "_prev_at",
        *[
            (
                F.coalesce(F.col(f"{c}_before"), F.lit(0))
                - F.coalesce(F.lag(f"{c}_tail_{w}").over(in_order), F.lit(0))
            ).alias(f"{c}_{w}")
            for c in sums
            for w in windows
        ],
    ).drop(*sums)


def _numbered(df: DataFrame) -> DataFrame:
    """With a row number of our own: ids may repeat or be null."""
    return stage(df.withColumn("_row", F.monotonically_increasing_id()))


def _card_totals_hot(df: DataFrame, key: str, row_id: str, windows: Sequence[int]) -> DataFrame:
    """Same result as ``_card_totals_ordinary``, cutting each key's time line into ranges."""
    df = _numbered(df)
    measured, sums = _card_measures(df, wide=True)
    order = F.struct("_at", F.col(row_id).alias("_id"), *TIES, "_row")
    events = measured.select(key, "_at", "_row", order.alias("_order"), *sums)
    walked = running_totals(
        events,
        [key],
        "_order",
        {**{f"{c}_before": ("sum", c) for c in sums}, "_prev_at": ("max", "_at")},
    ).select(key, "_row", "_prev_at", *[f"{c}_before" for c in sums])
    probes = (
        walked.where("_prev_at IS NOT NULL")
        .select(key, "_row", "_prev_at", F.explode(F.array(*[F.lit(w) for w in windows])).alias("_tag"))
        .withColumn("_at", F.col("_prev_at") - F.col("_tag").cast("bigint") * DAY_US)
    )
    tails = _by_tag(_cumulative_at(events, probes, key, sums), windows, sums)
    features = walked.join(tails, "_row", "left").select(
        "_row",
        "_prev_at",
        *[
            (F.col(f"{c}_before") - F.coalesce(F.col(f"{c}_{w}"), F.lit(0))).cast("bigint" if c in ("_n", "_nd") else "decimal(38,0)").alias(f"{c}_{w}")
            for c in sums
            for w in windows
        ],
    )
    return df.join(features, "_row").drop("_row")


def card_totals(
    df: DataFrame,
    windows: Sequence[int],
    key: str = "cc_num",
    row_id: str = "trans_num",
    ts: str = "trans_date_trans_time",
    hot: DataFrame | None = None,
) -> DataFrame:
    """Window counts and sums per card, plus ``daily_trans_count`` and the previous time.

    A row without a time has null windows and is in no other row's.
    """
    timed = df.withColumn("_at", epoch_us(ts))
    ordinary, hot = split_hot(timed, key, hot)
    day = F.to_date(ts)
    ordinary = _card_totals_ordinary(ordinary, key, row_id, windows).withColumn(
        "daily_trans_count", F.count(row_id).over(W.partitionBy(key, day))
    )
    money = [f"{c}_{w}" for c in ("_cents", "_miles") for w in windows]
    ordinary = ordinary.withColumns({c: F.col(c).cast("double") for c in money})
    made = ["daily_trans_count", *[f"{c}_{w}" for c in ("_n", "_cents", "_nd", "_miles") for w in windows]]
    known = {c: F.when(F.col("_at").isNotNull(), F.col(c)) for c in made}
    if hot is None:
        return ordinary.withColumns(known)
    per_day = hot.groupBy(F.col(key).alias("_dk"), day.alias("_dd")).agg(
        F.count(row_id).alias("daily_trans_count")
    )
    hot = (
        _card_totals_hot(hot, key, row_id, windows)
        .join(per_day, F.col(key).eqNullSafe(F.col("_dk")) & (day == F.col("_dd")), "left")
        .drop("_dk", "_dd")
    )
    both = ordinary.unionByName(hot.withColumns({c: F.col(c).cast("double") for c in money}))
    return both.withColumns(known)


def city_means(df: DataFrame) -> DataFrame:
    """Mean amount and distance per city."""
    return df.groupBy("city").agg(
        (F.sum(cents("amt")).cast("double") / F.count("amt") / 100).alias("city_amount"),
        F.avg("distance").alias("city_distance"),
    )


def key_profile(df: DataFrame, key: str, ts: str = "trans_date_trans_time") -> DataFrame:
    """One row per key: rows, amounts counted and summed, first and last time.

    It answers for the hot keys, the sparsity and the mean gap in one pass; staged, because
    all three read it.
    """
    return stage(
        df.groupBy(key).agg(
            F.count("*").alias("n_rows"),
            F.count("amt").alias("_n"),
            F.sum(cents("amt")).alias("_cents"),
            F.count(ts).alias("_times"),
            F.min(epoch_us(ts)).alias("_first"),
            F.max(epoch_us(ts)).alias("_last"),
        )
    )


def mean_gap_seconds(cards: DataFrame) -> DataFrame:
    """One row: the mean time between neighbouring transactions of a card.

    The gaps of a card add up to its last minus its first time, so no window is needed.
    """
    span = F.sum((F.col("_last") - F.col("_first")).cast("decimal(20,0)")).cast("double")
    gaps = F.sum(F.col("_times") - 1).cast("double")
    return cards.agg(F.try_divide(span, gaps * 1e6).alias("mean_gap"))


def count_dates(df: DataFrame, ts: str = "trans_date_trans_time") -> DataFrame:
    return df.select(F.countDistinct(F.to_date(ts)).alias("n_dates"))


def with_sparsity(
    df: DataFrame,
    key: str,
    prefix: str,
    profile: DataFrame,
    dates: DataFrame,
    max_rows: int = MAX_ROWS_PER_KEY,
) -> DataFrame:
    """Distinct dates of the whole table over the key's count, and over its amount."""
    table = profile.withColumn("_dates", dates.scalar()).select(
        key,
        ratio("_dates", "_n").alias(f"{prefix}_count_sparsity"),
        ratio(F.col("_dates") * 100, F.col("_cents")).alias(f"{prefix}_amount_sparsity"),
    )
    return join_per_key(df, table, key, hot_keys(profile, key, max_rows))


def card_behaviour(
    df: DataFrame,
    windows: Sequence[int] = CARD_WINDOWS,
    means: DataFrame | None = None,
    cards: DataFrame | None = None,
    ts: str = "trans_date_trans_time",
    max_rows: int = MAX_ROWS_PER_KEY,
) -> DataFrame:
    """Rolling amount, count and distance features of each card, ratios, gap and daily count.

    Windows end at the card's previous transaction. A card's first row has no window: sum
    and count stay null, the averages fall back to the mean of the row's city, taken from
    ``means`` (fitted on training data) or from this table. ``cards`` is the table's
    ``key_profile`` by card, if the caller has it.
    """
    require_columns(df, "cc_num", "trans_num", "amt", "distance", "city", ts)
    small_methods(df.sparkSession)
    means = settle_small(city_means(df)) if means is None else means
    cards = key_profile(df, "cc_num", ts) if cards is None else cards
    gap = mean_gap_seconds(cards).scalar()
    totals = card_totals(df, windows, ts=ts, hot=hot_keys(cards, "cc_num", max_rows))
    filled = totals.join(means, "city", "left").withColumn("_mean_gap", gap)
    first = F.col("_prev_at").isNull()
    seconds = F.coalesce((F.col("_at") - F.col("_prev_at")) / 1e6, F.col("_mean_gap"))
    averages, features = {}, {}
    for w in windows:
        has_amt, has_miles = F.col(f"_n_{w}") > 0, F.col(f"_nd_{w}") > 0
        averages[f"sum_amount_{w}_days"] = F.when(has_amt, F.col(f"_cents_{w}") / 100)
        averages[f"count_amount_{w}_days"] = F.when(~first, F.col(f"_n_{w}"))
        averages[f"avg_amount_{w}_days"] = F.coalesce(
            F.when(has_amt, F.col(f"_cents_{w}") / 100 / F.col(f"_n_{w}")), F.col("city_amount")
        )
        averages[f"avg_distance_{w}_days"] = F.coalesce(
            F.when(has_miles, F.col(f"_miles_{w}") / DISTANCE_SCALE / F.col(f"_nd_{w}")),
            F.col("city_distance"),
        )
        features[f"amount_over_average_{w}_days"] = ratio("amt", f"avg_amount_{w}_days")
        features[f"distance_over_avg_{w}_days"] = ratio("distance", f"avg_distance_{w}_days")
        features[f"inter_transaction_time_{w}_days"] = seconds
    keep = [*df.columns, "daily_trans_count", *averages, *features]
    return filled.withColumns(averages).withColumns(features).select(*keep)


def _risk_columns(windows: Sequence[int], delay: int) -> list[Column]:
    out = []
    for w in windows:
        old = delay + w
        n = F.coalesce(F.col(f"_n_{delay}"), F.lit(0)) - F.coalesce(F.col(f"_n_{old}"), F.lit(0))
        bad = F.coalesce(F.col(f"_bad_{delay}"), F.lit(0)) - F.coalesce(F.col(f"_bad_{old}"), F.lit(0))
        out.append(n.alias(f"merchant_num_trans_{w}_day_window"))
        out.append(F.coalesce(ratio(bad, n), F.lit(0.0)).alias(f"merchant_risk_{w}_day_window"))
    return out


def merchant_risk(
    df: DataFrame,
    delay: int = 7,
    windows: Sequence[int] = RISK_WINDOWS,
    key: str = "merchant",
    row_id: str = "trans_num",
    ts: str = "trans_date_trans_time",
    max_rows: int = MAX_ROWS_PER_KEY,
    profile: DataFrame | None = None,
) -> DataFrame:
    """Transactions and fraud share of the merchant in ``(t - delay - w, t - delay]`` days.

    Labels become known only after the delay, so a row never sees newer ones. An empty
    window gives 0 transactions and risk 0. ``profile`` is a table of ``n_rows`` per key, if
    the caller has one.
    """
    require_columns(df, key, row_id, ts, "is_fraud")
    small_methods(df.sparkSession)
    timed = df.withColumns(
        {
            "_at": epoch_us(ts),
            "_n": F.when(F.col("is_fraud").isNotNull(), 1).otherwise(0).cast("bigint"),
            "_bad": F.col("is_fraud").cast("bigint"),
        }
    )
    counts = count_keys(df, key) if profile is None else profile
    ordinary, hot = split_hot(timed, key, hot_keys(counts, key, max_rows))
    offsets = [delay, *[delay + w for w in windows]]
    sums = ("_n", "_bad")

    by_time = W.partitionBy(key).orderBy("_at")
    ordinary = ordinary.select(
        "*",
        *[
            F.sum(c).over(by_time.rangeBetween(W.unboundedPreceding, -o * DAY_US)).alias(f"{c}_{o}")
            for c in sums
            for o in offsets
        ],
    ).select(*df.columns, *_risk_columns(windows, delay))
    if hot is None:
        return ordinary

    hot = _numbered(hot)
    events = hot.select(key, "_at", "_row", *sums)
    probes = events.select(
        key, "_row", F.col("_at").alias("_own"), F.explode(F.array(*[F.lit(o) for o in offsets])).alias("_tag")
    ).withColumn("_at", F.col("_own") - F.col("_tag").cast("bigint") * DAY_US)
    upto = _by_tag(_cumulative_at(events, probes, key, sums), offsets, sums)
    hot = (
        hot.drop(*sums)
        .join(upto, "_row")
        .select(*df.columns, *_risk_columns(windows, delay))
    )
    return ordinary.unionByName(hot)
