"""Card and merchant windows carried forward from day to day.

Scoring a new day needs, of all history, only what its windows still reach. The state holds

* per card, the transactions within the longest window before the card's newest one (a window ends at the card's
  previous transaction, so nothing older is ever asked for);
* the transactions that the delayed merchant windows of later rows reach;
* totals per card, merchant and city (rows, amounts, times), from which sparsity, the mean gap and city means follow,
  and the days seen.

``advance`` takes the state and the next rows, returns their features and the next state. It reads the state and
the new rows, never the history. Batches are whole days in order of time: a row that is not newer than
the state raises an error, as it would change features that are already out.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerglass.functions.dates import epoch_us
from ledgerglass.functions.numbers import cents
from ledgerglass.operators.rolling import CARD_WINDOWS, RISK_WINDOWS, card_behaviour, merchant_risk
from ledgerglass.operators.skew import MAX_ROWS_PER_KEY, join_salted
from ledgerglass.schema import DAY_US, require_columns
from ledgerglass.sources.stage import stage

TS = "trans_date_trans_time"
COLUMNS = ("trans_num", TS, "cc_num", "merchant", "city", "amt", "distance", "is_fraud")
TABLES = ("card_tail", "merchant_tail", "cards", "merchants", "cities", "days")


@dataclass(frozen=True)
class State:
    """Tables as of the end of the last day."""

    card_tail: DataFrame
    merchant_tail: DataFrame
    cards: DataFrame
    merchants: DataFrame
    cities: DataFrame
    days: DataFrame

    def save(self, path: str) -> None:
        """Parquet tables below a new path; a state read from it replaces the one before."""
        for name in TABLES:
            getattr(self, name).write.parquet(f"{path}/{name}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "State":
        return cls(*[spark.read.parquet(f"{path}/{name}") for name in TABLES])


def _key_totals(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(
        F.count("*").alias("n_rows"),
        F.count("amt").alias("_n"),
        F.sum(cents("amt")).alias("_cents"),
        F.count(TS).alias("_times"),
        F.min(epoch_us(TS)).alias("_first"),
        F.max(epoch_us(TS)).alias("_last"),
    )


def _merged_keys(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    adds = {c: F.sum(c) for c in ("n_rows", "_n", "_cents", "_times")} | {"_first": F.min("_first"), "_last": F.max("_last")}
    return old.unionByName(new).groupBy(key).agg(*[f.cast(dict(old.dtypes)[c]).alias(c) for c, f in adds.items()])


def _city_totals(df: DataFrame) -> DataFrame:
    return df.groupBy("city").agg(
        F.sum(cents("amt")).alias("_cents"), F.count("amt").alias("_n"), F.sum("distance").alias("_miles"), F.count("distance").alias("_nd")
    )


def city_means(state: State) -> DataFrame:
    """Mean amount and distance per city over all days so far."""
    return state.cities.select(
        "city",
        F.try_divide(F.col("_cents").cast("double"), F.col("_n") * 100).alias("city_amount"),
        F.try_divide("_miles", "_nd").alias("city_distance"),
    )


def begin(df: DataFrame, windows: Sequence[int] = CARD_WINDOWS, delay: int = 7, risk_windows: Sequence[int] = RISK_WINDOWS) -> State:
    """The state after a history; an empty one is a table without rows."""
    require_columns(df, *COLUMNS)
    rows = stage(df.select(*COLUMNS))
    return _settled(rows, rows, _key_totals(rows, "cc_num"), _key_totals(rows, "merchant"), _city_totals(rows), _days(rows), windows, delay, risk_windows)


def _days(df: DataFrame) -> DataFrame:
    return df.select(F.to_date(TS).alias("day")).where("day IS NOT NULL").distinct()


def _settled(card_rows, merchant_rows, cards, merchants, cities, days, windows, delay, risk_windows) -> State:
    """Cut the tails and write every table once."""
    cards, merchants, cities, days = stage(cards), stage(merchants), stage(cities), stage(days)
    last = cards.select(F.col("cc_num").alias("_card"), F.col("_last").alias("_newest")).where("_newest IS NOT NULL")
    timed = card_rows.where(F.col(TS).isNotNull())
    tail = join_salted(timed, last, {"cc_num": "_card"})
    tail = tail.where(epoch_us(TS) > F.col("_newest") - max(windows) * DAY_US).drop("_newest")
    end = days.agg(F.max("day").alias("day"))
    reach = delay + max(risk_windows) + 1
    kept = merchant_rows.where(F.col(TS).isNotNull()).withColumn("_end", end.scalar())
    kept = kept.where(F.to_date(TS) > F.date_sub("_end", reach)).drop("_end")
    return State(stage(tail), stage(kept.select("trans_num", TS, "merchant", "is_fraud")), cards, merchants, cities, days)


def advance(
    state: State,
    new: DataFrame,
    windows: Sequence[int] = CARD_WINDOWS,
    delay: int = 7,
    risk_windows: Sequence[int] = RISK_WINDOWS,
    means: DataFrame | None = None,
    cards: DataFrame | None = None,
    max_rows: int = MAX_ROWS_PER_KEY,
) -> tuple[DataFrame, State]:
    """(features of the new rows, state after them).

    First rows of a card take ``means`` and the mean gap of ``cards`` (a fitted ``key_profile``); by default those of the
    state before the new rows, so that no feature looks ahead. A row without a time has no windows and is not carried.
    """
    require_columns(new, *COLUMNS)
    means = city_means(state) if means is None else means
    end = state.days.agg(F.max("day").alias("day")).scalar()
    late = F.to_date(TS) <= F.col("_end")
    checked = new.withColumn("_end", end).withColumn(TS, F.when(F.coalesce(late, F.lit(False)), F.raise_error(F.lit("a row is not newer than the state"))).otherwise(F.col(TS)))
    rows = stage(checked.drop("_end"))
    slim = rows.select(*COLUMNS).withColumn("_new", F.lit(True))
    both = state.card_tail.withColumn("_new", F.lit(False)).unionByName(slim)
    by_card = card_behaviour(both, windows, means, state.cards if cards is None else cards, TS, max_rows).where("_new")
    both = by_card.unionByName(state.merchant_tail.withColumn("_new", F.lit(False)), allowMissingColumns=True)
    by_merchant = merchant_risk(both, delay, risk_windows, ts=TS, max_rows=max_rows).where("_new")
    features = by_merchant.drop("_new", *[c for c in COLUMNS if c != "trans_num"])
    slim = slim.drop("_new")
    following = _settled(
        state.card_tail.unionByName(slim),
        state.merchant_tail.unionByName(slim.select("trans_num", TS, "merchant", "is_fraud")),
        _merged_keys(state.cards, _key_totals(slim, "cc_num"), "cc_num"),
        _merged_keys(state.merchants, _key_totals(slim, "merchant"), "merchant"),
        state.cities.unionByName(_city_totals(slim)).groupBy("city").agg(*[F.sum(c).cast(dict(state.cities.dtypes)[c]).alias(c) for c in ("_cents", "_n", "_miles", "_nd")]),
        state.days.unionByName(_days(slim)).distinct(),
        windows,
        delay,
        risk_windows,
    )
    return features, following


def sparsity(state: State, key: str, prefix: str) -> DataFrame:
    """Days seen over the key's count, and over its amount."""
    totals = {"cc_num": state.cards, "merchant": state.merchants}[key]
    seen = state.days.agg(F.count("*").alias("n")).scalar()
    return totals.withColumn("_days", seen).select(
        key,
        F.try_divide(F.col("_days").cast("double"), "_n").alias(f"{prefix}_count_sparsity"),
        F.try_divide(F.col("_days") * 100.0, "_cents").alias(f"{prefix}_amount_sparsity"),
    )
