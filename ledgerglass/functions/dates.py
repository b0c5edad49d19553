"""Calendar expressions on timestamps; all assume a UTC session time zone."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerglass.schema import DAY_US

# US federal holidays as (month, day, first year) ...
FIXED_DATE_HOLIDAYS = (
    (1, 1, 1870),
    (6, 19, 2021),
    (7, 4, 1870),
    (11, 11, 1978),
    (12, 25, 1870),
)
# ... and as (month, weekday with Monday = 0, n-th in the month, first year); n = -1 is the last one.
WEEKDAY_HOLIDAYS = (
    (1, 0, 3, 1986),
    (2, 0, 3, 1971),
    (5, 0, -1, 1971),
    (9, 0, 1, 1894),
    (10, 0, 2, 1971),
    (11, 3, 4, 1942),
)


def parse_timestamp(text, fmt: str | None = None, strict: bool = False) -> Column:
    """Text to timestamp; unparseable text gives null, or an error when strict."""
    args = (F.col(text) if isinstance(text, str) else text,) + ((F.lit(fmt),) if fmt else ())
    return F.to_timestamp(args[0], fmt) if strict else F.try_to_timestamp(*args)


def epoch_us(ts) -> Column:
    """Microseconds since the epoch, for TIMESTAMP and TIMESTAMP_NTZ columns alike."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(ts.cast("timestamp"))


def hour_of_day(ts) -> Column:
    return F.hour(ts)


def day_of_week(ts) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(ts)


def is_weekend(ts) -> Column:
    return F.when(F.weekday(ts) >= 5, 1).otherwise(0)


def high_risk_hour(ts) -> Column:
    """2 for the late evening, 1 for the small hours, else 0."""
    hour = F.hour(ts)
    return F.when(hour.isin(22, 23), 2).when(hour.between(0, 3), 1).otherwise(0)


def _on_fixed_holiday(day: Column) -> Column:
    return reduce(
        lambda a, b: a | b,
        [
            (F.month(day) == m) & (F.dayofmonth(day) == d) & (F.year(day) >= y)
            for m, d, y in FIXED_DATE_HOLIDAYS
        ],
    )


def is_us_holiday(ts) -> Column:
    """1 on US federal holidays including observed days, else 0.

    A fixed-date holiday on a Saturday is also observed on the Friday before, one on a
    Sunday on the Monday after. Written as arithmetic on the date, so no calendar join.
    """
    day = F.to_date(ts)
    weekday = F.weekday(day)
    nth = F.ceil(F.dayofmonth(day) / 7)
    from_end = F.ceil((F.dayofmonth(F.last_day(day)) - F.dayofmonth(day) + 1) / 7)
    floating = reduce(
        lambda a, b: a | b,
        [
            (F.month(day) == m)
            & (weekday == wd)
            & ((from_end == -n) if n < 0 else (nth == n))
            & (F.year(day) >= y)
            for m, wd, n, y in WEEKDAY_HOLIDAYS
        ],
    )
    observed = ((weekday == 4) & _on_fixed_holiday(F.date_add(day, 1))) | (
        (weekday == 0) & _on_fixed_holiday(F.date_sub(day, 1))
    )
    return F.when(_on_fixed_holiday(day) | floating | observed, 1).otherwise(0)


def month_of(ts) -> Column:
    """First day of the month."""
    return F.trunc(F.to_date(ts), "month")


def shift_days(ts, days: int) -> Column:
    """The same time of day, a number of days later (earlier if negative)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_micros(epoch_us(ts) + F.lit(days * DAY_US))


def age_in_years(ts, dob) -> Column:
    """Whole 365-day years between the birth date and the transaction."""
    return F.floor(F.datediff(F.to_date(ts), F.col(dob) if isinstance(dob, str) else dob) / 365)


def date_series(df: DataFrame, start: str, end: str, step_days: int, name: str = "point") -> DataFrame:
    """One row per step from start to end (inclusive) for every input row."""
    return df.withColumn(
        name,
        F.explode(F.sequence(F.col(start), F.col(end), F.expr(f"interval {int(step_days)} days"))),
    )


def with_time_features(df: DataFrame, ts: str = "trans_date_trans_time") -> DataFrame:
    """Date, hour, weekday, holiday, weekend and risky-hour columns."""
    return df.withColumns(
        {
            "trans_date": F.to_date(ts),
            "transaction_hour": hour_of_day(ts),
            "transaction_day_of_week": day_of_week(ts),
            "is_holiday": is_us_holiday(ts),
            "is_weekend": is_weekend(ts),
            "is_high_risk_hour": high_risk_hour(ts),
        }
    )
