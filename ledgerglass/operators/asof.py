"""As-of join: each row meets the newest event of its key at or before its own time."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F

from ledgerglass.operators.running import running_totals


def asof_join(
    df: DataFrame,
    events: DataFrame,
    keys: Sequence[str],
    at: str,
    values: Sequence[str],
    event_at: str | None = None,
    tie: str | None = None,
    strict: bool = False,
    prefix: str = "",
) -> DataFrame:
    """The rows of ``df`` with the ``values`` of the newest event of the same keys; nulls if there is none.

    An event at a row's own time counts unless ``strict``. Of several events at one time the greatest ``tie`` (then the greatest
    values) counts. Events without a time are never found; rows without a time or with a null key get nulls.

    Rows and events are laid on one time line per key, and the newest event is a running maximum. The time line is
    cut into ranges of about equal size over all keys, so no task receives a whole key, however hot it is. Rows bring their
    columns along, so the time line is written and dealt once and nothing is joined back.
    """
    event_at = event_at or at
    known = lambda columns: reduce(and_, [F.col(c).isNotNull() for c in columns])
    key = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    time = lambda c: F.unix_micros(F.col(c).cast("timestamp")) if dict(df.dtypes)[at].startswith("timestamp") else F.col(c)
    newest = F.struct(time(event_at).alias("at"), (F.col(tie) if tie else F.lit(None).cast("int")).alias("tie"), *[F.col(v).alias(f"v{i}") for i, v in enumerate(values)])
    # rows without a key or a time stand on a line of their own, where no event is
    placed = known([*keys, at])
    nowhere = F.struct(*[F.lit(None).cast(df.schema[k].dataType).alias(f"k{i}") for i, k in enumerate(keys)])
    kind = dict(df.dtypes)[at]
    start = F.lit("1970-01-01" if kind == "date" else "0").cast("long" if kind.startswith("timestamp") else kind)
    # at equal times an event comes before a row, or after it if only earlier ones count
    first, second = (1, 0) if strict else (0, 1)
    held = events.where(known([*keys, event_at])).select(
        key.alias("_key"), time(event_at).alias("_at"), F.lit(first).alias("_kind"), F.monotonically_increasing_id().alias("_row"), newest.alias("_event")
    )
    asked = df.select(
        F.when(placed, key).otherwise(nowhere).alias("_key"),
        F.when(placed, time(at)).otherwise(start).alias("_at"),
        F.lit(second).alias("_kind"),
        F.monotonically_increasing_id().alias("_row"),
        F.struct(*[F.col(c) for c in df.columns]).alias("_own"),
    )
    line = held.unionByName(asked, allowMissingColumns=True).select("_key", F.struct("_at", "_kind", "_row").alias("_order"), "_event", "_own")
    found = running_totals(line, ["_key"], "_order", {"_newest": ("max", "_event")}).where(F.col("_order._kind") == second)
    return found.select(*[F.col("_own").getField(c).alias(c) for c in df.columns], *[F.col(f"_newest.v{i}").alias(f"{prefix}{v}") for i, v in enumerate(values)])
