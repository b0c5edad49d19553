"""Binning, ratios, rounding and scaling expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Serving bins (age in years, city population) and their ordinal labels.
AGE_BOUNDS = (0.0, 25.0, 45.0, 65.0, float("inf"))
AGE_CODES = (1, 0, 2, 3)
AGE_NAMES = ("under 25", "25-45", "45-65", "65+")
CITY_BOUNDS = (0.0, 88735.0, 1577385.0, float("inf"))
CITY_CODES = (0, 1, 2)


def bin_right_closed(value, bounds: Sequence[float], labels: Sequence) -> Column:
    """Label of the interval ``(bounds[i], bounds[i+1]]`` holding the value, else null."""
    if len(bounds) != len(labels) + 1:
        raise ValueError("bin_right_closed needs one more bound than labels")
    value = F.col(value) if isinstance(value, str) else value
    out = None
    for low, high, label in zip(bounds, bounds[1:], labels):
        inside = value > F.lit(low)
        if high != float("inf"):
            inside = inside & (value <= F.lit(high))
        out = F.when(inside, label) if out is None else out.when(inside, label)
    return out


def ratio(numerator, denominator) -> Column:
    """Quotient as a double. Over 0 it is infinite, as in floating point; 0 over 0 is null."""
    as_double = lambda c: (F.col(c) if isinstance(c, str) else c).cast("double")
    top, bottom = as_double(numerator), as_double(denominator)
    return F.when(bottom != 0, top / bottom).when((bottom == 0) & (top != 0), F.signum(top) * float("inf"))


def log_scale(value) -> Column:
    return F.log1p(F.col(value).cast("double") if isinstance(value, str) else value.cast("double"))


def round_half_even(value, digits: int = 0) -> Column:
    return F.bround(value, digits)


def to_class(score, threshold: float = 0.5) -> Column:
    """1 where the score exceeds the threshold, else 0."""
    score = F.col(score) if isinstance(score, str) else score
    return (score > F.lit(threshold)).cast("int")


def positive_weight(label, weight: float) -> Column:
    """Row weight that counts positives ``weight`` times."""
    return F.when(F.col(label) == 1, F.lit(float(weight))).otherwise(F.lit(1.0))


def cents(amount) -> Column:
    """Money as whole cents, so that sums and differences are exact."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    return F.round(amount * 100).cast("bigint")


def clean_identifier(value) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.trim(value.cast("string"))
