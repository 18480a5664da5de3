"""Number functions that stay null where a value is undefined.

Spark 4 runs in ANSI mode, where a zero divisor raises; every division here
goes through a nulled divisor instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def zero_to_null(value: Column) -> Column:
    return F.when(value != 0, value)


def ratio(top: Column, bottom: Column) -> Column:
    """Double division; null when the divisor is zero or null."""
    return top.cast("double") / zero_to_null(bottom.cast("double"))


def pct_change(now: Column, before: Column) -> Column:
    return ratio(now, before) - 1


def round_half_up(value: Column, digits: int) -> Column:
    """Round half away from zero with plain IEEE steps on doubles."""
    scale = float(10**digits)
    number = value.cast("double")
    return F.signum(number) * F.floor(F.abs(number) * scale + 0.5) / scale + F.lit(0.0)


def round_half_even(value: Column, digits: int) -> Column:
    """Scale, round to the nearest even whole number, scale back."""
    scale = float(10**digits)
    return F.rint(value.cast("double") * scale) / scale


def finite_or_zero(value: Column) -> Column:
    """Null, NaN and both infinities become 0; Spark orders NaN above infinity."""
    number = value.cast("double")
    return F.when(F.abs(number) < F.lit(float("inf")), number).otherwise(0.0)


def floor_at_zero(value: Column) -> Column:
    """Negative numbers become 0; null stays null."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(0.0)))


def positive_or_one(value: Column) -> Column:
    return F.when(value > 0, value).otherwise(1)


def flag(condition: Column) -> Column:
    """0/1 integer; null counts as 0."""
    return F.when(condition, 1).otherwise(0)
