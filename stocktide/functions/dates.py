"""Date functions and the as-of range filter."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def day(value: Column | dt.date | str) -> Column:
    """A date column from a column, a ``date`` or an ISO string."""
    if isinstance(value, Column):
        return value
    return F.to_date(F.lit(str(value)))


def plus_days(value: Column | dt.date | str, n: int) -> Column:
    return F.date_add(day(value), n)


def plus_weeks(value: Column | dt.date | str, n: int) -> Column:
    return F.date_add(day(value), 7 * n)


def plus_months(value: Column | dt.date | str, n: int) -> Column:
    """Calendar months; a day that does not exist becomes the month's last day."""
    return F.add_months(day(value), n)


def week_start(value: Column) -> Column:
    """The Monday of the week, as a date."""
    return F.trunc(value, "week")


def iso_week(value: Column) -> Column:
    return F.weekofyear(value)


def weekday_from_monday(value: Column) -> Column:
    return F.weekday(value)


def is_weekend(value: Column) -> Column:
    return F.weekday(value) >= 5


def is_month_start(value: Column) -> Column:
    return F.dayofmonth(value) == 1


def is_month_end(value: Column) -> Column:
    return value == F.last_day(value)


def within_days(value: Column, start: Column, days: int) -> Column:
    """Inclusive range test: ``start`` to ``start + days``."""
    return value.between(start, F.date_add(start, days))


def since(
    df: DataFrame,
    lower: Column,
    before: Column | None = None,
    date: str = "date",
    year: str = "year",
) -> DataFrame:
    """Rows with ``lower <= date < before``.

    When the table has its ``year`` partition column, the range is repeated on
    it, because a predicate on ``date`` alone cannot prune partitions.
    """
    keep = F.col(date) >= lower
    if year in df.columns:
        keep = keep & (F.col(year) >= F.year(lower))
    if before is not None:
        keep = keep & (F.col(date) < before)
        if year in df.columns:
            keep = keep & (F.col(year) <= F.year(before))
    return df.where(keep)
