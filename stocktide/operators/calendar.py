"""Calendar features: computed once per day, not once per fact row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dates
from ..functions.numeric import flag
from ..settings import HOLIDAY_WEEK_DAYS, SEASONAL_PEAKS

CALENDAR_FEATURES = (
    "day_of_week",
    "day_of_month",
    "month",
    "quarter",
    "week_of_year",
    "is_weekend",
    "is_month_start",
    "is_month_end",
    "days_to_holiday",
    "is_holiday_week",
)


def _nth_weekday(year: Column, month: int, weekday: str, nth: int) -> Column:
    before = F.date_sub(F.make_date(year, F.lit(month), F.lit(1)), 1)
    return F.date_add(F.next_day(before, weekday), 7 * (nth - 1))


def _last_monday_of_may(year: Column) -> Column:
    return F.next_day(F.make_date(year, F.lit(5), F.lit(24)), "Mon")


def us_holidays(year: Column) -> Column:
    """Array of the eight holidays of a year: three fixed days and five weekday rules."""
    fixed = [F.make_date(year, F.lit(m), F.lit(d)) for m, d in ((1, 1), (7, 4), (12, 25))]
    return F.array(
        *fixed,
        _nth_weekday(year, 1, "Mon", 3),
        _nth_weekday(year, 2, "Mon", 3),
        _last_monday_of_may(year),
        _nth_weekday(year, 9, "Mon", 1),
        _nth_weekday(year, 11, "Thu", 4),
    )


def holidays_of(calendar: DataFrame) -> DataFrame:
    """The holidays of every year that occurs in the calendar."""
    years = calendar.select(F.year("date").alias("year")).distinct()
    return years.select(F.explode(us_holidays(F.col("year"))).alias("holiday"))


#: Days that are searched in one window.
EVENT_SPAN = 1024


def add_days_to_nearest(days: DataFrame, events: DataFrame, event: str = "holiday", name: str = "days_to_holiday") -> DataFrame:
    """``name``: the smallest number of days between ``date`` and any event, however many there are.

    Days and events lie in one order, cut into spans of ``EVENT_SPAN`` days. The
    last event before a day and the first after it come from a window over its
    span, and where the span has none, from the spans before and after, of which
    one row each is looked at. Null dates and tables without an event give null.
    """
    span = lambda c: F.floor(F.unix_date(c) / EVENT_SPAN)
    known = events.select(F.col(event).cast("date").alias("__event")).where("__event is not null").distinct().withColumn("__span", span("__event"))
    ends = known.groupBy("__span").agg(F.min("__event").alias("__first"), F.max("__event").alias("__last"))
    spans = ends.select("__span").union(days.select(span("date"))).distinct().join(ends, "__span", "left")
    order = Window.orderBy("__span")
    around = spans.select(
        "__span",
        F.max("__last").over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("__before"),
        F.min("__first").over(order.rowsBetween(1, Window.unboundedFollowing)).alias("__after"),
    )
    asked = days.select("date").distinct().where("date is not null").select("date", F.lit(None).cast("date").alias("__event"), span("date").alias("__span"))
    line = asked.union(known.select("__event", "__event", "__span"))
    ahead = Window.partitionBy("__span").orderBy("date").rangeBetween(Window.currentRow, Window.unboundedFollowing)
    behind = Window.partitionBy("__span").orderBy("date").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    found = line.withColumns({"__last": F.max("__event").over(behind), "__next": F.min("__event").over(ahead)}).where("__event is null")
    gap = F.least(
        F.datediff("date", F.coalesce("__last", "__before")),
        F.datediff(F.coalesce("__next", "__after"), "date"),
    )
    nearest = found.join(around, "__span").select("date", gap.alias(name))
    return days.join(nearest, "date", "left")


def calendar_features(calendar: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """The ten calendar features for a one-row-per-day table.

    The list of holidays may be of any length.
    """
    if holidays is None:
        holidays = holidays_of(calendar)
    date = F.col("date")
    return (
        add_days_to_nearest(calendar.select("date"), holidays)
        .withColumns(
            {
                "day_of_week": dates.weekday_from_monday(date),
                "day_of_month": F.dayofmonth(date),
                "month": F.month(date),
                "quarter": F.quarter(date),
                "week_of_year": dates.iso_week(date),
                "is_weekend": flag(dates.is_weekend(date)),
                "is_month_start": flag(dates.is_month_start(date)),
                "is_month_end": flag(dates.is_month_end(date)),
            }
        )
        .withColumn("is_holiday_week", flag(F.col("days_to_holiday") <= HOLIDAY_WEEK_DAYS))
    )


def calendar_of(df: DataFrame) -> DataFrame:
    """The distinct days of a fact table."""
    return df.select("date").distinct()


def add_calendar_features(
    df: DataFrame, calendar: DataFrame | None = None, holidays: DataFrame | None = None
) -> DataFrame:
    """Calendar features joined by day.

    Pass ``calendar`` when the days are known, which saves a pass over the fact.
    It has one row per day; Spark compares its size with the broadcast threshold.
    """
    features = calendar_features(calendar if calendar is not None else calendar_of(df), holidays)
    replaced = [c for c in CALENDAR_FEATURES if c in df.columns]
    return df.drop(*replaced).join(features, "date", "left")


def peak_months(spark: SparkSession, peaks: Mapping[str, Sequence[int]] = SEASONAL_PEAKS) -> DataFrame:
    """One row per category and peak month, from a literal mapping."""
    rows = [(category, month) for category, months in peaks.items() for month in months]
    return spark.createDataFrame(rows, "category string, month int")


def add_peak_flag(df: DataFrame, peaks: DataFrame) -> DataFrame:
    """1 in a peak month of the row's category; categories without peaks get 0.

    Twelve months per category bound the lookup; Spark compares its size with
    the broadcast threshold.
    """
    lookup = peaks.select("category", F.col("month").alias("peak_month"), F.lit(1).alias("_peak")).distinct()
    matched = df.join(
        lookup,
        (df["category"] == lookup["category"]) & (F.month(df["date"]) == lookup["peak_month"]),
        "left",
    ).drop(lookup["category"], lookup["peak_month"])
    return matched.withColumn("is_peak_season", F.coalesce(F.col("_peak"), F.lit(0))).drop("_peak")
