"""Scalar functions, over the days of the fact, the fact or the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as d
from ..functions.numeric import flag, round_half_even, round_half_up, zero_to_null
from ..operators.calendar import calendar_features
from ..operators.simple_ar import add_components
from ..sources.demand import demand_calendar, raw_demand
from ..sources.tables import read_table
from .base import AS_OF, register
from .ctes import AS_OF_SQL, CALENDAR, RAW, forecasts
from .projections import BODY


def _of_days(name, select, sql):
    """A query over the one-row-per-day calendar."""

    @register(name, RAW + BODY + f"SELECT date, {sql} FROM days")
    def run(spark, folder):
        return demand_calendar(spark, folder).select("date", *select(F.col("date")))


_of_days(
    "h1_week_start",
    lambda c: [d.week_start(c).alias("week_start")],
    "CAST(date_trunc('week', date) AS DATE) AS week_start",
)
_of_days(
    "h2_date_add",
    lambda c: [
        d.plus_weeks(c, -52).alias("weeks"),
        d.plus_months(c, -12).alias("year_ago"),
        d.plus_months(c, 1).alias("next_month"),
        d.plus_days(c, -30).alias("days"),
    ],
    """date - 364 AS weeks, CAST(date - INTERVAL 12 MONTH AS DATE) AS year_ago,
    CAST(date + INTERVAL 1 MONTH AS DATE) AS next_month, date - 30 AS days""",
)
_of_days(
    "h3_as_of_day",
    lambda c: [F.datediff(d.day(AS_OF), c).alias("age"), flag(c == d.day(AS_OF)).alias("is_as_of")],
    f"CAST(date_diff('day', date, {AS_OF_SQL}) AS INTEGER) AS age, CASE WHEN date = {AS_OF_SQL} THEN 1 ELSE 0 END AS is_as_of",
)
_of_days(
    "h4_date_parts",
    lambda c: [
        F.year(c).alias("year"),
        F.month(c).alias("month"),
        F.dayofmonth(c).alias("day"),
        F.quarter(c).alias("quarter"),
    ],
    """CAST(year(date) AS INTEGER) AS "year", CAST(month(date) AS INTEGER) AS "month",
    CAST(day(date) AS INTEGER) AS "day", CAST(quarter(date) AS INTEGER) AS quarter""",
)
_of_days(
    "h5_weekday",
    lambda c: [d.weekday_from_monday(c).alias("day_of_week")],
    "CAST((dayofweek(date) + 6) % 7 AS INTEGER) AS day_of_week",
)
_of_days("h6_iso_week", lambda c: [d.iso_week(c).alias("week")], "CAST(strftime(date, '%V') AS INTEGER) AS week")
_of_days(
    "h7_weekend",
    lambda c: [flag(d.is_weekend(c)).alias("is_weekend")],
    "CASE WHEN dayname(date) IN ('Saturday', 'Sunday') THEN 1 ELSE 0 END AS is_weekend",
)
_of_days(
    "h8_month_edges",
    lambda c: [flag(d.is_month_start(c)).alias("is_month_start"), flag(d.is_month_end(c)).alias("is_month_end")],
    """CASE WHEN date = date_trunc('month', date) THEN 1 ELSE 0 END AS is_month_start,
    CASE WHEN date = last_day(date) THEN 1 ELSE 0 END AS is_month_end""",
)


@register("h9_holiday_distance", CALENDAR + BODY + "SELECT date, days_to_holiday, is_holiday_week FROM calendar")
def holiday_distance(spark, folder):
    return calendar_features(demand_calendar(spark, folder)).select("date", "days_to_holiday", "is_holiday_week")


_of_days(
    "h10_date_range",
    lambda c: [
        flag(d.within_days(c, F.make_date(F.year(c), F.lit(11), F.lit(25)), 3)).alias("in_november_peak"),
        flag(c.between(F.make_date(F.year(c), F.lit(12), F.lit(20)), F.make_date(F.year(c), F.lit(12), F.lit(26)))).alias(
            "in_christmas_week"
        ),
        F.to_date(F.date_format(c, "yyyy-MM-dd")).alias("parsed"),
    ],
    """CASE WHEN month(date) = 11 AND day(date) BETWEEN 25 AND 28 THEN 1 ELSE 0 END AS in_november_peak,
    CASE WHEN month(date) = 12 AND day(date) BETWEEN 20 AND 26 THEN 1 ELSE 0 END AS in_christmas_week,
    CAST(strftime(date, '%Y-%m-%d') AS DATE) AS parsed""",
)


@register(
    "h11_round",
    RAW
    + BODY
    + """SELECT product_id, date, floor(price + 0.5) AS r0, floor(price * 10 + 0.5) / 10 AS r1,
    floor(price * 100 + 0.5) / 100 AS r2, floor(price * 1000 + 0.5) / 1000 AS r3 FROM raw_demand""",
)
def rounding(spark, folder):
    price = F.col("price")
    return raw_demand(spark, folder).select(
        "product_id", "date", *[round_half_up(price, n).alias(f"r{n}") for n in range(4)]
    )


@register(
    "h12_round_half_even",
    RAW + BODY + "SELECT product_id, date, round_even(price * 100, 0) / 100 AS price_2 FROM raw_demand",
    "price_2:4",
)
def rounding_to_even(spark, folder):
    return raw_demand(spark, folder).select("product_id", "date", round_half_even(F.col("price"), 2).alias("price_2"))


@register(
    "h13_arithmetic",
    RAW
    + BODY
    + """SELECT product_id, date, sqrt(units_sold) AS root, units_sold * units_sold * 1.0::DOUBLE AS square,
    abs(price - 1000) AS distance FROM raw_demand""",
    "root distance",
)
def arithmetic(spark, folder):
    return raw_demand(spark, folder).select(
        "product_id",
        "date",
        F.sqrt("units_sold").alias("root"),
        F.pow("units_sold", F.lit(2)).alias("square"),
        F.abs(F.col("price") - 1000).alias("distance"),
    )


@register("h14_cast", RAW + BODY + "SELECT product_id, date, CAST(units_sold AS DOUBLE) AS units FROM raw_demand")
def cast(spark, folder):
    return raw_demand(spark, folder).select("product_id", "date", F.col("units_sold").cast("double").alias("units"))


@register("h15_nullif", RAW + BODY + "SELECT product_id, date, nullif(units_sold, 0) AS units FROM raw_demand")
def nullif(spark, folder):
    return raw_demand(spark, folder).select("product_id", "date", zero_to_null(F.col("units_sold")).alias("units"))


@register("h16_padded_id", "SELECT p_partkey, printf('PROD-%04d', p_partkey + 1) AS product_id FROM part")
def padded_id(spark, folder):
    return read_table(spark, folder, "part").select(
        "p_partkey", F.format_string("PROD-%04d", F.col("p_partkey") + 1).alias("product_id")
    )


@register(
    "h17_repeated_rows",
    forecasts() + BODY + "SELECT product_id, date, step, pattern, level, growth FROM parts",
    "level growth",
)
def repeated_rows(spark, folder):
    return add_components(raw_demand(spark, folder)).select("product_id", "date", "step", "pattern", "level", "growth")


@register(
    "h18_modulo_attributes",
    "SELECT p_partkey, r_name AS region, 'WH-' || r_name AS warehouse FROM part JOIN region ON r_regionkey = p_partkey % 5",
)
def modulo_attributes(spark, folder):
    regions = read_table(spark, folder, "region").select("r_regionkey", F.col("r_name").alias("region"))
    parts = read_table(spark, folder, "part").select("p_partkey")
    joined = parts.join(regions, F.pmod("p_partkey", F.lit(5)) == F.col("r_regionkey"))
    return joined.select("p_partkey", "region", F.concat(F.lit("WH-"), "region").alias("warehouse"))
