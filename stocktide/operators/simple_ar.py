"""Forecast from three components: weekly pattern, last year, recent mean.

The held-out rows look back with row lags. Counting training rows from the
newest (age 1), step h repeats the row of age 7 - (h - 1) % 7, which lies
7 * ceil(h / 7) rows before the step's own row; last year's row lies 365 rows
before it. So one window over the product does everything and nothing is joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import floor_at_zero
from ..settings import YEAR_LAG
from .series import add_position, by_product

# Component weights and lengths.
PATTERN_WEIGHT, SEASON_WEIGHT, LEVEL_WEIGHT = 0.4, 0.35, 0.25
PATTERN_ROWS, LEVEL_ROWS = 7, 30


def _mean_of_ages(age: Column, first: int, last: int) -> Column:
    whole = Window.partitionBy("product_id")
    return F.avg(F.when(age.between(first, last), F.col("units_sold"))).over(whole)


def _short_pattern(age: Column, n_train: Column, step: Column) -> Column:
    """The training rows of a series with fewer than ``PATTERN_ROWS`` of them, over and over."""
    row = F.struct((-age).alias("place"), F.col("units_sold").alias("units"))
    held = F.collect_list(F.when((n_train < PATTERN_ROWS) & (age >= 1), row)).over(Window.partitionBy("product_id"))
    at = F.when(n_train > 0, F.pmod(step - 1, n_train) + 1)
    return F.get(F.sort_array(held), (at - 1).cast("int"))["units"]


def add_components(series: DataFrame, horizon: int = 30) -> DataFrame:
    """Held-out rows with ``step``, ``actual`` and the three components.

    ``growth`` relates the newest 30 training rows to the 30 rows ending 365
    rows earlier; rows before the series start are left out of that mean. With
    365 training rows or fewer the flat mean stands in for last year. Fewer than
    seven training rows repeat as they are; without any there is no forecast.
    """
    placed = add_position(series.select("product_id", "date", "units_sold"))
    reach = horizon + YEAR_LAG + LEVEL_ROWS
    recent = placed.where(F.col("nth") > F.col("n_rows") - reach)
    n_train = F.col("n_rows") - horizon
    age = n_train - F.col("nth") + 1
    step = F.col("nth") - n_train

    pattern = F.when(n_train < PATTERN_ROWS, _short_pattern(age, n_train, step))
    for back in range(PATTERN_ROWS, horizon + PATTERN_ROWS, PATTERN_ROWS):
        pattern = pattern.when(step <= back, F.lag("units_sold", back).over(by_product()))

    looked_up = recent.withColumns(
        {
            "n_train": n_train,
            "step": step.cast("int"),
            "pattern": pattern,
            "year_ago": F.lag("units_sold", YEAR_LAG).over(by_product()),
            "level": _mean_of_ages(age, 1, LEVEL_ROWS),
            "year_ago_level": _mean_of_ages(age, YEAR_LAG + 1, YEAR_LAG + LEVEL_ROWS),
        }
    ).where(F.col("step") >= 1)
    growth = F.when(F.col("year_ago_level") > 0, F.col("level") / F.col("year_ago_level")).otherwise(1.0)
    has_year = F.col("n_train") > YEAR_LAG
    return (
        looked_up.withColumn("growth", F.when(has_year, growth))
        .withColumn("season", F.when(has_year, F.col("year_ago") * F.col("growth")).otherwise(F.col("level")))
        .select(
            "product_id",
            "date",
            "step",
            F.col("units_sold").alias("actual"),
            "pattern",
            "season",
            "level",
            "growth",
        )
    )


def simple_ar(series: DataFrame, horizon: int = 30) -> DataFrame:
    """Forecast of the last ``horizon`` rows of every product, never negative."""
    mix = (
        PATTERN_WEIGHT * F.col("pattern") + SEASON_WEIGHT * F.col("season") + LEVEL_WEIGHT * F.col("level")
    )
    return add_components(series, horizon).select(
        "product_id",
        "date",
        "step",
        "actual",
        floor_at_zero(mix).alias("predicted"),
        F.lit("SimpleAR").alias("method"),
    )


def both_forecasts(series: DataFrame, horizon: int = 30, first: str = "arima_forecast", second: str = "rf_forecast") -> DataFrame:
    """The simple forecast and the recent mean side by side, from one pass over the series."""
    mix = (
        PATTERN_WEIGHT * F.col("pattern") + SEASON_WEIGHT * F.col("season") + LEVEL_WEIGHT * F.col("level")
    )
    return add_components(series, horizon).select(
        "product_id", "date", "actual", floor_at_zero(mix).alias(first), F.col("level").alias(second)
    )


def recent_level(series: DataFrame, horizon: int = 30) -> DataFrame:
    """Forecast by the mean of the newest 30 training rows: ``rolling_mean_30d`` of the last one."""
    return add_components(series, horizon).select(
        "product_id",
        "date",
        "step",
        "actual",
        F.col("level").alias("predicted"),
        F.lit("RecentLevel").alias("method"),
    )
