"""Combining two forecasts: alignment, weights, adaptive fallback, impact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import floor_at_zero, flag, positive_or_one
from ..settings import DEFAULTS, EnsembleSettings, StockSettings
from .scores import mape_or_zero, rmse
from .series import add_block, add_prefix_side

ENSEMBLE = DEFAULTS.ensemble
FIRST, SECOND = "arima_forecast", "rf_forecast"


def align(first: DataFrame, second: DataFrame) -> DataFrame:
    """Forecast points that both models made, matched by product and date."""
    a = first.select("product_id", "date", "actual", F.col("predicted").alias(FIRST))
    b = second.select("product_id", "date", F.col("predicted").alias(SECOND))
    return a.join(b, ["product_id", "date"])


def weighted(first_pct: Column | int) -> Column:
    """Weighted sum; the weight of the first model is given in whole percent."""
    pct = first_pct if isinstance(first_pct, Column) else F.lit(first_pct)
    w = pct / F.lit(100.0)
    return w * F.col(FIRST) + (1 - w) * F.col(SECOND)


def grid_scores(points: DataFrame, metric: str = "mape", s: EnsembleSettings = ENSEMBLE) -> DataFrame:
    """One row per candidate weight: ``weight_pct`` and ``score``.

    Every candidate is one aggregate of the same pass, so points are not
    multiplied by the number of candidates.
    """
    score = {"mape": mape_or_zero, "rmse": rmse}[metric]
    tried = [
        F.struct(F.lit(pct).alias("weight_pct"), score(F.col("actual"), weighted(pct)).alias("score"))
        for pct in s.grid
    ]
    return points.agg(F.array(*tried).alias("tried")).select(F.inline("tried"))


def best_weight(scores: DataFrame) -> DataFrame:
    """The lowest score; equal scores keep the smallest first weight."""
    return scores.orderBy("score", "weight_pct").limit(1)


def tuning_points(points: DataFrame, s: EnsembleSettings = ENSEMBLE) -> DataFrame:
    """The first share of each product's points, which the weights are tuned on."""
    return add_prefix_side(points, s.tuning_share).where("is_prefix").drop("is_prefix")


def add_previous_block_errors(points: DataFrame, s: EnsembleSettings = ENSEMBLE) -> DataFrame:
    """MAE of both models over the product's previous block; null in the first block.

    A range frame over the block number reaches exactly the previous block, so
    the block verdicts need no aggregation and no join back.
    """
    blocked = add_block(points, s.block_rows)
    before = Window.partitionBy("product_id").orderBy("block").rangeBetween(-1, -1)
    return blocked.withColumns(
        {
            "prev_first_mae": F.avg(F.abs(F.col("actual") - F.col(FIRST))).over(before),
            "prev_second_mae": F.avg(F.abs(F.col("actual") - F.col(SECOND))).over(before),
        }
    )


def block_errors(points: DataFrame, s: EnsembleSettings = ENSEMBLE) -> DataFrame:
    """MAE of both models per product and block."""
    return (
        add_block(points, s.block_rows)
        .groupBy("product_id", "block")
        .agg(
            F.avg(F.abs(F.col("actual") - F.col(FIRST))).alias("first_mae"),
            F.avg(F.abs(F.col("actual") - F.col(SECOND))).alias("second_mae"),
        )
    )


def add_adaptive_weight(points: DataFrame, tuned_pct: Column | int, s: EnsembleSettings = ENSEMBLE) -> DataFrame:
    """``weight_pct`` per row: the tuned weight unless one model failed in the block before."""
    tuned = tuned_pct if isinstance(tuned_pct, Column) else F.lit(tuned_pct)
    first, second = F.col("prev_first_mae"), F.col("prev_second_mae")
    return add_previous_block_errors(points, s).withColumn(
        "weight_pct",
        F.when(first > s.mae_multiple * second, s.min_pct)
        .when(second > s.mae_multiple * first, s.max_pct)
        .otherwise(tuned),
    )


def add_ensemble(points: DataFrame, weight_pct: Column | int) -> DataFrame:
    return points.withColumn("ensemble_forecast", floor_at_zero(weighted(weight_pct)))


def add_error_pct(points: DataFrame) -> DataFrame:
    error = F.abs(F.col("actual") - F.col("ensemble_forecast"))
    return points.withColumn("ensemble_error_pct", error / positive_or_one(F.col("actual")) * 100)


def ensemble_output(points: DataFrame, metric: str = "mape", s: EnsembleSettings = ENSEMBLE) -> DataFrame:
    """Tune on each product's first points, then combine all of them adaptively."""
    tuned = best_weight(grid_scores(tuning_points(points, s), metric, s)).select("weight_pct").scalar()
    weighed = add_adaptive_weight(points, tuned, s)
    return add_error_pct(add_ensemble(weighed, F.col("weight_pct"))).select(
        "product_id", "date", "actual", FIRST, SECOND, "ensemble_forecast", "ensemble_error_pct"
    )


def business_impact(
    points: DataFrame, predicted: str = "ensemble_forecast", s: StockSettings = DEFAULTS.stock
) -> DataFrame:
    """One row: stock-out share, daily excess cost and yearly margin of the forecast."""
    actual, forecast = F.col("actual"), F.col(predicted)
    short = F.avg(flag(forecast < actual * s.understock_share))
    revenue = F.avg(actual * s.unit_price)
    return points.agg(
        F.lit(s.safety_stock_cut * 100).alias("safety_stock_reduction_pct"),
        F.lit(s.margin_gain_pct).alias("gross_margin_improvement_pct"),
        (short * 100).alias("stockout_risk_pct"),
        (F.avg(F.abs(actual - forecast)) * s.unit_price * s.holding_rate).alias("daily_excess_inventory_cost"),
        (revenue * s.safety_stock_cut * s.margin_rate * 365).alias("annualized_margin_impact"),
    )
