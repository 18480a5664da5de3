"""Alert rows: (alert, subject, date, value, threshold)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import day
from ..settings import DEFAULTS, DemandSettings
from .scores import mape_or_zero
from .series import trailing


def _alerts(df: DataFrame, alert: Column, subject: Column, date: Column, value: Column, threshold: Column) -> DataFrame:
    return df.select(
        alert.alias("alert"),
        subject.alias("subject"),
        date.alias("date"),
        value.cast("double").alias("value"),
        threshold.cast("double").alias("threshold"),
    )


def stockout_alerts(risk: DataFrame, as_of: str) -> DataFrame:
    """One alert per scored product and warehouse at high risk: last week's units against the week before."""
    level = F.lower("stockout_risk_level")
    return _alerts(
        risk.where(F.col("stockout_risk_level").isin("CRITICAL", "HIGH")),
        F.concat(F.lit("stockout_"), level),
        F.col("product_id"),
        day(as_of),
        F.col("demand_last_7d"),
        F.col("demand_prior_7d"),
    )


def spike_alerts(demand: DataFrame, rows: int = 30, deviations: float = 3.0) -> DataFrame:
    """Days with more units than the mean plus three deviations of the rows before."""
    before = trailing(rows, exclude_current=True)
    limit = F.avg("units_sold").over(before) + deviations * F.stddev_samp("units_sold").over(before)
    spikes = demand.select("product_id", "date", "units_sold", limit.alias("limit")).where(
        F.col("units_sold") > F.col("limit")
    )
    return _alerts(
        spikes, F.lit("demand_spike"), F.col("product_id"), F.col("date"), F.col("units_sold"), F.col("limit")
    )


def degradation_alerts(points: DataFrame, predicted: str = "ensemble_forecast", s: DemandSettings = DEFAULTS) -> DataFrame:
    """At most two rows: MAPE above its target, and too few products covered."""
    checked = points.agg(
        F.max("date").alias("date"),
        mape_or_zero("actual", predicted).alias("mape"),
        F.countDistinct("product_id").alias("covered"),
    )
    rules = F.array(
        F.struct(
            F.lit("forecast_degradation").alias("alert"),
            F.lit("mape").alias("subject"),
            F.col("mape").alias("value"),
            F.lit(s.target_mape).alias("threshold"),
            (F.col("mape") > s.target_mape).alias("raised"),
        ),
        F.struct(
            F.lit("low_coverage").alias("alert"),
            F.lit("products").alias("subject"),
            F.col("covered").cast("double").alias("value"),
            F.lit(float(s.target_coverage)).alias("threshold"),
            (F.col("covered") < s.target_coverage).alias("raised"),
        ),
    )
    return (
        checked.select("date", F.inline(rules))
        .where("raised")
        .select("alert", "subject", "date", "value", "threshold")
    )
