"""Business measures as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..settings import DEFAULTS, StockSettings
from .numeric import ratio, zero_to_null

STOCK = DEFAULTS.stock

# Margin lift by stocking strategy.
MARGIN_LIFT = {
    "FORWARD-STOCK": 0.15,
    "REGIONAL-HUB": 0.12,
    "CENTRAL-CONSOLIDATE": 0.08,
}


def growth_pct(current: Column, prior: Column) -> Column:
    return (current.cast("double") - prior) / zero_to_null(prior.cast("double")) * 100


def acceleration(last_week: Column, week_before: Column) -> Column:
    return ratio(last_week, week_before)


def days_of_supply(daily_mean: Column, last_week: Column, s: StockSettings = STOCK) -> Column:
    """Days a stock of ``supply_days`` average days lasts at last week's rate."""
    return F.lit(s.supply_days) * daily_mean / zero_to_null(last_week.cast("double") / 7.0)


def risk_level(last_week: Column, week_before: Column, cv: Column, s: StockSettings = STOCK) -> Column:
    before = week_before.cast("double")
    return (
        F.when(last_week > before * s.critical_ratio, "CRITICAL")
        .when(last_week > before * s.high_ratio, "HIGH")
        .when(cv > s.medium_cv, "MEDIUM")
        .otherwise("LOW")
    )


def run_rate(recent_daily_mean: Column, days: int = 30) -> Column:
    return recent_daily_mean * days


def safety_stock(std: Column, s: StockSettings = STOCK) -> Column:
    return F.lit(s.service_z) * std * F.sqrt(F.lit(float(s.lead_days)))


def reorder_point(daily_mean: Column, std: Column, s: StockSettings = STOCK) -> Column:
    return daily_mean * s.lead_days + safety_stock(std, s)


def economic_order_quantity(daily_mean: Column, s: StockSettings = STOCK) -> Column:
    """Null where there is no demand."""
    yearly_cost = F.lit(2.0) * daily_mean * 365 * s.order_cost
    return F.sqrt(yearly_cost / zero_to_null(F.lit(s.holding_rate) * daily_mean * s.unit_price))


def abc_tier(daily_mean: Column, s: StockSettings = STOCK) -> Column:
    return F.when(daily_mean >= s.tier_a_mean, "A").when(daily_mean >= s.tier_b_mean, "B").otherwise("C")


def stocking_strategy(daily_mean: Column, std: Column, s: StockSettings = STOCK) -> Column:
    return (
        F.when(ratio(std, daily_mean) > s.make_to_order_cv, "MAKE-TO-ORDER")
        .when(daily_mean >= s.tier_a_mean, "FORWARD-STOCK")
        .when(daily_mean >= s.tier_b_mean, "REGIONAL-HUB")
        .otherwise("CENTRAL-CONSOLIDATE")
    )


def margin_impact(strategy: Column, forecast_units: Column, s: StockSettings = STOCK) -> Column:
    value = None
    for name, lift in MARGIN_LIFT.items():
        branch = forecast_units * s.unit_price * lift
        value = F.when(strategy == name, branch) if value is None else value.when(strategy == name, branch)
    return value.otherwise(0.0)


def promo_lift(promo_units: Column, base_units: Column) -> Column:
    return ratio(promo_units, base_units)


def discount_depth(promo_price: Column, regular_price: Column) -> Column:
    return F.lit(1.0) - ratio(promo_price, regular_price)
