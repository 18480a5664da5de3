"""The five reports, the business measures inside them, and the alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import measures as m
from ..functions.numeric import round_half_up
from ..operators.alerts import degradation_alerts, spike_alerts, stockout_alerts
from ..operators.ensemble import ensemble_output
from ..plans import reports as r
from ..sources.demand import raw_demand
from .base import AS_OF, MIN_YEAR, register, rnd
from .ctes import AS_OF_SQL, RAW, ensemble
from .joins import both_models
from .projections import BODY, CHECK_STOCK, PROMO, TRENDS, positions
from .scans import WEEKLY_DOUBLES, WEEKLY_SQL

YEARS = (
    RAW.rstrip()
    + f""",
cur AS (SELECT category, region, CAST(sum(units_sold) AS BIGINT) AS units, sum(units_sold * price) AS revenue,
  count(DISTINCT product_id) AS products, avg(units_sold) AS daily FROM raw_demand
  WHERE "year" = year({AS_OF_SQL}) AND date >= {AS_OF_SQL} - INTERVAL 12 MONTH GROUP BY 1, 2),
pre AS (SELECT category, region, CAST(sum(units_sold) AS BIGINT) AS units, sum(units_sold * price) AS revenue
  FROM raw_demand WHERE date >= {AS_OF_SQL} - INTERVAL 24 MONTH AND date < {AS_OF_SQL} - INTERVAL 12 MONTH GROUP BY 1, 2),
years AS (SELECT cur.category, cur.region, cur.units AS current_units, pre.units AS prior_units,
  (cur.units - pre.units) / nullif(CAST(pre.units AS DOUBLE), 0) * 100 AS unit_growth,
  cur.revenue AS current_revenue, pre.revenue AS prior_revenue,
  (cur.revenue - pre.revenue) / nullif(pre.revenue, 0) * 100 AS revenue_growth, cur.products AS active_products, cur.daily
  FROM cur JOIN pre USING (category, region))
"""
)

POSITIONS = positions()

LIFTS = (
    PROMO.rstrip()
    + """,
lifts AS (
  SELECT category, count(*) FILTER (WHERE is_promo = 1) AS promo_days, count(*) FILTER (WHERE is_promo = 0) AS non_promo_days,
         avg(units_sold) FILTER (WHERE is_promo = 1) AS promo_units, avg(units_sold) FILTER (WHERE is_promo = 0) AS base_units,
         avg(price) FILTER (WHERE is_promo = 1) AS promo_price, avg(price) FILTER (WHERE is_promo = 0) AS regular_price
  FROM promos GROUP BY 1)
"""
)


@register("j1_weekly_demand", RAW + BODY + WEEKLY_SQL, WEEKLY_DOUBLES)
def weekly_demand(spark, folder):
    return r.weekly_demand(raw_demand(spark, folder), AS_OF, MIN_YEAR)


@register(
    "j2_year_over_year",
    YEARS
    + BODY
    + f"""SELECT category, region, current_units, prior_units, {rnd('unit_growth', 2)} AS yoy_unit_growth_pct, current_revenue,
    prior_revenue, {rnd('revenue_growth', 2)} AS yoy_revenue_growth_pct, active_products, {rnd('daily', 1)} AS current_avg_daily
    FROM years""",
    "current_revenue:2 prior_revenue:2",
)
def year_over_year(spark, folder):
    return r.year_over_year(raw_demand(spark, folder), AS_OF)


@register(
    "j3_stockout_risk",
    TRENDS
    + BODY
    + f"""SELECT product_id, category, warehouse, {rnd('avg_daily_30d', 1)} AS avg_daily_demand, demand_last_7d, demand_prior_7d,
    {rnd('demand_acceleration', 2)} AS acceleration_ratio, {rnd('estimated_days_of_supply', 1)} AS est_days_of_supply,
    {rnd('demand_cv', 3)} AS demand_volatility, stockout_risk_level FROM scored
    WHERE stockout_risk_level IN ('CRITICAL', 'HIGH')
    ORDER BY CASE stockout_risk_level WHEN 'CRITICAL' THEN 1 ELSE 2 END, demand_acceleration DESC NULLS LAST, product_id, warehouse
    LIMIT 50""",
)
def stockout_risk(spark, folder):
    return r.stockout_risk(raw_demand(spark, folder), AS_OF)


@register(
    "j4_inventory_positioning",
    POSITIONS
    + BODY
    + f"""SELECT product_id, category, warehouse, region, {rnd('daily', 1)} AS avg_daily_demand, {rnd('std', 1)} AS demand_std,
    {rnd('forecast', 0)} AS forecast_30d_units, {rnd('safety', 0)} AS recommended_safety_stock,
    {rnd('reorder', 0)} AS reorder_point, {rnd('eoq', 0)} AS economic_order_qty, abc_tier, stocking_strategy,
    {rnd('margin', 0)} AS estimated_monthly_margin_impact FROM costed""",
)
def inventory_positioning(spark, folder):
    return r.inventory_positioning(raw_demand(spark, folder), AS_OF)


@register(
    "j5_promo_lift",
    LIFTS
    + BODY
    + f"""SELECT category, promo_days, non_promo_days, {rnd('promo_units', 1)} AS avg_promo_demand,
    {rnd('base_units', 1)} AS avg_base_demand, {rnd('promo_units / nullif(base_units, 0)', 2)} AS promotional_lift_ratio,
    {rnd('promo_price', 2)} AS avg_promo_price, {rnd('regular_price', 2)} AS avg_regular_price,
    {rnd('1 - promo_price / nullif(regular_price, 0)', 3)} AS avg_discount_depth FROM lifts WHERE promo_days > 100""",
)
def promo_lift(spark, folder):
    return r.promo_lift(raw_demand(spark, folder), MIN_YEAR)


@register("j6_growth_pct", YEARS + BODY + "SELECT category, region, unit_growth, revenue_growth FROM years", "unit_growth revenue_growth")
def growth(spark, folder):
    rows = r.year_over_year(raw_demand(spark, folder), AS_OF)
    return rows.select(
        "category",
        "region",
        m.growth_pct(F.col("current_units"), F.col("prior_units")).alias("unit_growth"),
        m.growth_pct(F.col("current_revenue"), F.col("prior_revenue")).alias("revenue_growth"),
    )


def _trend_measure(name, column, measure, doubles=""):
    @register(name, TRENDS + BODY + f"SELECT product_id, warehouse, {column} FROM scored", doubles)
    def run(spark, folder):
        trends = r.demand_trends(raw_demand(spark, folder), AS_OF)
        return trends.select("product_id", "warehouse", measure().alias(column))


def _position_measure(name, column, measure, sql, doubles="", blocks=POSITIONS):
    @register(name, blocks + BODY + f"SELECT product_id, warehouse, {sql} AS {column} FROM costed", doubles)
    def run(spark, folder):
        profile = r.demand_profile(raw_demand(spark, folder), AS_OF)
        return profile.select("product_id", "warehouse", measure().alias(column))


def _margin():
    strategy = m.stocking_strategy(F.col("daily"), F.col("std"), CHECK_STOCK)
    return m.margin_impact(strategy, round_half_up(F.col("forecast"), 0), CHECK_STOCK)


# The next three use thresholds that part the given tables, as the defaults give one tier there.
_PARTED = positions(CHECK_STOCK)


_trend_measure(
    "j7_acceleration",
    "demand_acceleration",
    lambda: m.acceleration(F.col("demand_last_7d"), F.col("demand_prior_7d")),
    "demand_acceleration",
)
_trend_measure(
    "j8_days_of_supply",
    "estimated_days_of_supply",
    lambda: m.days_of_supply(F.col("avg_daily_30d"), F.col("demand_last_7d")),
    "estimated_days_of_supply",
)
_trend_measure(
    "j9_risk_level",
    "stockout_risk_level",
    lambda: m.risk_level(F.col("demand_last_7d"), F.col("demand_prior_7d"), F.col("demand_cv")),
)
_position_measure("j10_run_rate", "forecast", lambda: F.col("forecast"), "forecast", "forecast")
_position_measure("j11_safety_stock", "safety_stock", lambda: m.safety_stock(F.col("std")), "safety", "safety_stock")
_position_measure(
    "j12_reorder_point", "reorder_point", lambda: m.reorder_point(F.col("daily"), F.col("std")), "reorder", "reorder_point"
)
_position_measure(
    "j13_order_quantity", "order_quantity", lambda: m.economic_order_quantity(F.col("daily")), "eoq", "order_quantity"
)
_position_measure("j14_abc_tier", "tier", lambda: m.abc_tier(F.col("daily"), CHECK_STOCK), "abc_tier", blocks=_PARTED)
_position_measure(
    "j15_stocking_strategy",
    "strategy",
    lambda: m.stocking_strategy(F.col("daily"), F.col("std"), CHECK_STOCK),
    "stocking_strategy",
    blocks=_PARTED,
)
_position_measure("j16_margin_impact", "margin_impact", _margin, "margin", "margin_impact:2", _PARTED)


@register(
    "j17_promo_measures",
    LIFTS
    + BODY
    + """SELECT category, promo_units / nullif(base_units, 0) AS lift, 1 - promo_price / nullif(regular_price, 0) AS depth
    FROM lifts""",
    "lift depth",
)
def promo_measures(spark, folder):
    promo, base = F.col("is_promo") == 1, F.col("is_promo") == 0
    rows = r.promo_rows(raw_demand(spark, folder), MIN_YEAR)

    def mean(where, column):
        return F.avg(F.when(where, F.col(column)))

    return rows.groupBy("category").agg(
        m.promo_lift(mean(promo, "units_sold"), mean(base, "units_sold")).alias("lift"),
        m.discount_depth(mean(promo, "price"), mean(base, "price")).alias("depth"),
    )


@register(
    "i32_stockout_alerts",
    TRENDS
    + BODY
    + f"""SELECT 'stockout_' || lower(stockout_risk_level) AS alert, product_id AS subject, {AS_OF_SQL} AS date,
    CAST(demand_last_7d AS DOUBLE) AS value, CAST(demand_prior_7d AS DOUBLE) AS threshold
    FROM scored WHERE stockout_risk_level IN ('CRITICAL', 'HIGH')""",
)
def alerts_of_stockout(spark, folder):
    return stockout_alerts(r.risk_scores(r.demand_trends(raw_demand(spark, folder), AS_OF)), AS_OF)


@register(
    "i33_spike_alerts",
    RAW
    + BODY
    + """SELECT 'demand_spike' AS alert, product_id AS subject, date, CAST(units_sold AS DOUBLE) AS value, cap AS threshold FROM (
    SELECT product_id, date, units_sold, avg(units_sold) OVER b + 3 * stddev_samp(units_sold) OVER b AS cap FROM raw_demand
    WINDOW b AS (PARTITION BY product_id ORDER BY date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)) WHERE units_sold > cap""",
    "threshold",
)
def alerts_of_spikes(spark, folder):
    return spike_alerts(raw_demand(spark, folder))


@register(
    "i34_degradation_alerts",
    ensemble().rstrip()
    + f""",
checked AS (SELECT max(date) AS date, coalesce(avg(abs((actual - ensemble_forecast) / nullif(actual, 0))) * 100, 0.0) AS mape,
  count(DISTINCT product_id) AS covered FROM output)
{BODY}SELECT 'forecast_degradation' AS alert, 'mape' AS subject, date, mape AS value, 10.0::DOUBLE AS threshold FROM checked
  WHERE mape > 10
  UNION ALL SELECT 'low_coverage', 'products', date, CAST(covered AS DOUBLE), 200.0::DOUBLE FROM checked WHERE covered < 200""",
    "value",
)
def alerts_of_degradation(spark, folder):
    return degradation_alerts(ensemble_output(both_models(spark, folder)))
