"""The five demand reports. Each takes the demand fact and an as-of day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import measures as m
from ..functions.dates import day, plus_days, plus_months, plus_weeks, since, week_start
from ..functions.numeric import ratio, round_half_up
from ..operators.series import add_report_promo


def weekly_demand(demand: DataFrame, as_of: str, min_year: int = 2022) -> DataFrame:
    """Daily rows of the last 52 weeks summed per product and week."""
    recent = since(demand.where(F.col("year") >= min_year), plus_weeks(as_of, -52))
    return (
        recent.groupBy("product_id", "category", "region", week_start(F.col("date")).alias("week_start"))
        .agg(
            F.sum("units_sold").alias("weekly_units"),
            F.avg("units_sold").alias("avg_daily_units"),
            F.stddev_samp("units_sold").alias("demand_volatility"),
            F.sum(F.col("units_sold") * F.col("price")).alias("weekly_revenue"),
            F.avg("price").alias("avg_price"),
            F.min("price").alias("min_price"),
            F.max("price").alias("max_price"),
            F.count_if(F.col("units_sold") == 0).alias("zero_demand_days"),
        )
        .orderBy("product_id", "week_start")
    )


def _segment_totals(demand: DataFrame) -> DataFrame:
    """Totals per category and region.

    Rows are first summed per product, which also counts the products: the
    second grouping then adds up one row per product.
    """
    products = demand.groupBy("category", "region", "product_id").agg(
        F.sum("units_sold").alias("units"),
        F.sum(F.col("units_sold") * F.col("price")).alias("revenue"),
        F.count("*").alias("days"),
    )
    return products.groupBy("category", "region").agg(
        F.sum("units").alias("units"),
        F.sum("revenue").alias("revenue"),
        F.count("*").alias("active_products"),
        ratio(F.sum("units"), F.sum("days")).alias("daily"),
    )


def year_over_year(demand: DataFrame, as_of: str) -> DataFrame:
    """This calendar year so far against months -24 to -12, per category and region."""
    year_ago = plus_months(as_of, -12)
    current = _segment_totals(since(demand, year_ago).where(F.col("year") == F.year(day(as_of))))
    prior = _segment_totals(since(demand, plus_months(as_of, -24), before=year_ago))
    c, p = current.alias("c"), prior.alias("p")
    return (
        c.join(p, ["category", "region"])
        .select(
            "category",
            "region",
            F.col("c.units").alias("current_units"),
            F.col("p.units").alias("prior_units"),
            round_half_up(m.growth_pct(F.col("c.units"), F.col("p.units")), 2).alias("yoy_unit_growth_pct"),
            F.col("c.revenue").alias("current_revenue"),
            F.col("p.revenue").alias("prior_revenue"),
            round_half_up(m.growth_pct(F.col("c.revenue"), F.col("p.revenue")), 2).alias("yoy_revenue_growth_pct"),
            F.col("c.active_products").alias("active_products"),
            round_half_up(F.col("c.daily"), 1).alias("current_avg_daily"),
        )
        .orderBy(F.desc_nulls_last("yoy_revenue_growth_pct"), "category", "region")
    )


def demand_trends(demand: DataFrame, as_of: str) -> DataFrame:
    """Last week, the week before and the 30-day mean and variation per product and warehouse."""
    date, units = F.col("date"), F.col("units_sold")
    last_week = date >= plus_days(as_of, -7)
    week_before = (date >= plus_days(as_of, -14)) & ~last_week
    return (
        since(demand, plus_days(as_of, -30))
        .groupBy("product_id", "category", "warehouse")
        .agg(
            F.sum(F.when(last_week, units).otherwise(0)).alias("demand_last_7d"),
            F.sum(F.when(week_before, units).otherwise(0)).alias("demand_prior_7d"),
            F.avg(units).alias("avg_daily_30d"),
            ratio(F.stddev_samp(units), F.avg(units)).alias("demand_cv"),
        )
    )


def risk_scores(trends: DataFrame) -> DataFrame:
    last, before = F.col("demand_last_7d"), F.col("demand_prior_7d")
    return trends.withColumns(
        {
            "demand_acceleration": m.acceleration(last, before),
            "estimated_days_of_supply": m.days_of_supply(F.col("avg_daily_30d"), last),
            "stockout_risk_level": m.risk_level(last, before, F.col("demand_cv")),
        }
    )


def risk_rank(level: Column) -> Column:
    return F.when(level == "CRITICAL", 1).when(level == "HIGH", 2).otherwise(3)


def stockout_risk(demand: DataFrame, as_of: str, n: int = 50) -> DataFrame:
    """The ``n`` product and warehouse pairs with the highest stock-out risk."""
    level = F.col("stockout_risk_level")
    return (
        risk_scores(demand_trends(demand, as_of))
        .where(level.isin("CRITICAL", "HIGH"))
        .orderBy(risk_rank(level), F.desc_nulls_last("demand_acceleration"), "product_id", "warehouse")
        .limit(n)
        .select(
            "product_id",
            "category",
            "warehouse",
            round_half_up(F.col("avg_daily_30d"), 1).alias("avg_daily_demand"),
            "demand_last_7d",
            "demand_prior_7d",
            round_half_up(F.col("demand_acceleration"), 2).alias("acceleration_ratio"),
            round_half_up(F.col("estimated_days_of_supply"), 1).alias("est_days_of_supply"),
            round_half_up(F.col("demand_cv"), 3).alias("demand_volatility"),
            "stockout_risk_level",
        )
    )


def demand_profile(demand: DataFrame, as_of: str) -> DataFrame:
    """Mean, spread, 95th percentile, peak and run-rate forecast over 90 days."""
    units = F.col("units_sold")
    recent_mean = F.avg(F.when(F.col("date") >= plus_days(as_of, -14), units))
    return (
        since(demand, plus_days(as_of, -90))
        .groupBy("product_id", "category", "warehouse", "region")
        .agg(
            F.avg(units).alias("daily"),
            F.stddev_samp(units).alias("std"),
            F.percentile_approx(units, 0.95).alias("p95_demand"),
            F.max(units).alias("peak_demand"),
            m.run_rate(recent_mean).alias("forecast"),
        )
    )


def inventory_positioning(demand: DataFrame, as_of: str) -> DataFrame:
    """Stocking recommendation per product and warehouse."""
    daily, std = F.col("daily"), F.col("std")
    return (
        demand_profile(demand, as_of)
        .select(
            "product_id",
            "category",
            "warehouse",
            "region",
            round_half_up(daily, 1).alias("avg_daily_demand"),
            round_half_up(std, 1).alias("demand_std"),
            round_half_up(F.col("forecast"), 0).alias("forecast_30d_units"),
            round_half_up(m.safety_stock(std), 0).alias("recommended_safety_stock"),
            round_half_up(m.reorder_point(daily, std), 0).alias("reorder_point"),
            round_half_up(m.economic_order_quantity(daily), 0).alias("economic_order_qty"),
            m.abc_tier(daily).alias("abc_tier"),
            m.stocking_strategy(daily, std).alias("stocking_strategy"),
        )
        .withColumn(
            "estimated_monthly_margin_impact",
            round_half_up(m.margin_impact(F.col("stocking_strategy"), F.col("forecast_30d_units")), 0),
        )
        .orderBy(F.desc_nulls_last("forecast_30d_units"), "product_id", "warehouse")
    )


def promo_rows(demand: DataFrame, min_year: int = 2022) -> DataFrame:
    """Fact rows with the report's promo flag; the mean price starts at ``min_year``."""
    recent = demand.where(F.col("year") >= min_year)
    return add_report_promo(recent.select("product_id", "category", "date", "units_sold", "price"))


def promo_lift(demand: DataFrame, min_year: int = 2022, min_promo_rows: int = 100) -> DataFrame:
    """Demand and price on promo days against other days, per category."""
    promo, base = F.col("is_promo") == 1, F.col("is_promo") == 0
    units, price = F.col("units_sold"), F.col("price")
    return (
        promo_rows(demand, min_year)
        .groupBy("category")
        .agg(
            F.count_if(promo).alias("promo_days"),
            F.count_if(base).alias("non_promo_days"),
            F.avg(F.when(promo, units)).alias("promo_units"),
            F.avg(F.when(base, units)).alias("base_units"),
            F.avg(F.when(promo, price)).alias("promo_price"),
            F.avg(F.when(base, price)).alias("regular_price"),
        )
        .where(F.col("promo_days") > min_promo_rows)
        .select(
            "category",
            "promo_days",
            "non_promo_days",
            round_half_up(F.col("promo_units"), 1).alias("avg_promo_demand"),
            round_half_up(F.col("base_units"), 1).alias("avg_base_demand"),
            round_half_up(m.promo_lift(F.col("promo_units"), F.col("base_units")), 2).alias("promotional_lift_ratio"),
            round_half_up(F.col("promo_price"), 2).alias("avg_promo_price"),
            round_half_up(F.col("regular_price"), 2).alias("avg_regular_price"),
            round_half_up(m.discount_depth(F.col("promo_price"), F.col("regular_price")), 3).alias(
                "avg_discount_depth"
            ),
        )
        .orderBy(F.desc_nulls_last("promotional_lift_ratio"), "category")
    )


def dataset_profile(demand: DataFrame) -> DataFrame:
    """One row: size, distinct keys, date range, mean units and revenue of the fact.

    Rows are summed per product first; the four distinct counts then run over
    one row per product and attribute set.
    """
    products = demand.groupBy("product_id", "category", "warehouse", "region").agg(
        F.count("*").alias("n"),
        F.min("date").alias("lo"),
        F.max("date").alias("hi"),
        F.sum("units_sold").alias("units"),
        F.sum("revenue").alias("money"),
    )
    return products.agg(
        F.sum("n").alias("total_records"),
        F.countDistinct("product_id").alias("unique_products"),
        F.min("lo").alias("first_date"),
        F.max("hi").alias("last_date"),
        F.countDistinct("category").alias("categories"),
        F.countDistinct("warehouse").alias("warehouses"),
        F.countDistinct("region").alias("regions"),
        ratio(F.sum("units"), F.sum("n")).alias("avg_daily_demand"),
        F.sum("money").alias("total_revenue"),
    )
