"""Joins, set operations, sorts and top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import plus_months, since
from ..operators.calendar import add_peak_flag, calendar_features, peak_months
from ..operators.ensemble import add_previous_block_errors, align, best_weight, grid_scores, tuning_points
from ..operators.numbering import add_place
from ..operators.prep import feature_columns, rank_correlations, target_correlations
from ..operators.selection import keep_products, top_products
from ..operators.simple_ar import both_forecasts, recent_level, simple_ar
from ..plans.reports import demand_trends, inventory_positioning, risk_rank, risk_scores, weekly_demand
from ..session import materialize
from ..sources.demand import demand_calendar, raw_demand
from .base import AS_OF, MIN_YEAR, PEAKS, register
from .ctes import (
    AS_OF_SQL,
    CALENDAR,
    CALENDAR_NAMES,
    FEATURE_TABLE,
    LAG_NAMES,
    ONE_HOT,
    PEAK_ROWS,
    RAW,
    ROLL_NAMES,
    ensemble,
    forecasts,
)
from .projections import BODY, TRENDS, features_of

LONG_HORIZON = 120


def both_models(spark, folder, horizon: int = 30):
    """Forecast points of the simple AR and of the recent mean, written once, as tuning and combining both read them."""
    return materialize(both_forecasts(raw_demand(spark, folder), horizon), "points")


@register(
    "c1_composite_key_join",
    RAW.rstrip()
    + f""",
now AS (SELECT category, region, CAST(sum(units_sold) AS BIGINT) AS current_units FROM raw_demand
  WHERE date >= {AS_OF_SQL} - INTERVAL 12 MONTH GROUP BY 1, 2),
past AS (SELECT category, region, CAST(sum(units_sold) AS BIGINT) AS prior_units FROM raw_demand
  WHERE date >= {AS_OF_SQL} - INTERVAL 24 MONTH AND date < {AS_OF_SQL} - INTERVAL 12 MONTH GROUP BY 1, 2)
{BODY}SELECT now.category, now.region, current_units, prior_units FROM now JOIN past
  ON past.category = now.category AND past.region = now.region""",
)
def composite_key_join(spark, folder):
    demand = raw_demand(spark, folder)
    year_ago = plus_months(AS_OF, -12)
    now = since(demand, year_ago).groupBy("category", "region").agg(F.sum("units_sold").alias("current_units"))
    past = (
        since(demand, plus_months(AS_OF, -24), before=year_ago)
        .groupBy("category", "region")
        .agg(F.sum("units_sold").alias("prior_units"))
    )
    return now.join(past, ["category", "region"])


@register(
    "c2_forecast_alignment",
    forecasts()
    + BODY
    + """SELECT a.product_id, a.date, a.actual, a.predicted AS arima_forecast, p.level AS rf_forecast
    FROM simple_ar a JOIN parts p ON p.product_id = a.product_id AND p.date = a.date""",
    "arima_forecast rf_forecast",
)
def forecast_alignment(spark, folder):
    return both_models(spark, folder)


@register("c3_nearest_event", CALENDAR + BODY + "SELECT date, days_to_holiday FROM calendar")
def nearest_event(spark, folder):
    return calendar_features(demand_calendar(spark, folder)).select("date", "days_to_holiday")


PEAK_SQL = (
    RAW.rstrip()
    + f""",
peaks(category, peak_month) AS (VALUES {PEAK_ROWS}),
flagged AS (SELECT r.*, CASE WHEN p.peak_month IS NULL THEN 0 ELSE 1 END AS is_peak_season
  FROM raw_demand r LEFT JOIN peaks p ON p.category = r.category AND p.peak_month = r."month")
"""
)


@register(
    "c4_lookup_default",
    PEAK_SQL
    + BODY
    + """SELECT category, "month", max(is_peak_season) AS is_peak_season, CAST(sum(units_sold) AS BIGINT) AS units
    FROM flagged GROUP BY 1, 2""",
)
def lookup_default(spark, folder):
    flagged = add_peak_flag(raw_demand(spark, folder), peak_months(spark, PEAKS))
    return flagged.groupBy("category", "month").agg(
        F.max("is_peak_season").alias("is_peak_season"), F.sum("units_sold").alias("units")
    )


@register(
    "c5_semi_join",
    RAW
    + BODY
    + """SELECT product_id, "year", CAST(sum(units_sold) AS BIGINT) AS units FROM raw_demand WHERE product_id IN (
    SELECT product_id FROM raw_demand GROUP BY 1 ORDER BY sum(units_sold) DESC, 1 LIMIT 5) GROUP BY 1, 2""",
)
def semi_join(spark, folder):
    demand = raw_demand(spark, folder)
    kept = keep_products(demand, top_products(demand, 5))
    return kept.groupBy("product_id", "year").agg(F.sum("units_sold").alias("units"))


@register(
    "c6_previous_block",
    ensemble(LONG_HORIZON)
    + BODY
    + "SELECT product_id, date, block, prev_first_mae, prev_second_mae FROM weighed",
    "prev_first_mae prev_second_mae",
)
def previous_block(spark, folder):
    return add_previous_block_errors(both_models(spark, folder, LONG_HORIZON)).select(
        "product_id", "date", "block", "prev_first_mae", "prev_second_mae"
    )


@register("c7_weight_candidates", ensemble() + BODY + "SELECT weight_pct, score FROM grid_scores", "score")
def weight_candidates(spark, folder):
    return grid_scores(tuning_points(both_models(spark, folder)))


@register(
    "f1_multi_key_sort",
    RAW
    + BODY
    + f"""SELECT product_id, CAST(date_trunc('week', date) AS DATE) AS week_start, CAST(sum(units_sold) AS BIGINT) AS weekly_units
    FROM raw_demand WHERE "year" >= {MIN_YEAR} AND date >= {AS_OF_SQL} - 364 GROUP BY 1, 2 ORDER BY 1, 2""",
)
def multi_key_sort(spark, folder):
    return weekly_demand(raw_demand(spark, folder), AS_OF, MIN_YEAR).select("product_id", "week_start", "weekly_units")


@register(
    "f1_row_order",
    RAW
    + BODY
    + f"""SELECT row_number() OVER (ORDER BY product_id, week_start) - 1 AS place, * FROM (
    SELECT product_id, CAST(date_trunc('week', date) AS DATE) AS week_start FROM raw_demand
    WHERE "year" >= {MIN_YEAR} AND date >= {AS_OF_SQL} - 364 GROUP BY ALL)""",
)
def order_of_weeks(spark, folder):
    weeks = weekly_demand(raw_demand(spark, folder), AS_OF, MIN_YEAR)
    return add_place(weeks.select("product_id", "week_start"))


@register(
    "f2_row_order",
    RAW
    + BODY
    + f"""SELECT row_number() OVER (ORDER BY units DESC, product_id) - 1 AS place, product_id FROM (
    SELECT product_id, floor(30 * avg(CASE WHEN date >= {AS_OF_SQL} - 14 THEN units_sold END) + 0.5) AS units
    FROM raw_demand WHERE date >= {AS_OF_SQL} - 90 GROUP BY 1)""",
)
def order_of_forecasts(spark, folder):
    return add_place(inventory_positioning(raw_demand(spark, folder), AS_OF).select("product_id"))


@register(
    "f2_descending_sort",
    RAW
    + BODY
    + f"""SELECT product_id, floor(30 * avg(CASE WHEN date >= {AS_OF_SQL} - 14 THEN units_sold END) + 0.5) AS forecast_30d_units
    FROM raw_demand WHERE date >= {AS_OF_SQL} - 90 GROUP BY 1 ORDER BY 2 DESC, 1""",
    "forecast_30d_units:0",
)
def descending_sort(spark, folder):
    return inventory_positioning(raw_demand(spark, folder), AS_OF).select("product_id", "forecast_30d_units")


RANKED = """SELECT product_id, warehouse, stockout_risk_level, demand_acceleration FROM scored
  WHERE stockout_risk_level IN ('CRITICAL', 'HIGH')
  ORDER BY CASE stockout_risk_level WHEN 'CRITICAL' THEN 1 WHEN 'HIGH' THEN 2 ELSE 3 END,
  demand_acceleration DESC NULLS LAST, product_id, warehouse"""


def _ranked_risk(spark, folder):
    level = F.col("stockout_risk_level")
    return (
        risk_scores(demand_trends(raw_demand(spark, folder), AS_OF))
        .where(level.isin("CRITICAL", "HIGH"))
        .orderBy(risk_rank(level), F.desc_nulls_last("demand_acceleration"), "product_id", "warehouse")
        .select("product_id", "warehouse", "stockout_risk_level", "demand_acceleration")
    )


@register("f3_custom_rank_sort", TRENDS + BODY + RANKED, "demand_acceleration")
def custom_rank_sort(spark, folder):
    return _ranked_risk(spark, folder)


@register(
    "f3_row_order",
    TRENDS
    + BODY
    + """SELECT row_number() OVER (ORDER BY stockout_risk_level, demand_acceleration DESC NULLS LAST, product_id, warehouse) - 1 AS place,
    product_id, warehouse FROM scored WHERE stockout_risk_level IN ('CRITICAL', 'HIGH')""",
)
def order_of_risks(spark, folder):
    return add_place(_ranked_risk(spark, folder).select("product_id", "warehouse"))


@register("f4_sorted_limit", TRENDS + BODY + RANKED + " LIMIT 50", "demand_acceleration")
def sorted_limit(spark, folder):
    return _ranked_risk(spark, folder).limit(50)


@register(
    "f5_top_products",
    RAW
    + BODY
    + """SELECT product_id, CAST(sum(units_sold) AS BIGINT) AS total_units, avg(units_sold) AS mean_demand
    FROM raw_demand GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""",
    "mean_demand",
)
def most_sold(spark, folder):
    return top_products(raw_demand(spark, folder), 5)


# The numeric model inputs in whose correlation with the target the report ranks them;
# the encoded columns are left out.
RANKED_INPUTS = [
    "price",
    *LAG_NAMES,
    *ROLL_NAMES,
    "demand_cv_30d",
    "price_change_pct",
    "price_vs_avg_30d",
    "is_promo",
    "days_since_promo",
    "price_demand_corr_30d",
    "demand_yoy",
    "trend_30d",
    *CALENDAR_NAMES,
]
CORRELATIONS = (
    FEATURE_TABLE.rstrip()
    + ",\ncorrelations AS ("
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, abs(covar_samp("{c}", target) FILTER (WHERE "{c}" IS NOT NULL)
        / nullif(stddev_samp("{c}") * stddev_samp(target) FILTER (WHERE "{c}" IS NOT NULL), 0)) AS correlation FROM feature_table"""
        for c in RANKED_INPUTS
    )
    + ")\n"
)


def correlations(spark, folder):
    features = features_of(spark, folder)
    columns = [c for c in feature_columns(features) if c not in ONE_HOT]
    return target_correlations(features, columns)


@register(
    "f6_top_correlations",
    CORRELATIONS + BODY + "SELECT feature, correlation FROM correlations ORDER BY correlation DESC NULLS LAST, feature LIMIT 15",
    "correlation:5",
)
def top_correlations(spark, folder):
    return rank_correlations(correlations(spark, folder), 15)


@register("f8_arg_min", ensemble() + BODY + "SELECT weight_pct, score FROM grid_scores ORDER BY score, weight_pct LIMIT 1", "score")
def arg_min(spark, folder):
    return best_weight(grid_scores(tuning_points(both_models(spark, folder))))


@register(
    "g1_append_frames",
    RAW
    + BODY
    + """SELECT product_id, date, units_sold, 'sold' AS part FROM raw_demand WHERE units_sold > 0
    UNION ALL SELECT product_id, date, units_sold, 'idle' FROM raw_demand WHERE units_sold = 0""",
)
def append_frames(spark, folder):
    rows = raw_demand(spark, folder).select("product_id", "date", "units_sold")
    sold = rows.where(F.col("units_sold") > 0).withColumn("part", F.lit("sold"))
    idle = rows.where(F.col("units_sold") == 0).withColumn("part", F.lit("idle"))
    return sold.unionByName(idle)


@register(
    "g2_append_forecasts",
    forecasts()
    + BODY
    + """SELECT product_id, date, step, actual, predicted, 'SimpleAR' AS method FROM simple_ar
    UNION ALL SELECT product_id, date, step, actual, level, 'RecentLevel' FROM parts""",
    "predicted",
)
def append_forecasts(spark, folder):
    demand = raw_demand(spark, folder)
    return simple_ar(demand).unionByName(recent_level(demand))
