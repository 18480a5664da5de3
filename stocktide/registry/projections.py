"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import measures as m
from ..functions.dates import is_weekend, plus_days, since
from ..functions.numeric import (
    finite_or_zero,
    flag,
    floor_at_zero,
    pct_change,
    positive_or_one,
    ratio,
    round_half_up,
    zero_to_null,
)
from ..operators.prep import CALENDAR_GROUP, add_target, drop_short_history, feature_columns, feature_groups
from ..operators.scores import mape
from ..operators.selection import first_products, keep_products
from ..operators.series import add_lags, add_price_change, add_rolling, by_product
from ..operators.simple_ar import simple_ar
from ..plans.features import feature_table
from ..plans.reports import demand_trends, demand_profile, promo_rows, risk_scores
from ..settings import DEFAULTS, NON_FEATURE_COLUMNS, StockSettings
from ..sources.demand import add_partition_keys, add_revenue, demand_calendar, demand_levels, raw_demand
from .base import AS_OF, MIN_YEAR, register, rnd
from .ctes import (
    AS_OF_SQL,
    FEATURE_TABLE,
    LAG_NAMES,
    ONE_HOT,
    RAW,
    ROLL_NAMES,
    forecasts,
)

BODY = "--body\n"

# Two sums per product are joined to the monthly figures, and the level is looked
# up as the first row of a table whose conditions hold.
# The levels' thresholds and the formula for days of supply.
TRENDS = (
    RAW.rstrip()
    + f""",
aged AS (SELECT *, date_diff('day', date, {AS_OF_SQL}) AS age FROM raw_demand WHERE date_diff('day', date, {AS_OF_SQL}) <= 30),
monthly AS (SELECT product_id, any_value(category) AS category, any_value(warehouse) AS warehouse, avg(units_sold) AS avg_daily_30d,
  sqrt(var_samp(units_sold)) / nullif(avg(units_sold), 0) AS demand_cv FROM aged GROUP BY product_id),
by_week AS (SELECT product_id, age <= 7 AS newest, CAST(sum(units_sold) AS BIGINT) AS units FROM aged WHERE age <= 14 GROUP BY ALL),
trends AS (SELECT m.*, coalesce(n.units, 0) AS demand_last_7d, coalesce(o.units, 0) AS demand_prior_7d FROM monthly m
  LEFT JOIN by_week n ON n.product_id = m.product_id AND n.newest
  LEFT JOIN by_week o ON o.product_id = m.product_id AND NOT o.newest),
risk_levels(place, level, over_ratio, over_cv) AS (
  VALUES (1, 'CRITICAL', 1.5::DOUBLE, NULL), (2, 'HIGH', 1.2::DOUBLE, NULL), (3, 'MEDIUM', NULL, 0.5::DOUBLE), (4, 'LOW', NULL, NULL)),
scored AS (SELECT t.product_id, t.category, t.warehouse, t.demand_last_7d, t.demand_prior_7d, t.avg_daily_30d, t.demand_cv,
  t.demand_last_7d / nullif(CAST(t.demand_prior_7d AS DOUBLE), 0) AS demand_acceleration,
  14.0::DOUBLE * t.avg_daily_30d / nullif(t.demand_last_7d / 7.0::DOUBLE, 0) AS estimated_days_of_supply,
  arg_min(l.level, l.place) AS stockout_risk_level
  FROM trends t JOIN risk_levels l ON (l.over_ratio IS NULL OR t.demand_last_7d > t.demand_prior_7d * l.over_ratio)
    AND (l.over_cv IS NULL OR t.demand_cv > l.over_cv) GROUP BY ALL)
"""
)
TREND_DOUBLES = "avg_daily_30d demand_cv"
SCORED_DOUBLES = TREND_DOUBLES + " demand_acceleration estimated_days_of_supply"

PROMO = (
    RAW.rstrip()
    + f""",
before AS (
  SELECT product_id, category, date, units_sold, price,
         avg(price) OVER (PARTITION BY product_id ORDER BY date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS avg_price_30d
  FROM raw_demand WHERE "year" >= {MIN_YEAR}),
promos AS (SELECT *, CASE WHEN price < 0.9::DOUBLE * avg_price_30d THEN 1 ELSE 0 END AS is_promo FROM before)
"""
)


def demand(spark, folder):
    return raw_demand(spark, folder)


def features_of(spark, folder):
    """The feature table; days and one-hot values come from the small given tables."""
    return feature_table(demand(spark, folder), demand_calendar(spark, folder), demand_levels(spark, folder))


@register(
    "b1_projection",
    RAW
    + BODY
    + "SELECT product_id, date AS sales_date, units_sold AS units, units_sold * price AS line_revenue FROM raw_demand",
    "line_revenue:4",
)
def projection(spark, folder):
    return demand(spark, folder).select(
        "product_id",
        F.col("date").alias("sales_date"),
        F.col("units_sold").alias("units"),
        (F.col("units_sold") * F.col("price")).alias("line_revenue"),
    )


@register("b2_star_plus", TRENDS + BODY + "SELECT * FROM scored", SCORED_DOUBLES)
def star_plus(spark, folder):
    return risk_scores(demand_trends(demand(spark, folder), AS_OF))


@register("b3_revenue", RAW + BODY + "SELECT product_id, date, units_sold * price AS revenue FROM raw_demand", "revenue:4")
def revenue(spark, folder):
    base = demand(spark, folder).select("product_id", "date", "units_sold", "price")
    return add_revenue(base).select("product_id", "date", "revenue")


@register(
    "b4_partition_keys",
    RAW
    + BODY
    + """SELECT product_id, date, CAST(extract(year FROM date) AS INTEGER) AS "year",
    CAST(extract(month FROM date) AS INTEGER) AS "month", CAST(extract(week FROM date) AS INTEGER) AS week FROM raw_demand""",
)
def partition_keys(spark, folder):
    return add_partition_keys(demand(spark, folder).select("product_id", "date"))


@register("b5_target", RAW + BODY + "SELECT product_id, date, units_sold, units_sold AS target FROM raw_demand")
def target(spark, folder):
    return add_target(demand(spark, folder).select("product_id", "date", "units_sold"))


@register(
    "b6_asof_range",
    RAW
    + BODY
    + f"""SELECT product_id, date, units_sold FROM raw_demand
    WHERE date >= {AS_OF_SQL} - 90 AND date < {AS_OF_SQL} - 30""",
)
def asof_range(spark, folder):
    picked = since(demand(spark, folder), plus_days(AS_OF, -90), before=plus_days(AS_OF, -30))
    return picked.select("product_id", "date", "units_sold")


@register(
    "b7_partition_predicate",
    RAW + BODY + f"""SELECT product_id, date, units_sold FROM raw_demand WHERE "year" = year({AS_OF_SQL})""",
)
def partition_predicate(spark, folder):
    this_year = F.col("year") == F.year(F.to_date(F.lit(AS_OF)))
    return demand(spark, folder).where(this_year).select("product_id", "date", "units_sold")


@register(
    "b8_membership",
    TRENDS + BODY + "SELECT product_id, warehouse, stockout_risk_level FROM scored WHERE stockout_risk_level IN ('CRITICAL', 'HIGH')",
)
def membership(spark, folder):
    scored = risk_scores(demand_trends(demand(spark, folder), AS_OF))
    urgent = F.col("stockout_risk_level").isin("CRITICAL", "HIGH")
    return scored.where(urgent).select("product_id", "warehouse", "stockout_risk_level")


@register(
    "b9_one_series",
    RAW + BODY + "SELECT date, units_sold, price FROM raw_demand WHERE product_id = 'Brand#7/PROMO'",
    "price",
)
def one_series(spark, folder):
    return demand(spark, folder).where(F.col("product_id") == "Brand#7/PROMO").select("date", "units_sold", "price")


@register(
    "b10_nonzero_actuals",
    forecasts()
    + BODY
    + """SELECT product_id, count(*) AS n_used, avg(abs((actual - predicted) / actual)) * 100 AS mape
    FROM simple_ar WHERE actual <> 0 GROUP BY 1""",
    "mape",
)
def nonzero_actuals(spark, folder):
    used = simple_ar(demand(spark, folder)).where(F.col("actual") != 0)
    return used.groupBy("product_id").agg(F.count("*").alias("n_used"), mape("actual", "predicted").alias("mape"))


@register(
    "b11_drop_nulls",
    RAW
    + BODY
    + """SELECT * FROM (SELECT product_id, date, lag(units_sold, 90) OVER (PARTITION BY product_id ORDER BY date) AS demand_lag_90d
    FROM raw_demand) WHERE demand_lag_90d IS NOT NULL""",
)
def drop_nulls(spark, folder):
    lagged = add_lags(demand(spark, folder), [90]).select("product_id", "date", "demand_lag_90d")
    return drop_short_history(lagged)


@register(
    "b12_fill_zero",
    RAW
    + BODY
    + """SELECT product_id, date, coalesce(price / lag(price) OVER (PARTITION BY product_id ORDER BY date) - 1, 0) AS price_change_pct
    FROM raw_demand""",
    "price_change_pct",
)
def fill_zero(spark, folder):
    return add_price_change(demand(spark, folder)).select("product_id", "date", "price_change_pct")


@register(
    "b13_finite_or_zero",
    RAW
    + BODY
    + """SELECT product_id, date, CASE WHEN units_sold = 0 THEN 0 ELSE 1.0::DOUBLE / units_sold END AS inverse,
    CASE WHEN units_sold > 5 THEN 0 ELSE sqrt(5.0::DOUBLE - units_sold) END AS root,
    coalesce(units_sold / nullif(lag(units_sold) OVER (PARTITION BY product_id ORDER BY date), 0) - 1, 0) AS change
    FROM raw_demand""",
    "inverse root change",
)
def finite(spark, folder):
    units = F.col("units_sold")
    return demand(spark, folder).select(
        "product_id",
        "date",
        finite_or_zero(F.pow(units.cast("double"), -1.0)).alias("inverse"),
        finite_or_zero(F.sqrt(5.0 - units)).alias("root"),
        finite_or_zero(pct_change(units, F.lag("units_sold", 1).over(by_product()))).alias("change"),
    )


@register(
    "b14_zero_to_null",
    RAW + BODY + "SELECT product_id, date, nullif(units_sold, 0) AS units, price / nullif(units_sold, 0) AS per_unit FROM raw_demand",
    "per_unit",
)
def null_divisor(spark, folder):
    return demand(spark, folder).select(
        "product_id",
        "date",
        zero_to_null(F.col("units_sold")).alias("units"),
        ratio(F.col("price"), F.col("units_sold")).alias("per_unit"),
    )


@register("b15_searched_case", TRENDS + BODY + "SELECT product_id, warehouse, stockout_risk_level FROM scored")
def searched_case(spark, folder):
    return risk_scores(demand_trends(demand(spark, folder), AS_OF)).select(
        "product_id", "warehouse", "stockout_risk_level"
    )


# Margin lift by strategy, and the tier that a strategy serves.
STRATEGY_ROWS = "('A', 'FORWARD-STOCK', 0.15::DOUBLE), ('B', 'REGIONAL-HUB', 0.12::DOUBLE), ('C', 'CENTRAL-CONSOLIDATE', 0.08::DOUBLE)"


def positions(s: StockSettings = DEFAULTS.stock) -> str:
    """CTE ``costed``: tiers and strategies are rows that are joined by threshold.

    Fixed values: the formulas for safety stock, reorder point and order quantity.
    """
    return (
        RAW.rstrip()
        + f""",
quarter AS (SELECT product_id, any_value(category) AS category, any_value(warehouse) AS warehouse, any_value(region) AS region,
  avg(units_sold) AS daily, sqrt(var_samp(units_sold)) AS std, max(units_sold) AS peak_demand
  FROM raw_demand WHERE date_diff('day', date, {AS_OF_SQL}) <= 90 GROUP BY product_id),
fortnight AS (SELECT product_id, avg(units_sold) * 30 AS forecast FROM raw_demand
  WHERE date_diff('day', date, {AS_OF_SQL}) <= 14 GROUP BY product_id),
tiers(tier, least) AS (VALUES ('A', {s.tier_a_mean}::DOUBLE), ('B', {s.tier_b_mean}::DOUBLE), ('C', -1.0::DOUBLE)),
strategies(tier, strategy, lift) AS (VALUES {STRATEGY_ROWS}),
tiered AS (SELECT q.product_id, arg_max(t.tier, t.least) AS abc_tier FROM quarter q JOIN tiers t ON q.daily >= t.least GROUP BY 1),
costed AS (
  SELECT q.*, f.forecast, t.abc_tier, 1.65::DOUBLE * q.std * sqrt(7.0::DOUBLE) AS safety,
         q.daily * 7 + 1.65::DOUBLE * q.std * sqrt(7.0::DOUBLE) AS reorder,
         CASE WHEN q.daily <> 0 THEN sqrt(2 * q.daily * 365 * 25 / (0.02::DOUBLE * q.daily * 45)) END AS eoq,
         coalesce(s.strategy, 'MAKE-TO-ORDER') AS stocking_strategy,
         coalesce({rnd('f.forecast', 0)} * 45 * s.lift, 0.0::DOUBLE) AS margin
  FROM quarter q JOIN tiered t USING (product_id) LEFT JOIN fortnight f USING (product_id)
  LEFT JOIN strategies s ON s.tier = t.abc_tier AND NOT coalesce(q.std / nullif(q.daily, 0) > {s.make_to_order_cv}::DOUBLE, false))
"""
    )


# Thresholds that part the given tables into all tiers and strategies.
CHECK_STOCK = StockSettings(tier_a_mean=5.0, tier_b_mean=3.0, make_to_order_cv=3.0)


@register(
    "b16_simple_case",
    positions(CHECK_STOCK) + BODY + "SELECT product_id, stocking_strategy, margin AS estimated_monthly_margin_impact FROM costed",
    "estimated_monthly_margin_impact:2",
)
def simple_case(spark, folder):
    profile = demand_profile(demand(spark, folder), AS_OF)
    strategy = m.stocking_strategy(F.col("daily"), F.col("std"), CHECK_STOCK)
    margin = m.margin_impact(F.col("stocking_strategy"), round_half_up(F.col("forecast"), 0), CHECK_STOCK)
    return profile.withColumn("stocking_strategy", strategy).select(
        "product_id", "stocking_strategy", margin.alias("estimated_monthly_margin_impact")
    )


@register(
    "b17_chained_steps",
    PROMO + BODY + "SELECT product_id, count(*) AS days, CAST(sum(is_promo) AS BIGINT) AS promo_days FROM promos GROUP BY 1",
)
def chained_steps(spark, folder):
    rows = promo_rows(demand(spark, folder), MIN_YEAR)
    return rows.groupBy("product_id").agg(F.count("*").alias("days"), F.sum("is_promo").alias("promo_days"))


@register(
    "b18_drop_columns",
    RAW + BODY + """SELECT price, category, warehouse, region, "month" FROM raw_demand""",
    "price",
)
def drop_columns(spark, folder):
    return demand(spark, folder).drop(*NON_FEATURE_COLUMNS)


@register(
    "b19_columns_by_type",
    RAW
    + BODY
    + """SELECT category, CAST(sum(units_sold) AS DOUBLE) AS units_sold, sum(price) AS price, sum(revenue) AS revenue,
    CAST(sum("year") AS DOUBLE) AS "year", CAST(sum("month") AS DOUBLE) AS "month", CAST(sum(week) AS DOUBLE) AS week
    FROM raw_demand GROUP BY 1""",
    "price:2 revenue:2",
)
def columns_by_type(spark, folder):
    df = demand(spark, folder)
    numeric = feature_columns(df, excluded=())
    return df.groupBy("category").agg(*[F.sum(c).cast("double").alias(c) for c in numeric])


_GROUPS = {
    "lag": LAG_NAMES,
    "rolling": ROLL_NAMES,
    "calendar": CALENDAR_GROUP,
    "price": ["price", "price_change_pct", "price_vs_avg_30d", "price_demand_corr_30d", "is_promo", "days_since_promo"],
    "trend": ["demand_yoy", "trend_30d"],
    "one_hot": list(ONE_HOT),
}


@register(
    "b20_feature_groups",
    FEATURE_TABLE
    + BODY
    + " UNION ALL ".join(
        f"SELECT '{group}' AS feature_group, {len(names)} AS n_columns, "
        f"CAST({' + '.join(f'count({chr(34)}{n}{chr(34)})' for n in names)} AS BIGINT) AS n_values FROM feature_table"
        for group, names in _GROUPS.items()
    ),
)
def count_feature_groups(spark, folder):
    df = features_of(spark, folder)
    columns = feature_columns(df)
    entries = []
    for group in feature_groups(columns):
        members = [c for c in columns if feature_groups([c])[group]]
        filled = sum((F.count(c) for c in members[1:]), F.count(members[0]))
        entries.append(
            F.struct(
                F.lit(group).alias("feature_group"),
                F.lit(len(members)).alias("n_columns"),
                filled.alias("n_values"),
            )
        )
    return df.agg(F.array(*entries).alias("groups")).select(F.inline("groups"))


@register(
    "b21_first_products",
    RAW
    + BODY
    + """SELECT product_id, count(*) AS n_rows, CAST(sum(units_sold) AS BIGINT) AS units FROM raw_demand
    WHERE product_id IN (SELECT DISTINCT product_id FROM raw_demand ORDER BY 1 LIMIT 20) GROUP BY 1""",
)
def sample_products(spark, folder):
    df = demand(spark, folder)
    kept = keep_products(df, first_products(df, 20))
    return kept.groupBy("product_id").agg(F.count("*").alias("n_rows"), F.sum("units_sold").alias("units"))


@register(
    "b22_floor_at_zero",
    RAW
    + BODY
    + """SELECT product_id, date, CASE WHEN gap < 0 THEN 0.0 ELSE gap END AS excess FROM (
    SELECT product_id, date, units_sold - avg(units_sold) OVER (PARTITION BY product_id ORDER BY date
      ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS gap FROM raw_demand)""",
    "excess",
)
def floored(spark, folder):
    rolled = add_rolling(demand(spark, folder), [30], ["mean"])
    return rolled.select(
        "product_id", "date", floor_at_zero(F.col("units_sold") - F.col("rolling_mean_30d")).alias("excess")
    )


@register(
    "b23_positive_or_one",
    RAW + BODY + "SELECT product_id, date, CASE WHEN units_sold > 0 THEN units_sold ELSE 1 END AS divisor FROM raw_demand",
)
def nonzero_divisor(spark, folder):
    return demand(spark, folder).select("product_id", "date", positive_or_one(F.col("units_sold")).alias("divisor"))


@register(
    "b24_flags",
    RAW
    + BODY
    + """SELECT product_id, date, CASE WHEN units_sold = 0 THEN 1 ELSE 0 END AS is_idle,
    CASE WHEN isodow(date) > 5 THEN 1 ELSE 0 END AS is_weekend FROM raw_demand""",
)
def flags(spark, folder):
    return demand(spark, folder).select(
        "product_id",
        "date",
        flag(F.col("units_sold") == 0).alias("is_idle"),
        flag(is_weekend(F.col("date"))).alias("is_weekend"),
    )
