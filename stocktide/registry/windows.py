"""Window functions and feature groups over the product series."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import series as s
from ..operators.simple_ar import add_components
from ..sources.demand import raw_demand
from .base import register
from .ctes import FEATURES, LAG_NAMES, PRICE_NAMES, RAW, ROLL_NAMES, forecasts
from .projections import BODY, PROMO

KEY = ("product_id", "date")


def _features(name, add, columns, doubles=""):
    """A query that adds columns to the fact and returns the key with them."""
    names = columns.split()

    @register(name, FEATURES + BODY + f"SELECT product_id, date, {', '.join(names)} FROM featured", doubles)
    def run(spark, folder):
        return add(raw_demand(spark, folder)).select(*KEY, *names)


def _promo(df):
    return s.add_feature_promo(s.add_price_level(df))


_features("e1_row_lags", s.add_lags, " ".join(LAG_NAMES))
for _number, _stat in enumerate(("mean", "std", "min", "max"), start=2):
    _names = " ".join(f"rolling_{_stat}_{n}d" for n in (7, 14, 30))
    _features(
        f"e{_number}_rolling_{_stat}",
        lambda df, stat=_stat: s.add_rolling(df, statistics=[stat]),
        _names,
        _names if _stat in ("mean", "std") else "",
    )
_features("e6_rolling_cv", s.add_rolling_features, "demand_cv_30d", "demand_cv_30d")


@register("e7_preceding_mean", PROMO + BODY + "SELECT product_id, date, avg_price_30d, is_promo FROM promos", "avg_price_30d:4")
def preceding_mean(spark, folder):
    return s.add_report_promo(raw_demand(spark, folder)).select(*KEY, "avg_price_30d", "is_promo")


_features(
    "e8_percent_change",
    lambda df: s.add_demand_change(s.add_price_change(df)),
    "price_change_pct demand_change",
    "price_change_pct demand_change",
)
_features("e9_price_level", s.add_price_level, "price_vs_avg_30d", "price_vs_avg_30d")
_features("e10_promo_flag", _promo, "is_promo")
_features("e11_promo_count", lambda df: s.add_promo_count(_promo(df)), "promo_count")
_features("e12_days_since_promo", lambda df: s.add_days_since_promo(_promo(df)), "days_since_promo")
_features("e13_rolling_correlation", s.add_price_features, "price_demand_corr_30d", "price_demand_corr_30d:4")
_features("e14_year_over_year", s.add_year_over_year, "demand_yoy", "demand_yoy")
_features("e15_trend", lambda df: s.add_trend(s.add_rolling(df, [7, 30], ["mean"])), "trend_30d", "trend_30d")


@register(
    "e16_holdout_rows",
    RAW
    + BODY
    + """SELECT product_id, date, units_sold FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY date DESC) AS back
    FROM raw_demand) WHERE back <= 30""",
)
def holdout_rows(spark, folder):
    return s.add_holdout(raw_demand(spark, folder)).where("is_holdout").select(*KEY, "units_sold")


@register("e17_tiled_pattern", forecasts() + BODY + "SELECT product_id, step, pattern FROM parts")
def tiled_pattern(spark, folder):
    return add_components(raw_demand(spark, folder)).select("product_id", "step", "pattern")


@register("e18_last_year_slice", forecasts() + BODY + "SELECT product_id, step, season FROM parts", "season")
def last_year_slice(spark, folder):
    return add_components(raw_demand(spark, folder)).select("product_id", "step", "season")


@register(
    "e19_row_blocks",
    RAW
    + BODY
    + """SELECT product_id, block, min(date) AS first_date, count(*) AS n_rows FROM (
    SELECT product_id, date, CAST((row_number() OVER (PARTITION BY product_id ORDER BY date) - 1) // 30 AS INTEGER) AS block
    FROM raw_demand) GROUP BY 1, 2""",
)
def row_blocks(spark, folder):
    blocked = s.add_block(raw_demand(spark, folder))
    return blocked.groupBy("product_id", "block").agg(F.min("date").alias("first_date"), F.count("*").alias("n_rows"))


@register(
    "e20_prefix_split",
    RAW
    + BODY
    + """SELECT product_id, is_prefix, count(*) AS n_rows, max(date) AS last_date FROM (
    SELECT product_id, date, row_number() OVER (PARTITION BY product_id ORDER BY date)
      <= floor(count(*) OVER (PARTITION BY product_id) * 0.6::DOUBLE) AS is_prefix FROM raw_demand) GROUP BY 1, 2""",
)
def prefix_split(spark, folder):
    sided = s.add_prefix_side(raw_demand(spark, folder))
    return sided.groupBy("product_id", "is_prefix").agg(
        F.count("*").alias("n_rows"), F.max("date").alias("last_date")
    )


_features(
    "i2_price_features",
    s.add_price_features,
    " ".join(PRICE_NAMES),
    "price_change_pct price_vs_avg_30d demand_change price_demand_corr_30d:4",
)
_features(
    "i3_rolling_features",
    s.add_rolling_features,
    " ".join(ROLL_NAMES) + " demand_cv_30d",
    " ".join(c for c in ROLL_NAMES if "mean" in c or "std" in c) + " demand_cv_30d",
)
