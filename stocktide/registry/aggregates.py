"""Aggregations, score measures and dataset summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import ratio
from ..operators.ensemble import block_errors
from ..operators.prep import add_split_side, split_summary
from ..operators.quantile import date_quantile
from ..operators.scores import mae, mape, mape_or_zero, median_ape, product_results, product_scores, r2, rmse, score_summary
from ..operators.selection import product_volumes
from ..operators.series import add_lags
from ..operators.prep import drop_short_history, rank_correlations
from ..operators.simple_ar import simple_ar
from ..plans.reports import dataset_profile, promo_rows
from ..sources.demand import raw_demand
from .base import MIN_YEAR, register
from .ctes import RAW, ensemble, forecasts
from .joins import CORRELATIONS, LONG_HORIZON, both_models, correlations
from .projections import BODY, PROMO


@register(
    "d1_grouped_aggregates",
    RAW
    + BODY
    + """SELECT category, region, "year", CAST(sum(units_sold) AS BIGINT) AS units, avg(units_sold) AS mean_units,
    min(price) AS min_price, max(price) AS max_price FROM raw_demand GROUP BY 1, 2, 3""",
    "mean_units min_price max_price",
)
def grouped_aggregates(spark, folder):
    return (
        raw_demand(spark, folder)
        .groupBy("category", "region", "year")
        .agg(
            F.sum("units_sold").alias("units"),
            F.avg("units_sold").alias("mean_units"),
            F.min("price").alias("min_price"),
            F.max("price").alias("max_price"),
        )
    )


@register("d2_sample_std", RAW + BODY + "SELECT product_id, stddev_samp(units_sold) AS std FROM raw_demand GROUP BY 1", "std")
def sample_std(spark, folder):
    return raw_demand(spark, folder).groupBy("product_id").agg(F.stddev_samp("units_sold").alias("std"))


@register(
    "d3_conditional_count",
    RAW + BODY + """SELECT product_id, "year", count(*) FILTER (WHERE units_sold = 0) AS idle_days FROM raw_demand GROUP BY 1, 2""",
)
def conditional_count(spark, folder):
    return (
        raw_demand(spark, folder)
        .groupBy("product_id", "year")
        .agg(F.count_if(F.col("units_sold") == 0).alias("idle_days"))
    )


@register(
    "d4_conditional_sum",
    RAW
    + BODY
    + """SELECT product_id, CAST(sum(CASE WHEN isodow(date) > 5 THEN units_sold ELSE 0 END) AS BIGINT) AS weekend_units
    FROM raw_demand GROUP BY 1""",
)
def conditional_sum(spark, folder):
    weekend = F.when(F.weekday("date") >= 5, F.col("units_sold")).otherwise(0)
    return raw_demand(spark, folder).groupBy("product_id").agg(F.sum(weekend).alias("weekend_units"))


@register(
    "d5_conditional_average",
    RAW
    + BODY
    + """SELECT product_id, avg(units_sold) FILTER (WHERE units_sold > 0) AS mean_sold,
    stddev_samp(units_sold) FILTER (WHERE units_sold > 0) AS std_sold FROM raw_demand GROUP BY 1""",
    "mean_sold std_sold",
)
def conditional_average(spark, folder):
    sold = F.when(F.col("units_sold") > 0, F.col("units_sold"))
    return (
        raw_demand(spark, folder)
        .groupBy("product_id")
        .agg(F.avg(sold).alias("mean_sold"), F.stddev_samp(sold).alias("std_sold"))
    )


@register(
    "d6_count_distinct",
    RAW
    + BODY
    + """SELECT category, "year", count(DISTINCT product_id) AS products FROM raw_demand WHERE units_sold > 0 GROUP BY 1, 2""",
)
def count_distinct(spark, folder):
    sold = raw_demand(spark, folder).where(F.col("units_sold") > 0)
    return sold.groupBy("category", "year").agg(F.countDistinct("product_id").alias("products"))


@register(
    "d7_approx_percentile",
    RAW + BODY + """SELECT product_id, "year", quantile_disc(units_sold, 0.95) AS p95 FROM raw_demand GROUP BY 1, 2""",
)
def approx_percentile(spark, folder):
    return (
        raw_demand(spark, folder)
        .groupBy("product_id", "year")
        .agg(F.percentile_approx("units_sold", 0.95).alias("p95"))
    )


@register(
    "d8_ratio_of_aggregates",
    RAW + BODY + """SELECT product_id, "year", stddev_samp(units_sold) / nullif(avg(units_sold), 0) AS cv FROM raw_demand GROUP BY 1, 2""",
    "cv",
)
def ratio_of_aggregates(spark, folder):
    return (
        raw_demand(spark, folder)
        .groupBy("product_id", "year")
        .agg(ratio(F.stddev_samp("units_sold"), F.avg("units_sold")).alias("cv"))
    )


@register(
    "d9_having",
    PROMO
    + BODY
    + """SELECT product_id, count(*) FILTER (WHERE is_promo = 1) AS promo_days FROM promos GROUP BY 1
    HAVING count(*) FILTER (WHERE is_promo = 1) > 10""",
)
def having(spark, folder):
    counted = (
        promo_rows(raw_demand(spark, folder), MIN_YEAR)
        .groupBy("product_id")
        .agg(F.count_if(F.col("is_promo") == 1).alias("promo_days"))
    )
    return counted.where(F.col("promo_days") > 10)


@register(
    "d10_volume_total",
    RAW
    + BODY
    + """SELECT product_id, CAST(sum(units_sold) AS BIGINT) AS total_units, avg(units_sold) AS mean_demand
    FROM raw_demand GROUP BY 1""",
    "mean_demand",
)
def volume_total(spark, folder):
    return product_volumes(raw_demand(spark, folder))


@register(
    "d11_dataset_profile",
    RAW
    + BODY
    + """SELECT count(*) AS total_records, count(DISTINCT product_id) AS unique_products, min(date) AS first_date,
    max(date) AS last_date, count(DISTINCT category) AS categories, count(DISTINCT warehouse) AS warehouses,
    count(DISTINCT region) AS regions, avg(units_sold) AS avg_daily_demand, sum(revenue) AS total_revenue FROM raw_demand""",
    "avg_daily_demand total_revenue:2",
)
def profile(spark, folder):
    return dataset_profile(raw_demand(spark, folder))


def _with_history(spark, folder):
    return drop_short_history(add_lags(raw_demand(spark, folder), [90]).select("product_id", "date", "demand_lag_90d"))


HISTORY = (
    RAW.rstrip()
    + """,
numbered AS (SELECT product_id, date, date_diff('day', DATE '1970-01-01', date) AS day_no,
  row_number() OVER (PARTITION BY product_id ORDER BY date) AS nth FROM raw_demand),
history AS (SELECT * FROM numbered WHERE nth > 90),
cut AS (SELECT quantile_cont(CAST(day_no AS DOUBLE), 0.8) AS split_day FROM history)
"""
)


@register("d12_date_quantile", HISTORY + BODY + "SELECT split_day FROM cut", "split_day")
def split_point(spark, folder):
    return date_quantile(_with_history(spark, folder))


@register(
    "d13_target_correlation",
    CORRELATIONS + BODY + "SELECT feature, correlation FROM correlations",
    "correlation:5",
)
def target_correlation(spark, folder):
    return rank_correlations(correlations(spark, folder))


@register("d14_distinct_values", RAW + BODY + "SELECT DISTINCT category, region, warehouse FROM raw_demand")
def distinct_values(spark, folder):
    return raw_demand(spark, folder).select("category", "region", "warehouse").distinct()


def _score(name, expression, column):
    sql = f"SELECT {expression} AS {name} FROM simple_ar"

    @register(f"{column}", forecasts() + BODY + sql, name)
    def run(spark, folder):
        return simple_ar(raw_demand(spark, folder)).agg(
            {"mape": mape, "rmse": rmse, "mae": mae, "r2": r2}[name]("actual", "predicted").alias(name)
        )

    return run


_score("rmse", "sqrt(avg(power(actual - predicted, 2)))", "d16_rmse")
_score("mae", "avg(abs(actual - predicted))", "d17_mae")


@register(
    "d15_mape",
    forecasts()
    + BODY
    + """SELECT product_id, avg(abs((actual - predicted) / nullif(actual, 0))) * 100 AS mape,
    coalesce(avg(abs((actual - predicted) / nullif(actual, 0))) * 100, 0.0) AS mape_or_zero FROM simple_ar GROUP BY 1""",
    "mape mape_or_zero",
)
def mape_by_product(spark, folder):
    return (
        simple_ar(raw_demand(spark, folder))
        .groupBy("product_id")
        .agg(mape("actual", "predicted").alias("mape"), mape_or_zero("actual", "predicted").alias("mape_or_zero"))
    )


@register(
    "d18_median_ape",
    forecasts()
    + BODY
    + "SELECT quantile_cont(abs((actual - predicted) / actual), 0.5) * 100 AS mdape FROM simple_ar WHERE actual <> 0",
    "mdape",
)
def median_error(spark, folder):
    return median_ape(simple_ar(raw_demand(spark, folder)), "actual", "predicted")


@register(
    "d19_r2",
    forecasts()
    + BODY
    + """SELECT product_id, CASE WHEN var_pop(actual) > 0 THEN
    1 - sum(power(actual - predicted, 2)) / (var_pop(actual) * count(*)) ELSE 0.0 END AS r2 FROM simple_ar GROUP BY 1""",
    "r2",
)
def r2_by_product(spark, folder):
    return simple_ar(raw_demand(spark, folder)).groupBy("product_id").agg(r2("actual", "predicted").alias("r2"))


@register(
    "d20_scorecard",
    forecasts().rstrip()
    + f""",
per_product AS (SELECT product_id, avg(abs((actual - predicted) / nullif(actual, 0))) * 100 AS mape FROM simple_ar GROUP BY 1),
pooled AS (SELECT avg(abs((actual - predicted) / nullif(actual, 0))) * 100 AS overall_mape,
  sqrt(avg(power(actual - predicted, 2))) AS overall_rmse FROM simple_ar)
{BODY}SELECT count(*) AS products, any_value(overall_mape) AS overall_mape, any_value(overall_rmse) AS overall_rmse,
  avg(mape) AS mean_mape, min(mape) AS best_mape, max(mape) AS worst_mape FROM per_product, pooled""",
    "overall_mape overall_rmse mean_mape best_mape worst_mape",
)
def scorecard(spark, folder):
    return score_summary(simple_ar(raw_demand(spark, folder)))


@register(
    "d20_product_scores",
    forecasts()
    + BODY
    + """SELECT product_id, avg(abs((actual - predicted) / nullif(actual, 0))) * 100 AS mape,
    sqrt(avg(power(actual - predicted, 2))) AS rmse, count(*) AS n_points FROM simple_ar GROUP BY 1""",
    "mape rmse",
)
def scores_by_product(spark, folder):
    return product_scores(simple_ar(raw_demand(spark, folder)))


@register(
    "d20_product_results",
    forecasts().rstrip()
    + f""",
means AS (SELECT product_id, avg(units_sold) AS mean_demand FROM raw_demand GROUP BY 1)
{BODY}SELECT product_id, 'SimpleAR' AS method, any_value(mean_demand) AS mean_demand, count(*) AS n_points,
  avg(abs((actual - predicted) / nullif(actual, 0))) * 100 AS mape, sqrt(avg(power(actual - predicted, 2))) AS rmse
  FROM simple_ar JOIN means USING (product_id) GROUP BY 1""",
    "mape rmse mean_demand",
)
def results_by_product(spark, folder):
    demand = raw_demand(spark, folder)
    return product_results(simple_ar(demand), demand)


@register(
    "d21_block_errors",
    ensemble(LONG_HORIZON) + BODY + "SELECT product_id, block, first_mae, second_mae FROM blocks",
    "first_mae second_mae",
)
def errors_by_block(spark, folder):
    return block_errors(both_models(spark, folder, LONG_HORIZON))


@register(
    "d22_split_summary",
    HISTORY
    + BODY
    + """SELECT CASE WHEN day_no <= split_day THEN 'train' ELSE 'test' END AS side, count(*) AS n_rows,
    min(date) AS first_date, max(date) AS last_date FROM history, cut GROUP BY 1""",
)
def summary_of_split(spark, folder):
    return split_summary(add_split_side(_with_history(spark, folder)))
