"""Feature table, model preparation, models, ensemble."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import forest
from ..operators.calendar import add_calendar_features, add_peak_flag, peak_months
from ..operators.ensemble import (
    FIRST,
    SECOND,
    add_adaptive_weight,
    add_ensemble,
    add_error_pct,
    align,
    best_weight,
    business_impact,
    ensemble_output,
    grid_scores,
    tuning_points,
    weighted,
)
from ..operators.prep import add_level_codes, add_one_hot, add_split_side, feature_columns, feature_matrix, fold_labels
from ..operators.scores import compare_models, full_metrics, model_scores
from ..operators.seasonal_arima import fit_seasonal_arima, forecast_with_fallback
from ..operators.selection import top_products, with_min_history
from ..operators.simple_ar import add_components, simple_ar
from ..plans.features import feature_table, sided_features
from ..plans.forecasting import MODELS, ensemble_run, product_forecasts, rolling_forecasts
from ..session import materialize
from ..settings import DEFAULTS
from ..sources.demand import demand_calendar, demand_level_index, demand_levels, raw_demand
from .base import PEAKS, register
from .ctes import (
    CALENDAR,
    CALENDAR_NAMES,
    CODES,
    DOUBLE_FEATURES,
    FEATURE_TABLE,
    LAG_NAMES,
    ONE_HOT,
    ONE_HOT_SQL,
    PRICE_NAMES,
    RAW,
    ROLL_NAMES,
    ensemble,
    forecasts,
)
from .joins import LONG_HORIZON, PEAK_SQL, both_models
from .projections import BODY, features_of

# The matrix inputs by name, for the check of its sums.
MATRIX_INPUTS = ["price", *LAG_NAMES, *ROLL_NAMES, "demand_cv_30d", *(c for c in PRICE_NAMES if c != "demand_change"),
                 "demand_yoy", "trend_30d", *(c for c in CALENDAR_NAMES), *ONE_HOT]

_STORED: dict = {}


def _stored(spark, folder, name, make):
    """A table that is written once per application, as training reads its input many times."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _STORED:
        _STORED[key] = materialize(make(), name)
    return _STORED[key]


def stored_features(spark, folder):
    return _stored(spark, folder, "features", lambda: sided_features(features_of(spark, folder)))


def stored_matrix(spark, folder):
    return _stored(spark, folder, "matrix", lambda: feature_matrix(stored_features(spark, folder)))


_FORESTS: dict = {}


def trained(spark, folder):
    """(forest, matrix, input columns) of a forest on the training side, grown once per application."""
    matrix, key = stored_matrix(spark, folder), (spark.sparkContext.applicationId, folder)
    if key not in _FORESTS:
        _FORESTS[key] = forest.fit_forest(matrix.where("side = 'train'"))
    return _FORESTS[key], matrix, feature_columns(stored_features(spark, folder))


@register(
    "i1_calendar_features",
    CALENDAR
    + BODY
    + f"""SELECT r.product_id, r.date, {", ".join(f'c."{c}"' for c in CALENDAR_NAMES)}
    FROM raw_demand r JOIN calendar c ON c.date = r.date""",
)
def calendar_feature_set(spark, folder):
    rows = raw_demand(spark, folder).select("product_id", "date")
    return add_calendar_features(rows, demand_calendar(spark, folder))


@register("i4_one_hot", RAW + BODY + f"SELECT product_id, date, {ONE_HOT_SQL} FROM raw_demand")
def one_hot(spark, folder):
    rows = raw_demand(spark, folder).select("product_id", "date", "category", "warehouse", "region")
    return add_one_hot(rows, demand_levels(spark, folder))


@register(
    "i4_level_codes",
    RAW
    + BODY
    + """SELECT product_id, date, dense_rank() OVER (ORDER BY category) - 1 AS cat_code,
    dense_rank() OVER (ORDER BY warehouse) - 1 AS wh_code, dense_rank() OVER (ORDER BY region) - 1 AS reg_code FROM raw_demand""",
)
def level_codes(spark, folder):
    rows = raw_demand(spark, folder).select("product_id", "date", "category", "warehouse", "region")
    return add_level_codes(rows, demand_level_index(spark, folder))


_FEATURE_DIGITS = {c: 4 if c in ("price_demand_corr_30d", "revenue") else 6 for c in (*DOUBLE_FEATURES, "price_demand_corr_30d")}


@register("i5_feature_table", FEATURE_TABLE + BODY + "SELECT * FROM sided", _FEATURE_DIGITS)
def whole_feature_table(spark, folder):
    return sided_features(features_of(spark, folder))


_SIDES = (
    RAW.rstrip()
    + """,
history AS (SELECT product_id, date, date_diff('day', DATE '1970-01-01', date) AS day_no FROM raw_demand),
cut AS (SELECT quantile_cont(CAST(day_no AS DOUBLE), 0.8) AS split_day FROM history)
"""
)


@register(
    "i6_time_split",
    _SIDES
    + BODY
    + "SELECT product_id, date, CASE WHEN day_no <= split_day THEN 'train' ELSE 'test' END AS side FROM history, cut",
)
def split_by_time(spark, folder):
    return add_split_side(raw_demand(spark, folder).select("product_id", "date"))


@register(
    "i7_feature_matrix",
    FEATURE_TABLE
    + BODY
    + f"""SELECT product_id, date, side, CAST(target AS DOUBLE) AS label, {len(MATRIX_INPUTS)} AS n_features,
    {" + ".join(f'coalesce(CAST("{c}" AS DOUBLE), 0.0)' for c in MATRIX_INPUTS)} AS feature_sum FROM sided""",
    "feature_sum:4",
)
def matrix_rows(spark, folder):
    return _checked_sums(stored_matrix(spark, folder))


def _checked_sums(matrix):
    values = vector_to_array("features")
    return matrix.select(
        "product_id",
        "date",
        "side",
        "label",
        F.size(values).alias("n_features"),
        F.aggregate(values, F.lit(0.0), lambda total, v: total + v).alias("feature_sum"),
    )


_CODED_INPUTS = [f'"{c}"' for c in MATRIX_INPUTS if c not in ONE_HOT] + [f"({sql})" for sql in CODES.values()]


@register(
    "i7_coded_matrix",
    FEATURE_TABLE
    + BODY
    + f"""SELECT product_id, date, side, CAST(target AS DOUBLE) AS label, {len(_CODED_INPUTS)} AS n_features,
    {" + ".join(f'coalesce(CAST({c} AS DOUBLE), 0.0)' for c in _CODED_INPUTS)} AS feature_sum FROM sided""",
    "feature_sum:4",
)
def coded_matrix_rows(spark, folder):
    """The matrix with a code per attribute, whatever the number of values; nothing is collected before a fit."""
    codes = demand_level_index(spark, folder)
    features = feature_table(raw_demand(spark, folder), demand_calendar(spark, folder), level_codes=codes)
    return _checked_sums(feature_matrix(sided_features(features)))


@register("i8_forest_forecasts")
def forest_forecasts(spark, folder):
    model, matrix, _ = trained(spark, folder)
    return forest.predict(model, matrix.where("side = 'test'")).drop("side")


@register("i9_forest_metrics")
def forest_metrics(spark, folder):
    model, matrix, _ = trained(spark, folder)
    return forest.side_metrics(forest.predict(model, matrix))


@register("i10_feature_importance")
def feature_importance(spark, folder):
    model, matrix, columns = trained(spark, folder)
    return forest.importances(model, columns, matrix)


@register("f7_top_importance")
def top_importance(spark, folder):
    return feature_importance(spark, folder).limit(10)


@register("i11_out_of_bag")
def out_of_bag_score(spark, folder):
    model, matrix, _ = trained(spark, folder)
    judged = forest.out_of_bag(model, matrix.where("side = 'train'"))
    return judged.agg(F.count("*").alias("n_rows"), F.count("predicted").alias("n_judged"), forest.r2("actual", "predicted").alias("oob_r2"))


@register(
    "i12_full_metrics",
    forecasts()
    + BODY
    + """SELECT avg(abs((actual - predicted) / nullif(actual, 0))) * 100 AS mape,
    quantile_cont(abs((actual - predicted) / nullif(actual, 0)), 0.5) * 100 AS mdape,
    sqrt(avg(power(actual - predicted, 2))) AS rmse, avg(abs(actual - predicted)) AS mae,
    1 - sum(power(actual - predicted, 2)) / (var_pop(actual) * count(*)) AS r2 FROM simple_ar""",
    "mape mdape rmse mae r2",
)
def metric_set(spark, folder):
    return full_metrics(simple_ar(raw_demand(spark, folder)), "actual", "predicted")


@register(
    "i13_fold_labels",
    RAW.rstrip()
    + f""",
placed AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS place, count(*) OVER () AS n FROM days),
cuts AS (SELECT CAST(k AS INTEGER) AS fold, p.date, p.place, p.n // 6 AS size, p.n - (6 - k) * (p.n // 6) AS start
  FROM placed p, range(1, 6) f(k))
{BODY}SELECT fold, date, CASE WHEN place < start THEN 'train' ELSE 'test' END AS role FROM cuts WHERE place < start + size""",
)
def time_folds(spark, folder):
    return fold_labels(demand_calendar(spark, folder))


@register("i13_cross_validation")
def cross_validation(spark, folder):
    matrix = stored_matrix(spark, folder)
    labels = fold_labels(matrix.select("date").distinct())
    return forest.cross_validate(matrix, labels)


@register("i14_reduced_inputs")
def reduced_inputs(spark, folder):
    features = stored_features(spark, folder)
    model, matrix, columns = trained(spark, folder)
    reduced = forest.reduced_matrix(features, forest.importances(model, columns, matrix))
    values = vector_to_array("features")
    return reduced.groupBy("side").agg(F.count("*").alias("n_rows"), F.max(F.size(values)).alias("n_features"))


@register(
    "i15_split_with_gap",
    _SIDES
    + BODY
    + """SELECT product_id, date, CASE WHEN day_no <= split_day THEN 'train' WHEN day_no > split_day + 7 THEN 'test' END AS side
    FROM history, cut""",
)
def split_with_gap(spark, folder):
    return add_split_side(raw_demand(spark, folder).select("product_id", "date"), gap_days=7)


@register(
    "i16_min_history",
    RAW
    + BODY
    + """SELECT product_id, date, units_sold FROM raw_demand
    QUALIFY count(*) OVER (PARTITION BY product_id) >= 90""",
)
def min_history(spark, folder):
    kept = with_min_history(raw_demand(spark, folder), DEFAULTS.min_history_days)
    return kept.select("product_id", "date", "units_sold")


@register(
    "i17_product_selection",
    RAW
    + BODY
    + """SELECT product_id, CAST(sum(units_sold) AS BIGINT) AS total_units, avg(units_sold) AS mean_demand FROM raw_demand
    GROUP BY 1 HAVING avg(units_sold) >= 4 ORDER BY 2 DESC, 1 LIMIT 50""",
    "mean_demand",
)
def product_selection(spark, folder):
    return top_products(raw_demand(spark, folder), DEFAULTS.n_products, min_daily_demand=4)


@register(
    "i18_fixed_weights",
    ensemble()
    + BODY
    + "SELECT product_id, date, 0.4::DOUBLE * arima_forecast + (1 - 0.4::DOUBLE) * rf_forecast AS ensemble_forecast FROM points",
    "ensemble_forecast",
)
def fixed_weights(spark, folder):
    points = both_models(spark, folder)
    return add_ensemble(points, DEFAULTS.ensemble.fixed_first_pct).select("product_id", "date", "ensemble_forecast")


@register("i19_peak_season", PEAK_SQL + BODY + "SELECT product_id, date, is_peak_season FROM flagged")
def peak_season(spark, folder):
    rows = raw_demand(spark, folder).select("product_id", "date", "category")
    return add_peak_flag(rows, peak_months(spark, PEAKS)).select("product_id", "date", "is_peak_season")


@register("i20_seasonal_arima")
def seasonal_arima(spark, folder):
    fits = fit_seasonal_arima(raw_demand(spark, folder))
    return fits.select(
        "product_id",
        F.posexplode("ahead").alias("step", "predicted"),
    ).select("product_id", (F.col("step") + 1).alias("step"), F.greatest("predicted", F.lit(0.0)).alias("predicted"))


@register("i21_information_criteria")
def information_criteria(spark, folder):
    return fit_seasonal_arima(raw_demand(spark, folder)).select("product_id", "n_used", "sse", "aic", "bic")


@register(
    "i21_fit_conditions",
    RAW
    + BODY
    # Held-out rows, and those before the first difference, its last lag and the last lag of its residuals.
    + """SELECT product_id, count(*) - 30 - 8 - 28 - 9 AS n_used, 6 AS n_parameters, TRUE AS least, TRUE AS multiplicative,
    TRUE AS criteria_agree FROM raw_demand GROUP BY product_id""",
)
def fit_conditions(spark, folder):
    """What must hold for every fit: its rows, residuals at a right angle to the slopes, products at lags 8 and 9, criteria by the count."""
    fits = fit_seasonal_arima(raw_demand(spark, folder))
    p, c = (lambda k: F.col("parameters")[k]), (lambda k: F.col("coefficients")[k])
    products = [(3, -p(0) * p(2)), (4, -p(1) * p(2)), (8, p(3) * p(5)), (9, p(4) * p(5))]
    holds = reduce(and_, [F.abs(c(k) - value) <= 1e-9 * (1 + F.abs(value)) for k, value in products])
    return fits.select(
        "product_id",
        "n_used",
        F.size("parameters").alias("n_parameters"),
        (F.col("slope") < 1e-6).alias("least"),
        holds.alias("multiplicative"),
        (F.abs(F.col("bic") - F.col("aic") - 7 * (F.log("n_used") - 2)) < 1e-6 * F.abs("aic")).alias("criteria_agree"),
    )


@register(
    "i22_simple_ar",
    forecasts() + BODY + "SELECT product_id, date, step, actual, predicted, 'SimpleAR' AS method FROM simple_ar",
    "predicted",
)
def simple_forecasts(spark, folder):
    return simple_ar(raw_demand(spark, folder))


@register("i23_growth_ratio", forecasts() + BODY + "SELECT DISTINCT product_id, growth FROM parts", "growth")
def growth_ratio(spark, folder):
    return add_components(raw_demand(spark, folder)).where("step = 1").select("product_id", "growth")


@register("i24_forecasts_with_fallback")
def forecasts_with_fallback(spark, folder):
    return forecast_with_fallback(raw_demand(spark, folder))


@register(
    "i24_forecast_keys",
    forecasts() + BODY + "SELECT product_id, date, step, actual, TRUE AS usable FROM simple_ar",
)
def forecast_keys(spark, folder):
    """What SQL can tell of the seasonal forecasts: one for every held-out row, finite and not negative."""
    usable = F.col("predicted").between(0.0, 1e300) & F.col("method").isin("SARIMA", "SimpleAR")
    return forecast_with_fallback(raw_demand(spark, folder)).select("product_id", "date", "step", "actual", usable.alias("usable"))


@register("i25_weight_grid", ensemble() + BODY + "SELECT weight_pct, score FROM best JOIN grid_scores USING (weight_pct)", "score")
def weight_grid(spark, folder):
    return best_weight(grid_scores(tuning_points(both_models(spark, folder))))


@register(
    "i25_weight_grid_rmse",
    ensemble()
    + BODY
    + """SELECT CAST(weight_pct AS INTEGER) AS weight_pct, sqrt(avg(power(actual - (weight_pct / 100.0::DOUBLE * arima_forecast
      + (1 - weight_pct / 100.0::DOUBLE) * rf_forecast), 2))) AS score FROM tuning, weights GROUP BY 1""",
    "score",
)
def weight_grid_rmse(spark, folder):
    return grid_scores(tuning_points(both_models(spark, folder)), "rmse")


@register(
    "i26_weighted_sum",
    ensemble()
    + BODY
    + """SELECT product_id, date, b.weight_pct / 100.0::DOUBLE * arima_forecast + (1 - b.weight_pct / 100.0::DOUBLE) * rf_forecast AS combined
    FROM points, best b""",
    "combined",
)
def weighted_sum(spark, folder):
    points = both_models(spark, folder)
    tuned = best_weight(grid_scores(tuning_points(points))).select("weight_pct").scalar()
    return points.select("product_id", "date", weighted(tuned).alias("combined"))


@register(
    "i27_adaptive_fallback",
    ensemble(LONG_HORIZON) + BODY + "SELECT product_id, date, block, weight_pct, ensemble_forecast FROM combined",
    "ensemble_forecast",
)
def adaptive_fallback(spark, folder):
    points = both_models(spark, folder, LONG_HORIZON)
    tuned = best_weight(grid_scores(tuning_points(points))).select("weight_pct").scalar()
    weighed = add_adaptive_weight(points, tuned)
    return add_ensemble(weighed, F.col("weight_pct")).select(
        "product_id", "date", "block", "weight_pct", "ensemble_forecast"
    )


@register("i28_error_pct", ensemble() + BODY + "SELECT product_id, date, ensemble_error_pct FROM output", "ensemble_error_pct")
def error_pct(spark, folder):
    return ensemble_output(both_models(spark, folder)).select("product_id", "date", "ensemble_error_pct")


def _scores_sql(model, column):
    return f"""SELECT '{model}' AS model, coalesce(avg(abs((actual - {column}) / nullif(actual, 0))) * 100, 0.0) AS mape,
      sqrt(avg(power(actual - {column}, 2))) AS rmse, avg(abs(actual - {column})) AS mae FROM output"""


_THREE = {**MODELS, "ensemble": "ensemble_forecast"}


@register(
    "i29_model_scores",
    ensemble() + BODY + " UNION ALL ".join(_scores_sql(*pair) for pair in _THREE.items()),
    "mape rmse mae",
)
def scores_by_model(spark, folder):
    return model_scores(ensemble_output(both_models(spark, folder)), _THREE)


@register(
    "i29_model_comparison",
    ensemble().rstrip()
    + f""",
mapes AS (SELECT {", ".join(f"coalesce(avg(abs((actual - {c}) / nullif(actual, 0))) * 100, 0.0) AS {n}_mape" for n, c in _THREE.items())} FROM output)
{BODY}SELECT *, least(arima_mape, random_forest_mape) AS best_single_mape,
  (least(arima_mape, random_forest_mape) - ensemble_mape) / nullif(least(arima_mape, random_forest_mape), 0) * 100 AS improvement_pct
  FROM mapes""",
    "arima_mape random_forest_mape ensemble_mape best_single_mape improvement_pct",
)
def model_comparison(spark, folder):
    return compare_models(ensemble_output(both_models(spark, folder)), MODELS, "ensemble_forecast")


@register(
    "i30_business_impact",
    ensemble()
    + BODY
    + """SELECT 0.12::DOUBLE * 100 AS safety_stock_reduction_pct, 12.0::DOUBLE AS gross_margin_improvement_pct,
    100.0::DOUBLE * count(*) FILTER (WHERE ensemble_forecast < actual * 0.9::DOUBLE) / count(*) AS stockout_risk_pct,
    avg(abs(actual - ensemble_forecast)) * 45 * 0.02::DOUBLE AS daily_excess_inventory_cost,
    sum(actual * 45.0::DOUBLE) * 0.12::DOUBLE * 0.35::DOUBLE / count(*) * 365 AS annualized_margin_impact FROM output""",
    """safety_stock_reduction_pct stockout_risk_pct daily_excess_inventory_cost annualized_margin_impact""",
)
def impact(spark, folder):
    return business_impact(ensemble_output(both_models(spark, folder)))


_OUTPUT_DOUBLES = f"{FIRST} {SECOND} ensemble_forecast ensemble_error_pct"


@register("i31_ensemble_output", ensemble(LONG_HORIZON) + BODY + "SELECT * FROM output", _OUTPUT_DOUBLES)
def whole_ensemble(spark, folder):
    """Four blocks per product, so that the adaptive step has verdicts to apply."""
    return ensemble_output(both_models(spark, folder, LONG_HORIZON))


@register("i31_model_ensemble")
def model_ensemble(spark, folder):
    """The ensemble of the two fitted models, over two blocks of 30 days with a fit of the seasonal model before each."""
    first = rolling_forecasts(raw_demand(spark, folder), origins=2)
    second = forest_forecasts(spark, folder)
    points = materialize(align(first, second), "points")
    return ensemble_run(points)["output"]


@register(
    "i24_rolling_keys",
    RAW
    + BODY
    + """SELECT product_id, date, CAST((60 - age) // 30 AS INTEGER) AS origin, CAST((60 - age) % 30 + 1 AS INTEGER) AS step, units_sold AS actual, TRUE AS usable
    FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY date DESC) AS age FROM raw_demand) WHERE age <= 60""",
)
def rolling_keys(spark, folder):
    """Which rows two origins of 30 steps forecast; every forecast is finite and not negative."""
    usable = F.col("predicted").between(0.0, 1e300)
    return rolling_forecasts(raw_demand(spark, folder), origins=2).select("product_id", "date", "origin", "step", "actual", usable.alias("usable"))


@register("i24_top_product_forecasts")
def top_product_forecasts(spark, folder):
    return product_forecasts(raw_demand(spark, folder), s=DEFAULTS.__class__(min_daily_demand=4.0))
