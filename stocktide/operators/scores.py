"""Forecast error measures, as aggregate columns and as score tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import ratio
from ..session import materialize
from .quantile import exact_quantile


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def abs_pct_error(actual: Column | str, predicted: Column | str) -> Column:
    """Null where the actual is 0, so that aggregates skip the row."""
    a, p = _column(actual), _column(predicted)
    return F.abs(ratio(a - p, a))


def mape(actual: Column | str, predicted: Column | str) -> Column:
    return F.avg(abs_pct_error(actual, predicted)) * 100


def mape_or_zero(actual: Column | str, predicted: Column | str) -> Column:
    """The ensemble's variant: 0 when every actual is 0."""
    return F.coalesce(mape(actual, predicted), F.lit(0.0))


def rmse(actual: Column | str, predicted: Column | str) -> Column:
    error = _column(actual) - _column(predicted)
    return F.sqrt(F.avg(error * error))


def mae(actual: Column | str, predicted: Column | str) -> Column:
    return F.avg(F.abs(_column(actual) - _column(predicted)))


def r2(actual: Column | str, predicted: Column | str) -> Column:
    """1 - residual / total variation; 0 when the actuals do not vary."""
    a, p = _column(actual).cast("double"), _column(predicted)
    error = a - p
    total = F.var_pop(a) * F.count(a)
    return F.when(total > 0, 1 - F.sum(error * error) / F.when(total > 0, total)).otherwise(0.0)


def median_ape(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row ``mdape``: exact median absolute percentage error."""
    errors = df.select(abs_pct_error(actual, predicted).alias("ape"))
    return exact_quantile(errors, "ape", 0.5).select((F.col("quantile") * 100).alias("mdape"))


def full_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row: mape, mdape, rmse, mae, r2. The rows are written once and read for each part."""
    df = materialize(df.select(actual, predicted), "scored")
    return df.agg(
        mape(actual, predicted).alias("mape"),
        rmse(actual, predicted).alias("rmse"),
        mae(actual, predicted).alias("mae"),
        r2(actual, predicted).alias("r2"),
    ).select("mape", median_ape(df, actual, predicted).scalar().alias("mdape"), "rmse", "mae", "r2")


def product_scores(forecasts: DataFrame) -> DataFrame:
    """Scores per product over its held-out rows."""
    return forecasts.groupBy("product_id").agg(
        mape("actual", "predicted").alias("mape"),
        rmse("actual", "predicted").alias("rmse"),
        F.count("*").alias("n_points"),
    )


def product_results(forecasts: DataFrame, demand: DataFrame) -> DataFrame:
    """Scores per product with the model that made its forecast and its mean units per day."""
    means = demand.groupBy("product_id").agg(F.avg("units_sold").alias("mean_demand"))
    methods = forecasts.groupBy("product_id").agg(F.max("method").alias("method"))
    return product_scores(forecasts).join(methods, "product_id").join(means, "product_id")


def score_summary(forecasts: DataFrame) -> DataFrame:
    """Pooled scores over all points, and mean, best and worst product MAPE.

    The pooled scores come from the sums per product, so the points are read once.
    """
    error = F.col("actual") - F.col("predicted")
    ape = abs_pct_error("actual", "predicted")
    sums = forecasts.groupBy("product_id").agg(
        F.sum(ape).alias("ape_sum"),
        F.count(ape).alias("ape_n"),
        F.sum(error * error).alias("square_sum"),
        F.count(error).alias("n"),
    )
    product_mape = ratio(F.col("ape_sum"), F.col("ape_n")) * 100
    return sums.agg(
        F.count("*").alias("products"),
        (ratio(F.sum("ape_sum"), F.sum("ape_n")) * 100).alias("overall_mape"),
        F.sqrt(ratio(F.sum("square_sum"), F.sum("n"))).alias("overall_rmse"),
        F.avg(product_mape).alias("mean_mape"),
        F.min(product_mape).alias("best_mape"),
        F.max(product_mape).alias("worst_mape"),
    )


def model_scores(points: DataFrame, models: Mapping[str, str], actual: str = "actual") -> DataFrame:
    """One row per model. ``models`` maps a model name to its forecast column.

    All models are scored in one pass and the single result row is unpivoted,
    so the points are not multiplied.
    """
    aggregates = []
    for name, column in models.items():
        aggregates.append(
            F.struct(
                F.lit(name).alias("model"),
                mape_or_zero(actual, column).alias("mape"),
                rmse(actual, column).alias("rmse"),
                mae(actual, column).alias("mae"),
            )
        )
    return points.agg(F.array(*aggregates).alias("scores")).select(F.inline("scores"))


def improvement_pct(best_single: Column, combined: Column) -> Column:
    return ratio(best_single - combined, best_single) * 100


def compare_models(points: DataFrame, singles: Mapping[str, str], combined: str, actual: str = "actual") -> DataFrame:
    """One row: the MAPE of each model and the gain of the combined one over the best single."""
    scores: Sequence[Column] = [mape_or_zero(actual, c).alias(f"{m}_mape") for m, c in singles.items()]
    row = points.agg(*scores, mape_or_zero(actual, combined).alias("ensemble_mape"))
    best = F.least(*[F.col(f"{m}_mape") for m in singles])
    return row.withColumn("best_single_mape", best).withColumn(
        "improvement_pct", improvement_pct(F.col("best_single_mape"), F.col("ensemble_mape"))
    )
