"""Forecast runs: per-product models with a fallback, and the ensemble of two models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ensemble import FIRST, SECOND, best_weight, business_impact, ensemble_output, grid_scores, tuning_points
from ..operators.scores import compare_models, model_scores, product_results, score_summary
from ..operators.seasonal_arima import forecast_with_fallback
from ..operators.selection import keep_products, top_products, with_min_history
from ..operators.series import add_position
from ..session import materialize
from ..settings import DEFAULTS, DemandSettings
from ..sources.tables import write_csv


def product_forecasts(demand: DataFrame, n_products: int | None = None, s: DemandSettings = DEFAULTS) -> DataFrame:
    """Held-out forecasts of the products with the most units and enough demand and history."""
    chosen = top_products(demand, n_products or s.n_products, s.min_daily_demand)
    return forecast_with_fallback(with_min_history(keep_products(demand, chosen), s.min_history_days), s.horizon)


def rolling_forecasts(demand: DataFrame, origins: int = 2, horizon: int = DEFAULTS.horizon) -> DataFrame:
    """Forecasts of the last ``origins`` stretches of ``horizon`` rows, each from the rows before it alone.

    ``origin`` counts the stretches from the oldest. So the blocks of an ensemble
    follow each other as they do in use: the model is fitted anew before each.
    """
    placed = add_position(demand.select("product_id", "date", "units_sold"))
    made = None
    for origin in range(origins):
        known = placed.where(F.col("nth") <= F.col("n_rows") - (origins - 1 - origin) * horizon).drop("nth", "n_rows")
        one = forecast_with_fallback(known, horizon).withColumn("origin", F.lit(origin))
        made = one if made is None else made.unionByName(one)
    return made


def product_run(demand: DataFrame, n_products: int | None = None, s: DemandSettings = DEFAULTS) -> dict[str, DataFrame]:
    """One run of the models per product: ``forecasts``, ``results`` per product, and one row of ``summary``."""
    forecasts = materialize(product_forecasts(demand, n_products, s), "forecasts")
    return {"forecasts": forecasts, "results": product_results(forecasts, demand), "summary": score_summary(forecasts)}


def write_run(results: dict[str, DataFrame], folder: str) -> None:
    """Each result of a run as a CSV table below ``folder``, named after the result."""
    for name, df in results.items():
        write_csv(df, f"{folder.rstrip('/')}/{name}")


MODELS = {"arima": FIRST, "random_forest": SECOND}


def ensemble_run(points: DataFrame, s: DemandSettings = DEFAULTS) -> dict[str, DataFrame]:
    """All results of one ensemble run over aligned points.

    ``points`` are read for tuning, combining and scoring: pass a written table.
    """
    output = ensemble_output(points, "mape", s.ensemble)
    return {
        "output": output,
        "weight": best_weight(grid_scores(tuning_points(points, s.ensemble), "mape", s.ensemble)),
        "scores": model_scores(output, MODELS | {"ensemble": "ensemble_forecast"}),
        "comparison": compare_models(output, MODELS, "ensemble_forecast"),
        "impact": business_impact(output, s=s.stock),
    }
