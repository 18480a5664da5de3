"""Seasonal autoregression with moving-average terms, per product.

The order is (2,1,2)(1,1,1,7): one plain and one weekly difference, then AR and
MA terms at lags 1, 2, 7, 8 and 9. The six parameters are found by two-stage
regression (Hannan and Rissanen 1982) in place of maximum likelihood:

1. a long autoregression gives residuals that stand in for the innovations;
2. the differenced series is regressed on its own and the residuals' lags. The
   ten coefficients are functions of the parameters: those at lags 8 and 9 are
   products of a plain and the weekly one. Damped Gauss-Newton steps find the
   parameters with the least sum of squares.

Spark does all passes over rows: differences and lags are window columns. The sum
of squares, its gradient and the step for any parameters follow from the sums of
products per product, so that Python sees one row of sums per product, whatever
the number of steps, fits a batch of products at once and steps the recursion.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import floor_at_zero
from ..session import materialize
from .series import add_position, by_product
from .simple_ar import simple_ar

# The batch functions travel to the workers by value, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEASON = 7
TERM_LAGS = (1, 2, 7, 8, 9)
LONG_LAGS = 28
STATE = 9
FREE = 6
#: Those of the lags and the variance.
PARAMETERS = FREE + 1
MAX_CONDITION = 1e12
STEPS = 100
#: Steps end where no regressor along the parameters correlates more than this with the residuals.
MAX_SLOPE = 1e-7

_REGRESSORS = [f"z{k}" for k in TERM_LAGS] + [f"e{k}" for k in TERM_LAGS]
_PAIRS = [(i, j) for i in range(len(_REGRESSORS)) for j in range(i, len(_REGRESSORS))]


def _lag(column: str, k: int) -> Column:
    return F.lag(column, k).over(by_product())


def differenced(series: DataFrame, horizon: int = 30) -> DataFrame:
    """Training rows with ``z``, the plain and weekly difference, its lags and the row's age."""
    placed = add_position(series.select("product_id", "date", F.col("units_sold").cast("double").alias("y")))
    train = placed.where(F.col("nth") <= F.col("n_rows") - horizon)
    z = F.col("y") - _lag("y", 1) - _lag("y", SEASON) + _lag("y", SEASON + 1)
    with_z = train.withColumns({"z": z, "age": F.col("n_rows") - horizon - F.col("nth") + 1})
    return with_z.withColumns({f"z{k}": _lag("z", k) for k in range(1, LONG_LAGS + 1)})


def _solve(matrix: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Batched solve; NaN where a system is singular or badly conditioned."""
    solution = np.full(right.shape, np.nan)
    finite = np.isfinite(matrix).all(axis=(1, 2)) & np.isfinite(right).all(axis=1)
    usable = np.flatnonzero(finite)
    if len(usable):
        usable = usable[np.linalg.cond(matrix[usable]) < MAX_CONDITION]
    if len(usable):
        solution[usable] = np.linalg.solve(matrix[usable], right[usable][:, :, None])[:, :, 0]
    return solution


def _long_coefficients(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Yule-Walker: autocovariances per product to ``LONG_LAGS`` coefficients."""
    distance = np.abs(np.subtract.outer(np.arange(LONG_LAGS), np.arange(LONG_LAGS)))
    for sums in batches:
        g = sums[[f"g{k}" for k in range(LONG_LAGS + 1)]].to_numpy(dtype=float)
        phi = _solve(g[:, :LONG_LAGS][:, distance], g[:, 1:])
        keep = np.isfinite(phi).all(axis=1)
        yield pd.DataFrame({"product_id": sums["product_id"][keep].to_numpy(), "phi": list(phi[keep])})


def long_autoregression(rows: DataFrame) -> DataFrame:
    """``phi`` per product; products whose system is singular are absent."""
    products = [F.sum(F.col("z") * (F.col(f"z{k}") if k else F.col("z"))).alias(f"g{k}") for k in range(LONG_LAGS + 1)]
    return rows.groupBy("product_id").agg(*products).mapInPandas(
        _long_coefficients, "product_id string, phi array<double>"
    )


def regression_sums(rows: DataFrame, phi: DataFrame) -> DataFrame:
    """One row per product: sums of products of all regressors, and the last states."""
    fitted = sum((F.col("phi")[k - 1] * F.col(f"z{k}") for k in range(2, LONG_LAGS + 1)), F.col("phi")[0] * F.col("z1"))
    residual = rows.join(phi, "product_id").withColumn("e", F.col("z") - fitted)
    lagged = residual.withColumns({f"e{k}": _lag("e", k) for k in TERM_LAGS})
    complete = lagged.where(F.col(f"e{max(TERM_LAGS)}").isNotNull())
    x = [F.col(c) for c in _REGRESSORS]
    sums = [F.sum(x[i] * x[j]).alias(f"xx{i}_{j}") for i, j in _PAIRS]
    sums += [F.sum(c * F.col("z")).alias(f"xz{i}") for i, c in enumerate(x)]
    states = [
        F.max(F.when(F.col("age") == k, F.col(c))).alias(f"{c}_{k}") for c in ("y", "z", "e") for k in range(1, STATE + 1)
    ]
    return complete.groupBy("product_id").agg(
        F.count("*").alias("n"), F.sum(F.col("z") * F.col("z")).alias("zz"), *sums, *states
    )


def lag_coefficients(theta: np.ndarray) -> np.ndarray:
    """Coefficients at ``TERM_LAGS`` of the series, then of the innovations.

    A row of ``theta`` has the two plain and the weekly AR parameter, then those of the MA side.
    """
    p1, p2, p7, q1, q2, q7 = theta.T
    return np.stack([p1, p2, p7, -p1 * p7, -p2 * p7, q1, q2, q7, q1 * q7, q2 * q7], axis=1)


def _slopes(theta: np.ndarray) -> np.ndarray:
    """Derivatives of ``lag_coefficients``: one matrix, lags by parameters, per row."""
    out = np.zeros((len(theta), 2 * len(TERM_LAGS), FREE))
    for side, sign in ((0, -1.0), (1, 1.0)):
        row, at = side * len(TERM_LAGS), side * FREE // 2
        first, second, weekly = theta[:, at], theta[:, at + 1], theta[:, at + 2]
        for k in range(3):
            out[:, row + k, at + k] = 1.0
        out[:, row + 3, at], out[:, row + 3, at + 2] = sign * weekly, sign * first
        out[:, row + 4, at + 1], out[:, row + 4, at + 2] = sign * weekly, sign * second
    return out


def _descend(xx: np.ndarray, xz: np.ndarray, zz: np.ndarray, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Parameters, sum of squares and steepest correlation of each system, by damped Gauss-Newton steps from ``theta``."""

    def loss(at: np.ndarray) -> np.ndarray:
        b = lag_coefficients(at)
        return zz - 2 * (b * xz).sum(axis=1) + np.einsum("ni,nij,nj->n", b, xx, b)

    theta, best, damping = theta.copy(), loss(theta), np.full(len(theta), 1e-3)
    slope = np.full(len(theta), np.inf)
    for _ in range(STEPS):
        jacobian = _slopes(theta)
        normal = np.einsum("nia,nij,njb->nab", jacobian, xx, jacobian)
        gradient = np.einsum("nia,ni->na", jacobian, xz - np.einsum("nij,nj->ni", xx, lag_coefficients(theta)))
        scale = np.einsum("naa->na", normal)
        slope = (np.abs(gradient) / np.sqrt(np.maximum(scale * best[:, None], 1e-300))).max(axis=1)
        moving = slope > MAX_SLOPE
        if not moving.any():
            break
        normal += np.eye(FREE) * (damping[:, None] * np.maximum(scale, 1e-300))[:, None, :]
        tried = theta + np.linalg.solve(normal, gradient[:, :, None])[:, :, 0]
        after = loss(tried)
        better = moving & (after <= best)
        theta[better], best[better] = tried[better], after[better]
        damping = np.clip(np.where(better, damping / 10, damping * 10), 1e-12, 1e12)
    return theta, best, slope


def constrained_fit(xx: np.ndarray, xz: np.ndarray, zz: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Parameters, sum of squares and steepest correlation per system, NaN where a system is singular.

    The sum of squares can have more than one low point, so the steps start from the
    free coefficients of the lags and from zero, and the lower end counts.
    """
    free = _solve(xx, xz)
    theta, sse, slope = np.full((len(xx), FREE), np.nan), np.full(len(xx), np.nan), np.full(len(xx), np.nan)
    usable = np.flatnonzero(np.isfinite(free).all(axis=1))
    if len(usable):
        terms = len(TERM_LAGS)
        starts = (free[usable][:, [0, 1, 2, terms, terms + 1, terms + 2]], np.zeros((len(usable), FREE)))
        ends = [_descend(xx[usable], xz[usable], zz[usable], start) for start in starts]
        lower = ends[0][1] <= ends[1][1]
        theta[usable] = np.where(lower[:, None], ends[0][0], ends[1][0])
        sse[usable], slope[usable] = np.where(lower, ends[0][1], ends[1][1]), np.where(lower, ends[0][2], ends[1][2])
    return theta, sse, slope


def _forecast_batches(horizon: int):
    """Solve stage two and step the recursion for a batch of products at once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size, terms = len(_REGRESSORS), len(TERM_LAGS)
        for sums in batches:
            xx = np.empty((len(sums), size, size))
            for i, j in _PAIRS:
                xx[:, i, j] = xx[:, j, i] = sums[f"xx{i}_{j}"]
            xz = sums[[f"xz{i}" for i in range(size)]].to_numpy(dtype=float)
            theta, sse, slope = constrained_fit(xx, xz, sums["zz"].to_numpy(dtype=float))
            beta = lag_coefficients(theta)
            n = sums["n"].to_numpy(dtype=float)

            def state(name: str) -> np.ndarray:
                """Oldest first, with room for the steps ahead."""
                past = sums[[f"{name}_{k}" for k in range(STATE, 0, -1)]].to_numpy(dtype=float)
                return np.hstack([past, np.zeros((len(sums), horizon))])

            y, z, e = state("y"), state("z"), state("e")
            with np.errstate(all="ignore"):
                for t in range(STATE, STATE + horizon):
                    back = [t - k for k in TERM_LAGS]
                    z[:, t] = (beta[:, :terms] * z[:, back]).sum(axis=1) + (beta[:, terms:] * e[:, back]).sum(axis=1)
                    y[:, t] = z[:, t] + y[:, t - 1] + y[:, t - SEASON] - y[:, t - SEASON - 1]
                aic = n * np.log(sse / n) + 2 * PARAMETERS
                bic = n * np.log(sse / n) + PARAMETERS * np.log(n)
            keep = np.isfinite(y).all(axis=1) & np.isfinite(aic) & (n > size + 1)
            yield pd.DataFrame(
                {
                    "product_id": sums["product_id"][keep].to_numpy(),
                    "parameters": list(theta[keep]),
                    "coefficients": list(beta[keep]),
                    "ahead": list(y[keep, STATE:]),
                    "n_used": n[keep].astype("int64"),
                    "sse": sse[keep],
                    "slope": slope[keep],
                    "aic": aic[keep],
                    "bic": bic[keep],
                }
            )

    return run


FIT_SCHEMA = (
    "product_id string, parameters array<double>, coefficients array<double>, ahead array<double>, "
    "n_used long, sse double, slope double, aic double, bic double"
)


def fit_seasonal_arima(series: DataFrame, horizon: int = 30) -> DataFrame:
    """One row per product that could be fitted: parameters, coefficients, forecast array, AIC and BIC.

    ``slope`` is the largest correlation of the residuals with a regressor along
    the parameters, zero at the least sum of squares.

    Products with too few rows, a singular system or a forecast that is not
    finite are absent.
    """
    rows = materialize(differenced(series, horizon), "differenced")
    sums = regression_sums(rows, long_autoregression(rows))
    return sums.mapInPandas(_forecast_batches(horizon), FIT_SCHEMA)


def forecast_with_fallback(series: DataFrame, horizon: int = 30) -> DataFrame:
    """Held-out rows of every product: the seasonal model, or the simple one where it has no fit."""
    fits = fit_seasonal_arima(series, horizon).select("product_id", "ahead")
    ahead = floor_at_zero(F.col("ahead")[F.col("step") - 1])
    return (
        simple_ar(series, horizon)
        .join(fits, "product_id", "left")
        .select(
            "product_id",
            "date",
            "step",
            "actual",
            F.coalesce(ahead, F.col("predicted")).alias("predicted"),
            F.when(ahead.isNotNull(), "SARIMA").otherwise(F.col("method")).alias("method"),
        )
    )
