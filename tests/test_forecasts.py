import numpy as np
import pytest

from stocktide.operators import seasonal_arima as sa
from stocktide.operators.scores import rmse
from stocktide.operators.simple_ar import recent_level, simple_ar


def brute_simple_ar(values, horizon):
    train = np.array(values[: len(values) - horizon], dtype=float)
    flat, n = train[-30:].mean(), len(train)
    pattern = np.array([train[-7:][h % 7] for h in range(horizon)])
    if n > 365:
        past = train[max(n - 395, 0) : n - 365].mean()
        season = train[n - 365 : n - 365 + horizon] * (flat / past if past > 0 else 1.0)
    else:
        season = np.full(horizon, flat)
    return np.maximum(0.4 * pattern + 0.35 * season + 0.25 * flat, 0)


@pytest.mark.parametrize("horizon", [30, 45])
def test_simple_ar_against_brute_force(series, horizon):
    rng = np.random.default_rng(1)
    units = {
        "long": rng.integers(0, 50, 500),
        "clamped": rng.integers(1, 50, 380 + horizon),
        "short": rng.integers(0, 50, 200),
        "idle a year ago": np.r_[np.zeros(120, int), rng.integers(1, 9, 360)],
    }
    made = simple_ar(series(units), horizon).toPandas()
    for product, values in units.items():
        got = made[made.product_id == product].sort_values("step")
        assert list(got.step) == list(range(1, horizon + 1))
        assert list(got.actual) == list(values[-horizon:])
        np.testing.assert_allclose(got.predicted, brute_simple_ar(values, horizon), err_msg=product)


def weekly(n, rng):
    pattern = np.array([20, 22, 25, 30, 45, 60, 50])
    return np.round(pattern[np.arange(n) % 7] * (1 + 0.0005 * np.arange(n)) + rng.normal(0, 2, n)).clip(0)


def test_seasonal_model_beats_the_flat_mean(series):
    rng = np.random.default_rng(2)
    demand = series({f"p{i}": weekly(400, rng) for i in range(3)})
    made = sa.forecast_with_fallback(demand)
    assert {r.method for r in made.select("method").distinct().collect()} == {"SARIMA"}
    model = made.agg(rmse("actual", "predicted").alias("e")).first().e
    flat = recent_level(demand).agg(rmse("actual", "predicted").alias("e")).first().e
    assert model < flat / 3


def least_squares(x, z):
    """Parameters with the least sum of squares over many starts, by numeric slopes on the rows themselves."""
    rng, best = np.random.default_rng(0), (np.inf, None)
    for start in range(30):
        theta, damping = rng.uniform(-0.9, 0.9, sa.FREE) * (start > 0), 1e-3
        residual = lambda t: z - x @ sa.lag_coefficients(t[None])[0]
        for _ in range(300):
            r = residual(theta)
            slopes = np.column_stack([(residual(theta + h) - residual(theta - h)) / 2e-6 for h in 1e-6 * np.eye(sa.FREE)])
            step = np.linalg.lstsq(np.vstack([slopes, damping * np.eye(sa.FREE)]), np.r_[-r, np.zeros(sa.FREE)], rcond=None)[0]
            if (residual(theta + step) ** 2).sum() <= (r**2).sum():
                theta, damping = theta + step, damping / 4
            else:
                damping = max(damping, 1e-6) * 4
        best = min(best, ((residual(theta) ** 2).sum(), tuple(theta)))
    return best


def test_seasonal_parameters_against_least_squares(series):
    rng = np.random.default_rng(5)
    y = weekly(330, rng)
    fit = sa.fit_seasonal_arima(series({"p": y})).first()
    train = y[:300]
    z = np.full(300, np.nan)
    z[8:] = train[8:] - train[7:-1] - train[1:-7] + train[:-8]
    m = sa.LONG_LAGS

    def lag(v, k):
        return np.r_[np.full(k, np.nan), v[:-k]]

    gamma = [np.nansum(z * (lag(z, k) if k else z)) for k in range(m + 1)]
    toeplitz = np.array([[gamma[abs(i - j)] for j in range(m)] for i in range(m)])
    phi = np.linalg.solve(toeplitz, gamma[1:])
    e = z - sum(phi[k - 1] * lag(z, k) for k in range(1, m + 1))
    x = np.column_stack([lag(z, k) for k in sa.TERM_LAGS] + [lag(e, k) for k in sa.TERM_LAGS])
    rows = np.isfinite(x).all(axis=1)
    sse, theta = least_squares(x[rows], z[rows])
    assert fit.sse == pytest.approx(sse, rel=1e-6)
    np.testing.assert_allclose(fit.parameters, theta, atol=1e-3)
    np.testing.assert_allclose(fit.coefficients, sa.lag_coefficients(np.array([fit.parameters]))[0])
    assert fit.n_used == rows.sum()
    assert fit.slope < 1e-6
    assert fit.aic == pytest.approx(rows.sum() * np.log(sse / rows.sum()) + 2 * 7)
    assert fit.bic == pytest.approx(rows.sum() * np.log(sse / rows.sum()) + 7 * np.log(rows.sum()))


def test_slopes_against_differences():
    theta = np.random.default_rng(1).normal(size=(4, sa.FREE))
    for k in range(sa.FREE):
        h = 1e-6 * np.eye(sa.FREE)[k]
        numeric = (sa.lag_coefficients(theta + h) - sa.lag_coefficients(theta - h)) / 2e-6
        np.testing.assert_allclose(sa._slopes(theta)[:, :, k], numeric, atol=1e-8)


def test_seasonal_parameters_of_simulated_series(series):
    """Series drawn from the model itself give its parameters back, and forecasts follow its recursion."""
    # Far from roots that both sides share, where no data can tell the parameters apart.
    truth = {"a": (0.9, -0.5, 0.4, 0.6, 0.4, 0.4), "b": (-0.6, -0.5, -0.3, -0.4, 0.4, -0.4)}
    units, n, errors = {}, 4000, {}
    for seed, (product, theta) in enumerate(truth.items()):
        b = sa.lag_coefficients(np.array([theta]))[0]
        e = np.random.default_rng(seed).normal(0, 1000, n)
        z, y = np.zeros(n), np.zeros(n)
        for t in range(9, n):
            back = [t - k for k in sa.TERM_LAGS]
            z[t] = b[:5] @ z[back] + b[5:] @ e[back] + e[t]
            y[t] = z[t] + y[t - 1] + y[t - 7] - y[t - 8]
        units[product] = np.round(y)
        x = np.column_stack([v[9 - k : n - k] for v in (z, e) for k in sa.TERM_LAGS]) @ sa._slopes(np.array([theta]))[0]
        errors[product] = 1000 * np.sqrt(np.diag(np.linalg.inv(x.T @ x)))
    fits = {r.product_id: r for r in sa.fit_seasonal_arima(series(units)).collect()}
    for product, theta in truth.items():
        # The estimate's own standard errors, from the true innovations.
        assert (np.abs(np.subtract(fits[product].parameters, theta)) < 4 * errors[product]).all()
        assert (errors[product] < 0.05).all()
        assert len(fits[product].ahead) == 30
        assert (fits[product].sse / fits[product].n_used) ** 0.5 == pytest.approx(1000, rel=0.05)
        # Far ahead only the recursion of the differences is left.
        y = np.r_[units[product][:-30], fits[product].ahead]
        z = y[8:] - y[7:-1] - y[1:-7] + y[:-8]
        p = np.array(fits[product].coefficients[:5])
        for t in range(len(z) - 20, len(z)):
            assert z[t] == pytest.approx(p @ z[[t - k for k in sa.TERM_LAGS]], abs=1e-3)


def test_singular_systems_have_no_parameters():
    xx = np.stack([np.zeros((10, 10)), np.eye(10), np.full((10, 10), np.nan)])
    theta, sse, slope = sa.constrained_fit(xx, np.stack([np.zeros(10), 0.1 * np.ones(10), np.zeros(10)]), np.ones(3))
    assert np.isnan(theta[[0, 2]]).all() and np.isnan(sse[[0, 2]]).all()
    assert np.isfinite(theta[1]).all() and slope[1] < 1e-6
    assert [len(part) for part in sa.constrained_fit(xx[:0], np.zeros((0, 10)), np.zeros(0))] == [0, 0, 0]


def test_series_that_cannot_be_fitted_fall_back(series):
    rng = np.random.default_rng(4)
    demand = series({"short": [3, 4, 5, 6] * 12, "constant": [5] * 300, "good": weekly(300, rng)})
    made = sa.forecast_with_fallback(demand)
    methods = {r.product_id: r.method for r in made.select("product_id", "method").distinct().collect()}
    assert methods == {"short": "SimpleAR", "constant": "SimpleAR", "good": "SARIMA"}
    assert made.where("predicted is null or predicted < 0").count() == 0
    assert made.count() == 90
