import math

import numpy as np
import pandas as pd
import pytest

from stocktide.operators import series as s

from conftest import column


def test_days_since_promo_counts_islands(spark):
    flags = [0, 0, 1, 0, 0, 1, 1, 0]
    rows = [("p", i, f) for i, f in enumerate(flags)]
    df = spark.createDataFrame(rows, "product_id string, date int, is_promo int")
    assert column(s.add_days_since_promo(df), "days_since_promo") == [0, 1, 0, 1, 2, 0, 0, 1]
    assert column(s.add_promo_count(df), "promo_count") == [0, 0, 1, 1, 1, 2, 3, 3]


def test_first_row(series):
    df = s.add_price_features(s.add_rolling_features(s.add_lags(series({"p": [4, 6]}))))
    first = df.orderBy("date").first()
    assert first.demand_lag_7d is None and first.rolling_std_7d is None
    assert first.rolling_mean_30d == 4 and first.price_change_pct == 0
    assert s.add_report_promo(series({"p": [4, 6]})).orderBy("date").first().is_promo == 0


def test_constant_price_has_no_correlation(series):
    df = s.add_price_features(series({"p": range(1, 41)}))
    assert column(df, "price_demand_corr_30d") == [None] * 40


def test_correlation_needs_seven_pairs(series):
    units = [5, 0, 7, 8, 6, 9, 4, 8, 7, 6]
    prices = [10, 11, 10, 12, 11, 10, 12, 13, 11, 10]
    got = column(s.add_price_features(series({"p": units}, {"p": prices})), "price_demand_corr_30d")
    # Missing pairs: the first row has no change before it and row 2 divides by zero.
    assert got[:8] == [None] * 8 and got[8] is not None


def test_window_features_against_pandas(series):
    rng = np.random.default_rng(3)
    units, prices = rng.integers(0, 30, 120), np.round(rng.uniform(5, 20, 120), 2)
    df = s.add_rolling_features(s.add_lags(series({"p": units}, {"p": prices})))
    got = s.add_trend_features(s.add_price_features(df)).orderBy("date").toPandas()
    u, p = pd.Series(units).astype(float), pd.Series(prices)
    change = u.pct_change().replace([np.inf, -np.inf], np.nan)
    level = p / p.rolling(30, min_periods=1).mean()
    expected = {
        "demand_lag_30d": u.shift(30),
        "rolling_std_14d": u.rolling(14, min_periods=1).std(),
        "rolling_max_7d": u.rolling(7, min_periods=1).max(),
        "price_vs_avg_30d": level,
        "price_demand_corr_30d": p.pct_change().fillna(0).rolling(30, min_periods=7).corr(change),
        "trend_30d": u.rolling(7, min_periods=1).mean() / u.rolling(30, min_periods=1).mean() - 1,
    }
    for name, values in expected.items():
        np.testing.assert_allclose(got[name].astype(float), values, rtol=1e-9, atol=1e-9, err_msg=name)
    promo = level < 0.9
    assert list(got.days_since_promo) == list((~promo).groupby(promo.cumsum()).cumcount())


def test_exclude_current_leaves_the_target_out(series):
    df = s.add_rolling(series({"p": [1, 2, 3]}), [7], ["mean"], exclude_current=True)
    assert column(df, "rolling_mean_7d") == [None, 1.0, 1.5]


def test_all_product_windows_share_one_exchange(series):
    df = s.add_trend_features(s.add_price_features(s.add_rolling_features(s.add_lags(series({"p": [1]})))))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1


@pytest.mark.parametrize("n,share,expected", [(30, 0.6, 18), (7, 0.6, 4), (1, 0.6, 0)])
def test_prefix_is_floored(series, n, share, expected):
    marked = s.add_prefix_side(series({"p": [1] * n}), share)
    assert sum(column(marked, "is_prefix")) == expected == math.floor(n * share)
