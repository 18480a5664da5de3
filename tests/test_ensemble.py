import datetime as dt

import pytest
from pyspark.sql import functions as F

from stocktide.operators import alerts, ensemble as en


@pytest.fixture
def points(spark):
    def build(rows):
        data = [("p", dt.date(2023, 1, 1) + dt.timedelta(days=i), a, float(x), float(y)) for i, (a, x, y) in enumerate(rows)]
        return spark.createDataFrame(data, "product_id string, date date, actual long, arima_forecast double, rf_forecast double")

    return build


def test_grid_finds_the_better_model(points):
    scores = en.grid_scores(points([(10, 10, 20)] * 5))
    assert [r.weight_pct for r in scores.orderBy("weight_pct").collect()] == list(range(20, 81, 5))
    assert en.best_weight(scores).first().weight_pct == 80


def test_ties_keep_the_smallest_first_weight(points):
    # Forecasts of 0 give the same score under every weight, without rounding noise.
    assert en.best_weight(en.grid_scores(points([(10, 0, 0)] * 5))).first().weight_pct == 20


def test_fallback_applies_to_the_next_block_only(points):
    rows = [(100, 110, 104)] * 30 + [(100, 100, 104)] * 30 + [(100, 100, 100)] * 5
    weights = [r.weight_pct for r in en.add_adaptive_weight(points(rows), 50).orderBy("date").collect()]
    assert weights == [50] * 30 + [20] * 30 + [80] * 5


def test_output_is_floored_and_scored(points):
    df = en.add_error_pct(en.add_ensemble(points([(0, -5, -5), (10, 8, 8)]), 40)).orderBy("date").collect()
    assert [r.ensemble_forecast for r in df] == [0.0, 8.0]
    assert df[0].ensemble_error_pct == 0.0 and df[1].ensemble_error_pct == pytest.approx(20)


def test_alignment_is_by_key(spark):
    schema = "product_id string, date int, actual long, predicted double"
    a = spark.createDataFrame([("p", 1, 5, 1.0), ("p", 2, 6, 2.0)], schema)
    b = spark.createDataFrame([("p", 2, 6, 9.0), ("q", 1, 7, 8.0)], schema)
    assert [tuple(r) for r in en.align(a, b).collect()] == [("p", 2, 6, 2.0, 9.0)]


def test_impact(points):
    df = points([(10, 0, 0), (20, 0, 0)]).withColumn("ensemble_forecast", F.when(F.col("actual") == 10, 5.0).otherwise(20.0))
    row = en.business_impact(df).first()
    assert row.stockout_risk_pct == 50
    assert row.daily_excess_inventory_cost == pytest.approx(2.5 * 45 * 0.02)
    assert row.annualized_margin_impact == pytest.approx(15 * 45 * 0.12 * 0.35 * 365)


def test_degradation_alerts(points):
    df = points([(10, 0, 0)]).withColumn("ensemble_forecast", F.lit(5.0))
    assert {r.alert for r in alerts.degradation_alerts(df).collect()} == {"forecast_degradation", "low_coverage"}


def test_spike_alert(series):
    rows = alerts.spike_alerts(series({"p": [5, 6, 5, 6, 5, 6, 50, 5]})).collect()
    assert [(r.date.day, r.value) for r in rows] == [(7, 50.0)]
