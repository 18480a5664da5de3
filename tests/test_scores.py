import numpy as np
import pytest

from stocktide.operators import scores
from stocktide.operators.quantile import date_quantile, exact_quantile


@pytest.mark.parametrize("q", [0.0, 0.2, 0.5, 0.9, 1.0])
@pytest.mark.parametrize("kind", ["distinct", "one value holds a third", "few"])
def test_exact_quantile_against_numpy(spark, q, kind):
    rng = np.random.default_rng(7)
    values = rng.lognormal(size=5000) if kind != "few" else np.array([3.0, 1.0])
    if kind == "one value holds a third":
        values[: len(values) // 3] = 1.0
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double").repartition(4)
    # Few stretches, so that the range narrows several times.
    got = exact_quantile(df, "x", q, bins=16).first().quantile
    assert got == pytest.approx(np.quantile(values, q), rel=1e-12)


def test_date_quantile_falls_between_days(spark):
    df = spark.sql("select explode(sequence(date'1970-01-01', date'1970-01-03')) date")
    assert date_quantile(df).first().split_day == pytest.approx(1.6)


def test_metrics_skip_zero_actuals(spark):
    df = spark.createDataFrame([(0, 5.0), (10, 8.0), (20, 30.0), (40, 40.0)], "actual long, predicted double")
    row = scores.full_metrics(df, "actual", "predicted").first()
    a, p = np.array([0, 10, 20, 40.0]), np.array([5, 8, 30, 40.0])
    ape = np.abs((a[1:] - p[1:]) / a[1:]) * 100
    assert row.mape == pytest.approx(ape.mean())
    assert row.mdape == pytest.approx(np.median(ape))
    assert row.rmse == pytest.approx(np.sqrt(np.mean((a - p) ** 2)))
    assert row.mae == pytest.approx(np.abs(a - p).mean())
    assert row.r2 == pytest.approx(1 - ((a - p) ** 2).sum() / ((a - a.mean()) ** 2).sum())


def test_all_zero_actuals(spark):
    df = spark.createDataFrame([("x", 0, 5.0), ("x", 0, 8.0)], "product_id string, actual long, predicted double")
    row = df.agg(
        scores.mape("actual", "predicted").alias("plain"),
        scores.mape_or_zero("actual", "predicted").alias("zero"),
        scores.r2("actual", "predicted").alias("r2"),
    ).first()
    assert (row.plain, row.zero, row.r2) == (None, 0.0, 0.0)
    assert scores.score_summary(df).first().overall_mape is None


def test_model_scores_and_gain(spark):
    df = spark.createDataFrame([(10, 8.0, 11.0, 10.0), (20, 25.0, 22.0, 20.5)], "actual long, a double, b double, e double")
    table = {r.model: r for r in scores.model_scores(df, {"a": "a", "b": "b", "ensemble": "e"}).collect()}
    assert table["a"].mae == 3.5 and table["ensemble"].mape == pytest.approx(1.25)
    row = scores.compare_models(df, {"a": "a", "b": "b"}, "e").first()
    assert row.best_single_mape == pytest.approx(10.0) and row.improvement_pct == pytest.approx(87.5)
