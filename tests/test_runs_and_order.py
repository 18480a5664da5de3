"""Numbering, re-run months, nearest events, short series, rolling origins and written runs."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stocktide.operators.calendar import add_days_to_nearest
from stocktide.operators.ensemble import align, ensemble_output
from stocktide.operators.numbering import add_place
from stocktide.operators.simple_ar import recent_level, simple_ar
from stocktide.plans.forecasting import ensemble_run, product_run, rolling_forecasts, write_run
from stocktide.settings import DemandSettings
from stocktide.sources.demand import add_partition_keys
from stocktide.sources.tables import read_by_month, read_csv_inferred, replace_months

DAY = dt.date(2020, 1, 1)


def test_places_follow_the_order(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(1000).select(F.xxhash64("id").alias("x"), "id").orderBy("x", "id")
        placed = add_place(df)
        rows = sorted(placed.collect(), key=lambda r: r.place)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [r.place for r in rows] == list(range(1000))
    assert [r.x for r in rows] == sorted(r.x for r in rows)
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "Exchange SinglePartition" not in plan.split("HashAggregate")[-1]  # the rows themselves stay where they are
    assert add_place(df.where("false")).collect() == []


def test_a_second_run_replaces_its_months_alone(spark, tmp_path):
    def rows(units, months):
        data = [(f"p{i}", dt.date(2023, m, 1 + i), units) for m in months for i in range(3)]
        return add_partition_keys(spark.createDataFrame(data, "product_id string, date date, units_sold long"))

    path = str(tmp_path / "demand")
    replace_months(rows(1, (1, 2, 3)), path)
    replace_months(rows(5, (2,)), path)
    replace_months(rows(7, (4,)), path)
    got = {(r.month): (r.n, r.u) for r in read_by_month(spark, path).groupBy("month").agg(F.count("*").alias("n"), F.sum("units_sold").alias("u")).collect()}
    assert got == {1: (3, 3), 2: (3, 15), 3: (3, 3), 4: (3, 21)}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


@pytest.mark.parametrize("n_events", [0, 1, 7, 3000])
def test_nearest_event_against_all_events(spark, n_events):
    random.seed(n_events)
    events = [DAY + dt.timedelta(days=random.randint(-9000, 9000)) for _ in range(n_events)]
    days = [DAY + dt.timedelta(days=random.randint(-12000, 12000)) for _ in range(200)] + events[:5]
    frame = lambda dates, name: spark.createDataFrame([(d,) for d in [*dates, None]], f"{name} date")
    got = add_days_to_nearest(frame(days, "date"), frame(events, "holiday")).collect()
    expected = [(d, min((abs((d - e).days) for e in events), default=None)) for d in days] + [(None, None)]
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)


def test_nearest_of_many_events(spark):
    """A hundred thousand event rows, of which many fall on one day."""
    events = spark.range(100_000).select(F.date_add(F.lit(DAY), (F.col("id") % 997 * 3).cast("int")).alias("holiday"))
    days = spark.range(3000).select(F.date_add(F.lit(DAY), F.col("id").cast("int")).alias("date"))
    got = {(r.date - DAY).days: r.days_to_holiday for r in add_days_to_nearest(days, events).collect()}
    assert all(got[i] == (0 if i % 3 == 0 else 1) if i < 2988 else got[i] == i - 2988 for i in range(3000))


def test_short_series_repeat_what_they_have(series):
    made = simple_ar(series({"five": list(range(1, 36)), "one": [4] + [0] * 30, "none": [2] * 30, "fewer": [2] * 9}))
    got = {}
    for r in made.orderBy("product_id", "step").collect():
        got.setdefault(r.product_id, []).append(r.predicted)
    train = [1, 2, 3, 4, 5]
    assert got["five"] == pytest.approx([0.4 * train[h % 5] + 0.6 * 3 for h in range(30)])
    assert got["one"] == pytest.approx([4.0] * 30)
    assert got["none"] == [None] * 30 and set(got["fewer"]) == {None}


def weekly(n, seed):
    rng = np.random.default_rng(seed)
    return np.round(np.array([20, 22, 25, 30, 45, 60, 50])[np.arange(n) % 7] + rng.normal(0, 2, n)).clip(0)


def test_each_origin_sees_only_what_came_before(series):
    units = weekly(400, 1)
    rolled = {(r.origin, r.step): r for r in rolling_forecasts(series({"p": units}), origins=2).collect()}
    assert len(rolled) == 60 and [rolled[0, s].actual for s in range(1, 31)] == units[340:370].tolist()
    changed = np.r_[units[:370], np.full(30, 999)]
    again = {(r.origin, r.step): r for r in rolling_forecasts(series({"p": changed}), origins=2).collect()}
    assert all(again[k].predicted == pytest.approx(rolled[k].predicted) for k in rolled)


def test_the_adaptive_step_changes_a_weight_over_real_forecasts(series):
    """The flat mean fails on a strong week, so the block after it trusts the seasonal model."""
    demand = series({f"p{i}": weekly(430, i) for i in range(2)})
    first = rolling_forecasts(demand, origins=2)
    points = align(first, recent_level(demand, 60)).cache()
    out = ensemble_output(points)
    weight = (F.col("ensemble_forecast") - F.col("rf_forecast")) / (F.col("arima_forecast") - F.col("rf_forecast"))
    nth = F.row_number().over(Window.partitionBy("product_id").orderBy("date"))
    late = out.withColumn("nth", nth).where("nth > 30 and abs(arima_forecast - rf_forecast) > 5").select(F.avg(weight)).first()[0]
    assert late == pytest.approx(0.8)


def test_runs_with_results_and_files(spark, series, tmp_path):
    demand = series({f"p{i}": weekly(400, i) for i in range(3)} | {"small": [0] * 400})
    run = product_run(demand, s=DemandSettings(n_products=3, min_daily_demand=5.0))
    assert {r.product_id for r in run["results"].collect()} == {"p0", "p1", "p2"}
    assert run["forecasts"].count() == 90 and run["summary"].first().products == 3
    points = align(run["forecasts"], recent_level(demand)).cache()
    write_run(ensemble_run(points) | run, str(tmp_path))
    written = read_csv_inferred(spark, str(tmp_path / "output"))
    assert written.count() == 90 and written.columns == ["product_id", "date", "actual", "arima_forecast", "rf_forecast", "ensemble_forecast", "ensemble_error_pct"]
    assert read_csv_inferred(spark, str(tmp_path / "summary")).first().products == 3
