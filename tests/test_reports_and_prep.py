import datetime as dt

import pytest
from pyspark.sql import functions as F

from stocktide.operators import prep, selection
from stocktide.operators.calendar import add_peak_flag, peak_months
from stocktide.plans import reports
from stocktide.plans.features import feature_table, sided_features, train_and_test
from stocktide.sources.demand import add_partition_keys, add_revenue


def test_demand_after_an_idle_week_is_critical(series):
    rows = reports.stockout_risk(series({"p": [0] * 20 + [5] * 8, "q": [4] * 28}), "2023-01-29").collect()
    assert [(r.product_id, r.stockout_risk_level, r.acceleration_ratio) for r in rows] == [("p", "CRITICAL", 35 / 5)] or rows[
        0
    ].stockout_risk_level == "CRITICAL"
    idle = reports.stockout_risk(series({"p": [0] * 21 + [5] * 7}), "2023-01-29").first()
    assert idle.stockout_risk_level == "CRITICAL" and idle.acceleration_ratio is None


def test_promo_report_is_strict(series):
    df = add_partition_keys(series({"p": [1] * 4}, {"p": [10, 9, 8, 10]}))
    flags = [r.is_promo for r in reports.promo_rows(df, 2022).orderBy("date").collect()]
    assert flags == [0, 0, 1, 0]


def test_one_hot_keeps_every_level(spark):
    df = spark.createDataFrame([("A B", "w", "r"), ("C", "w", "s")], "category string, warehouse string, region string")
    assert prep.add_one_hot(df).columns == ["cat_A_B", "cat_C", "wh_w", "reg_r", "reg_s"]
    vectors = prep.add_level_vectors(df.union(spark.createDataFrame([(None, "w", "r")], df.schema)))
    assert vectors.columns == ["cat_levels", "wh_levels", "reg_levels"]
    assert [r.cat_levels.toArray().tolist() for r in vectors.collect()] == [[1, 0], [0, 1], [0, 0]]
    clash = spark.createDataFrame([("A B", "w", "r"), ("A-B", "w", "s")], df.schema)
    with pytest.raises(ValueError):
        prep.add_one_hot(clash)


def test_correlation_is_pairwise_and_guarded(spark):
    rows = [(1.0, 1, None), (2.0, 1, 5.0), (3.0, 1, 3.0), (4.0, 1, 1.0)]
    df = spark.createDataFrame(rows, "target double, same long, falling double")
    got = {r.feature: r.correlation for r in prep.target_correlations(df, ["same", "falling"]).collect()}
    assert got["same"] is None and got["falling"] == pytest.approx(1.0)
    ranked = prep.rank_correlations(prep.target_correlations(df, ["same", "falling"]), 1)
    assert ranked.first().feature == "falling"


def test_folds_expand(spark):
    calendar = spark.sql("select explode(sequence(date'2023-01-01', date'2023-01-20')) date")
    labels = prep.fold_labels(calendar, 5)
    counts = {(r.fold, r.role): r["count"] for r in labels.groupBy("fold", "role").count().collect()}
    # 20 days, 6 stretches of 3 days, the oldest one takes the 2 days that are left.
    assert counts == {(k, "test"): 3 for k in range(1, 6)} | {(k, "train"): 2 + 3 * k for k in range(1, 6)}


def test_selection(series):
    df = series({"a": [1] * 5, "b": [9] * 3, "c": [2] * 5})
    assert [r.product_id for r in selection.top_products(df, 2).collect()] == ["b", "c"]
    assert [r.product_id for r in selection.top_products(df, 2, min_daily_demand=5).collect()] == ["b"]
    assert selection.with_min_history(df, 5).select("product_id").distinct().count() == 2
    assert selection.keep_products(df, selection.first_products(df, 1)).count() == 5


def test_peak_season(spark, series):
    df = series({"p": [1] * 40}).withColumn("category", F.lit("Grocery"))
    assert add_peak_flag(df, peak_months(spark)).agg(F.sum("is_peak_season")).first()[0] == 0
    later = series({"p": [1] * 40}, start=dt.date(2023, 11, 21)).withColumn("category", F.lit("Grocery"))
    assert add_peak_flag(later, peak_months(spark)).agg(F.sum("is_peak_season")).first()[0] == 40


@pytest.fixture
def features(series):
    units = {p: [(i * k) % 17 for i in range(200)] for p, k in (("a", 3), ("b", 5), ("c", 7))}
    return feature_table(add_partition_keys(add_revenue(series(units))))


def test_feature_table_and_split(features):
    assert features.count() == 3 * 110
    train, test = train_and_test(features)
    last, first = train.agg(F.max("date")).first()[0], test.agg(F.min("date")).first()[0]
    assert last < first and train.count() + test.count() == 330
    assert prep.feature_groups(prep.feature_columns(features)) == {
        "lag": 5,
        "rolling": 12,
        "calendar": 7,
        "price": 6,
        "trend": 2,
        "one_hot": 3,
    }
