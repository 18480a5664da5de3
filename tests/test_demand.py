import datetime as dt

import pytest
from pyspark.sql import functions as F

from stocktide.functions.dates import since
from stocktide.schema import RAW_DEMAND
from stocktide.session import materialize, new_path
from stocktide.sources import demand, tables

D = dt.date


def lines(spark, rows):
    schema = "l_partkey long, l_quantity double, l_discount double, l_shipdate timestamp_ntz"
    return spark.createDataFrame([(k, q, d, dt.datetime(*at)) for k, q, d, at in rows], schema)


@pytest.fixture
def catalogue(spark):
    parts = spark.createDataFrame(
        [(1, "Brand#1", "SMALL", 100.0), (2, "Brand#7", "LARGE", 50.0)],
        "p_partkey long, p_brand string, p_type string, p_retailprice double",
    )
    regions = spark.createDataFrame([(1, "AMERICA"), (2, "ASIA")], "r_regionkey int, r_name string")
    return parts, regions


def test_gaps_are_filled_with_the_last_price(spark, catalogue):
    sold = lines(spark, [(1, 3.0, 0.0, (2020, 1, 2)), (1, 1.0, 0.1, (2020, 1, 2)), (1, 5.0, 0.1, (2020, 1, 4)), (2, 2.0, 0.0, (2020, 1, 5))])
    fact = demand.assemble(sold, *catalogue)
    first = fact.where("product_id = 'Brand#1/SMALL'").orderBy("date").collect()
    assert [(r.date.day, r.units_sold, r.price) for r in first] == [
        (2, 4, 95.0),
        (3, 0, 95.0),
        (4, 5, 90.0),
        (5, 0, 90.0),
    ]
    second = fact.where("product_id = 'Brand#7/LARGE'").orderBy("date").collect()
    assert [(r.date.day, r.units_sold, r.price, r.warehouse) for r in second] == [
        (2, 0, 50.0, "WH-ASIA"),
        (3, 0, 50.0, "WH-ASIA"),
        (4, 0, 50.0, "WH-ASIA"),
        (5, 2, 50.0, "WH-ASIA"),
    ]
    assert {f.name for f in fact.schema} == set(RAW_DEMAND.names)


def test_a_hot_product_is_summed_before_the_shuffle(spark, catalogue):
    sold = lines(spark, [(1, 1.0, 0.0, (2020, 1, 1 + i % 3)) for i in range(3000)] + [(2, 1.0, 0.0, (2020, 1, 1))])
    sales = demand.daily_sales(sold, catalogue[0])
    plan = sales._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_sum") > plan.index("Exchange hashpartitioning(p_brand")
    assert sorted(r.units for r in sales.collect()) == [1, 1000, 1000, 1000]


def test_fact_is_unique_per_product_and_day(spark, folder):
    fact = demand.raw_demand(spark, folder)
    checked = fact.agg(
        F.count("*").alias("n"), F.countDistinct("product_id", "date").alias("keys"), F.min("units_sold").alias("low")
    ).first()
    assert checked.n == checked.keys == 264_894
    assert checked.low == 0


def test_windows_reuse_the_partitioning_of_the_fact(spark, folder):
    from stocktide.operators.series import add_lags

    plan = add_lags(demand.raw_demand(spark, folder))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(product_id") == 1


def test_month_table_prunes_folders(spark, series):
    fact = demand.add_partition_keys(demand.add_revenue(series({"p": range(800)})))
    path = new_path(spark, "fact")
    tables.write_by_month(fact, path)
    read = tables.read_by_month(spark, path)
    recent = since(read, F.lit(D(2024, 6, 1)))
    scan = [line for line in recent._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line][0]
    assert "PartitionFilters: [isnotnull(year" in scan and "2024" in scan
    assert recent.count() == fact.where("date >= '2024-06-01'").count()


def test_csv_round_trip(spark, series):
    fact = demand.add_partition_keys(demand.add_revenue(series({"p": [1, 0, 3]})))
    path = new_path(spark, "csv")
    tables.write_csv(fact.select(*RAW_DEMAND.names), path)
    typed = tables.read_csv(spark, path, RAW_DEMAND)
    assert typed.exceptAll(fact.select(*RAW_DEMAND.names)).count() == 0
    assert dict(tables.read_csv_inferred(spark, path).dtypes)["date"] == "date"


def test_materialize_keeps_rows(spark, series):
    df = series({"p": [1, 2, 3]})
    stored = materialize(df, "stored")
    assert stored.schema.names == df.schema.names and stored.exceptAll(df).count() == 0
