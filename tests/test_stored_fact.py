"""The fact stored by product, and codes in place of one-hot columns."""

import collections
import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from stocktide.operators import prep, series
from stocktide.registry.scans import bucketed_features
from stocktide.session import new_path
from stocktide.sources import demand, spans, tables


@pytest.fixture(scope="module")
def given(spark):
    """300 order lines, two thirds of them of part 1; part 3 is never sold."""
    lines = [(1 if i % 3 else 2, float(i % 5), i % 4 / 10, dt.datetime(2020, 1, 1 + i * 7 % 28)) for i in range(300)]
    return (
        spark.createDataFrame(lines, "l_partkey long, l_quantity double, l_discount double, l_shipdate timestamp_ntz"),
        spark.createDataFrame(
            [(1, "Brand#1", "SMALL", 100.0), (2, "Brand#1", "SMALL", 50.0), (3, "Brand#2", "LARGE", 10.0)],
            "p_partkey long, p_brand string, p_type string, p_retailprice double",
        ),
        spark.createDataFrame([(1, "AMERICA"), (2, "ASIA")], "r_regionkey int, r_name string"),
        lines,
    )


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def by_key(df):
    return {(r.product_id, r.date): r.asDict() for r in df.collect()}


def test_parts_are_products_of_their_own(given):
    *frames, lines = given
    sales = {(r.product_id, r.date): r for r in demand.daily_part_sales(*frames[:2]).collect()}
    expected = {}
    for part, quantity, discount, at in lines:
        units, cents, n = expected.get((part, at.date()), (0, 0, 0))
        price = 10000 if part == 1 else 5000
        expected[part, at.date()] = (units + int(quantity), cents + price * round((1 - discount) * 100), n + 1)
    assert {k: (r.units, r.paid_price) for k, r in sales.items()} == {
        (f"P{part:010d}", day): (units, cents / n / 10000.0) for (part, day), (units, cents, n) in expected.items()
    }


def test_lines_are_summed_before_they_meet_their_part(given):
    plan = plan_of(demand.daily_part_sales(*given[:2]))
    assert plan.index("Join") < plan.index("partial_sum")  # the plan is printed from the top


@pytest.mark.parametrize("by_part", [False, True])
def test_stored_fact_equals_the_assembled_one(given, by_part):
    stored = demand.store_by_product(*given[:3], by_part=by_part, buckets=3)
    assert by_key(stored) == by_key(demand.assemble(*given[:3], by_part=by_part))


def test_nothing_is_shuffled_over_the_stored_fact(given, spark):
    stored = demand.store_by_product(*given[:3], by_part=True, buckets=3)
    assert "Exchange" not in plan_of(bucketed_features(stored)).replace("BroadcastExchange", "")
    joined = stored.hint("merge").join(stored.groupBy("product_id").agg(F.max("units_sold").alias("top")), "product_id")
    assert "Exchange" not in plan_of(joined)


def test_one_product_is_in_one_bucket(given, spark):
    stored = demand.store_by_product(*given[:3], by_part=True, buckets=3)
    auto = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    spark.conf.set(auto, "false")  # else the plan does not say which buckets it reads
    try:
        assert "SelectedBucketsCount: 1 out of 3" in plan_of(stored.where("product_id = 'P0000000002'"))
    finally:
        spark.conf.unset(auto)


def test_a_stored_fact_is_opened_again(given, spark):
    path = new_path(spark, "by_product")
    stored = demand.store_by_product(*given[:3], path=path, name="fact_written", by_part=True, buckets=2)
    opened = tables.open_by_product(spark, path, "fact_opened", stored.schema, 2)
    assert by_key(opened) == by_key(stored)
    assert "Exchange" not in plan_of(opened.groupBy("product_id").count())


def test_rows_that_lie_anyhow_are_dealt_to_one_file_a_bucket(given, spark):
    fact = demand.assemble(*given[:3], by_part=True).repartition(5)
    stored = tables.write_by_product(fact, new_path(spark, "by_product"), "fact_dealt", 2)
    assert stored.select(F.input_file_name()).distinct().count() <= 2
    assert by_key(stored) == by_key(fact)


def test_partitions_follow_the_rows(given, spark):
    sales = demand.daily_part_sales(*given[:2])
    assert demand.tasks_for(sales, rows=10) == 5  # two parts over 22 days
    assert demand.tasks_for(sales) == 1
    assert demand.tasks_for(sales.limit(0)) == 1
    empty = demand.store_by_product(given[0].limit(0), *given[1:3], by_part=True)
    assert empty.count() == 0 and bucketed_features(empty).count() == 0


def test_codes_follow_the_values_in_order(spark):
    rows = [("b", "w", "r"), ("a", "w", None), (None, "v", "r"), ("é", "w", "q"), ("b", "w", "r")]
    df = spark.createDataFrame(rows, "category string, warehouse string, region string")
    got = [tuple(r) for r in prep.add_level_codes(df.withColumn("n", F.monotonically_increasing_id())).orderBy("n").drop("n").collect()]
    assert got == [(1, 1, 1), (0, 1, -1), (-1, 0, 1), (2, 1, 0), (1, 1, 1)]
    known = prep.level_index(df.limit(1))
    assert prep.add_level_codes(df, known).where("cat_code = -1").count() == 3
    assert prep.add_level_codes(df.limit(0)).count() == 0


def test_wide_catalogues_get_codes_not_columns(spark):
    wide = spark.range(3000).select(F.col("id").cast("string").alias("category"), F.lit("w").alias("warehouse"), F.lit("r").alias("region"))
    with pytest.raises(ValueError, match="add_level_codes"):
        prep.levels_of(wide, prep.ONE_HOT_PREFIXES)
    coded = prep.add_level_codes(wide).agg(F.min("cat_code"), F.max("cat_code"), F.countDistinct("cat_code")).first()
    assert tuple(coded) == (0, 2999, 3000)


def test_nothing_is_sorted_over_the_stored_fact(given, spark):
    stored = demand.store_by_product(*given[:3], by_part=True, buckets=3)
    assert "Sort [" not in plan_of(series.add_rolling(series.add_lags(stored, (7, 365)), (30,), ("max",)))
    assert "Sort [" not in plan_of(bucketed_features(stored))


@pytest.mark.parametrize("exclude_current", [False, True])
def test_extremes_of_parts_are_those_of_the_frame(spark, exclude_current):
    rows = [(f"p{i % 3}", dt.date(2020, 1, 1) + dt.timedelta(days=i // 3), None if i % 11 == 0 else float(i * 7919 % 101)) for i in range(200)]
    df = spark.createDataFrame(rows, "product_id string, date date, units_sold double")
    found = series.add_rolling(df, (1, 2, 7, 14, 30), ("min", "max"), exclude_current=exclude_current)
    whole = {f"{s}{n}": f(F.col("units_sold")).over(series.trailing(n, exclude_current)) for s, f in (("min", F.min), ("max", F.max)) for n in (1, 2, 7, 14, 30)}
    compared = found.withColumns(whole).collect()
    assert len(compared) == 200 and all(r[f"rolling_{s}_{n}d"] == r[f"{s}{n}"] for r in compared for s in ("min", "max") for n in (1, 2, 7, 14, 30))
    # No frame of 30 rows is gone over at each row.
    assert "-29" not in plan_of(series.add_rolling(df, (30,), ("max",)))


@pytest.fixture(scope="module")
def odd(spark):
    """Parts and regions that come twice, a region without a name, brands of no region, and nulls in every column."""
    at = [dt.datetime(2019, 12, 25) + dt.timedelta(days=d) for d in range(20)]
    lines = [(i % 7, float(i % 5), i % 4 / 10, at[i * 7 % 20]) for i in range(70)]
    lines += [(None, 1.0, 0.1, at[0]), (1, None, 0.1, at[3]), (2, 1.0, None, at[4]), (3, 2.0, 0.0, None), (4, 1.0, 0.2, at[19])]
    parts = [(k, f"Brand#{k}", f"T{k % 3}", 10.0 * k) for k in range(1, 6)] + [(1, "Brand#1", "T1", 10.0), (6, None, "T0", 5.0), (0, "Brand#0", None, None)]
    return (
        spark.createDataFrame(lines, "l_partkey long, l_quantity double, l_discount double, l_shipdate timestamp_ntz"),
        spark.createDataFrame(parts, "p_partkey long, p_brand string, p_type string, p_retailprice double"),
        spark.createDataFrame([(0, "AFRICA"), (1, "AMERICA"), (2, None), (3, "ASIA"), (3, "ASIA")], "r_regionkey int, r_name string"),
    )


@pytest.mark.parametrize("by_part", [False, True])
@pytest.mark.parametrize("rows", [1_000_000, 40])
def test_columns_written_are_the_rows_of_the_assembled_fact(odd, spark, monkeypatch, by_part, rows):
    monkeypatch.setattr(spans, "ROWS_PER_GROUP", rows)
    path = new_path(spark, "by_product")
    stored = demand.store_by_product(*odd, path=path, by_part=by_part, buckets=3)
    expected = demand.assemble(*odd, by_part=by_part)
    found = collections.Counter(map(tuple, stored.collect()))
    assert found == collections.Counter(map(tuple, expected.collect())) and found
    assert [f.dataType for f in stored.schema] == [f.dataType for f in expected.schema]
    assert max(found.values()) > 1  # regions that come twice
    files = collections.Counter()
    for file in stored.select(F.input_file_name()).distinct().collect():
        table = pq.ParquetFile(file[0].removeprefix("file://")).read(["product_id", "date"])
        keys = list(zip(*(table[c].to_pylist() for c in table.column_names)))
        assert keys == sorted(keys)
        files[file[0].rpartition("_")[2]] += 1
    assert set(files.values()) == {1}
    for product in {r[0] for r in found}:  # reads that product's bucket alone
        assert stored.where(F.col("product_id") == product).count() == sum(n for r, n in found.items() if r[0] == product)


def test_other_folders_get_the_same_table(odd, monkeypatch):
    by_columns = demand.store_by_product(*odd, by_part=True, buckets=2)
    monkeypatch.setattr(demand, "shared_folder", lambda spark, path: None)
    by_rows = demand.store_by_product(*odd, by_part=True, buckets=2)
    assert by_columns.schema == by_rows.schema
    assert collections.Counter(map(tuple, by_columns.collect())) == collections.Counter(map(tuple, by_rows.collect()))


def test_shared_folders_are_those_of_the_machine(spark):
    assert spans.shared_folder(spark, "/tmp/a b") == spans.shared_folder(spark, "file:/tmp/a b") == "/tmp/a b"
    assert spans.shared_folder(spark, "hdfs://lake/a") is None


def test_nothing_is_written_over(given, spark):
    path = new_path(spark, "by_product")
    stored = demand.store_by_product(*given[:3], path=path, name="fact_kept", by_part=True, buckets=2)
    n = stored.count()
    with pytest.raises(FileExistsError):
        demand.store_by_product(*given[:3], path=path, name="fact_other", by_part=True, buckets=2)
    with pytest.raises(ValueError, match="fact_kept"):
        demand.store_by_product(*given[:3], name="fact_kept", by_part=True, buckets=2)
    assert spark.table("fact_kept").count() == n > 0


def test_spans_are_cut_between_products_and_buckets(monkeypatch):
    monkeypatch.setattr(spans, "ROWS_PER_GROUP", 5)
    rows = [("a", 0, 3), ("a", 4, 6), ("b", 0, 6), ("c", 0, 0), ("c", 1, 1), ("d", 0, 9)]
    table = pa.table({"product_id": [r[0] for r in rows], "from_day": [r[1] for r in rows], "until_day": [r[2] for r in rows], "bucket": [0, 0, 0, 1, 1, 1]})
    for size in range(1, 7):
        pieces = [(bucket, piece["product_id"].to_pylist()) for bucket, piece in spans._pieces(iter(table.to_batches(size)))]
        assert [p for _, piece in pieces for p in piece] == [r[0] for r in rows]
        assert all({"a": 0, "b": 0, "c": 1, "d": 1}[p] == bucket for bucket, piece in pieces for p in piece)
        assert sorted({p for _, piece in pieces for p in set(piece)}) == sorted(p for _, piece in pieces for p in set(piece))


@pytest.mark.parametrize("codec, written", [("zstd", "ZSTD"), ("uncompressed", "UNCOMPRESSED")])
def test_files_have_the_codec_of_the_session(given, spark, codec, written):
    key = "spark.sql.parquet.compression.codec"
    spark.conf.set(key, codec)
    try:
        stored = demand.store_by_product(*given[:3], by_part=True, buckets=2)
    finally:
        spark.conf.unset(key)
    file = stored.select(F.input_file_name()).first()[0].removeprefix("file://")
    assert pq.ParquetFile(file).metadata.row_group(0).column(0).compression == written
    assert stored.count() == 44  # two parts over 22 days
