"""Registered queries against their SQL on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import check  # noqa: E402
from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402

# Row-level window queries run in tools/check.py; these return few rows.
NAMES = """a1_sql_view a1_report_view a5_partitioned_sink a10_part_demand a10_stored_by_product b2_star_plus b16_simple_case b21_first_products c1_composite_key_join c4_lookup_default
c6_previous_block d7_approx_percentile d11_dataset_profile d12_date_quantile d18_median_ape
d20_scorecard d20_product_results d22_split_summary e19_row_blocks f4_sorted_limit h2_date_add h9_holiday_distance i13_fold_labels i21_fit_conditions
i27_adaptive_fallback i29_model_comparison i30_business_impact i33_spike_alerts j1_weekly_demand j2_year_over_year
j3_stockout_risk j4_inventory_positioning""".split()


@pytest.fixture(scope="module")
def con(folder):
    import duckdb

    connection = duckdb.connect()
    for table in check.TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, folder, con, name):
    df = queries()[name](spark, folder)
    result = con.execute(oracle_sql()[name])
    expected = check.rows_of([d[0] for d in result.description], result.fetchall())
    assert check.rows_of(df.columns, df.collect()) == expected
    assert expected[1]


def test_entry(spark, folder):
    assert entry(spark).count() == 5618


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())
