import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stocktide.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", cores=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    if not os.path.isdir(SMALL):
        pytest.skip("the given tables are not here")
    return SMALL


@pytest.fixture
def series(spark):
    """Builds a demand table from {product: [units]} and optional prices."""

    def build(units, prices=None, start=dt.date(2023, 1, 1)):
        rows = []
        for product, values in units.items():
            for i, value in enumerate(values):
                price = prices[product][i] if prices else 10.0
                rows.append((product, start + dt.timedelta(days=i), int(value), float(price), "c", "w", "r"))
        schema = "product_id string, date date, units_sold long, price double, category string, warehouse string, region string"
        return spark.createDataFrame(rows, schema)

    return build


def column(df, name, order="date"):
    return [row[name] for row in df.orderBy(order).collect()]
