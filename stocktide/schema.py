"""Explicit schemas of the tables that are read and written."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_DEMAND = T.StructType(
    [
        T.StructField("product_id", T.StringType(), False),
        T.StructField("date", T.DateType(), False),
        T.StructField("units_sold", T.LongType(), False),
        T.StructField("price", T.DoubleType(), False),
        T.StructField("category", T.StringType(), False),
        T.StructField("warehouse", T.StringType(), False),
        T.StructField("region", T.StringType(), False),
        T.StructField("revenue", T.DoubleType(), False),
        T.StructField("year", T.IntegerType(), False),
        T.StructField("month", T.IntegerType(), False),
        T.StructField("week", T.IntegerType(), False),
    ]
)

FORECAST = T.StructType(
    [
        T.StructField("product_id", T.StringType(), False),
        T.StructField("date", T.DateType(), False),
        T.StructField("step", T.IntegerType(), False),
        T.StructField("actual", T.LongType(), True),
        T.StructField("predicted", T.DoubleType(), True),
        T.StructField("method", T.StringType(), True),
    ]
)

FEATURE_IMPORTANCE = T.StructType(
    [
        T.StructField("feature", T.StringType(), False),
        T.StructField("importance", T.DoubleType(), False),
    ]
)
