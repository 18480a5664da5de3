"""Choosing products and rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def product_volumes(df: DataFrame) -> DataFrame:
    return df.groupBy("product_id").agg(
        F.sum("units_sold").alias("total_units"), F.avg("units_sold").alias("mean_demand")
    )


def top_products(df: DataFrame, n: int, min_daily_demand: float | None = None) -> DataFrame:
    """The ``n`` products with the most units, among those with enough daily demand."""
    volumes = product_volumes(df)
    if min_daily_demand is not None:
        volumes = volumes.where(F.col("mean_demand") >= min_daily_demand)
    return volumes.orderBy(F.desc("total_units"), "product_id").limit(n)


def first_products(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` distinct product ids in their order."""
    return df.select("product_id").distinct().orderBy("product_id").limit(n)


def keep_products(df: DataFrame, chosen: DataFrame) -> DataFrame:
    """Rows of the chosen products; other columns of ``chosen`` are not added."""
    return df.join(chosen.select("product_id"), "product_id", "left_semi")


def with_min_history(df: DataFrame, days: int = 90) -> DataFrame:
    """Rows of products that have at least ``days`` rows."""
    n = F.count("*").over(Window.partitionBy("product_id"))
    return df.withColumn("_n", n).where(F.col("_n") >= days).drop("_n")
