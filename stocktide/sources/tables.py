"""Readers and writers for parquet and CSV tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def write_by_month(df: DataFrame, path: str) -> None:
    """Parquet partitioned by year and month.

    The rebalance hint lets adaptive execution split a month that is larger
    than one task should write and merge the small ones, so files get an even
    size whatever the months hold.
    """
    (
        df.hint("rebalance", F.col("year"), F.col("month"))
        .write.mode("overwrite")
        .partitionBy("year", "month")
        .parquet(path)
    )


def replace_months(df: DataFrame, path: str) -> None:
    """Write the months that ``df`` has rows of, and leave the table's other months as they are.

    A second run over a month replaces that month alone. The option holds for
    this write, whatever the session's setting is.
    """
    (
        df.hint("rebalance", F.col("year"), F.col("month"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "month")
        .parquet(path)
    )


def read_by_month(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The partitioned table; ``year`` and ``month`` predicates prune folders."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_by_product(df: DataFrame, path: str, name: str, buckets: int, placed: bool = False) -> DataFrame:
    """Table ``name`` at ``path`` in buckets of products, each sorted by product and day.

    Rows are dealt to the buckets first, so that a bucket is one file; ``placed``
    says that they already lie so, by ``product_id`` in as many partitions.
    """
    rows = df if placed else df.repartition(buckets, "product_id")
    rows.write.option("path", path).bucketBy(buckets, "product_id").sortBy("product_id", "date").saveAsTable(name)
    return _in_order(df.sparkSession, name)


def _in_order(spark: SparkSession, name: str) -> DataFrame:
    """The table, whose windows and sums by product need no sort where each bucket is one file.

    Spark looks at the files before it trusts the order, and sorts where a
    bucket has several; it does so only with this setting.
    """
    spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")
    return spark.table(name)


def open_by_product(spark: SparkSession, path: str, name: str, schema: T.StructType, buckets: int) -> DataFrame:
    """Declare the table that an earlier application wrote with ``write_by_product``."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet "
        f"CLUSTERED BY (product_id) SORTED BY (product_id, date) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return _in_order(spark, name)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header line; no index column exists in Spark."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header line and given types; a malformed row is an error."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV whose types Spark infers, at the price of a second pass."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)
