"""The demand fact: one row per product line and calendar day.

``raw_demand`` is assembled from order lines in three steps.

1. Order lines are joined to their part and summed per product line and day.
   The sum is combined on the map side, so a product line that holds a third of
   all order lines reaches the shuffle as at most one row per day and task.
   The join has no broadcast hint: Spark compares the size of ``part`` with the
   broadcast threshold and otherwise sort-merges, where adaptive execution
   splits a hot part.
2. Days without a sale are filled from the gap to the next sale, within one
   window per product. This needs no calendar join, and the window holds at most
   one row per day of the calendar.
3. Partition keys and revenue are derived.

The result stays hash-partitioned by product, so that later windows over
``product_id`` need no further exchange. ``store_by_product`` keeps that on disk:
a table in buckets of products, whose readers need no exchange either.

A product is a line (brand and type) or, with ``by_part``, each part by itself.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dates
from ..operators.prep import ONE_HOT_PREFIXES, level_index, levels_of
from ..session import materialize, new_path
from .spans import shared_folder, write_spans
from .tables import open_by_product, read_table, write_by_product

#: Rows of the filled fact that one task or bucket is sized for.
ROWS_PER_TASK = 2_000_000


def sale_span(lines: DataFrame) -> DataFrame:
    """One row: first and last day of the order lines."""
    shipped = F.to_date("l_shipdate")
    return lines.agg(F.min(shipped).alias("first_day"), F.max(shipped).alias("last_day"))


def spine(span: DataFrame) -> DataFrame:
    """Every day of the span, one row each."""
    return span.select(F.explode(F.sequence("first_day", "last_day")).alias("date"))


def _region_no() -> Column:
    """Each brand belongs to one region: its number modulo five."""
    return F.pmod(F.substring_index("p_brand", "#", -1).cast("int"), F.lit(5))


def _add_region(df: DataFrame, regions: DataFrame) -> DataFrame:
    """Region and its warehouse in place of the region number; the names are made once per region, not per row."""
    warehouse = F.concat(F.lit("WH-"), "r_name").alias("warehouse")
    named = regions.select(F.col("r_regionkey").alias("region_no"), F.col("r_name").alias("region"), warehouse)
    return df.join(named, "region_no").drop("region_no")


def _with_regions(sales: DataFrame, regions: DataFrame) -> DataFrame:
    """``regions``, the list of region and warehouse that ``_add_region`` finds, beside each row.

    The rows stay one each, so this can go before they are dealt by product; a
    join after that would deal them by region where it isn't a broadcast.
    """
    named = F.struct(F.col("r_name").alias("region"), F.concat(F.lit("WH-"), "r_name").alias("warehouse"))
    listed = regions.groupBy(F.col("r_regionkey").alias("region_no")).agg(F.collect_list(named).alias("regions"))
    return sales.join(listed, "region_no", "left").drop("region_no")


def daily_sales(lines: DataFrame, parts: DataFrame) -> DataFrame:
    """Units and mean paid price per product line and day with a sale.

    Prices are summed as whole numbers (cents times percent paid), so the mean
    does not depend on the order of the rows. ``rint`` is used because ``round``
    on doubles goes through decimals row by row.
    """
    list_cents = F.rint(F.col("p_retailprice") * 100).cast("long")
    paid_pct = F.rint((1 - F.col("l_discount")) * 100).cast("long")
    return (
        lines.select("l_partkey", "l_quantity", "l_discount", F.to_date("l_shipdate").alias("date"))
        .join(
            parts.select("p_partkey", "p_brand", "p_type", "p_retailprice"),
            F.col("l_partkey") == F.col("p_partkey"),
        )
        .groupBy("p_brand", "p_type", "date")
        .agg(
            F.sum(F.col("l_quantity").cast("long")).alias("units"),
            (F.sum(list_cents * paid_pct).cast("double") / F.count("*") / 10000.0).alias("paid_price"),
        )
        .select(
            F.concat_ws("/", "p_brand", "p_type").alias("product_id"),
            F.col("p_type").alias("category"),
            _region_no().alias("region_no"),
            "date",
            "units",
            "paid_price",
        )
    )


def daily_part_sales(lines: DataFrame, parts: DataFrame) -> DataFrame:
    """Units and mean paid price per part and day with a sale, each part a product of its own.

    Order lines are summed before they meet their part, so a part with a third
    of all lines reaches the join as one row per day. Its list price is the same
    in all of them and multiplies the sum.
    """
    daily = (
        lines.groupBy("l_partkey", F.to_date("l_shipdate").alias("date"))
        .agg(
            F.sum(F.col("l_quantity").cast("long")).alias("units"),
            F.sum(F.rint((1 - F.col("l_discount")) * 100).cast("long")).alias("paid_pct"),
            F.count("*").alias("n"),
        )
    )
    list_cents = F.rint(F.col("p_retailprice") * 100).cast("long")
    return daily.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.format_string("P%010d", "p_partkey").alias("product_id"),
        F.col("p_type").alias("category"),
        _region_no().alias("region_no"),
        "date",
        "units",
        ((list_cents * F.col("paid_pct")).cast("double") / F.col("n") / 10000.0).alias("paid_price"),
    )


def tasks_for(sales: DataFrame, rows: int = ROWS_PER_TASK) -> int:
    """Tasks of ``rows`` rows that the filled fact needs: products times days, counted on the days with a sale."""
    days = F.datediff(F.max("date"), F.min("date")) + 1
    size = sales.agg(F.approx_count_distinct("product_id").alias("products"), F.coalesce(days, F.lit(0)).alias("days")).first()
    return max(1, -(-size.products * size.days // rows))


def fill_days(sales: DataFrame, first_day: Column, last_day: Column, partitions: int | None = None) -> DataFrame:
    """One row per product and day, from rows that exist only on days with a sale.

    Units of a filled day are 0. Its price is the last paid price, or the first
    one for days before any sale.

    Filling multiplies the rows and every later window works on the result, so
    the exchange gets its number of ``partitions`` outright (the session's number
    of shuffle partitions if none is given): adaptive execution would merge
    partitions by the few bytes that go in.
    """
    # Whole numbers: a sequence of dates goes through time stamps and the time zone, day by day.
    spans = day_spans(sales, first_day, last_day, partitions)
    filled = spans.withColumn("filled_day", F.explode(F.sequence("from_day", "until_day")))
    filled = filled.withColumn("filled_day", F.date_from_unix_date("filled_day"))
    return filled.select(
        "product_id",
        F.col("filled_day").alias("date"),
        F.when(F.col("filled_day") == F.col("date"), F.col("units")).otherwise(F.lit(0)).alias("units_sold"),
        F.col("paid_price").alias("price"),
        *[c for c in sales.columns if c not in ("product_id", "date", "units", "paid_price")],
    )


def day_spans(sales: DataFrame, first_day: Column, last_day: Column, partitions: int | None = None) -> DataFrame:
    """The days that each row of ``sales`` fills, its own and those up to the next sale, as numbers from ``from_day`` to ``until_day``."""
    if partitions is None:
        partitions = _session_partitions(sales.sparkSession)
    sales = sales.repartition(partitions, "product_id")
    series = Window.partitionBy("product_id").orderBy("date")
    gaps = sales.withColumns(
        {
            "until": F.coalesce(F.date_sub(F.lead("date").over(series), 1), last_day),
            "nth": F.row_number().over(series),
        }
    )
    start = F.when(F.col("nth") == 1, first_day).otherwise(F.col("date"))
    return gaps.select(*sales.columns, F.unix_date(start).alias("from_day"), F.unix_date("until").alias("until_day"))


def _session_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def add_revenue(df: DataFrame) -> DataFrame:
    return df.withColumn("revenue", F.col("units_sold") * F.col("price"))


def add_partition_keys(df: DataFrame) -> DataFrame:
    """Year, month and ISO week of the date."""
    date = F.col("date")
    return df.withColumns({"year": F.year(date), "month": F.month(date), "week": dates.iso_week(date)})


def assemble(
    lines: DataFrame, parts: DataFrame, regions: DataFrame, by_part: bool = False, partitions: int | None = None
) -> DataFrame:
    """The whole fact with product attributes, revenue and partition keys.

    The daily sums are written once: the order lines are read for them alone,
    and the first and last day come from the sums. Unless ``partitions`` says
    otherwise, there are as many as the filled rows need, and no fewer than the
    session's number of shuffle partitions.
    """
    return _filled(_daily(lines, parts, by_part), regions, partitions)


def _daily(lines: DataFrame, parts: DataFrame, by_part: bool) -> DataFrame:
    return materialize((daily_part_sales if by_part else daily_sales)(lines, parts), "daily_sales")


def _filled(sales: DataFrame, regions: DataFrame, partitions: int | None) -> DataFrame:
    if partitions is None:
        partitions = max(_session_partitions(sales.sparkSession), tasks_for(sales))
    filled = fill_days(sales, *_ends(sales), partitions)
    fact = _add_region(filled, regions).select(
        "product_id", "date", "units_sold", "price", "category", "warehouse", "region"
    )
    return add_partition_keys(add_revenue(fact))


def _ends(sales: DataFrame) -> tuple[Column, Column]:
    """First and last day with a sale."""
    span = sales.agg(F.min("date").alias("first_day"), F.max("date").alias("last_day"))
    return span.select("first_day").scalar(), span.select("last_day").scalar()


def store_by_product(
    lines: DataFrame,
    parts: DataFrame,
    regions: DataFrame,
    path: str | None = None,
    name: str | None = None,
    by_part: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """The fact as a stored table in buckets of products, sorted by product and day.

    Days are filled in as many partitions as there are buckets, dealt by the same
    hash, so each task writes one file and nothing is shuffled for the write. In a
    shared folder tasks fill and write by whole columns (``spans``), elsewhere as
    Spark's rows; the table is the same.
    Windows, sums and joins by product over the table then need no exchange, and a
    filter on one product reads one bucket. By default there are as many buckets
    as partitions in ``assemble``, up to the most that the session allows.
    """
    spark = lines.sparkSession
    sales = _daily(lines, parts, by_part)
    if buckets is None:
        most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000"))
        buckets = min(most, max(_session_partitions(spark), tasks_for(sales)))
    name = name or f"demand_{uuid.uuid4().hex}"
    path = path or new_path(spark, "demand_by_product")
    folder = shared_folder(spark, path)
    fact = _filled(sales, regions, buckets)
    if folder is None:
        return write_by_product(fact, path, name, buckets, placed=True)
    if spark.catalog.tableExists(name):
        raise ValueError(f"table {name} exists")
    spans = day_spans(_with_regions(sales, regions), *_ends(sales), buckets)
    known = spans.where("from_day IS NOT NULL AND until_day IS NOT NULL")
    write_spans(known.select("*", F.inline("regions")).drop("regions"), folder, buckets)
    return open_by_product(spark, path, name, fact.schema, buckets)


def raw_demand(spark: SparkSession, folder: str, by_part: bool = False) -> DataFrame:
    """The demand fact of the tables in ``folder``."""
    return assemble(*demand_tables(spark, folder), by_part=by_part)


def demand_tables(spark: SparkSession, folder: str) -> list[DataFrame]:
    """Order lines, parts and regions."""
    return [read_table(spark, folder, t) for t in ("lineitem", "part", "region")]


def _catalogue(spark: SparkSession, folder: str) -> DataFrame:
    """Category, warehouse and region of each part: the two catalogue tables, not a pass over the fact."""
    products = read_table(spark, folder, "part").select(F.col("p_type").alias("category"), _region_no().alias("region_no"))
    return _add_region(products, read_table(spark, folder, "region"))


def demand_levels(spark: SparkSession, folder: str) -> dict[str, list[str]]:
    """Values of category, warehouse and region in the catalogue, for one-hot columns."""
    return levels_of(_catalogue(spark, folder), ONE_HOT_PREFIXES)


def demand_level_index(spark: SparkSession, folder: str) -> DataFrame:
    """The written codes of those values, however many there are."""
    return level_index(_catalogue(spark, folder), ONE_HOT_PREFIXES)


def demand_calendar(spark: SparkSession, folder: str) -> DataFrame:
    """The days of the fact, from one column of the order lines."""
    return spine(sale_span(read_table(spark, folder, "lineitem")))
