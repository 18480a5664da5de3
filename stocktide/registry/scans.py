"""Sources and sinks: reading and writing the demand fact and results."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.calendar import peak_months
from ..operators.series import add_lags, add_rolling
from ..operators.simple_ar import simple_ar
from ..plans.reports import weekly_demand
from ..plans.views import create_views
from ..schema import RAW_DEMAND
from ..session import new_path
from ..sources.demand import demand_calendar, demand_tables, raw_demand, store_by_product
from ..sources.tables import read_by_month, read_csv, read_csv_inferred, replace_months, write_by_month, write_csv
from .base import AS_OF, MIN_YEAR, PEAKS, register
from .ctes import AS_OF_SQL, PART_RAW, PEAK_ROWS, RAW, forecasts

BODY = "--body\n"
WEEKLY_SQL = f"""SELECT product_id, category, region, CAST(date_trunc('week', date) AS DATE) AS week_start,
  CAST(sum(units_sold) AS BIGINT) AS weekly_units, avg(units_sold) AS avg_daily_units,
  stddev_samp(units_sold) AS demand_volatility, sum(units_sold * price) AS weekly_revenue, avg(price) AS avg_price,
  min(price) AS min_price, max(price) AS max_price, count(*) FILTER (WHERE units_sold = 0) AS zero_demand_days
  FROM raw_demand WHERE "year" >= {MIN_YEAR} AND date >= {AS_OF_SQL} - INTERVAL 364 DAY
  GROUP BY ALL"""
WEEKLY_DOUBLES = "avg_daily_units demand_volatility weekly_revenue:2 avg_price:4 min_price:4 max_price:4"


@register(
    "a1_table_scan",
    RAW
    + BODY
    + """SELECT "year", "month", count(*) AS n_rows, CAST(sum(units_sold) AS BIGINT) AS units, sum(revenue) AS revenue
    FROM raw_demand WHERE "year" >= 1998 GROUP BY 1, 2""",
    "revenue:2",
)
def table_scan(spark, folder):
    path = new_path(spark, "raw_demand")
    write_by_month(raw_demand(spark, folder), path)
    return (
        read_by_month(spark, path)
        .where(F.col("year") >= 1998)
        .groupBy("year", "month")
        .agg(F.count("*").alias("n_rows"), F.sum("units_sold").alias("units"), F.sum("revenue").alias("revenue"))
    )


@register(
    "a1_sql_view",
    RAW
    + BODY
    + """SELECT region, "month", count(*) FILTER (WHERE units_sold = 0) AS idle_days, CAST(sum(units_sold) AS BIGINT) AS units
    FROM raw_demand WHERE "year" >= 1998 GROUP BY ALL""",
)
def sql_view(spark, folder):
    create_views(raw_demand(spark, folder), AS_OF, MIN_YEAR)
    return spark.sql(
        """SELECT region, month, count_if(units_sold = 0) AS idle_days, sum(units_sold) AS units
        FROM raw_demand WHERE year >= :first_year GROUP BY region, month""",
        args={"first_year": 1998},
    )


@register(
    "a1_report_view",
    RAW
    + BODY
    + f"""SELECT region, week_start, count(*) AS products, CAST(sum(weekly_units) AS BIGINT) AS units FROM ({WEEKLY_SQL})
    GROUP BY ALL""",
)
def report_view(spark, folder):
    create_views(raw_demand(spark, folder), AS_OF, MIN_YEAR)
    return spark.sql(
        "SELECT region, week_start, count(*) AS products, sum(weekly_units) AS units FROM weekly_demand GROUP BY region, week_start"
    )


@register(
    "a2_csv_typed",
    RAW
    + BODY
    + """SELECT category, "year", min(date) AS first_date, CAST(sum(units_sold) AS BIGINT) AS units,
    avg(price) AS avg_price FROM raw_demand GROUP BY 1, 2""",
    "avg_price:4",
)
def csv_typed(spark, folder):
    path = new_path(spark, "raw_demand_csv")
    write_csv(raw_demand(spark, folder).select(*RAW_DEMAND.names), path)
    return (
        read_csv(spark, path, RAW_DEMAND)
        .groupBy("category", "year")
        .agg(F.min("date").alias("first_date"), F.sum("units_sold").alias("units"), F.avg("price").alias("avg_price"))
    )


@register(
    "a3_csv_inferred",
    RAW
    + BODY
    + """SELECT region, "month", max(date) AS last_date, CAST(sum(units_sold) AS BIGINT) AS units,
    max(price) AS max_price FROM raw_demand GROUP BY 1, 2""",
    "max_price:4",
)
def csv_inferred(spark, folder):
    path = new_path(spark, "raw_demand_csv")
    write_csv(raw_demand(spark, folder), path)
    return (
        read_csv_inferred(spark, path)
        .groupBy("region", "month")
        .agg(
            F.max("date").alias("last_date"),
            F.sum("units_sold").cast("long").alias("units"),
            F.max("price").alias("max_price"),
        )
    )


@register("a4_csv_sink", RAW + BODY + WEEKLY_SQL, WEEKLY_DOUBLES)
def csv_sink(spark, folder):
    path = new_path(spark, "weekly_demand_csv")
    weekly = weekly_demand(raw_demand(spark, folder), AS_OF, MIN_YEAR)
    write_csv(weekly, path)
    return read_csv(spark, path, weekly.schema)


@register(
    "a5_partitioned_sink",
    RAW + BODY + """SELECT "year", "month", category, count(*) AS n_rows FROM raw_demand GROUP BY 1, 2, 3""",
)
def partitioned_sink(spark, folder):
    path = new_path(spark, "raw_demand")
    write_by_month(raw_demand(spark, folder), path)
    return read_by_month(spark, path).groupBy("year", "month", "category").agg(F.count("*").alias("n_rows"))


@register(
    "a5_month_rerun",
    RAW
    + BODY
    + """SELECT "year", "month", count(*) AS n_rows, CAST(sum(units_sold) AS BIGINT) AS units, count(DISTINCT product_id) AS products
    FROM raw_demand GROUP BY 1, 2""",
)
def month_rerun(spark, folder):
    """A first run counts each unit of the last two years twice; a second run over those months puts them right."""
    path, demand = new_path(spark, "raw_demand"), raw_demand(spark, folder)
    late = F.col("year") >= 2000
    replace_months(demand.withColumn("units_sold", F.when(late, F.col("units_sold") * 2).otherwise(F.col("units_sold"))), path)
    replace_months(demand.where(late), path)
    return (
        read_by_month(spark, path)
        .groupBy("year", "month")
        .agg(F.count("*").alias("n_rows"), F.sum("units_sold").alias("units"), F.count_distinct("product_id").alias("products"))
    )


@register(
    "a6_forecast_export",
    forecasts() + BODY + "SELECT product_id, date, step, actual, predicted, 'SimpleAR' AS method FROM simple_ar",
    "predicted",
)
def forecast_export(spark, folder):
    path = new_path(spark, "forecasts_csv")
    made = simple_ar(raw_demand(spark, folder))
    write_csv(made, path)
    return read_csv(spark, path, made.schema)


@register("a7_result_location", RAW + BODY + WEEKLY_SQL, WEEKLY_DOUBLES)
def result_location(spark, folder):
    path = new_path(spark, "result")
    weekly_demand(raw_demand(spark, folder), AS_OF, MIN_YEAR).write.parquet(path)
    return spark.read.parquet(path)


@register("a8_calendar_spine", RAW + BODY + "SELECT date FROM days")
def calendar_spine(spark, folder):
    return demand_calendar(spark, folder)


@register(
    "a9_literal_rows",
    RAW.rstrip()
    + f""",
peaks(category, "month") AS (VALUES {PEAK_ROWS})
{BODY}SELECT p.category, p."month", 'peak' AS label, CAST(sum(r.units_sold) AS BIGINT) AS units
FROM peaks p JOIN raw_demand r ON r.category = p.category AND r."month" = p."month" GROUP BY 1, 2""",
)
def literal_rows(spark, folder):
    peaks = peak_months(spark, PEAKS).withColumn("label", F.lit("peak"))
    monthly = raw_demand(spark, folder).groupBy("category", "month").agg(F.sum("units_sold").alias("units"))
    return peaks.join(monthly, ["category", "month"])


@register("a10_raw_demand", RAW + BODY + "SELECT * FROM raw_demand", "price revenue:4")
def whole_fact(spark, folder):
    return raw_demand(spark, folder)


@register("a10_part_demand", PART_RAW + BODY + """SELECT product_id, category, region, "year", count(*) AS n_days,
    CAST(sum(units_sold) AS BIGINT) AS units, sum(revenue) AS revenue, min(price) AS min_price, max(price) AS max_price
    FROM raw_demand GROUP BY ALL""", "revenue:2 min_price:4 max_price:4")  # fmt: skip
def part_fact(spark, folder):
    """The fact with each part as a product of its own, by part and year."""
    return (
        raw_demand(spark, folder, by_part=True)
        .groupBy("product_id", "category", "region", "year")
        .agg(
            F.count("*").alias("n_days"),
            F.sum("units_sold").alias("units"),
            F.sum("revenue").alias("revenue"),
            F.min("price").alias("min_price"),
            F.max("price").alias("max_price"),
        )
    )


def bucketed_features(demand):
    """Windows, sums and a join by product: none of them shuffles a fact that is stored by product."""
    rolled = add_rolling(add_lags(demand, (7, 365)), windows=(30,), statistics=("max",))
    weekly = rolled.groupBy("product_id").agg(
        F.count("*").alias("n_days"),
        F.sum("demand_lag_365d").alias("units_before_last_year"),
        F.sum(F.col("units_sold") * F.col("demand_lag_7d")).alias("weekly_product"),
        F.sum("rolling_max_30d").alias("monthly_peaks"),
    )
    busiest = demand.groupBy("product_id").agg(F.max(F.struct("units_sold", "date")).alias("top"))
    return weekly.join(busiest, "product_id").select(
        "product_id", "n_days", "units_before_last_year", "weekly_product", "monthly_peaks", F.col("top.date").alias("busiest_day")
    )


@register("a10_stored_by_product", PART_RAW.rstrip() + """,
lagged AS (
  SELECT *, lag(units_sold, 7) OVER w AS week_ago, lag(units_sold, 365) OVER w AS year_ago,
         max(units_sold) OVER (PARTITION BY product_id ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS peak
  FROM raw_demand WINDOW w AS (PARTITION BY product_id ORDER BY date))
--body
SELECT product_id, count(*) AS n_days, CAST(sum(year_ago) AS BIGINT) AS units_before_last_year,
  CAST(sum(units_sold * week_ago) AS BIGINT) AS weekly_product, CAST(sum(peak) AS BIGINT) AS monthly_peaks,
  max_by(date, units_sold * 100000 + date_diff('day', DATE '1970-01-01', date)) AS busiest_day
  FROM lagged GROUP BY 1""")  # fmt: skip
def stored_fact(spark, folder):
    return bucketed_features(store_by_product(*demand_tables(spark, folder), by_part=True))
