"""SQL building blocks of the oracles: each is a WITH prefix ending in a newline.

They are written against the given tables only and in another way than the
Spark side (calendar grid joined to sales, self joins, islands by group count).
"""

from __future__ import annotations

import datetime as dt

from .base import AS_OF, PEAKS


def us_holiday_dates(years: range) -> list[dt.date]:
    """Eight holidays per year, found by walking through the days of the month."""

    def nth(year: int, month: int, weekday: int, n: int) -> dt.date:
        days = [dt.date(year, month, d) for d in range(1, 31) if month != 2 or d < 29]
        if month in (1, 3, 5, 7, 8, 10, 12):
            days.append(dt.date(year, month, 31))
        return [d for d in days if d.weekday() == weekday][n]

    found = []
    for y in years:
        found += [dt.date(y, 1, 1), dt.date(y, 7, 4), dt.date(y, 12, 25)]
        found += [nth(y, 1, 0, 2), nth(y, 2, 0, 2), nth(y, 5, 0, -1), nth(y, 9, 0, 0), nth(y, 11, 3, 3)]
    return sorted(found)


HOLIDAY_ROWS = ", ".join(f"(DATE '{d}')" for d in us_holiday_dates(range(1995, 2002)))
PEAK_ROWS = ", ".join(f"('{c}', {m})" for c, months in PEAKS.items() for m in months)

RAW = """
WITH sold AS (
  SELECT p.p_brand || '/' || p.p_type AS product_id, p.p_type AS category,
         CAST(substr(p.p_brand, 7) AS INTEGER) % 5 AS region_no,
         CAST(l.l_shipdate AS DATE) AS sold_on,
         CAST(sum(l.l_quantity) AS BIGINT) AS units,
         CAST(sum(CAST(round(p.p_retailprice * 100) AS BIGINT) * CAST(round((1 - l.l_discount) * 100) AS BIGINT)) AS DOUBLE)
           / count(*) / 10000 AS paid
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  GROUP BY 1, 2, 3, 4),
bounds AS (SELECT min(CAST(l_shipdate AS DATE)) AS lo, max(CAST(l_shipdate AS DATE)) AS hi FROM lineitem),
days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM bounds),
lines AS (SELECT DISTINCT product_id, category, region_no FROM sold),
grid AS (
  SELECT n.product_id, n.category, n.region_no, d.date, s.units, s.paid
  FROM lines n CROSS JOIN days d LEFT JOIN sold s ON s.product_id = n.product_id AND s.sold_on = d.date),
priced AS (
  SELECT *, coalesce(last_value(paid IGNORE NULLS) OVER (PARTITION BY product_id ORDER BY date
                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                     first_value(paid IGNORE NULLS) OVER (PARTITION BY product_id ORDER BY date
                       ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS price
  FROM grid),
raw_demand AS (
  SELECT g.product_id, g.date, coalesce(g.units, 0) AS units_sold, g.price, g.category,
         'WH-' || r.r_name AS warehouse, r.r_name AS region, coalesce(g.units, 0) * g.price AS revenue,
         CAST(year(g.date) AS INTEGER) AS "year", CAST(month(g.date) AS INTEGER) AS "month",
         CAST(week(g.date) AS INTEGER) AS week
  FROM priced g JOIN region r ON r.r_regionkey = g.region_no)
"""

# The same fact with each part as a product of its own.
PART_RAW = RAW.replace("p.p_brand || '/' || p.p_type AS product_id", "'P' || lpad(CAST(p.p_partkey AS VARCHAR), 10, '0') AS product_id")

CALENDAR = (
    RAW.rstrip()
    + f""",
holidays(holiday) AS (VALUES {HOLIDAY_ROWS}),
nearest AS (
  SELECT d.date, min(abs(date_diff('day', h.holiday, d.date))) AS gap FROM days d CROSS JOIN holidays h GROUP BY 1),
calendar AS (
  SELECT date, CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, CAST(day(date) AS INTEGER) AS day_of_month,
         CAST(month(date) AS INTEGER) AS "month", CAST(quarter(date) AS INTEGER) AS quarter,
         CAST(week(date) AS INTEGER) AS week_of_year,
         CASE WHEN isodow(date) IN (6, 7) THEN 1 ELSE 0 END AS is_weekend,
         CASE WHEN day(date) = 1 THEN 1 ELSE 0 END AS is_month_start,
         CASE WHEN month(date + INTERVAL 1 DAY) <> month(date) THEN 1 ELSE 0 END AS is_month_end,
         CAST(gap AS INTEGER) AS days_to_holiday,
         CASE WHEN gap <= 3 THEN 1 ELSE 0 END AS is_holiday_week
  FROM nearest)
"""
)

_ROLL = ",\n         ".join(
    f"avg(units_sold) OVER w{n} AS rolling_mean_{n}d, stddev_samp(units_sold) OVER w{n} AS rolling_std_{n}d, "
    f"min(units_sold) OVER w{n} AS rolling_min_{n}d, max(units_sold) OVER w{n} AS rolling_max_{n}d"
    for n in (7, 14, 30)
)
_LAGS = ", ".join(f"lag(units_sold, {k}) OVER w AS demand_lag_{k}d" for k in (7, 14, 30, 60, 90))
_SERIES = "PARTITION BY product_id ORDER BY date"

FEATURES = (
    CALENDAR.rstrip()
    + f""",
f1 AS (
  SELECT *, {_LAGS},
         {_ROLL},
         coalesce(price / nullif(lag(price, 1) OVER w, 0) - 1, 0) AS price_change_pct,
         price / nullif(avg(price) OVER w30, 0) AS price_vs_avg_30d,
         CAST(units_sold AS DOUBLE) / nullif(lag(units_sold, 1) OVER w, 0) - 1 AS demand_change,
         CAST(units_sold AS DOUBLE) / nullif(lag(units_sold, 365) OVER w, 0) AS demand_yoy
  FROM raw_demand
  WINDOW w AS ({_SERIES}), w7 AS ({_SERIES} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
         w14 AS ({_SERIES} ROWS BETWEEN 13 PRECEDING AND CURRENT ROW),
         w30 AS ({_SERIES} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)),
f2 AS (
  SELECT *, rolling_std_30d / nullif(rolling_mean_30d, 0) AS demand_cv_30d,
         (rolling_mean_7d - rolling_mean_30d) / nullif(rolling_mean_30d, 0) AS trend_30d,
         CASE WHEN price_vs_avg_30d < 0.9 THEN 1 ELSE 0 END AS is_promo,
         CASE WHEN demand_change IS NOT NULL THEN price_change_pct END AS pair_price
  FROM f1),
f3 AS (
  SELECT *, CAST(sum(is_promo) OVER ({_SERIES}) AS BIGINT) AS promo_count,
         CASE WHEN count(demand_change) OVER w30 >= 7 THEN
           covar_samp(pair_price, demand_change) OVER w30
           / nullif(stddev_samp(pair_price) OVER w30 * stddev_samp(demand_change) OVER w30, 0) END AS price_demand_corr_30d
  FROM f2 WINDOW w30 AS ({_SERIES} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)),
featured AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY product_id, promo_count ORDER BY date) - 1 AS INTEGER) AS days_since_promo
  FROM f3)
"""
)

CATEGORIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
LAG_NAMES = [f"demand_lag_{k}d" for k in (7, 14, 30, 60, 90)]
ROLL_NAMES = [f"rolling_{s}_{n}d" for n in (7, 14, 30) for s in ("mean", "std", "min", "max")]
PRICE_NAMES = [
    "price_change_pct",
    "price_vs_avg_30d",
    "is_promo",
    "days_since_promo",
    "demand_change",
    "price_demand_corr_30d",
]
CALENDAR_NAMES = [
    "day_of_week",
    "day_of_month",
    "month",
    "quarter",
    "week_of_year",
    "is_weekend",
    "is_month_start",
    "is_month_end",
    "days_to_holiday",
    "is_holiday_week",
]
ONE_HOT = {f"cat_{c}": f"category = '{c}'" for c in CATEGORIES}
ONE_HOT |= {f"wh_WH_{r.replace(' ', '_')}": f"warehouse = 'WH-{r}'" for r in REGIONS}
ONE_HOT |= {f"reg_{r.replace(' ', '_')}": f"region = '{r}'" for r in REGIONS}
ONE_HOT_SQL = ", ".join(f"CASE WHEN {test} THEN 1 ELSE 0 END AS {name}" for name, test in ONE_HOT.items())


def _code_sql(prefix: str, levels: list[str]) -> str:
    """Place of the value among its column's, from the columns per value."""
    names = [name for name in ONE_HOT if name.startswith(f"{prefix}_")]
    in_order = sorted(range(len(levels)), key=levels.__getitem__)
    return " + ".join(f"{code} * {names[i]}" for code, i in enumerate(in_order))


CODES = {
    "cat_code": _code_sql("cat", list(CATEGORIES)),
    "wh_code": _code_sql("wh", [f"WH-{r}" for r in REGIONS]),
    "reg_code": _code_sql("reg", list(REGIONS)),
}

FEATURE_TABLE = (
    FEATURES.rstrip()
    + f""",
feature_table AS (
  SELECT f.product_id, f.date, f.units_sold, f.price, f.revenue, f."year", f.week,
         {", ".join("f." + c for c in LAG_NAMES + ROLL_NAMES)}, f.demand_cv_30d,
         {", ".join("f." + c for c in PRICE_NAMES)}, f.demand_yoy, f.trend_30d,
         {", ".join(f'c."{c}"' for c in CALENDAR_NAMES)}, {ONE_HOT_SQL}, f.units_sold AS target
  FROM featured f JOIN calendar c ON c.date = f.date
  WHERE f.demand_lag_90d IS NOT NULL),
cut AS (SELECT quantile_cont(CAST(date_diff('day', DATE '1970-01-01', date) AS DOUBLE), 0.8) AS split_day FROM feature_table),
sided AS (
  SELECT t.*, CASE WHEN date_diff('day', DATE '1970-01-01', t.date) <= cut.split_day THEN 'train' ELSE 'test' END AS side
  FROM feature_table t, cut)
"""
)

DOUBLE_FEATURES = (
    ["price", "revenue"]
    + [c for c in ROLL_NAMES if "mean" in c or "std" in c]
    + ["demand_cv_30d", "price_change_pct", "price_vs_avg_30d", "demand_change", "demand_yoy", "trend_30d"]
)


def forecasts(horizon: int = 30) -> str:
    """CTE ``simple_ar`` with one row per held-out day, by self joins on row ages."""
    return (
        RAW.rstrip()
        + f""",
placed AS (
  SELECT product_id, date, units_sold, row_number() OVER (PARTITION BY product_id ORDER BY date DESC) - {horizon} AS age
  FROM raw_demand),
train AS (SELECT product_id, units_sold, age FROM placed WHERE age >= 1),
levels AS (
  SELECT product_id, count(*) AS n_train, avg(units_sold) FILTER (WHERE age <= 30) AS level,
         avg(units_sold) FILTER (WHERE age BETWEEN 366 AND 395) AS year_ago_level
  FROM train GROUP BY product_id),
numbered AS (SELECT product_id, date, units_sold AS actual, CAST(1 - age AS INTEGER) AS step FROM placed WHERE age < 1),
parts AS (
  SELECT n.product_id, n.date, n.step, n.actual, p.units_sold AS pattern, l.level,
         CASE WHEN l.n_train > 365 THEN CASE WHEN l.year_ago_level > 0 THEN l.level / l.year_ago_level ELSE 1.0 END END AS growth,
         CASE WHEN l.n_train > 365 THEN y.units_sold
              * CASE WHEN l.year_ago_level > 0 THEN l.level / l.year_ago_level ELSE 1.0 END
              ELSE l.level END AS season
  FROM numbered n
  JOIN levels l ON l.product_id = n.product_id
  LEFT JOIN train p ON p.product_id = n.product_id AND p.age = 7 - (n.step - 1) % 7
  LEFT JOIN train y ON y.product_id = n.product_id AND y.age = 366 - n.step),
simple_ar AS (
  SELECT product_id, date, step, actual,
         CASE WHEN 0.4::DOUBLE * pattern + 0.35::DOUBLE * season + 0.25::DOUBLE * level > 0
              THEN 0.4::DOUBLE * pattern + 0.35::DOUBLE * season + 0.25::DOUBLE * level
              WHEN 0.4::DOUBLE * pattern + 0.35::DOUBLE * season + 0.25::DOUBLE * level <= 0 THEN 0.0 END AS predicted
  FROM parts)
"""
    )


def ensemble(horizon: int = 30) -> str:
    """CTEs ``points`` (both forecasts), ``tuning``, ``grid_scores``, ``best``, ``output``."""
    return (
        forecasts(horizon).rstrip()
        + """,
points AS (
  SELECT a.product_id, a.date, a.actual, a.predicted AS arima_forecast, p.level AS rf_forecast,
         row_number() OVER (PARTITION BY a.product_id ORDER BY a.date) AS nth,
         count(*) OVER (PARTITION BY a.product_id) AS n_rows
  FROM simple_ar a JOIN parts p ON p.product_id = a.product_id AND p.date = a.date),
tuning AS (SELECT * FROM points WHERE nth <= floor(n_rows * 0.6)),
weights AS (SELECT 20 + 5 * i AS weight_pct FROM range(0, 13) r(i)),
grid_scores AS (
  SELECT CAST(weight_pct AS INTEGER) AS weight_pct,
         coalesce(avg(abs((actual - (weight_pct / 100.0::DOUBLE * arima_forecast + (1 - weight_pct / 100.0::DOUBLE) * rf_forecast))
                      / nullif(CAST(actual AS DOUBLE), 0))) * 100, 0.0) AS score
  FROM tuning, weights GROUP BY 1),
best AS (SELECT weight_pct FROM grid_scores ORDER BY score, weight_pct LIMIT 1),
blocked AS (SELECT *, CAST(floor((nth - 1) / 30) AS INTEGER) AS block FROM points),
blocks AS (
  SELECT product_id, block, avg(abs(actual - arima_forecast)) AS first_mae, avg(abs(actual - rf_forecast)) AS second_mae
  FROM blocked GROUP BY 1, 2),
weighed AS (
  SELECT b.*, v.first_mae AS prev_first_mae, v.second_mae AS prev_second_mae,
         CAST(CASE WHEN v.first_mae > 2 * v.second_mae THEN 20 WHEN v.second_mae > 2 * v.first_mae THEN 80
              ELSE best.weight_pct END AS INTEGER) AS weight_pct
  FROM blocked b CROSS JOIN best LEFT JOIN blocks v ON v.product_id = b.product_id AND v.block = b.block - 1),
combined AS (
  SELECT *, greatest(weight_pct / 100.0::DOUBLE * arima_forecast + (1 - weight_pct / 100.0::DOUBLE) * rf_forecast, 0.0) AS ensemble_forecast
  FROM weighed),
output AS (
  SELECT product_id, date, actual, arima_forecast, rf_forecast, ensemble_forecast,
         abs(actual - ensemble_forecast) / CASE WHEN actual > 0 THEN actual ELSE 1 END * 100 AS ensemble_error_pct
  FROM combined)
"""
    )


AS_OF_SQL = f"DATE '{AS_OF}'"
