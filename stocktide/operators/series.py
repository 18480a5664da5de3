"""Window operators over many daily series.

All of them share one window specification, ``product_id`` ordered by ``date``,
so Spark plans one exchange and one sort for any mix of them. The fact has one
row per product and day, so a window partition never holds more rows than the
calendar has days, whatever share of the sales a product has.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from ..functions.numeric import flag, pct_change, ratio
from ..settings import (
    LAG_PERIODS,
    MIN_CORRELATION_PAIRS,
    PROMO_RATIO,
    ROLLING_WINDOWS,
    YEAR_LAG,
)


def by_product() -> WindowSpec:
    return Window.partitionBy("product_id").orderBy("date")


def trailing(rows: int, exclude_current: bool = False) -> WindowSpec:
    """The last ``rows`` rows, ending at the current row or just before it."""
    end = -1 if exclude_current else 0
    return by_product().rowsBetween(end - rows + 1, end)


def add_lags(df: DataFrame, periods: Iterable[int] = LAG_PERIODS, value: str = "units_sold") -> DataFrame:
    series = by_product()
    return df.withColumns({f"demand_lag_{k}d": F.lag(value, k).over(series) for k in periods})


ROLLING = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}


def add_rolling(
    df: DataFrame,
    windows: Iterable[int] = ROLLING_WINDOWS,
    statistics: Iterable[str] = tuple(ROLLING),
    value: str = "units_sold",
    exclude_current: bool = False,
) -> DataFrame:
    """Rolling statistics over the rows that exist so far (at least one).

    By default the frame ends at the current row, whose value is also the
    training target; ``exclude_current`` ends it one row earlier.

    Spark goes over a whole frame again at each row. Where extremes alone are
    asked for, they are put together from those of shorter frames.
    """
    frames = {n: trailing(n, exclude_current) for n in windows}
    statistics = tuple(statistics)
    if set(statistics) <= EXTREMES.keys():
        return _add_extremes(df, list(frames), statistics, value, exclude_current)
    return df.withColumns(
        {f"rolling_{s}_{n}d": ROLLING[s](value).over(frame) for n, frame in frames.items() for s in statistics}
    )


#: Extremes of a frame are those of the extremes of its parts.
EXTREMES = {"min": F.least, "max": F.greatest}


def _part(rows: int) -> int:
    """The smallest whole part of ``rows`` that is at least their square root."""
    return next(n for n in range(1, rows + 1) if rows % n == 0 and n * n >= rows)


def _add_extremes(df: DataFrame, windows: list[int], statistics: tuple[str, ...], value: str, exclude_current: bool) -> DataFrame:
    """Rolling extremes of ``windows`` rows, from those of a part of the rows at the row itself and before."""
    names = {(s, n): f"rolling_{s}_{n}d" for n in windows for s in statistics}
    short = {(s, n): f"__{s}_{n}" for s, n in names}
    parted = df.withColumns({short[s, n]: ROLLING[s](value).over(trailing(_part(n), exclude_current)) for s, n in names})
    before = lambda s, n: [F.lag(short[s, n], k).over(by_product()) for k in range(_part(n), n, _part(n))]
    whole = {names[s, n]: EXTREMES[s](short[s, n], *before(s, n)) if _part(n) < n else F.col(short[s, n]) for s, n in names}
    return parted.withColumns(whole).drop(*short.values())


def add_demand_cv(df: DataFrame) -> DataFrame:
    return df.withColumn("demand_cv_30d", ratio(F.col("rolling_std_30d"), F.col("rolling_mean_30d")))


def add_rolling_features(df: DataFrame, exclude_current: bool = False) -> DataFrame:
    return add_demand_cv(add_rolling(df, exclude_current=exclude_current))


def preceding_mean_price(rows: int = 30) -> Column:
    """Mean price of the preceding rows, without the current one."""
    return F.avg("price").over(trailing(rows, exclude_current=True))


def add_report_promo(df: DataFrame, limit: float = PROMO_RATIO) -> DataFrame:
    """Promo flag of the lift report: strictly below ``limit`` times the mean price before.

    A product's first row has no preceding mean and is no promo.
    """
    return df.withColumn("avg_price_30d", preceding_mean_price()).withColumn(
        "is_promo", flag(F.col("price") < F.lit(limit) * F.col("avg_price_30d"))
    )


def add_price_change(df: DataFrame) -> DataFrame:
    before = F.lag("price", 1).over(by_product())
    return df.withColumn("price_change_pct", F.coalesce(pct_change(F.col("price"), before), F.lit(0.0)))


def add_price_level(df: DataFrame, rows: int = 30) -> DataFrame:
    mean = F.avg("price").over(trailing(rows))
    return df.withColumn("price_vs_avg_30d", ratio(F.col("price"), mean))


def add_feature_promo(df: DataFrame, limit: float = PROMO_RATIO) -> DataFrame:
    """Promo flag of the feature table, relative to a mean that includes the row itself."""
    return df.withColumn("is_promo", flag(F.col("price_vs_avg_30d") < limit))


def add_promo_count(df: DataFrame) -> DataFrame:
    running = by_product().rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("promo_count", F.sum("is_promo").over(running))


def add_days_since_promo(df: DataFrame) -> DataFrame:
    """0 on a promo row, then 1, 2, ..; before any promo it counts from the series start.

    The row number of the last promo is carried along the same window, which
    saves the extra sort that a second grouping by promo count would need.
    """
    series = by_product()
    nth = F.row_number().over(series)
    numbered = df.withColumn("_nth", nth)
    last_promo = F.last(F.when(F.col("is_promo") == 1, F.col("_nth")), ignorenulls=True).over(
        series.rowsBetween(Window.unboundedPreceding, 0)
    )
    return numbered.withColumn("days_since_promo", F.col("_nth") - F.coalesce(last_promo, F.lit(1))).drop("_nth")


def add_demand_change(df: DataFrame) -> DataFrame:
    before = F.lag("units_sold", 1).over(by_product())
    return df.withColumn("demand_change", pct_change(F.col("units_sold"), before))


def add_price_demand_correlation(
    df: DataFrame, rows: int = 30, min_pairs: int = MIN_CORRELATION_PAIRS
) -> DataFrame:
    """Rolling correlation of the two change columns; null below ``min_pairs`` pairs.

    Both inputs are nulled unless both are present, and the division is guarded,
    since a constant input has no correlation.
    """
    frame = trailing(rows)
    both = F.col("price_change_pct").isNotNull() & F.col("demand_change").isNotNull()
    x = F.when(both, F.col("price_change_pct"))
    y = F.when(both, F.col("demand_change"))
    spread = F.stddev_samp(x).over(frame) * F.stddev_samp(y).over(frame)
    corr = ratio(F.covar_samp(x, y).over(frame), spread)
    return df.withColumn("price_demand_corr_30d", F.when(F.count(y).over(frame) >= min_pairs, corr))


def add_price_features(df: DataFrame) -> DataFrame:
    for step in (
        add_price_change,
        add_price_level,
        add_feature_promo,
        add_days_since_promo,
        add_demand_change,
        add_price_demand_correlation,
    ):
        df = step(df)
    return df


def add_year_over_year(df: DataFrame, rows: int = YEAR_LAG) -> DataFrame:
    year_ago = F.lag("units_sold", rows).over(by_product())
    return df.withColumn("demand_yoy", ratio(F.col("units_sold"), year_ago))


def add_trend(df: DataFrame) -> DataFrame:
    month = F.col("rolling_mean_30d")
    return df.withColumn("trend_30d", ratio(F.col("rolling_mean_7d") - month, month))


def add_trend_features(df: DataFrame) -> DataFrame:
    return add_trend(add_year_over_year(df))


def add_position(df: DataFrame) -> DataFrame:
    """``nth`` from the oldest row, ``n_rows`` of the series; both per product."""
    whole = Window.partitionBy("product_id")
    return df.withColumns({"nth": F.row_number().over(by_product()), "n_rows": F.count("*").over(whole)})


def add_holdout(df: DataFrame, horizon: int = 30) -> DataFrame:
    """``is_holdout`` marks the last ``horizon`` rows of each series."""
    return add_position(df).withColumn("is_holdout", F.col("nth") > F.col("n_rows") - horizon)


def add_block(df: DataFrame, rows: int = 30) -> DataFrame:
    """Fixed blocks of ``rows`` rows along each series, counted from 0."""
    nth = F.row_number().over(by_product())
    return df.withColumn("block", F.floor((nth - 1) / rows).cast("int"))


def add_prefix_side(df: DataFrame, share: float = 0.6, name: str = "is_prefix") -> DataFrame:
    """Marks the first ``floor(share * n)`` rows of each series."""
    positioned = add_position(df)
    return positioned.withColumn(name, F.col("nth") <= F.floor(F.col("n_rows") * share)).drop("nth", "n_rows")
