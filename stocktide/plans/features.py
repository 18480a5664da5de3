"""The feature table: every feature group, encoded, trimmed and split by time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from ..operators.calendar import add_calendar_features, calendar_of
from ..operators.prep import (
    ONE_HOT_PREFIXES,
    add_level_codes,
    add_one_hot,
    add_split_side,
    add_target,
    drop_short_history,
    levels_of,
    time_split,
)
from ..operators.selection import first_products, keep_products
from ..operators.series import add_lags, add_price_features, add_rolling_features, add_trend_features
from ..session import materialize
from ..settings import DEFAULTS, DemandSettings


def feature_table(
    demand: DataFrame,
    calendar: DataFrame | None = None,
    levels: Mapping[str, Sequence[str]] | None = None,
    sample_products: int | None = None,
    exclude_current: bool = False,
    s: DemandSettings = DEFAULTS,
    level_codes: DataFrame | None = None,
) -> DataFrame:
    """All features per product and day, without the rows that lack the longest lag.

    ``level_codes``, an index of ``level_index``, puts one code per attribute in
    place of a column per value, for catalogues too wide for columns.

    The window features come first, while the fact is still partitioned by
    product; the calendar joins afterwards as a broadcast of one row per day.
    """
    if sample_products:
        demand = keep_products(demand, first_products(demand, sample_products))
    if levels is None and level_codes is None:
        levels = levels_of(demand, ONE_HOT_PREFIXES)
    featured = add_lags(demand, s.lags)
    featured = add_rolling_features(featured, exclude_current)
    featured = add_price_features(featured)
    featured = add_trend_features(featured)
    trimmed = drop_short_history(featured, f"demand_lag_{max(s.lags)}d")
    dated = add_calendar_features(trimmed, calendar if calendar is not None else calendar_of(demand))
    return add_target(add_one_hot(dated, levels) if level_codes is None else add_level_codes(dated, level_codes))


def train_and_test(features: DataFrame, s: DemandSettings = DEFAULTS) -> tuple[DataFrame, DataFrame]:
    return time_split(features, s.train_share, s.gap_days)


def sided_features(features: DataFrame, s: DemandSettings = DEFAULTS) -> DataFrame:
    """Features with their side of the split; they are written once, as the split day is a quantile of their rows."""
    features = materialize(features, "features")
    return add_split_side(features, s.train_share, s.gap_days)
