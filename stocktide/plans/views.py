"""The demand fact and its reports as views, for users who write SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame

from . import reports


def create_views(demand: DataFrame, as_of: str, min_year: int = 2022) -> list[str]:
    """Temporary views ``raw_demand`` and one per report, named as its function; returns the names.

    A view is a plan: a statement on it reads the columns and folders it needs.
    """
    views = {
        "raw_demand": demand,
        "weekly_demand": reports.weekly_demand(demand, as_of, min_year),
        "year_over_year": reports.year_over_year(demand, as_of),
        "stockout_risk": reports.stockout_risk(demand, as_of),
        "inventory_positioning": reports.inventory_positioning(demand, as_of),
        "promo_lift": reports.promo_lift(demand, min_year),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    return list(views)
