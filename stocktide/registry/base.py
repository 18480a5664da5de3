"""Registration of named queries with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

AS_OF = "2001-11-04"
MIN_YEAR = 1995

# Peak months of the given tables' categories, in the shape of the default mapping.
PEAKS = {
    "ECONOMY": (11, 12),
    "LARGE": (5, 6, 7, 8),
    "MEDIUM": (3, 4, 9, 10),
    "PROMO": (1, 2, 12),
    "SMALL": (4, 5, 6),
}


def rnd(expr: str, digits: int) -> str:
    """The oracle's side of ``round_half_up``."""
    x = f"CAST({expr} AS DOUBLE)"
    return f"(sign({x}) * floor(abs({x}) * 1e{digits} + 0.5) / 1e{digits} + 0.0)"


# Sums of doubles differ in the last bits between engines, so both sides are rounded
# to the nearest decimal. The half is a little more than a half, since values of
# few digits that lie in the middle would fall to either side.
GRID_SHIFT = 0.5000137


def snap(value: Column, digits: int) -> Column:
    scale = float(10**digits)
    return F.floor(value.cast("double") * scale + GRID_SHIFT) / scale


def snap_sql(expr: str, digits: int) -> str:
    return f"(floor(CAST({expr} AS DOUBLE) * 1e{digits} + {GRID_SHIFT}) / 1e{digits})"


def parse_digits(doubles: str | Mapping[str, int]) -> dict[str, int]:
    """``"a b:2"`` gives a 6 digits and b 2."""
    if not isinstance(doubles, str):
        return dict(doubles)
    pairs = (item.partition(":") for item in doubles.split())
    return {name: int(digits) if digits else 6 for name, _, digits in pairs}


def register(name: str, sql: str | None = None, doubles: str | Mapping[str, int] = ""):
    """Register a query with its SQL; both sides snap the named double columns."""
    digits = parse_digits(doubles)

    def wrap(query: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            df = query(spark, folder)
            return df.withColumns({c: snap(F.col(c), n) for c, n in digits.items()}) if digits else df

        run.__name__ = name
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            if digits:
                rounded = ", ".join(f"{snap_sql(c, n)} AS {c}" for c, n in digits.items())
                head, _, body = sql.rpartition("--body\n")
                ORACLES[name] = f"{head}SELECT * REPLACE ({rounded}) FROM ({body}) AS result"
            else:
                ORACLES[name] = sql.replace("--body\n", "")
        return query

    return wrap
