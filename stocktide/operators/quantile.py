"""Exact quantile of one column without holding the column in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

BINS = 4096


def _rank_value(values: DataFrame, rank: int, below: int, low: float, high: float, bins: int) -> float:
    """The value at ``rank`` (from 0) of those in [low, high], of which ``below`` lie lower.

    Each pass counts ``bins`` equal stretches, and goes on with the least and the
    largest value of the stretch that holds the rank, until they are equal.
    """
    while low < high:
        width = F.lit(high / bins - low / bins)
        place = F.least(F.floor((F.col("v") - low) / width), F.lit(bins - 1)).alias("bin")
        inside = values.where(F.col("v").between(low, high))
        # One row per stretch: bounded by the parameter.
        rows = inside.groupBy(place).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()
        for row in sorted(rows, key=lambda r: r.lo):
            if below + row.n > rank:
                break
            below += row.n
        if (row.lo, row.hi) == (low, high):  # neighbouring numbers, which no width can part
            return low if below + values.where(F.col("v") == low).count() > rank else high
        low, high = row.lo, row.hi
    return low


def exact_quantile(df: DataFrame, column: str, q: float, bins: int = BINS) -> DataFrame:
    """One row, one column ``quantile``: linear interpolation between order statistics.

    ``percentile`` keeps every distinct value in one task, and a sketch is not
    exact. Here the range is narrowed by counting, which takes two or three
    passes over one written column for common data, whatever its size.
    """
    spark = df.sparkSession
    values = materialize(df.select(F.col(column).cast("double").alias("v")).where("v is not null and not isnan(v)"), "quantile")
    found = values.agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    if not found.n:
        return spark.createDataFrame([(None,)], "quantile double")
    at = (found.n - 1) * q
    low = _rank_value(values, int(at), 0, found.lo, found.hi, bins)
    upto = values.where(F.col("v") <= low).count()
    high = low if int(at) == at or upto > int(at) + 1 else values.where(F.col("v") > low).agg(F.min("v")).first()[0]
    return spark.createDataFrame([(low + (high - low) * (at - int(at)),)], "quantile double")


def date_quantile(df: DataFrame, q: float = 0.8, column: str = "date") -> DataFrame:
    """Interpolated quantile of a date column, in days since 1970-01-01.

    The number of distinct days bounds the state, so ``percentile`` fits.
    """
    return df.agg(F.percentile(F.unix_date(column), q).alias("split_day"))
