"""Numbering the rows of a sorted table without bringing them into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

#: Bits of a row's number within its partition, as Spark hands them out.
_WITHIN = 33


def add_place(ordered: DataFrame, name: str = "place") -> DataFrame:
    """``name`` counts the rows from 0 in the order of a sorted table.

    Sorting deals ranges to partitions. The sorted table is written with each
    row's partition and its number there; the rows of the partitions before are
    then added. Only one row per partition is summed up.
    """
    numbered = ordered.withColumn("__id", F.monotonically_increasing_id())
    written = materialize(numbered, "ordered").withColumn("__part", F.shiftright("__id", _WITHIN))
    counts = written.groupBy("__part").agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("__part", before.alias("__before"))
    within = F.col("__id").bitwiseAND(F.lit((1 << _WITHIN) - 1))
    return written.join(starts, "__part").withColumn(name, F.col("__before") + within).drop("__part", "__before", "__id")
