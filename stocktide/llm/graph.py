"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` for every end of the edges (``a``, ``b``); equal roots mean one component.

    Each round sends every node to the neighbour (or itself) that a hash with a
    new seed puts first, and draws the edges anew between the places. A round
    keeps components apart and whole, and takes away a constant share of the
    nodes on average, whatever the shape: long chains as well as stars. Rounds
    are written tables, so no lineage builds up. Null ends and self links are
    ignored.
    """
    steps: list[DataFrame] = []
    edges = materialize(edges.select("a", "b").where("a <> b"), "edges")
    while not edges.isEmpty():
        ends = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(edges.select("b", "a"))
        order = lambda x: F.struct(F.xxhash64(F.col(x), F.lit(len(steps))).alias("h"), F.col(x).alias("to"))  # noqa: E731,B023
        step = ends.groupBy("node").agg(F.min(order("other")).alias("best")).select("node", F.least("best", order("node"))["to"].alias("to"))
        step = materialize(step, "component_step")
        steps.append(step)
        moved = edges.join(step.select(F.col("node").alias("a"), F.col("to").alias("to_a")), "a")
        moved = moved.join(step.select(F.col("node").alias("b"), F.col("to").alias("to_b")), "b")
        moved = moved.where("to_a <> to_b").select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
        edges = materialize(moved.distinct(), "edges")
    if not steps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = steps[-1].select("node", F.col("to").alias("root"))
    for step in reversed(steps[:-1]):
        later = roots.select(F.col("node").alias("to"), "root")
        roots = step.join(later, "to", "left").select("node", F.coalesce("root", "to").alias("root"))
    return roots
