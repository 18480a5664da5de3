"""Chat formatting: logged conversations that are the beginning of longer ones are dropped, the rest rendered.

A log often keeps a snapshot after every turn. Each prefix of a conversation has
a rolling hash: the sums of hashes of (position, role, text) of its turns. A
conversation goes if another one passes through its last prefix and goes on; of
equal conversations the one with the smallest id stays. All of it is DataFrame
operations.

Positions and sums come in two steps, within stretches of ``STRETCH`` turn
numbers and over the stretches of a conversation, so a very long conversation is
not one task's work. Hot prefixes (a common first turn, a conversation logged
very often) are counted before the shuffle.

Defined cases: turns are ordered by number (null first), then role and text; a
null role or text counts as empty; a row that is repeated as a whole counts
once; rows with a null conversation id belong to no conversation and are left
out; an empty table gives an empty table; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STRETCH = 512
PART_TURNS = 500
SUMS = ("s0", "s1", "s2", "s3")


def _hash(seed: int) -> Column:
    """32 bits, so that sums of billions of turns fit a long."""
    return F.xxhash64(F.lit(seed), "pos", "role", "text").bitwiseAND(F.lit(0xFFFFFFFF))


def prefixes(turns: DataFrame) -> DataFrame:
    """Turns (``conv_id``, ``turn``, ``role``, ``text``) with their position from 1 and the rolling sums up to it."""
    rows = turns.select(
        F.col("conv_id"), F.col("turn").cast("long").alias("turn"), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]
    )
    rows = rows.where("conv_id is not null").distinct()
    rows = rows.withColumn("stretch", F.coalesce(F.floor(F.col("turn") / STRETCH), F.lit(-(1 << 60))))
    inner = Window.partitionBy("conv_id", "stretch").orderBy("turn", "role", "text")
    outer = Window.partitionBy("conv_id").orderBy("stretch")
    before = lambda c: (F.sum(c).over(outer) - F.col(c)).alias(f"{c}_before")
    counts = rows.groupBy("conv_id", "stretch").agg(F.count("*").alias("n")).select("conv_id", "stretch", before("n"))
    placed = rows.withColumn("at", F.row_number().over(inner)).join(counts, ["conv_id", "stretch"])
    placed = placed.withColumn("pos", F.col("at") + F.col("n_before"))
    placed = placed.withColumns({s: _hash(i) for i, s in enumerate(SUMS)})
    running = inner.rowsBetween(Window.unboundedPreceding, 0)
    summed = placed.groupBy("conv_id", "stretch").agg(*[F.sum(s).alias(s) for s in SUMS]).select("conv_id", "stretch", *map(before, SUMS))
    rolled = placed.withColumns({s: F.sum(s).over(running) for s in SUMS}).join(summed, ["conv_id", "stretch"])
    return rolled.select("conv_id", "pos", "role", "text", *[(F.col(s) + F.col(f"{s}_before")).alias(s) for s in SUMS])


def maximal(prefixed: DataFrame) -> DataFrame:
    """``conv_id``, ``n_turns`` and ``copies`` of the conversations that no other one continues."""
    key = ["pos", *SUMS]
    ends = prefixed.groupBy("conv_id").agg(F.max(F.struct(*key)).alias("end")).select("conv_id", "end.*")
    classes = ends.groupBy(*key).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("copies"))
    passing = prefixed.groupBy(*key).agg(F.count("*").alias("passing"))
    a, b = classes.alias("a"), passing.alias("b")
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in key]
    kept = a.join(b, [*same, F.col("b.passing") > F.col("a.copies")], "left_anti")
    return kept.select("conv_id", F.col("pos").alias("n_turns"), "copies")


def render(turns: DataFrame) -> DataFrame:
    """Maximal conversations as text, in parts of ``PART_TURNS`` turns.

    Returns ``conv_id``, ``part`` (from 0), ``n_turns`` and ``copies`` of the
    conversation, and ``text``: its turns as ``<|role|>``, a line feed, the text
    and a line feed. The parts in order are the whole conversation.
    """
    prefixed = prefixes(turns)
    kept = prefixed.select("conv_id", "pos", "role", "text").join(maximal(prefixed), "conv_id")
    line = F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit("\n"))
    part = F.floor((F.col("pos") - 1) / PART_TURNS).alias("part")
    lines = F.sort_array(F.collect_list(F.struct("pos", line.alias("line"))))
    grouped = kept.groupBy("conv_id", part, "n_turns", "copies").agg(lines.alias("lines"))
    return grouped.select("conv_id", "part", "n_turns", "copies", F.array_join("lines.line", "").alias("text"))
