"""Hard negatives by Kronecker-packed products.

Vectors are turned into whole numbers. The components of several candidates, made
non-negative by a bias, lie in separate bit fields of one wide number; a field
has room for a whole inner product, so sums never run into the next field. One
product with an anchor's component serves all candidates of a wide number, and
after the last component the fields are read out and the biases taken off. That
gives exact scores:

    sum((a + A)(b + B)) = sum(ab) + B sum(a) + A sum(b) + dim A B

Wide numbers of up to 53 bits are whole numbers that a double holds exactly, so
that a matrix product does the work; where one field needs more, Python's whole
numbers of any size take their place.

1. Anchors meet the rows of their own label, in blocks, for their positives.
2. Anchors with their positives meet all rows, in blocks, for the negatives
   between the given percentages of each positive's score.

A block of rows meets a group of anchors in some task, which keeps the best few
for each anchor or positive; labels of any size are cut into blocks.

Defined cases: rows whose label or vector is null, or whose vector has a null or
non-finite component, take no part; zero vectors do; vectors meet only those of
their own dimension; rows with one id are different rows; an id may be null and
then ranks after all others; anchors without positives give no row, and positives
without a fitting negative give none; a score beyond 64 bits counts as the nearest
number of 64 bits; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocktide.session import materialize

POSITIVES, NEGATIVES = 5, 10
LOW_PERCENT, HIGH_PERCENT = 30, 90
SCALE = 256
#: Numbers in a block of rows and in a group of anchors, and rows of a block at most.
BLOCK_VALUES, GROUP_VALUES, BLOCK_ROWS = 1 << 19, 1 << 16, 8192
#: Anchors of a group that are multiplied at once.
STEP = 64
#: Bits that a double holds exactly; fields of a wide number where a field needs more.
EXACT_BITS, WIDE_FIELDS = 53, 4
LARGEST = (1 << 63) - 1


def whole_numbers(vectors: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of doubles: 64-bit numbers, or Python's where these do not fit."""
    if not vectors.size or np.abs(vectors).max() < 2.0**52 / scale:
        return np.floor(vectors * scale).astype(np.int64)
    exact = lambda x: int(x) * scale if abs(x) >= 2.0**52 else int(np.floor(x * scale))
    return np.array([exact(x) for x in vectors.ravel().tolist()], object).reshape(vectors.shape)


class Packed:
    """Candidates in the fields of wide numbers, for anchors whose components lie between ``low`` and ``high``."""

    def __init__(self, rows: np.ndarray, low: int, high: int):
        self.n, self.dim = rows.shape
        self.bias, self.anchor_bias = max(0, -int(rows.min(initial=0))), max(0, -low)
        most = self.dim * (max(high, 0) + self.anchor_bias) * (int(rows.max(initial=0)) + self.bias)
        self.bits = max(1, int(most).bit_length())
        self.exact = self.bits <= EXACT_BITS
        self.fields = EXACT_BITS // self.bits if self.exact else WIDE_FIELDS
        words = -(-self.n // self.fields)
        raised = rows.astype(object) if not self.exact else rows.astype(np.int64)
        filled = np.zeros((words * self.fields, self.dim), raised.dtype)
        filled[: self.n] = raised + self.bias
        fields = filled.reshape(words, self.fields, self.dim)
        packed = sum(fields[:, i] << (self.bits * i) for i in range(self.fields)).T
        self.words = np.ascontiguousarray(packed.astype(np.float64) if self.exact else packed)
        self.sums = raised.sum(1) if self.dim else np.zeros(self.n, raised.dtype)

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Inner products of all anchors with all candidates, cut to 64 bits."""
        if not self.dim:
            return np.zeros((len(anchors), self.n), np.int64)
        if self.exact:
            whole = anchors.astype(np.int64)
            product = ((whole + self.anchor_bias).astype(np.float64) @ self.words).astype(np.int64)
        else:
            whole = anchors.astype(object)
            product = sum((whole[:, d, None] + self.anchor_bias) * self.words[d] for d in range(self.dim))
        mask = (1 << self.bits) - 1
        fields = np.stack([product >> (self.bits * i) & mask for i in range(self.fields)], 2).reshape(len(anchors), -1)[:, : self.n]
        out = fields - self.bias * whole.sum(1)[:, None] - self.anchor_bias * self.sums - self.dim * self.bias * self.anchor_bias
        if self.exact:
            return out
        return np.array([min(max(x, -LARGEST - 1), LARGEST) for x in out.ravel().tolist()], np.int64).reshape(out.shape)


def best(scores: np.ndarray, names: np.ndarray, nameless: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores; ties by name, null names last, then by row."""
    at = np.arange(len(scores))
    if len(scores) > k:
        floor = np.partition(scores, -k)[-k]
        at = np.flatnonzero(scores >= floor)
    return at[np.lexsort((rows[at], names[at], nameless[at], ~scores[at]))][:k]


def _numbers(column: pa.Array, i: int, kind: str = "<i8") -> np.ndarray:
    return np.asarray(column[i].values.to_numpy(zero_copy_only=False), kind)


def finite(vector: Column) -> Column:
    """Not null, and no component null or not finite."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def mine(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW_PERCENT,
    high: int = HIGH_PERCENT,
    scale: int = SCALE,
    key: str = "vec_id",
    vector: str = "embedding",
    label: Column | str = "label",
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score`` and ``negative_score``."""
    values = F.transform(F.col(vector), lambda x: x.cast("double"))
    labels = (F.col(label) if isinstance(label, str) else label).cast("long")
    source = rows.select(F.col(key).cast("long").alias("id"), labels.alias("label"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"), values.alias("v"))
    source = source.where(F.col("label").isNotNull() & finite(F.col("v"))).withColumns({"dim": F.size("v"), "row": F.monotonically_increasing_id()})
    # Written, so that row numbers are the same wherever they are read.
    source = materialize(source, "vectors")

    def grouped(chosen: DataFrame, by: list[str], name: str, size: int, most: int, columns: list[str]) -> DataFrame:
        """Rows in arrays, in groups of about ``size`` numbers within ``by``, with ``<name>s``, the number of groups."""
        fit = F.least(F.lit(most), F.greatest(F.lit(16), F.floor(F.lit(size) / F.greatest("dim", F.lit(1))))).cast("long")
        counts = chosen.groupBy(*by).agg(F.count("*").alias("__n"))
        dealt = chosen.join(counts, by).withColumn(f"{name}s", F.ceil(F.col("__n") / fit).cast("long"))
        dealt = dealt.withColumn(name, F.pmod(F.xxhash64("row"), F.col(f"{name}s")))
        items = F.sort_array(F.collect_list(F.struct("row", "id", "label", "v", *columns)))
        return dealt.groupBy(*by, name, f"{name}s").agg(items.alias("items"))

    def met(anchors: DataFrame, blocks: DataFrame, by: list[str], more: tuple[str, ...] = ()) -> DataFrame:
        """One row for each group of anchors, with ``more`` of their columns, and block of rows."""
        number = blocks.groupBy(*by).agg(F.max("blocks").alias("__blocks"))
        spread = anchors.join(number, by).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__blocks") - 1)))
        fields = ["row", "id", "label"]
        left = [F.col(f"items.{c}").alias(f"a_{c}") for c in (*fields, *more)] + [F.flatten("items.v").alias("a_v")]
        right = [F.col(f"items.{c}").alias(f"b_{c}") for c in fields] + [F.flatten("items.v").alias("b_v")]
        return spread.select(*by, "block", *left).join(blocks.select(*by, "block", *right), [*by, "block"])

    def read(batch: pa.RecordBatch, i: int, side: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Row numbers, ids, which ids are null, labels and whole-number vectors."""
        at = lambda name: batch.column(f"{side}_{name}")
        ids = at("id")[i].values
        names = ids.fill_null(0).to_numpy(zero_copy_only=False)
        found = _numbers(at("row"), i)
        vectors = whole_numbers(_numbers(at("v"), i, "<f8").reshape(len(found), -1), scale)
        return found, names, ids.is_null().to_numpy(zero_copy_only=False), _numbers(at("label"), i), vectors

    def steps(batch: pa.RecordBatch, i: int) -> Iterator[tuple]:
        """A few anchors at a time, with their scores."""
        anchors, block = read(batch, i, "a"), read(batch, i, "b")
        packed = Packed(block[4], int(anchors[4].min(initial=0)), int(anchors[4].max(initial=0)))
        for start in range(0, len(anchors[0]), STEP):
            few = [x[start : start + STEP] for x in anchors]
            yield start, few, block, packed.scores(few[4])

    near = "anchor_row long, row long, id long, score long"

    def same_label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                out: list[tuple[np.ndarray, ...]] = []
                for _, (own, _, _, _, _), (found, names, nameless, _, _), scores in steps(batch, i):
                    for row, line in zip(own, scores):
                        others = np.flatnonzero(found != row)
                        top = others[best(line[others], names[others], nameless[others], found[others], positives)]
                        out.append((np.full(len(top), row), found[top], names[top], nameless[top], line[top]))
                anchor, found, names, nameless, line = (np.concatenate(x) for x in zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor, pa.int64()), pa.array(found, pa.int64()), pa.array(names, pa.int64(), mask=nameless), pa.array(line, pa.int64())],
                    names=["anchor_row", "row", "id", "score"],
                )

    anchors = source.where("anchor")
    by_label = met(grouped(anchors, ["dim", "label"], "grp", GROUP_VALUES, BLOCK_ROWS, []), grouped(source, ["dim", "label"], "block", BLOCK_VALUES, BLOCK_ROWS, []), ["dim", "label"])
    order = Window.partitionBy("anchor_row").orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "row")
    chosen = by_label.mapInArrow(same_label, near).withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives)
    few = chosen.groupBy(F.col("anchor_row").alias("row")).agg(F.sort_array(F.collect_list(F.struct("place", "id", "score"))).alias("positives"))
    ready = materialize(anchors.join(few, "row"), "positives")

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                asked = batch.column("a_positives")[i].as_py()
                out: list[tuple] = []
                for start, (own, _, _, kinds, _), (found, names, nameless, labels_, _), scores in steps(batch, i):
                    for j, (row, kind, line) in enumerate(zip(own.tolist(), kinds, scores)):
                        other = np.flatnonzero(labels_ != kind)
                        line = line[other]
                        for positive in asked[start + j]:
                            least, most = -(-low * positive["score"] // 100), high * positive["score"] // 100
                            fit = other[(line >= least) & (line <= most)] if least <= most else other[:0]
                            value = scores[j][fit]
                            top = best(value, names[fit], nameless[fit], found[fit], negatives)
                            for t in top.tolist():
                                at = fit[t]
                                out.append((row, positive["place"], int(found[at]), None if nameless[at] else int(names[at]), int(value[t])))
                columns = list(zip(*out)) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["anchor_row", "place", "row", "id", "score"])

    all_rows = met(grouped(ready, ["dim"], "grp", GROUP_VALUES, BLOCK_ROWS, ["positives"]), grouped(source, ["dim"], "block", BLOCK_VALUES, BLOCK_ROWS, []), ["dim"], ("positives",))
    order = Window.partitionBy("anchor_row", "place").orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "row")
    ranked = all_rows.mapInArrow(between, "anchor_row long, place long, row long, id long, score long")
    ranked = ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    known = ready.select(F.col("row").alias("anchor_row"), F.col("id").alias("anchor_id"), F.explode("positives").alias("p"))
    known = known.select("anchor_row", "anchor_id", F.col("p.place").cast("long").alias("place"), F.col("p.id").alias("positive_id"), F.col("p.score").alias("positive_score"))
    return ranked.join(known, ["anchor_row", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
