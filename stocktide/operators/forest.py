"""Random forest on the feature matrix: fit, predict, importances, out-of-bag, folds.

The matrix is binned once and written as blocks of rows. Trees are grown in two
steps, after the way of large distributed tree learners:

1. Nodes of more than ``NODE_ROWS`` rows are split by histograms: each task adds
   up draws and labels by node, tried column and bin, the sums meet by node, and
   the best split of each node goes into the next pass. One pass splits all large
   nodes of a depth and of ``BATCH_TREES`` trees.
2. The rows of a smaller node meet in one task, which is bounded by ``NODE_ROWS``,
   and the node's subtree is finished there.

Both steps give the same tree, wherever the border lies. Finished trees are
written batch by batch; no task holds more than ``PACK_TREES`` of them. Which
rows a tree draws is a function of row and tree, so the trees themselves judge
the rows that they have not seen.
"""

from __future__ import annotations

import sys
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, new_path
from ..settings import DEFAULTS, ForestSettings
from . import trees as trees_module
from .prep import feature_matrix
from .scores import mae, mape, median_ape, r2, rmse
from .trees import Tree, TreeRules, bag_of, best_splits, draws, from_bytes, grow, groups_of, histograms, joined, to_bytes, tried_features

# The functions travel to the workers by value, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(trees_module)

FOREST = DEFAULTS.forest

#: Rows of a node that one task may finish; trees that are grown in one job; trees and blocks that meet in one task.
NODE_ROWS = 1_000_000
BATCH_TREES = 100
PACK_TREES, PACK_BLOCKS = 25, 40
#: Bins of a column, rows of a block, and rows that the bins' borders are taken from.
BINS, BLOCK_ROWS, EDGE_ROWS = 32, 10_000, 20_000
#: Leading bits of a hash that rows are counted by.
BAND_BITS = 12

BLOCKS = "block long, product_id array<string>, date array<date>, day binary, side array<string>, label binary, row_key binary, bins binary"
PIECES = "model int, tree int, path long, column binary, cut binary, left binary, value binary, gains array<double>"


@dataclass(frozen=True)
class Span:
    """The days that a model learns from (before ``before``; all if None) and judges (null: all)."""

    before: int | None = None
    test_from: int | None = None
    test_to: int | None = None


@dataclass(frozen=True)
class Forest:
    """A trained forest: its trees are a written table of pieces, one row or more per tree."""

    pieces: DataFrame
    edges: list[np.ndarray]
    rules: TreeRules
    n_trees: int
    spans: tuple[Span, ...] = (Span(),)


def bin_edges(matrix: DataFrame, bins: int = BINS, rows: int = EDGE_ROWS) -> list[np.ndarray]:
    """Borders between the bins of each column, from up to ``rows`` rows chosen by a hash of the key.

    A column of few values has a border between any two of them.
    """
    keyed = matrix.withColumn("h", F.xxhash64("product_id", "date"))
    # The chosen rows lie in the first bands of hashes. Only rows of these are ranked, and by tasks: a
    # ranking that ends in a collect would send ``rows`` rows of every partition to the driver.
    band = F.shiftright("h", 64 - BAND_BITS)
    counts = keyed.groupBy(band.alias("band")).count().orderBy("band").collect()  # one per band
    before = np.cumsum([0, *(r["count"] for r in counts)])
    last = next((r.band for r, n in zip(counts, before[1:]) if n >= rows), None)
    near = keyed if last is None else keyed.where(band <= last)
    chosen = near.select("h", vector_to_array("features").alias("x")).orderBy("h", "x").limit(rows)
    x = np.array([r.x for r in materialize(chosen.select("x"), "edge_rows").collect()], float)  # ``rows`` at most
    edges = []
    for column in x.T if len(x) else ():
        known = np.unique(column)
        if len(known) <= bins:
            edges.append((known[1:] + known[:-1]) / 2)
        else:
            edges.append(np.unique(np.quantile(column, np.arange(1, bins) / bins)))
    return edges


def binned_blocks(matrix: DataFrame, edges: Sequence[np.ndarray]) -> DataFrame:
    """The rows of a matrix in blocks of about ``BLOCK_ROWS``, written: a byte per row and column."""
    side = F.col("side") if "side" in matrix.columns else F.lit(None).cast("string")
    rows = matrix.select(
        "product_id", "date", F.unix_date("date").cast("long").alias("day"), side.alias("side"), "label",
        F.xxhash64("product_id", "date").alias("row_key"), vector_to_array("features").alias("x"),
    )
    names, most = [c.split()[0] for c in BLOCKS.split(", ")], BLOCK_ROWS

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for start in range(0, len(batch), most):
                some = batch.slice(start, most)
                get = lambda name: some.column(name).to_numpy(zero_copy_only=False)  # noqa: E731,B023
                x = some.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(some), -1)
                bins = np.empty(x.shape, np.uint8)
                for i, borders in enumerate(edges):
                    bins[:, i] = np.searchsorted(borders, x[:, i], "left")
                one = lambda value: pa.array([value], pa.binary())
                whole = lambda name: pa.ListArray.from_arrays([0, len(some)], some.column(name))  # noqa: E731,B023
                columns = [
                    pa.array([number], pa.int64()), whole("product_id"), whole("date"), one(get("day").astype("<i8").tobytes()), whole("side"),
                    one(get("label").astype("<f8").tobytes()), one(get("row_key").astype("<i8").tobytes()), one(bins.tobytes()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)
                number += 1

    return materialize(rows.mapInArrow(pack, BLOCKS), "blocks")


def _read(batch: pa.RecordBatch, i: int, features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bins, labels, row keys and days of a block."""
    get = lambda name, kind: np.frombuffer(batch.column(name)[i].as_py(), kind)
    return get("bins", "u1").reshape(-1, features), get("label", "<f8"), get("row_key", "<i8"), get("day", "<i8")


class _Top:
    """The upper part of a tree while its large nodes are being split; open leaves hold minus their path in place of a child."""

    def __init__(self, large: bool):
        self.column, self.cut, self.left, self.value = [-1], [0], [-1], [0.0]
        self.place = {1: 0}
        self.large = [1] if large else []
        self.gains: dict[int, float] = defaultdict(float)

    def tree(self) -> Tree:
        return Tree(np.array(self.column, np.int16), np.array(self.cut, np.uint8), np.array(self.left, np.int32), np.array(self.value))

    def split(self, found: dict, rules: TreeRules, most: int) -> None:
        """Split a large node, or close it with its mean where nothing is gained."""
        at, path = self.place[found["path"]], found["path"]
        if found["gain"] <= 0 or path.bit_length() > rules.max_depth:
            self.left[at], self.value[at] = 0, found["mean"]
            return
        self.column[at], self.cut[at], self.left[at] = found["column"], found["cut"], len(self.column)
        self.gains[found["column"]] += found["gain"]
        for child, rows in ((2 * path, found["left_rows"]), (2 * path + 1, found["right_rows"])):
            self.place[child] = len(self.column)
            self.column.append(-1)
            self.cut.append(0)
            self.left.append(-child)
            self.value.append(0.0)
            if rows > most:
                self.large.append(child)


def _split_large(blocks: DataFrame, tops: dict[tuple[int, int], _Top], spans: tuple[Span, ...], rules: TreeRules, features: int, most: int) -> None:
    """Split all nodes of more than ``most`` rows, one depth a pass."""
    while any(top.large for top in tops.values()):
        work = {at: (top.tree(), np.array(sorted(top.large), np.int64)) for at, top in tops.items() if top.large}

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[tuple[int, int, int], np.ndarray] = {}
            for batch in batches:
                for i in range(len(batch)):
                    rows, y, keys, day = _read(batch, i, features)
                    for (model, tree), (top, large) in work.items():
                        w = bag_of(keys, day, spans[model].before, tree, rules.seed)
                        path = -top.left[top.walk(rows)].astype(np.int64)
                        node = np.searchsorted(large, path)
                        here = np.flatnonzero((w > 0) & (node < len(large)) & (large[np.minimum(node, len(large) - 1)] == path))
                        columns = tried_features(large, tree, features, rules)
                        n, total = histograms(rows, here, y[here], w[here].astype(float), node[here], columns, rules.bins)
                        drawn = np.bincount(node[here], minlength=len(large)).astype(float)
                        for j, p in enumerate(large.tolist()):
                            own = np.concatenate([n[j].ravel(), total[j].ravel(), drawn[j : j + 1]])
                            sums[model, tree, p] = sums[model, tree, p] + own if (model, tree, p) in sums else own
            ids = list(zip(*sums)) or [(), (), ()]
            columns = [pa.array(ids[0], pa.int32()), pa.array(ids[1], pa.int32()), pa.array(ids[2], pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["model", "tree", "path", "sums"])

        def choose(table: pa.Table) -> pa.Table:
            model, tree, path = (table[c][0].as_py() for c in ("model", "tree", "path"))
            sums = np.sum([np.frombuffer(x, "<f8") for x in table["sums"].to_pylist()], axis=0)
            n, total = sums[:-1].reshape(2, 1, rules.tried, rules.bins)
            place, cut, gain = (x[0] for x in best_splits(n, total, rules.min_leaf_rows))
            left, whole = float(n[0, place, : cut + 1].sum()), float(n[0, 0].sum())
            column = int(tried_features(np.array([path]), tree, features, rules)[0, place])
            # Distinct rows are what a task has to hold; they are in proportion to the draws.
            share = float(sums[-1]) / max(whole, 1.0)
            row = {
                "model": model, "tree": tree, "path": path, "column": column, "cut": int(cut), "gain": float(gain),
                "mean": float(total[0, 0].sum()) / max(whole, 1.0), "left_rows": left * share, "right_rows": (whole - left) * share,
            }
            return pa.Table.from_pylist([row], schema=_SPLIT_ARROW)

        counted = blocks.select("block", "day", "label", "row_key", "bins").mapInArrow(count, "model int, tree int, path long, sums binary")
        for top in tops.values():
            top.large = []
        for row in counted.groupBy("model", "tree", "path").applyInArrow(choose, _SPLIT).collect():  # one per large node
            tops[row.model, row.tree].split(row.asDict(), rules, most)


_SPLIT = "model int, tree int, path long, column int, cut int, gain double, mean double, left_rows double, right_rows double"
_ARROW = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64()}
_SPLIT_ARROW = pa.schema([(name, _ARROW[kind]) for name, kind in (field.split() for field in _SPLIT.split(", "))])


def _finish(blocks: DataFrame, tops: dict[tuple[int, int], _Top], spans: tuple[Span, ...], rules: TreeRules, features: int) -> DataFrame:
    """Pieces of the trees: the rows of every node that is left meet and are split there."""
    parts = {at: top.tree() for at, top in tops.items()}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                rows, y, keys, day = _read(batch, i, features)
                for (model, tree), top in parts.items():
                    w = bag_of(keys, day, spans[model].before, tree, rules.seed)
                    drawn = np.flatnonzero(w)
                    ended = top.walk(rows[drawn]) if len(top.column) > 1 else np.zeros(len(drawn), np.int32)
                    found = [(int(-top.left[n]), drawn[at]) for n, at in groups_of(ended) if top.left[n] < 0]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "model": pa.array([model] * len(found), pa.int32()),
                            "tree": pa.array([tree] * len(found), pa.int32()),
                            "path": pa.array([p for p, _ in found], pa.int64()),
                            "block": pa.array([batch.column("block")[i].as_py()] * len(found), pa.int64()),
                            "bins": pa.array([rows[at].tobytes() for _, at in found], pa.binary()),
                            "label": pa.array([y[at].tobytes() for _, at in found], pa.binary()),
                            "drawn": pa.array([w[at].tobytes() for _, at in found], pa.binary()),
                        }
                    )

    def finish(table: pa.Table) -> pa.Table:
        model, tree, path = (table[c][0].as_py() for c in ("model", "tree", "path"))
        order = np.argsort(table["block"].to_numpy())  # sums do not depend on which block came first
        whole = lambda name, kind: np.concatenate([np.frombuffer(table[name][int(i)].as_py(), kind) for i in order])
        made, gains = grow(whole("bins", "u1").reshape(-1, features), whole("label", "<f8"), whole("drawn", "u1").astype(float), tree, rules, path)
        row = {"model": model, "tree": tree, "path": path, **to_bytes(made), "gains": gains.tolist()}
        return pa.Table.from_pylist([row], schema=_PIECE_ARROW)

    dealt = blocks.select("block", "day", "label", "row_key", "bins").mapInArrow(
        deal, "model int, tree int, path long, block long, bins binary, label binary, drawn binary"
    )
    # A task for about every tree, so that cores do not wait for the one with the most trees.
    return dealt.repartition(max(8, len(tops)), "model", "tree", "path").groupBy("model", "tree", "path").applyInArrow(finish, PIECES)


_PIECE_ARROW = pa.schema(
    [("model", pa.int32()), ("tree", pa.int32()), ("path", pa.int64()), *((c, pa.binary()) for c in ("column", "cut", "left", "value")), ("gains", pa.list_(pa.float64()))]
)


def _tried(subset: str | int, features: int) -> int:
    named = {"sqrt": int(features**0.5), "all": features, "onethird": features // 3}
    return min(features, max(1, named[subset] if isinstance(subset, str) else subset))


def fit_blocks(blocks: DataFrame, edges: list[np.ndarray], s: ForestSettings = FOREST, spans: tuple[Span, ...] = (Span(),), node_rows: int | None = None) -> Forest:
    """Grow the trees of one model per span, ``BATCH_TREES`` of a model in a job."""
    features, most = len(edges), node_rows or NODE_ROWS
    rules = TreeRules(max([2, *(len(e) + 1 for e in edges)]), s.max_depth, s.min_leaf_rows, _tried(s.feature_subset, features), s.seed)
    spark, path = blocks.sparkSession, new_path(blocks.sparkSession, "forest")
    rows = blocks.agg(F.sum(F.octet_length("day") / 8)).first()[0] or 0
    for model in range(len(spans)):
        for first in range(0, s.trees, BATCH_TREES):
            # A tree draws about 0.63 of the rows.
            tops = {(model, tree): _Top(rows * 0.64 > most) for tree in range(first, min(first + BATCH_TREES, s.trees))}
            _split_large(blocks, tops, spans, rules, features, most)
            pieces = _finish(blocks, tops, spans, rules, features)
            upper = [
                (model, tree, 0, *to_bytes(top.tree()).values(), [top.gains.get(i, 0.0) for i in range(features)])
                for (model, tree), top in tops.items()
                if top.left != [-1]
            ]
            pieces.write.mode("append").parquet(path)
            if upper:
                spark.createDataFrame(upper, PIECES).write.mode("append").parquet(path)
    if not spans or not s.trees:
        raise ValueError("a forest needs trees and a model")
    return Forest(spark.read.schema(PIECES).parquet(path), edges, rules, s.trees, spans)


def fit_forest(matrix: DataFrame, s: ForestSettings = FOREST, edges: list[np.ndarray] | None = None, node_rows: int | None = None, **overrides) -> Forest:
    """Train on a ``label`` and ``features`` table with the keys product_id and date.

    ``overrides`` replace single settings, such as ``trees`` or ``max_depth``.
    """
    edges = bin_edges(matrix) if edges is None else edges
    return fit_blocks(binned_blocks(matrix, edges), edges, replace(s, **overrides), node_rows=node_rows)


def _assembled(rows: list[dict]) -> dict[tuple[int, int], Tree]:
    """Whole trees from their pieces."""
    by_tree: dict[tuple[int, int], dict[int, Tree]] = defaultdict(dict)
    for row in rows:
        by_tree[row["model"], row["tree"]][row["path"]] = from_bytes(row)
    return {at: joined(found.pop(0), found) if 0 in found else found[1] for at, found in by_tree.items()}


def judge_blocks(forest: Forest, blocks: DataFrame) -> DataFrame:
    """``product_id``, ``date``, ``side``, ``model``, ``actual``, ``predicted``, ``oob_predicted`` and ``oob_votes``.

    Packs of trees meet packs of blocks; each pair adds up its trees' values per
    row, and the sums meet by block. Out of bag are the trees that have not drawn
    a row; without any the prediction is null.
    """
    features, rules, spans = len(forest.edges), forest.rules, forest.spans
    packs = -(-forest.n_trees // PACK_TREES)
    placed = blocks.withColumn("chunk", F.pmod(F.xxhash64("block"), F.lit(max(1, -(-blocks.count() // PACK_BLOCKS)))))
    chunks = blocks.sparkSession.range(max(1, -(-blocks.count() // PACK_BLOCKS))).select(F.col("id").alias("chunk"))
    met_blocks = placed.select("chunk", "block", "day", "label", "row_key", "bins").crossJoin(blocks.sparkSession.range(packs).select(F.col("id").alias("pack")))
    met_trees = forest.pieces.drop("gains").withColumn("pack", F.floor(F.col("tree") / PACK_TREES)).join(F.broadcast(chunks), how="cross")

    def add(left: pa.Table, right: pa.Table) -> pa.Table:
        whole = _assembled(right.drop_columns(["pack", "chunk"]).to_pylist())
        batch = left.combine_chunks().to_batches()[0] if len(left) else None
        out: dict[str, list] = {"block": [], "model": [], "total": [], "oob_total": [], "oob_votes": []}
        for i in range(len(left)):
            rows, _, keys, day = _read(batch, i, features)
            for model, span in enumerate(spans):
                asked = np.arange(len(day)) if span.test_from is None else np.flatnonzero((day >= span.test_from) & (day <= span.test_to))
                total, oob, votes = np.zeros(len(day)), np.zeros(len(day)), np.zeros(len(day), np.int32)
                for (own, tree), found in whole.items() if len(asked) else ():
                    if own == model:
                        value = found.predict(rows[asked])
                        unseen = draws(keys[asked], tree, rules.seed) == 0
                        total[asked] += value
                        oob[asked] += value * unseen
                        votes[asked] += unseen
                if len(asked):
                    for name, value in (("block", batch.column("block")[i].as_py()), ("model", model), ("total", total.tobytes()), ("oob_total", oob.tobytes()), ("oob_votes", votes.tobytes())):
                        out[name].append(value)
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        return pa.table({name: pa.array(values, kind) for (name, values), kind in zip(out.items(), kinds)})

    sums = met_blocks.groupBy("pack", "chunk").cogroup(met_trees.groupBy("pack", "chunk"))
    sums = sums.applyInArrow(add, "block long, model int, total binary, oob_total binary, oob_votes binary")
    ranges = [(span.test_from, span.test_to) for span in spans]
    trees = forest.n_trees

    def spread(left: pa.Table, right: pa.Table) -> pa.Table:
        """The rows of a block with the sums of all packs."""
        out = []
        for model in sorted(set(right["model"].to_pylist())) if len(left) else ():
            own = [r for r in right.to_pylist() if r["model"] == model]
            add_up = lambda name, kind: np.sum([np.frombuffer(r[name], kind) for r in own], axis=0)  # noqa: E731,B023
            total, oob, votes = add_up("total", "<f8"), add_up("oob_total", "<f8"), add_up("oob_votes", "<i4")
            day = np.frombuffer(left["day"][0].as_py(), "<i8")
            first, last = ranges[model]
            asked = np.arange(len(day)) if first is None else np.flatnonzero((day >= first) & (day <= last))
            take = pa.array(asked)
            out.append(
                pa.table(
                    {
                        "product_id": left["product_id"].combine_chunks().flatten().take(take),
                        "date": left["date"].combine_chunks().flatten().take(take),
                        "side": left["side"].combine_chunks().flatten().take(take),
                        "model": pa.array(np.full(len(asked), model), pa.int32()),
                        "actual": pa.array(np.frombuffer(left["label"][0].as_py(), "<f8")[asked]),
                        "predicted": pa.array(total[asked] / trees),
                        "oob_predicted": pa.array(oob[asked] / np.maximum(votes[asked], 1), mask=votes[asked] == 0),
                        "oob_votes": pa.array(votes[asked].astype(np.int32)),
                    }
                )
            )
        return pa.concat_tables(out) if out else _JUDGED.empty_table()

    schema = "product_id string, date date, side string, model int, actual double, predicted double, oob_predicted double, oob_votes int"
    rows = blocks.select("block", "product_id", "date", "side", "day", "label")
    return rows.groupBy("block").cogroup(sums.groupBy("block")).applyInArrow(spread, schema)


_JUDGED = pa.schema(
    [("product_id", pa.string()), ("date", pa.date32()), ("side", pa.string()), ("model", pa.int32()), *((c, pa.float64()) for c in ("actual", "predicted", "oob_predicted")), ("oob_votes", pa.int32())]
)


def predict(forest: Forest, matrix: DataFrame) -> DataFrame:
    """Forecast rows (product_id, date, actual, predicted) next to the side, if the matrix has it."""
    judged = judge_blocks(forest, binned_blocks(matrix, forest.edges))
    keep = [c for c in ("side",) if c in matrix.columns]
    return judged.select("product_id", "date", *keep, "actual", "predicted")


def out_of_bag(forest: Forest, matrix: DataFrame) -> DataFrame:
    """The training rows with ``predicted``, the mean over the trees that have not drawn them, and ``votes``."""
    judged = judge_blocks(forest, binned_blocks(matrix, forest.edges))
    return judged.select("product_id", "date", "actual", F.col("oob_predicted").alias("predicted"), F.col("oob_votes").alias("votes"))


def side_metrics(predicted: DataFrame) -> DataFrame:
    """One row of the full metric set for each of train and test."""
    predicted = materialize(predicted, "predictions")
    sides = []
    for side in ("train", "test"):
        rows = predicted.where(F.col("side") == side)
        sides.append(
            rows.agg(
                F.lit(side).alias("side"),
                mape("actual", "predicted").alias("mape"),
                rmse("actual", "predicted").alias("rmse"),
                mae("actual", "predicted").alias("mae"),
                r2("actual", "predicted").alias("r2"),
            ).withColumn("mdape", median_ape(rows, "actual", "predicted").scalar())
        )
    return sides[0].unionByName(sides[1])


def importances(forest: Forest, columns: Sequence[str], df: DataFrame) -> DataFrame:
    """Feature and importance, highest first; one row per model input.

    A tree's importance of a column is its share of the tree's gains; the
    forest's is the mean over the trees that gained anything.
    """
    by_column = forest.pieces.where("model = 0").select("tree", F.posexplode("gains").alias("at", "gain")).groupBy("tree", "at").agg(F.sum("gain").alias("gain"))
    whole = by_column.groupBy("tree").agg(F.sum("gain").alias("whole")).where("whole > 0")
    shares = by_column.join(whole, "tree").groupBy("at").agg(F.avg(F.col("gain") / F.col("whole")).alias("importance"))
    names = df.sparkSession.createDataFrame(list(enumerate(columns)), "at int, feature string")
    table = names.join(shares, "at", "left").select("feature", F.coalesce("importance", F.lit(0.0)).alias("importance"))
    return table.orderBy(F.desc("importance"), "feature")


def important_columns(ranked: DataFrame, threshold: float = FOREST.importance_threshold) -> list[str]:
    """Names of the inputs at or above the threshold; at most one per model input."""
    return [row.feature for row in ranked.where(F.col("importance") >= threshold).collect()]


def fold_spans(labels: DataFrame) -> tuple[Span, ...]:
    """The days of each fold, in order."""
    day = F.unix_date("date")
    rows = labels.where("role = 'test'").groupBy("fold").agg(F.min(day).alias("a"), F.max(day).alias("b")).orderBy("fold").collect()  # one per fold
    return tuple(Span(r.a, r.a, r.b) for r in rows)


def cross_validate(matrix: DataFrame, labels: DataFrame, folds: int = FOREST.folds, s: ForestSettings = FOREST, **overrides) -> DataFrame:
    """One row of scores per expanding time fold; all folds read one binned matrix."""
    spans = fold_spans(labels.where(F.col("fold") <= folds))
    edges = bin_edges(matrix)
    blocks = binned_blocks(matrix, edges)
    judged = judge_blocks(fit_blocks(blocks, edges, replace(s, **overrides), spans), blocks)
    return judged.groupBy((F.col("model") + 1).alias("fold")).agg(
        F.count("*").alias("n_test"),
        mape("actual", "predicted").alias("mape"),
        rmse("actual", "predicted").alias("rmse"),
        r2("actual", "predicted").alias("r2"),
    )


def reduced_matrix(features: DataFrame, ranked: DataFrame, threshold: float = FOREST.importance_threshold) -> DataFrame:
    """The feature matrix without the inputs below the importance threshold."""
    return feature_matrix(features, important_columns(ranked, threshold))
