"""The forest against plain loops, and its two ways of growing against each other."""

import dataclasses
import datetime as dt

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from __spark_entry__ import queries
from stocktide.operators import forest, prep, trees
from stocktide.operators.calendar import calendar_of
from stocktide.plans.features import feature_table, sided_features
from stocktide.registry import models

SMALL = dataclasses.replace(forest.FOREST, trees=6, max_depth=7, min_leaf_rows=3)
RULES = trees.TreeRules(8, 5, 2, 3, 7)


def binned(n=300, features=6, bins=8, seed=1):
    rng = np.random.default_rng(seed)
    rows = rng.integers(0, bins, (n, features)).astype(np.uint8)
    y = np.round(rows[:, 0] * 3.0 + rows[:, 1] * rows[:, 2] + rng.normal(0, 2, n))
    return rows, y, rng.integers(1, 4, n).astype(float)


def plain_grow(rows, y, w, tree, rules, path=1):
    """{path: (column, cut) or mean} by trying every split of every node."""
    out = {path: float((w * y).sum() / w.sum())}
    if path.bit_length() > rules.max_depth or w.sum() < 2 * rules.min_leaf_rows or len(np.unique(y)) == 1:
        return out
    best = (0.0, None, None)
    for column in trees.tried_features(np.array([path]), tree, rows.shape[1], rules)[0]:
        for cut in range(rules.bins - 1):
            left = rows[:, column] <= cut
            n = (w[left].sum(), w[~left].sum())
            if min(n) < rules.min_leaf_rows:
                continue
            gain = (w * y)[left].sum() ** 2 / n[0] + (w * y)[~left].sum() ** 2 / n[1] - (w * y).sum() ** 2 / w.sum()
            if gain > best[0] + 1e-9 * (w * y).sum() ** 2:
                best = (gain, int(column), cut)
    if best[1] is None:
        return out
    left = rows[:, best[1]] <= best[2]
    out[path] = best[1:]
    return out | plain_grow(rows[left], y[left], w[left], tree, rules, 2 * path) | plain_grow(rows[~left], y[~left], w[~left], tree, rules, 2 * path + 1)


def paths_of(tree):
    out, todo = {}, [(0, 1)]
    while todo:
        at, path = todo.pop()
        if tree.column[at] < 0:
            out[path] = float(tree.value[at])
        else:
            out[path] = (int(tree.column[at]), int(tree.cut[at]))
            todo += [(int(tree.left[at]), 2 * path), (int(tree.left[at]) + 1, 2 * path + 1)]
    return out


def alike(found, expected):
    """The same splits, and nearly the same means."""
    assert found.keys() == expected.keys()
    for path, node in found.items():
        assert node == expected[path] if isinstance(node, tuple) else node == pytest.approx(expected[path])


@pytest.mark.parametrize("at_once", [1, 3, 2048])
def test_a_tree_against_plain_loops(monkeypatch, at_once):
    monkeypatch.setattr(trees, "NODES_AT_ONCE", at_once)
    rows, y, w = binned()
    for tree in range(4):
        grown, gains = trees.grow(rows, y, w, tree, RULES)
        alike(paths_of(grown), plain_grow(rows, y, w, tree, RULES))
        error = (w * (y - (w * y).sum() / w.sum()) ** 2).sum() - (w * (y - grown.predict(rows)) ** 2).sum()
        assert gains.sum() == pytest.approx(error)


def test_trees_of_odd_rows():
    rows, y, w = binned(5)
    assert len(trees.grow(rows, y * 0, w, 0, RULES)[0].column) == 1
    one = trees.grow(rows[:1], y[:1], w[:1], 0, RULES)[0]
    assert one.predict(rows).tolist() == [y[0]] * 5


def test_draws_are_those_of_a_bag():
    keys = np.arange(50_000, dtype=np.int64) * 7919
    w = trees.draws(keys, 3, 42)
    assert (w == trees.draws(keys, 3, 42)).all() and (w != trees.draws(keys, 4, 42)).any()
    assert w.mean() == pytest.approx(1, abs=0.02) and (w == 0).mean() == pytest.approx(0.3679, abs=0.01)


def matrix_of(spark, n=400, seed=4, days=40):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        x = [float(rng.integers(0, 5)), float(rng.normal()), float(rng.integers(0, 2)), 1.0]
        label = float(np.round(10 * x[0] + 5 * x[1] + rng.normal()))
        rows.append((f"p{i // days}", dt.date(2023, 1, 1) + dt.timedelta(days=i % days), "train", label, x))
    schema = "product_id string, date date, side string, label double, features array<double>"
    return spark.createDataFrame(rows, schema).withColumn("features", array_to_vector("features"))


def all_trees(made):
    rows = [r.asDict() for r in made.pieces.collect()]
    return {at: paths_of(tree) for at, tree in forest._assembled(rows).items()}


def test_large_nodes_give_the_same_trees(spark, monkeypatch):
    matrix = matrix_of(spark)
    edges = forest.bin_edges(matrix)
    monkeypatch.setattr(forest, "BLOCK_ROWS", 64)
    whole = forest.fit_forest(matrix, SMALL, edges)
    for node_rows in (150, 40):
        parted = forest.fit_forest(matrix, SMALL, edges, node_rows=node_rows)
        assert parted.pieces.count() > SMALL.trees
        found, expected = all_trees(parted), all_trees(whole)
        assert found.keys() == expected.keys()
        for at in found:
            alike(found[at], expected[at])
        a, b = (forest.importances(f, "abcd", matrix).collect() for f in (whole, parted))
        assert [r.feature for r in a] == [r.feature for r in b] and [r.importance for r in a] == pytest.approx([r.importance for r in b])


def test_forecasts_and_out_of_bag_against_the_trees(spark, monkeypatch):
    for name, value in (("BLOCK_ROWS", 64), ("PACK_TREES", 2), ("PACK_BLOCKS", 3), ("BATCH_TREES", 4)):
        monkeypatch.setattr(forest, name, value)
    matrix = matrix_of(spark)
    made = forest.fit_forest(matrix, SMALL)
    whole = forest._assembled([r.asDict() for r in made.pieces.collect()])
    assert sorted(whole) == [(0, t) for t in range(SMALL.trees)]
    rows = matrix.select("product_id", "date", "label", F.xxhash64("product_id", "date").alias("k"), "features").collect()
    predicted = {(r.product_id, r.date): r for r in forest.predict(made, matrix).collect()}
    judged = {(r.product_id, r.date): r for r in forest.out_of_bag(made, matrix).collect()}
    assert len(predicted) == len(judged) == len(rows)
    for r in rows:
        bins = np.array([[np.searchsorted(e, v, "left") for e, v in zip(made.edges, r.features)]], np.uint8)
        values = [tree.predict(bins)[0] for _, tree in sorted(whole.items())]
        unseen = [v for t, v in enumerate(values) if trees.draws(np.array([r.k]), t, SMALL.seed)[0] == 0]
        got, oob = predicted[r.product_id, r.date], judged[r.product_id, r.date]
        assert (got.side, got.actual) == ("train", r.label) and got.predicted == pytest.approx(np.mean(values))
        assert oob.votes == len(unseen) and (oob.predicted == pytest.approx(np.mean(unseen)) if unseen else oob.predicted is None)


def test_a_row_that_no_tree_saw_scores_worse_than_one_that_it_saw(spark):
    """Labels of noise alone: trees know the rows that they drew, and nothing of the others."""
    matrix = matrix_of(spark, 600).withColumn("label", F.pmod(F.xxhash64("product_id", "date", F.lit(1)), F.lit(100)).cast("double"))
    made = forest.fit_forest(matrix, SMALL, trees=30, max_depth=12, min_leaf_rows=1)
    seen = forest.predict(made, matrix).agg(forest.r2("actual", "predicted")).first()[0]
    unseen = forest.out_of_bag(made, matrix).agg(forest.r2("actual", "predicted")).first()[0]
    assert seen > 0.15 and unseen < 0.05


def test_folds_learn_from_the_days_before_alone(spark):
    matrix = matrix_of(spark, 600, days=60)
    labels = prep.fold_labels(matrix.select("date").distinct())
    scores = forest.cross_validate(matrix, labels, s=SMALL).orderBy("fold").collect()
    assert [(r.fold, r.n_test) for r in scores] == [(k, 100) for k in range(1, 6)] and all(r.r2 > 0.3 for r in scores)
    # A fold alone, from its own rows, gives the same trees.
    span = forest.fold_spans(labels)[1]
    edges = forest.bin_edges(matrix)
    alone = forest.fit_forest(matrix.where(F.unix_date("date") < span.before), SMALL, edges)
    blocks = forest.binned_blocks(matrix, edges)
    both = forest.fit_blocks(blocks, edges, SMALL, forest.fold_spans(labels))
    found, expected = all_trees(both), all_trees(alone)
    for tree in range(SMALL.trees):
        alike(found[1, tree], expected[0, tree])


def test_forest_on_features(series):
    rng = np.random.default_rng(8)
    demand = series({f"p{i}": rng.poisson(10 + 5 * i + 4 * (np.arange(500) % 7 > 4)) for i in range(3)})
    sided = sided_features(feature_table(demand, calendar_of(demand)))
    matrix, columns = prep.feature_matrix(sided).cache(), prep.feature_columns(sided)
    made = forest.fit_forest(matrix.where("side = 'train'"), trees=10, max_depth=8)
    metrics = {r.side: r for r in forest.side_metrics(forest.predict(made, matrix)).collect()}
    assert metrics["train"].r2 > 0.5 and metrics["test"].mdape is not None
    ranked = forest.importances(made, columns, matrix)
    assert ranked.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    assert 0 < len(forest.important_columns(ranked, 0.001)) < len(columns)


def test_an_empty_side_gives_no_rows(spark):
    matrix = matrix_of(spark, 80)
    made = forest.fit_forest(matrix, SMALL)
    assert forest.predict(made, matrix.where("side = 'test'")).collect() == []


def test_registered_forests_have_the_default_size(spark, folder, monkeypatch):
    asked, real = [], forest.fit_blocks
    monkeypatch.setattr(forest, "fit_blocks", lambda b, e, s=forest.FOREST, *a, **k: asked.append(s) or real(b, e, dataclasses.replace(s, trees=2, max_depth=3), *a, **k))
    monkeypatch.setattr(models, "_FORESTS", {})
    for name in ("i8_forest_forecasts", "i11_out_of_bag", "i13_cross_validation"):
        queries()[name](spark, folder)
    assert {(s.trees, s.max_depth, s.min_leaf_rows) for s in asked} == {(500, 20, 5)} and len(asked) == 2


@pytest.mark.parametrize("rows", [1, 50, 399, 400, 1000])
def test_edges_come_from_the_first_rows_by_hash(spark, rows):
    matrix = matrix_of(spark).unionByName(matrix_of(spark, seed=5))  # each key twice
    keyed = matrix.select(F.xxhash64("product_id", "date").alias("h"), "features").collect()
    x = np.array([r.features.toArray() for r in sorted(keyed, key=lambda r: (r.h, list(r.features)))[:rows]])
    for found, column in zip(forest.bin_edges(matrix, 4, rows), x.T):
        known = np.unique(column)
        expected = (known[1:] + known[:-1]) / 2 if len(known) <= 4 else np.unique(np.quantile(column, [0.25, 0.5, 0.75]))
        assert found.tolist() == expected.tolist()


def test_edges_of_many_partitions_send_the_driver_little(spark, monkeypatch):
    """The ranking is done by tasks; what is collected is a count per band and the chosen rows."""
    kept, real = [], forest.materialize
    monkeypatch.setattr(forest, "materialize", lambda df, name: kept.append((name, real(df, name))) or kept[-1][1])
    edges = forest.bin_edges(matrix_of(spark).repartition(16), rows=100)
    assert [name for name, _ in kept] == ["edge_rows"] and kept[0][1].count() == 100 and len(edges) == 4


@pytest.mark.parametrize("labels, at_once", [("whole", True), ("negative", True), ("fractions", False), ("huge", False)])
def test_draws_and_labels_in_one_number(labels, at_once):
    rows, y, w = binned(2000)
    y = {"whole": y, "negative": -y, "fractions": y / 3, "huge": y * 2.0**45}[labels]
    assert bool(trees._scale(w, w * y)) == at_once
    here, node = np.arange(2000), np.repeat(np.arange(4), 500)
    columns = trees.tried_features(np.arange(1, 5), 0, 6, RULES)
    count, total = trees.histograms(rows, here, y, w, node, columns, RULES.bins)
    for n in range(4):
        for i, column in enumerate(columns[n]):
            bins = rows[node == n, column]
            assert (count[n, i] == np.bincount(bins, w[node == n], RULES.bins)).all()
            assert (total[n, i] == np.bincount(bins, (w * y)[node == n], RULES.bins)).all()
