"""Growing and walking regression trees over binned rows, with numpy.

A node is named by its path: the root is 1, the children of p are 2p and 2p + 1.
What a node may look at follows from its path and its tree, so a subtree comes
out the same in whichever task it is grown.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Nodes whose histograms are held at once.
NODES_AT_ONCE = 2048
#: Cumulative Poisson(1) probabilities of 0, 1, 2, .. draws.
POISSON_ONE = np.array([0.36787944, 0.73575888, 0.91969860, 0.98101184, 0.99634015, 0.99940582, 0.99991676])


@dataclass(frozen=True)
class TreeRules:
    """What all trees of a forest have in common."""

    bins: int
    max_depth: int
    min_leaf_rows: int
    tried: int
    seed: int


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of unsigned 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def draws(keys: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is drawn for a tree: Poisson(1) from a hash of row and tree.

    Training and judging ask the same function, so a row is out of the bag of a
    tree exactly if that tree has not seen it.
    """
    salt = mix64(np.array([(seed << 32) + tree + 1], np.uint64))
    u = (mix64(keys.view(np.uint64) ^ salt) >> np.uint64(11)).astype(np.float64) / float(1 << 53)
    return np.searchsorted(POISSON_ONE, u, "right").astype(np.uint8)


def tried_features(paths: np.ndarray, tree: int, features: int, rules: TreeRules) -> np.ndarray:
    """The columns that each node may split on: one row per node."""
    salt = mix64(np.array([(rules.seed << 32) + tree + 1], np.uint64))
    order = mix64(mix64(paths.astype(np.uint64) ^ salt)[:, None] + np.arange(1, features + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return np.sort(np.argpartition(order, rules.tried - 1, axis=1)[:, : rules.tried], axis=1)


def _scale(w: np.ndarray, sums: np.ndarray) -> float:
    """The power of two above all draws, by which sums of whole labels and the draws fit into one exact number; 0 if they do not."""
    scale = 2.0 ** int(w.sum() + 1).bit_length()
    fits = np.abs(sums).sum() * scale < 2.0**52  # not for null labels
    return scale if fits and (w == np.floor(w)).all() and (sums == np.floor(sums)).all() else 0.0


def histograms(rows: np.ndarray, here: np.ndarray, y: np.ndarray, w: np.ndarray, node: np.ndarray, columns: np.ndarray, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Draws and sums of labels by node, tried column and bin; ``here`` are the rows that count, the others go by row."""
    nodes, tried = columns.shape
    flat, at = rows.ravel(), here * rows.shape[1]
    base, sums = node * bins, w * y
    count, total = np.empty((tried, nodes * bins)), np.empty((tried, nodes * bins))
    scale = _scale(w, sums) if len(here) > nodes * bins else 0.0
    both = sums * scale + w if scale else None
    by_place = np.ascontiguousarray(columns.T)
    for i in range(tried):
        place = by_place[i].take(node)
        place += at
        code = base + flat.take(place)
        if scale:
            found = np.bincount(code, both, nodes * bins)
            np.floor(found / scale, out=total[i])
            np.subtract(found, total[i] * scale, out=count[i])
        else:
            count[i], total[i] = np.bincount(code, w, nodes * bins), np.bincount(code, sums, nodes * bins)
    shape = lambda x: x.reshape(tried, nodes, bins).transpose(1, 0, 2)
    return shape(count), shape(total)


def best_splits(count: np.ndarray, total: np.ndarray, min_leaf_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per node: place among the tried columns, last bin of the left side, and gain; no gain means no split.

    The gain is how much the sum of squared errors falls. Of equal gains the
    first column and bin count.
    """
    left_n, left_sum = np.cumsum(count, axis=2)[:, :, :-1], np.cumsum(total, axis=2)[:, :, :-1]
    all_n, all_sum = count[:, :1].sum(axis=2, keepdims=True), total[:, :1].sum(axis=2, keepdims=True)
    right_n, right_sum = all_n - left_n, all_sum - left_sum
    fits = (left_n >= min_leaf_rows) & (right_n >= min_leaf_rows)
    whole = all_sum**2 / np.maximum(all_n, 1)
    gain = np.square(left_sum, out=left_sum)
    gain /= np.maximum(left_n, 1, out=left_n)
    np.square(right_sum, out=right_sum)
    right_sum /= np.maximum(right_n, 1, out=right_n)
    gain += right_sum
    gain -= whole
    gain[~(fits & (gain > 1e-9 * np.maximum(1.0, whole)))] = 0.0
    gain = gain.reshape(len(count), -1)
    at = gain.argmax(axis=1)
    place, cut = np.divmod(at, count.shape[2] - 1)
    return place, cut, gain[np.arange(len(gain)), at]


@dataclass
class Tree:
    """Nodes in breadth-first order. A leaf has column -1; the right child stands behind the left one."""

    column: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray

    def walk(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        at = np.zeros(len(rows), np.int32)
        moving = np.arange(len(rows))
        while len(moving):
            column = self.column[at[moving]]
            moving, column = moving[column >= 0], column[column >= 0]
            node = at[moving]
            at[moving] = self.left[node] + (rows[moving, column] > self.cut[node])
        return at

    def predict(self, rows: np.ndarray) -> np.ndarray:
        return self.value[self.walk(rows)]


def grow(rows: np.ndarray, y: np.ndarray, w: np.ndarray, tree: int, rules: TreeRules, path: int = 1) -> tuple[Tree, np.ndarray]:
    """The subtree at ``path`` over its rows, and the gain by column.

    All nodes of a depth are split together; rows are in the order of their
    nodes, and nodes are taken ``NODES_AT_ONCE`` at a time.
    """
    features = rows.shape[1]
    gains = np.zeros(features)
    depth = path.bit_length() - 1
    paths, order = np.array([path], np.int64), np.arange(len(y))
    starts = np.array([0, len(y)])
    parts: list[tuple[np.ndarray, ...]] = []
    made = 1
    while len(y):
        w_here, y_here = w[order], y[order]
        n, total, squares = (np.add.reduceat(v, starts[:-1]) for v in (w_here, w_here * y_here, w_here * y_here**2))
        column, cut, left = np.full(len(paths), -1, np.int16), np.zeros(len(paths), np.uint8), np.zeros(len(paths), np.int32)
        spread = squares - total**2 / np.maximum(n, 1) > 1e-9 * np.maximum(1.0, squares)
        open_ = (n >= 2 * rules.min_leaf_rows) & spread & (depth < rules.max_depth)
        for first in range(0, len(paths), NODES_AT_ONCE):
            some = first + np.flatnonzero(open_[first : first + NODES_AT_ONCE])
            if not len(some):
                continue
            span = slice(starts[first], starts[min(first + NODES_AT_ONCE, len(paths))])
            sizes = np.diff(starts[first : first + NODES_AT_ONCE + 1])
            inside = np.repeat(open_[first : first + NODES_AT_ONCE], sizes)
            node = np.repeat(np.arange(len(some)), starts[some + 1] - starts[some])
            columns = tried_features(paths[some], tree, features, rules)
            counted = histograms(rows, order[span][inside], y_here[span][inside], w_here[span][inside], node, columns, rules.bins)
            place, at, gain = best_splits(*counted, rules.min_leaf_rows)
            split = gain > 0
            chosen = columns[np.arange(len(some)), place]
            column[some[split]], cut[some[split]] = chosen[split], at[split]
            gains += np.bincount(chosen[split], gain[split], features)
        parted = column >= 0
        split = np.flatnonzero(parted)
        left[split] = made + 2 * np.arange(len(split))
        parts.append((column, cut, left, total / np.maximum(n, 1)))
        made += 2 * len(split)
        if not len(split):
            break
        sizes = np.diff(starts)
        here = order[np.repeat(parted, sizes)]
        node = np.repeat(np.arange(len(split)), sizes[split])
        child = 2 * node + (rows.ravel().take(here * features + column[split][node]) > cut[split][node])
        order = here[np.argsort(child, kind="stable")]
        starts = np.concatenate(([0], np.cumsum(np.bincount(child, minlength=2 * len(split)))))
        paths = (2 * paths[split][:, None] + np.arange(2)).ravel()
        depth += 1
    return Tree(*(np.concatenate(x) for x in zip(*parts))), gains


def joined(top: Tree, subtrees: dict[int, Tree]) -> Tree:
    """A whole tree from its upper part, whose open leaves hold minus the path of a subtree in place of a child."""
    column, cut, left, value = (x.copy() for x in (top.column, top.cut, top.left, top.value))
    parts = [[column], [cut], [left], [value]]
    made = len(column)
    for at in np.flatnonzero(left < 0):
        below = subtrees[-int(left[at])]
        # The subtree's root takes the leaf's place, and the others follow.
        column[at], cut[at], value[at] = below.column[0], below.cut[0], below.value[0]
        moved = np.where(below.column >= 0, below.left - 1 + made, 0)
        left[at] = moved[0]
        for part, more in zip(parts, (below.column, below.cut, moved, below.value)):
            part.append(more[1:])
        made += len(below.column) - 1
    return Tree(*(np.concatenate(x) for x in parts))


def to_bytes(tree: Tree) -> dict[str, bytes]:
    return {"column": tree.column.astype("<i2").tobytes(), "cut": tree.cut.tobytes(), "left": tree.left.astype("<i4").tobytes(), "value": tree.value.astype("<f8").tobytes()}


def from_bytes(row: dict[str, bytes]) -> Tree:
    kinds = {"column": "<i2", "cut": "u1", "left": "<i4", "value": "<f8"}
    return Tree(*(np.frombuffer(row[name], kind) for name, kind in kinds.items()))


def bag_of(keys: np.ndarray, day: np.ndarray, before: int | None, tree: int, seed: int) -> np.ndarray:
    """Draws of a block's rows for a tree that learns from the days before ``before``."""
    w = draws(keys, tree, seed)
    return w if before is None else np.where(day < before, w, 0).astype(np.uint8)


def groups_of(values: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each distinct value with its places."""
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(np.diff(values[order])) + 1
    for places in np.split(order, cuts) if len(order) else ():
        yield int(values[places[0]]), places
