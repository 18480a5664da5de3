"""SimHash near-duplicates: fingerprints of word shingles, compared exactly in tiles.

Fingerprints that differ in at most ``radius`` bits are linked; documents that
are linked directly or through others form one component.

All pairs of distinct fingerprints are covered by tiles. A tile holds up to
``TILE`` fingerprints with the same population counts of their four 16-bit
quarters. Two fingerprints cannot be nearer than the sum of the differences of
these counts, so only tiles whose sum is within the radius meet; about one pair
in sixty does. Within a pair of tiles numpy takes exclusive-or and bit counts of
every pair, and returns a spanning forest of the links, which has the same
components as all links.

Defined cases: a null, empty or blank text has the fingerprint zero and is
linked like any other; a text of fewer words than a shingle is one shingle;
repeated rows share a fingerprint; a null id never names a component, unless it
has no other; an empty table gives an empty table; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktide.session import materialize

from .graph import components
from .text import texts_of

SHINGLE = 3
RADIUS = 2
SEED = 42
TILE = 4096
QUARTERS = 4
#: Shingles whose bits are counted at once.
SLICE = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Majority of the bits of all shingle hashes, as a signed 64-bit number."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = ends[shingle - 1 :] if len(words) >= shingle else ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[s:e], seed) for s, e in zip(starts.tolist(), last.tolist())], "<u8")
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), SLICE):
        part = hashes[i : i + SLICE].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def fingerprint_column(text: str, shingle: int = SHINGLE, seed: int = SEED) -> Column:
    def work(column: pa.Array) -> pa.Array:
        return pa.array([fingerprint(x, shingle, seed) for x in texts_of(column)], pa.int64())

    return F.arrow_udf(work, "long")(F.col(text))


def _quarter_counts(value: Column) -> list[Column]:
    return [F.bit_count(F.shiftrightunsigned(value, 16 * i).bitwiseAND(F.lit(0xFFFF))).cast("long") for i in range(QUARTERS)]


def _neighbours(radius: int) -> list[tuple[int, ...]]:
    return [d for d in product(range(-radius, radius + 1), repeat=QUARTERS) if sum(map(abs, d)) <= radius]


def _forest(rows: np.ndarray, columns: np.ndarray, parent: dict[int, int]) -> Iterator[tuple[int, int]]:
    """Those links that join what was apart."""

    def top(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    for a, b in zip(rows.tolist(), columns.tolist()):
        if (x := top(a)) != (y := top(b)):
            parent[x] = y
            yield a, b


def close_pairs(left: np.ndarray, right: np.ndarray, radius: int, same: bool, rows: int = 256) -> list[tuple[int, int]]:
    """A spanning forest of the links between two tiles, or within one."""
    found: list[tuple[int, int]] = []
    parent: dict[int, int] = {}
    for i in range(0, len(left), rows):
        a = left[i : i + rows]
        b = right[i:] if same else right
        x, y = np.nonzero(np.bitwise_count(a[:, None] ^ b[None, :]) <= radius)
        if same:
            x, y = x[y > x], y[y > x]
        found.extend(_forest(a[x].view(np.int64), b[y].view(np.int64), parent))
    return found


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (``a``, ``b``) of the distinct fingerprints in column ``fp``, enough to join each component."""
    counts = _quarter_counts(F.col("fp"))
    cell = sum((c * 32**i for i, c in enumerate(counts)), F.lit(0).cast("long"))
    celled = prints.select("fp", cell.alias("cell"))
    # 17^4 cells at most, whatever the input.
    sizes = celled.groupBy("cell").agg(F.ceil(F.count("*") / TILE).cast("long").alias("parts"))
    tiles = (
        celled.join(F.broadcast(sizes), "cell")
        .groupBy("cell", F.pmod(F.xxhash64("fp"), "parts").alias("part"))
        .agg(F.sort_array(F.collect_list("fp")).alias("fps"))
    )
    tiles = materialize(tiles, "tiles")
    steps = [(sum(d * 32**i for i, d in enumerate(ds))) for ds in _neighbours(radius)]
    near = F.explode(F.array(*[F.col("cell") + F.lit(s).cast("long") for s in steps if s >= 0]))
    left = (
        tiles.select(F.col("cell").alias("cell_a"), F.col("part").alias("part_a"), F.col("fps").alias("fps_a"), near.alias("cell"))
        .join(F.broadcast(sizes), "cell")
        .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        .where("cell <> cell_a or part >= part_a")
    )
    pairs = left.join(tiles, ["cell", "part"]).select("fps_a", "fps", F.expr("cell = cell_a and part = part_a").alias("same"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, same in zip(batch.column("fps_a"), batch.column("fps"), batch.column("same").to_pylist()):
                left, right = (x.values.to_numpy(zero_copy_only=False).view(np.uint64) for x in (a, b))
                if found := close_pairs(left, right, radius, same):
                    ends = np.array(found, np.int64)
                    yield pa.RecordBatch.from_pydict({"a": pa.array(ends[:, 0]), "b": pa.array(ends[:, 1])})

    return pairs.mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, key: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """``key``, ``fingerprint`` (16 lowercase hex digits) and ``component_id`` (the smallest key reachable) of every row."""
    rows = docs.select(F.col(key).alias("id"), fingerprint_column(text, shingle, seed).alias("fp"))
    rows = materialize(rows, "fingerprints")
    prints = materialize(rows.groupBy("fp").agg(F.min("id").alias("least")), "distinct_fingerprints")
    roots = components(links(prints, radius))
    placed = prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = placed.join(smallest, "root").select("fp", "component_id")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.join(named, "fp").select(F.col("id").alias(key), hexed.alias("fingerprint"), "component_id")
