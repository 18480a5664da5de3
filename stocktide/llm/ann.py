"""Approximate nearest neighbours by inner product, with randomly rotated one-bit codes.

A vector is centred, scaled to length one and rotated; its code is the signs of
the rotated components, packed into bits. With the query rotated and rounded to
four bits, the inner product of code and query is a few bit counts, and two
scalars kept with each code turn it into an unbiased estimate of the true inner
product. The estimate's error is below ``EPSILON`` standard deviations with
near certainty, which gives each vector a lower and an upper bound. A block
keeps the vectors whose upper bound reaches the k-th largest lower bound; only
these are reranked with the original vectors in double precision.

The given queries are searched against all rows, in blocks: a block of codes
meets each block of queries of its dimension in some task, and gives k rows per
query at most. The centre comes from at most ``CENTRE_ROWS`` vectors.

Defined cases: vectors that are null, empty or zero, or hold null or non-finite
components, take no part, nor do null ids; vectors meet only those of their own
dimension; rows with one id are different rows, each a candidate for the others,
and each a query of its own; equal scores rank by id; fewer candidates than k are
all returned; further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocktide.session import materialize

K = 20
BLOCK = 4096
QUERY_BLOCK = 512
QUERY_BITS = 4
EPSILON = 3.0
CENTRE_ROWS = 20_000
SEED = 20


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def valid(vector: Column) -> Column:
    """Neither null nor zero, and all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def encode(vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes (packed 64-bit words), and for each vector its distance from the centre, the code's own inner product, and its inner product with the centre."""
    dim = vectors.shape[1]
    residual = vectors - centre
    length = np.linalg.norm(residual, axis=1)
    unit = residual / np.maximum(length, 1e-300)[:, None] @ turn
    bits = unit > 0
    own = np.abs(unit).sum(1) / math.sqrt(dim)
    padded = np.zeros((len(bits), -(-dim // 64) * 64), bool)
    padded[:, :dim] = bits
    return np.packbits(padded, axis=1, bitorder="little").view("<u8"), length, own, vectors @ centre


def bounds(query: np.ndarray, codes: np.ndarray, length: np.ndarray, own: np.ndarray, offset: np.ndarray, centre: np.ndarray, turn: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner product of the query with each coded vector, and its error bound."""
    dim = len(query)
    residual = query - centre
    norm = np.linalg.norm(residual)
    turned = residual @ turn
    low = turned.min()
    step = max((turned.max() - low) / ((1 << QUERY_BITS) - 1), 1e-300)
    levels = np.clip(np.floor((turned - low) / step + rng.random(dim)), 0, (1 << QUERY_BITS) - 1).astype(np.uint8)
    padded = np.zeros((QUERY_BITS, codes.shape[1] * 64), bool)
    padded[:, :dim] = levels >> np.arange(QUERY_BITS)[:, None] & 1
    planes = np.packbits(padded, axis=1, bitorder="little").view("<u8")
    ones = np.bitwise_count(codes).sum(1, dtype=np.int64)
    inner = sum(np.bitwise_count(codes & plane).sum(1, dtype=np.int64) << i for i, plane in enumerate(planes))
    # <sign vector, query>: signs are 2 * bit - 1, and the query is low + step * level.
    signed = (2 * step * inner + 2 * low * ones - step * levels.sum(dtype=np.int64) - dim * low) / math.sqrt(dim)
    # <o - c, q> = <o - c, q - c> + <o - c, c>, and <o, q> = <o - c, q> + <c, q>.
    estimate = length * signed / np.maximum(own, 1e-12) + offset - centre @ centre + centre @ query
    rounding = step * math.sqrt(dim) / (2 * max(norm, 1e-300))
    spread = np.sqrt(np.maximum(1 - own**2, 0) / np.maximum(own**2, 1e-12) / max(dim - 1, 1)) + rounding / math.sqrt(dim)
    return estimate, EPSILON * length * norm * spread


def partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of a task's vectors, of any width."""
    total = None
    for batch in batches:
        if len(batch):
            vectors = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
            total = vectors.sum(0) if total is None else total + vectors.sum(0)
    if total is not None:
        yield pa.RecordBatch.from_pydict({"sums": pa.array([total.tolist()], pa.list_(pa.float64()))})


def nearest(rows: DataFrame, is_query: Column, k: int = K, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the ``k`` rows nearest to each row where ``is_query`` holds."""
    spark = rows.sparkSession
    values = F.transform(F.col(vector), lambda x: x.cast("double"))
    source = rows.where(F.col(key).isNotNull() & valid(values)).select(F.col(key).cast("long").alias("id"), is_query.alias("q"), values.alias("v"))
    # Written, so that row numbers are the same wherever they are read.
    source = materialize(source.withColumns({"dim": F.size("v"), "row": F.monotonically_increasing_id()}), "vectors")
    centres = {}
    for dim, n in [(r["dim"], r["count"]) for r in source.groupBy("dim").count().collect()]:
        few = source.where(F.col("dim") == dim).orderBy(F.xxhash64("id"), "id", "row").limit(CENTRE_ROWS).select("v")
        sums = [np.array(r["sums"]) for r in few.mapInArrow(partial_sums, "sums array<double>").collect()]  # one per task
        centres[dim] = (np.sum(sums, axis=0) / min(n, CENTRE_ROWS), -(-n // BLOCK))

    def blob(name: str, blocks: Column, only: Column) -> DataFrame:
        """One row per block: ids and vectors."""
        part = F.pmod(F.xxhash64("id", "row", F.lit(name)), blocks)
        chosen = source.where(only).select("dim", part.alias(name), "id", "row", "v")
        pairs = F.sort_array(F.collect_list(F.struct("id", "row", "v")))
        packed = chosen.groupBy("dim", name).agg(pairs.alias("p"))
        return packed.select("dim", name, F.col("p.id").alias(f"{name}_ids"), F.col("p.row").alias(f"{name}_rows"), F.flatten("p.v").alias(f"{name}_values"))

    parts = F.lit(1).cast("long")
    query_parts = F.lit(1).cast("long")
    for dim, (_, blocks) in centres.items():
        parts = F.when(F.col("dim") == dim, F.lit(blocks).cast("long")).otherwise(parts)
        share = source.where((F.col("dim") == dim) & F.col("q")).count()
        query_parts = F.when(F.col("dim") == dim, F.lit(max(1, -(-share // QUERY_BLOCK))).cast("long")).otherwise(query_parts)
    codes = blob("block", parts, F.lit(True))
    queries = blob("group", query_parts, F.col("q")).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    met = queries.join(codes, ["dim", "block"]).select("dim", "group_ids", "group_rows", "group_values", "block_ids", "block_rows", "block_values")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for batch in batches:
            for i in range(len(batch)):
                dim = batch.column("dim")[i].as_py()
                if dim not in turns:
                    turns[dim] = rotation(dim)
                turn = turns[dim]
                read = lambda name: batch.column(name)[i].values.to_numpy(zero_copy_only=False)  # noqa: E731,B023
                ids, own_rows, vectors = read("block_ids"), read("block_rows"), read("block_values").reshape(-1, dim)
                centre = centres[dim][0]
                code = encode(vectors, centre, turn)
                rng = np.random.default_rng(SEED)
                out: list[tuple[np.ndarray, ...]] = []
                for q, row, query in zip(read("group_ids").tolist(), read("group_rows").tolist(), read("group_values").reshape(-1, dim)):
                    others = own_rows != row
                    estimate, error = bounds(query, *code, centre, turn, rng)
                    low = np.where(others, estimate - error, -np.inf)
                    floor = np.partition(low, -k)[-k] if len(low) > k else -np.inf
                    chosen = np.flatnonzero(others & (estimate + error >= floor))
                    scores = vectors[chosen] @ query
                    best = np.lexsort((ids[chosen], -scores))[:k]
                    out.append((np.full(len(best), row), np.full(len(best), q), ids[chosen][best], scores[best]))
                query_row, query_id, vec_id, score = (np.concatenate(x) for x in zip(*out))
                numbers = [pa.array(x, pa.int64()) for x in (query_row, query_id, vec_id)]
                yield pa.RecordBatch.from_arrays([*numbers, pa.array(score)], names=["query_row", "query_id", "vec_id", "score"])

    if not centres:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    found = met.mapInArrow(search, "query_row long, query_id long, vec_id long, score double")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
