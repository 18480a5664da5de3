"""Corpus-wide counts by blocks of documents.

A count over all windows or n-grams of a corpus has about as many keys as the
corpus has words. Sent as one Spark row each, they cost far more to shuffle than
the texts. Here rows are packed into blocks of a few MB of text and written once,
each block sends its distinct keys with their counts, as arrays dealt to buckets
by hash, and gets the corpus-wide counts back in the same order:

    documents -> blocks -> (block, bucket, keys, counts) -> by bucket: sums
              -> (block, bucket, totals) -> by block, beside the block's documents

A key that a third of all documents share arrives once per block. Buckets are
even since they follow a hash of the key.

Each block sends a row to nearly every bucket. With blocks and buckets of fixed
size there would be as many rows as the square of the input, so both grow with
its square root, from ``BLOCK_BYTES`` and ``BUCKET_BYTES`` at ``BASE_BYTES`` to
``MOST_GROWTH`` times as much, which still fits a task. Up to 64 times
``BASE_BYTES`` the rows are in proportion to the input; beyond that they get
smaller, down to one key a row.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.session import materialize

BASE_BYTES = 1 << 30
BLOCK_BYTES = 4 << 20
BUCKET_BYTES = 8 << 20
MOST_GROWTH = 8
LEAST_BUCKET_BYTES = 1 << 20
BLOCK_SCHEMA = "block long, n_bytes long, data binary"
TALLY_SCHEMA = "bucket long, block long, keys binary, counts binary"
TOTAL_SCHEMA = "bucket long, block long, totals binary, types long, tokens long"


def to_bytes(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def from_bytes(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(data)).read_all()


def shrink(values: np.ndarray) -> bytes:
    """Non-negative numbers as compressed byte planes; counts are mostly 1, so nearly all planes are zeros."""
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8).T
    return zstandard.compress(np.ascontiguousarray(planes).tobytes(), 1)


def grow(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<i8").ravel()


def pack_keys(keys: np.ndarray) -> bytes:
    """Keys in order, as their distances."""
    return shrink(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(grow(data).view("<u8"), dtype=np.uint64)


def growth(total: int) -> float:
    """How many times their base size blocks and buckets have for this many bytes of text."""
    return min(max(1.0, math.sqrt(total / BASE_BYTES)), MOST_GROWTH)


def block_size(df: DataFrame, text: str = "text") -> int:
    """Bytes of text for a block, from the length of all texts."""
    total = df.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    return int(BLOCK_BYTES * growth(total))


def write_blocks(df: DataFrame, text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``df`` packed into blocks of about ``block_bytes`` of text, written as a table.

    A text above that size gets a block of its own. Block numbers are those of
    the task and its sequence; they are fixed by the written table.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        size = 0

        def block() -> pa.RecordBatch:
            data = to_bytes(pa.Table.from_batches(held).combine_chunks())
            return pa.RecordBatch.from_pydict(
                {"block": pa.array([number], pa.int64()), "n_bytes": pa.array([size], pa.int64()), "data": pa.array([data], pa.binary())}
            )

        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
            start = 0
            for i, n in enumerate(lengths.tolist()):
                if size and size + n > block_bytes:
                    held.append(batch.slice(start, i - start))
                    yield block()
                    number, held, size, start = number + 1, [], 0, i
                size += n
            held.append(batch.slice(start))
        if sum(map(len, held)):
            yield block()

    return materialize(df.mapInArrow(pack, BLOCK_SCHEMA), "blocks")


def bucket_count(blocks: DataFrame) -> int:
    """So many buckets that each gets the keys of about ``BUCKET_BYTES`` of text, and more with ``growth``.

    A small input is dealt to two buckets a task, but none below ``LEAST_BUCKET_BYTES``.
    """
    total = blocks.agg(F.sum("n_bytes")).first()[0] or 0
    tasks = 2 * int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(tasks, math.ceil(total / LEAST_BUCKET_BYTES)), math.ceil(total / (BUCKET_BYTES * growth(total))))


def deal(block: int, keys: np.ndarray, counts: np.ndarray, bucket: np.ndarray, first: int = 0) -> Iterator[pa.RecordBatch]:
    """Rows of ``TALLY_SCHEMA``, one per bucket; ``bucket`` gives that of each key and ``keys`` come in order of bucket and key."""
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    starts = np.concatenate(([0], cuts)) if len(keys) else cuts
    ends = np.append(cuts, len(keys))
    yield pa.RecordBatch.from_pydict(
        {
            "bucket": pa.array([first + int(bucket[s]) for s in starts], pa.int64()),
            "block": pa.array([block] * len(starts), pa.int64()),
            "keys": pa.array([pack_keys(keys[s:e]) for s, e in zip(starts, ends)], pa.binary()),
            "counts": pa.array([shrink(counts[s:e]) for s, e in zip(starts, ends)], pa.binary()),
        }
    )


def distinct_keys(keys: np.ndarray, buckets: int, counted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in bucket order, how often each is counted, its bucket, and for each input key its place.

    ``counted`` marks the occurrences that count; a key without any is still asked for.
    """
    values, place, counts = np.unique(keys, return_inverse=True, return_counts=True)
    if counted is not None:
        counts = np.bincount(place[counted], minlength=len(values))
    bucket = (values % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    return values[order], counts[order], bucket[order], back[place]


def totals(tallies: DataFrame, owners: bool = False) -> DataFrame:
    """Sums per key over all blocks, sent back to each block in the order it asked (``TOTAL_SCHEMA``).

    ``types`` and ``tokens`` hold the number of counted keys of a bucket and
    their sum, once per bucket and else 0. With ``owners`` a total is sent as
    twice its value, and one more to the first block that asked.
    """

    def add(table: pa.Table) -> pa.Table:
        table = table.take(pc.sort_indices(table["block"]))
        parts = [unpack_keys(x) for x in table["keys"].to_pylist()]
        sizes = list(map(len, parts))
        counts = np.concatenate([grow(x) for x in table["counts"].to_pylist()])
        values, first, place = np.unique(np.concatenate(parts), return_index=True, return_inverse=True)
        sums = np.zeros(len(values), "<i8")
        np.add.at(sums, place, counts)
        sent = sums[place]
        if owners:
            sent *= 2
            sent[first] += 1
        answers = np.split(sent, np.cumsum(sizes)[:-1])
        rest = [0] * (len(sizes) - 1)
        return pa.table(
            {
                "bucket": table["bucket"],
                "block": table["block"],
                "totals": pa.array([shrink(x) for x in answers], pa.binary()),
                "types": pa.array([int((sums > 0).sum()), *rest], pa.int64()),
                "tokens": pa.array([int(sums.sum()), *rest], pa.int64()),
            }
        )

    return tallies.groupBy("bucket").applyInArrow(add, TOTAL_SCHEMA)


def beside_blocks(blocks: DataFrame, answers: DataFrame, work: Callable[[int, pa.Table, np.ndarray], Iterator[pa.Table] | pa.Table], schema: str) -> DataFrame:
    """``work(block, documents, totals)`` for every block, with its totals in the order it asked."""

    def one(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right["bucket"].to_numpy())
        parts = right["totals"].to_pylist()
        values = np.concatenate([grow(parts[i]) for i in order]) if len(order) else np.empty(0, np.int64)
        return work(left["block"][0].as_py(), from_bytes(left["data"][0].as_py()), values)

    return (
        blocks.select("block", "data").groupBy("block").cogroup(answers.select("block", "bucket", "totals").groupBy("block")).applyInArrow(one, schema)
    )
