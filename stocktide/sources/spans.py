"""Filling days and writing the filled fact, by whole columns.

A span is a run of days of one product: a day with a sale and the days up to the
next. Spans are few; the rows that come out of them are many, and as Spark rows
each of their values costs more to pass on and encode than to make. Here the task
that holds the spans makes the columns with numpy and writes the bucket's file.

Workers write with pyarrow, which needs a folder that they reach by its path;
elsewhere ``store_by_product`` writes Spark's rows.
"""

from __future__ import annotations

import os
import shutil
import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Filled rows that are made and written at a time, and one product's more.
ROWS_PER_GROUP = 1_000_000

NAMES = ("product_id", "category", "warehouse", "region")
_NAME = pa.dictionary(pa.int32(), pa.string())
STORED = pa.schema(
    {
        "product_id": _NAME,
        "date": pa.date32(),
        "units_sold": pa.int64(),
        "price": pa.float64(),
        "category": _NAME,
        "warehouse": _NAME,
        "region": _NAME,
        "revenue": pa.float64(),
        "year": pa.int32(),
        "month": pa.int32(),
        "week": pa.int32(),
    }
)


def shared_folder(spark: SparkSession, path: str) -> str | None:
    """The folder that ``path`` names, if it is reached through the file system of the machine."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    given = hadoop.Path(path)
    if (given.toUri().getScheme() or hadoop.FileSystem.getDefaultUri(conf).getScheme()) != "file":
        return None
    return given.getFileSystem(conf).makeQualified(given).toUri().getPath()


def write_spans(spans: DataFrame, folder: str, buckets: int) -> None:
    """Write the filled rows of ``spans`` to ``folder`` in buckets of products, by product and day.

    Rows lie in the buckets that Spark's own hash gives, in files with the names
    that it looks for. Tasks write to a folder of this call, and only the files of
    those that ended well are moved from there, as Spark does.
    """
    if os.path.isdir(folder) and os.listdir(folder):
        raise FileExistsError(f"{folder} is not empty")
    codec = spans.sparkSession.conf.get("spark.sql.parquet.compression.codec").lower()
    codec = {"uncompressed": "none", "lz4_raw": "lz4"}.get(codec, codec)
    held = os.path.join(folder, f"_temporary-{uuid.uuid4().hex}")
    os.makedirs(held)
    try:
        dealt = spans.withColumn("bucket", F.pmod(F.hash("product_id"), F.lit(buckets)))
        ordered = dealt.sortWithinPartitions("bucket", "product_id", "date")
        written = ordered.mapInArrow(lambda batches: _write_buckets(batches, held, codec), "file string")
        for row in written.collect():  # one per bucket
            os.replace(os.path.join(held, row.file), os.path.join(folder, row.file))
    finally:
        shutil.rmtree(held, ignore_errors=True)


def _write_buckets(batches: Iterator[pa.RecordBatch], held: str, codec: str) -> Iterator[pa.RecordBatch]:
    """Names of the files, one per bucket that the task has."""
    files, writer, current = [], None, None
    numbers = [f.name for f in STORED if f.name not in NAMES and f.name != "date"]
    for bucket, spans in _pieces(batches):
        if bucket != current:
            if writer:
                writer.close()
            files.append(f"part-{bucket:05d}-{uuid.uuid4()}_{bucket:05d}.c000.{codec}.parquet")
            # Days follow one another, so they are stored as differences.
            writer = pq.ParquetWriter(
                os.path.join(held, files[-1]),
                STORED,
                compression=codec,
                use_dictionary=[*NAMES, *numbers],
                column_encoding={"date": "DELTA_BINARY_PACKED"},
                store_schema=False,
            )
            current = bucket
        writer.write_table(fill(spans), row_group_size=2**31)
    if writer:
        writer.close()
    yield pa.record_batch({"file": pa.array(files, pa.string())})


def _codes(column: pa.ChunkedArray) -> pa.DictionaryArray:
    return column.cast(pa.string()).combine_chunks().dictionary_encode()


def _numbers(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray | None]:
    """Values, and where there is none (``None`` if there are all)."""
    empty = column.is_null().to_numpy() if column.null_count else None
    return (column.fill_null(0) if column.null_count else column).to_numpy(), empty


def _starts(spans: pa.Table) -> np.ndarray:
    """Places where a product begins."""
    codes = _codes(spans["product_id"]).indices.fill_null(-1).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.flatnonzero(np.diff(codes)) + 1])


def _days(spans: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First day, direction and number of days of each span. A span that ends before it begins goes back, as a sequence does."""
    first, last = (spans[c].to_numpy().astype("int64") for c in ("from_day", "until_day"))
    return first, np.where(first <= last, 1, -1), np.abs(last - first) + 1


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """Whole products of one bucket that make about ``ROWS_PER_GROUP`` rows, with that bucket."""
    kept = None
    for batch in batches:
        if not batch.num_rows:
            continue
        met = pa.Table.from_batches([batch])
        met = pa.concat_tables([kept, met]) if kept else met
        starts = _starts(met)
        yield from _cut(met.slice(0, starts[-1]), starts[:-1])
        kept = met.slice(starts[-1])  # the next batch may go on with this product
    if kept:
        yield from _cut(kept, np.array([0]))


def _cut(spans: pa.Table, starts: np.ndarray) -> Iterator[tuple[int, pa.Table]]:
    if not len(starts):
        return
    rows = np.add.reduceat(_days(spans)[2], starts)
    buckets = spans["bucket"].to_numpy()[starts]
    group = (np.cumsum(rows) - rows) // ROWS_PER_GROUP
    ends = np.flatnonzero((np.diff(group) != 0) | (np.diff(buckets) != 0)) + 1
    edges = [0, *starts[ends].tolist(), spans.num_rows]
    for bucket, begin, end in zip(buckets[[0, *ends]].tolist(), edges, edges[1:]):
        yield bucket, spans.slice(begin, end - begin)


def fill(spans: pa.Table) -> pa.Table:
    """One row per day of each span, by product and day, with revenue and partition keys.

    The span's own day has its units, all others have 0, and all have its price.
    """
    first, step, n = _days(spans)
    day = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    if (step < 0).any():
        day *= np.repeat(step, n)
    day += np.repeat(first, n)

    def spread(values, empty):
        return np.repeat(values, n), None if empty is None else np.repeat(empty, n)

    def either(*masks):
        given = [m for m in masks if m is not None]
        return np.logical_or.reduce(given) if given else None

    own, without = _numbers(spans["date"].cast(pa.int32()))
    sold = day == np.repeat(own, n)
    if without is not None:
        sold &= ~np.repeat(without, n)
    units, no_units = spread(*_numbers(spans["units"]))
    units = np.where(sold, units, 0)
    no_units = None if no_units is None else no_units & sold
    price, no_price = spread(*_numbers(spans["paid_price"]))

    low = day.min()
    calendar = pa.array(np.arange(low, day.max() + 1, dtype="int32")).cast(pa.date32())
    keys = {k: f(calendar).to_numpy().astype("int32")[day - low] for k, f in (("year", pc.year), ("month", pc.month), ("week", pc.iso_week))}
    columns = {
        "date": pa.array(day.astype("int32")).cast(pa.date32()),
        "units_sold": pa.array(units, mask=no_units),
        "price": pa.array(price, mask=no_price),
        "revenue": pa.array(units * price, mask=either(no_units, no_price)),
        **{k: pa.array(v) for k, v in keys.items()},
    }
    for name in NAMES:
        codes = _codes(spans[name])
        at, empty = spread(*_numbers(pa.chunked_array([codes.indices])))
        columns[name] = pa.DictionaryArray.from_arrays(pa.array(at, mask=empty), codes.dictionary)
    filled = pa.table([columns[f.name] for f in STORED], schema=STORED)
    return filled if _in_order(spans, first, step, n) else filled.take(_order(spans, day, n))


def _in_order(spans: pa.Table, first: np.ndarray, step: np.ndarray, n: np.ndarray) -> bool:
    """Whether the days of each product go up. They don't where a product has two spans from one day."""
    follows = first[1:] >= first[:-1] + n[:-1] - 1
    follows[_starts(spans)[1:] - 1] = True
    return bool((step > 0).all() and follows.all())


def _order(spans: pa.Table, day: np.ndarray, n: np.ndarray) -> np.ndarray:
    starts = _starts(spans)
    nth = np.zeros(spans.num_rows, dtype="int64")
    nth[starts[1:]] = 1
    return np.lexsort((day, np.repeat(np.cumsum(nth), n)))
