"""Substring removal: token windows that occur more than once in the corpus.

Rabin-Karp hashes of every window of ``window`` words are counted over all
documents; words under any repeated window go, and neighbouring repeated windows
merge into maximal intervals. Windows are judged on the input.

Defined cases: a null or empty text has no words and stays as it is; a text of
fewer words than the window is never changed; a row that is repeated as a whole
repeats all its windows, so all of them go; an empty table gives an empty table;
further columns are not read, whatever their names.

Two windows count as equal if two independent hashes agree: the 64-bit key, and
a second one modulo the number of buckets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import TALLY_SCHEMA, beside_blocks, block_size, bucket_count, deal, from_bytes, totals, write_blocks
from .text import WordHashes, mix, rolling, texts_of

WINDOW = 35
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def _windows(texts: list[bytes], window: int, hashes: WordHashes) -> tuple[list[list[bytes]], np.ndarray, np.ndarray, np.ndarray]:
    """Words per text, where each text starts in one row of all words, the starts of windows, and their two hashes."""
    words = [text.split() for text in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    begins = np.concatenate(([0], np.cumsum(sizes)))
    flat = np.concatenate([hashes.of(w) for w in words]) if words else np.empty(0, np.uint64)
    left = np.repeat(begins[1:], sizes) - np.arange(len(flat))
    starts = np.flatnonzero(left >= window)
    first, second = (mix(rolling(flat, window, b))[starts] if len(starts) else np.empty(0, np.uint64) for b in BASES)
    return words, begins, starts, np.stack([first, second])


def _distinct(pair: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct windows by bucket of the second hash and key of the first: keys, counts, buckets, place of each window."""
    bucket = (pair[1] % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((pair[0], bucket))
    keys, buckets_ = pair[0][order], bucket[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (buckets_[1:] != buckets_[:-1])
    place = np.empty(len(keys), np.int64)
    place[order] = np.cumsum(new) - 1
    at = np.flatnonzero(new)
    return keys[at], np.diff(np.append(at, len(keys))), buckets_[at], place


def remove_repeats(docs: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Each document without its repeated windows.

    Returns ``key``, the columns of ``keep``, ``n_words``, ``n_removed``,
    ``intervals`` (removed words as [begin, end) pairs, maximal and in order) and
    ``kept_text``: the input text where nothing is removed, else the words left,
    joined by one space.
    """
    spark = docs.sparkSession
    source = docs.select(key, *keep, F.col(text).alias("__text"))
    blocks = write_blocks(source, "__text", block_size(source, "__text"))
    buckets = bucket_count(blocks)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for block, data in zip(batch.column("block").to_pylist(), batch.column("data")):
                pair = _windows(texts_of(from_bytes(data.as_py())["__text"]), window, hashes)[3]
                keys, counts, bucket, _ = _distinct(pair, buckets)
                yield from deal(block, keys, counts, bucket)

    answers = totals(blocks.select("block", "data").mapInArrow(ask, TALLY_SCHEMA))
    result = source.drop("__text").schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in result)
    schema = f"{fields}, n_words long, n_removed long, intervals array<struct<begin:long,end:long>>, kept_text string"

    def cut(block: int, table: pa.Table, totals: np.ndarray) -> pa.Table:
        column = table["__text"].combine_chunks()
        originals = column.to_pylist()
        words, begins, starts, pair = _windows(texts_of(column), window, WordHashes())
        place = _distinct(pair, buckets)[3]
        repeated = starts[totals[place] > 1] if len(starts) else starts
        edges = np.zeros(begins[-1] + 1, np.int64)
        np.add.at(edges, repeated, 1)
        np.add.at(edges, repeated + window, -1)
        gone = np.cumsum(edges)[:-1] > 0
        removed, intervals, kept = [], [], []
        for i, own in enumerate(words):
            mask = gone[begins[i] : begins[i + 1]]
            if not mask.any():
                removed.append(0)
                intervals.append([])
                kept.append(originals[i])
                continue
            turns = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
            removed.append(int(mask.sum()))
            intervals.append([{"begin": b, "end": e} for b, e in turns.reshape(-1, 2).tolist()])
            kept.append(b" ".join(w for w, m in zip(own, mask.tolist()) if not m).decode())
        out = table.drop_columns(["__text"])
        out = out.append_column("n_words", pa.array([len(w) for w in words], pa.int64()))
        out = out.append_column("n_removed", pa.array(removed, pa.int64()))
        out = out.append_column("intervals", pa.array(intervals, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))))
        return out.append_column("kept_text", pa.array(kept, pa.string()))

    return beside_blocks(blocks, answers, cut, schema)
