"""Words, word hashes and folds that the text operators share.

A word is a run of bytes other than space, tab, line feed, vertical tab, form
feed and carriage return, which is what ``bytes.split()`` gives on UTF-8.
``bytes.lower()`` changes A-Z alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

#: A cache of word hashes is emptied beyond this many words, so that its memory is bounded.
CACHED_WORDS = 300_000


def fold(doc_id: Column | str, parts: int = 5) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as the empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % parts


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of a string column; null gives the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [b"" if x is None else x for x in column.cast(pa.large_binary()).to_pylist()]


class WordHashes(dict):
    """Word to its 64-bit hash, computed once per distinct word while it is cached."""

    def __init__(self, seed: int = 0):
        super().__init__()
        self.seed = seed

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, self.seed)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolling(values: np.ndarray, length: int, base: int) -> np.ndarray:
    """Rabin-Karp hashes modulo 2^64 of all windows of ``length`` values; ``base`` is odd.

    The hash of values v0..vk is the sum of v_j * base^j. Prefix sums give every
    window in one pass: their difference is divided by base^i, which is possible
    since an odd base has an inverse.
    """
    n = len(values)
    if n < length:
        return np.empty(0, np.uint64)

    def powers(b: int, count: int) -> np.ndarray:
        out = np.full(count, b, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers(base, n), dtype=np.uint64, out=sums[1:])
    return (sums[length:] - sums[:-length]) * powers(pow(base, -1, 1 << 64), n - length + 1)
