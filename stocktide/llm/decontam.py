"""Benchmark decontamination: size-partitioned MinHash containment, verified exactly.

Items are short and documents long, so a Jaccard similarity of their shingle
sets says little, and banded signatures of whole documents would miss most
items. What is searched is containment: the share of an item's shingles that a
document holds.

- Items are partitioned by the size of their shingle set, in powers of two. The
  signature of an item is its ``SIGNATURE`` smallest shingle hashes, a bottom-k
  MinHash. In each partition only document shingles up to the largest signature
  hash are looked up, so partitions of large items look up a small share.
- Partitions whose items have too many shingles for a document of this size
  (its shingles are fewer than the asked share) are left out for it.
- An item is a candidate if the document holds at least ``FLOOR`` of its
  signature, far below the asked share. For an item of true containment 0.8 and
  a signature of 32 the chance to miss that is below 1e-9; an item of at most 32
  shingles has them all in its signature and cannot be missed.
- Candidates are verified on the shingles themselves, not on hashes.

Items are the query set. They go to the tasks in blocks of about
``BLOCK_SHINGLES`` shingles, one pass over the documents per block; items of one
id stay together. The plan holds the indexes of all blocks.

Defined cases: text is lower-cased (A-Z) and split at white space; an item of
fewer words than a shingle is one shingle of its own width, which is looked for
among the documents' runs of as many words; a null or empty item has no shingle
and is never found; null and empty documents hold nothing; items with one id are searched one by one and the
largest containment counts; repeated documents give repeated rows; further
columns are not read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quality import _typed
from .text import WordHashes, mix, rolling, texts_of

SHINGLE = 5
THRESHOLD = 0.8
SIGNATURE = 32
FLOOR = 0.25
BLOCK_SHINGLES = 1_000_000
BASE = 0xD1342543DE82EF95
FOUND = "array<struct<item_id:bigint,shared:bigint,size:bigint>>"


def shingle_hashes(values: np.ndarray, width: int) -> np.ndarray:
    """Distinct hashes of all runs of ``width`` words; they depend on the width."""
    return np.unique(mix(rolling(values, width, BASE) + np.uint64(width)))


def shingle_set(words: list[bytes], width: int) -> set[bytes]:
    return {b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)}


@dataclass
class SizePartition:
    """Items of about one size and one width of shingles: signature hashes in order, and the item of each."""

    width: int
    least: int
    hashes: np.ndarray
    items: np.ndarray


class ItemIndex:
    """Signatures of a block of items."""

    def __init__(self, items: list[tuple[int | None, str]], shingle: int, threshold: float):
        self.ids = [i for i, _ in items]
        self.shingle, self.threshold = shingle, threshold
        own = WordHashes()
        self.sets, self.widths, entries = [], [], defaultdict(list)
        signed = []
        for n, (_, text) in enumerate(items):
            words = text.encode().lower().split()
            width = min(shingle, len(words))
            self.widths.append(width)
            self.sets.append(shingle_set(words, width) if words else set())
            hashes = shingle_hashes(own.of(words), width) if words else np.empty(0, np.uint64)
            signature = hashes[:SIGNATURE]
            signed.append(len(signature))
            if len(hashes):
                entries[width, len(hashes).bit_length()].append((len(hashes), signature, n))
        self.signed = np.array(signed, np.int64)
        self.partitions = []
        for (width, _), group in entries.items():
            hashes = np.concatenate([s for _, s, _ in group])
            items_ = np.repeat([n for _, _, n in group], [len(s) for _, s, _ in group])
            order = np.argsort(hashes, kind="stable")
            self.partitions.append(SizePartition(width, min(n for n, _, _ in group), hashes[order], items_[order]))

    def search(self, text: bytes, own: WordHashes) -> list[dict]:
        """Items held by the document to at least the threshold."""
        words = text.lower().split()
        values = own.of(words)
        by_width = {width: shingle_hashes(values, width) for width in {part.width for part in self.partitions}}
        counts: Counter = Counter()
        for part in self.partitions:
            hashes = by_width[part.width]
            if len(hashes) < self.threshold * part.least:
                continue
            probes = hashes[: np.searchsorted(hashes, part.hashes[-1], "right")]
            left, right = np.searchsorted(part.hashes, probes, "left"), np.searchsorted(part.hashes, probes, "right")
            for a, b in zip(left[right > left].tolist(), right[right > left].tolist()):
                counts.update(part.items[a:b].tolist())
        candidates = [n for n, c in counts.items() if c >= max(1, FLOOR * self.signed[n])]
        if not candidates:
            return []
        held = {width: shingle_set(words, width) for width in {self.widths[n] for n in candidates}}
        best: dict[int | None, dict] = {}
        for n in candidates:
            shared, size = len(self.sets[n] & held[self.widths[n]]), len(self.sets[n])
            if shared >= self.threshold * size - 1e-9:
                found = {"item_id": self.ids[n], "shared": shared, "size": size}
                if self.ids[n] not in best or shared * best[self.ids[n]]["size"] > best[self.ids[n]]["shared"] * size:
                    best[self.ids[n]] = found
        return sorted(best.values(), key=lambda x: (x["item_id"] is None, x["item_id"]))


def item_blocks(items: DataFrame, shingle: int = SHINGLE, threshold: float = THRESHOLD, key: str = "item_id", text: str = "text") -> Iterator[ItemIndex]:
    """Indexes of the benchmark, block by block; a block ends where an id does."""
    held, size = [], 0
    for row in items.select(F.col(key).cast("long").alias("i"), F.col(text).alias("t")).where("t is not null").orderBy("i", "t").toLocalIterator():
        words = len(row["t"].split())
        if held and size + words > BLOCK_SHINGLES and row["i"] != held[-1][0]:
            yield ItemIndex(held, shingle, threshold)
            held, size = [], 0
        held.append((row["i"], row["t"]))
        size += words
    yield ItemIndex(held, shingle, threshold)


def found_items(index: ItemIndex, text: str = "text") -> Column:
    """Column with the items of one block that the document holds."""

    def work(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = WordHashes()
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("shared", pa.int64()), ("size", pa.int64())]))
        for batch in batches:
            yield pa.array([index.search(x, own) for x in texts_of(batch)], kind)

    return F.arrow_udf(_typed(work), FOUND)(F.col(text))


def contaminated(docs: DataFrame, items: DataFrame, shingle: int = SHINGLE, threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``item_id``, ``shared``, ``size`` and ``containment`` of every pair at or above the threshold."""
    out = None
    for index in item_blocks(items, shingle, threshold):
        pairs = docs.select(key, F.explode(found_items(index, text)).alias("found")).select(key, "found.*")
        out = pairs if out is None else out.union(pairs)
    return out.withColumn("containment", F.col("shared") / F.col("size"))


def clean(docs: DataFrame, items: DataFrame, shingle: int = SHINGLE, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """The documents, all columns, that hold no item."""
    for index in item_blocks(items, shingle, threshold):
        docs = docs.where(F.size(found_items(index, text)) == 0)
    return docs
