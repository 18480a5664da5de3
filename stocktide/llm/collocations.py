"""Phrase collocations by prefix-free parsing.

1. The words of a text, with a mark between its pieces, are cut into chunks
   where the hash of a window of ``longest - 1`` words says so; a chunk ends with
   the window that begins the next one. Equal passages give equal chunks
   wherever they stand, so a passage that many documents share is one entry of
   the dictionary, with its number of occurrences in the parse.
2. N-grams are counted inside the distinct chunks, each as often as its chunk
   occurs. An n-gram belongs to the chunk in which it starts before the closing
   window, so those in an overlap are counted once. The sums run over blocks of
   chunks (``blocks.py``), which get back the counts of all n-grams they hold.
3. One block per phrase writes it, with its score. Phrases inside a longer one
   that has a given share of their occurrences are dropped, and the best of each
   language are kept.

N-grams are told apart by two hashes of 64 bits, of which the second chooses the
bucket. Scores are computed with whole numbers of any size.

Defined cases: a null text is empty; a null language counts as ``und``; repeated
rows count as often as they occur; equal scores rank by count, then by the bytes
of the phrase; languages without a phrase have no row; an empty table gives an
empty table; further columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stocktide.session import materialize

from .blocks import TALLY_SCHEMA, beside_blocks, block_size, bucket_count, deal, from_bytes, totals, write_blocks
from .text import WordHashes, mix, texts_of

LONGEST = 3
MIN_COUNT = 10
TOP = 2000
#: Percent of a phrase's occurrences that a longer one needs to cover it.
COVER_PERCENT = 50
MILLION = 1_000_000
#: One window in so many ends a chunk.
CHUNK_WORDS = 32
#: Bytes of chunks that a task adds up before it hands them on.
DICTIONARY_BYTES = 8 << 20
#: Signs that end a piece, and how the table below writes them.
BREAKS, MARK = b".,;:!?\n\x0b\x0c\r", b"."
FOLDED = bytes(MARK[0] if b in BREAKS else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
FIRST, SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def words_of(text: bytes) -> list[bytes]:
    """Words with a mark for every sign that ends a piece; no word is a mark."""
    return text.translate(FOLDED).replace(MARK, b" . ").split()


def chunks_of(words: list[bytes], hashes: WordHashes, longest: int = LONGEST) -> Iterator[bytes]:
    """The chunks of a text, with one space between words; the text is closed by a window of marks."""
    overlap = longest - 1
    words = words + [MARK] * overlap
    values = hashes.of(words)
    window = np.zeros(len(words) - overlap + 1, np.uint64)
    for i in range(overlap):
        window = mix(window * FIRST + values[i : i + len(window)])
    starts = np.flatnonzero(window % np.uint64(CHUNK_WORDS) == 0)
    last = len(window) - 1
    edges = [0, *starts[(starts > 0) & (starts < last)].tolist(), last]
    for a, b in zip(edges, edges[1:]):
        yield b" ".join(words[a : b + overlap])


def parse(docs: DataFrame, longest: int = LONGEST, text: str = "text", lang: str = "lang") -> DataFrame:
    """The dictionary: ``lang``, ``chunk`` and ``n``, how often it occurs in the parse."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        held: Counter = Counter()
        size = 0

        def out() -> pa.RecordBatch:
            langs, chunks = zip(*held) if held else ((), ())
            columns = {"lang": pa.array(langs, pa.string()), "chunk": pa.array(chunks, pa.binary()).cast(pa.string()), "n": pa.array(held.values(), pa.int64())}
            held.clear()
            return pa.RecordBatch.from_pydict(columns)

        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                held.update((name, chunk) for chunk in chunks_of(words_of(data), hashes, longest))
                size += len(data)
                if size > DICTIONARY_BYTES:
                    yield out()
                    size = 0
        yield out()

    source = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    parsed = source.mapInArrow(cut, "lang string, chunk string, n long")
    return parsed.groupBy("lang", "chunk").agg(F.sum("n").alias("n"))


class Grams:
    """The n-grams of a block of chunks: where they start, their keys, and how often they count."""

    def __init__(self, table: pa.Table, hashes: WordHashes, buckets: int, longest: int):
        texts = texts_of(table["chunk"])
        sizes = np.array([text.count(b" ") + 1 for text in texts], np.int64)
        self.words = b" ".join(texts).split(b" ") if texts else []
        self.langs = table["lang"].to_pylist()
        self.chunk = np.repeat(np.arange(len(texts)), sizes)
        self.times = table["n"].to_numpy()
        ends = np.cumsum(sizes)
        left = self.left = np.repeat(ends, sizes) - np.arange(len(self.words))
        values = hashes.of(self.words)
        is_word = values != hashes[MARK]
        seeds = np.array([xxhash.xxh64_intdigest((x or "").encode(), 1) for x in self.langs], np.uint64)[self.chunk] if texts else values
        #: Per length: starts, distinct keys with counts and buckets in order, and the place of each start among them.
        self.kinds = []
        first, second, good = seeds, ~seeds, np.ones(len(values), bool)
        for size in range(1, longest + 1):
            n = max(len(values) - size + 1, 0)
            first = mix(first[:n] * FIRST + values[size - 1 :][:n])
            second = mix(second[:n] * SECOND + values[size - 1 :][:n])
            good = good[:n] & is_word[size - 1 :][:n] & (left[:n] >= size)
            starts = np.flatnonzero(good)
            counted = left[starts] > longest - 1
            weight = np.where(counted, self.times[self.chunk[starts]], 0)
            self.kinds.append((starts, *distinct(first[starts], (second[starts] % np.uint64(buckets)).astype(np.int64), weight)))

    def places(self, size: int) -> np.ndarray:
        """Per word, the place of the n-gram that starts there."""
        out = np.zeros(len(self.words), np.int64)
        out[self.kinds[size - 1][0]] = self.kinds[size - 1][4]
        return out


def distinct(keys: np.ndarray, bucket: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (bucket, key) pairs in order: keys, sums of weights, buckets, and the place of each input."""
    order = np.lexsort((keys, bucket))
    sorted_keys, sorted_bucket = keys[order], bucket[order]
    new = np.ones(len(keys), bool)
    new[1:] = (sorted_keys[1:] != sorted_keys[:-1]) | (sorted_bucket[1:] != sorted_bucket[:-1])
    place = np.empty(len(keys), np.int64)
    place[order] = np.cumsum(new) - 1
    at = np.flatnonzero(new)
    sums = np.add.reduceat(weight[order], at) if len(at) else np.empty(0, np.int64)
    return sorted_keys[at], sums, sorted_bucket[at], place


def lowest_cut(whole: int, parts: list[tuple[int, int]]) -> tuple[int, int, int]:
    """(score, l, r) of the cut with the lowest score; the first of equal ones."""
    scored = [(MILLION * whole * whole // (l * r), k, l, r) for k, (l, r) in enumerate(parts)]
    score, _, l, r = min(scored)  # noqa: E741
    return score, l, r


CANDIDATES = "lang string, phrase string, size int, a long, l long, r long, score decimal(38,0)"


def candidates(docs: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT, text: str = "text", lang: str = "lang") -> DataFrame:
    """Every phrase of 2 to ``longest`` words that occurs often enough, once; and rows of size 1 without phrase, whose ``a`` add up to the words of a language."""
    # An n-gram of each length starts at nearly every word, so a block takes more memory for its size than one of plain texts.
    blocks = write_blocks(parse(docs, longest, text, lang), "chunk", block_size(docs, text) // 2)
    buckets = bucket_count(blocks)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for block, data in zip(batch.column("block").to_pylist(), batch.column("data")):
                own = Grams(from_bytes(data.as_py()), hashes, buckets, longest)
                for kind, (_, keys, sums, bucket, _) in enumerate(own.kinds):
                    yield from deal(block, keys, sums, bucket, first=kind * buckets)

    answers = totals(blocks.select("block", "data").mapInArrow(ask, TALLY_SCHEMA), owners=True)

    def write(block: int, table: pa.Table, found: np.ndarray) -> pa.Table:
        own = Grams(table, WordHashes(), buckets, longest)
        cuts = np.cumsum([0] + [len(kind[1]) for kind in own.kinds])
        counts, mine, places = [], [], []
        for size in range(1, longest + 1):
            answer = found[cuts[size - 1] : cuts[size]]
            counts.append(answer >> 1)
            mine.append(answer & 1)
            places.append(own.places(size))
        count = lambda size, at: int(counts[size - 1][places[size - 1][at]])
        starts = own.kinds[0][0]
        within = own.chunk[starts[own.left[starts] > longest - 1]]
        words = np.bincount(within, minlength=len(own.langs)) * own.times
        rows: list[tuple] = [(name, None, 1, n, None, None, None) for name, n in _summed(own.langs, words.tolist())]
        for size in range(2, longest + 1):
            starts, keys, _, _, place = own.kinds[size - 1]
            chosen = (mine[size - 1] == 1) & (counts[size - 1] >= min_count)
            sample = np.zeros(len(keys), np.int64)
            sample[place] = starts
            for at, a in zip(sample[chosen].tolist(), counts[size - 1][chosen].tolist()):
                score, l, r = lowest_cut(a, [(count(k, at), count(size - k, at + k)) for k in range(1, size)])  # noqa: E741
                rows.append((own.langs[own.chunk[at]], b" ".join(own.words[at : at + size]).decode(), size, a, l, r, score))
        kinds = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.decimal128(38, 0)]
        columns = list(zip(*rows)) or [()] * 7
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["lang", "phrase", "size", "a", "l", "r", "score"])

    return beside_blocks(blocks, answers, write, CANDIDATES)


def _summed(names: list[str], numbers: list[int]) -> list[tuple[str, int]]:
    sums: Counter = Counter()
    for name, n in zip(names, numbers):
        sums[name] += n
    return sorted(sums.items())


def _best(phrases: DataFrame, top: int, rows: int) -> DataFrame:
    """The first ``top`` phrases per language with their ``rank``.

    Each of several parts of a language sends its own first ``top``. There are so many
    parts that one part and all that the parts send have about the same size: both
    grow with the square root of ``rows``, the number of phrases, even in one language.
    """
    part = F.pmod(F.xxhash64("phrase"), F.lit(math.ceil(math.sqrt(rows / max(top, 1))) or 1))
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    first = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    sent = phrases.withColumn("part", part).withColumn("first", first).where(F.col("first") <= top).drop("part", "first")
    return sent.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)


def collocations(
    docs: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT, top: int = TOP, cover_percent: int = COVER_PERCENT, text: str = "text", lang: str = "lang"
) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score`` of each language's best phrases."""
    found = materialize(candidates(docs, longest, min_count, text, lang), "phrases")
    words = found.where("size = 1").groupBy("lang").agg(F.sum("a").alias("n"))
    phrases = found.where("size > 1")
    # All shorter runs of words inside a phrase, with the count of the phrase.
    parts = F.split("phrase", " ")
    inner = phrases.where("size > 2").select(
        "lang",
        F.col("a").alias("cover"),
        F.explode(
            F.flatten(
                F.transform(
                    F.sequence(F.lit(2), F.col("size") - 1),
                    lambda n: F.transform(F.sequence(F.lit(1), F.col("size") - n + 1), lambda i: F.array_join(F.slice(parts, i, n), " ")),
                )
            )
        ).alias("phrase"),
    )
    covers = inner.groupBy("lang", "phrase").agg(F.max("cover").alias("cover"))
    covered = F.col("cover").cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * cover_percent
    open_phrases = phrases.join(covers, ["lang", "phrase"], "left").where(F.col("cover").isNull() | ~covered)
    best = _best(open_phrases, top, phrases.count())
    return best.join(words, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score")
    )
