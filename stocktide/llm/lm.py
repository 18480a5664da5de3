"""Language-model scores by deleted interpolation.

Bigram and unigram maximum-likelihood estimates and a uniform share are mixed
with weights that depend on how often the context was seen, in buckets by powers
of two. The weights come from expectation-maximisation on deleted counts: each
training document is held out in turn, its own counts taken from the corpus
counts. All training tokens take part; they reach the driver as a histogram over
(bucket, quantised bigram share, quantised unigram share), whose size is bounded
by the grid and not by the corpus.

Tokens are the words of the text with A-Z lowered, then one end token; the first
context is a start mark, which is as frequent as the end token.

Defined cases: a null text counts as empty and has the end token alone; a table
without a training document gives every token the uniform share of one; repeated
rows count as often as they occur; a null id is folded as the empty text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.session import materialize

from .blocks import TALLY_SCHEMA, beside_blocks, block_size, bucket_count, deal, distinct_keys, from_bytes, totals, write_blocks
from .text import WordHashes, mix, texts_of

END, START = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
#: Steps of the histogram per factor of two.
STEPS = 4
ROUNDS = 60
LEVELS = 64


class Tokens:
    """The tokens of a block: unigram and bigram keys, the document of each, and places in what the block asks for."""

    def __init__(self, texts: list[bytes], counted: np.ndarray, buckets: int, hashes: WordHashes):
        words = [text.lower().split() for text in texts]
        self.sizes = np.array([len(w) + 1 for w in words], np.int64)
        ends = np.cumsum(self.sizes) - 1
        n = int(self.sizes.sum())
        token = np.empty(n, np.uint64)
        inner = np.ones(n, bool)
        inner[ends] = False
        token[inner] = np.concatenate([hashes.of(w) for w in words]) if words else []
        token[ends] = END
        context = np.empty(n, np.uint64)
        context[1:] = token[:-1]
        context[np.concatenate(([0], ends[:-1] + 1))[: len(ends)]] = START
        self.doc = np.repeat(np.arange(len(words)), self.sizes)
        self.first = context == START
        counted = counted[self.doc]
        self.words = distinct_keys(mix(token), buckets, counted)
        self.pairs = distinct_keys(mix(mix(context) * MULTIPLIER + token), buckets, counted)

    def read(self, totals: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Corpus counts of each token, its bigram and its context."""
        split = len(self.words[0])
        word = totals[:split][self.words[3]]
        pair = totals[split:][self.pairs[3]]
        return word, pair, self.context(word)

    def context(self, per_token: np.ndarray) -> np.ndarray:
        """What belongs to each token's context, given what belongs to each token; the start mark is as the end token."""
        out = np.empty_like(per_token)
        out[1:] = per_token[:-1]
        ends = np.cumsum(self.sizes) - 1
        out[self.first] = per_token[ends]
        return out

    def own(self, place: np.ndarray) -> np.ndarray:
        """How often each token's key occurs in its own document."""
        codes = self.doc * (int(place.max(initial=0)) + 1) + place
        _, back, counts = np.unique(codes, return_inverse=True, return_counts=True)
        return counts[back]


def bucket_of(context: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else 1 + the whole logarithm of its count to base two."""
    return np.where(context > 0, np.frexp(np.maximum(context, 1).astype(float))[1], 0)


def share(part: np.ndarray, whole: np.ndarray | float) -> np.ndarray:
    return np.where(part > 0, part / np.maximum(whole, 1), 0.0)


def learn_weights(bucket: np.ndarray, pair: np.ndarray, word: np.ndarray, n: np.ndarray, uniform: float, rounds: int = ROUNDS) -> np.ndarray:
    """Weights of (bigram, unigram, uniform) per bucket by expectation-maximisation.

    Each bucket starts from, and is smoothed by one token of, equal weights; the
    unseen context has no bigram share. A bucket without tokens takes the weights
    of the next lower bucket that has some.
    """
    parts = np.stack([pair, word, np.full(len(n), uniform)])
    weights = np.full((LEVELS, 3), 1 / 3)
    weights[0] = (0.0, 0.5, 0.5)
    start = weights.copy()
    for _ in range(rounds):
        mixed = parts * weights[bucket].T
        mixed *= n / np.maximum(mixed.sum(0), 1e-300)
        sums = np.stack([np.bincount(bucket, m, LEVELS) for m in mixed], 1) + start
        weights = sums / sums.sum(1, keepdims=True)
    seen = np.bincount(bucket, n, LEVELS) > 0
    for level in range(2, LEVELS):
        if not seen[level] and seen[1:level].any():
            weights[level] = weights[level - 1]
    return weights


def score(docs: DataFrame, train: str = "train", key: str = "doc_id", text: str = "text") -> DataFrame:
    """Scores of all documents by a model of those where the boolean column ``train`` is true.

    Returns ``key``, ``train``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` (additively smoothed unigrams) and ``score``.
    """
    source = docs.select(key, F.coalesce(F.col(train), F.lit(False)).alias("__train"), F.col(text).alias("__text"))
    blocks = write_blocks(source, "__text", block_size(source, "__text"))
    buckets = bucket_count(blocks)

    def tokens(table: pa.Table, hashes: WordHashes | None = None) -> tuple[Tokens, np.ndarray]:
        train_rows = table["__train"].to_numpy().astype(bool)
        return Tokens(texts_of(table["__text"]), train_rows, buckets, hashes or WordHashes()), train_rows

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for block, data in zip(batch.column("block").to_pylist(), batch.column("data")):
                own, _ = tokens(from_bytes(data.as_py()), hashes)
                yield from deal(block, *own.words[:3])
                yield from deal(block, *own.pairs[:3], first=buckets)

    answers = materialize(totals(blocks.select("block", "data").mapInArrow(ask, TALLY_SCHEMA)), "lm_counts")
    seen = answers.where(F.col("bucket") < buckets).agg(F.sum("types"), F.sum("tokens")).first()
    types, total = int(seen[0] or 0), int(seen[1] or 0)
    uniform = 1.0 / (types + 1)

    def levels(block: int, table: pa.Table, found: np.ndarray) -> pa.Table:
        own, train_rows = tokens(table)
        word, pair, context = own.read(found)
        mine = own.own(own.words[3])
        at = train_rows[own.doc]
        word, pair, context = word - mine, pair - own.own(own.pairs[3]), context - own.context(mine)
        left = total - own.sizes[own.doc]
        grid = [bucket_of(context)[at]]
        for part, whole in ((pair, context), (word, left)):
            p = share(part, whole)[at]
            grid.append(np.where(p > 0, -np.rint(STEPS * np.log2(np.maximum(p, 1e-300))), -1).astype(np.int64))
        codes = (grid[0] * 1024 + grid[1] + 1) * 1024 + grid[2] + 1
        values, n = np.unique(codes, return_counts=True)
        return pa.table({"code": pa.array(values, pa.int64()), "n": pa.array(n, pa.int64())})

    histogram = beside_blocks(blocks, answers, levels, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toPandas()
    code, n = histogram["code"].to_numpy(np.int64), histogram["n"].to_numpy(float)
    back = lambda q: np.where(q == 0, 0.0, 2.0 ** (-(q - 1) / STEPS))
    weights = learn_weights(code >> 20, back(code >> 10 & 1023), back(code & 1023), n, uniform)

    kind = source.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"

    def rate(block: int, table: pa.Table, found: np.ndarray) -> pa.Table:
        own, train_rows = tokens(table)
        word, pair, context = own.read(found)
        w = weights[bucket_of(context)].T
        mixed = w[0] * share(pair, context) + w[1] * share(word, float(total)) + w[2] * uniform
        base = (word + 0.5) / (total + 0.5 * (types + 1))
        docs_, sums = len(own.sizes), lambda x: np.bincount(own.doc, x, len(own.sizes))
        return pa.table(
            {
                key: table[key],
                "train": pa.array(train_rows),
                "n_tokens": pa.array(own.sizes, pa.int64()),
                "n_known": pa.array(sums(word > 0).astype(np.int64), pa.int64()),
                "train_tokens": pa.array(np.full(docs_, total), pa.int64()),
                "base_score": pa.array(sums(np.log10(base))),
                "score": pa.array(sums(np.log10(mixed))),
            }
        )

    return beside_blocks(blocks, answers, rate, schema)
