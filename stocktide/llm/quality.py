"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

1. Tokens are runs of letters and digits, and runs of other signs. Each falls by
   hash into one of ``SLOTS`` slots, and each slot has a sparse index vector of
   ``DIMS`` numbers from its hash. The vector of a slot is the sum of the index
   vectors of all neighbours within ``REACH`` tokens, over the whole corpus.
   Tasks add up locally and send one array; its size does not depend on the text.
2. A document is the mean of the unit vectors of its tokens, with the logarithm
   of their number.
3. A network of two layers learns the labels from at most ``fit_rows`` labelled
   documents, chosen by a hash of the id. A fifth of them is kept apart, to find
   the temperature that divides the output before it becomes a probability.

The bound on the labelled sample is a parameter; vectors come from all texts and
all texts are scored whole.

Defined cases: a null or empty text has the zero vector and is scored as such;
labels of one document that disagree are averaged, null labels are ignored;
without labels of both kinds the score is the share of label 1 (0.5 if there is
none at all); repeated rows get equal scores; further columns pass through
``score`` untouched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sampling import labelled_sample
from .text import CACHED_WORDS

SLOTS = 1 << 14
DIMS = 32
NONZERO = 4
REACH = 2
CHUNK = 256
FIT_ROWS = 20_000
HIDDEN = 24
TOKEN = re.compile(r"\w+|[^\w\s]+")
#: Tokens that are counted at once.
FLUSH = 1 << 18


class Slots(dict):
    def __missing__(self, token: str) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[token] = xxhash.xxh64_intdigest(token.encode("utf-8", "surrogatepass")) % SLOTS
        return value

    def of(self, text: str | None) -> np.ndarray:
        found = TOKEN.findall(text) if text else []
        return np.fromiter(map(self.__getitem__, found), np.int64, len(found))


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero entries of each slot's index vector."""
    rng = np.random.default_rng(7)
    places = np.argsort(rng.random((SLOTS, DIMS)), axis=1)[:, :NONZERO]
    return places, rng.choice([-1, 1], (SLOTS, NONZERO))


def corpus_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Unit context vectors of all slots (``SLOTS`` x ``DIMS``), from every text."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_vectors()
        slots, total = Slots(), np.zeros(SLOTS * DIMS)
        held: list[np.ndarray] = []

        def add() -> None:
            line = np.concatenate(held)
            for gap in range(1, REACH + 1):
                a, b = line[:-gap], line[gap:]
                keep = (a >= 0) & (b >= 0)
                a, b = a[keep], b[keep]
                for x, y in ((a, b), (b, a)):
                    for k in range(NONZERO):
                        total[:] += np.bincount(x * DIMS + places[y, k], signs[y, k], SLOTS * DIMS)

        apart, size = np.full(REACH, -1), 0
        for batch in batches:
            for value in batch.column(0):
                own = slots.of(value.as_py())
                for i in range(0, len(own), FLUSH):
                    held += [own[max(0, i - REACH) : i] if i and not held else own[:0], own[i : i + FLUSH]]
                    size += len(held[-1])
                    if size >= FLUSH:
                        add()
                        held, size = [], 0
                held.append(apart)
        if held:
            add()
        rows = total.reshape(-1, CHUNK * DIMS).astype("<i8")
        full = np.flatnonzero(rows.any(1))
        yield pa.RecordBatch.from_pydict({"chunk": pa.array(full, pa.int64()), "sums": pa.array([rows[i].tobytes() for i in full], pa.binary())})

    def merge(table: pa.Table) -> pa.Table:
        sums = sum(np.frombuffer(x.as_py(), "<i8") for x in table["sums"])
        return pa.table({"chunk": table["chunk"][:1], "sums": pa.array([sums.tobytes()], pa.binary())})

    schema = "chunk long, sums binary"
    local = docs.select(F.col(text).alias("t")).mapInArrow(gather, schema)
    # Two rounds, so that no group gathers the arrays of all tasks at once.
    spread = local.withColumn("group", F.pmod(F.xxhash64("sums"), F.lit(32)))
    first = spread.groupBy("chunk", "group").applyInArrow(lambda t: merge(t.drop_columns(["group"])), schema)
    vectors = np.zeros((SLOTS // CHUNK, CHUNK * DIMS))
    for row in first.groupBy("chunk").applyInArrow(merge, schema).collect():  # SLOTS // CHUNK rows of fixed size
        vectors[row["chunk"]] = np.frombuffer(row["sums"], "<i8")
    vectors = vectors.reshape(SLOTS, DIMS)
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return (vectors / np.maximum(length, 1e-12)).astype(np.float32)


def pool(texts: list[str | None], vectors: np.ndarray, slots: Slots) -> np.ndarray:
    """Features of documents: mean token vector and logarithm of the token count."""
    out = np.zeros((len(texts), DIMS + 1), np.float32)
    for i, text in enumerate(texts):
        own = slots.of(text)
        if len(own):
            total = sum(vectors[own[j : j + FLUSH]].sum(0, dtype=np.float64) for j in range(0, len(own), FLUSH))
            out[i, :DIMS] = total / len(own)
            out[i, DIMS] = np.log1p(len(own))
    return out


@dataclass
class Network:
    """Features to the probability of label 1."""

    mean: np.ndarray
    spread: np.ndarray
    layers: tuple[np.ndarray, ...]
    temperature: float
    constant: float | None = None

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh((x - self.mean) / self.spread @ w1 + b1) @ w2 + b2

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def fit_network(x: np.ndarray, y: np.ndarray, hidden: int = HIDDEN, steps: int = 3000, batch: int = 256, decay: float = 1e-4) -> Network:
    """Adam on the cross-entropy; every fifth row is kept for the temperature. Rows come in hashed order."""
    x = x.astype(np.float64)
    flat = Network(np.zeros(x.shape[1]), np.ones(x.shape[1]), (), 1.0, float(y.mean()) if len(y) else 0.5)
    if len(y) < 10 or y.min() > 0.5 or y.max() < 0.5:
        return flat
    held = np.arange(len(y)) % 5 == 4
    tx, ty = x[~held], y[~held]
    mean, spread = tx.mean(0), tx.std(0) + 1e-6
    rng = np.random.default_rng(11)
    w = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), np.zeros(1)]
    m, v = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w]
    z = (tx - mean) / spread
    for step in range(1, steps + 1):
        at = rng.integers(0, len(ty), batch)
        h = np.tanh(z[at] @ w[0] + w[1])
        error = (1 / (1 + np.exp(-np.clip(h @ w[2] + w[3], -40, 40))) - ty[at]) / batch
        back = error[:, None] * w[2] * (1 - h * h)
        rate = 0.01 * (1 - step / (steps + 1))
        for i, g in enumerate((z[at].T @ back + decay * w[0], back.sum(0), h.T @ error + decay * w[2], error.sum(keepdims=True))):
            m[i] += 0.1 * (g - m[i])
            v[i] += 0.001 * (g * g - v[i])
            w[i] = w[i] - rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    network = Network(mean, spread, tuple(w), 1.0)
    logits, target = network.logits(x[held]), y[held]
    loss = lambda t: np.mean(np.logaddexp(0, logits / t) - target * logits / t)
    network.temperature = float(min(np.geomspace(0.25, 8, 101), key=loss))
    return network


@dataclass
class QualityModel:
    vectors: np.ndarray
    network: Network

    def score(self, text: str = "text") -> Column:
        """Column with the probability of label 1."""
        vectors, network = self.vectors, self.network

        def work(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            slots = Slots()
            for batch in batches:
                yield pa.array(network(pool(batch.to_pylist(), vectors, slots)), pa.float64())

        return F.arrow_udf(_typed(work), "double")(F.col(text))


def _typed(work):
    """Arrow functions are told apart by their type hints, which must be objects."""
    work.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return work


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", fit_rows: int = FIT_ROWS, key: str = "doc_id", text: str = "text") -> QualityModel:
    """Word vectors from all ``docs``, the network from ``labels`` (``key``, ``label``) of up to ``fit_rows`` of them."""
    vectors = corpus_vectors(docs, text)

    def features(column: pa.Array) -> pa.Array:
        return pa.array(list(pool(column.to_pylist(), vectors, Slots())), pa.list_(pa.float32()))

    sample = labelled_sample(docs, labels, label, fit_rows, key, text)
    rows = sample.select("place", "__id", F.arrow_udf(features, "array<float>")("text").alias("x"), "label").collect()  # fit_rows at most
    rows.sort(key=lambda r: (r["place"], str(r["__id"])))
    x = np.array([r["x"] for r in rows], np.float32).reshape(-1, DIMS + 1)
    return QualityModel(vectors, fit_network(x, np.array([r["label"] for r in rows], float)))
