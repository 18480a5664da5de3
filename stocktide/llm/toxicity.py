"""Toxicity by compression distance: two zstandard dictionaries, one of them trained on toxic passages.

1. From up to ``fit_rows`` labelled documents, passages of toxic documents are
   taken whose letter sequences of six bytes are over-represented there. A
   dictionary is trained on them, another on windows of ordinary documents.
2. A window, one word between spaces, is compressed with the ordinary
   dictionary, and with both. Its gain is the difference of the two lengths in
   bytes. A fixed tail that both hold stands behind each window, since zstandard
   does not search the last bytes of its input, nor compress tiny ones. Lengths
   are cached per distinct word.
3. A document has the largest gains, the numbers and rates of windows above a
   few gains, and its length. A small network, with a temperature from documents
   it has not seen, calibrates these to a probability.

The passages come from three fifths of the sample and the calibration from the
rest, since dictionaries fit their own texts better. The bound on the sample is
a parameter; every document is scored whole.

Defined cases: a null or empty text has no gain and is scored as such; labels
that disagree are averaged; without labels of both kinds, or without any
over-represented passage, the score is the share of label 1 (0.5 if there is no
label); repeated rows get equal scores; further columns pass untouched.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktide.session import materialize

from .quality import Network, _typed, fit_network
from .sampling import labelled_sample
from .text import CACHED_WORDS, texts_of

FIT_ROWS = 20_000
GRAM = 6
MIN_Z = 5.0
MIN_RATIO = 6.0
PASSAGES = 4_000
WINDOWS = 8_000
WINDOW_WORDS = 8
TOXIC_BYTES, ORDINARY_BYTES = 4096, 1024
TAIL = b" zq0 zq1 zq2 zq3 zq4"
FEATURES = 9


def _grams(word: bytes) -> list[bytes]:
    return [word[i : i + GRAM] for i in range(len(word) - GRAM + 1)]


def gram_counts(sample: DataFrame) -> DataFrame:
    """``gram`` with the numbers of toxic and ordinary documents that hold it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, ordinary = Counter(), Counter()

        def out() -> pa.RecordBatch:
            grams = list(toxic | ordinary)
            return pa.RecordBatch.from_pydict(
                {
                    "gram": pa.array(grams, pa.binary()),
                    "toxic": pa.array([toxic[g] for g in grams], pa.int64()),
                    "ordinary": pa.array([ordinary[g] for g in grams], pa.int64()),
                }
            )

        for batch in batches:
            for text, label in zip(texts_of(batch.column("text")), batch.column("label").to_pylist()):
                found = {g for word in set(text.lower().split()) for g in _grams(b" " + word + b" ")}
                (toxic if label >= 0.5 else ordinary).update(found)
                if len(toxic) + len(ordinary) > 400_000:
                    yield out()
                    toxic.clear()
                    ordinary.clear()
        yield out()

    counted = sample.select("text", "label").mapInArrow(count, "gram binary, toxic long, ordinary long")
    return counted.groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def over_represented(counts: DataFrame, toxic_docs: int, ordinary_docs: int, most: int = PASSAGES) -> set[bytes]:
    """Sequences that toxic documents hold far more often, by share and by significance; the ``most`` most significant ones."""
    a, b = F.col("toxic") / toxic_docs, F.col("ordinary") / ordinary_docs
    pooled = (F.col("toxic") + F.col("ordinary")) / (toxic_docs + ordinary_docs)
    z = (a - b) / F.sqrt(pooled * (1 - pooled) * (1 / toxic_docs + 1 / ordinary_docs) + 1e-12)
    high = counts.where((F.col("toxic") >= 3) & (a >= MIN_RATIO * (F.col("ordinary") + 1) / (ordinary_docs + 1)) & (z >= MIN_Z))
    return {bytes(r["gram"]) for r in high.select("gram", z.alias("z")).orderBy(F.desc("z"), "gram").limit(most).collect()}


def passages_of(text: bytes, grams: set[bytes]) -> Iterator[bytes]:
    """The parts of words that are covered by ``grams``."""
    for word in text.lower().split():
        word = b" " + word + b" "
        begin = end = -1
        for i, g in enumerate(_grams(word)):
            if g in grams:
                if begin >= 0 and i > end:
                    yield word[begin:end]
                    begin = i
                begin, end = (i if begin < 0 else begin), i + GRAM
        if begin >= 0:
            yield word[begin:end]


def toxic_passages(sample: DataFrame, grams: set[bytes], most: int = PASSAGES) -> list[tuple[bytes, int]]:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = Counter(p for text in texts_of(batch.column("text")) for p in passages_of(text, grams))
            yield pa.RecordBatch.from_pydict({"passage": pa.array(list(found), pa.binary()), "n": pa.array(list(found.values()), pa.int64())})

    found = sample.where("label >= 0.5").select("text").mapInArrow(find, "passage binary, n long")
    top = found.groupBy("passage").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "passage").limit(most)
    return [(bytes(r["passage"]), r["n"]) for r in top.collect()]


def ordinary_windows(sample: DataFrame, most: int = WINDOWS) -> list[bytes]:
    """Windows of a few words, up to four from each ordinary document, spread over it."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in texts_of(batch.column("text")):
                words = text.lower().split()
                for i in range(0, len(words), max(WINDOW_WORDS, len(words) // 4 + 1)):
                    out.append(b" ".join(words[i : i + WINDOW_WORDS]))
            yield pa.RecordBatch.from_pydict({"window": pa.array(out, pa.binary())})

    windows = sample.where("label < 0.5").select("text").mapInArrow(cut, "window binary")
    return [bytes(r["window"]) for r in windows.orderBy(F.xxhash64("window"), "window").limit(most).collect()]


def train_dictionary(size: int, samples: list[bytes]) -> bytes:
    """The trained dictionary's bytes; samples too few to train on are the dictionary themselves."""
    try:
        return zstandard.train_dictionary(size, samples, k=16, d=6, level=3).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


@dataclass
class ToxicModel:
    toxic: bytes
    ordinary: bytes
    network: Network

    def _compressor(self, content: bytes) -> zstandard.ZstdCompressor:
        settings = zstandard.ZstdCompressionParameters(
            write_content_size=0, write_checksum=0, write_dict_id=0, strategy=zstandard.STRATEGY_BTOPT,
            min_match=4, window_log=14, hash_log=14, chain_log=14, search_log=6,
        )
        dictionary = zstandard.ZstdCompressionDict(content + TAIL + b"________", dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return zstandard.ZstdCompressor(compression_params=settings, dict_data=dictionary)

    def features(self, texts: list[bytes], gains: Gains) -> np.ndarray:
        out = np.zeros((len(texts), FEATURES))
        for i, text in enumerate(texts):
            words = text.lower().split()
            g = np.fromiter(map(gains.__getitem__, words), np.int64, len(words))
            if len(g):
                top = np.sort(np.partition(g, -3)[-3:] if len(g) > 3 else g)[::-1]
                steps = [(g >= k).sum() for k in (1, 2, 3, 4)]
                out[i] = [top[0], top.sum() / 3, *np.log1p(steps), steps[1] / len(g) ** 0.5, steps[2] / len(g) ** 0.5, np.log1p(len(g))]
        return out

    def gains(self) -> Gains:
        return Gains(self._compressor(self.ordinary), self._compressor(self.toxic + self.ordinary))

    def score(self, text: str = "text") -> Column:
        """Column with the probability of label 1."""

        def work(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            gains = self.gains()
            for batch in batches:
                yield pa.array(self.network(self.features(texts_of(batch), gains)), pa.float64())

        return F.arrow_udf(_typed(work), "double")(F.col(text))


class Gains(dict):
    """Word to the bytes that the toxic dictionary saves."""

    def __init__(self, ordinary: zstandard.ZstdCompressor, both: zstandard.ZstdCompressor):
        super().__init__()
        self.ordinary, self.both = ordinary, both

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        window = b" " + word + b" " + TAIL
        value = self[word] = len(self.ordinary.compress(window)) - len(self.both.compress(window))
        return value


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", fit_rows: int = FIT_ROWS, key: str = "doc_id", text: str = "text") -> ToxicModel:
    """Dictionaries and calibration from the labels of up to ``fit_rows`` documents."""
    sample = materialize(labelled_sample(docs, labels, label, fit_rows, key, text), "toxic_sample")
    part = F.pmod(F.col("place"), F.lit(5))
    learn, check = sample.where(part < 3), sample.where(part >= 3)
    shares = learn.agg(F.count("*").alias("n"), F.coalesce(F.sum((F.col("label") >= 0.5).cast("int")), F.lit(0)).alias("toxic")).first()
    grams: set[bytes] = set()
    if 0 < shares["toxic"] < shares["n"]:
        grams = over_represented(gram_counts(learn), shares["toxic"], shares["n"] - shares["toxic"])
    model = ToxicModel(b"", b"", Network(np.zeros(FEATURES), np.ones(FEATURES), (), 1.0, None))
    if grams:
        found = toxic_passages(learn, grams)
        weight = np.sqrt([n for _, n in found])
        picks = np.random.default_rng(5).choice(len(found), (4000, 8), p=weight / weight.sum())
        model.toxic = train_dictionary(TOXIC_BYTES, [b"".join(found[i][0] for i in row) for row in picks])
        model.ordinary = train_dictionary(ORDINARY_BYTES, ordinary_windows(learn))

    def features(column: pa.Array) -> pa.Array:
        return pa.array(list(model.features(texts_of(column), model.gains())), pa.list_(pa.float64()))

    rows = check.select("place", "__id", F.arrow_udf(features, "array<double>")("text").alias("x"), "label").collect()  # fit_rows at most
    rows.sort(key=lambda r: (r["place"], str(r["__id"])))
    x = np.array([r["x"] for r in rows], float).reshape(-1, FEATURES)
    y = np.array([r["label"] for r in rows], float)
    model.network = fit_network(x, y, hidden=12, steps=2000)
    if not grams:
        share = sample.agg(F.avg("label")).first()[0]
        model.network.constant = 0.5 if share is None else float(share)
    return model
