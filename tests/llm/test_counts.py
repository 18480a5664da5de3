"""Substring removal and language-model scores, which share the block counts, against brute force."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stocktide.llm import blocks, lm, queries, substrings
from stocktide.llm.text import fold, mix, rolling

LONG = " ".join(f"w{i}" for i in range(30_000))
DOCS = [
    (1, "a b c d e f g"),
    (2, "x a b c y"),
    (3, None),
    (4, ""),
    (5, " \t\n "),
    (6, "q r q r q r q r"),
    (6, "q r q r q r q r"),
    (None, "lonely words of their own"),
    (7, "a\u00a0b c d"),
    (8, LONG),
    (9, "Tail w29997 w29998 w29999 A b c"),
]


def frame(spark, rows, clash=True):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({c: F.lit("x") for c in ("n_words", "block", "__text", "kept_text", "score", "train2", "data")}) if clash else df


def expected_removal(rows, window):
    words = [(t or "").encode().split() for _, t in rows]
    counts = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (key, _), w in zip(rows, words):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if counts[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((key, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("window", [1, 3])
def test_removal_against_brute_force(spark, window):
    got = substrings.remove_repeats(frame(spark, DOCS), window).collect()
    rows = [(r.doc_id, r.n_words, r.n_removed, hashlib.sha256(b" ".join((r.kept_text or "").encode().split())).hexdigest()) for r in got]
    assert sorted(rows, key=str) == expected_removal(DOCS, window)
    for r in got:
        assert sum(i["end"] - i["begin"] for i in r.intervals) == r.n_removed
        assert all(a["end"] < b["begin"] for a, b in zip(r.intervals, r.intervals[1:]))
        assert r.n_removed or r.kept_text in [t for _, t in DOCS]


def test_removal_in_many_blocks_and_of_nothing(spark, monkeypatch):
    monkeypatch.setattr(blocks.write_blocks, "__defaults__", ("text", 64))
    got = substrings.remove_repeats(frame(spark, DOCS, clash=False), 3)
    assert got.agg(F.sum("n_removed")).first()[0] == sum(r[2] for r in expected_removal(DOCS, 3))
    assert substrings.remove_repeats(frame(spark, [])).count() == 0


def test_removal_query(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = queries.QUERIES["op2_substring_dedup"](spark, folder).drop("intervals").collect()
    assert sorted(map(tuple, got), key=str) == expected_removal(rows, 35)


def test_rolling_hash_tells_order_and_place():
    values = np.array([5, 7, 11, 5, 7, 11, 7, 5], np.uint64)
    hashes = rolling(values, 3, 0x9E3779B97F4A7C15)
    assert hashes[0] == hashes[3] and len(set(hashes.tolist())) == 5
    assert len(rolling(values, 9, 3)) == 0
    assert len(np.unique(mix(np.arange(1000, dtype=np.uint64)))) == 1000


def test_shrunk_counts_come_back():
    values = np.array([1, 1, 2, 1 << 40, 0], np.int64)
    assert blocks.grow(blocks.shrink(values)).tolist() == values.tolist()
    assert blocks.grow(blocks.shrink(values[:0])).tolist() == []


def tokens(text):
    return (text or "").encode().lower().split() + [None]


def brute_scores(rows, weights):
    """(id, tokens, known, all, base, score) by plain counting, with given mixture weights."""
    words, pairs = Counter(), Counter()
    for _, text, train in rows:
        if train:
            own = tokens(text)
            words.update(own)
            pairs.update(zip([0] + own[:-1], own))
    total, types = sum(words.values()), len(words)
    out = []
    for key, text, _ in rows:
        own = tokens(text)
        base = model = 0.0
        for before, word in zip([0] + own[:-1], own):
            base += math.log10((words[word] + 0.5) / (total + 0.5 * (types + 1)))
            context = words[None] if before == 0 else words[before]
            w = weights[0 if not context else 1 + int(math.log2(context))]
            share = pairs[before, word] / context if context else 0
            model += math.log10(w[0] * share + w[1] * (words[word] / total if total else 0) + w[2] / (types + 1))
        out.append((key, len(own), sum(words[w] > 0 for w in own), total, round(base, 6), round(model, 6)))
    return sorted(out, key=str)


def test_scores_against_brute_force(spark, monkeypatch):
    learnt = []
    plain = lm.learn_weights
    monkeypatch.setattr(lm, "learn_weights", lambda *a, **k: learnt.append(plain(*a, **k)) or learnt[-1])
    rows = [(k, t, i % 3 != 0) for i, (k, t) in enumerate(DOCS)]
    df = spark.createDataFrame(rows, "doc_id long, text string, train boolean").withColumn("score", F.lit(1))
    got = lm.score(df).collect()
    flat = sorted([(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got], key=str)
    assert [r[:4] for r in flat] == [r[:4] for r in brute_scores(rows, learnt[-1])]
    assert [x for r in flat for x in r[4:]] == pytest.approx([x for r in brute_scores(rows, learnt[-1]) for x in r[4:]], abs=2e-6)


def test_scores_without_training_documents(spark):
    df = spark.createDataFrame([(1, "a b", False), (2, None, None)], "doc_id long, text string, train boolean")
    assert sorted((r.doc_id, r.n_tokens, r.train_tokens) for r in lm.score(df).collect()) == [(1, 3, 0), (2, 1, 0)]
    assert lm.score(df.limit(0)).count() == 0


def test_weights_favour_what_predicts():
    n = np.array([100.0, 100.0])
    weights = lm.learn_weights(np.array([5, 5]), np.array([0.5, 0.4]), np.array([0.01, 0.02]), n, 0.001)
    assert weights[5][0] > 0.9 and weights.sum(1) == pytest.approx(np.ones(lm.LEVELS))
    assert weights[9].tolist() == weights[5].tolist()


def test_model_beats_unigrams_on_held_out_texts(spark, folder):
    rows = queries.QUERIES["op1_deleted_interpolation"](spark, folder).where("held_out").collect()
    assert rows and all((zlib.crc32(str(r.doc_id).encode()) % 5 == 1) == r.held_out for r in rows)
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_fold_of_a_null_id(spark):
    df = spark.createDataFrame([(None,), (12,)], "doc_id long").select(fold("doc_id").alias("f"))
    assert [r.f for r in df.collect()] == [0, zlib.crc32(b"12") % 5]
