"""Classifiers and the whole pipeline."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stocktide.llm import decontam, quality, queries, sampling, toxicity
from stocktide.llm.text import fold
from test_counts import expected_removal
from test_formats import check_packing
from test_near_copies import brute_components

MIDDLE = "/root/testdata/sf0.01"


def corpus(n=240):
    rng = np.random.default_rng(0)
    vowels, docs, labels = "aeiou", [], []
    for i in range(n):
        good, toxic = i % 3 != 0, i % 4 == 0
        words = ["".join(rng.choice(list("bdklmnst")) + rng.choice(list(vowels)) for _ in range(rng.integers(1, 4))) for _ in range(60)]
        if not good:
            words = [w + "%%%" for w in words]
        if toxic:
            for at in rng.integers(0, 60, 4):
                words[at] = str(rng.choice(["wretched", "pathetic", "horrible"]))
        docs.append((i, " ".join(words)))
        labels.append((i, int(good), int(toxic)))
    return docs, labels


ODD = [(None, "text without an id"), (1000, None), (1001, ""), (1002, "\u00e9" * 200_000), (5, "a repeated id")]


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = corpus()
    df = spark.createDataFrame(docs + ODD, "doc_id long, text string").withColumns({"label": F.lit(1), "place": F.lit(2), "x": F.lit(3)})
    extra = [(7, None, None), (None, 1, 1), (12, 0, 1)]
    return df, spark.createDataFrame(labels + extra, "doc_id long, quality int, toxic int"), {k: (q, t) for k, q, t in labels}


@pytest.mark.parametrize("label", ["quality", "toxic"])
def test_classifier_learns(tables, label):
    df, labels, truth = tables
    fit = {"quality": quality.fit, "toxic": toxicity.fit}[label]
    model = fit(df, labels.where(fold("doc_id") != 0), label)
    rows = df.select("*", model.score("text").alias("score"), (fold("doc_id") == 0).alias("held")).collect()
    assert len(rows) == 245 and all(0 <= r.score <= 1 for r in rows) and rows[0].label == 1
    held = [(r.score >= 0.5, truth[r.doc_id][label == "toxic"]) for r in rows if r.held and r.doc_id in truth and r.doc_id != 5]
    assert len(held) > 30 and np.mean([a == b for a, b in held]) > 0.9
    again = {r.doc_id: r.s for r in df.select("doc_id", fit(df, labels.where(fold("doc_id") != 0), label).score("text").alias("s")).collect()}
    assert all(again[r.doc_id] == r.score for r in rows if r.doc_id in (3, 100))


@pytest.mark.parametrize("fit", [quality.fit, toxicity.fit])
def test_classifier_without_labels(spark, fit):
    df = spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    label = "quality" if fit is quality.fit else "toxic"
    assert [r.s for r in df.select(fit(df, labels, label).score("text").alias("s")).collect()] == [0.5, 0.5]
    one = spark.createDataFrame([(1, 1, 1)], labels.schema)
    assert [r.s for r in df.select(fit(df, one, label).score("text").alias("s")).collect()] == [1.0, 1.0]
    assert df.limit(0).select(fit(df.limit(0), one, label).score("text")).count() == 0


def test_sample_is_bounded_and_averaged(tables):
    df, labels, _ = tables
    rows = sampling.labelled_sample(df, labels, "toxic", 50).collect()
    assert len(rows) == 50
    rows = {r["__id"]: r for r in sampling.labelled_sample(df, labels, "quality", 1000).collect()}
    assert len(rows) == 240 and rows[12].label == 0.0 and rows[5].text == min(rows[5].text, "a repeated id")


def test_passages():
    grams = {b" trash", b"trash "}
    assert list(toxicity.passages_of(b"some trash trashy", grams)) == [b" trash ", b" trash"]
    gains = toxicity.ToxicModel(b" trash  pathetic ", b" the and of ", None).gains()
    assert gains[b"pathetic"] >= 3 and gains[b"trash"] >= 1 and gains[b"the"] <= 0


def test_temperature_and_constant():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3))
    y = (x[:, 0] + rng.normal(size=400) > 0).astype(float)
    network = quality.fit_network(x, y)
    p = network(x)
    assert np.mean((p > 0.5) == y) > 0.7 and abs(p.mean() - y.mean()) < 0.1
    assert quality.fit_network(x[:0], y[:0])(x[:2]).tolist() == [0.5, 0.5]


def test_held_out_quality_of_the_given_tables(spark):
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet")
    scored = queries.QUERIES["op8_random_indexing"](spark, MIDDLE).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in scored]) > 0.9


def test_pipeline_stages_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumn("n_words", F.lit("clash"))
    state = docs
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in state.collect()]
        after = corpus_pipeline.materialize(stage(spark, state, folder), name)
        rows = after.collect()
        if name != "packing":
            assert tuple(after.columns) == corpus_pipeline.COLUMNS
            assert {r.doc_id for r in rows} <= {k for k, _ in before}
        if name == "quality":
            assert 0 < len(rows) < len(before)
        if name == "near_dedup":
            assert sorted(r.doc_id for r in rows) == sorted({c for _, _, c in brute_components(before)})
        if name == "substring_dedup":
            gone = {k: (n, m) for k, n, m, _ in expected_removal(before, 35)}
            assert sorted(r.doc_id for r in rows) == sorted(k for k, (n, m) in gone.items() if m == 0 or m < n)
            assert all(len(r.text.split()) == gone[r.doc_id][0] - gone[r.doc_id][1] for r in rows)
        if name == "decontamination":
            items = [decontam.shingle_set(r.text.encode().lower().split(), 5) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
            held = {k: decontam.shingle_set(t.encode().lower().split(), 5) for k, t in before}
            bad = {k for k, own in held.items() if any(len(i & own) >= 0.8 * len(i) for i in items)}
            assert {r.doc_id for r in rows} == set(held) - bad
        if name == "packing":
            check_packing(rows, [t for _, t in before], 4096)
        state = after
    assert corpus_pipeline.run(spark, folder).count() == state.count()


def test_pipeline_stages_on_odd_rows(spark, folder):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    odd = [(None, None, None, None, None), (None, "a b", None, None, 3), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, None, None, None, None)]
    for rows in (odd, []):
        state = spark.createDataFrame(rows, schema).withColumn("id", F.lit(1))
        for name, stage in corpus_pipeline.STAGES[1:]:
            state = corpus_pipeline.materialize(stage(spark, state, folder), name)
        assert bool(state.count()) == bool(rows)


def test_near_dedup_keeps_one_row_of_each_component(spark, folder):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(12)) for x in "abcd")
    rows = [(None, "a b", None, None, 3), (5, a, "en", "s", 1), (5, b, "en", "s", 2), (3, a, "en", "s", 1), (None, b.upper(), None, None, None)]
    rows += [(None, c, "de", None, 4), (None, c, "de", None, 4), (6, d, "en", "s", 5), (6, d, "en", "s", 5), (6, d, "en", None, 5), (7, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = [tuple(r) for r in corpus_pipeline.near_dedup(spark, df, folder).collect()]
    kept = [(None, "a b", None, None, 3), (3, a, "en", "s", 1), (5, b, "en", "s", 2), (None, c, "de", None, 4), (7, None, None, None, None)]
    one = [r for r in got if r[0] == 6]
    assert sorted([r for r in got if r[0] != 6], key=str) == sorted(kept, key=str)
    assert len(one) == 1 and one[0] in rows
