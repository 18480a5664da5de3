"""Hard negatives, collocations and token counts against brute force, on odd rows too."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from stocktide.llm import blocks, collocations, hardneg, queries, tokencount

# Hard negatives ---------------------------------------------------------------

VECTOR_SCHEMA = "vec_id long, embedding array<float>, label int"


def expected_negatives(rows, is_anchor, positives=5, negatives=10, low=30, high=90, scale=256):
    """By plain loops over whole numbers; null ids rank last, rows with equal ids by place."""
    limit = lambda x: min(max(x, -(1 << 63)), (1 << 63) - 1)
    floor = lambda x: math.floor(x * scale) if abs(x) < 2**52 else int(x) * scale
    kept = [(n, i, [floor(float(np.float32(x))) for x in v], c) for n, (i, v, c) in enumerate(rows) if usable(v) and c is not None]
    out = []
    for n, i, v, c in kept:
        if not is_anchor(i):
            continue
        scored = [(limit(sum(a * b for a, b in zip(v, w))), j, m, d) for m, j, w, d in kept if m != n and len(w) == len(v)]
        scored.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0, x[2]))
        for p, j, _, _ in [x for x in scored if x[3] == c][:positives]:
            fit = [x for x in scored if x[3] != c and low * p <= 100 * x[0] <= high * p][:negatives]
            out += [(i, j, rank, x[1], p, x[0]) for rank, x in enumerate(fit, 1)]
    return sorted(out, key=str)


def usable(v):
    return v is not None and all(x is not None and math.isfinite(np.float32(x)) for x in v)


def mined(spark, rows, schema=VECTOR_SCHEMA, clash=True, **more):
    df = spark.createDataFrame(rows, schema)
    if clash:
        df = df.withColumns({c: F.lit("x") for c in ("row", "id", "items", "block", "anchor", "dim", "score", "v", "positives")})
    got = hardneg.mine(df, F.col("vec_id") % 100 == 0, **more).collect()
    return sorted([tuple(r) for r in got], key=str)


def test_negatives_against_brute_force(spark, monkeypatch):
    random.seed(5)
    rows = [(i, [random.choice((-0.5, 0.1, 0.25, 0.7)) for _ in range(6)], random.choice((0, 0, 1, 2))) for i in range(0, 400, 5)]
    # A null id, ids that occur twice, null and odd vectors, another dimension, a zero vector, ties.
    rows += [(None, [0.5] * 6, 1), (100, [0.7] * 6, 1), (100, [0.7] * 6, 1), (7, None, 0), (8, [None] * 6, 0), (9, [math.inf] * 6, 0)]
    rows += [(11, [math.nan] * 6, 0), (12, [0.0] * 6, 2), (13, [0.5, 0.5], 0), (300, [0.5, 0.25], 0), (14, [0.5, 0.4], 0), (16, [0.2, 0.2], 1), (15, [0.5] * 6, None)]
    anchors = lambda i: i is not None and i % 100 == 0
    expected = expected_negatives(rows, anchors)
    assert len(expected) > 50 and mined(spark, rows) == expected
    # Blocks and groups of a few rows give the same.
    for name, value in (("BLOCK_ROWS", 16), ("STEP", 2)):
        monkeypatch.setattr(hardneg, name, value)
    assert mined(spark, rows) == expected


def test_negatives_of_large_components_are_exact(spark):
    random.seed(6)
    schema = "vec_id long, embedding array<double>, label int"
    value = lambda: random.choice((1.0, -1.0, 3.0)) * 2.0 ** random.choice((10, 20, 21))
    rows = [(i, [value() for _ in range(3)], i // 5 % 2) for i in range(0, 300, 5)] + [(1, [1e30, 1e30, 1e300], 0)]
    assert mined(spark, rows, schema) == expected_exact(rows)


def expected_exact(rows):
    exact = [(i, [x for x in v], c) for i, v, c in rows]
    floor = lambda x: math.floor(x * 256) if abs(x) < 2**40 else int(x) * 256
    out = []
    for i, v, c in exact:
        if i % 100:
            continue
        limit = lambda x: min(max(x, -(1 << 63)), (1 << 63) - 1)
        scored = sorted((-limit(sum(floor(a) * floor(b) for a, b in zip(v, w))), j, d) for j, w, d in exact if j != i)
        for p, j, _ in [x for x in scored if x[2] == c][:5]:
            fit = [x for x in scored if x[2] != c and 30 * -p <= 100 * -x[0] <= 90 * -p][:10]
            out += [(i, j, rank, x[1], -p, -x[0]) for rank, x in enumerate(fit, 1)]
    return sorted(out, key=str)


def test_packed_fields():
    rng = np.random.default_rng(3)
    for top in (1, 5, 200, 1 << 20, 1 << 40):
        rows, anchors = (rng.integers(-top, top + 1, (n, 7)) for n in (11, 3))
        packed = hardneg.Packed(rows, int(anchors.min()), int(anchors.max()))
        exact = [[sum(int(a) * int(b) for a, b in zip(x, y)) for y in rows] for x in anchors]
        clipped = np.clip(np.array(exact, object), -(1 << 63), (1 << 63) - 1).astype(np.int64)
        assert (packed.scores(anchors) == clipped).all()
        assert packed.fields > 1 or top > 5000
    assert (hardneg.Packed(np.zeros((2, 0), np.int64), 0, 0).scores(np.zeros((3, 0), np.int64)) == 0).all()


def test_negatives_of_nothing(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(100, [0.5], 1)]) == []
    assert mined(spark, [(100, [0.5], 1), (1, [0.5], 2)]) == []


# Collocations -----------------------------------------------------------------


def expected_phrases(rows, longest=3, min_count=2, top=2000, cover=50):
    counts, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", folded):
            words = [w for w in re.split("[ \t]+", piece) if w]
            n[lang] += len(words)
            for size in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        rows_ = []
        for p, a in found.items():
            score, _, l, r = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))  # noqa: E741
            inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))  # noqa: E731,B023
            if not any(len(q) > len(p) and 100 * b >= cover * a and inside(q) for q, b in found.items()):
                rows_.append((score, a, " ".join(p), l, r))
        rows_.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, i, p, a, l, r, n[lang], s) for i, (s, a, p, l, r) in enumerate(rows_[:top], 1)]  # noqa: E741
    return sorted(out, key=str)


def odd_texts():
    random.seed(9)
    words = ["a", "b", "New", "york", "city", "é", "É", " ", "x.y", "z"]
    rows = [(random.choice(("en", "fr", None, "und", "")), " ".join(random.choice(words) for _ in range(random.randint(0, 60)))) for _ in range(60)]
    rows += [("en", None), ("en", ""), ("en", " \t\n. , "), (None, "New York City, New york\tcity! NEW YORK city"), ("de", "b " * 5000), ("de", "c d " * 300)]
    return rows + [("en", "one passage that many documents share word for word " * 4)] * 7


def phrases(spark, rows, **more):
    df = spark.createDataFrame(rows, "lang string, text string")
    df = df.withColumns({c: F.lit(1) for c in ("chunk", "n", "phrase", "a", "size", "rank")})
    return sorted([tuple(r) for r in collocations.collocations(df, **more).collect()], key=str)


@pytest.mark.parametrize("longest", [2, 3, 4])
def test_phrases_against_brute_force(spark, longest):
    rows = odd_texts()
    expected = expected_phrases(rows, longest)
    assert len(expected) > 50 and phrases(spark, rows, longest=longest, min_count=2) == expected


def test_phrases_over_many_blocks(spark, monkeypatch):
    rows = odd_texts()
    monkeypatch.setattr(collocations, "block_size", lambda *_: 500)
    monkeypatch.setattr(collocations, "DICTIONARY_BYTES", 300)
    assert phrases(spark, rows, min_count=3, top=20) == expected_phrases(rows, 3, 3, 20)


@pytest.mark.parametrize("top", [1, 4])
def test_best_phrases_of_many_parts(spark, top):
    """Many parts per language, with equal scores on both sides of the last rank."""
    rows = odd_texts()
    assert phrases(spark, rows, min_count=1, top=top) == expected_phrases(rows, 3, 1, top)


def test_no_phrases(spark):
    assert phrases(spark, []) == []
    assert phrases(spark, [("en", "one two three")], min_count=2) == []


def test_scores_beyond_64_bits():
    a, l, r = 3 * 10**12, 4 * 10**12, 5 * 10**12  # noqa: E741
    assert collocations.lowest_cut(a, [(l, r), (r, l)]) == (10**6 * a * a // (l * r), l, r)


# Token counts -----------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    tokenizers = pytest.importorskip("tokenizers")
    path = queries.tokenizer_path(queries.COUNTED)
    library = tokenizers.Tokenizer.from_file(path)
    return path, lambda text: len(library.encode(text, add_special_tokens=False).ids)


SIGNS = ["a", "b", "the", " ", "  ", "\n", "\t", "'re", "'s", "'", "'ll", "é", "ç", "日本", "1", "23", "!", "<|endoftext|>", "<|endo", "՘", " ", "　", "🙂", "\x1c", "\x85", "Ġ"]


def test_counts_of_every_prefix(tokenizer):
    path, library = tokenizer
    counter = tokencount.PrefixCounter(path)
    random.seed(3)
    for _ in range(400):
        text = "".join(random.choice(SIGNS) for _ in range(random.randint(0, 14)))
        found = tokencount.prefix_counts(tokencount.pack_steps(counter.of(text)))
        assert found.tolist() == [library(text[:n]) for n in range(len(text) + 1)], text


def test_counts_of_rows(spark, tokenizer):
    path, library = tokenizer
    texts = ["two words", "", None, "x" * 30_000, "<|endoftext|>" * 3, "don't\n\n  we'll ", "a" * 7 + " " * 300 + "b", "two words"]
    rows = [(i if i else None, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("n_tokens", "__text", "prefix_steps", "n_bytes")})
    counted = tokencount.count_tokens(df, path).cache()
    got = sorted((str(r.doc_id), r.n_chars, r.n_bytes, r.n_tokens) for r in counted.collect())
    assert got == sorted((str(i), len(t or ""), len((t or "").encode()), library(t or "")) for i, t in rows)
    by_id = {i: t or "" for i, t in rows}
    for budget in (-1, 0, 1, 3, 40):
        for r in counted.select("doc_id", tokencount.fits(budget).alias("n"), tokencount.count_before(F.lit(5)).alias("five")).collect():
            text = by_id[r.doc_id]
            assert library(text[: r.n]) <= max(budget, 0) and r.five == library(text[:5])
            if len(text) < 400:
                assert r.n == max(n for n in range(len(text) + 1) if library(text[:n]) <= max(budget, 0))
    short = {r.doc_id: r for r in tokencount.truncated(df, path, 3).collect()}
    assert short[1].text == "" and short[4].text == "<|endoftext|>" * 3 and short[4].n_tokens == 3
    assert tokencount.count_tokens(df.where("false"), path).collect() == []


def test_words_are_cut_once_and_as_in_whole_texts(tokenizer, monkeypatch):
    path, library = tokenizer
    counter = tokencount.counter_of(path)
    assert tokencount.counter_of(path) is counter  # later tasks of a worker find what earlier ones have seen
    signs, rng = [" ", "  ", "\n", " \n", "\t", "a", "don't", "'re", "we'll", "x1", "é", "日本", "!", "\u0085", "\u3000", "<|endoftext|>"], random.Random(5)
    for caches in (400_000, 3):
        monkeypatch.setattr(tokencount, "CACHED_WORDS", caches)
        for text in ["", " ", " a", "a ", "a  b", "a \nb", "x" * 100 + " y", *("".join(rng.choices(signs, k=9)) for _ in range(300))]:
            counts = [0, *np.cumsum(counter.of(text))]
            assert counts == [library(text[:n]) for n in range(len(text) + 1)]
    monkeypatch.setattr(counter, "parts", lambda text, real=counter.parts: [] if text == "" else pytest.fail(text))
    monkeypatch.setattr(tokencount, "CACHED_WORDS", 400_000)
    counter.words.update({w: counter.joined([f" {w}"]) for w in ("seen", "before")})
    assert counter.of(" seen before seen").sum() == library(" seen before seen")


def test_null_budget_and_place(spark, tokenizer):
    df = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    counted = tokencount.count_tokens(df, tokenizer[0])
    row = counted.select(tokencount.fits(F.lit(None)).alias("a"), tokencount.count_before(F.lit(None)).alias("b"), tokencount.count_before(F.lit(99)).alias("c")).first()
    assert (row.a, row.b, row.c) == (None, None, 2)


def test_registered_queries(spark, folder, tokenizer):
    _, library = tokenizer
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    texts = {r.doc_id: r.text or "" for r in docs}
    for r in queries.op13_prefix_token_counts(spark, folder).collect():
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (library(texts[r.doc_id]), len(texts[r.doc_id].encode()), library(texts[r.doc_id]) > 1024)
        assert library(texts[r.doc_id][: r.chars_in_limit]) <= 1024
    got = sorted([tuple(r) for r in queries.op12_parsed_collocations(spark, folder).collect()], key=str)
    assert got == expected_phrases([(r.lang, r.text) for r in docs], 3, 10, 2000)
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    moved = [(r.vec_id, r.embedding, None if r.label is None else (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in vectors]
    got = sorted([tuple(r) for r in queries.op11_packed_hard_negatives(spark, folder).collect()], key=str)
    assert got == expected_negatives(moved, lambda i: i % 100 == 0)


# Blocks -----------------------------------------------------------------------


def test_rows_between_blocks_and_buckets_follow_the_input():
    """Blocks times buckets, for inputs a thousand times apart."""
    rows = lambda total: (total / (blocks.BLOCK_BYTES * blocks.growth(total))) * (total / (blocks.BUCKET_BYTES * blocks.growth(total)))
    small = blocks.BASE_BYTES
    assert rows(8 * small) / rows(small) == pytest.approx(8)
    assert rows(64 * small) / rows(small) == pytest.approx(64)


def test_keys_in_order_survive_packing():
    keys = np.sort(np.random.default_rng(1).integers(0, 2**64, 1000, np.uint64))
    assert (blocks.unpack_keys(blocks.pack_keys(keys)) == keys).all()
    assert len(blocks.unpack_keys(blocks.pack_keys(keys[:0]))) == 0
