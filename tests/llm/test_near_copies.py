"""SimHash components, containment search and nearest neighbours against brute force."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from stocktide.llm import ann, decontam, graph, queries, simhash


def brute_print(text, n=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, radius=2):
    prints = [brute_print(t) for _, t in rows]
    root = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(i):
                if (prints[i] ^ prints[j]).bit_count() <= radius and root[i] != root[j]:
                    root[i] = root[j] = min(root[i], root[j])
                    changed = True
    ids = {}
    for (key, _), r in zip(rows, root):
        ids.setdefault(r, []).append(key)
    return sorted(((k, f"{p:016x}", min((x for x in ids[r] if x is not None), default=None)) for (k, _), p, r in zip(rows, prints, root)), key=str)


def test_components_against_brute_force(spark):
    base = "the quick brown fox jumps over the lazy dog and runs far away from here now"
    rows = [(9, base), (4, base.upper()), (7, None), (3, ""), (8, "  "), (5, "one"), (6, "one two"), (5, "one")]
    rows += [(None, base), (20, base + " x"), (21, " ".join(f"w{i}" for i in range(70_000)))]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"fp": F.lit(1), "id": F.lit(2), "root": F.lit(3)})
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(df).collect()]
    assert sorted(got, key=str) == brute_components(rows)
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_component_query(spark, folder):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = queries.QUERIES["op9_simhash_tiles"](spark, folder).collect()
    assert sorted(map(tuple, got), key=str) == brute_components(rows)


def test_tiles_find_all_links(spark, monkeypatch):
    """Chains of prints two bits apart, in tiles of three."""
    monkeypatch.setattr(simhash, "TILE", 3)
    rng = np.random.default_rng(1)
    prints = set()
    for _ in range(30):
        x = int(rng.integers(0, 1 << 62))
        for _ in range(rng.integers(1, 7)):
            prints.add(x)
            x ^= 1 << int(rng.integers(0, 64)) | 1 << int(rng.integers(0, 64))
    signed = sorted(x - (1 << 64) if x >> 63 else x for x in prints)
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    roots = {r.node: r.root for r in graph.components(simhash.links(df)).collect()}
    array = np.array(signed, np.int64).view(np.uint64)
    near = np.bitwise_count(array[:, None] ^ array[None, :]) <= 2
    reach = near
    for _ in range(7):
        reach = (reach.astype(int) @ reach.astype(int)) > 0
    root = [roots.get(x, x) for x in signed]
    assert [[a == b for b in root] for a in root] == reach.tolist()


def test_long_chain_and_star(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 100)] + [(5, 5), (None, 3)]
    roots = {r.node: r.root for r in graph.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert len({roots[i] for i in range(201)}) == 1 and len({roots[1000 + i] for i in range(100)}) == 1
    assert roots[0] != roots[1000] and len(roots) == 301


def words(rng, n):
    return [f"t{int(x)}" for x in rng.integers(0, 10_000, n)]


def test_containment_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(3)
    items = {i: words(rng, n) for i, n in enumerate([3, 5, 12, 40, 60, 200, 1, 2, 4])}
    docs = [(100 + i, " ".join(words(rng, 500) + w + words(rng, 400))) for i, w in items.items()]
    near = list(items[4])
    near[10] = "other"
    far = [w if i % 6 else "x" for i, w in enumerate(items[5])]
    docs += [(200, " ".join(words(rng, 20_000) + near)), (201, " ".join(far)), (202, " ".join(items[0])), (203, None), (204, ""), (None, " ".join(items[3]).upper())]
    docs.append(docs[3])
    bench = [(i, " ".join(w)) for i, w in items.items()] + [(50, None), (51, ""), (3, " ".join(items[3]))]
    expected = []
    for key, text in docs:
        for i, w in items.items():
            # A short item is looked for as a run of its own number of words.
            width = min(5, len(w))
            held = decontam.shingle_set((text or "").encode().lower().split(), width)
            own = decontam.shingle_set([x.encode() for x in w], width)
            if own and len(own & held) >= 0.8 * len(own):
                expected.append((key, i, len(own & held), len(own)))
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"found": F.lit(1), "item_id": F.lit(9)})
    benchmark = spark.createDataFrame(bench, "item_id long, text string")
    get = lambda: sorted([(r.doc_id, r.item_id, r.shared, r.size) for r in decontam.contaminated(df, benchmark).collect()], key=str)
    assert get() == sorted(expected, key=str) and (200, 4) in [e[:2] for e in expected] and 201 not in [e[0] for e in expected]
    assert sorted((str(r.doc_id) for r in decontam.clean(df, benchmark).collect())) == sorted(str(k) for k, _ in docs if k not in {e[0] for e in expected})
    monkeypatch.setattr(decontam, "BLOCK_SHINGLES", 50)
    assert get() == sorted(expected, key=str)
    assert {i for _, i, _, _ in expected} == set(items)
    assert decontam.contaminated(df, benchmark.limit(0)).count() == 0 and decontam.contaminated(df.limit(0), benchmark).count() == 0


def brute_nearest(rows, is_query, k):
    usable = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    out = []
    for n, (i, v) in enumerate(usable):
        if is_query(i):
            scored = sorted([(-float(w @ v), j) for m, (j, w) in enumerate(usable) if m != n and len(w) == len(v)])[:k]
            out += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(scored)]
    return sorted(out)


def test_neighbours_with_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, -0.5]), (3, [2.0, 1.0]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [float("nan"), 1.0])]
    # Ids that occur twice, with equal and with other vectors; equal scores.
    rows += [(30, [0.5, 1.0]), (30, [0.5, 1.0]), (30, [4.0, 1.0]), (1, [3.0, 0.0]), (11, [0.5, 0.5])]
    rows += [(8, [None, 1.0]), (9, [float("inf"), 0.0]), (None, [1.0, 1.0]), (10, [1.0, 2.0, 3.0]), (20, [1.0, 2.0, 4.0]), (3, [2.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"id": F.lit(1), "v": F.lit(2), "dim": F.lit(3)})
    got = ann.nearest(df, F.col("vec_id") % 10 == 0, k=3).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == brute_nearest(rows, lambda i: i % 10 == 0, 3)
    assert ann.nearest(df.limit(0), F.lit(True)).count() == 0


@pytest.mark.parametrize("dim", [64, 100])
def test_recall(spark, monkeypatch, dim):
    monkeypatch.setattr(ann, "BLOCK", 300)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 16)
    vectors = np.random.default_rng(2).normal(size=(900, dim)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    got = ann.nearest(df, F.col("vec_id") % 20 == 0).collect()
    exact = vectors.astype(float) @ vectors[::20].T.astype(float)
    exact[np.arange(0, 900, 20), np.arange(45)] = -np.inf
    best = {20 * q: set(np.argsort(-exact[:, q])[:20].tolist()) for q in range(45)}
    assert len(got) == 900 and sum(r.vec_id in best[r.query_id] for r in got) >= 0.9 * len(got)
    assert all(r.score == pytest.approx(exact[r.vec_id, r.query_id // 20]) for r in got)


def test_wide_vectors(spark):
    rng = np.random.default_rng(7)
    vectors = rng.normal(size=(40, 5000)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    got = sorted((r.query_id, r["rank"], r.vec_id) for r in ann.nearest(df, F.col("vec_id") % 20 == 0, k=3).collect())
    exact = vectors.astype(float) @ vectors.T.astype(float)
    np.fill_diagonal(exact, -np.inf)
    assert got == [(q, r + 1, int(j)) for q in (0, 20) for r, j in enumerate(np.argsort(-exact[q])[:3])]


def test_registered_neighbours_and_items(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = {(r.query_id, r["rank"]): r for r in queries.op3_rotated_codes(spark, folder).collect()}
    expected = brute_nearest(rows, lambda i: i % 20 == 0, 20)
    assert len(got) == len(expected) and sum(got[q, rank].vec_id == i for q, rank, i, _ in expected) >= 0.9 * len(expected)
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    items = [(r.item_id, (r.text or "").encode().lower().split()) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    found = {(r.doc_id, r.item_id) for r in queries.op5_containment(spark, folder).collect()}
    expected = set()
    for d in docs:
        held = {n: decontam.shingle_set((d.text or "").encode().lower().split(), n) for n in range(1, 6)}
        own = {i: decontam.shingle_set(w, min(5, len(w))) for i, w in items if w}
        expected |= {(d.doc_id, i) for i, w in items if w and len(own[i] & held[min(5, len(w))]) >= 0.8 * len(own[i])}
    assert found == expected


def test_bounds_hold():
    rng = np.random.default_rng(4)
    vectors, centre = rng.normal(size=(2000, 64)), rng.normal(size=64) * 0.1
    turn = ann.rotation(64)
    code = ann.encode(vectors, centre, turn)
    inside = []
    for query in rng.normal(size=(20, 64)):
        estimate, error = ann.bounds(query, *code, centre, turn, rng)
        inside.append(np.abs(estimate - vectors @ query) <= error)
    assert np.mean(inside) > 0.99
