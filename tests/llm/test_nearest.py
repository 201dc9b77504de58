from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tiffin.llm.nearest import MultiIndex, nearest_vectors


def brute(ids, vectors, is_query, k):
    out = {}
    for q in sorted({i for i in ids if is_query(i)}):
        scores = (vectors * vectors[list(ids).index(q)]).sum(axis=1)
        others = [j for j in range(len(ids)) if ids[j] != q]
        out[q] = [(int(ids[j]), scores[j]) for j in sorted(others, key=lambda j: (-scores[j], ids[j]))[:k]]
    return out


def found(spark, ids, vectors, k):
    rows = [(int(i), [float(x) for x in v], "clash") for i, v in zip(ids, vectors, strict=True)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, id string").repartition(5)
    out = {}
    for r in nearest_vectors(df, F.col("vec_id") % 20 == 0, k).orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


@pytest.mark.parametrize("kind", ["sphere", "lengths", "clusters", "copies"])
def test_recall(spark, kind):
    rng = np.random.default_rng(4)
    v = rng.normal(size=(1500, 32))
    if kind == "sphere":
        v /= np.linalg.norm(v, axis=1, keepdims=True)
    elif kind == "clusters":
        v = rng.normal(size=(10, 32))[rng.integers(0, 10, 1500)] * 3 + v * 0.5
    elif kind == "copies":
        v[::3] = v[0]
    ids = np.arange(1500)
    want = brute(ids, v, lambda i: i % 20 == 0, 20)
    got = found(spark, ids, v, 20)
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    for q in got:
        assert [s for _, s in got[q]] == [float((v[i] * v[q]).sum()) for i, _ in got[q]]
        assert got[q] == sorted(got[q], key=lambda x: (-x[1], x[0]))


def test_few_rows_ties_and_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 0.0]), (3, [1.0, 0.0]), (2, [0.0, 2.0]), (20, [-1.0, 0.5]), (20, [-1.0, 0.5]), (5, None),
        (6, [0.0, 0.0]), (7, [1.0, None]), (8, [nan, 1.0]), (9, [inf, 1.0]), (10, []), (11, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]),
        (40, None), (60, [0.0, 0.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in nearest_vectors(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got[0] == [(1, 1.0), (3, 1.0), (2, 0.0), (20, -1.0), (20, -1.0)]
    assert set(got) == {0, 20}
    assert {i for i, _ in got[20]} == {0, 1, 2, 3}


def test_repeated_queries_keep_their_neighbours(spark):
    """Copies of a query row ask once; two vectors under one id give each candidate's larger score."""
    v = np.random.default_rng(7).normal(size=(60, 8))
    ids = [*range(60), *[0] * 24, 20]
    vectors = np.concatenate([v, np.repeat(v[:1], 24, axis=0), v[40:41]])
    got = found(spark, ids, vectors, 5)
    for q, asking in ((0, v[[0]]), (20, v[[20, 40]])):
        scores = (vectors[:, None, :] * asking).sum(axis=2).max(axis=1)
        want = sorted((-s, i) for s, i in zip(scores, ids, strict=True) if i != q)[:5]
        assert got[q] == [(i, pytest.approx(-s)) for s, i in want]


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert nearest_vectors(df, F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("radius", [0, 5, 9, 20, 31])
def test_index_finds_every_code_in_the_radius(radius):
    rng = np.random.default_rng(radius)
    codes = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    codes[:300] = codes[0] ^ (np.uint64(1) << rng.integers(0, 63, 300).astype(np.uint64))
    index = MultiIndex(codes, radius)
    for code in codes[[0, 5, 1000]]:
        assert index.within(code).tolist() == np.flatnonzero(np.bitwise_count(codes ^ code) <= radius).tolist()
