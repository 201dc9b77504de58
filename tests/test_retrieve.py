from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tiffin.functions.vectors import cosine
from tiffin.operators import ivf
from tiffin.operators import retrieve as r
from tiffin.operators import topk
from tiffin.sources.tables import LayerTable

VECTORS = "chunk_id bigint, vector array<float>"


def brute(store, queries, k):
    out = set()
    for q, qv in queries:
        scored = []
        for i, v in store:
            a, b = np.array(qv, "float64"), np.array(v, "float64")
            length = np.linalg.norm(a) * np.linalg.norm(b)
            scored.append((-round(float(a @ b / length), 9) if length else 0.0, i))
        out |= {(q, i, rank) for rank, (_, i) in enumerate(sorted(scored)[:k], 1)}
    return out


def found(df):
    return {(x.query_id, x.chunk_id, x.rank) for x in df.collect()}


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(1)
    base = rng.normal(size=(60, 8)).astype("float32")
    store = [(i, base[i % 60].tolist()) for i in range(150)]  # copies tie
    store += [(200 + i, base[0].tolist()) for i in range(100)]  # one vector holds much of the store
    store += [(400, [0.0] * 8)]
    queries = [(i, rng.normal(size=8).tolist()) for i in range(6)] + [(6, base[0].tolist()), (7, [0.0] * 8)]
    return store, queries


def test_topk_against_brute_force(spark, data):
    store, queries = data
    s = spark.createDataFrame(store, VECTORS).repartition(6)
    q = spark.createDataFrame(queries, "query_id int, vector array<double>")
    assert found(topk.cosine_topk(s, q, 5)) == brute(store, queries, 5)
    assert found(topk.cosine_topk(s, q, 1000)) == brute(store, queries, 1000)


def test_a_hot_id_spreads_over_blocks(spark, monkeypatch):
    """One id with many vectors: its items are in several blocks, and the answer is that of one block."""
    rng = np.random.default_rng(2)
    store = [(7, rng.normal(size=4).tolist()) for _ in range(300)] + [(i, rng.normal(size=4).tolist()) for i in range(8, 40)]
    s = spark.createDataFrame(store, VECTORS)
    q = spark.createDataFrame([(0, [1.0, 2.0, 3.0, 4.0])], "query_id int, vector array<double>")
    rows = lambda: sorted((r.chunk_id, r.score) for r in topk.cosine_topk(s, q, 20).collect())
    whole = rows()
    monkeypatch.setattr(topk, "ITEMS_PER_BLOCK", 16)
    assert rows() == whole


def test_cells(spark, data, monkeypatch):
    """All cells give the exact answer, in blocks of any size; the nearest cells most of it."""
    store, queries = data
    s = spark.createDataFrame(store, VECTORS).repartition(6)
    q = spark.createDataFrame(queries, "query_id int, vector array<double>")
    for size in (ivf.ITEMS_PER_BLOCK, 7):
        monkeypatch.setattr(ivf, "ITEMS_PER_BLOCK", size)
        monkeypatch.setattr(ivf, "QUERIES_PER_BLOCK", min(size, 3))
        index = ivf.build_index(s, cells=9)
        assert found(ivf.search(index, q, 5, probes=9)) == brute(store, queries, 5)
    placed = {(r.chunk_id, r.cell) for r in index.items.collect()}
    assert len(placed) == len(store) and len({c for _, c in placed}) > 4


def test_clustered_vectors_are_found_in_few_cells(spark):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(40, 16))
    store = [(i, (centers[i % 40] + 0.15 * rng.normal(size=16)).tolist()) for i in range(2000)]
    s = spark.createDataFrame(store, VECTORS)
    q = s.filter("chunk_id % 50 = 0").select(F.col("chunk_id").alias("query_id"), "vector")
    index = ivf.build_index(s, sample=500)
    near = ivf.search(index, q, 10, probes=8)
    assert len(index.centroids) > 30
    assert ivf.recall(near, topk.cosine_topk(s, q, 10)) >= 0.9


def test_cell_edges(spark):
    empty = spark.createDataFrame([], VECTORS)
    q = spark.createDataFrame([(1, [1.0, 0.0])], "query_id int, vector array<double>")
    assert ivf.search(ivf.build_index(empty), q, 3, probes=1).count() == 0
    flat = spark.createDataFrame([(1, [0.0, 0.0]), (2, None)], VECTORS)
    got = ivf.search(ivf.build_index(flat), q, 3, probes=1).collect()
    assert [(r.chunk_id, r.score) for r in got] == [(1, 0.0)]


def test_topk_in_several_blocks(spark, data, monkeypatch):
    store, queries = data
    monkeypatch.setattr(topk, "QUERIES_PER_BLOCK", 3)
    s = spark.createDataFrame(store, VECTORS)
    q = spark.createDataFrame(queries, "query_id int, vector array<double>")
    assert found(topk.cosine_topk(s, q, 4)) == brute(store, queries, 4)


def test_topk_edges(spark):
    empty = spark.createDataFrame([], VECTORS)
    q = spark.createDataFrame([(1, [1.0, 0.0])], "query_id int, vector array<double>")
    assert topk.cosine_topk(empty, q, 3).count() == 0
    s = spark.createDataFrame([(1, [1.0, 1.0]), (2, None)], VECTORS)
    assert topk.cosine_topk(s, q.limit(0), 3).count() == 0
    (hit,) = topk.cosine_topk(s, q, 3).collect()
    assert hit.chunk_id == 1 and hit.score == pytest.approx(0.5**0.5)
    wrong = spark.createDataFrame([(71, [1.0, 1.0, 1.0])], VECTORS)
    with pytest.raises(Exception, match="vector of 71 has 3 numbers, not 2"):
        topk.cosine_topk(wrong, q, 3).collect()


def test_ragged_vectors_are_named_not_scored(spark):
    """Lengths that add up to whole vectors by chance must not shift the rows after them."""
    q = spark.createDataFrame([(1, [1.0, 0.0])], "query_id int, vector array<double>")
    ragged = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0]), (3, [1.0, 0.0, 5.0]), (4, [0.0, 1.0])], VECTORS)
    with pytest.raises(Exception, match="vector of [23] has [13] numbers, not 2"):
        topk.cosine_topk(ragged.coalesce(1), q, 3).collect()
    holes = spark.createDataFrame([(1, [1.0, None])], VECTORS)
    with pytest.raises(Exception, match="vector of 1 holds a missing number"):
        topk.cosine_topk(holes, q, 3).collect()


def test_repeated_chunks_and_missing_texts(spark, tmp_path):
    rows = [(1, "first", "c", 5, "2024-01-01"), (1, "second", "c", 4, "2024-02-01"), (2, None, "c", 3, "2024-01-01")]
    base = str(tmp_path)
    r.index_reviews(spark, base, reviews(spark, rows), lambda: r.hashing_embedder(16))
    stored = r.vector_store(spark, base).read().collect()
    assert [(x.chunk_id, x.text) for x in stored] == [("1", "second")]


def test_cosine_column(spark):
    df = spark.createDataFrame([([1.0, 2.0], [2.0, 4.0]), ([0.0, 0.0], [1.0, 1.0]), ([1.0, 0.0], [0.0, 3.0])],
                               "a array<float>, b array<float>")
    assert [x[0] for x in df.select(F.round(cosine("a", "b"), 9)).collect()] == [1.0, 0.0, 0.0]


REVIEWS = "review_id bigint, comment string, city string, rating bigint, review_date string"


def reviews(spark, rows):
    return spark.createDataFrame(rows, REVIEWS)


def test_cached_texts_are_not_embedded_again(spark, tmp_path):
    marks = tmp_path / "calls"
    marks.mkdir()

    def counting():
        embed = r.hashing_embedder(16)

        def call(texts):
            for t in texts:
                with open(marks / f"{abs(hash(t))}", "a") as f:
                    f.write("x")
            return embed(texts)

        return call

    def calls():
        return sum(len(p.read_text()) for p in marks.iterdir())

    cache = LayerTable(spark, str(tmp_path / "cache"), r.CACHE)
    first = reviews(spark, [(i, "same text", "c", 5, "2024-01-01") for i in range(50)] + [(99, "other", None, None, None)])
    pieces = r.chunks(r.documents(first, sample_size=None))
    embedded = r.embed_with_cache(pieces, cache, counting)
    assert embedded.count() == 51 and calls() == 2  # copies in one batch count once
    again = r.embed_with_cache(pieces, LayerTable(spark, str(tmp_path / "cache"), r.CACHE), counting)
    assert again.count() == 51 and calls() == 2  # a new session finds the stored cache
    vectors = {tuple(x.vector) for x in again.filter("text = 'same text'").collect()}
    assert len(vectors) == 1


def test_index_retrieve_and_context(spark, tmp_path):
    rows = [
        (1, "cold pizza late driver", "Pune", 1, "2024-01-01"), (2, "lovely fresh salad", "Delhi", 5, "2024-01-02"),
        (3, "pizza pizza pizza", None, None, None), (4, "cold pizza late driver", "Agra", 2, "2024-01-03"),
    ]
    store = r.index_reviews(spark, str(tmp_path), reviews(spark, rows), lambda: r.hashing_embedder(64))
    assert store.read().count() == 4
    hits = r.retrieve(spark, store.read(), ["cold pizza late driver", "fresh salad"], lambda: r.hashing_embedder(64), k=2)
    got = {x.query_id: x for x in r.context(hits).collect()}
    assert got[0].context == " (Pune, 1 stars) cold pizza late driver\n (Agra, 2 stars) cold pizza late driver"
    assert got[1].context.startswith(" (Delhi, 5 stars) lovely fresh salad\n") and got[1].n_sources == 2
    changed = [(2, "soggy salad", "Delhi", 2, "2024-02-02"), (5, "new", None, 3, None)]
    r.index_reviews(spark, str(tmp_path), reviews(spark, changed), lambda: r.hashing_embedder(64))
    stored = {x.chunk_id: x.text for x in r.vector_store(spark, str(tmp_path)).read().collect()}
    assert len(stored) == 5 and stored["2"] == "soggy salad"
    unknown = r.context(r.retrieve(spark, r.vector_store(spark, str(tmp_path)).read(), ["new"],
                                   lambda: r.hashing_embedder(64), k=1)).first()
    assert unknown.context == " (None, 3 stars) new"


def test_last_write_wins_within_and_across_batches(spark):
    df = spark.createDataFrame(
        [("a", 0, 0, "1"), ("a", 1, 0, "2"), ("a", 1, 5, "3"), ("b", 0, 9, "4")],
        "chunk_id string, batch int, position int, text string",
    )
    assert {(x.chunk_id, x.text) for x in r.last_write_wins(df).collect()} == {("a", "3"), ("b", "4")}


def test_sampled_documents(spark):
    rows = [(i, f"text {i}", "c", 5, "2024-01-01") for i in range(30)]
    docs = r.documents(reviews(spark, rows), sample_size=10)
    assert docs.count() == 10
    assert docs.first().metadata == {"city": "c", "rating": "5", "review_date": "2024-01-01"}


def test_retrieval_over_all_texts_against_brute_force(spark, sf_dir):
    from tiffin.plans import trade, workload

    texts = {x.review_id: x.comment for x in trade.reviews_typed(spark, sf_dir).collect()}
    embed = r.letter_embedder()
    got = {x.query_id: x for x in workload.review_retrieval(spark, sf_dir).collect()}
    for q, question in enumerate(["license and permission", "who is it for"]):
        scores = {}
        a = np.asarray(embed([question])[0], "float64")
        for i, text in texts.items():
            b = np.asarray(embed([text])[0], "float64")
            length = np.linalg.norm(a) * np.linalg.norm(b)
            scores[str(i)] = round(float(a @ b / length), 9) if length else 0.0
        best = sorted(scores, key=lambda i: (-scores[i], i))[:5]
        assert got[q].n_sources == 5
        position = -1
        for i in best:  # in this order, each whole text
            position = got[q].context.index(texts[int(i)], position + 1)


def test_items_are_placed_once(spark):
    """The cells of an index are found when it is built, not again by every search."""
    store = spark.range(60).select(F.col("id").alias("chunk_id"), F.array(F.sin("id"), F.cos("id")).alias("vector"))
    index = ivf.build_index(store, cells=4)
    assert "ArrowEvalPython" not in index.items._jdf.queryExecution().executedPlan().toString()
    assert index.items.count() == 60
