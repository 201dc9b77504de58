"""Retrieval over reviews: documents, chunks, cached embeddings, context."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.functions.text import content_hash
from tiffin.operators.latest import fixed_sample, latest_per_key
from tiffin.operators.topk import cosine_topk
from tiffin.operators.windows import Windows, text_windows
from tiffin.sources.tables import LayerTable

CHUNKS = "chunk_id string, doc_id string, text string, metadata map<string,string>, vector array<float>"
CACHE = "content_hash string, vector array<float>"
SAMPLE_SIZE = None  # all reviews; a sample only where a caller asks for one
TOP_K = 5
TEXTS_PER_CALL = 256

# Takes texts, returns one vector per text.
Embedder = Callable[[Sequence[str]], Sequence[Sequence[float]]]


def documents(reviews: DataFrame, sample_size: int | None = SAMPLE_SIZE, seed: int = 0) -> DataFrame:
    """Reviews as documents with the metadata needed to cite them."""
    rows = reviews if sample_size is None else fixed_sample(reviews, "review_id", sample_size, seed)
    return rows.select(
        F.col("review_id").cast("string").alias("doc_id"),
        F.col("comment").alias("text"),
        F.create_map(
            F.lit("city"), F.col("city"),
            F.lit("rating"), F.col("rating").cast("string"),
            F.lit("review_date"), F.col("review_date").cast("string"),
        ).alias("metadata"),
    )


def chunks(docs: DataFrame, windows: Windows | None = None) -> DataFrame:
    """One chunk per document, as reviews are short, or one per window: ``<doc_id>#<number>``, with the offsets of
    its characters in the metadata. A document without text has nothing to find and no chunk."""
    if windows is None:
        return docs.filter("text is not null").select(F.col("doc_id").alias("chunk_id"), "doc_id", "text", "metadata")
    span = F.concat_ws("-", "window_start", "window_end")
    return text_windows(docs, "text", windows).select(
        F.concat_ws("#", "doc_id", "window_no").alias("chunk_id"),
        "doc_id",
        F.col("window_text").alias("text"),
        F.map_concat(F.coalesce("metadata", F.create_map().cast("map<string,string>")), F.create_map(F.lit("chars"), span)).alias("metadata"),
    )


def unseen_texts(pieces: DataFrame, cache: DataFrame) -> DataFrame:
    """Each text whose hash is not cached, once: content_hash, text. The hashes
    ask the cache alone; only the texts that it lacks are brought together."""
    hashed = pieces.filter("text is not null").select(content_hash("text").alias("content_hash"), "text")
    missing = hashed.select("content_hash").distinct().join(cache.select("content_hash"), "content_hash", "left_anti")
    return hashed.join(missing, "content_hash", "left_semi").groupBy("content_hash").agg(F.first("text").alias("text"))


def embed_texts(texts: DataFrame, make_embedder: Callable[[], Embedder], parallelism: int | None = None) -> DataFrame:
    if parallelism:
        texts = texts.repartition(parallelism)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        embed = make_embedder()
        for frame in frames:
            values = frame["text"].tolist()
            vectors = [v for i in range(0, len(values), TEXTS_PER_CALL) for v in embed(values[i : i + TEXTS_PER_CALL])]
            if len(vectors) != len(values):
                raise ValueError("the embedder must return one vector per text")
            yield pd.DataFrame(
                {"content_hash": frame["content_hash"], "vector": [np.asarray(v, dtype="float32") for v in vectors]}
            )

    return texts.select("content_hash", "text").mapInPandas(run, CACHE)


def embed_with_cache(
    pieces: DataFrame, cache: LayerTable, make_embedder: Callable[[], Embedder], parallelism: int | None = None
) -> DataFrame:
    """Chunks with vectors. Only texts new to the cache are embedded, each once;
    the new vectors are stored before they are used."""
    new = embed_texts(unseen_texts(pieces, cache.read()), make_embedder, parallelism)
    cache.append(new)
    hashed = pieces.withColumn("content_hash", content_hash("text"))
    return hashed.join(cache.read(), "content_hash").select("chunk_id", "doc_id", "text", "metadata", "vector")


def last_write_wins(batches: DataFrame, key: str = "chunk_id", order: Sequence[str] = ("batch", "position")):
    """The newest row per key over several batches, also within one batch."""
    newest = latest_per_key(batches, [key], [F.desc(c) for c in order])
    return newest.drop(*order)


def vector_store(spark: SparkSession, warehouse: str) -> LayerTable:
    return LayerTable(spark, f"{warehouse}/ai/vector_store", CHUNKS)


def embedding_cache(spark: SparkSession, warehouse: str) -> LayerTable:
    return LayerTable(spark, f"{warehouse}/ai/embedding_cache", CACHE)


def index_reviews(
    spark: SparkSession,
    warehouse: str,
    reviews: DataFrame,
    make_embedder: Callable[[], Embedder],
    sample_size: int | None = SAMPLE_SIZE,
    parallelism: int | None = None,
    windows: Windows | None = None,
) -> LayerTable:
    """Documents to vector store: prepare, chunk, embed, upsert by chunk."""
    pieces = chunks(documents(reviews, sample_size), windows)
    embedded = embed_with_cache(pieces, embedding_cache(spark, warehouse), make_embedder, parallelism)
    # Of a chunk that comes twice the newer review is kept.
    newest = latest_per_key(embedded, ["chunk_id"], [F.desc(F.col("metadata")["review_date"]), F.desc("text")])
    store = vector_store(spark, warehouse)
    store.upsert(newest, ["chunk_id"])
    return store


def retrieve(
    spark: SparkSession, store: DataFrame, questions: Sequence[str], make_embedder: Callable[[], Embedder],
    k: int = TOP_K,
) -> DataFrame:
    """The best chunks per question, with text and metadata."""
    if not questions:
        raise ValueError("no question")
    vectors = make_embedder()(list(questions))
    rows = [(i, q, [float(x) for x in v]) for i, (q, v) in enumerate(zip(questions, vectors, strict=True))]
    queries = spark.createDataFrame(rows, "query_id int, question string, vector array<double>")
    hits = cosine_topk(store, queries, k).join(queries.select("query_id", "question"), "query_id")
    return with_chunks(hits, store)


def with_chunks(hits: DataFrame, store: DataFrame) -> DataFrame:
    """Text and metadata of the hits; adaptive execution sends few hits to the
    store's tasks, so that its texts are not shuffled."""
    return store.drop("vector").join(hits, "chunk_id")


def context(hits: DataFrame, query_id: str = "query_id") -> DataFrame:
    """One text per query: a line per retrieved chunk, best first, with the characters of its document that a window
    holds. A list has at most k lines."""
    shown = lambda key: F.coalesce(F.element_at("metadata", key), F.lit("None"))
    span = F.element_at("metadata", "chars")
    chars = F.when(span.isNull(), F.lit("")).otherwise(F.concat(F.lit(", characters "), span))
    line = F.concat(F.lit(" ("), shown("city"), F.lit(", "), shown("rating"), F.lit(" stars"), chars, F.lit(") "), F.col("text"))
    lines = F.sort_array(F.collect_list(F.struct("rank", line.alias("line"))))
    return hits.groupBy(query_id).agg(
        F.count("*").alias("n_sources"), F.array_join(F.transform(lines, lambda x: x["line"]), "\n").alias("context")
    )


def hashing_embedder(size: int = 64) -> Embedder:
    """Word counts hashed into ``size`` signed slots: an embedder that needs no
    outside service."""

    def embed(texts: Sequence[str]) -> list[np.ndarray]:
        out = []
        for text in texts:
            v = np.zeros(size, dtype="float32")
            for word in re.findall(r"\w+", text.lower()):
                h = zlib.crc32(word.encode("utf-8"))
                v[h % size] += 1 if h & 0x80000000 else -1
            out.append(v)
        return out

    return embed


def letter_embedder() -> Embedder:
    """How often each of the letters a to z occurs, in either case: vectors that
    SQL can state as well."""

    def embed(texts: Sequence[str]) -> list[np.ndarray]:
        letters = "abcdefghijklmnopqrstuvwxyz"
        return [np.array([t.count(c) + t.count(c.upper()) for c in letters], dtype="float32") for t in texts]

    return embed
