from __future__ import annotations

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tiffin.llm import quality
from tiffin.llm.quality import chunk_sample, classify, learn_from


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = classify(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert np.mean([r["predicted"] for r in held if r["quality"] == 1]) > 0.98
    assert np.mean([r["predicted"] for r in held if r["quality"] == 0]) < 0.1
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)


def test_held_out_labels_are_not_seen(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = learn_from(docs, labels), learn_from(docs, turned)
    assert a.good == b.good and a.bad == b.bad and np.array_equal(a.weights, b.weights)


def test_edge_rows(spark, edge_docs, no_docs):
    labels = spark.createDataFrame(
        [(1, 1, 0), (2, 1, 0), (3, 1, 1), (7, 0, 0), (8, 0, 0), (12, 0, 1), (12, 1, 1), (None, 0, 0), (99, 1, 0), (5, None, 0)],
        "doc_id long, quality int, toxic int",
    )
    got = classify(edge_docs, labels).collect()
    assert len(got) == edge_docs.count()
    assert all(0 <= r["score"] <= 1 for r in got)
    blank = {r["score"] for r in got if r["doc_id"] in (4, 5)}
    assert len(blank) == 1  # a missing text is an empty one
    assert classify(no_docs, labels).count() == 0
    assert {r["score"] for r in classify(edge_docs, labels.limit(0)).collect()} == {0.5}
    one_label = labels.filter("quality = 1")
    assert all(r["predicted"] == 1 for r in classify(edge_docs, one_label).collect())


def test_scores_by_hand(spark):
    """Features, calibration and scores computed again, text by text, from the model's dictionaries."""
    import zstandard

    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = learn_from(docs, labels)

    def size(data, dictionary):
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        c = zstandard.ZstdCompressor(
            level=3, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False
        )
        return len(c.compress(data))

    got = {r["doc_id"]: r["score"] for r in classify(docs, labels).collect()}
    for r in docs.limit(40).collect():
        data = (r["text"] or "").encode()
        good, bad = (
            sum(size(data[i : i + 1024], d) for i in range(0, len(data), 1024)) for d in (model.good, model.bad)
        )
        rate = min(1.0, sum(size(data[i : i + 8192], None) for i in range(0, len(data), 8192)) / len(data)) if data else 1
        x = (np.array([(bad - good) / max(bad, good, 1), rate, rate * rate]) - model.mean) / model.spread
        assert abs(got[r["doc_id"]] - 1 / (1 + np.exp(-(model.weights[0] + x @ model.weights[1:])))) < 1e-9


def test_labels_with_long_texts_only(spark, tmp_path):
    """Long texts are learned from; a label without any text makes the pipeline keep everything."""
    rng = random.Random(3)
    word = lambda letters: "".join(rng.choices(letters, k=rng.randrange(3, 9)))
    words = [[word(letters) for _ in range(400)] for letters in ("qwxyzkjv", "etaoinsr")]
    rows = [(i, " ".join(rng.choices(words[i % 2], k=9000))) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(80)], "doc_id long, quality int, toxic int")
    assert all(r["predicted"] == r["doc_id"] % 2 for r in classify(docs, labels).collect())
    labels.filter("quality = 0").write.parquet(str(tmp_path / "labels.parquet"))
    assert not learn_from(docs, labels.filter("quality = 0")).learned
    assert corpus_pipeline.keep_good(spark, docs, str(tmp_path)).count() == 80


def test_chunks_come_from_the_whole_text():
    text = "".join(f"{i:08d}" for i in range(100_000))
    found = chunk_sample(text)
    assert len(found) == quality.SAMPLE_CHUNKS * quality.CHUNK_BYTES and found[-8:] > "00050000"
    assert chunk_sample("short") == "short"
