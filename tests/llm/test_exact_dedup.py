from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tiffin.llm.exact_dedup import CountingQuotientFilter, exact_duplicates, without_exact_duplicates


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", "", text or "")


def brute(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(normal(text), []).append((-len(text or ""), doc_id is None, doc_id))
    out = Counter()
    for doc_id, text in rows:
        group = groups[normal(text)]
        best = min(group, key=lambda g: (g[0], g[1], g[2] or 0))
        own = (-len(text or ""), doc_id is None, doc_id)
        digest = hashlib.sha256(normal(text).encode()).hexdigest()
        out[doc_id, best[2], len(group), own == best, digest] += 1
    return out


def test_edge_rows(edge_docs):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.select("doc_id", "text").collect()]
    got = exact_duplicates(edge_docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert Counter(tuple(r) for r in got) == brute(rows)


def test_empty_table(no_docs):
    assert exact_duplicates(no_docs).count() == 0
    assert without_exact_duplicates(no_docs).count() == 0


def test_one_row_of_each_group_stays(edge_docs):
    kept = without_exact_duplicates(edge_docs)
    assert kept.columns == edge_docs.columns
    texts = [normal(r["text"]) for r in kept.select("text").collect()]
    assert len(texts) == len(set(texts))
    assert set(texts) == {normal(r["text"]) for r in edge_docs.select("text").collect()}


def test_a_third_of_all_rows_are_copies(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same text").otherwise(F.col("id").cast("string")).alias("text")
    )
    got = exact_duplicates(docs)
    assert got.filter("kept").count() == 2001
    assert got.filter("group_size = 1000 and keep_id = 0").count() == 1000


@pytest.mark.parametrize("n", [0, 1, 5, 4000])
def test_filter_is_lossless(n):
    rng = np.random.default_rng(n)
    values = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)
    values = np.concatenate([values, values[: n // 3], values[: n // 7]])
    parts = np.array_split(values, 4)
    rows = [CountingQuotientFilter.build(p).to_row() for p in parts]
    found, counts = CountingQuotientFilter.merge([CountingQuotientFilter.from_row(*r) for r in rows]).items()
    assert dict(zip(found.tolist(), counts.tolist(), strict=True)) == Counter(values.tolist())
    assert (np.diff(found.astype(object)) > 0).all() if n > 1 else True
