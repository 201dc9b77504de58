from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tiffin.llm import near_dedup
from tiffin.llm.near_dedup import components, match_threshold, near_duplicates, without_near_duplicates


def shingles(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset([tuple(words)] if len(words) < k else [tuple(words[i : i + k]) for i in range(len(words) - k + 1)])


def brute(rows, k, percent):
    """(doc_id, n_shingles, component_id, kept) of each row, by comparing all pairs."""
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    ids = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            ids[find(i)] = min(ids.get(find(i), doc_id), doc_id)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        comp = ids.get(find(i)) if sets[i] else doc_id
        out.append((doc_id, len(sets[i]), comp, doc_id == comp))
    return Counter(out)


def answer(docs, k, percent):
    got = near_duplicates(docs, words=k, percent=percent)
    return Counter(tuple(r) for r in got.select("doc_id", "n_shingles", "component_id", "kept").collect())


@pytest.mark.parametrize(("k", "percent"), [(3, 85), (5, 80), (1, 50)])
def test_edge_rows(edge_docs, k, percent):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.select("doc_id", "text").collect()]
    assert answer(edge_docs, k, percent) == brute(rows, k, percent)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return words


def test_near_copies_chains_and_shared_passages(spark):
    """A large group whose members are not all linked to one another, chains, and a passage in many texts."""
    rng = random.Random(3)
    passage = [f"p{i}" for i in range(30)]
    texts = []
    base = [f"b{i}" for i in range(150)]
    texts += [edited(rng, base, rng.randrange(1, 5)) for _ in range(120)]
    chain = [f"c{i}" for i in range(120)]
    for _ in range(25):
        chain = edited(rng, chain, 2)
        texts.append(chain)
    texts += [passage + [f"u{i}_{j}" for j in range(rng.randrange(5, 60))] for i in range(120)]
    texts += [texts[0]] * 60
    rows = list(enumerate(" ".join(t) for t in texts))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert answer(docs, 3, 85) == brute(rows, 3, 85)
    assert answer(docs, 5, 80) == brute(rows, 5, 80)


def test_empty_table(no_docs):
    assert near_duplicates(no_docs).count() == 0
    assert without_near_duplicates(no_docs).columns == no_docs.columns


def test_one_document_of_each_group_stays(edge_docs):
    kept = [r["doc_id"] for r in without_near_duplicates(edge_docs).select("doc_id").collect()]
    assert 1 in kept and 2 not in kept and 7 in kept and 8 not in kept and 10 in kept and 11 not in kept


def test_components_of_a_long_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 400)] + [(70, 70)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r["node"]: r["root"] for r in components(df).collect()}
    assert {n: r for n, r in got.items() if n <= 60} == dict.fromkeys(range(61), 0)
    assert {n: r for n, r in got.items() if n >= 100} == dict.fromkeys(range(100, 400), 100)


def test_threshold_leaves_room():
    assert match_threshold(85) == 40 and match_threshold(100) == near_dedup.COORDINATES


def test_a_third_of_all_rows_are_copies(spark):
    docs = spark.range(900).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("the same few words in a row"))
        .otherwise(F.concat_ws(" ", F.lit("other"), F.col("id"), F.col("id") + 1, F.col("id") + 2, F.col("id") * 7))
        .alias("text"),
    )
    got = near_duplicates(docs)
    assert got.filter("kept").count() == 601
    assert got.filter("component_id = 0").count() == 300


def test_one_row_of_a_group_stays(spark):
    """Near copies without ids, near copies under one id, and rows alike in id and text."""
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(None, text), (None, text + " a"), (None, text + " b")]
    rows += [(5, text.upper().replace("WORD", "x") + end) for end in ("", " a")] + [(6, text.replace("word", "x"))]
    rows += [(9, text.replace("word", "y"))] * 3 + [(None, ""), (None, ""), (7, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = without_near_duplicates(docs).collect()
    assert sorted((r["doc_id"] for r in got if r["text"].strip()), key=str) == [5, 9, None]
    assert sum(not r["text"].strip() for r in got) == 3
