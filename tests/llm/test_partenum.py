from __future__ import annotations

import random

import numpy as np
import pytest
from test_near_dedup import brute as near_brute

from tiffin.llm import partenum
from tiffin.llm.partenum import band, bands_of, differences, jaccard_join, signatures


def brute(rows, words, percent):
    return sorted((r[:3] for r in near_brute(rows, words, percent).elements()), key=repr)


def test_similar_sizes_share_a_band():
    for percent in (50, 80, 95):
        for low in [*range(1, 400), 5_000, 77_777]:
            high = low * 100 // percent
            assert {b.number for b in bands_of(low, percent)} & {b.number for b in bands_of(high, percent)}
            for b in bands_of(low, percent):
                assert b.low <= low <= b.high
                assert b.groups * (b.broken + 1) > b.differences and b.parts > b.broken


@pytest.mark.parametrize("percent", [60, 80, 90])
def test_similar_sets_share_a_signature(percent):
    rng = np.random.default_rng(percent)
    for _ in range(1500):
        n = int(rng.integers(1, 400) if rng.random() < 0.7 else rng.integers(1, 20))
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        size = int(rng.integers(len(a) * percent // 100, len(a) * 100 // percent + 1))
        lost = rng.integers(0, differences(len(a), max(size, 1), percent) + 1)
        kept = rng.permutation(a)[: len(a) - lost]
        b = np.unique(np.r_[kept, rng.integers(0, 1 << 63, max(0, size - len(kept)), dtype=np.uint64) * np.uint64(2)])
        both = len(np.intersect1d(a, b))
        if both and 100 * both >= percent * (len(a) + len(b) - both) and not np.array_equal(a, b):
            assert set(signatures(a, percent).tolist()) & set(signatures(b, percent).tolist())


def test_sets_with_elements_in_few_partitions():
    """All elements in one range of hashes: the empty subsets are signatures too."""
    a = np.arange(40, dtype=np.uint64)
    b = np.r_[a[4:], np.uint64(1) << np.uint64(63)]
    assert set(signatures(a, 80).tolist()) & set(signatures(b, 80).tolist())
    assert len(signatures(np.zeros(0, np.uint64), 80)) == 0
    assert band(0, 80).differences == 0


@pytest.mark.parametrize("words, percent", [(5, 80), (3, 60)])
def test_edge_rows(edge_docs, words, percent):
    rows = [tuple(r) for r in edge_docs.select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in jaccard_join(edge_docs, words, percent).collect()), key=repr)
    assert got == brute(rows, words, percent)


def test_near_copies_and_crowds(spark, monkeypatch):
    """Chains of changes, groups of copies, and a passage that many otherwise different texts share."""
    monkeypatch.setattr(partenum, "BLOCK_MEMBERS", 5)
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    passage, rows = [word() for _ in range(40)], []
    for i in range(60):
        rows.append((i, " ".join(passage + [word() for _ in range(rng.choice([2, 5, 9, 30]))])))
    for g in range(12):
        text = [word() for _ in range(rng.choice([6, 30, 120, 700]))]
        for _ in range(8):
            text = list(text)
            for _ in range(max(1, len(text) // 90)):
                text[rng.randrange(len(text))] = word()
            rows += [(len(rows), " ".join(text)), (len(rows) + 1, " ".join(text))]
    got = sorted((tuple(r) for r in jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    assert got == brute(rows, 5, 80)


def test_empty_table(no_docs):
    assert jaccard_join(no_docs).count() == 0
