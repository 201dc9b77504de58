from __future__ import annotations

import random
import struct
import zlib

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tiffin.llm import packing
from tiffin.llm.encoding import tokenizer_path
from tiffin.llm.packing import best_fit, pack, pieces_of

PATH = tokenizer_path("byte_bpe_50k.json")


def brute_pieces(text, capacity):
    ids = Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [2]
    first = len(ids) % capacity or capacity
    cuts = [0, *range(first, len(ids) + 1, capacity)]
    return [
        (p, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))) for p, (a, b) in enumerate(zip(cuts, cuts[1:]))
    ]


def check_sequences(rows, capacity):
    """Offsets run without gaps, no sequence is too long; the number of sequences."""
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


@pytest.mark.parametrize("capacity", [16, 1024])
def test_edge_rows(edge_docs, capacity):
    rows = edge_docs.select("doc_id", "text").collect()
    want = sorted(((r["doc_id"], *p) for r in rows for p in brute_pieces(r["text"], capacity)), key=repr)
    got = pack(edge_docs, PATH, capacity=capacity).collect()
    assert sorted(((r[0], r[1], r[2], r[3], r[4]) for r in got), key=repr) == want
    check_sequences(got, capacity)


def test_levels_of_the_tree(spark):
    """Many small tasks: their underfull bins meet over several levels."""
    rng = random.Random(5)
    docs = spark.createDataFrame(
        [(i, "word " * rng.randrange(1, 40)) for i in range(3000)], "doc_id long, text string"
    ).repartition(300)
    got = pack(docs, PATH, capacity=64).collect()
    sequences = check_sequences(got, 64)
    total = sum(r["length"] for r in got)
    assert len(got) == 3000
    assert sequences <= 1.05 * -(-total // 64)


def unlike_lengths(spark, tasks):
    """3000 documents of 600 tokens, then 3000 of 400: only together they fill 3000 sequences."""
    words = F.when(F.col("id") < 3000, 599).otherwise(399).cast("int")
    return spark.range(0, 6000, numPartitions=tasks).select(
        F.col("id").alias("doc_id"), F.trim(F.repeat(F.lit("word "), words)).alias("text")
    )


def test_tasks_of_unlike_lengths(spark):
    """Bins of both tasks meet, thousands each: within 0.5 % of best fit over all, in one group equal to it."""
    for options, most in (({}, 3015), ({"group_pieces": 6_000}, 3000)):
        got = pack(unlike_lengths(spark, 2), PATH, **options).collect()
        assert {r["length"] for r in got} == {400, 600}
        assert sorted(r["doc_id"] for r in got) == list(range(6000))
        assert check_sequences(got, 1024) <= most


def test_blocks_of_one_task_meet(spark, monkeypatch):
    """Each flush of a task is a block of its own; its underfull bins meet those of the others."""
    monkeypatch.setattr(packing, "BLOCK_PIECES", 1000)
    got = pack(unlike_lengths(spark, 1), PATH).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(6000))
    assert check_sequences(got, 1024) <= 3015


def test_empty_table(no_docs):
    assert pack(no_docs, PATH).count() == 0


def first_sizes(rng, n):
    return [rng.randrange(1, 101) for _ in range(n)]


@pytest.mark.parametrize("n", [0, 1, 10, 500])
def test_best_fit_equals_the_plain_search(n):
    sizes = first_sizes(random.Random(n), n)
    rooms = []
    for s in sorted(sizes, reverse=True):
        fitting = [r for r in rooms if r >= s]
        if fitting:
            rooms[rooms.index(min(fitting))] -= s
        else:
            rooms.append(100 - s)
    bins = best_fit(sizes, 100)
    assert sorted(100 - sum(sizes[i] for i in b) for b in bins) == sorted(rooms)
    assert sorted(i for b in bins for i in b) == list(range(n))


def test_pieces_of_exact_multiples():
    ids = b"\x01\0\0\0" * 32
    assert [(p[2], p[3]) for p in pieces_of(1, ids, 16)] == [(0, 16), (16, 16)]
    assert [(p[2], p[3]) for p in pieces_of(1, ids[:68], 16)] == [(0, 1), (1, 16)]
