from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tiffin.llm import prefix_trie as trie
from tiffin.llm.prefix_trie import prefix_trie

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
DDL = "conv_id long, turn long, role string, text string, i int, lcp int, node string, block string"


def brute(rows):
    """Nodes from a dictionary of all prefixes."""
    given = defaultdict(list)
    for conv_id, turn, role, text in rows:
        role, text = role or "", text or ""
        digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
        if conv_id is not None:
            given[conv_id].append((turn is not None, turn or 0, digest[:32], role, text))
    turns = {c: [t[3:] for t in sorted(g)] for c, g in given.items()}
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 6
        whole = turns.get(c - int(np.fmod(c, 100)), [])[:h] + turns[c][h:]
        for d in range(len(whole) + 1):
            members[tuple(whole[:d])].append(c)
            if d:
                children[tuple(whole[: d - 1])].add(tuple(whole[:d]))
        ends[tuple(whole)].append(c)
    leaves, saved = {}, {}
    for key in sorted(members, key=len, reverse=True):
        below = children[key]
        leaves[key] = sum(leaves[k] for k in below) if below else 1
        saved[key] = (len(members[key]) - 1) * len(key[-1][1] if key else "") + sum(saved[k] for k in below)
    return sorted(
        (
            (min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(children[k]), leaves[k], saved[k],
             hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest())
            for k, m in members.items()
        ),
        key=repr,
    )


def check(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, 2, "clash", "clash") for r in rows], DDL).repartition(7)
    got = sorted((tuple(r[c] for c in COLUMNS) for r in prefix_trie(df, **options).collect()), key=repr)
    assert got == brute(rows)


def test_small_tables_over_small_blocks(spark):
    """Copies, shared beginnings of all depths and several levels of sparse tables."""
    rng = random.Random(4)
    rows = []
    for c in range(60):
        for t in range(rng.randrange(0, 9)):
            rows.append((c if c < 30 else 100 * c, t, "user", rng.choice(["a", "b", "bb"])))
    long = [(7_000_000 + c, t, "user", "x" * (1 + t % 3) if t < 40 - c else f"{c}") for c in range(3) for t in range(45)]
    check(spark, rows + long + [(c + 1_000_000_000, t, r, x) for c, t, r, x in rows if c < 20], block=4, chunk_turns=2)


def test_edge_rows(spark):
    rows = [
        (1, None, "user", "first"), (1, 0, None, None), (1, 0, "", ""), (1, 0, "user", "tie"), (1, 0, "user", "tie"),
        (2, 3, "us", "er"), (2, 4, "u", "ser"), (None, 0, "user", "left out"), (-150, 1, "a", "b"), (-100, 1, "a", "c"),
        (500, 0, "user", "y" * 100_000), (501, 0, "user", "y" * 100_000), (502, 0, "user", "é😀"), (600, 1, "a", "b"),
    ]
    check(spark, rows)


def test_empty_table(spark):
    assert prefix_trie(spark.createDataFrame([], DDL)).count() == 0


def test_given_conversations(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    got = sorted((tuple(r[c] for c in COLUMNS) for r in prefix_trie(df).collect()), key=repr)
    assert got == brute([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


@pytest.mark.parametrize("seed", range(20))
def test_binary_search_on_range_minima(seed):
    rng = random.Random(seed)
    n = rng.randrange(1, 40)
    value = [rng.randrange(-1, 5) for _ in range(n)]
    least = [rng.randrange(100) for _ in range(n)]
    entries = [{"i": 8 + j, "lcp": v, "least": m, "weight": j + 1} for j, (v, m) in enumerate(zip(value, least))]
    asked = [(rng.randrange(n), rng.randrange(0, 5), rng.random() < 0.5) for _ in range(30)]
    queries = pa.table(
        {"i": [8 + a for a, _, _ in asked], "depth": [d for _, d, _ in asked], "to_right": [r for _, _, r in asked],
         "block": [0] * 30, "place": [8 + a for a, _, _ in asked], "least": [1000] * 30, "weight": [0] * 30}
    )
    for (a, d, right), row in zip(asked, trie._search(queries, pa.table({"entries": [entries]})).to_pylist()):
        span = range(a + 1, n) if right else range(a - 1, -1, -1)
        hit = next((j for j in span if value[j] < d), None)
        assert row["found"] == (hit is not None)
        if hit is not None:
            assert row["entry"] == hit + 8
        if right:
            passed = range(a + 1, n if hit is None else hit)
            assert row["least"] == min([least[j] for j in passed], default=1000)
            assert row["weight"] == sum(j + 1 for j in passed)
