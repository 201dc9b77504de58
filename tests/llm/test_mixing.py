from __future__ import annotations

import hashlib
import re

import pytest

from tiffin.llm.mixing import mix, mixed_documents, source_targets


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def fill(sizes, weights=(1, 2, 3), times=3):
    """Share by weight, cap, share the excess anew, until no source is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(times * sizes[s] for s in capped)
        open_ = [s for s in names if s not in capped]
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        above = {s for s in open_ if share[s] > times * sizes[s]}
        if not above:
            return {s: share.get(s, times * sizes[s]) for s in names}
        capped |= above


def test_targets_equal_repeated_sharing(spark):
    for sizes in (
        {"a": 100, "b": 5, "c": 7, "d": 1000, "e": 1, None: 30},
        {"a": 1, "b": 1},
        {"a": 0, "b": 10, None: 0},
        {"x": 50},
    ):
        df = spark.createDataFrame(
            [(s is None, s or "", n) for s, n in sizes.items()], "no_source boolean, source_key string, source_size long"
        )
        got = {None if r["no_source"] else r["source_key"]: r["target"] for r in source_targets(df).collect()}
        want = fill(sizes)
        assert got.keys() == want.keys()
        for s in want:
            assert got[s] == pytest.approx(want[s], rel=1e-12), (sizes, s)


def test_edge_rows(edge_docs):
    rows = edge_docs.select("doc_id", "text", "source").collect()
    sizes = {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + size_of(r["text"])
    targets = fill(sizes)
    want = []
    for source, total in sizes.items():
        budget = min(round(targets[source]), 3 * total)
        own = [(r["doc_id"], size_of(r["text"])) for r in rows if r["source"] == source]
        draw = lambda i: hashlib.md5(("mix-1" + ("" if i is None else f"|{i}")).encode()).hexdigest()
        at = 0
        for doc_id, size in sorted(own, key=lambda o: (draw(o[0]), o[0] or 0, o[1])):
            rest = budget % total if total else 0
            taken = (budget // total if total else 0) * size + max(0, min(size, rest - at))
            at += size
            want.append((doc_id, source, size, total, taken))
    got = mix(edge_docs).collect()
    key = lambda r: tuple((v is None, v or 0) if not isinstance(v, str) else (False, v) for v in r)
    assert sorted(((r["doc_id"], r["source"], r["size"], r["source_size"], r["taken"]) for r in got), key=key) == sorted(
        want, key=key
    )
    for r in got:
        assert r["target"] == pytest.approx(targets[r["source"]])
        assert r["taken"] <= 3 * r["size"]


def test_reruns_agree_whatever_the_partitions(edge_docs):
    def run(df):
        return sorted(map(repr, mix(df).collect()))

    assert run(edge_docs) == run(edge_docs.coalesce(1))


def test_empty_table(no_docs):
    assert mix(no_docs).count() == 0
    assert mixed_documents(no_docs).count() == 0


def test_documents_come_as_often_as_they_are_taken(edge_docs):
    plan = {(r["doc_id"], r["source"], r["size"]): -(-r["taken"] // r["size"]) for r in mix(edge_docs).collect() if r["size"]}
    out = mixed_documents(edge_docs)
    assert out.columns == edge_docs.columns
    found = {}
    for r in out.select("doc_id", "source", "text").collect():
        k = (r["doc_id"], r["source"], size_of(r["text"]))
        found[k] = found.get(k, 0) + 1
    # Document 8 stands there twice with the same text.
    repeated = (8, None, size_of("lorem ipsum dolor sit amet " * 4000))
    assert {k: n for k, n in found.items() if k != repeated} == {k: n for k, n in plan.items() if n and k != repeated}
