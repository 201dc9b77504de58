"""Every stage of the corpus pipeline on the smallest tables, against what its operator says."""

from __future__ import annotations

import re

import pytest

import corpus_pipeline
from test_near_dedup import brute as near_brute
from tiffin.llm.common import stored, table
from tiffin.llm.quality import learn_from


@pytest.fixture(scope="module")
def outputs(spark, sf_dir):
    docs, found = table(spark, sf_dir, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        found.append((docs, stored(stage(spark, docs, sf_dir), "test-stage")))
        docs = found[-1][1]
    return found


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_documents_keep_their_columns(outputs):
    for before, after in outputs[:4]:
        assert after.columns == before.columns


def test_quality_keeps_what_scores_enough(spark, sf_dir, outputs):
    before, after = outputs[0]
    model = learn_from(before, table(spark, sf_dir, "labels"))
    given = rows(before)
    scores = model.score([t or "" for _, t in given])
    assert sorted(rows(after)) == sorted(r for r, s in zip(given, scores, strict=True) if s >= 0.7)
    assert 0 < after.count() < before.count()


def test_exact_copies_go(outputs):
    before, after = (rows(x) for x in outputs[1])
    normal = lambda t: re.sub(r"[\x20\x09-\x0D]+", "", t)
    best = {}
    for doc_id, text in before:
        key = (-len(text), doc_id)
        best[normal(text)] = min(best.get(normal(text), key), key)
    assert sorted(i for i, _ in after) == sorted(k[1] for k in best.values())


def test_near_copies_go(outputs):
    before, after = (rows(x) for x in outputs[2])
    kept = sorted(doc_id for doc_id, _, _, keeps in near_brute(before, 5, 80) if keeps)
    assert sorted(i for i, _ in after) == kept


def test_mix_and_packing_hold_together(outputs):
    mixed = [i for i, _ in rows(outputs[3][1])]
    assert set(mixed) <= {i for i, _ in rows(outputs[3][0])}
    packed = outputs[4][1].collect()
    assert sorted(r["doc_id"] for r in packed if r["piece"] == 0) == sorted(mixed)
    spans = {}
    for r in packed:
        spans.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for s in spans.values():
        s.sort()
        assert s[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(s, s[1:], strict=False)) and sum(s[-1]) <= 1024


def test_without_labels_all_documents_stay(spark, sf_dir, tmp_path):
    table(spark, sf_dir, "labels").limit(0).write.parquet(str(tmp_path / "labels.parquet"))
    docs = table(spark, sf_dir, "documents").limit(20)
    assert corpus_pipeline.keep_good(spark, docs, str(tmp_path)).count() == 20
