from __future__ import annotations

import zlib

import numpy as np
import pytest

from tiffin.llm import language
from tiffin.llm.language import document_vectors, identify, letter_vectors


def brute_vector(text):
    letters = "".join(c if c.isalpha() else " " for c in f" {text.lower()} ")
    letters = " " + " ".join(letters.split()) + " "
    out = np.zeros(language.DIMENSIONS)
    if letters.strip():
        for i in range(len(letters) - 2):
            a, b, c = letter_vectors(np.array([0 if x == " " else ord(x) for x in letters[i : i + 3]]))
            out += np.roll(a, 2) * np.roll(b, 1) * c
    return out


@pytest.mark.parametrize("text", ["", " .,1 ", "a", "Hello, World!", "Straße\nÀ É 12 x", "語語 a語", "İI" * 7])
def test_vectors_bind_and_bundle(text):
    alone = document_vectors([text])[0]
    assert np.array_equal(alone, brute_vector(text))
    assert np.array_equal(document_vectors(["other words", text, ""])[1], alone)


def test_long_texts_are_read_whole(monkeypatch):
    text = "abcd efgh ijkl " * 50
    whole = document_vectors([text, "short"])
    monkeypatch.setattr(language, "SEGMENT_CHARS", 64)
    assert np.array_equal(document_vectors([text, "short"]), whole)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_edge_rows(edge_docs, no_docs):
    got = {r["doc_id"]: r for r in identify(edge_docs).collect()}
    assert identify(edge_docs).count() == edge_docs.count()
    for doc_id in (4, 5, 6, 14):
        assert (got[doc_id]["lang_pred"], got[doc_id]["score"]) == ("und", 0.0)
    assert got[1]["lang_pred"] in {"en", "fr", "de"}
    assert identify(no_docs).count() == 0


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some words", None)], "doc_id long, text string, lang string")
    assert [r["lang_pred"] for r in identify(docs).collect()] == ["und"]


def test_languages_with_long_texts_only(spark):
    rows = [(i, "the house and the garden with a tree " * 2000, "en") for i in range(6)]
    rows += [(i, "das haus und der garten mit einem baum " * 2000, "de") for i in range(6, 12)]
    got = identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert [r["lang_pred"] for r in sorted(got)] == ["en"] * 6 + ["de"] * 6


def test_the_sample_is_bounded(spark):
    """Of a language with many rows no more than the sample counts, of a rare one all do."""
    rows = [(i, "abc abd abe", "x") for i in range(3000)] + [(-1, "uvw uvx uvy", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language.learn(docs, docs_per_language=10)
    assert got.languages == ("x", "y")
