from __future__ import annotations

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tiffin.operators import retrieve
from tiffin.operators.windows import Windows, text_windows

SMALL = Windows(size=20, overlap=8, slack=6)


def brute(text, w):
    """Windows by the definition, from the whole text."""

    def snapped(planned):
        low = planned - w.slack
        ends = [m.end() for m in re.finditer(r"[.!?][ \t\r]|\n", text[low:planned])]
        return low + ends[-1] if ends else planned

    count = max(1, -(-(len(text) - w.overlap) // w.step))
    out = []
    for k in range(count):
        a, b = k * w.step, k * w.step + w.size
        a, b = snapped(a) if k else 0, len(text) if b >= len(text) else snapped(b)
        out.append((k, a, b, text[a:b]))
    return out


def windows_of(spark, texts, w):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {}
    for r in text_windows(df, "text", w).collect():
        got.setdefault(r.doc_id, []).append((r.window_no, r.window_start, r.window_end, r.window_text))
    return [sorted(got.get(i, [])) for i in range(len(texts))]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab. \n!?é😀\t", max_size=150), min_size=20, max_size=40))
def test_windows_against_brute_force(spark, texts):
    for w in (SMALL, Windows(size=30, overlap=10, slack=0), Windows(size=50, overlap=44, slack=5)):
        got = windows_of(spark, texts, w)
        assert got == [brute(t, w) for t in texts]


def test_windows_cover_the_text_and_keep_their_size(spark):
    texts = ["One. Two three four. " * 60, "x" * 500, "a\n" * 200, "", "short"]
    for text, found in zip(texts, windows_of(spark, texts, SMALL), strict=True):
        covered = 0
        for _, a, b, body in found:
            assert a <= covered and body == text[a:b] and b - a <= SMALL.size + SMALL.slack
            covered = b
        assert covered == len(text)


def test_a_missing_text_has_no_window_and_names_may_clash(spark):
    df = spark.createDataFrame([(1, None, 5), (2, "a. b", 6)], "doc_id int, body string, window_no int")
    got = text_windows(df, "body", SMALL).collect()
    assert [tuple(r) for r in got] == [(2, 0, 0, 4, "a. b")]
    assert text_windows(df.limit(0), "body", SMALL).collect() == []


def test_a_very_long_text(spark):
    text = "Some words here. And more of them\n" * 60000  # 2 million characters
    got = windows_of(spark, [text], Windows())[0]
    assert got == brute(text, Windows())


def test_sizes_that_would_leave_gaps_are_refused():
    for sizes in ((10, 10, 1), (10, 2, 3), (10, 6, 5), (10, 2, -1)):
        with pytest.raises(ValueError):
            Windows(*sizes)


def test_context_cites_the_characters(spark):
    docs = spark.createDataFrame([("d", "First one. " * 4)], "doc_id string, text string").withColumn(
        "metadata", F.create_map(F.lit("city"), F.lit("Pune"), F.lit("rating"), F.lit("4"))
    )
    pieces = retrieve.chunks(docs, SMALL).withColumns({"query_id": F.lit(1), "rank": F.regexp_extract("chunk_id", "#(.*)", 1).cast("int") + 1})
    row = retrieve.context(pieces).first()
    want = [f" (Pune, 4 stars, characters {a}-{b}) {t}" for _, a, b, t in brute("First one. " * 4, SMALL)]
    assert row.context == "\n".join(want) and row.n_sources == len(want)
