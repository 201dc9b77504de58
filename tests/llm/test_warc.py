from __future__ import annotations

import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from tiffin.llm import warc
from tiffin.llm.warc import archive_pages, parse_record, read_records, with_revisits, write_archives

PAGES = [
    (1, "http://a.net/ä?q= x\r\nEvil: 1", "<p>same</p>", "clash"),
    (2, None, "<p>same</p>", "clash"),
    (3, "http://b.net/", "<p>ünï\r\n\r\n</p>", "clash"),
    (4, "http://c.net/", None, "clash"),
    (5, "", "", "clash"),
    (6, "http://d.net/", "long " * 300_000, "clash"),
    (7, "http://d.net/", "long " * 300_000, "clash"),
    (7, "http://d.net/", "long " * 300_000, "clash"),
    (None, "http://e.net/", "<p>only here</p>", "clash"),
    (8, "http://f.net/", "\r\n\r\nWARC/1.1\r\n", "clash"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string, offset string").repartition(3)


def brute(rows, min_bytes=0):
    holder = {}
    for page_id, _, html, _ in rows:
        if page_id is not None:
            holder[html or ""] = max(holder.get(html or "", page_id), page_id)
    out = []
    for page_id, _, html, _ in rows:
        payload = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        response = len(payload) < min_bytes or holder.get(html or "", page_id) == page_id
        out.append(
            (page_id, len(payload), digest, "response" if response else "revisit", None if response else holder[html or ""])
        )
    return sorted(out, key=repr)


@pytest.mark.parametrize("min_bytes", [0, 5, 10**7])
def test_edge_rows(pages, min_bytes):
    got = archive_pages(pages, min_bytes).drop("url").collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(PAGES, min_bytes)


def test_round_trip_of_selected_records(spark, pages, tmp_path, monkeypatch):
    folder = f"file://{tmp_path}/archives"
    index = write_archives(with_revisits(pages), folder)
    chosen = index.filter("record_type = 'response' and page_id in (3, 6, 8) or page_id is null")
    got = {r["page_id"]: bytes(r["payload"]) for r in read_records(chosen, folder).collect()}
    want = {p[0]: (p[2] or "").encode() for p in PAGES}
    # 6 has the payload of 7, which holds it
    assert got == {k: want[k] for k in (3, 8, None)}


def test_archives_are_plain_warc(pages, tmp_path):
    index = write_archives(with_revisits(pages.coalesce(1)), f"file://{tmp_path}/a").collect()
    for name in {r["archive"] for r in index}:
        data = (tmp_path / "a" / name).read_bytes()
        whole = gzip.decompress(data)
        own = [r for r in index if r["archive"] == name]
        assert whole.count(b"WARC-Record-ID: ") == len(own)
        assert sum(r["length"] for r in own) == len(data)
        assert b"\r\nEvil" not in whole


def test_torn_archive_is_refused(pages, tmp_path):
    folder = f"file://{tmp_path}/b"
    index = write_archives(with_revisits(pages.coalesce(1)), folder)
    row = index.filter("page_id = 3").first()
    data = (tmp_path / "b" / row["archive"]).read_bytes()[row["offset"] : row["offset"] + row["length"]]
    assert parse_record(data)[0] == 3
    with pytest.raises(Exception, match="."):
        parse_record(data[:-9])


def test_runs_coalesce_near_records():
    entries = [{"archive": "a", "offset": o, "length": 10} for o in (0, 10, 20, 10**6)] + [
        {"archive": "b", "offset": 0, "length": 10}
    ]
    assert [len(r) for r in warc._runs(entries)] == [3, 1, 1]


def test_empty_table(pages):
    assert archive_pages(pages.limit(0)).count() == 0


def test_a_third_of_all_pages_are_copies(spark):
    pages = spark.range(300).select(
        F.col("id").alias("page_id"),
        F.lit("http://x/").alias("url"),
        F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("html"),
    )
    got = archive_pages(pages)
    assert got.filter("record_type = 'revisit' and refers_to = 297").count() == 99
    assert got.filter("record_type = 'response'").count() == 201
