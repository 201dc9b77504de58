"""Rows that are shuffled slice by slice, copies that are deleted when used, and compressed landing files."""

from __future__ import annotations

import gzip
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tiffin.operators import quality
from tiffin.plans import changes, daily, staging, workload
from tiffin.sources import tables
from tiffin.sources.landing import SOURCE_COLUMNS, raw_table
from tiffin.sources.tables import LayerTable, in_slices, slices_for


@pytest.fixture
def sliced(monkeypatch):
    """The smallest tables go in several slices; the number of rows of every write."""
    monkeypatch.setattr(tables, "SLICE_BYTES", 1)
    seen: list[list[int]] = []
    write = LayerTable._write

    def counted(self, df, part, part_by):
        seen.append([frame.count() for frame in df] if isinstance(df, list) else [df.count()])
        return write(self, df, part, part_by)

    monkeypatch.setattr(LayerTable, "_write", counted)
    return seen


def test_equal_and_missing_keys_are_in_one_slice(spark):
    rows = spark.createDataFrame([(k, i) for k in (*range(40), None) for i in range(3)], "k bigint, i int")
    slices = in_slices(rows, ["k"], 4)
    held = [[r.k for r in s.collect()] for s in slices]
    assert sum(map(len, held)) == 123 and all(held) and not any(set(a) & set(b) for a in held for b in held if a is not b)
    assert (slices_for(0), slices_for(tables.SLICE_BYTES + 1), slices_for(1 << 50)) == (1, 2, tables.MOST_SLICES)


def order(number: str, status: str, day: int = 1) -> tuple:
    values = {"order_id": number, "order_timestamp": f"2024-03-0{day} 10:00:00", "order_date": "2024-03-01", "user_id": "7", "r_id": "1",
              "restaurant_city": "Pune", "order_status": status}
    return tuple(values.get(c) for c in SOURCE_COLUMNS["orders"])


def stamp(spark, rows, table, source: str, day: int) -> None:
    """Append rows of texts as the load of a day."""
    found = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in SOURCE_COLUMNS[source]))
    at = F.lit(datetime(2024, 3, day)).cast("timestamp")
    table.append(found.withColumns({"_ingested_at": at, "_source_file": F.lit("f"), "_batch_id": F.lit("b"), "_record_hash": F.lit("h")}))


def test_staging_is_built_slice_by_slice(spark, tmp_path, sliced):
    """No slice holds all orders, and of '5' and '05' the later one stays."""
    raw = raw_table(spark, str(tmp_path), "orders")
    for day in (1, 2):
        rows = [order(f"{'0' * (day - 1)}{i}", f"day {day}") for i in range(1, 41) if day == 1 or i % 2] + [order("x", "none")]
        stamp(spark, rows, raw, "orders", day)
    sliced.clear()
    changes.stage_source(spark, str(tmp_path), "orders")
    assert len(sliced[0]) == tables.MOST_SLICES and sum(sliced[0]) == 40 and max(sliced[0]) < 40
    staged = changes.staging_table(spark, str(tmp_path), "orders")
    assert len(staged.pieces()) == 1 and staged.pieces()[0].rows == 40
    assert {r.order_id: r.order_status for r in staged.read().collect()} == {i: f"day {1 + i % 2}" for i in range(1, 41)}


def test_an_upsert_goes_slice_by_slice(spark, tmp_path, sliced):
    table = LayerTable(spark, str(tmp_path / "t"), "k bigint, v string", keys=["k"])
    month = F.floor(F.col("k") / 10)
    old = [(k, "old") for k in range(30)] + [(None, "old")]
    table.replace(spark.createDataFrame(old, "k bigint, v string"), part_by=month)
    change = table.upsert(spark.createDataFrame([(k, "new") for k in (3, 12, 40, None)], "k bigint, v string"), ["k"], part_by=month)
    assert len(sliced[-1]) == tables.MOST_SLICES and max(sliced[-1]) < sum(sliced[-1])
    assert {r.k: r.v for r in table.read().collect()} == dict(old) | dict.fromkeys((3, 12, 40, None), "new")
    assert table.read().count() == 32 and change.before.count() == 3


def test_the_copy_of_an_upsert_goes_when_it_is_released(spark, tmp_path):
    table = LayerTable(spark, str(tmp_path / "t"), "k bigint, v string")
    table.append(spark.createDataFrame([(1, "a")], "k bigint, v string"))
    change = table.upsert(spark.createDataFrame([(1, "b")], "k bigint, v string"), ["k"])
    assert change.before.collect() == [(1, "a")] and change.after.collect() == [(1, "b")]
    change.release()
    assert not list((tmp_path / "t" / "incoming").iterdir()) and table.read().collect() == [(1, "b")]


def test_no_copy_is_left_after_the_marts(spark, tmp_path, monkeypatch):
    """A second day merges orders and items; the copies of what it took in are deleted as soon as they are used."""
    monkeypatch.setattr(quality, "gate", lambda results: "passed")
    config = daily.DailyConfig("", str(tmp_path), "d")
    for day in (1, 2):
        item = (f"1{day}", str(day), "1", "f1", "12.50", "1", "12.50")
        stamp(spark, [order(str(day), "Delivered", day)], raw_table(spark, str(tmp_path), "orders"), "orders", day)
        stamp(spark, [item], raw_table(spark, str(tmp_path), "order_items"), "order_items", day)
        staged = staging.build_staging({s: raw_table(spark, str(tmp_path), s).read() for s in SOURCE_COLUMNS})
        daily.build_marts(spark, config, staged, daily.RunState())
    for name in ("fact_orders", "fact_order_items"):
        assert daily.table(spark, config, "marts", name).read().count() == 2
        assert (tmp_path / "marts" / name / "incoming").is_dir() and not list((tmp_path / "marts" / name / "incoming").iterdir())


def test_packed_landing_files_are_compressed_and_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workload, "PACKED_ROWS", 2)
    rows = spark.createDataFrame([(str(i), f"f{i}", "a\nb,\"c", None) for i in range(5)], ", ".join(f"`{c}` string" for c in SOURCE_COLUMNS["food"]))
    workload.export_landing(spark, "", str(tmp_path), ["food"], raw={"food": rows.coalesce(1)}, packed=True)
    files = sorted((tmp_path / "food").glob("*.csv.gz"))
    assert len(files) == 3 and gzip.decompress(files[0].read_bytes()).startswith(b"_idx,f_id,item")
    plain = workload.load_sources(spark, str(tmp_path), str(tmp_path / "w"), "r", ["food"])
    got = raw_table(spark, str(tmp_path / "w"), "food").read().select("f_id", "item", "veg_or_non_veg").collect()
    assert plain.total_rows == 5 and sorted(got) == [(f"f{i}", 'a\nb,"c', None) for i in range(5)]
