from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from tiffin.plans.daily import merge_fact
from tiffin.sources import keystats
from tiffin.sources.tables import DuplicateKeys, LayerTable, incremental_rows


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def table(spark, tmp_path):
    return LayerTable(spark, str(tmp_path / "t"), "k bigint, v string")


def frame(spark, data, schema="k bigint, v string"):
    return spark.createDataFrame(data, schema)


def test_absent_table_reads_empty(table):
    assert not table.exists() and table.read().count() == 0


def test_upsert_updates_and_inserts(spark, table):
    table.upsert(frame(spark, [(1, "a"), (2, "b")]), ["k"])
    table.upsert(frame(spark, [(2, "B"), (3, "c")]), ["k"])
    assert rows(table.read()) == [(1, "a"), (2, "B"), (3, "c")]
    table.upsert(frame(spark, [(2, "B"), (3, "c")]), ["k"])
    assert rows(table.read()) == [(1, "a"), (2, "B"), (3, "c")]


def test_upsert_refuses_repeated_keys_and_changes_nothing(spark, table):
    table.append(frame(spark, [(1, "a")]))
    with pytest.raises(DuplicateKeys):
        table.upsert(frame(spark, [(2, "x"), (2, "y")]), ["k"])
    assert rows(table.read()) == [(1, "a")]


def test_only_touched_partitions_are_rewritten(spark, table):
    by = F.left("v", F.lit(1))
    table.replace(frame(spark, [(1, "a1"), (2, "a2"), (3, "b3"), (4, "c4"), (5, None)]), part_by=by)
    before = {p.part: p.path for p in table.pieces()}
    assert set(before) == {"a", "b", "c", "none"}
    table.upsert(frame(spark, [(3, "b9"), (6, "c6"), (7, "d7")]), ["k"], part_by=by)
    after = table.pieces()
    paths = {p.path for p in after}
    assert before["a"] in paths and before["c"] in paths and before["none"] in paths
    assert before["b"] not in paths
    assert sorted(p.part for p in after) == ["a", "b", "c", "c", "d", "none"]
    assert rows(table.read().filter("k > 2")) == sorted(
        [(3, "b9"), (4, "c4"), (6, "c6"), (7, "d7"), (5, None)], key=lambda r: r[0]
    )
    assert rows(table.read(["c"])) == [(4, "c4"), (6, "c6")]


def test_an_upsert_reads_only_directories_that_may_hold_its_keys(spark, tmp_path):
    """Ranges of keys first, then the Bloom filters; what is left out surely holds none of the keys."""
    month = F.floor(F.col("k") / 1000)
    table = LayerTable(spark, str(tmp_path / "t"), "k bigint, v string", keys=["k"])
    # The even keys of a thousand in one directory, some odd ones of all thousands in the last.
    old = spark.range(0, 20_000, 2).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    table.replace(old, part_by=month)
    assert all(p.rows == 500 and int(p.high) - int(p.low) == 998 for p in table.pieces())
    asked = lambda *keys: sorted(int(p.part) for p in table.candidates(table.pieces(), frame(spark, [(k,) for k in keys], "k bigint"), ["k"]))
    assert asked(3000, 3998) == [3]
    assert asked(2500, 7500) == [2, 7]  # the ranges of 3 to 6 lie between
    assert asked(3001) == [] and asked(50_000) == []
    for piece in table.pieces():
        low = int(piece.low)
        assert int(piece.part) in asked(low, low + 1)
    table.upsert(frame(spark, [(2500, "new"), (2501, "new"), (99_000, "new")]), ["k"], part_by=month)
    got = {r.k: r.v for r in table.read().collect()}
    assert len(got) == 10_002 and got[2500] == got[2501] == got[99_000] == "new" and got[2502] == "old"
    assert asked(99_000) == [99] and asked(2501) == [2]
    assert len(spark.read.parquet(*[f"{table.root}/keys/{w}" for w in {p.write for p in table.pieces()}]).select("path").distinct().collect()) >= 20
    table.expire()
    assert asked(2500) == [2]


def test_directories_without_statistics_are_read(spark, tmp_path):
    plain = LayerTable(spark, str(tmp_path / "t"), "k bigint, v string")
    plain.replace(frame(spark, [(1, "a"), (2, "b")]), part_by=F.col("v"))
    table = LayerTable(spark, plain.root, "k bigint, v string", keys=["k"])
    table.append(frame(spark, [(3, "c")]), part="c")
    found = table.candidates(table.pieces(), frame(spark, [(9,)], "k bigint"), ["k"])
    assert sorted(p.part for p in found) == ["a", "b"]
    table.upsert(frame(spark, [(2, "B")]), ["k"], part_by=F.col("v"))
    assert rows(table.read()) == [(1, "a"), (2, "B"), (3, "c")]


def test_a_row_may_move_to_another_partition(spark, table):
    by = F.left("v", F.lit(1))
    table.replace(frame(spark, [(1, "a1"), (2, "b2")]), part_by=by)
    table.upsert(frame(spark, [(1, "b1")]), ["k"], part_by=by)
    assert rows(table.read()) == [(1, "b1"), (2, "b2")]


def test_new_columns_are_added_and_types_kept(spark, table):
    table.append(frame(spark, [(1, "a")]))
    table.upsert(frame(spark, [(2, "b", 7)], "k bigint, v string, extra int"), ["k"])
    assert rows(table.read().filter("k = 2")) == [(2, "b", 7)]
    assert rows(table.read().filter("k = 1")) == [(1, "a", None)]
    with pytest.raises(TypeError):
        table.append(frame(spark, [("1", "a")], "k string, v string"))


def test_reader_keeps_its_snapshot(spark, table):
    table.append(frame(spark, [(1, "a")]))
    seen = table.read()
    table.replace(frame(spark, [(9, "z")]))
    assert rows(seen) == [(1, "a")] and rows(table.read()) == [(9, "z")]


def test_an_unfinished_write_is_not_seen(spark, table):
    table.append(frame(spark, [(1, "a")]))
    table._write(frame(spark, [(2, "b")]), "all", None)  # stopped before the snapshot
    assert rows(table.read()) == [(1, "a")]


def test_expire_keeps_what_the_newest_snapshot_needs(spark, table):
    table.append(frame(spark, [(1, "a")]))
    table.upsert(frame(spark, [(1, "b")]), ["k"])
    table.upsert(frame(spark, [(2, "c")]), ["k"])
    assert table.expire() > 0
    assert rows(table.read()) == [(1, "b"), (2, "c")]
    table.append(frame(spark, [(3, "d")]))
    assert table.read().count() == 3


FACT = "order_id bigint, t string, status string"


def fact(spark, data):
    return frame(spark, data, FACT).select("order_id", F.col("t").cast("timestamp_ntz").alias("t"), "status")


def test_incremental_merge_skips_late_rows_unless_told(spark, tmp_path):
    first = [(1, "2024-01-05 00:00:00", "Placed"), (2, "2024-02-10 00:00:00", "Placed")]
    second = [
        (1, "2024-01-05 00:00:00", "Delivered"),  # old order, new status
        (2, "2024-02-10 00:00:00", "Delivered"),  # newest stored time: not newer
        (3, "2024-02-09 00:00:00", "Delivered"),  # came late
        (4, "2024-02-11 00:00:00", "Delivered"),
    ]
    strict = LayerTable(spark, str(tmp_path / "strict"))
    merge_fact(strict, fact(spark, first), "order_id", "t")
    merge_fact(strict, fact(spark, second), "order_id", "t")
    assert [(r.order_id, r.status) for r in strict.read().orderBy("order_id").collect()] == [
        (1, "Placed"), (2, "Placed"), (4, "Delivered"),
    ]
    reach = LayerTable(spark, str(tmp_path / "reach"))
    merge_fact(reach, fact(spark, first), "order_id", "t")
    merge_fact(reach, fact(spark, second), "order_id", "t", "3 days")
    assert [(r.order_id, r.status) for r in reach.read().orderBy("order_id").collect()] == [
        (1, "Placed"), (2, "Delivered"), (3, "Delivered"), (4, "Delivered"),
    ]


def test_watermark_reaches_the_parquet_scan(spark, tmp_path):
    fact(spark, [(1, "2024-01-05 00:00:00", "x")]).write.parquet(str(tmp_path / "src"))
    source = spark.read.parquet(str(tmp_path / "src"))
    target = LayerTable(spark, str(tmp_path / "target"))
    target.append(source)
    plan = incremental_rows(source, target, "t")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(t" in plan


def test_many_keys_are_asked_of_the_ranges_alone(spark, tmp_path, monkeypatch):
    """A filter passes some of very many keys by chance, so building and asking it for them is work for nothing."""
    table = LayerTable(spark, str(tmp_path / "t"), "k bigint, v string", keys=["k"])
    half = F.floor(F.col("k") / 50_000)
    table.replace(spark.range(0, 100_000, 2).select(F.col("id").alias("k"), F.lit("old").alias("v")), part_by=half)
    monkeypatch.setattr(keystats, "may_hold", lambda *_: pytest.fail("the filters were asked"))
    batch = spark.range(1, 40_000).select(F.col("id").alias("k"), F.lit("new").alias("v"))
    assert [p.part for p in table.candidates(table.pieces(), batch.select("k"), ["k"])] == ["0"]
    table.upsert(batch, ["k"], part_by=half)
    assert table.read().groupBy("v").count().orderBy("v").collect() == [("new", 39_999), ("old", 30_001)]


def test_a_filter_has_a_row_per_word_of_keys(spark, tmp_path):
    stored = spark.range(5_000).select(F.lit("p").alias("path"), F.col("id").alias("k"))
    sizes = spark.createDataFrame([("p", keystats.words_for(5_000))], "path string, words bigint")
    held = keystats.filters(stored, sizes, ["k"])
    assert held.count() <= keystats.words_for(5_000) == 4_096
    ask = lambda low, high: keystats.may_hold(held, spark.range(low, high).toDF("k"), ["k"], [4_096]).count()
    assert all(ask(k, k + 1) for k in (0, 17, 4_999))
    assert sum(ask(k, k + 1) for k in range(9_000, 9_010)) <= 1


def test_disk_of_a_run(spark, table):
    """Shuffle files go when the statement that made them is done; tables are stored with the stronger codec."""
    held = lambda: spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ").count("shuffle_")
    before = held()
    table.replace(spark.range(1000).selectExpr("id AS k", "'x' AS v").repartition(8, "k"), part_by=F.col("k") % 3)
    for _ in range(50):
        if held() <= before:
            break
        time.sleep(0.2)
    assert held() <= before
    assert all(".zstd." in f for f in table.read().inputFiles())
