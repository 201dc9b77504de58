"""Steps of the daily run that go side by side or in one statement."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tiffin.plans import workload
from tiffin.sources.landing import SOURCE_COLUMNS
from tiffin.sources.tables import LayerTable


def test_landing_files_are_written_side_by_side(spark, tmp_path, monkeypatch):
    """Both writes are under way at the same time, else the barrier breaks."""
    both = threading.Barrier(2, timeout=20)
    monkeypatch.setattr(DataFrameWriter, "csv", lambda self, path: both.wait())
    raw = {s: spark.createDataFrame([], ", ".join(f"`{c}` string" for c in SOURCE_COLUMNS[s])) for s in ("food", "menu")}
    workload.export_landing(spark, "", str(tmp_path), ["food", "menu"], raw=raw)


def test_keys_are_asked_in_one_pass(spark, tmp_path):
    """Missing keys, range and number of the new keys come from one statement; the batch is not scanned for each."""
    table = LayerTable(spark, str(tmp_path / "t"), "k bigint, part string", keys=["k"])
    table.replace(spark.createDataFrame([(i, str(i % 3)) for i in range(30)], "k bigint, part string"), part_by=F.col("part"))
    scans = spark.sparkContext.accumulator(0)

    def counted(rows):
        for row in rows:
            scans.add(1)
            yield row

    keys = spark.createDataFrame(spark.sparkContext.parallelize([(4,)], 1).mapPartitions(counted), "k bigint")
    assert [p.part for p in table.candidates(table.pieces(), keys, ["k"])] == ["1"]
    assert scans.value == 2  # one for these, one to ask the filters
