from __future__ import annotations

import csv
import gzip
import io
import random
from datetime import datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tiffin.session import settings
from tiffin.sources import control, landing, records
from tiffin.sources.control import LoadGateFailed
from tiffin.streaming.landing_stream import file_counts, stream_source

HEADER = "_idx,f_id,item,veg_or_non_veg\n"


class Folder:
    """A landing folder and a warehouse of one test."""

    def __init__(self, spark, base):
        self.spark, self.base = spark, base
        self.landing, self.warehouse = str(base / "landing"), str(base / "warehouse")
        (base / "landing").mkdir()

    def put(self, name, body, source="food"):
        path = self.base / "landing" / source / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(body if isinstance(body, bytes) else body.encode())
        return path

    def load(self, run_id, sources=("food",)):
        return landing.load_sources(self.spark, self.landing, self.warehouse, run_id, list(sources))

    def runs(self, **where):
        rows = control.ingestion_runs(self.spark, self.warehouse).read().collect()
        rows = [r for r in rows if all(r[k] == v for k, v in where.items())]
        return {(r.run_id, r.file_name): (r.status, r.row_count) for r in rows}

    def raw(self, source="food"):
        return landing.raw_table(self.spark, self.warehouse, source).read()


@pytest.fixture
def folder(spark, tmp_path):
    return Folder(spark, tmp_path)


def test_dialect(folder):
    folder.put("a.csv", HEADER + '1,fd1,"x, ""q"" y",veg\n2,fd2,,""\n3,fd3,\\N,NULL\n4,fd4, \n'
               '5,fd5,"two\nlines",veg,extra,more\n6,fd6, keep ,"NULL"\n')  # fmt: skip
    folder.put("b.csv.gz", gzip.compress((HEADER + "9,fd9,z,non-veg\n").encode()))
    assert folder.load("r1").total_rows == 7
    got = {r.f_id: (r.item, r.veg_or_non_veg) for r in folder.raw().collect()}
    assert got == {
        "fd1": ('x, "q" y', "veg"), "fd2": (None, ""), "fd3": (None, None), "fd4": (None, None),
        "fd5": ("two\nlines", "veg"), "fd6": (" keep ", None), "fd9": ("z", "non-veg"),
    }


@pytest.fixture
def small_blocks(spark):
    """Files are split into blocks of 400 bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {n: spark.conf.get(n) for n in names}
    spark.conf.set(names[0], "400")
    spark.conf.set(names[1], "0")
    yield
    for n in names:
        spark.conf.set(n, old[n])


def test_files_with_line_breaks_are_split(folder, spark, small_blocks):
    """Records over many blocks, compared with a reader of whole files."""
    rng = random.Random(2)
    texts = ["", "plain", 'a "quoted" word', "two\nlines", "\n", ",\n,", '"\n"', "one,\ntwo\n\nthree", "x" * 900, 'y\n' * 400]
    for number, end in enumerate(["\n", "\r\n"]):
        with io.StringIO(newline="") as out:
            writer = csv.writer(out, lineterminator=end)
            writer.writerow(["_idx", "f_id", "item", "veg_or_non_veg"])
            for i in range(400):
                writer.writerow([i, f"fd{number}_{i}", rng.choice(texts), rng.choice(['5" pipe', "veg", "a\nb", ""])])
            folder.put(f"{number}.csv", out.getvalue())
    folder.put("plain.csv", HEADER + "".join(f"{i},p{i},x,veg\n" for i in range(200)))
    files = [str(folder.base / "landing" / "food" / n) for n in ("0.csv", "1.csv")]
    found = records.lines(spark, files, landing.file_key("food"))
    assert found.select("file_name", "block").distinct().count() > 40
    assert folder.load("r1").total_rows == 1000
    whole = landing.text_reader(spark.read, landing.SOURCE_COLUMNS["food"]).option("multiLine", True).csv(files)
    want = [tuple(r) for r in landing.null_tokens(whole, landing.SOURCE_COLUMNS["food"]).collect()]
    got = folder.raw().filter("f_id like 'fd%'").select(*landing.SOURCE_COLUMNS["food"]).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_states_by_hand(spark):
    """The maps of single lines, composed over blocks of any cut, against a walk over the whole file."""
    rng = random.Random(5)
    for _ in range(6):
        values = ["".join(rng.choices(',"a', k=rng.randrange(0, 7))) for _ in range(60)]
        df = spark.createDataFrame(list(enumerate(values)), "i long, value string").select(
            "value", records.state_after(F.col("value"), False).alias("o"), records.state_after(F.col("value"), True).alias("n"), "i"
        )
        maps = {r["i"]: (r["o"], r["n"]) for r in df.collect()}
        rows = [("f", (i // 7) * 10, v) for i, v in enumerate(values)]
        placed, ends = records.with_states(spark.createDataFrame(rows, "file_name string, block long, value string").coalesce(1))
        state, want = False, []
        for i in range(len(values)):
            want.append((state, maps[i][state]))
            state = maps[i][state]
        got = placed.orderBy("block", "at").collect()
        assert [(r["opened"], r["open"]) for r in got] == want and ends.first()["open"] == state


def test_one_line_sources(folder):
    """Where fields have no line breaks, an open line tears the file."""
    folder.put("a.csv", HEADER + '1,fd1,"item, 1",\n')
    folder.put("b.csv", HEADER + '1,fd2,"two\nlines",\n')
    out = landing.load_sources(folder.spark, folder.landing, folder.warehouse, "r1", ["food"], one_line_sources=["food"])
    assert (out.total_rows, out.failed_sources) == (1, ["food"])


def test_rows_are_stamped(folder):
    folder.put("deep/a b+c%.csv", HEADER + "1,fd1,x,veg\n")
    folder.load("r1")
    row = folder.raw().first()
    assert (row._source_file, row._batch_id) == ("food/deep/a b+c%.csv", "r1")
    assert len(row._record_hash) == 32 and isinstance(row._ingested_at, datetime)


def test_a_loaded_file_is_skipped(folder):
    folder.put("a.csv", HEADER + "".join(f"{i},fd{i},x,veg\n" for i in range(100)))
    assert folder.load("r1").total_rows == 100
    assert folder.runs() == {("r1", "food/a.csv"): ("SUCCEEDED", 100)}
    second = folder.load("r2")
    assert (second.total_rows, second.exit_code) == (0, 0)
    assert folder.runs(run_id="r2") == {("r2", "food/a.csv"): ("SKIPPED_ALREADY_LOADED", 0)}
    assert folder.raw().count() == 100


def test_a_retry_keeps_its_success(folder):
    folder.put("a.csv", HEADER + "1,fd1,x,veg\n")
    folder.load("r1")
    folder.put("b.csv", HEADER + "2,fd2,x,veg\n")
    folder.load("r1")
    assert folder.runs() == {("r1", "food/a.csv"): ("SUCCEEDED", 1), ("r1", "food/b.csv"): ("SUCCEEDED", 1)}
    assert folder.raw().count() == 2


def test_a_broken_file_fails_alone_and_is_retried(folder):
    for name in "abc":
        folder.put(f"{name}.csv", HEADER + f"1,{name},x,veg\n")
    folder.put("bad.csv.gz", b"not gzip")
    outcome = folder.load("r1")
    assert (outcome.failed_sources, outcome.exit_code, outcome.total_rows) == (["food"], 1, 3)
    assert folder.runs()[("r1", "food/bad.csv.gz")] == ("FAILED", 0)
    failed = control.ingestion_runs(folder.spark, folder.warehouse).read().filter("status = 'FAILED'").first()
    assert failed.error_message
    folder.put("bad.csv.gz", gzip.compress((HEADER + "1,late,x,veg\n").encode()))
    folder.load("r2")
    assert folder.runs(run_id="r2")[("r2", "food/bad.csv.gz")] == ("SUCCEEDED", 1)
    assert sorted(r.f_id for r in folder.raw().collect()) == ["a", "b", "c", "late"]


TORN = {
    "first.csv": '1,fd1,"open until the end,veg\n2,fd2,x,veg\n3,fd3,x,veg\n',
    "later.csv": '1,fd1,"closed, ""q""",veg\n2,fd2,"open\n3,fd3,"again, closed",veg\n',
    "last.csv": '1,fd1,x,veg\n2,fd2,x,"',
}
WHOLE = {
    "inch.csv": '1,fd1,5" plate,veg\n2,fd2,"",veg\n',
    "breaks.csv": '1,fd1,"two\n,""lines""",veg\n2,fd2,"""all""",veg\n',
    "plain.csv": "1,fd1,x\n",
}


@pytest.mark.parametrize("one_line", [False, True])
def test_torn_files_fail_and_the_others_load(folder, one_line):
    whole = {n: b for n, b in WHOLE.items() if not (one_line and n == "breaks.csv")}
    for name, body in (TORN | whole).items():
        folder.put(name, HEADER + body)

    def load(run_id):
        sources = ["food"] if one_line else []
        return landing.load_sources(
            folder.spark, folder.landing, folder.warehouse, run_id, ["food"], one_line_sources=sources
        )

    assert load("r1").exit_code == 1
    got = folder.runs(run_id="r1")
    assert {f for (_, f), (status, n) in got.items() if (status, n) == ("FAILED", 0)} == {f"food/{n}" for n in TORN}
    assert {f: n for (_, f), (status, n) in got.items() if status == "SUCCEEDED"} == {
        f"food/{n}": 1 if n == "plain.csv" else 2 for n in whole
    }
    for name in TORN:
        folder.put(name, HEADER + "7,mended,x,veg\n")
    assert load("r2").exit_code == 0
    assert folder.raw().filter("f_id = 'mended'").count() == 3


def test_errors_that_are_no_files_fault_are_not_blamed_on_files(folder, monkeypatch):
    folder.put("a.csv", HEADER + "1,fd1,x,veg\n")
    folder.put("b.csv", HEADER + "2,fd2,x,veg\n")

    def full(*args, **kw):
        raise RuntimeError("no space left")

    with monkeypatch.context() as m:
        m.setattr(landing.LayerTable, "append", full)
        with pytest.raises(RuntimeError, match="no space left"):
            landing._write_files(
                folder.spark, landing.raw_table(folder.spark, folder.warehouse, "food"), "food", "r1", {"food/a.csv": f"{folder.landing}/food/a.csv"}, None, False
            )
    folder.load("r2")
    assert folder.runs() == {("r2", "food/a.csv"): ("SUCCEEDED", 1), ("r2", "food/b.csv"): ("SUCCEEDED", 1)}


def test_a_crash_before_the_record_does_not_load_twice(folder, monkeypatch):
    folder.put("a.csv", HEADER + "1,fd1,x,veg\n2,fd2,x,veg\n")

    def crash(*args):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(control, "record_results", crash)
        with pytest.raises(RuntimeError):
            folder.load("r1")
    assert folder.raw().count() == 2 and folder.runs() == {}
    folder.put("b.csv", HEADER + "3,fd3,x,veg\n")
    folder.load("r2")
    assert folder.raw().count() == 3
    assert folder.runs() == {("r2", "food/a.csv"): ("SUCCEEDED", 2), ("r2", "food/b.csv"): ("SUCCEEDED", 1)}


def test_a_source_without_files_leaves_a_row(folder):
    folder.load("r1")
    assert folder.runs() == {("r1", None): ("SUCCEEDED", 0)}
    folder.load("r1")
    assert folder.runs() == {("r1", None): ("SUCCEEDED", 0)}


def test_a_missing_landing_folder_fails_the_source(folder):
    outcome = landing.load_sources(folder.spark, folder.landing + "-gone", folder.warehouse, "r1", ["food"])
    assert outcome.failed_sources == ["food"]
    assert folder.runs() == {("r1", "<list_files>"): ("FAILED", 0)}


def test_load_gate_and_lineage(folder):
    runs = control.ingestion_runs(folder.spark, folder.warehouse)
    with pytest.raises(LoadGateFailed):
        control.check_load(runs.read(), "r1")
    folder.put("a.csv", HEADER + "1,fd1,x,veg\n")
    folder.put("u.csv", "h\n0,1,n\n0,2,n\n", "users")
    folder.load("r1", ["food", "users"])
    assert control.check_load(runs.read(), "r1") == {"sources_loaded": 2, "total_rows": 3}
    folder.put("bad.csv.gz", b"no")
    folder.load("r2", ["food", "users"])
    with pytest.raises(LoadGateFailed, match="food"):
        control.check_load(runs.read(), "r2")
    lineage = control.lineage_runs(folder.spark, folder.warehouse).read().collect()
    got = {(r.run_id, r.source): (r.input_files, r.output_table, r.state, r.row_count) for r in lineage}
    assert got == {
        ("r1", "food"): (1, "raw.food", "COMPLETE", 1), ("r1", "users"): (1, "raw.users", "COMPLETE", 2),
        ("r2", "food"): (2, "raw.food", "FAIL", 0), ("r2", "users"): (1, "raw.users", "COMPLETE", 0),
    }


def test_list_files(folder):
    folder.put("x/a.csv", "12345")
    folder.put("b.csv", "1")
    got = {r.file_name: r.size_bytes for r in landing.list_files(folder.spark, folder.landing, "food").collect()}
    assert got == {"food/x/a.csv": 5, "food/b.csv": 1}


def test_stream_loads_each_file_once(folder):
    folder.put("a.csv", HEADER + '1,fd1,"a\nb",NULL\n')
    folder.put("b.csv", HEADER + "2,fd2,x,veg\n3,fd3,x,veg\n")
    for _ in range(2):
        stream_source(folder.spark, folder.landing, folder.warehouse, "food", "s1", 1).awaitTermination()
    folder.put("c.csv", HEADER + "4,fd4,x,veg\n")
    stream_source(folder.spark, folder.landing, folder.warehouse, "food", "s2").awaitTermination()
    got = {r._source_file: r.row_count for r in file_counts(folder.raw()).collect()}
    assert got == {"food/a.csv": 1, "food/b.csv": 2, "food/c.csv": 1}
    # The batch load takes the files of the stream as loaded.
    assert folder.runs() == {
        ("s1", "food/a.csv"): ("SUCCEEDED", 1), ("s1", "food/b.csv"): ("SUCCEEDED", 2),
        ("s2", "food/c.csv"): ("SUCCEEDED", 1),
    }
    folder.load("r1")
    assert folder.raw().count() == 4
    assert folder.runs()[("r1", "food/b.csv")] == ("SKIPPED_ALREADY_LOADED", 0)
    runs = control.ingestion_runs(folder.spark, folder.warehouse).read()
    assert control.check_load(runs, "s1") == {"sources_loaded": 1, "total_rows": 3}
    lineage = control.lineage_runs(folder.spark, folder.warehouse).read().filter("run_id like 's%'").collect()
    assert {(x.run_id, x.input_files, x.state, x.row_count) for x in lineage} == {
        ("s1", 2, "COMPLETE", 3), ("s2", 1, "COMPLETE", 1),
    }


def test_stream_records_a_torn_file(folder):
    folder.put("a.csv", HEADER + "1,fd1,x,veg\n")
    folder.put("torn.csv", HEADER + '2,fd2,"x,veg\n3,fd3,x,veg\n')
    stream_source(folder.spark, folder.landing, folder.warehouse, "food", "s1").awaitTermination()
    assert folder.runs() == {("s1", "food/a.csv"): ("SUCCEEDED", 1), ("s1", "food/torn.csv"): ("FAILED", 0)}
    assert folder.raw().count() == 1
    with pytest.raises(LoadGateFailed, match="food"):
        control.check_load(control.ingestion_runs(folder.spark, folder.warehouse).read(), "s1")


@pytest.mark.parametrize("step", ["record_results", "lineage"])
def test_a_replayed_batch_writes_nothing_twice(folder, monkeypatch, step):
    """A stream that dies after writing rows, or after recording them, plays the batch again under another run."""
    folder.put("a.csv", HEADER + "1,fd1,x,veg\n2,fd2,x,veg\n")

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(control, step, crash)
        with pytest.raises(StreamingQueryException):
            stream_source(folder.spark, folder.landing, folder.warehouse, "food", "s1").awaitTermination()
    assert folder.raw().count() == 2
    stream_source(folder.spark, folder.landing, folder.warehouse, "food", "s2").awaitTermination()
    assert folder.raw().count() == 2
    by_run = {"record_results": {("s2", "food/a.csv"): ("SUCCEEDED", 2)}, "lineage": {
        ("s1", "food/a.csv"): ("SUCCEEDED", 2), ("s2", "food/a.csv"): ("SKIPPED_ALREADY_LOADED", 0)}}
    assert folder.runs() == by_run[step]


def test_pipeline_run_rows_are_updated_in_place(spark, tmp_path):
    table = control.pipeline_runs(spark, str(tmp_path))
    start, end = datetime(2024, 1, 1), datetime(2024, 1, 1, 1)
    control.record_failure(table, "r1", start, 7)
    row = table.read().first()
    assert (row.status, row.dq_status, row.rows_ingested, row.ai_success_count) == ("FAILED", "failed", 7, 0)
    control.record_pipeline_run(
        table, run_id="r1", started_at=end, status="SUCCESS", dq_status="passed", finished_at=end, dag_run_id="d2"
    )
    control.record_pipeline_run(table, run_id="r2", started_at=end, status="SUCCESS", dq_status="warned")
    got = {r.run_id: r for r in table.read().collect()}
    assert set(got) == {"r1", "r2"}
    assert (got["r1"].status, got["r1"].started_at, got["r1"].dag_run_id) == ("SUCCESS", start, "r1")


def test_records_are_cut_where_they_lie(spark):
    """Records of lines in blocks of any cut against one pass over the file; only parts of those over an end are shuffled."""
    rng = random.Random(9)
    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "3"}):
        for size in (1, 4, 9):
            values = [rng.choice(["", " ", "a,b", 'a,"b', 'c",d', "e\r", '"', 'x,"y"', 'i"j']) for _ in range(70)]
            rows = [("f", (i // size) * 10, v) for i, v in enumerate(values)]
            found = spark.createDataFrame(rows, "file_name string, block long, value string").coalesce(1)
            placed, _ = records.with_states(found)
            want, part = [], []
            for r in placed.orderBy("block", "at").collect():
                part.append(r["value"])
                if not r["open"]:
                    want += ["\n".join(part)] if len(part) > 1 or part[0].strip(" \t\r") else []
                    part = []
            want += ["\n".join(part)] if part else []
            want = [w.removesuffix("\r") for w in want[1:]]
            cut = records.records(found, records.block_states(found)[0])
            assert sorted(r["record"] for r in cut.collect()) == sorted(want)


def test_tasks_take_several_blocks(spark, sf_dir, tmp_path):
    """The load in small blocks sends the measures of a bounded number of tasks to the driver."""
    path = str(tmp_path / "lines")
    spark.range(200_000).select(F.col("id").cast("string").alias("value")).coalesce(1).write.text(path)
    small = {"spark.sql.files.maxPartitionBytes": "1KB", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.maxPartitionNum": "16"}
    with settings(spark, small):
        found = records.lines(spark, [path], F.lit("f"))
        assert found.rdd.getNumPartitions() <= 17 and found.select("block").distinct().count() > 1000
