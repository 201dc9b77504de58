"""CSV drops: dialect, listing, and the exactly-once load into raw tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import UTC, datetime
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffin.functions.cleaning import record_hash
from tiffin.sources import control, records
from tiffin.sources.tables import LayerTable, Piece, union_all

# Sources and the column order of their files.
SOURCE_COLUMNS: dict[str, list[str]] = {
    "restaurants": ["_idx", "id", "name", "city", "rating", "rating_count", "cost", "cuisine", "lic_no", "link",
                    "address", "menu"],
    "users": ["_idx", "user_id", "name", "email", "password", "age", "gender", "marital_status", "occupation",
              "monthly_income", "education", "family_size"],
    "food": ["_idx", "f_id", "item", "veg_or_non_veg"],
    "menu": ["_idx", "menu_id", "r_id", "f_id", "cuisine", "price"],
    "orders": ["order_id", "order_timestamp", "order_date", "user_id", "r_id", "restaurant_city", "cuisine",
               "items_count", "sales_qty", "subtotal", "discount", "delivery_fee", "gst", "sales_amount",
               "currency", "payment_method", "order_status", "customer_rating", "delivery_time_min"],
    "order_items": ["order_item_id", "order_id", "r_id", "f_id", "price", "quantity", "line_amount"],
    "reviews": ["review_id", "order_id", "user_id", "restaurant_id", "rating", "comment", "review_date"],
}

# Field texts that stand for NULL, besides a bare empty field.
NULL_TOKENS = [" ", "\\N", "NULL"]

_FILES = "file_name string, path string, size_bytes bigint, modified_at timestamp"
_LOADED = "file_name string, row_count bigint, status string, error_message string"


OPEN_QUOTE = "a quoted field is still open at the end of the file"


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


# Fields go by position: missing trailing fields are NULL and extra ones dropped.
# ``""`` is an empty text and a bare empty field is NULL, which the null marker
# keeps apart.
DIALECT = {
    "escape": '"', "nullValue": "\u0001", "emptyValue": "", "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false", "maxCharsPerColumn": "-1",
}


def text_reader(reader, columns: Sequence[str]):
    """The landing dialect, a record a line; the header is skipped."""
    return reader.schema(text_schema(columns)).options(**DIALECT, header=True)


def file_key(source: str):
    """Name of a file within the landing folder: ``<source>/<rest of path>``."""
    rest = F.element_at(F.split(F.col("_metadata.file_path"), f"/{source}/", 2), -1)
    return F.concat(F.lit(f"{source}/"), F.url_decode(F.replace(rest, F.lit("+"), F.lit("%2B"))))


def null_tokens(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.when(~F.col(c).isin(NULL_TOKENS), F.col(c)) for c in columns})


def read_landing_csv(spark: SparkSession, paths: str | Sequence[str], source: str) -> DataFrame:
    """Text columns of a source plus ``_source_file``, from files whose every line is a record."""
    columns = SOURCE_COLUMNS[source]
    reader = text_reader(spark.read, columns).option("recursiveFileLookup", True)
    rows = reader.csv(paths if isinstance(paths, str) else list(paths))
    return null_tokens(rows.withColumn("_source_file", file_key(source)), columns)


def parsed_records(found: DataFrame, source: str) -> DataFrame:
    """Text columns of a source plus ``_source_file`` from (file_name, record)."""
    columns = SOURCE_COLUMNS[source]
    ddl = ", ".join(f"`{c}` string" for c in columns)
    fields = F.from_csv("record", ddl, DIALECT).alias("fields")
    rows = found.select(F.col("file_name").alias("_source_file"), fields).select("fields.*", "_source_file")
    return null_tokens(rows, columns)


def stamp(rows: DataFrame, source: str, batch_id: str, loaded_at: datetime | None = None, compat: bool = False):
    """Add load time, batch and row hash to the text columns."""
    columns = SOURCE_COLUMNS[source]
    at = F.current_timestamp() if loaded_at is None else F.lit(loaded_at).cast("timestamp")
    return rows.select(
        *columns,
        at.alias("_ingested_at"),
        "_source_file",
        F.lit(batch_id).alias("_batch_id"),
        record_hash(columns, compat).alias("_record_hash"),
    )


def list_files(spark: SparkSession, landing: str, source: str) -> DataFrame:
    """Every file of a source, loaded or not. File contents are not read. A
    source without a folder has no files; a missing landing folder is an error."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(f"{landing}/{source}")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(hadoop.Path(landing)) and not fs.exists(folder):
        return spark.createDataFrame([], _FILES)
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(f"{landing}/{source}")
        .select(
            file_key(source).alias("file_name"),
            "path",
            F.col("length").alias("size_bytes"),
            F.col("modificationTime").alias("modified_at"),
        )
    )


def raw_table(spark: SparkSession, warehouse: str, source: str) -> LayerTable:
    schema = ", ".join(f"`{c}` string" for c in SOURCE_COLUMNS[source])
    stamps = "_ingested_at timestamp, _source_file string, _batch_id string, _record_hash string"
    return LayerTable(spark, f"{warehouse}/raw/{source}", f"{schema}, {stamps}")


@dataclass(frozen=True)
class LoadOutcome:
    run_id: str
    failed_sources: list[str]
    total_rows: int

    @property
    def exit_code(self) -> int:
        return 1 if self.failed_sources else 0


def load_sources(
    spark: SparkSession,
    landing: str,
    warehouse: str,
    run_id: str | None = None,
    sources: Sequence[str] | None = None,
    loaded_at: datetime | None = None,
    at_once: int = 4,
    one_line_sources: Sequence[str] = (),
) -> LoadOutcome:
    """Load all new files of the given sources (default: all), record every file
    and the lineage of every source, and sum up the run.

    Sources are loaded side by side; one that fails as a whole does not stop the
    others and is recorded as one failed row.
    """
    run_id = run_id or str(uuid.uuid4())
    sources = list(sources or SOURCE_COLUMNS)
    runs = control.ingestion_runs(spark, warehouse)
    before = runs.read()
    known = _recorded_writes(spark, warehouse, sources)

    def attempt(source: str) -> DataFrame:
        try:
            one_line = source in one_line_sources
            files = list_files(spark, landing, source)
            return _load_new(spark, warehouse, source, files, run_id, before, known, loaded_at, one_line)
        except Exception as exc:  # the source as a whole could not be listed or written
            return _results(spark, [("<list_files>", 0, control.FAILED, str(exc))])

    with ThreadPoolExecutor(at_once) as pool:
        outcomes = dict(zip(sources, pool.map(attempt, sources), strict=True))
    results = union_all([df.withColumn("source", F.lit(s)) for s, df in outcomes.items()])
    control.record_results(runs, _result_rows(results, run_id, loaded_at), run_id)
    _mark_recorded(spark, warehouse, sources, known)

    after = runs.read().filter((F.col("run_id") == run_id) & F.col("source").isin(sources))
    control.lineage_runs(spark, warehouse).append(control.lineage(after, loaded_at))
    summary = control.load_summary(after).first()
    failed = [s for s in summary["failed_sources"].split(",") if s]
    return LoadOutcome(run_id, failed, summary["total_rows"])


def load_listed(
    spark: SparkSession, warehouse: str, source: str, files: DataFrame, run_id: str, loaded_at: datetime | None = None
) -> None:
    """Load those of the files (file_name, path) that have no success on record, and record them and the run's lineage.

    May be called again with the same files: rows that an earlier call wrote are counted, not written again, and
    records are put in by key.
    """
    runs = control.ingestion_runs(spark, warehouse)
    known = _recorded_writes(spark, warehouse, [source])
    results = _load_new(spark, warehouse, source, files, run_id, runs.read(), known, loaded_at, False)
    results = results.withColumn("source", F.lit(source))
    control.record_results(runs, _result_rows(results, run_id, loaded_at), run_id)
    _mark_recorded(spark, warehouse, [source], known)
    after = runs.read([LayerTable.label(run_id)]).filter((F.col("run_id") == run_id) & (F.col("source") == source))
    control.lineage_runs(spark, warehouse).upsert(control.lineage(after, loaded_at), ["run_id", "source"])


def _recorded_writes(spark: SparkSession, warehouse: str, sources: Sequence[str]) -> set[str]:
    marked = _marks(spark, warehouse).read()
    return {r["write"] for r in marked.filter(F.col("source").isin(list(sources))).select("write").collect()}


def _result_rows(results: DataFrame, run_id: str, loaded_at: datetime | None) -> DataFrame:
    return results.select(
        F.lit(run_id).alias("run_id"),
        "source",
        "file_name",
        F.lit(loaded_at or datetime.now(UTC)).cast("timestamp").alias("ingestion_timestamp"),
        "row_count",
        "status",
        "error_message",
    )


def _results(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, _LOADED)


def _load_new(spark, warehouse, source, files, run_id, runs, known, loaded_at, one_line) -> DataFrame:
    table = raw_table(spark, warehouse, source)
    new, old = control.split_new_files(files, runs, source)
    # File names and paths only; Spark's own file index holds the same list.
    todo = {r["file_name"]: r["path"] for r in new.select("file_name", "path").collect()}
    parts = [old.select("file_name", F.lit(0).cast("bigint").alias("row_count"), F.lit(control.SKIPPED).alias("status"),
                        F.lit(None).cast("string").alias("error_message"))]

    # Rows written by a load that stopped before its record: take them as loaded.
    orphans = [p for p in table.pieces() if p.write not in known]
    if orphans and todo:
        counts = table.read_pieces(orphans).groupBy("_source_file").count().collect()
        found = {r["_source_file"]: r["count"] for r in counts if r["_source_file"] in todo}
        if found:
            parts.append(_results(spark, [(f, n, control.SUCCEEDED, None) for f, n in found.items()]))
        todo = {f: p for f, p in todo.items() if f not in found}

    written, failed = _write_files(spark, table, source, run_id, todo, loaded_at, one_line)
    names = [f for f in todo if f not in failed]
    if names:
        # Counted here, while other sources load; a number for each of the names above.
        rows = table.read_pieces(written).groupBy("_source_file").count().collect() if written else []
        found = {r["_source_file"]: r["count"] for r in rows}
        parts.append(_results(spark, [(f, found.get(f, 0), control.SUCCEEDED, None) for f in names]))
    if failed:
        parts.append(_results(spark, [(f, 0, control.FAILED, e) for f, e in failed.items()]))
    results = union_all(parts)
    if not todo and not failed and files.isEmpty():
        return _results(spark, [(None, 0, control.SUCCEEDED, None)])
    return results


def _write_files(
    spark, table, source, run_id, todo, loaded_at, one_line
) -> tuple[list[Piece], dict[str, str]]:
    """Write all files in one job. A file counts whole or not at all: one whose
    last quoted field is never closed is left out beforehand, and one that cannot
    be read fails the job, of which nothing is visible then, and is left out of
    the next. Any other error is not a file's fault and is raised."""
    written: list[Piece] = []
    failed: dict[str, str] = {}
    groups = [sorted(todo)] if todo else []
    while groups:
        group = groups.pop()
        try:
            rows, torn = _whole_rows(spark, {f: todo[f] for f in group}, source, one_line)
            failed |= {f: OPEN_QUOTE for f in torn}
            if rows is not None:
                write = table.append(stamp(rows, source, run_id, loaded_at), part=run_id)
                written += [p for p in table.pieces() if p.write == write]
        except Exception as exc:
            message = str(exc)
            if "FAILED_READ_FILE" not in message:
                raise
            named = [f for f in group if f in unquote(message)]
            if len(group) == 1 or named:
                bad = max(named or group, key=len)
                failed[bad] = message
                rest = [f for f in group if f != bad]
                groups += [rest] if rest else []
            else:
                half = len(group) // 2
                groups += [group[half:], group[:half]]
    return written, failed


def _whole_rows(spark, todo: dict[str, str], source: str, one_line: bool) -> tuple[DataFrame | None, set[str]]:
    """Rows of the files (name: path) that are whole, and the names of those that end inside a quoted field.

    Files without an open line are read line by line. In the others the state
    before each block is found and lines are put together to records; where fields are known to have no line breaks, an open line tears
    the file.
    """
    spanning = records.files_with_open_lines(spark, list(todo.values()), file_key(source))
    plain = [p for f, p in todo.items() if f not in spanning]
    rows = read_landing_csv(spark, plain, source) if plain else None
    if one_line or not spanning:
        return rows, spanning
    found = records.lines(spark, [p for f, p in todo.items() if f in spanning], file_key(source))
    blocks, ends = records.block_states(found)
    torn = {r["file_name"] for r in ends.filter("torn").select("file_name").collect()}
    if torn != spanning:
        kept = blocks.join(ends.filter("not torn").select("file_name"), "file_name", "left_semi")
        joined = parsed_records(records.records(found, kept), source)
        rows = joined if rows is None else rows.unionByName(joined)
    return rows, torn


def _marks(spark, warehouse) -> LayerTable:
    """Writes to raw tables whose files are in the control table."""
    return LayerTable(spark, f"{warehouse}/control/recorded_writes", "source string, write string")


def _mark_recorded(spark, warehouse, sources: Sequence[str], known: set[str]) -> None:
    new = [(s, p.write) for s in sources for p in raw_table(spark, warehouse, s).pieces() if p.write not in known]
    if new:
        _marks(spark, warehouse).append(spark.createDataFrame(new, "source string, write string"))
