"""Parquet tables that can be appended to, replaced and upserted.

A table is a folder of write directories plus numbered snapshot files. A
snapshot lists the directories that make up the table and their schema, and is
written last, so a reader sees all of a write or none of it. A write lands in a
new directory and never touches the files a job is reading. A snapshot is
written under another name and renamed, which HDFS and local file systems do in
one step; on a store without such a rename a reader may meet half a snapshot.
One writer at a time is assumed per table; on HDFS a second one fails on the
snapshot number, elsewhere the callers have to see to it.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffin.sources import keystats

_PART = "_part"
CODEC = "zstd"  # the raw layer is all text
# What is to be shuffled goes in slices of the keys, one after the other, so that a statement's shuffle files are those
# of one slice. Each slice reads the stored rows again, so there are few.
SLICE_BYTES = 32 << 20  # of stored files
MOST_SLICES = 4


class DuplicateKeys(Exception):
    """The rows of an upsert are not unique on its keys."""


@dataclass(frozen=True)
class Piece:
    """One directory of a table: its partition label and its path."""

    part: str
    path: str
    write: str
    # Of a table that keeps statistics of its keys: rows, and least and greatest first key.
    rows: int | None = None
    low: str | None = None
    high: str | None = None


@dataclass(frozen=True)
class Change:
    """What an upsert did: the old versions of the rows it replaced, and its rows. Readable until ``release``,
    which deletes the copy made of its rows, or ``expire``."""

    before: DataFrame
    after: DataFrame
    release: Callable[[], None] = field(default=lambda: None, repr=False, compare=False)

    @staticmethod
    def none(like: DataFrame) -> Change:
        return Change(like.limit(0), like.limit(0))


class LayerTable:
    """``keys``: keep statistics of these columns beside the snapshot, so that an upsert reads only directories
    that may hold its keys (``keystats``); directories written without them are always read."""

    def __init__(
        self, spark: SparkSession, root: str, schema: T.StructType | str | None = None, keys: Sequence[str] = ()
    ) -> None:
        self.spark = spark
        self.keys = list(keys)
        self.root = root.rstrip("/")
        self._declared = T._parse_datatype_string(schema) if isinstance(schema, str) else schema

    # --- snapshots ----------------------------------------------------------

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        fs, path = self._fs(), self._path(folder)
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def _version(self) -> int:
        return max((int(n) for n in self._names(f"{self.root}/snapshots") if n.isdigit()), default=0)

    def version(self) -> int:
        """Number of the newest snapshot."""
        return self._version()

    def _snapshot(self) -> tuple[list[Piece], T.StructType | None]:
        version = self._version()
        return self._load(version) if version else ([], self._declared)

    def _load(self, version: int) -> tuple[list[Piece], T.StructType]:
        stream = self._fs().open(self._path(f"{self.root}/snapshots/{version:08d}"))
        try:
            body = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return [Piece(**p) for p in body["pieces"]], T.StructType.fromJson(body["schema"])

    def _commit(self, pieces: list[Piece], schema: T.StructType) -> None:
        body = json.dumps({"pieces": [asdict(p) for p in pieces], "schema": schema.jsonValue()})
        fs, path = self._fs(), self._path(f"{self.root}/snapshots/{self._version() + 1:08d}")
        # Readers see numbered files only, and a file gets its number when it is whole.
        draft = self._path(f"{self.root}/snapshots/draft-{uuid.uuid4().hex}")
        stream = fs.create(draft, False)
        try:
            stream.write(bytearray(body, "utf-8"))
        finally:
            stream.close()
        if fs.exists(path) or not fs.rename(draft, path):
            fs.delete(draft, False)
            raise FileExistsError(f"another writer has committed {path}")

    # --- reading ------------------------------------------------------------

    def exists(self) -> bool:
        return self._version() > 0

    def pieces(self) -> list[Piece]:
        return self._snapshot()[0]

    def read(self, parts: Sequence[str] | None = None) -> DataFrame:
        """The table, or only the named partitions of it."""
        pieces, schema = self._snapshot()
        wanted = None if parts is None else set(parts)
        return self._frame([p for p in pieces if wanted is None or p.part in wanted], schema)

    def read_pieces(self, pieces: Sequence[Piece]) -> DataFrame:
        return self._frame(list(pieces), self._snapshot()[1])

    def _frame(self, pieces: list[Piece], schema: T.StructType | None) -> DataFrame:
        if schema is None:
            raise FileNotFoundError(f"no table at {self.root}")
        if not pieces:
            return self.spark.createDataFrame([], schema)
        # The schema is known, so no file is opened to infer it; columns that
        # older files lack read as NULL.
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{p.path}" for p in pieces])

    # --- writing ------------------------------------------------------------

    @staticmethod
    def label(value: str) -> str:
        """The partition label of a text value."""
        return re.sub("[^A-Za-z0-9.-]", "_", value)

    def size(self, pieces: Sequence[Piece]) -> int:
        """Bytes of the files of these directories."""
        return sum(stored_bytes(self.spark, f"{self.root}/{p.path}") for p in pieces)

    def _write(self, df: DataFrame | Sequence[DataFrame], part: str, part_by: Column | None) -> list[Piece]:
        """Several frames are written one after the other into the same directories, which nobody reads before they
        are in a snapshot."""
        write = uuid.uuid4().hex
        base = f"data/{write}"
        frames = [df] if isinstance(df, DataFrame) else df
        if part_by is None:
            for frame in frames:
                frame.write.mode("append").option("compression", CODEC).parquet(f"{self.root}/{base}")
            return [Piece(part, base, write)]
        # As label() does.
        labels = F.coalesce(F.regexp_replace(part_by.cast("string"), "[^A-Za-z0-9.-]", "_"), F.lit("none"))
        # Rebalancing gathers a label's rows into few files and splits a label
        # that holds much of the data over several tasks.
        for frame in frames:
            labelled = frame.withColumn(_PART, labels).hint("rebalance", _PART)
            labelled.write.mode("append").option("compression", CODEC).partitionBy(_PART).parquet(f"{self.root}/{base}")
        names = [n for n in self._names(f"{self.root}/{base}") if n.startswith(f"{_PART}=")]
        return [Piece(n[len(_PART) + 1 :], f"{base}/{n}", write) for n in sorted(names)]

    def _described(self, written: list[Piece], schema: T.StructType) -> list[Piece]:
        """The directories just written, with the statistics of their keys."""
        if not self.keys or not written:
            return written
        held = self._frame(written, schema).select(*self.keys, self._directory().alias("path"))
        spans = {r["path"]: r for r in keystats.spans(held, self.keys).collect()}  # a row per directory
        sizes = [(path, keystats.words_for(r["rows"])) for path, r in spans.items()]
        if sizes:
            words = self.spark.createDataFrame(sizes, "path string, words bigint")
            filters = keystats.filters(held, words, self.keys)
            filters.write.option("compression", CODEC).parquet(f"{self.root}/keys/{written[0].write}")
        found = [spans.get(p.path) for p in written]
        return [
            replace(p, rows=r["rows"], low=r["low"], high=r["high"]) if r else replace(p, rows=0)
            for p, r in zip(written, found, strict=True)
        ]

    @staticmethod
    def _directory() -> Column:
        return F.regexp_extract(F.col("_metadata.file_path"), r"(data/[0-9a-f]{32}(?:/_part=[^/]+)?)/[^/]+$", 1)

    def _merged_schema(self, new: T.StructType) -> T.StructType:
        old = self._snapshot()[1]
        if old is None:
            return new
        known = {f.name: f.dataType for f in old}
        clash = [f.name for f in new if f.name in known and known[f.name] != f.dataType]
        if clash:
            raise TypeError(f"{self.root}: type of {clash} differs from the stored table")
        # Files written from now on may lack values for any column.
        fields = list(old) + [f for f in new if f.name not in known]
        return T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])

    def replace(self, df: DataFrame | Sequence[DataFrame], part: str = "all", part_by: Column | None = None) -> None:
        """Make ``df`` the whole content, or the frames of one schema together, which are computed in turn."""
        schema = (df if isinstance(df, DataFrame) else df[0]).schema
        written = self._write(df, part, part_by)
        self._commit(self._described(written, schema), schema)

    def append(self, df: DataFrame, part: str = "all", part_by: Column | None = None) -> str:
        """Add rows; returns the id of the write."""
        schema = self._merged_schema(df.schema)
        written = self._write(df, part, part_by)
        self._commit(self.pieces() + self._described(written, schema), schema)
        return written[0].write if written else ""

    def replace_parts(self, df: DataFrame, parts: Sequence[str], part_by: Column | None = None) -> None:
        """Make ``df`` the whole content of the partitions ``parts``; the others stay."""
        schema = self._merged_schema(df.schema)
        kept = [p for p in self.pieces() if p.part not in set(parts)]
        self._commit(kept + self._described(self._write(df, "all", part_by), schema), schema)

    def upsert(self, df: DataFrame, keys: Sequence[str], part_by: Column | None = None) -> Change:
        """Update the rows whose keys match (a missing key is a key like any other), insert the others.

        ``part_by`` must give the same partition label each time for a row.
        Only partitions that hold a matched key are rewritten; new rows go to
        new directories beside the old ones.
        """
        keys = list(keys)
        schema = self._merged_schema(df.schema)
        incoming = f"{self.root}/incoming/{uuid.uuid4().hex}"
        df.write.option("compression", CODEC).parquet(incoming)  # computed once, however often it is used below
        batch = self.spark.read.schema(df.schema).parquet(incoming)
        twice = batch.groupBy(*keys).count().filter("count > 1").limit(1).collect()
        if twice:
            raise DuplicateKeys(f"{self.root}: {keys} repeat in the new rows, e.g. {twice[0].asDict()}")

        pieces = self.pieces()
        touched = self._parts_with(pieces, batch.select(*keys), keys)
        kept = [p for p in pieces if p.part not in touched]
        number = slices_for(stored_bytes(self.spark, incoming) + self.size([p for p in pieces if p.part in touched]))
        result = in_slices(batch, keys, number)
        before = self._frame([], schema)
        if touched:
            stored = self.read(touched)
            result = [
                _matched(old, new, keys, "left_anti").unionByName(new, allowMissingColumns=True)
                for old, new in zip(in_slices(stored, keys, number), result, strict=True)
            ]
            before = _matched(stored, batch, keys, "left_semi")
        self._commit(kept + self._described(self._write(result, "all", part_by), schema), schema)
        return Change(before, batch, lambda: self._drop(incoming))

    def _drop(self, folder: str) -> None:
        self._fs().delete(self._path(folder), True)

    def candidates(self, pieces: list[Piece], keys_df: DataFrame, keys: list[str]) -> list[Piece]:
        """The directories that may hold any of the keys, without reading one: first those whose range of keys meets
        that of the new rows, then of these the ones whose filter passes some key. So many keys that some would pass
        any filter are asked of the ranges only."""
        known = [p for p in pieces if p.rows is not None] if keys[: len(self.keys)] == self.keys else []
        if not known:
            return pieces
        keys = self.keys
        kind = keys_df.schema[keys[0]].dataType
        asked = keys_df.agg(
            F.count_if(F.expr(" OR ".join(f"`{k}` IS NULL" for k in keys))).alias("missing"),
            F.count("*").alias("n"),
            *[f(keys[0]).cast("string").alias(name) for f, name in ((F.min, "low"), (F.max, "high"))],
        ).first()
        if asked["missing"]:
            return pieces
        low, high = asked["low"], asked["high"]
        ranges = [(p.path, p.low, p.high) for p in known if p.rows]
        met = set()
        if ranges and low is not None:
            stored = self.spark.createDataFrame(ranges, "path string, low string, high string")
            meets = (F.col("high").cast(kind) >= F.lit(low).cast(kind)) & (F.col("low").cast(kind) <= F.lit(high).cast(kind))
            met = {r["path"] for r in stored.filter(meets).collect()}
        near = [p for p in known if p.path in met]
        passed = set(met)
        if near and asked["n"] <= keystats.ASKED_KEYS:
            folders = sorted({f"{self.root}/keys/{p.write}" for p in near})
            held = self.spark.read.schema(keystats.FILTER_SCHEMA).parquet(*folders).filter(F.col("path").isin(sorted(met)))
            sizes = sorted({keystats.words_for(p.rows) for p in near})
            passed = {r["path"] for r in keystats.may_hold(held, keys_df, keys, sizes).collect()}
        return [p for p in pieces if p.rows is None or p not in known or p.path in passed]

    def _parts_with(self, pieces: list[Piece], keys_df: DataFrame, keys: list[str]) -> list[str]:
        """Labels of the partitions that hold any of the keys, from one scan of the key columns of the directories
        that may. Their number is that of the labels, not of the rows."""
        if len({p.part for p in pieces}) < 2:
            return sorted({p.part for p in pieces})
        asked = self.candidates(pieces, keys_df, keys)
        if not asked:
            return []
        stored = self.read_pieces(asked).select(*keys, self._directory().alias("_dir"))
        found = _matched(stored, keys_df, keys, "left_semi").select("_dir")
        by_dir = {p.path: p.part for p in pieces}
        return sorted({by_dir[r["_dir"]] for r in found.distinct().collect()})

    def expire(self, keep: int = 1) -> int:
        """Forget all but the newest ``keep`` snapshots and delete the write
        directories only they used; returns how many were deleted. Not to be run
        while jobs still read an older snapshot."""
        versions = sorted(n for n in self._names(f"{self.root}/snapshots") if n.isdigit())
        fs, used = self._fs(), set()
        for name in versions[-keep:]:
            used |= {p.write for p in self._load(int(name))[0]}
        for name in versions[:-keep]:
            fs.delete(self._path(f"{self.root}/snapshots/{name}"), False)
        gone = [f"{kind}/{w}" for kind in ("data", "keys") for w in self._names(f"{self.root}/{kind}") if w not in used]
        gone += [f"incoming/{w}" for w in self._names(f"{self.root}/incoming")]
        for folder in gone:
            fs.delete(self._path(f"{self.root}/{folder}"), True)
        return len(gone)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of the files in a folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()


def slices_for(size: int) -> int:
    """In how many slices rows of so many stored bytes are shuffled."""
    return max(1, min(MOST_SLICES, -(-size // SLICE_BYTES)))


def in_slices(df: DataFrame, keys: Sequence[Column | str], number: int) -> list[DataFrame]:
    """The rows dealt by a hash of their keys; equal keys are together, missing ones too."""
    if number == 1:
        return [df]
    place = F.pmod(F.xxhash64(F.lit("slice"), *keys), F.lit(number))
    return [df.filter(place == i) for i in range(number)]


def _matched(stored: DataFrame, batch: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Rows of ``stored`` with (or without) a partner in ``batch``; missing keys are equal."""
    asked = batch.select(*[F.col(k).alias(f"_asked_{i}") for i, k in enumerate(keys)])
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_asked_{i}")) for i, k in enumerate(keys)])
    return stored.join(asked, same, how)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def incremental_rows(
    source: DataFrame, target: LayerTable, time_column: str, lookback: str | None = None, target_time: str | None = None
) -> DataFrame:
    """Source rows newer than the newest row of the target.

    The first run takes everything. Rows that arrive late, at or before the
    newest stored time, are left out unless ``lookback`` (an interval such as
    ``'3 days'``) reaches back to them. The newest time becomes a literal, so
    the filter reaches the scan of the source.
    """
    if not target.exists():
        return source
    newest = newest_time(target.read(), target_time or time_column)
    return newer_than(source, time_column, newest, lookback)


def newest_time(df: DataFrame, time_column: str) -> str:
    start = F.to_timestamp_ntz(F.lit("1900-01-01 00:00:00"))
    newest = df.agg(F.coalesce(F.max(F.col(time_column).cast("timestamp_ntz")), start).cast("string"))
    return newest.first()[0]


def newer_than(source: DataFrame, time_column: str, newest: str, lookback: str | None = None) -> DataFrame:
    bound = f"timestamp_ntz'{newest}'" + (f" - interval {lookback}" if lookback else "")
    return source.filter(F.col(time_column) > F.expr(bound))


def merged(base: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``base`` with the rows of ``batch`` put in by key, as a frame."""
    kept = base.join(batch.select(*keys), list(keys), "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True)
