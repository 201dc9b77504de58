"""Exact dedup: counting quotient filters find repeated fingerprints, bytes confirm them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.llm.common import SPACES, stored, whole_text

FLUSH_ROWS = 1_000_000  # fingerprints that one partial filter takes


class CountingQuotientFilter:
    """Exact multiset of 64-bit fingerprints in quotient form.

    The top ``q`` bits of a fingerprint are its quotient: a bit says whether any
    fingerprint has it, and the remainders of one quotient form a run, sorted,
    whose last slot is marked. Only remainders are stored; a slot has a counter.
    """

    def __init__(self, q: int, occupied: np.ndarray, ends: np.ndarray, remainders: np.ndarray, counts: np.ndarray):
        self.q, self.occupied, self.ends, self.remainders, self.counts = q, occupied, ends, remainders, counts

    @classmethod
    def build(cls, fingerprints: np.ndarray, counts: np.ndarray | None = None) -> CountingQuotientFilter:
        values, place = np.unique(fingerprints.astype(np.uint64), return_inverse=True)
        weights = np.ones(len(fingerprints), np.int64) if counts is None else counts
        total = np.zeros(len(values), np.int64)
        np.add.at(total, place, weights)
        q = max(1, int(len(values)).bit_length())
        quotients = (values >> np.uint64(64 - q)).astype(np.int64)
        occupied = np.zeros(1 << q, bool)
        occupied[quotients] = True
        ends = np.append(quotients[1:] != quotients[:-1], True)[: len(values)]
        return cls(q, occupied, ends, values & np.uint64((1 << (64 - q)) - 1), total)

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted fingerprints and their counts."""
        run = np.cumsum(self.ends) - self.ends  # which run a slot lies in
        quotients = np.flatnonzero(self.occupied).astype(np.uint64)[run]
        return (quotients << np.uint64(64 - self.q)) | self.remainders, self.counts

    @classmethod
    def merge(cls, filters: list[CountingQuotientFilter]) -> CountingQuotientFilter:
        """The filter of all fingerprints together; nothing is lost as quotient and remainder make up the whole."""
        parts = [f.items() for f in filters]
        return cls.build(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))

    def to_row(self) -> tuple[int, bytes, bytes, bytes, bytes]:
        return (
            self.q, np.packbits(self.occupied).tobytes(), np.packbits(self.ends).tobytes(),
            self.remainders.astype("<u8").tobytes(), self.counts.astype("<i8").tobytes(),
        )

    @classmethod
    def from_row(cls, q, occupied, ends, remainders, counts) -> CountingQuotientFilter:
        slots = len(counts) // 8
        return cls(
            int(q),
            np.unpackbits(np.frombuffer(occupied, np.uint8), count=1 << int(q)).astype(bool),
            np.unpackbits(np.frombuffer(ends, np.uint8), count=slots).astype(bool),
            np.frombuffer(remainders, "<u8"),
            np.frombuffer(counts, "<i8"),
        )


FILTER_ROW = "shard long, q int, occupied binary, ends binary, remainders binary, counts binary"


def repeated_fingerprints(fingerprints: DataFrame) -> DataFrame:
    """Values of the long column ``fp`` that occur more than once: fp, n.

    Every task builds filters of its rows, cut by the fingerprints' lowest bits
    into shards; filters of one shard merge in one task. A fingerprint of a
    third of all rows is one slot with a counter per task.
    """
    spark = fingerprints.sparkSession
    shards = 1 << max(2, int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("shard", pa.int64()), ("q", pa.int32())]
            + [(n, pa.binary()) for n in ("occupied", "ends", "remainders", "counts")]
        )

        def flush(parts: list[np.ndarray]) -> pa.RecordBatch:
            values = np.concatenate(parts)
            shard = values & np.uint64(shards - 1)
            order = np.argsort(shard, kind="stable")
            values, shard = values[order], shard[order]
            cuts = np.flatnonzero(np.diff(shard)) + 1
            rows = [
                (int(s[0]), *CountingQuotientFilter.build(v).to_row())
                for v, s in zip(np.split(values, cuts), np.split(shard, cuts), strict=True)
            ]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema
            )

        held, n = [], 0
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            held, n = [*held, values], n + len(values)
            if n >= FLUSH_ROWS:
                yield flush(held)
                held, n = [], 0
        if n:
            yield flush(held)

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        whole = CountingQuotientFilter.merge(
            [CountingQuotientFilter.from_row(*r) for r in rows.drop(columns="shard").itertuples(index=False)]
        )
        values, counts = whole.items()
        return pd.DataFrame({"fp": values[counts > 1].view(np.int64), "n": counts[counts > 1]})

    partial = fingerprints.select("fp").mapInArrow(build, FILTER_ROW)
    return partial.groupBy("shard").applyInPandas(merge, "fp long, n long")


def normalised(column: str = "text") -> Column:
    """The text without ASCII white space; a missing text is empty."""
    return F.translate(whole_text(column), SPACES, "")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """Group of every document among texts equal up to white space.

    Returns doc_id, keep_id, group_size, kept, text_sha256, n_points, one row
    per input row. Of a group the row with most code points stays, then the
    smallest id; a missing id comes last. Rows alike in id, length and
    normalised text are one document and share the answer. Missing and blank
    texts form one group. An empty table gives no rows; other columns are
    ignored.

    Fingerprints that the filters count more than once send their documents to
    byte verification: Spark groups these by the normalised text itself, each
    task combining its own copies first, so a group of a third of all documents
    reaches the final grouping as one row per task.
    """
    text = normalised()
    slim = stored(
        docs.select("doc_id", F.length(whole_text()).alias("points"), text.alias("norm")).select(
            "doc_id", "points", F.xxhash64("norm").alias("fp"), F.sha2(F.col("norm").cast("binary"), 256).alias("sha")
        ),
        "exact-slim",
    )
    repeated = stored(repeated_fingerprints(slim), "exact-repeated").select("fp")
    best = F.struct((-F.col("points")).alias("points"), F.col("doc_id").isNull().alias("no_id"), "doc_id")
    verified = (
        docs.select("doc_id", F.length(whole_text()).alias("points"), text.alias("norm"))
        .withColumn("fp", F.xxhash64("norm"))
        .join(repeated, "fp", "left_semi")
        .groupBy("norm")
        .agg(F.count("*").alias("group_size"), F.min(best).alias("best"))
        .select(F.sha2(F.col("norm").cast("binary"), 256).alias("sha"), "group_size", "best")
    )
    groups = stored(verified, "exact-groups")
    is_best = (F.col("points") == -F.col("best.points")) & F.col("doc_id").eqNullSafe(F.col("best.doc_id"))
    alone = F.col("group_size").isNull()
    return slim.join(groups, "sha", "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | is_best).alias("kept"),
        F.col("sha").alias("text_sha256"),
        F.col("points").cast("long").alias("n_points"),
    )


def without_exact_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of every group of equal texts, all columns kept."""
    key = ["_dup_id", "_dup_sha", "_dup_points"]
    kept = (
        exact_duplicates(docs)
        .filter("kept")
        .groupBy(*[F.col(c).alias(k) for c, k in zip(("doc_id", "text_sha256", "n_points"), key, strict=True)])
        .agg(F.count("*").alias("_dup_rows"))
    )
    hashed = docs.withColumn("_sha", F.sha2(normalised().cast("binary"), 256)).withColumn(
        "_points", F.length(whole_text())
    )
    own = (
        (F.col("_sha") == F.col("_dup_sha"))
        & (F.col("_points") == F.col("_dup_points"))
        & F.col("doc_id").eqNullSafe(F.col("_dup_id"))
    )
    rows = hashed.join(kept, own)
    # Rows alike in id, length and text are rare; of those any one stays.
    alike = rows.filter("_dup_rows > 1").groupBy("_sha").agg(F.first(F.struct(*docs.columns)).alias("row"))
    return rows.filter("_dup_rows = 1").select(*docs.columns).unionByName(alike.select("row.*"))
