"""Exact nearest vectors by cosine similarity."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

QUERIES_PER_BLOCK = 4_096  # queries that meet a block of items at a time
ITEMS_PER_BLOCK = 65_536  # items of a block
QUERIES_PER_SLICE = 64  # queries scored at a time
SCORE_DIGITS = 12  # equal vectors must tie, whatever block they are scored in


def cosine_topk(
    store: DataFrame,
    queries: DataFrame,
    k: int,
    item_id: str = "chunk_id",
    item_vector: str = "vector",
    query_id: str = "query_id",
    query_vector: str = "vector",
) -> DataFrame:
    """The ``k`` best items of every query: query id, item id, score, rank.

    The store is scanned once for any number of queries. Items and queries are
    dealt into blocks by their numbers and by the hash of id and vector, so an id
    with many vectors spreads too; each block of items meets each block of queries in one
    task, which keeps the best ``k`` per query, and only those are ranked
    together. Ties go to the smaller id; a vector without length scores 0. A
    missing vector takes no part; one that is of another length than the rest
    of its block, or that holds a missing number, raises with its id.
    """
    asked = queries.select(query_id, query_vector).filter(F.col(query_vector).isNotNull())
    query_blocks = max(1, -(-asked.count() // QUERIES_PER_BLOCK))
    item_blocks = max(1, -(-store.count() // ITEMS_PER_BLOCK))
    schema = T.StructType(
        [
            T.StructField(query_id, asked.schema[0].dataType),
            T.StructField(item_id, store.schema[item_id].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )

    def dealt(n: int, *keys: str) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("long")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    none = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields[:2]}
    vector = "array<double>"
    items = (
        store.filter(F.col(item_vector).isNotNull())
        .select(
            none[query_id].alias("_query"), F.col(item_id).alias("_item"),
            F.col(item_vector).cast(vector).alias("_vector"), dealt(item_blocks, item_id, item_vector).alias("_left"),
        )
        .withColumn("_right", every(query_blocks))
    )
    sent = (
        asked.select(
            F.col(query_id).alias("_query"), none[item_id].alias("_item"),
            F.col(query_vector).cast(vector).alias("_vector"), dealt(query_blocks, query_id, query_vector).alias("_right"),
        )
        .withColumn("_left", every(item_blocks))
        .select("_query", "_item", "_vector", "_left", "_right")
    )
    cells = items.withColumn("_asks", F.lit(False)).unionByName(sent.withColumn("_asks", F.lit(True)))
    fields = [(f.name, to_arrow_type(f.dataType)) for f in schema]
    found = cells.groupBy("_left", "_right").applyInArrow(_best(k, fields), schema)
    w = Window.partitionBy(query_id).orderBy(F.desc("score"), F.asc(item_id))
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _best(k: int, fields: list[tuple[str, pa.DataType]]):
    """The best ``k`` items of a cell for each of its queries."""

    def best(cell: pa.Table) -> pa.Table:
        asks = cell.column("_asks")
        questions, items = cell.filter(asks), cell.filter(pc.invert(asks))
        out: list[tuple] = []
        if questions.num_rows and items.num_rows:
            unit = _unit(_matrix(questions, "_query"))
            vectors, names = _matrix(items, "_item", unit.shape[1]), items.column("_item").to_pylist()
            place = np.argsort(np.argsort(np.array(names, dtype=object), kind="stable"), kind="stable")
            vectors, asked = _unit(vectors), questions.column("_query").to_pylist()
            for at in range(0, len(unit), QUERIES_PER_SLICE):
                scores = np.round(unit[at : at + QUERIES_PER_SLICE] @ vectors.T, SCORE_DIGITS)
                for q, row in zip(asked[at : at + QUERIES_PER_SLICE], scores, strict=True):
                    picks = np.arange(len(row))
                    if k < len(row):
                        picks = np.flatnonzero(row >= np.partition(row, -k)[-k])
                    picks = picks[np.lexsort((place[picks], -row[picks]))][:k]
                    out += [(q, names[i], row[i]) for i in picks]
        return pa.table(
            [pa.array([r[i] for r in out], type=t) for i, (_, t) in enumerate(fields)], [n for n, _ in fields]
        )

    return best


def _matrix(rows: pa.Table, name: str, length: int | None = None) -> np.ndarray:
    """The vectors as rows; one of another length, or with a missing number, raises."""
    vectors = rows.column("_vector").combine_chunks()
    lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    length = lengths[0] if length is None else length
    odd = np.flatnonzero(lengths != length)
    if len(odd):
        raise ValueError(
            f"vector of {rows.column(name)[int(odd[0])].as_py()!r} has {lengths[odd[0]]} numbers, not {length}"
        )
    flat = vectors.flatten()
    if flat.null_count:
        at = int(np.flatnonzero(flat.is_null().to_numpy(zero_copy_only=False))[0]) // int(length)
        raise ValueError(f"vector of {rows.column(name)[at].as_py()!r} holds a missing number")
    return flat.to_numpy(zero_copy_only=False).reshape(len(lengths), -1)


def _unit(m: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; rows without length stay 0."""
    length = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return np.divide(m, length, out=np.zeros_like(m), where=length > 0)
