"""Nearest vectors by cosine through an inverted file: k-means cells, search in the nearest of them, exact scores.

The cells come from a bounded sample; every item is put in its cell. A search of all
cells gives what ``cosine_topk`` gives.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tiffin.operators.topk import ITEMS_PER_BLOCK, QUERIES_PER_BLOCK, _best, _unit
from tiffin.session import scratch_dir

MAX_CELLS = 1_024  # so many centroids travel with the tasks at most
SAMPLE = 100_000  # items that the cells are learned from, by their hash
SEED = 11
_VECTOR = "array<double>"


@dataclass(frozen=True)
class CellIndex:
    """Unit centroids, and the items with their cell: item id, vector, cell."""

    centroids: np.ndarray
    items: DataFrame
    item_id: str


def _usable(vector: str) -> Column:
    return F.col(vector).isNotNull() & F.exists(F.col(vector), lambda x: x != 0)


def _nearest_cells(centroids: np.ndarray, vector: Column, probes: int) -> Column:
    """The cells of the ``probes`` nearest centroids, nearest first."""
    if len(centroids) == 1:
        return F.array(F.lit(0))

    def nearest(vectors: pd.Series) -> pd.Series:
        if not len(vectors):
            return pd.Series([], dtype=object)
        scores = _unit(np.stack(vectors.to_numpy()).astype(float)) @ centroids.T
        return pd.Series(np.argsort(-np.round(scores, 12), axis=1, kind="stable")[:, :probes].tolist())

    return F.pandas_udf(nearest, "array<int>")(vector)


def build_index(
    store: DataFrame, cells: int | None = None, item_id: str = "chunk_id", item_vector: str = "vector", sample: int = SAMPLE
) -> CellIndex:
    """Cells of ``store`` by k-means on the unit vectors of at most ``sample`` items.

    ``cells`` is about the root of the number of items if not given, and no more
    than ``MAX_CELLS``. Vectors without length are put in the cell that the
    nearest-cell rule gives them and score 0 in a search; missing ones take no
    part. Vectors of unlike lengths raise.
    """
    held = store.filter(F.col(item_vector).isNotNull()).select(item_id, F.col(item_vector).cast(_VECTOR).alias("vector"))
    rows = held.count()
    cells = min(MAX_CELLS, cells or max(1, round(rows**0.5)))
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    unit = held.filter(_usable("vector")).select(
        F.transform("vector", lambda x: x / length).alias("unit"), F.xxhash64(item_id, "vector").alias("draw")
    )
    if rows > sample:
        unit = unit.filter(F.col("draw") / F.lit(2.0**64) + 0.5 < F.lit(2.0 * sample) / rows).orderBy("draw").limit(sample)
    learned = unit.select(array_to_vector("unit").alias("features"))
    if learned.isEmpty():
        centroids = np.zeros((1, 1))
        return CellIndex(centroids, held.withColumn("cell", F.lit(0)), item_id)
    model = KMeans(k=cells, seed=SEED, maxIter=15, distanceMeasure="cosine").fit(learned)
    centroids = _unit(np.array(model.clusterCenters()))
    # Written, as every search reads the items twice.
    path = scratch_dir(store.sparkSession, "ivf-items")
    held.withColumn("cell", _nearest_cells(centroids, F.col("vector"), 1)[0]).write.parquet(path)
    return CellIndex(centroids, store.sparkSession.read.parquet(path), item_id)


def search(
    index: CellIndex, queries: DataFrame, k: int, probes: int, query_id: str = "query_id", query_vector: str = "vector"
) -> DataFrame:
    """The ``k`` best items of every query among the ``probes`` nearest cells: query id, item id, score, rank.

    With as many probes as cells the answer is exact. A cell is cut into blocks
    by its size, its queries into blocks by theirs; each two meet in a task.
    Ties go to the smaller id.
    """
    item_id, items = index.item_id, index.items
    asked = queries.filter(F.col(query_vector).isNotNull()).select(
        F.col(query_id).alias("_query"), F.col(query_vector).cast(_VECTOR).alias("_vector")
    )
    probed = asked.withColumn("_cell", F.explode(_nearest_cells(index.centroids, F.col("_vector"), probes)))
    schema = T.StructType(
        [
            T.StructField(query_id, asked.schema[0].dataType),
            T.StructField(item_id, items.schema[item_id].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )
    # A row per cell: how many blocks of items and of queries it has.
    blocks = lambda n, size: F.ceil(n / size).cast("int")
    sizes = items.groupBy(F.col("cell").alias("_cell")).agg(blocks(F.count("*"), ITEMS_PER_BLOCK).alias("_lefts"))
    asks = probed.groupBy("_cell").agg(blocks(F.count("*"), QUERIES_PER_BLOCK).alias("_rights"))
    met = sizes.join(asks, "_cell")
    other = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    dealt = lambda n, *keys: F.pmod(F.xxhash64(*keys), F.col(n)).cast("int")
    none = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields[:2]}
    left = items.withColumnRenamed("cell", "_cell").join(met, "_cell").select(
        "_cell", none[query_id].alias("_query"), F.col(item_id).alias("_item"), F.col("vector").alias("_vector"),
        dealt("_lefts", item_id, "vector").alias("_left"), other("_rights").alias("_right"), F.lit(False).alias("_asks"),
    )
    right = probed.join(met, "_cell").select(
        "_cell", "_query", none[item_id].alias("_item"), "_vector", other("_lefts").alias("_left"),
        dealt("_rights", "_query", "_vector").alias("_right"), F.lit(True).alias("_asks"),
    )
    fields = [(f.name, to_arrow_type(f.dataType)) for f in schema]
    found = left.unionByName(right).groupBy("_cell", "_left", "_right").applyInArrow(_best(k, fields), schema)
    w = Window.partitionBy(query_id).orderBy(F.desc("score"), F.asc(item_id))
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def recall(found: DataFrame, exact: DataFrame, query_id: str = "query_id", item_id: str = "chunk_id") -> float:
    """Share of the exact answers that were found."""
    hits = exact.select(query_id, item_id).join(found.select(query_id, item_id), [query_id, item_id], "left_semi").count()
    return hits / max(1, exact.count())


def probes_for(
    index: CellIndex, queries: DataFrame, k: int, wanted: float, query_id: str = "query_id", query_vector: str = "vector"
) -> int:
    """The fewest probes, in steps of half as many again, that reach the recall ``wanted`` on these queries.

    All cells reach 1. Clustered vectors need few; vectors without structure
    need most, as no cell is then far from any query.
    """
    cells, probes = len(index.centroids), 1
    exact = search(index, queries, k, cells, query_id, query_vector)
    while probes < cells:
        found = search(index, queries, k, probes, query_id, query_vector)
        if recall(found, exact, query_id, index.item_id) >= wanted:
            break
        probes = min(cells, max(probes + 1, probes * 3 // 2))
    return probes
