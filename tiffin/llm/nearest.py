"""Approximate nearest vectors by inner product: rotated binary codes, multi-index hashing, exact rerank."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffin.llm.common import stored

CODE_BITS = 64  # at most; fewer for shorter vectors
PART_BITS = 8  # bits of a code's substring, each with an index of its own
ROTATIONS = 30  # learning steps
COVER = 0.98  # share of true neighbours in the learning sample that the radius takes in
SAMPLE_ROWS = 8_192  # bound of the learning sample
SAMPLE_QUERIES = 512
BLOCK_ROWS = 32_768  # vectors indexed together
BLOCK_QUERIES = 4_096
BLOCKS_PER_CORE = 2
SEED = 10


@dataclass(frozen=True)
class Codes:
    """Learned binary codes: a centre, a rotated projection, and the radius to search."""

    longest: float  # of all vectors
    centre: np.ndarray
    projection: np.ndarray
    radius: int

    def _lifted(self, vectors: np.ndarray, as_query: bool) -> np.ndarray:
        """Vectors on the unit sphere, where a larger inner product is a smaller angle.

        Stored vectors are scaled by the longest and get one more component that
        fills them up; queries are scaled to length 1 and get a 0.
        """
        if as_query:
            return np.c_[vectors / np.linalg.norm(vectors, axis=1, keepdims=True), np.zeros(len(vectors))]
        scaled = vectors / self.longest
        return np.c_[scaled, np.sqrt(np.maximum(0, 1 - (scaled * scaled).sum(axis=1)))]

    def encode(self, vectors: np.ndarray, as_query: bool) -> np.ndarray:
        bits = (self._lifted(vectors, as_query) - self.centre) @ self.projection > 0
        padded = np.zeros((len(bits), CODE_BITS), dtype=bool)
        padded[:, : bits.shape[1]] = bits
        return np.packbits(padded, axis=1).view(np.uint64).ravel()


def learn_codes(sample: np.ndarray, longest: float, k: int) -> Codes:
    """Principal axes of the sample, rotated so that signs lose least, and a radius.

    The radius takes in ``COVER`` of the sample queries' true neighbours inside
    the sample; among all vectors the true neighbours are closer still.
    """
    bare = Codes(longest, np.zeros(sample.shape[1] + 1), np.zeros((sample.shape[1] + 1, 1)), 0)
    x = bare._lifted(sample, as_query=False)
    centre = x.mean(axis=0)
    bits = min(CODE_BITS, sample.shape[1])
    _, axes = np.linalg.eigh((x - centre).T @ (x - centre))
    axes = axes[:, ::-1][:, :bits]
    z = (x - centre) @ axes
    rotation = np.linalg.qr(np.random.default_rng(SEED).normal(size=(bits, bits)))[0]
    for _ in range(ROTATIONS):
        left, _, right = np.linalg.svd(np.where(z @ rotation > 0, 1.0, -1.0).T @ z)
        rotation = (left @ right).T
    codes = Codes(longest, centre, axes @ rotation, bits)
    if len(sample) < 2:
        return codes
    queries = min(SAMPLE_QUERIES, len(sample))
    scores = sample[:queries] @ sample.T
    np.fill_diagonal(scores, -np.inf)
    k = min(k, len(sample) - 1)
    nearest = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    stored_codes, query_codes = codes.encode(sample, False), codes.encode(sample[:queries], True)
    apart = np.bitwise_count(stored_codes[nearest] ^ query_codes[:, None])
    radius = int(np.quantile(apart, COVER, method="higher"))
    return Codes(longest, centre, codes.projection, radius)


class MultiIndex:
    """Rows of a block by the value of each substring of their codes."""

    def __init__(self, codes: np.ndarray, radius: int):
        self.codes, self.radius = codes, radius
        self.parts = codes.view(np.uint8).reshape(len(codes), -1)
        values = np.arange(1 << PART_BITS, dtype=np.uint8)
        # A code within the radius differs in some substring by no more than this.
        near = radius // self.parts.shape[1]
        self.masks = values[np.bitwise_count(values) <= near]
        self.order = [np.argsort(p, kind="stable").astype(np.int32) for p in self.parts.T]
        self.starts = [np.searchsorted(p[o], np.arange((1 << PART_BITS) + 1)) for p, o in zip(self.parts.T, self.order)]
        self.probed: dict[tuple[int, int], np.ndarray] = {}

    def _probe(self, table: int, value: int) -> np.ndarray:
        """Rows whose substring is near ``value``."""
        found = self.probed.get((table, value))
        if found is None:
            order, starts = self.order[table], self.starts[table]
            found = np.concatenate([order[starts[v] : starts[v + 1]] for v in (self.masks ^ value).tolist()])
            self.probed[table, value] = found
        return found

    def within(self, code: np.uint64) -> np.ndarray:
        """Every row whose code is within the radius."""
        hit = np.zeros(len(self.codes), dtype=bool)
        for table, value in enumerate(np.array([code]).view(np.uint8).tolist()):
            hit[self._probe(table, value)] = True
        rows = np.flatnonzero(hit)
        return rows[np.bitwise_count(self.codes[rows] ^ code) <= self.radius]

    def closest(self, code: np.uint64, n: int) -> np.ndarray:
        """The ``n`` rows with the closest codes, and those as close."""
        apart = np.bitwise_count(self.codes ^ code)
        if n >= len(apart):
            return np.arange(len(apart))
        return np.flatnonzero(apart <= np.partition(apart, n - 1)[n - 1])


def _usable(vector: Column) -> Column:
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")).cast("double"))
    )
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def nearest_vectors(
    vectors: DataFrame, is_query: Column, k: int = 20, item_id: str = "vec_id", item_vector: str = "embedding"
) -> DataFrame:
    """The ``k`` rows of largest inner product for every query row: query_id, rank, vec_id, score.

    ``is_query`` picks the queries among the rows; a query's candidates are the
    rows with another id. Ties go to the smaller id. Rows without an id, and
    vectors that are null, zero, of another length than most, or that hold null
    or non-finite components take no part; repeated rows are found repeatedly
    but ask once. Where rows of one id ask with several vectors, a candidate row
    counts once, with its largest score. An empty table gives no rows; other
    columns are ignored.

    Codes and radius come from a bounded sample, the index holds every row. Rows
    and queries are cut into blocks of bounded size and each block of rows meets
    each block of queries in one task, which indexes the rows, probes each
    substring's index, keeps the codes within the radius, and ranks them by the
    original vectors. A query with fewer than ``k`` codes in the radius of a
    block takes the block's ``k`` closest codes instead. The best ``k`` of each
    task meet in the final ranking.
    """
    spark = vectors.sparkSession
    rows = stored(
        vectors.select(
            F.col(item_id).cast("long").alias("id"),
            F.col(item_vector).cast("array<double>").alias("vector"),
            is_query.alias("asks"),
        ).filter(F.col("id").isNotNull() & _usable(F.col("vector"))),
        "nearest-rows",
    )
    lengths = rows.groupBy(F.size("vector").alias("length")).agg(F.count("*").alias("n"))
    most = lengths.orderBy(F.desc("n"), "length").first()
    if most is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.filter(F.size("vector") == most["length"])
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    longest = rows.agg(F.max(norm).alias("longest")).first()["longest"]
    asked = stored(rows.filter("asks").select("id", "vector").distinct(), "nearest-queries")
    draw = rows.select("vector", F.xxhash64(F.lit(SEED), "id").alias("draw"), "id")
    sample = np.array([r["vector"] for r in draw.orderBy("draw", "id").limit(SAMPLE_ROWS).collect()], dtype=float)
    codes = learn_codes(sample, float(longest), k)

    cores = spark.sparkContext.defaultParallelism
    row_blocks = max(cores * BLOCKS_PER_CORE, -(-most["n"] // BLOCK_ROWS))
    query_blocks = max(1, -(-asked.count() // BLOCK_QUERIES))
    place = F.xxhash64("id", "vector")

    def block(n: int, salt: int) -> Column:
        return F.pmod(F.xxhash64(place, F.lit(salt)), F.lit(n))

    def spread(over: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(over - 1).cast("long")))

    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    items = numbered.withColumn("row_block", block(row_blocks, 1)).withColumn("query_block", spread(query_blocks))
    asked = asked.withColumn("query_block", block(query_blocks, 2)).withColumn("row_block", spread(row_blocks))
    cell = F.col("row_block") * query_blocks + F.col("query_block")
    cells = items.select(cell.alias("cell"), F.lit(False).alias("query"), "id", "vector", "row").unionByName(
        asked.select(cell.alias("cell"), F.lit(True).alias("query"), "id", "vector", F.lit(-1).cast("long").alias("row"))
    )
    schema = T.StructType(
        [T.StructField(n, T.LongType()) for n in ("query_id", "vec_id", "row")] + [T.StructField("score", T.DoubleType())]
    )
    found = cells.groupBy("cell").applyInArrow(_search(codes, k), schema)
    best = found.groupBy("query_id", "vec_id", "row").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(order).cast("int"))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _search(codes: Codes, k: int):
    """The best ``k`` rows of a cell for each of its queries."""

    def search(cell: pa.Table) -> pa.Table:
        asks = cell.column("query").to_numpy()
        ids, rows = cell.column("id").to_numpy(), cell.column("row").to_numpy()
        flat = cell.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        vectors = flat.reshape(len(ids), -1)
        items, item_ids, item_rows = vectors[~asks], ids[~asks], rows[~asks]
        queries, query_ids = vectors[asks], ids[asks]
        out: list[list[np.ndarray]] = [[], [], [], []]
        if len(items) and len(queries):
            index = MultiIndex(codes.encode(items, as_query=False), codes.radius)
            for query, query_id, code in zip(queries, query_ids, codes.encode(queries, as_query=True), strict=True):
                picked = index.within(code)
                picked = picked[item_ids[picked] != query_id]
                if len(picked) < k:
                    own = int((item_ids == query_id).sum())
                    picked = index.closest(code, k + own)
                    picked = picked[item_ids[picked] != query_id]
                # Row by row in one order, so equal vectors tie exactly wherever they are.
                scores = (items[picked] * query).sum(axis=1)
                best = np.lexsort((item_ids[picked], -scores))[:k]
                out[0].append(np.full(len(best), query_id))
                out[1].append(item_ids[picked][best])
                out[2].append(item_rows[picked][best])
                out[3].append(scores[best])
        columns = [np.concatenate(c) if c else np.zeros(0) for c in out]
        types = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
        names = ["query_id", "vec_id", "row", "score"]
        return pa.table([pa.array(c.astype(t.to_pandas_dtype())) for c, t in zip(columns, types, strict=True)], names)

    return search
