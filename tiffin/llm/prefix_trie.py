"""Trie of shared conversation prefixes, read off the sorted distinct conversations and their common prefix lengths.

Every prefix is an interval of the sorted order. Its ends are found by binary search
on range minima of the common prefix lengths (a sparse table per block of the order,
and one over the blocks' minima above it), for each prefix on its own.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiffin.llm.common import stored

BLOCK = 1_024  # conversations under one sparse table
CANDIDATE_DEPTHS = 64  # depths of a block that are searched together
CHUNK_TURNS = 32  # turns compared in the first round of sorting
LONGEST_CHUNK = 8_192
DIGEST = 32  # characters of a turn's digest
SHARED_TURNS = 6  # a conversation takes fewer first turns than this from another one
FAMILY = 100


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _in_order(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` written in ranges of ``order``: adds block (rising with the order) and at (rising in it)."""
    ranged = df.repartitionByRange(_partitions(df), *order).sortWithinPartitions(*order)
    return stored(
        ranged.withColumn("block", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), name
    )


def digested(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, digest of role and text, code points of the text; rows without a conv_id are left out."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.substring(F.sha2(whole.cast("binary"), 256), 1, DIGEST).alias("digest"),
        F.length(text).cast("long").alias("chars"),
    )


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations (conv_id, depth, digest, chars), and all their ids (conv_id).

    Turns are numbered in ranges of (conversation, turn, digest), so one that
    holds a third of all rows is split over blocks; the counts of its earlier
    blocks are added.
    """
    ordered = _in_order(digested(conversations), [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest")], "trie-given")
    parts = ordered.groupBy("conv_id", "block").agg(F.min("at").alias("start"), F.count("*").alias("rows"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    parts = stored(parts.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0))), "trie-parts")
    taken = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(SHARED_TURNS))
    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    sizes = parts.groupBy("conv_id").agg(F.sum("rows").alias("own"))
    ids = sizes.select("conv_id", taken.alias("taken"), family.alias("family"))
    first = sizes.select(F.col("conv_id").alias("family"), F.col("own").alias("has"))
    ids = stored(
        ids.join(first, "family", "left").select(
            "conv_id", "family", "taken", F.least("taken", F.coalesce("has", F.lit(0))).alias("got")
        ),
        "trie-ids",
    )
    placed = parts.join(ids, "conv_id").select("conv_id", "block", "start", "before", "taken", "got")
    numbered = ordered.join(placed, ["conv_id", "block"]).withColumn("place", F.col("at") - F.col("start") + F.col("before") + 1)
    own = numbered.filter("place > taken").select(
        "conv_id", (F.col("place") - F.col("taken") + F.col("got")).alias("depth"), "digest", "chars"
    )
    shared = numbered.filter((F.col("conv_id") == family) & (F.col("place") < SHARED_TURNS)).select(
        F.col("conv_id").alias("family"), F.col("place").alias("depth"), "digest", "chars"
    )
    given = ids.filter("got > 0").join(shared, "family").filter("depth <= got")
    turns = own.unionByName(given.select("conv_id", "depth", "digest", "chars"))
    return stored(turns, "trie-turns"), ids.select("conv_id")


def _classes(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """conv_id and what tells its sequence from others: number of turns and two sums of hashes of (depth, turn)."""
    sums = turns.groupBy("conv_id").agg(
        F.count("*").alias("turns"),
        F.bit_xor(F.xxhash64("depth", "digest")).alias("x"),
        F.bit_xor(F.xxhash64(F.lit("second"), "digest", "depth")).alias("y"),
    )
    empty = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("turns", "x", "y")]
    return ids.join(sums, "conv_id", "left").select("conv_id", *empty)


def _ends(sequences: DataFrame, classes: DataFrame) -> DataFrame:
    """node, ends_sha256: digest of the ids of each class of equal conversations.

    SHA-256 reads its input in order, so the ids of one class pass through one
    task, sorted on disk if need be, one batch held at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node = state = None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"node": [node], "ends_sha256": [state.hexdigest()]})

        for batch in batches:
            for owner, conv_id in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
                if owner != node:
                    if state is not None:
                        yield row()
                    node, state = owner, hashlib.sha256(str(conv_id).encode())
                else:
                    state.update(f",{conv_id}".encode())
        if state is not None:
            yield row()

    alone = classes.filter("weight = 1").select("node", F.sha2(F.col("node").cast("string").cast("binary"), 256).alias("ends_sha256"))
    many = sequences.join(classes.filter("weight > 1").select("node", "turns", "x", "y"), ["turns", "x", "y"])
    streamed = many.select("node", "conv_id").repartition("node").sortWithinPartitions("node", "conv_id")
    return alone.unionByName(streamed.mapInArrow(run, "node long, ends_sha256 string"))


def sorted_order(turns: DataFrame, classes: DataFrame, chunk_turns: int) -> DataFrame:
    """node, i, lcp: the classes in the order of their turns, and the turns each shares with the one before (-1 for the first).

    Sorted by the digests of the first turns; only those that are equal so far
    go on to the next, longer chunk of turns. A chunk is bounded, so no
    conversation is ever held whole.
    """
    order: list[DataFrame] = []
    shared: list[DataFrame] = []
    pending = classes.select("node", F.lit(0).cast("long").alias("run"))
    start, size = 0, chunk_turns
    prefix = F.pandas_udf(
        lambda a, b: pd.Series([len(os.path.commonprefix(p)) // DIGEST for p in zip(a, b, strict=True)], dtype="int64"), "long"
    )
    while True:
        chunk = (
            turns.filter((F.col("depth") > start) & (F.col("depth") <= start + size))
            .join(pending.select("node"), "node", "left_semi")
            .groupBy("node")
            .agg(F.sort_array(F.collect_list(F.struct("depth", "digest"))).alias("rows"))
            .select("node", F.array_join(F.col("rows.digest"), "").alias("key"))
        )
        keyed = pending.join(chunk, "node", "left").select("node", "run", F.coalesce("key", F.lit("")).alias("key"))
        rows = _in_order(keyed, [F.col("run"), F.col("key"), F.col("node")], "trie-sorted")
        # One row per block: what it ends with, and how many rows lie before it.
        edges = rows.groupBy("block").agg(F.max_by(F.struct("run", "key"), "at").alias("last"), F.count("*").alias("n"))
        over = Window.orderBy("block")
        before = over.rowsBetween(Window.unboundedPreceding, -1)
        edges = edges.select(
            "block", F.lag("last").over(over).alias("left"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
        )
        inside = Window.partitionBy("block").orderBy("at")
        linked = stored(
            rows.withColumn("previous", F.lag(F.struct("run", "key")).over(inside))
            .withColumn("number", F.row_number().over(inside) - 1)
            .join(edges, "block")
            .select(
                "node", "run", "key", "block", (F.col("base") + F.col("number")).alias("number"),
                F.coalesce("previous", "left").alias("previous"),
            ),
            "trie-linked",
        )
        starts = linked.groupBy("run").agg(F.min("number").alias("first"))
        same_run = F.col("previous.run") == F.col("run")
        begins = ~F.coalesce(same_run & (F.col("previous.key") == F.col("key")), F.lit(False))
        placed = stored(
            linked.join(starts, "run").select(
                "node", "block", (F.col("run") + F.col("number") - F.col("first")).alias("i"), begins.alias("begins"),
                (F.length("key") == size * DIGEST).alias("goes_on"),
                F.when(F.col("number") == 0, F.lit(-1)).when(same_run & begins, start + prefix("key", F.coalesce("previous.key", F.lit("")))).alias("lcp"),
            ),
            "trie-placed",
        )
        shared.append(placed.filter("lcp is not null" if not start else "lcp >= 0").select("i", F.col("lcp").cast("long").alias("lcp")))
        # Rows equal so far share the place where their run begins, perhaps in an earlier block.
        carried = placed.groupBy("block").agg(F.max(F.when(F.col("begins"), F.col("i"))).alias("latest"))
        carried = carried.select("block", F.max("latest").over(before).alias("carried"))
        to_here = Window.partitionBy("block").orderBy("i")
        runs = placed.join(carried, "block").withColumn(
            "run", F.coalesce(F.max(F.when(F.col("begins"), F.col("i"))).over(to_here), F.col("carried"))
        )
        tied = runs.filter("goes_on").groupBy("run").agg(F.count("*").alias("members")).filter("members > 1").select("run")
        pending = stored(runs.filter("goes_on").join(tied, "run").select("node", "run"), "trie-pending")
        order.append(placed.join(pending.select("node"), "node", "left_anti").select("node", "i"))
        if pending.isEmpty():
            break
        start, size = start + size, min(4 * size, LONGEST_CHUNK)
    whole = reduce(DataFrame.unionByName, order)
    return stored(whole.join(reduce(DataFrame.unionByName, shared), "i"), "trie-order")


def _minima(values: np.ndarray) -> list[np.ndarray]:
    """Sparse table: minima of all ranges whose length is a power of two."""
    out, width = [values], 1
    while 2 * width <= len(values):
        out.append(np.minimum(out[-1][:-width], out[-1][width:]))
        width *= 2
    return out


def _range_minimum(table: list[np.ndarray], start: np.ndarray, end: np.ndarray, empty: int) -> np.ndarray:
    """Minima of [start, end); ``empty`` for empty ranges."""
    size = end - start
    level = np.frexp(np.maximum(size, 1).astype(float))[1] - 1
    out = np.full(len(start), empty, np.int64)
    for k, values in enumerate(table):
        rows = (level == k) & (size > 0)
        out[rows] = np.minimum(values[start[rows]], values[end[rows] - (1 << k)])
    return out


NONE = np.iinfo(np.int64).max
SEARCH_DDL = (
    "i long, depth long, to_right boolean, found boolean, entry long, block long, place long, least long, weight long"
)


def _search(queries: pa.Table, tables: pa.Table) -> pa.Table:
    """Binary search of the queries of one block on its sparse table.

    To the right: the first entry after ``place`` whose value is below the
    depth, with the least conversation and the weights on the way; to the left:
    the last such entry before ``place``.
    """
    held = tables.column("entries")[0].as_py()
    value, least, weight = (np.array([e[c] for e in held], np.int64) for c in ("lcp", "least", "weight"))
    base = held[0]["i"]
    i, depth, block, place = (queries.column(c).to_numpy() for c in ("i", "depth", "block", "place"))
    to_right = queries.column("to_right").to_numpy(zero_copy_only=False)
    table, n = _minima(value), len(value)
    # The first place that may be jumped over, for either direction.
    at = np.where(to_right, place - base + 1, place - base)
    for k in range(len(table) - 1, -1, -1):
        width = 1 << k
        low = np.where(to_right, at, at - width)
        fits = (low >= 0) & (low + width <= n)
        fits[fits] = table[k][low[fits]] >= depth[fits]
        at = np.where(fits, np.where(to_right, at + width, at - width), at)
    found = np.where(to_right, at < n, at > 0)
    entry = np.where(to_right, at, at - 1) + base
    start, end = np.where(to_right, place - base + 1, 0), np.where(to_right, at, 0)
    summed = np.r_[0, np.cumsum(weight)]
    best = np.minimum(queries.column("least").to_numpy(), _range_minimum(_minima(least), start, end, NONE))
    total = queries.column("weight").to_numpy() + np.where(to_right, summed[end] - summed[start], 0)
    return pa.table(
        [pa.array(x) for x in (i, depth, to_right, found, entry, block, place, best, total)],
        names=[c.split()[0] for c in SEARCH_DDL.split(", ")],
    )


def extents(candidates: DataFrame, order: DataFrame, block: int) -> DataFrame:
    """i, depth, to_right, entry, least, weight of every candidate (i, depth, to_right).

    ``order`` has i, lcp, least, weight. To the right, ``entry`` is the first
    place after i outside the prefix of that depth (missing if there is none),
    least and weight are of all conversations up to there; to the left it is
    the prefix's first place. A search that leaves its block goes up to the
    blocks' minima, and from the block found there down again.
    """
    levels, entries = [], order.select("i", "lcp", "least", "weight")
    parent = F.expr(f"i div {block}")
    while True:
        grouped = entries.groupBy(parent.alias("block")).agg(F.sort_array(F.collect_list(F.struct("i", "lcp", "least", "weight"))).alias("entries"))
        levels.append(stored(grouped, "trie-table"))
        if levels[-1].count() <= 1:
            break
        entries = stored(
            entries.groupBy(parent.alias("i")).agg(F.min("lcp").alias("lcp"), F.min("least").alias("least"), F.sum("weight").alias("weight")),
            "trie-level",
        )
    own = order.select("i", "least", "weight")
    pending = candidates.join(own, "i").select(
        "i", "depth", "to_right", parent.alias("block"), F.col("i").alias("place"), "least", "weight"
    )
    depths = F.expr(f"depth div {CANDIDATE_DEPTHS}")

    def searched(queries: DataFrame, level: int) -> DataFrame:
        asked = queries.withColumn("part", depths)
        used = asked.select(F.col("block").alias("table_block"), F.col("part").alias("table_part")).distinct()
        tables = used.join(levels[level].withColumnRenamed("block", "table_block"), "table_block").groupBy("table_block", "table_part")
        found = asked.groupBy("block", "part").cogroup(tables).applyInArrow(_search, SEARCH_DDL)
        return stored(found, "trie-search")

    def below(found: DataFrame) -> DataFrame:
        """The block found one level up, entered from its near end."""
        return found.filter("found").select(
            "i", "depth", "to_right", F.col("entry").alias("block"),
            F.when(F.col("to_right"), F.col("entry") * block - 1).otherwise((F.col("entry") + 1) * block).alias("place"),
            "least", "weight",
        )

    done, downs = [], {}
    for level in range(len(levels)):
        found = searched(pending, level)
        if level:
            downs[level - 1] = below(found)
        else:
            done.append(found.filter("found"))
        pending = found.filter("not found").select(
            "i", "depth", "to_right", F.expr(f"block div {block}").alias("block"), F.col("block").alias("place"), "least", "weight"
        )
    outside = pending.select("i", "depth", "to_right", F.lit(None).cast("long").alias("entry"), "least", "weight")
    for level in range(len(levels) - 2, -1, -1):
        found = searched(downs[level], level)
        if level:
            downs[level - 1] = downs[level - 1].unionByName(below(found))
        else:
            done.append(found)
    columns = ["i", "depth", "to_right", "entry", "least", "weight"]
    return reduce(DataFrame.unionByName, [d.select(*columns) for d in done] + [outside])


def prefix_trie(conversations: DataFrame, block: int = BLOCK, chunk_turns: int = CHUNK_TURNS) -> DataFrame:
    """Nodes of the trie of all rebuilt conversations.

    Returns conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256 (and last_conv_place, the node's last place in the
    order). A conversation c is rebuilt as the first h turns of c - c % 100 and
    its own turns after the first h, h = crc32 of c modulo 6. A node is a
    distinct sequence of first turns, its members the conversations that begin
    with it; the root has depth 0.

    A missing role or text is empty. Turns with equal numbers are ordered by
    the digest of role and text, a missing number first; repeated rows are
    repeated turns. Rows without a conv_id are left out; an empty table gives
    no nodes, a conversation that comes out empty ends at the root. Texts of
    any length are hashed where they lie and never moved. Other columns are
    ignored.
    """
    turns, ids = rebuilt_turns(conversations)
    sequences = stored(_classes(turns, ids), "trie-sequences")
    classes = stored(
        sequences.groupBy("turns", "x", "y").agg(F.min("conv_id").alias("node"), F.count("*").alias("weight")), "trie-classes"
    )
    own = turns.withColumnRenamed("conv_id", "node").join(classes.select("node"), "node", "left_semi")
    own = stored(own, "trie-own")
    order = sorted_order(own, classes, chunk_turns)
    order = order.join(classes.select("node", "turns", "weight"), "node").withColumn("least", F.col("node"))
    following = order.select((F.col("i") - 1).alias("i"), F.col("lcp").alias("next_lcp"))
    order = stored(order.join(following, "i", "left").withColumn("next_lcp", F.coalesce("next_lcp", F.lit(-1))), "trie-order")

    root = order.filter("i = 0").select("node", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("chars"))
    given = own.select("node", "depth", "chars").unionByName(root)
    nodes = given.join(order, "node").filter("depth > lcp")
    # Prefixes that reach beyond their first conversation search their end, first prefixes of a conversation their parent.
    candidates = nodes.filter("depth <= next_lcp").select("i", "depth", F.lit(True).alias("to_right")).unionByName(
        order.filter("i > 0").select("i", F.col("lcp").alias("depth"), F.lit(False).alias("to_right"))
    )
    found = stored(extents(candidates, order, block), "trie-extents")
    last = order.agg(F.max("i").alias("last_place"))
    ends = found.filter("to_right").join(last).select(
        "i", "depth", (F.coalesce(F.col("entry"), F.col("last_place") + 1) - 1).alias("end"), F.col("least").alias("first_conv"),
        F.col("weight").alias("members"),
    )
    parents = found.filter("not to_right").select("i", (F.col("depth") + 1).alias("depth"), F.col("entry").alias("parent"))
    nodes = (
        nodes.join(ends, ["i", "depth"], "left")
        .join(parents, ["i", "depth"], "left")
        .select(
            "i", "depth", "node", "turns", F.coalesce("end", "i").alias("end"),
            F.coalesce("first_conv", "node").alias("conv_id"), F.coalesce("members", "weight").alias("n_convs"),
            F.when(F.col("depth") > 0, F.coalesce("parent", "i")).alias("parent"), "chars",
            ((F.col("depth") == F.col("turns")) & (F.col("next_lcp") < F.col("turns"))).cast("long").alias("leaf"),
        )
        .withColumn("saves", (F.col("n_convs") - 1) * F.col("chars"))
    )
    summed = _running(nodes)
    closing = summed.filter("depth = turns").select(
        F.col("i").alias("end"), F.col("leaves").alias("end_leaves"), F.col("saved").alias("end_saved")
    )
    whole = stored(
        summed.join(closing, "end")
        .withColumn("n_leaves", F.col("end_leaves") - F.col("leaves") + F.col("leaf"))
        .withColumn("saved_tokens", F.col("end_saved") - F.col("saved") + F.col("saves")),
        "trie-nodes",
    )
    children = whole.filter("depth > 0").groupBy(F.col("parent").alias("i"), (F.col("depth") - 1).alias("depth")).agg(
        F.count("*").alias("n_children")
    )
    above = whole.select(F.col("i").alias("parent"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"))
    texts = stored(_ends(sequences, classes), "trie-ends")
    ending = whole.filter("depth = turns").join(texts, "node").select("i", "depth", "ends_sha256")
    return (
        whole.join(children, ["i", "depth"], "left")
        .join(ending, ["i", "depth"], "left")
        .join(above, ["parent", "depth"], "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
            "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
            F.col("end").alias("last_conv_place"),
        )
    )


def _running(nodes: DataFrame) -> DataFrame:
    """Adds leaves and saved, the sums over all nodes up to here in the order of (i, depth), by blocks of that order."""
    ordered = _in_order(nodes, [F.col("i"), F.col("depth")], "trie-preorder")
    sums = ordered.groupBy("block").agg(F.sum("leaf").alias("leaf_sum"), F.sum("saves").alias("save_sum"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("block", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in ("leaf_sum", "save_sum")])
    inside = Window.partitionBy("block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    return (
        ordered.join(bases, "block")
        .withColumn("leaves", F.col("leaf_sum") + F.sum("leaf").over(inside))
        .withColumn("saved", F.col("save_sum") + F.sum("saves").over(inside))
        .drop("block", "at", "leaf_sum", "save_sum")
    )
