"""Set-similarity join of word n-gram sets by PartEnum signatures.

Sets are put in overlapping size bands, so that any two similar ones share a band.
A band bounds how many elements two similar sets may differ in. The hashed domain of
n-grams is split into partitions, in groups; of each group every subset of partitions
that may be left untouched by the differences is enumerated. What a set has in such a
subset is one signature, and by the pigeonhole principle similar sets share one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.llm.common import stored, task_memory, whole_text
from tiffin.llm.near_dedup import (
    PACKED_ROWS,
    ROWS,
    WordHashes,
    _confirmed,
    _mixed,
    _packed,
    _sizes_fit,
    _texts_of,
    _unpacked,
    components,
    shingle_set,
    text_hash,
)

WIDTH = 2  # largest size of a band over its smallest
PAIRS_UP_TO = 8  # differences up to which one group has all partitions, and pairs of them are signatures
THIRDS_UP_TO = 40  # up to which groups have three partitions; beyond, two
SPARE = 1.06  # groups beyond what the pigeonhole needs, for those with too few elements
BLOCK_MEMBERS = 1024  # classes of a cell that one task compares with as many
RANGE_SHINGLES = 2_000_000  # shingles whose signatures one task sorts
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
SECOND = np.uint64(0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class Band:
    """Sizes low to high; ``groups`` of ``parts`` partitions each, of which at most ``broken`` may differ in the agreeing group."""

    number: int
    low: int
    high: int
    differences: int
    groups: int
    parts: int
    broken: int


@lru_cache(maxsize=None)
def band(number: int, percent: int) -> Band:
    """Bands overlap so far that a set of any size shares one with all sets similar to it."""
    low = 1 if number == 0 else band(number - 1, percent).high * percent // 100 + 1
    high = WIDTH * low
    d = differences(high, high, percent)
    if d <= PAIRS_UP_TO:
        return Band(number, low, high, d, 1, d + 3, d)
    groups = int(-(-SPARE * (d + 1) // 2)) + 1
    return Band(number, low, high, d, groups, 3 if d <= THIRDS_UP_TO else 2, 1)


def differences(a: int, b: int, percent: int) -> int:
    """Elements that two similar sets of these sizes can have apart at most."""
    return (a + b) * (100 - percent) // (100 + percent)


def bands_of(size: int, percent: int) -> list[Band]:
    found, number = [], 0
    while (b := band(number, percent)).low <= size:
        if size <= b.high:
            found.append(b)
        number += 1
    return found


@lru_cache(maxsize=None)
def _subsets(parts: int, keep: int) -> np.ndarray:
    return np.array(list(combinations(range(parts), keep)), np.int64)


def contents(shingles: np.ndarray, percent: int) -> np.ndarray:
    """32-bit digests of what a sorted set of hashes has in each partition, of all its bands in a row; 0 where it has nothing.

    Bands in which similar sets are equal have none.
    """
    out = []
    sums = np.r_[np.zeros(1, np.uint64), np.cumsum(_mixed(shingles * SECOND + GOLDEN), dtype=np.uint64)]
    for b in _open_bands(len(shingles), percent):
        total = b.groups * b.parts
        # Partitions are ranges of the hash.
        edges = np.arange(1, total, dtype=np.float64) * (2.0**64 / total)
        ends = np.r_[0, np.searchsorted(shingles, edges.astype(np.uint64)), len(shingles)]
        digest = (_mixed((sums[ends[1:]] - sums[ends[:-1]]) * GOLDEN) >> np.uint64(32)).astype(np.uint32)
        out.append(np.where(np.diff(ends) > 0, np.maximum(digest, 1), 0).astype(np.uint32))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


@lru_cache(maxsize=1 << 14)
def _open_bands(size: int, percent: int) -> list[Band]:
    return [b for b in bands_of(size, percent) if b.differences]


def _in_bands(held: np.ndarray, size: int, percent: int) -> Iterator[tuple[Band, np.ndarray]]:
    """The bands of a set of this size, each with its part of the set's ``contents``."""
    at = 0
    for b in _open_bands(size, percent):
        yield b, held[at : at + b.groups * b.parts]
        at += b.groups * b.parts


def signatures(shingles: np.ndarray, percent: int) -> np.ndarray:
    """64-bit signatures of a sorted set of hashes."""
    return signatures_of(contents(shingles, percent), len(shingles), percent)


def signatures_of(held: np.ndarray, n: int, percent: int) -> np.ndarray:
    """64-bit signatures, of all its bands, of the set of ``n`` elements with these ``contents``.

    Signatures of subsets without an element are left out where enough groups
    have elements: of the ``rich`` groups (elements in more partitions than may
    be broken) the differences can spoil at most ``differences / (broken + 1)``,
    so with more rich groups than that some signature with elements is shared.
    """
    out = []
    for b, own in _in_bands(held, n, percent):
        place = np.arange(len(own), dtype=np.uint64) + np.uint64(b.number << 40)
        content = _mixed(own.astype(np.uint64) * GOLDEN + place).reshape(b.groups, b.parts)
        some = (own > 0).reshape(b.groups, b.parts)
        keep = min(2, b.parts - b.broken)
        subsets = _subsets(b.parts, keep)
        value = content[:, subsets[:, 0]]
        for column in range(1, keep):
            value = value * SECOND + content[:, subsets[:, column]]
        posted = some[:, subsets].any(axis=2)
        rich = int((some.sum(axis=1) > b.broken).sum())
        most = min(b.high, n * 100 // percent)
        if rich <= differences(n, most, percent) // (b.broken + 1):
            posted[:] = True
        out.append(_mixed(value)[posted])
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def may_link(x: np.ndarray, n_x: int, y: np.ndarray, n_y: int, percent: int) -> bool:
    """Whether sets of these sizes and contents can be similar: an element that only one has spoils one partition."""
    if 100 * min(n_x, n_y) < percent * max(n_x, n_y):
        return False
    apart, others = differences(n_x, n_y, percent), {b.number: own for b, own in _in_bands(y, n_y, percent)}
    return any(
        b.number in others and int((own != others[b.number]).sum()) <= apart for b, own in _in_bands(x, n_x, percent)
    )


def _with_partners(
    held: list[np.ndarray], n: np.ndarray, root: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int
) -> np.ndarray:
    """Which members may link with one of another component on the other side, as ``may_link`` has it."""
    found, by_band = np.zeros(len(n), bool), {}
    for side, members in enumerate((left, right)):
        for i in members:
            for b, own in _in_bands(held[i], int(n[i]), percent):
                by_band.setdefault(b.number, ([], []))[side].append((i, own))
    for lefts, rights in by_band.values():
        if not lefts or not rights:
            continue
        rights.sort(key=lambda r: n[r[0]])
        at, grid = np.array([i for i, _ in rights]), np.stack([own for _, own in rights])
        sizes, roots = n[at], root[at]
        for i, own in lefts:
            low, high = np.searchsorted(100 * sizes, percent * n[i], "left"), np.searchsorted(percent * sizes, 100 * n[i], "right")
            apart = (grid[low:high] != own).sum(axis=1)
            near = (apart <= (n[i] + sizes[low:high]) * (100 - percent) // (100 + percent)) & (roots[low:high] != root[i])
            if near.any():
                found[i] = True
                found[at[low:high][near]] = True
    return found


def _near_pairs(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that ``may_link`` lets through."""

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("parts_a", "n_a", "parts_b", "n_b")]
            near = [
                may_link(np.frombuffer(x, np.uint32), n_x, np.frombuffer(y, np.uint32), n_y, percent)
                for x, n_x, y, n_y in zip(*columns, strict=True)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    for side in "ab":
        named = classes.select(F.col("node").alias(side), F.col("n_shingles").alias(f"n_{side}"), F.col("parts").alias(f"parts_{side}"))
        pairs = pairs.join(named, side)
    return pairs.mapInArrow(test, "a binary, b binary")


def _cells(met: DataFrame, roots: DataFrame) -> DataFrame:
    """cell, node, root, n_shingles: the classes that meet one smallest member, and this member.

    Two classes of a list both meet the list's smallest member, so they share
    its cell. Near copies share hundreds of lists, but these have few smallest
    members, so a pair is compared a few times at most.
    """
    smallest = met.select(F.col("b").alias("cell"), F.col("b").alias("node"), F.col("n_b").alias("n_shingles")).distinct()
    meeting = met.select(F.col("b").alias("cell"), F.col("a").alias("node"), F.col("n_a").alias("n_shingles"))
    members = meeting.unionByName(smallest).join(roots, "node", "left")
    return stored(members.select("cell", "node", F.coalesce("root", "node").alias("root"), "n_shingles"), "join-cells")


def _linked_in_cells(cells: DataFrame, classes: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) that join different components of a cell, each two blocks of its members compared on their own.

    First the contents of partitions tell which members may link at all, then the texts of these are read.
    """

    def open_members(cell: pa.Table) -> pa.Table:
        n = cell.column("n_shingles").to_numpy()
        held = [np.frombuffer(p, np.uint32) for p in cell.column("parts").to_pylist()]
        _, root = np.unique(cell.column("root").to_pylist(), return_inverse=True)
        is_left = cell.column("is_left").to_numpy(zero_copy_only=False)
        near = _with_partners(held, n, root, np.flatnonzero(is_left), np.flatnonzero(~is_left), percent)
        return cell.select(["cell", "l", "r", "node", "root", "n_shingles", "is_left"]).filter(pa.array(near))

    def compare(cell: pa.Table) -> pa.Table:
        hashes = WordHashes()
        node, n = cell.column("node").to_pylist(), cell.column("n_shingles").to_numpy()
        sets = [shingle_set(t, words, hashes) for t in cell.column("text").to_pylist()]
        _, root = np.unique(cell.column("root").to_pylist(), return_inverse=True)
        is_left = cell.column("is_left").to_numpy(zero_copy_only=False)
        left, right = np.flatnonzero(is_left), np.flatnonzero(~is_left)
        if not len(left) or not len(right):
            return pa.table({"a": pa.array([], pa.binary()), "b": pa.array([], pa.binary())})
        a, b = _links(sets, n, root, left, right, percent)
        return pa.table({"a": pa.array([node[i] for i in a], pa.binary()), "b": pa.array([node[j] for j in b], pa.binary())})

    # Members outside the largest component of a cell, in blocks, meet all members, in blocks.
    by_root = cells.groupBy("cell", "root").agg(F.count("*").alias("n"))
    sizes = by_root.groupBy("cell").agg(F.sum("n").alias("size"), F.max(F.struct("n", "root")).alias("major"))
    blocks = lambda n: F.ceil(n / BLOCK_MEMBERS).cast("long")
    sizes = sizes.filter(F.col("size") > F.col("major.n")).select(
        "cell", F.col("major.root").alias("major"), blocks(F.col("size")).alias("rights"),
        blocks(F.col("size") - F.col("major.n")).alias("lefts"),
    )
    placed = cells.join(sizes, "cell").join(classes.select("node", "parts"), "node")
    block = lambda n: F.pmod(F.xxhash64("node"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    columns = ["cell", "node", "root", "n_shingles", "parts"]
    minor = placed.filter(F.col("root") != F.col("major")).select(
        *columns, block("lefts").alias("l"), every("rights").alias("r"), F.lit(True).alias("is_left")
    )
    whole = placed.select(*columns, every("lefts").alias("l"), block("rights").alias("r"), F.lit(False).alias("is_left"))
    grouped = minor.unionByName(whole).groupBy("cell", "l", "r")
    near = "cell binary, l long, r long, node binary, root binary, n_shingles long, is_left boolean"
    near = stored(grouped.applyInArrow(open_members, near), "join-near")
    texts = _texts_of(near.select("node").distinct(), classes, docs)
    return near.join(texts, "node").groupBy("cell", "l", "r").applyInArrow(compare, "a binary, b binary").distinct()


def _links(
    sets: list[np.ndarray], n: np.ndarray, root: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int
) -> tuple[list[int], list[int]]:
    """Similar pairs of a left and a right member, as few as join what is linked.

    The elements of the right sets in order give, for each left set, how often
    each right member shares one.
    """
    parent = list(range(int(root.max()) + 1))

    def top(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    values = np.concatenate([sets[j] for j in right])
    owners = np.repeat(np.arange(len(right)), [len(sets[j]) for j in right])
    order = np.argsort(values, kind="stable")
    values, owners = values[order], owners[order]
    a, b = [], []
    for i in left:
        now = np.array([top(r) for r in root[right]]) if len(a) else root[right]
        other = now != top(int(root[i]))
        fits = other & (100 * np.minimum(n[i], n[right]) >= percent * np.maximum(n[i], n[right]))
        if not fits.any():
            continue
        start, end = np.searchsorted(values, sets[i], "left"), np.searchsorted(values, sets[i], "right")
        size = end - start
        places = np.repeat(start - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
        both = np.bincount(owners[places], minlength=len(right))
        for j in np.flatnonzero(fits & (100 * both >= percent * (n[i] + n[right] - both))):
            x, y = top(int(root[i])), top(int(root[right[j]]))
            if x != y:
                parent[x] = y
                a.append(int(i))
                b.append(int(right[j]))
    return a, b


SKETCH_DDL = "doc_id long, text_hash string, n_shingles long, node binary, parts binary"


def _node(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def sketch(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, node (digest of the set) and parts (its ``contents``); both null for an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        with task_memory():
            for batch in batches:
                for at in range(0, batch.num_rows, ROWS):
                    part, sizes, nodes, parts = batch.slice(at, ROWS), [], [], []
                    for text in part.column("text").to_pylist():
                        found = shingle_set(text, words, hashes)
                        sizes.append(len(found))
                        nodes.append(_node(found) if len(found) else None)
                        parts.append(contents(found, percent).tobytes() if len(found) else None)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id"), part.column("text_hash"), pa.array(sizes, pa.int64()),
                         pa.array(nodes, pa.binary()), pa.array(parts, pa.binary())],
                        ["doc_id", "text_hash", "n_shingles", "node", "parts"],
                    )
            hashes.clear()

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("text_hash"), whole_text().alias("text"))
    return texts.mapInArrow(run, SKETCH_DDL)


def shared_signatures(classes: DataFrame, percent: int, ranges: int) -> DataFrame:
    """Sets that share signatures: a set (a), the smallest set of a list (b), and in how many lists (n) they meet so.

    Sets go by the first 64 bits of their digests (owner). Signatures travel as packed arrays, one row per range of values
    and flush of a task.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        with task_memory():
            for batch in batches:
                columns = [batch.column(c).to_pylist() for c in ("owner", "n_shingles", "parts")]
                for owner, n, parts in zip(*columns, strict=True):
                    posted = signatures_of(np.frombuffer(parts, np.uint32), n, percent)
                    held.append((posted, np.full(len(posted), owner, np.int64)))
                    size += len(posted)
                    if size >= PACKED_ROWS:
                        yield _packed(held, lambda token, _: token, ranges)
                        held, size = [], 0
            if held:
                yield _packed(held, lambda token, _: token, ranges)

    def collide(rows: pa.Table) -> pa.Table:
        token, owner = _unpacked(rows)
        order = np.lexsort((owner, token))
        token, owner = token[order], owner[order]
        new_token = np.r_[True, token[1:] != token[:-1]] if len(token) else np.zeros(0, bool)
        distinct = new_token | np.r_[True, owner[1:] != owner[:-1]] if len(token) else new_token
        token, owner = token[distinct], owner[distinct]
        _, first, place, times = np.unique(token, return_index=True, return_inverse=True, return_counts=True)
        several = times[place] > 1
        hub = owner[first][place]
        meets = several & (owner != hub)
        met, n_met = np.unique(np.c_[owner[meets], hub[meets]], axis=0, return_counts=True)
        return pa.table([pa.array(met[:, 0]), pa.array(met[:, 1]), pa.array(n_met.astype(np.int64))], ["a", "b", "n"])

    dealt = classes.select("owner", "n_shingles", "parts").mapInArrow(deal, "range long, shingles binary, owners binary")
    return dealt.groupBy("range").applyInArrow(collide, "a long, b long, n long")


def jaccard_join(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Documents linked by similar sets of word n-grams: doc_id, n_shingles, component_id, one row per input row.

    Two documents link when ``100 * intersection >= percent * union``; the
    component's id is the smallest reachable one, a missing id being larger than
    any other. A text with fewer words is one n-gram, one without words links
    with nothing and is its own component. Texts of any length are read whole;
    repeated rows repeat, an empty table gives no rows, other columns are
    ignored.

    Equal sets are one class from the start. Classes with a signature in common
    are candidates, and every link is confirmed on the whole sets. In each list
    of a signature all classes first meet one member, and the member that a
    class meets in most lists is confirmed. Then all that meet one such member
    are a cell; in cells that still hold several components, the classes
    outside the largest one are compared with all. Cells are cut into blocks,
    two blocks meet in a task, and no pair is left out for the size of a list.
    Texts are read only of classes that have as many partitions alike with
    another one as similar sets of their sizes must have.
    """
    sketches = stored(sketch(docs, words, percent), "join-sketch")
    classes = stored(
        sketches.filter("n_shingles > 0")
        .groupBy("node")
        .agg(
            F.first("n_shingles").alias("n_shingles"), F.min("text_hash").alias("text_hash"), F.first("parts").alias("parts")
        )
        .withColumn("owner", _owner_of("node")),
        "join-classes",
    )
    total = classes.agg(F.sum("n_shingles")).first()[0] or 0
    lists = shared_signatures(classes, percent, max(4, -(-total // RANGE_SHINGLES)))
    met = lists.groupBy("a", "b").agg(F.sum("n").alias("times"))
    for side in "ab":
        named = classes.select(F.col("owner").alias(side), F.col("node").alias(f"node_{side}"), F.col("n_shingles").alias(f"n_{side}"))
        met = met.join(named, side)
    met = stored(met.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"), "times", "n_a", "n_b"), "join-met")

    # The smallest member of a list, the one that a set meets most often.
    best = (
        met.filter(_sizes_fit(F.col("n_a"), F.col("n_b"), percent))
        .groupBy("a")
        .agg(F.max(F.struct("times", "b")).alias("best"))
        .select("a", F.col("best.b").alias("b"))
    )
    pairs = stored(_near_pairs(best, classes, percent), "join-pairs")
    texts = _texts_of(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), classes, docs)
    first = stored(_confirmed(pairs, texts, words, percent), "join-links")
    cells = _cells(met, components(first))
    links = stored(first.unionByName(_linked_in_cells(cells, classes, docs, words, percent)), "join-links")

    grouped = stored(
        sketches.select("doc_id", "n_shingles", "node")
        .join(components(links), "node", "left")
        .withColumn("root", F.coalesce("root", "node")),
        "join-grouped",
    )
    smallest = grouped.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    own = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return grouped.join(smallest, "root", "left").select("doc_id", "n_shingles", own.alias("component_id"))


def _owner_of(node: str):
    """The first 64 bits of a digest as a number, least byte first."""
    turned = F.reverse(F.hex(F.substring(node, 1, 8)))
    pairs = F.regexp_replace(turned, "(.)(.)", "$2$1")
    return _signed(pairs)


def _signed(digits):
    """16 hexadecimal digits as a signed 64-bit number."""
    high, low = (F.conv(F.substring(digits, at, 8), 16, 10).cast("long") for at in (1, 9))
    return F.when(high >= 1 << 31, high - (1 << 32)).otherwise(high) * F.lit(1 << 32) + low
