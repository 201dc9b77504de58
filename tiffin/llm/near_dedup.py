"""Near-duplicate groups: MinHash signatures joined through their coordinates, links confirmed on full sets."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.llm.common import stored, task_memory, whole_text

COORDINATES = 64
SEED = 7
SPREAD = 5.0  # standard deviations that the match threshold lies below the expected matches
BUCKETS = 1 << 16  # counters of the token histogram, whatever the input
MEMO_WORDS = 120_000
ROWS = 512  # documents worked on together
BLOCK = 4_096  # shingles hashed together
CROWD = 16  # members of a list above which the shingles they may share are counted
PARTS = 32  # counts per class for that
PACKED_ROWS = 1_000_000  # shingles that a task packs at a time
BLOCK_MEMBERS = 1_024  # members of a crowded list that one task compares with as many

_rng = np.random.default_rng(SEED)
FACTORS = _rng.integers(1, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _rng.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)
POSITION = np.uint64(0x9E3779B97F4A7C15)


def match_threshold(percent: int, coordinates: int = COORDINATES) -> int:
    """Matching coordinates that a pair at the similarity limit misses about once in a million pairs."""
    s = percent / 100
    return max(1, int(coordinates * s - SPREAD * (coordinates * s * (1 - s)) ** 0.5))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class WordHashes(dict):
    """64-bit hash of each word, kept."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = xxhash.xxh64_intdigest(word)
        if len(word) <= 64:
            self[word] = value
        return value


def shingle_set(text: str, words: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; a shorter text is one shingle, one without words none.

    Only A-Z is lower-cased; words are split at ASCII white space.
    """
    if len(hashes) > MEMO_WORDS:
        hashes.clear()
    split = text.encode("utf-8", "surrogatepass").lower().split()
    if not split:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, split), np.uint64, len(split))
    width = min(words, len(h))
    total = np.full(len(h) - width + 1, np.uint64(width))
    for i in range(width):
        total = total * POSITION + h[i : len(h) - width + 1 + i]
    return np.unique(_mixed(total))


def signature(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over the set, 32 bits each."""
    low = np.full(COORDINATES, np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(shingles), BLOCK):
        low = np.minimum(low, (shingles[at : at + BLOCK, None] * FACTORS + SHIFTS).min(axis=0))
    return (low >> np.uint64(32)).astype(np.uint32)


def tokens_of(signatures: np.ndarray) -> np.ndarray:
    """One number per coordinate and value."""
    place = np.arange(1, COORDINATES + 1, dtype=np.uint64)
    return _mixed(signatures.astype(np.uint64) + (place << np.uint64(32)))


SKETCH_DDL = "doc_id long, text_hash string, n_shingles long, node binary, signature binary"


def text_hash() -> Column:
    return F.md5(whole_text().cast("binary"))


def sketch(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, node (digest of the set), signature; both null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        with task_memory():
            for batch in batches:
                for at in range(0, batch.num_rows, ROWS):
                    yield sketched(batch.slice(at, ROWS), hashes)
            del hashes

    def sketched(part: pa.RecordBatch, hashes: WordHashes) -> pa.RecordBatch:
        sizes, nodes, signatures = [], [], []
        for text in part.column("text").to_pylist():
            found = shingle_set(text, words, hashes)
            sizes.append(len(found))
            some = len(found) > 0
            nodes.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if some else None)
            signatures.append(signature(found).tobytes() if some else None)
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), part.column("text_hash"), pa.array(sizes, pa.int64()),
             pa.array(nodes, pa.binary()), pa.array(signatures, pa.binary())],
            ["doc_id", "text_hash", "n_shingles", "node", "signature"],
        )

    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("text_hash"), whole_text().alias("text")
    )
    return texts.mapInArrow(run, SKETCH_DDL)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, COORDINATES)


def token_counts(classes: DataFrame) -> np.ndarray:
    """How many classes hold a token of each bucket; each task counts first, ``BUCKETS`` sums reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            tokens = tokens_of(_matrix(batch.column(0)))
            total += np.bincount((tokens % np.uint64(BUCKETS)).astype(np.int64).ravel(), minlength=BUCKETS)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    sums = classes.select("signature").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n"))
    found = np.zeros(BUCKETS, np.int64)
    rows = sums.toPandas()
    found[rows["bucket"].to_numpy(np.int64)] = rows["sum(n)"].to_numpy(np.int64)
    return found


def postings(classes: DataFrame, counts: np.ndarray, matches: int) -> DataFrame:
    """Every class under its rarest tokens: token, node.

    Two signatures with ``matches`` equal coordinates share a token among the
    ``COORDINATES - matches + 1`` that come first in any common order. The
    order here puts rare buckets first, so passages that many documents share
    are not posted where a document has enough of its own.
    """
    prefix = COORDINATES - matches + 1

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            tokens = tokens_of(_matrix(batch.column("signature")))
            rarity = counts[(tokens % np.uint64(BUCKETS)).astype(np.int64)]
            first = np.lexsort((tokens, rarity), axis=1)[:, :prefix]
            chosen = np.take_along_axis(tokens, first, axis=1).ravel().view(np.int64)
            row = pa.array(np.repeat(np.arange(batch.num_rows), prefix))
            yield pa.RecordBatch.from_arrays(
                [pa.array(chosen), batch.column("node").take(row)], ["token", "node"]
            )

    return classes.select("node", "signature").mapInArrow(post, "token long, node binary")


def centrality(counts: np.ndarray) -> Callable[[Column], Column]:
    """How common all of a class's tokens are together.

    The highest in a group of near copies is the copy with the fewest changes of
    its own.
    """

    def add_up(signatures: pd.Series) -> pd.Series:
        if not len(signatures):
            return pd.Series([], dtype="int64")
        tokens = tokens_of(np.frombuffer(b"".join(signatures), np.uint32).reshape(-1, COORDINATES))
        return pd.Series(counts[(tokens % np.uint64(BUCKETS)).astype(np.int64)].sum(axis=1))

    return F.pandas_udf(add_up, "long")


def _crowded_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components in crowded lists that can be similar enough, given what they share at most.

    ``members`` has token, node, root, n_shingles, crowd, parts, tokens. A list
    is cut into blocks of about ``BLOCK_MEMBERS``, and each two blocks meet in a
    task of their own, so a list of any size spreads over many tasks; a task
    gives only the pairs that pass, each in the first list that it shares.
    """

    def compare(cell: pa.Table) -> pa.Table:
        nodes, n = cell.column("node").to_numpy(), cell.column("n_shingles").to_numpy()
        parts = cell.column("parts").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, PARTS)
        tokens = [set(t) for t in cell.column("tokens").to_pylist()]
        token = cell.column("token")[0].as_py()
        block, low, high = (cell.column(c).to_numpy() for c in ("block", "low", "high"))
        _, root = np.unique(cell.column("root").to_pylist(), return_inverse=True)
        left, right = np.flatnonzero(block == low[0]), np.flatnonzero(block == high[0])
        found: list[tuple[int, int]] = []
        for at in range(0, len(left), 64):
            rows = left[at : at + 64]
            most = np.zeros((len(rows), len(right)), dtype=np.int32)
            for p in range(PARTS):
                most += np.minimum(parts[rows, p][:, None], parts[right, p][None, :])
            size = n[rows][:, None] + n[right][None, :]
            fits = (100 * most >= percent * (size - most)) & (root[rows][:, None] != root[right][None, :])
            if low[0] == high[0]:
                fits &= rows[:, None] < right[None, :]
            near = [(rows[i], right[j]) for i, j in zip(*np.nonzero(fits), strict=True)]
            found += [(i, j) for i, j in near if min(tokens[i] & tokens[j]) == token]
        pairs = [sorted((nodes[i], nodes[j])) for i, j in found]
        return pa.table({c: pa.array([p[k] for p in pairs], pa.binary()) for k, c in enumerate("ab")})

    blocks = F.ceil(F.col("crowd") / BLOCK_MEMBERS).cast("long")
    placed = members.withColumn("block", F.pmod(F.xxhash64("node"), blocks)).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))
    )
    return (
        placed.withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .select("token", "low", "high", "block", "node", "root", "n_shingles", "parts", "tokens")
        .groupBy("token", "low", "high")
        .applyInArrow(compare, "a binary, b binary")
    )


def _sizes_fit(a: Column, b: Column, percent: int) -> Column:
    return (F.least(a, b) * 100) >= (F.greatest(a, b) * percent)


def _matching(pairs: DataFrame, classes: DataFrame, matches: int) -> DataFrame:
    """Pairs (a, b) whose signatures agree in at least ``matches`` coordinates, with the count.

    The prefix collisions made the pair; the coordinates they skipped are
    counted here, for these pairs only.
    """

    def agree(a: pd.Series, b: pd.Series) -> pd.Series:
        if not len(a):
            return pd.Series([], dtype="int64")
        x = np.frombuffer(b"".join(a), np.uint32).reshape(-1, COORDINATES)
        y = np.frombuffer(b"".join(b), np.uint32).reshape(-1, COORDINATES)
        return pd.Series((x == y).sum(axis=1).astype("int64"))

    signed = classes.select("node", "signature")
    both = pairs.join(signed.select(F.col("node").alias("a"), F.col("signature").alias("sa")), "a").join(
        signed.select(F.col("node").alias("b"), F.col("signature").alias("sb")), "b"
    )
    return both.select("a", "b", F.pandas_udf(agree, "long")("sa", "sb").alias("matches")).filter(
        F.col("matches") >= matches
    )


def _texts_of(nodes: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """node, text: the text of one document of each class in ``nodes``."""
    wanted = classes.join(nodes, "node", "left_semi").select("node", "text_hash")
    read = docs.select(text_hash().alias("text_hash"), whole_text().alias("text"))
    # Copies of a text share its hash, so they are combined where the join has put them.
    found = read.join(wanted, "text_hash").groupBy("text_hash", "node").agg(F.first("text").alias("text"))
    return stored(found.select("node", "text"), "near-texts")


def _confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held = WordHashes(), {}

        def shingles(text: str) -> np.ndarray:
            if text not in held:
                if len(held) > 64:
                    held.clear()
                held[text] = shingle_set(text, words, hashes)
            return held[text]

        with task_memory():
            for batch in batches:
                for at in range(0, batch.num_rows, ROWS):
                    part, near = batch.slice(at, ROWS), []
                    for x, y in zip(part.column("ta").to_pylist(), part.column("tb").to_pylist(), strict=True):
                        x, y = shingles(x), shingles(y)
                        both = len(np.intersect1d(x, y, assume_unique=True))
                        near.append(100 * both >= percent * (len(x) + len(y) - both))
                    yield part.select(["a", "b"]).filter(pa.array(near, pa.bool_()))
            held.clear()
            del hashes

    joined = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a").join(
        texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b"
    )
    return joined.select("a", "b", "ta", "tb").mapInArrow(confirm, "a binary, b binary")


def _open_shingles(nodes: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """node, parts: shingles of each class in ``nodes`` that another one in ``nodes`` has too, counted by part.

    A shingle's part is its hash modulo ``PARTS``. Two classes share at most the
    smaller count of each part. Shingles travel as packed arrays: first by
    range of the hash, where those that only one class has are found, then
    these by range of the class. Classes go by a hash here; two with the same
    one would only count as sharing more.
    """
    conf = nodes.sparkSession.conf
    ranges = 1 << max(2, int(conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()
    chosen = texts.join(nodes, "node", "left_semi").select("node", F.xxhash64("node").alias("hashed"), "text")

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
        hashes = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                yield part, [shingle_set(t, words, hashes) for t in part.column("text").to_pylist()]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in sets_of(batches):
            counts = [np.bincount((s % np.uint64(PARTS)).astype(np.int64), minlength=PARTS).tolist() for s in sets]
            yield pa.RecordBatch.from_arrays(
                [part.column("node"), part.column("hashed"), pa.array(counts, pa.list_(pa.int32()))],
                ["node", "hashed", "parts"],
            )

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for part, sets in sets_of(batches):
            owner = np.repeat(part.column("hashed").to_numpy(zero_copy_only=False), [len(s) for s in sets])
            held.append((np.concatenate(sets), owner))
            if sum(len(h[0]) for h in held) >= PACKED_ROWS:
                yield _packed(held, lambda shingle, _: shingle, ranges)
                held = []
        if held:
            yield _packed(held, lambda shingle, _: shingle, ranges)

    def single(rows: pa.Table) -> pa.Table:
        shingle, owner = _unpacked(rows)
        _, first, times = np.unique(shingle, return_index=True, return_counts=True)
        alone = first[times == 1]
        return pa.Table.from_batches([_packed([(shingle[alone], owner[alone])], lambda _, owner: owner, ranges)])

    def per_class(rows: pa.Table) -> pa.Table:
        shingle, owner = _unpacked(rows)
        owners, place = np.unique(owner, return_inverse=True)
        slot = place * PARTS + (shingle % np.uint64(PARTS)).astype(np.int64)
        counts = np.bincount(slot, minlength=len(owners) * PARTS).reshape(-1, PARTS)
        return pa.table([pa.array(owners), pa.array(counts.tolist(), pa.list_(pa.int32()))], ["hashed", "alone"])

    dealt = "range long, shingles binary, owners binary"
    alone = (
        chosen.mapInArrow(deal, dealt)
        .groupBy("range")
        .applyInArrow(single, dealt)
        .groupBy("range")
        .applyInArrow(per_class, "hashed long, alone array<int>")
    )
    counted = chosen.mapInArrow(count, "node binary, hashed long, parts array<int>").join(alone, "hashed", "left")
    left = F.zip_with("parts", "alone", lambda p, o: p - o)
    return counted.select("node", F.when(F.col("alone").isNull(), F.col("parts")).otherwise(left).alias("parts"))


def _packed(
    held: list[tuple[np.ndarray, np.ndarray]], key: Callable[[np.ndarray, np.ndarray], np.ndarray], ranges: int
) -> pa.RecordBatch:
    """Shingles and their owners as one row per range of the key."""
    shingle, owner = (np.concatenate([h[i] for h in held]) for i in (0, 1))
    at = (_mixed(key(shingle, owner).view(np.uint64)) % np.uint64(ranges)).astype(np.int64)
    order = np.argsort(at, kind="stable")
    names, starts = np.unique(at[order], return_index=True)
    cuts = list(zip(starts.tolist(), [*starts[1:].tolist(), len(at)], strict=True)) if len(at) else []
    shingle, owner = shingle[order], owner[order]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(names, pa.int64()),
            pa.array([shingle[a:b].tobytes() for a, b in cuts], pa.binary()),
            pa.array([owner[a:b].tobytes() for a, b in cuts], pa.binary()),
        ],
        ["range", "shingles", "owners"],
    )


def _unpacked(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    shingle = np.frombuffer(b"".join(rows.column("shingles").to_pylist()), np.uint64)
    return shingle, np.frombuffer(b"".join(rows.column("owners").to_pylist()), np.int64)


def components(links: DataFrame) -> DataFrame:
    """node, root: the smallest node reachable over links (a, b), for every node with a link.

    Alternating large-star and small-star steps: every node points its larger,
    then its smaller neighbours at the smallest one it sees, until nothing
    changes. A node with many neighbours is combined in the tasks first.
    """

    def step(edges: DataFrame, larger: bool) -> DataFrame:
        if larger:
            near = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            near = edges
        least = near.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("least", "a"))
        seen = near.join(least, "a")
        if larger:
            out = seen.filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        else:
            out = seen.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
                least.select("a", F.col("least").alias("b"))
            )
        return out.filter("a != b").distinct()

    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct()
    edges = stored(edges, "near-edges")
    before = None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if tuple(mark) == before:
            break
        before = tuple(mark)
        edges = stored(step(step(edges, larger=True), larger=False), "near-edges")
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Groups of near-duplicate documents, one row per input row.

    Returns doc_id, n_shingles, component_id, kept, text_hash. Documents whose
    shingle sets have ``100 * intersection >= percent * union`` are linked;
    component_id is the smallest id reachable, and kept says that it is the
    document's own. Documents without words are linked with nothing. Rows that
    share an id share ``kept`` in their group; a missing id counts as larger
    than any other and is kept only where no other id is in its group. Repeated
    rows repeat, an empty table gives no rows, other columns are ignored.

    Equal sets are one class from the start. Classes are posted under their
    rarest signature tokens. First every class meets the most central member of
    each of its lists, and the best match is confirmed on the texts: most of a
    large group of near copies becomes one component with one confirmed pair
    per class. Then only classes of different components that share a list are
    paired, so the first pass drops no pair that could still matter. For the
    classes of crowded lists the shingles that others there have too are
    counted by part first: where the smaller counts cannot add up to the
    similarity, the pair is not made. Pairs
    are confirmed on the whole sets; at the similarity limit about one pair in
    a million has too few matching coordinates to be looked at.
    """
    grouped = _grouped(docs, words, percent)
    smallest = stored(
        grouped.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id")), "near-ids"
    )
    return (
        grouped.join(smallest, "root", "left")
        .withColumn("component_id", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
        .select(
            "doc_id", "n_shingles", "component_id",
            F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "text_hash",
        )
    )


def _grouped(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, node and root of every row; rows of a group share the root, without words it is null."""
    matches = match_threshold(percent)
    sketches = stored(sketch(docs, words), "near-sketch")
    classes = stored(
        sketches.filter("n_shingles > 0")
        .groupBy("node")
        .agg(
            F.first("n_shingles").alias("n_shingles"),
            F.first("signature").alias("signature"),
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("one"),
        )
        .select("node", "n_shingles", "signature", "one.doc_id", "one.text_hash"),
        "near-classes",
    )
    counts = token_counts(classes)
    posted = stored(postings(classes, counts, matches), "near-postings")
    lists = posted.groupBy("token").agg(F.count("*").alias("crowd")).filter("crowd > 1")
    sized = classes.select("node", "n_shingles", centrality(counts)("signature").alias("central"))
    shared = stored(posted.join(lists, "token").join(sized, "node"), "near-shared")
    hubs = shared.groupBy("token").agg(F.max(F.struct("central", "node", "n_shingles")).alias("hub"))
    texts = _texts_of(shared.select("node").distinct(), classes, docs)

    # Pass 1: the most central member of each list.
    met = (
        shared.join(hubs, "token")
        .select(
            F.col("node").alias("a"), "n_shingles", F.col("hub.node").alias("b"), F.col("hub.n_shingles").alias("nb")
        )
        .filter(F.col("a") != F.col("b"))
        .filter(_sizes_fit(F.col("n_shingles"), F.col("nb"), percent))
        .select("a", "b")
        .distinct()
    )
    best = (
        _matching(met, classes, matches)
        .groupBy("a")
        .agg(F.max(F.struct("matches", "b")).alias("best"))
        .select("a", F.col("best.b").alias("b"))
    )
    first = stored(_confirmed(stored(best, "near-pairs"), texts, words, percent), "near-links")
    roots = stored(components(first), "near-roots")

    # Pass 2: lists that still hold several components, members of different ones paired.
    placed = (
        shared.select("token", "node", "n_shingles", "crowd")
        .join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    several = placed.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high")
    mixed = stored(placed.join(several, "token", "left_semi"), "near-mixed")
    crowded = mixed.filter(F.col("crowd") > CROWD).select("node").distinct()
    parts = stored(_open_shingles(crowded, texts, words), "near-parts")
    dense = mixed.filter(F.col("crowd") > CROWD)
    tokens = dense.groupBy("node").agg(F.collect_list("token").alias("tokens"))  # at most one per coordinate
    close = _crowded_pairs(dense.join(parts.join(tokens, "node"), "node"), percent)
    few = mixed.filter(F.col("crowd") <= CROWD)
    a, b = (few.select("token", *[F.col(c).alias(c + side) for c in ("node", "root", "n_shingles")]) for side in "ab")
    apart = (F.col("roota") < F.col("rootb")) & _sizes_fit(F.col("n_shinglesa"), F.col("n_shinglesb"), percent)
    ends = (F.least("nodea", "nodeb").alias("a"), F.greatest("nodea", "nodeb").alias("b"))
    crossing = a.join(b, "token").filter(apart).select(*ends).unionByName(close).distinct()
    pairs = stored(_matching(crossing, classes, matches).select("a", "b"), "near-pairs")
    second = _confirmed(pairs, texts, words, percent)
    links = stored(first.unionByName(second), "near-links")
    roots = components(links)

    sized = sketches.select("doc_id", "text_hash", "n_shingles", "node").join(roots, "node", "left")
    return sized.withColumn("root", F.coalesce("root", "node"))


def without_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group, all columns kept; documents without words all stay.

    It is the row of the smallest id, a missing id being the largest, then of
    the smallest text hash. Of rows alike in id and text any one stays.
    """
    grouped = stored(_grouped(docs, words, percent), "near-grouped")
    key = (F.col("doc_id").alias("_near_id"), F.col("text_hash").alias("_near_hash"))
    best = (
        grouped.filter("root is not null")
        .groupBy("root", "doc_id", "text_hash")
        .agg(F.count("*").alias("rows"))
        .groupBy("root")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "rows")).alias("one"))
        .select("one.doc_id", "one.text_hash", "one.rows")
        .select(*key, F.col("rows").alias("_near_rows"))
    )
    wordless = grouped.filter("root is null").select(*key, F.lit(1).cast("long").alias("_near_rows")).distinct()
    own = (text_hash() == F.col("_near_hash")) & F.col("doc_id").eqNullSafe(F.col("_near_id"))
    rows = docs.join(best.unionByName(wordless), own)
    alike = (
        rows.filter("_near_rows > 1").groupBy("_near_id", "_near_hash").agg(F.first(F.struct(*docs.columns)).alias("row"))
    )
    return rows.filter("_near_rows = 1").select(*docs.columns).unionByName(alike.select("row.*"))
