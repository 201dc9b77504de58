"""Best-fit packing of token sequences, first in each task, then round by round of all underfull bins."""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.llm.common import stored, whole_text
from tiffin.llm.encoding import word_encoder

TOKENIZER = "byte_bpe_50k.json"
CAPACITY = 1024
END_ID = 2
BLOCK_PIECES = 50_000  # pieces packed together in a task
SLACK = 1 / 128  # a bin with less room than this share is full
GROUP_PIECES = 2_000  # pieces whose underfull bins are packed anew together
SLICE = 256  # texts encoded together

SLOT = pa.struct(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
     ("ids_crc32", pa.int64()), ("offset", pa.int64())]
)
BINS = pa.schema(
    [("block", pa.int64()), ("number", pa.int64()), ("fill", pa.int64()), ("open", pa.bool_()), ("slots", pa.list_(SLOT))]
)
BINS_DDL = (
    "block long, number long, fill long, open boolean, slots array<struct<doc_id:long,piece:int,start:long,length:long,"
    "ids_crc32:long,offset:long>>"
)


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Places of the items in each bin; largest items first, each into the fullest bin that takes it.

    Bins are kept by the room they have; one integer has a bit per room, so the
    least room that suffices is its lowest bit from the item's size on.
    """
    rooms, bins = 0, []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        enough = rooms >> sizes[i]
        if enough:
            room = sizes[i] + (enough & -enough).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        room -= sizes[i]
        if room:
            by_room[room].append(b)
            rooms |= 1 << room
    return bins


def pieces_of(doc_id: int | None, ids: bytes, capacity: int) -> Iterator[tuple]:
    """(doc_id, piece, start, length, crc) of one document; the first piece takes what full pieces leave."""
    total = len(ids) // 4
    start, end = 0, total % capacity or capacity
    piece = 0
    while start < total:
        end = min(end, total)
        yield doc_id, piece, start, end - start, zlib.crc32(ids[4 * start : 4 * end])
        piece, start, end = piece + 1, end, end + capacity


def _merged(items: list[tuple[int, list[tuple]]], capacity: int) -> Iterator[tuple[int, list[tuple]]]:
    """Bins of (fill, slots) items, packed best-fit, with the slots' offsets set anew.

    Underfull bins are packed as they are and, beside it, taken apart; the
    packing with fewer bins counts.
    """
    bins = best_fit([fill for fill, _ in items], capacity)
    apart = [(slot[3], [slot]) for _, slots in items for slot in slots]
    if len(apart) > len(items):
        anew = best_fit([fill for fill, _ in apart], capacity)
        if len(anew) < len(bins):
            bins, items = anew, apart
    for places in bins:
        at, slots = 0, []
        for i in places:
            for slot in items[i][1]:
                slots.append((*slot[:5], at))
                at += slot[3]
        yield at, slots


def _rows(block: int, bins: list[tuple[int, list[tuple]]], capacity: int) -> list[tuple]:
    """(block, number, fill, open, slots); every bin that is not full is open to the next round."""
    return [(block, i, fill, capacity - fill > capacity * SLACK, slots) for i, (fill, slots) in enumerate(bins)]


def pack(
    docs: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    keeps_space: bool = True,
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """Sequences of at most ``capacity`` tokens: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its token ids and ``end_id``. Only documents longer than a
    sequence are cut: into full pieces, before them one with the rest. Each
    task encodes and packs its own documents; full sequences are done at once.
    All others are dealt by a hash into groups of about ``group_pieces`` pieces,
    so bins of all tasks meet, and each group is packed anew by best fit. Such
    rounds, each dealt differently, go on with what is not full until one group
    held it all or a round saved no sequence.

    A missing text is empty: a piece of one token. A missing id is kept;
    repeated rows are packed each for itself; an empty table gives no rows.
    Other columns are ignored.
    """

    def encode_and_pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ending = end_id.to_bytes(4, "little")
        block = TaskContext.get().partitionId() << 32  # and the flushes of the task counted
        items: list[tuple[int, list[tuple]]] = []

        def flush() -> pa.RecordBatch:
            return _batch(_rows(block, list(_merged(items, capacity)), capacity))

        with word_encoder(path, keeps_space) as encoder:
            for batch in batches:
                for at in range(0, batch.num_rows, SLICE):
                    texts = batch.slice(at, SLICE)
                    found = encoder.encode(texts.column("text").to_pylist())
                    for doc_id, ids in zip(texts.column("doc_id").to_pylist(), found, strict=True):
                        items += [(p[3], [p]) for p in pieces_of(doc_id, ids + ending, capacity)]
                    if len(items) >= BLOCK_PIECES:
                        yield flush()
                        block, items = block + 1, []
            if items:
                yield flush()

    first = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    level = stored(first.mapInArrow(encode_and_pack, BINS_DDL), "pack-level")
    done = []
    for turn in itertools.count():
        left = level.filter("open").agg(F.count("*").alias("bins"), F.sum(F.size("slots")).alias("pieces")).first()
        if not left["bins"]:
            break
        done.append(level.filter("not open"))
        groups = -(-left["pieces"] // group_pieces)
        dealt = F.pmod(F.xxhash64("block", "number", F.lit(turn)), F.lit(groups))
        again = level.filter("open").groupBy(dealt.alias("group"))
        level = stored(again.applyInArrow(_refit(capacity), BINS_DDL), "pack-level")
        if groups == 1 or level.count() == left["bins"]:
            break
    done.append(level)
    whole = done[0]
    for more in done[1:]:
        whole = whole.unionByName(more)
    return (
        whole.withColumn("sequence_id", F.monotonically_increasing_id())
        .select("sequence_id", F.explode("slots").alias("slot"))
        .select(
            "slot.doc_id", "slot.piece", "slot.start", "slot.length", "slot.ids_crc32", "sequence_id", "slot.offset"
        )
    )


def _refit(capacity: int):
    """The next level's bins of one group's underfull bins."""

    def refit(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        items = [
            (fill, [tuple(slot.values()) for slot in slots])
            for fill, slots in zip(rows.column("fill").to_pylist(), rows.column("slots").to_pylist(), strict=True)
        ]
        return pa.Table.from_batches([_batch(_rows(key[0].as_py(), list(_merged(items, capacity)), capacity))])

    return refit


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    """Arrow columns built from flat lists, one per field of a slot."""
    blocks, numbers, fills, opens, slots = zip(*rows, strict=True)
    fields = list(zip(*itertools.chain.from_iterable(slots), strict=True))
    flat = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(fields, SLOT, strict=True)], fields=list(SLOT))
    ends = pa.array([0, *itertools.accumulate(map(len, slots))], pa.int32())
    arrays = [pa.array(c, f.type) for c, f in zip((blocks, numbers, fills, opens), BINS, strict=False)]
    return pa.RecordBatch.from_arrays([*arrays, pa.ListArray.from_arrays(ends, flat)], schema=BINS)
