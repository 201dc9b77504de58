"""Alignment of two tokenizers: groups between common token ends, composed from fragments of byte ranges.

A fragment covers a range of a text: an open prefix up to its first safe cut, the
closed groups between its first and last one, an open suffix after it. Fragments
compose, and the composition is associative, so those of a very long document are
reduced as a tree over tasks; a short document is one fragment.

A cut is safe where both tokenizers always end a token: before a blank or a line
feed that stands between two visible characters. The text between two safe cuts is
aligned on its own, and a task remembers what it found for each.
"""

from __future__ import annotations

import hashlib
import os
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tiffin.llm.common import stored, task_memory, whole_text

FIRST = "byte_bpe_50k.json"
SECOND = "piece_bpe_32k.model"
CHUNK_BYTES = 1 << 16  # byte range of a fragment; longer texts are dealt over tasks
FAN_IN = 8  # fragments composed at a time
BLOCK_LINKS = 1_500_000  # id pairs of the documents that are held together
BLOCK_DOCS = 4_096
MEMO_BYTES = 64 << 20
ENTRY_BYTES = 280  # what a remembered stretch takes beside its text and ids
MANY_LINKS = 4_096  # above, the ids of a group are counted before they are paired
ROWS = 256  # texts worked on together

VISIBLE = r"[!-~\xa1-\xac\xae-ɏ]"
CUT = re.compile(rf"(?<={VISIBLE})(?=[ \n]{VISIBLE})")
PLAIN = re.compile(rf"[ \n]{VISIBLE}+")
# Texts without these have a safe cut before every blank and line feed.
ODD = re.compile(r"  | \n|\n |\n\n|[\x00-\x09\x0b-\x1f\x7f-\xa0\xad]|[^\x00-ɏ]")


def bytes_of_second(pieces) -> list[bytes]:
    """Bytes of each piece: U+2581 is a blank, byte pieces are their byte."""
    out = []
    for i in range(pieces.get_piece_size()):
        piece = pieces.id_to_piece(i)
        out.append(bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace("▁", " ").encode())
    return out


def bytes_of_first(tokenizer) -> list[bytes]:
    """Bytes of each id: printable characters of Latin-1 stand for themselves, the others follow from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    letters = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    out = [b""] * tokenizer.get_vocab_size()
    for token, i in tokenizer.get_vocab().items():
        out[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
    return out


@dataclass
class Part:
    """Closed groups of a stretch of text; ``codes`` are its distinct id pairs (a << 32 | b), ``occ`` how often each is linked."""

    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    n_links: int = 0
    text: str = ""
    codes: bytes = b""
    occ: bytes = b""
    bad: bool = False


def summed(parts: list[Part]) -> Part:
    """The parts in a row as one."""
    if len(parts) == 1:
        return parts[0]
    codes = np.frombuffer(b"".join(p.codes for p in parts), np.int64)
    occ = np.frombuffer(b"".join(p.occ for p in parts), np.int64)
    if len(codes):
        order = np.argsort(codes, kind="stable")
        codes, occ = codes[order], occ[order]
        first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
        codes, occ = codes[first], np.add.reduceat(occ, first)
    return Part(
        sum(p.n_a for p in parts), sum(p.n_b for p in parts), sum(p.n_groups for p in parts),
        sum(p.n_links for p in parts), ";".join([p.text for p in parts if p.n_groups]),
        codes.tobytes(), occ.tobytes(), any(p.bad for p in parts),
    )


class Aligner:
    """Both tokenizers of a worker, and the ids of the stretches between cuts that the task has met."""

    def __init__(self, first: str, second: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(first)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=second)
        self.bytes_a, self.bytes_b = bytes_of_first(self.a), bytes_of_second(self.b)
        self.length_a, self.length_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))
        # How an id is written: in a group's first half, as its last of that half, in the second half, as its last.
        spelled = [f"{i}{end}" for i in range(len(self.bytes_a)) for end in ",|"]
        spelled += [f"{i}{end}" for i in range(len(self.bytes_b)) for end in ",;"]
        self.spelled = np.array(spelled, dtype=object)
        pieces = [x.decode("utf-8", "replace") for i, x in enumerate(self.bytes_b) if not self.b.is_byte(i)]
        # A piece with a blank inside or a line feed could reach over a cut.
        self.cuts = not any(re.search(r"[^ ] |\n", p) for p in pieces)
        self.lead = [i for i, x in enumerate(self.bytes_b) if x == b" " and not self.b.is_byte(i)]
        self.forget()

    def forget(self) -> None:
        self.memo: dict[str, tuple[bytes, bytes] | None] = {}
        self.memo_bytes = 0

    def units(self, text: str) -> list[str]:
        """``text`` between its safe cuts."""
        if not self.cuts:
            return [text]
        if ODD.search(text) or text[-1] in " \n":
            return CUT.split(text)
        head, *rest = text.replace("\n", " \n").split(" ")
        rest = [p if p[:1] == "\n" else " " + p for p in rest]
        return [head, *rest] if head else rest

    def learn(self, units: set[str]) -> None:
        """Encode the units that the task has not met: plain ones in a row, which is a text with just these cuts."""
        if self.memo_bytes > MEMO_BYTES:
            self.forget()
        new = [u for u in units if u not in self.memo]
        plain = [u for u in new if PLAIN.fullmatch(u)] if self.cuts else []
        found = self._in_a_row(plain) if plain else {}
        left = [u for u in new if u not in found]
        if left:
            ids_a = [e.ids for e in self.a.encode_batch_fast(left, add_special_tokens=False)]
            # The library puts a blank before every text; a line feed keeps it off as a piece of its own.
            ids_b = self.b.encode([u[1:] if u[0] == " " else u for u in left], num_threads=1)
            for u, a, b in zip(left, ids_a, ids_b, strict=True):
                if u[0] != " ":
                    b = b[1:] if b[:1] == self.lead[:1] else []
                data = u.encode("utf-8", "surrogatepass")
                same = b"".join([self.bytes_a[i] for i in a]) == data == b"".join([self.bytes_b[i] for i in b])
                found[u] = (np.array(a, np.uint32).tobytes(), np.array(b, np.uint32).tobytes()) if same else None
        self.memo.update(found)
        self.memo_bytes += sum(ENTRY_BYTES + 2 * len(u) + 12 * len(u) // 3 for u in found)

    def _in_a_row(self, plain: list[str]) -> dict[str, tuple[bytes, bytes] | None]:
        """Ids of the units, encoded as one text and taken apart at their ends; none if these are no ends of tokens."""
        text = " x" + "".join(plain)
        a = np.array(self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        b = np.array(self.b.encode(text[1:]), np.uint32)
        data = text.encode("utf-8", "surrogatepass")
        if b"".join([self.bytes_a[i] for i in a]) != data or b"".join([self.bytes_b[i] for i in b]) != data:
            return {}
        ends = np.cumsum([2, *[len(u.encode()) for u in plain]])
        cut = []
        for ids, length in ((a, self.length_a), (b, self.length_b)):
            reached = np.cumsum(length[ids])
            at = np.searchsorted(reached, ends)
            if not np.array_equal(reached[at], ends):
                return {}
            cut.append((at + 1).tolist())
        return {
            u: (a[i:j].tobytes(), b[k:m].tobytes())
            for u, i, j, k, m in zip(plain, cut[0], cut[0][1:], cut[1], cut[1][1:], strict=False)
        }

    def parts(self, texts: list[str]) -> list[Part]:
        """What each text, from a cut to a cut, aligns to; an empty one to nothing."""
        out: list[Part] = []
        for at in range(0, len(texts), ROWS):
            split = [self.units(t) if t else [] for t in texts[at : at + ROWS]]
            self.learn(set().union(*split))
            held = [list(map(self.memo.__getitem__, units)) for units in split]
            good = [None not in ids for ids in held]
            rows = [ids if ok else [] for ids, ok in zip(held, good, strict=True)]
            found = self.aligned([b"".join([a for a, _ in ids]) for ids in rows], [b"".join([b for _, b in ids]) for ids in rows])
            out += [part if ok else Part(bad=True) for part, ok in zip(found, good, strict=True)]
        return out

    def aligned(self, ids_a: list[bytes], ids_b: list[bytes]) -> list[Part]:
        """Groups and links of texts, each by the ids of both tokenizers over the same bytes.

        The texts are laid in a row; tokens of both that end at the same byte
        end a group.
        """
        n_a, n_b = (np.array([len(x) // 4 for x in ids], np.int64) for ids in (ids_a, ids_b))
        a, b = (np.frombuffer(b"".join(ids), np.uint32).astype(np.int64) for ids in (ids_a, ids_b))
        if not len(a):
            return [Part() for _ in ids_a]
        end_a, end_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        common = end_a[end_b[np.minimum(np.searchsorted(end_b, end_a), len(b) - 1)] == end_a]
        group_a, group_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
        of_a, of_b = (np.bincount(g, minlength=len(common)) for g in (group_a, group_b))
        first_b, stop_a = np.cumsum(of_b) - of_b, np.cumsum(of_a)
        spelled = np.empty(len(a) + len(b), np.int64)
        spelled[np.arange(len(a)) + first_b[group_a]] = 2 * a + (end_a == common[group_a])
        spelled[np.arange(len(b)) + stop_a[group_b]] = 2 * len(self.bytes_a) + 2 * b + (end_b == common[group_b])
        pieces = self.spelled[spelled]
        doc_a = np.repeat(np.arange(len(n_a)), n_a)
        doc_group = doc_a[stop_a - 1]
        links = of_a * of_b
        codes, occ, owner = self._links(a, b, group_a, of_a, of_b, first_b, stop_a, doc_a, doc_group)
        n_groups = np.bincount(doc_group, minlength=len(n_a))
        total = np.r_[0, np.cumsum(links)][np.r_[0, np.cumsum(n_groups)]]
        ends, cuts = np.cumsum(n_a + n_b).tolist(), np.searchsorted(owner, np.arange(len(n_a) + 1)).tolist()
        return [
            Part(
                int(n_a[i]), int(n_b[i]), int(n_groups[i]), int(total[i + 1] - total[i]),
                "".join(pieces[ends[i] - n_a[i] - n_b[i] : ends[i]].tolist())[:-1],
                codes[cuts[i] : cuts[i + 1]].tobytes(), occ[cuts[i] : cuts[i + 1]].tobytes(),
            )
            for i in range(len(n_a))
        ]

    def _links(self, a, b, group_a, of_a, of_b, first_b, stop_a, doc_a, doc_group) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct id pairs of each text (a << 32 | b), how often each is linked, and the text; sorted by text and pair."""
        size, every = len(self.bytes_b), len(self.bytes_a) * len(self.bytes_b)
        large = of_a * of_b > MANY_LINKS
        spread = np.where(large[group_a], 0, of_b[group_a])
        place = np.repeat(first_b[group_a] - np.cumsum(spread) + spread, spread) + np.arange(spread.sum())
        keys = [np.repeat(doc_a * every + a * size, spread) + b[place]]
        times = [np.ones(len(keys[0]), np.int64)]
        for g in np.flatnonzero(large):  # ids of such a group are counted first
            ua, na = np.unique(a[stop_a[g] - of_a[g] : stop_a[g]], return_counts=True)
            ub, nb = np.unique(b[first_b[g] : first_b[g] + of_b[g]], return_counts=True)
            keys.append((doc_group[g] * every + ua[:, None] * size + ub[None, :]).ravel())
            times.append((na[:, None] * nb[None, :]).ravel())
        key, weight = np.concatenate(keys), np.concatenate(times)
        order = np.argsort(key, kind="stable")
        key, weight = key[order], weight[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        pair = key[first] % every
        return (pair // size) << 32 | (pair % size), np.add.reduceat(weight, first), key[first] // every


def aligner(first: str, second: str) -> Aligner:
    held = sys.modules.setdefault("tiffin_worker_aligners", SimpleNamespace(by_file={}))
    if (first, second) not in held.by_file:
        held.by_file[first, second] = Aligner(first, second)
    return held.by_file[first, second]


@dataclass
class Fragment:
    """A range of a text; without a safe cut in it all of it is ``prefix``."""

    prefix: str
    cut: bool = False
    closed: list[Part] = field(default_factory=list)
    suffix: str = ""


def fragment(text: str, by: Aligner) -> Fragment:
    """The fragment of a byte range."""
    cuts = [m.start() for m in CUT.finditer(text)] if by.cuts else []
    if not cuts:
        return Fragment(text)
    first, last = cuts[0], cuts[-1]
    return Fragment(text[:first], True, by.parts([text[first:last]]), text[last:])


def composed(x: Fragment, y: Fragment, by: Aligner) -> Fragment:
    """The fragment of two ranges in a row. Associative: units between cuts do not depend on how ranges were joined."""
    if not x.cut and not y.cut:
        return fragment(x.prefix + y.prefix, by)
    if x.cut and y.cut:
        middle = by.parts([x.suffix + y.prefix])
        return Fragment(x.prefix, True, [summed([*x.closed, *middle, *y.closed])], y.suffix)
    if x.cut:  # what follows the last cut grows, and may get cuts of its own
        grown = fragment(x.suffix + y.prefix, by)
        if not grown.cut:
            return Fragment(x.prefix, True, x.closed, grown.prefix)
        closed = summed([*x.closed, *by.parts([grown.prefix]), *grown.closed])
        return Fragment(x.prefix, True, [closed], grown.suffix)
    grown = fragment(x.prefix + y.prefix, by)
    if not grown.cut:
        return Fragment(grown.prefix, True, y.closed, y.suffix)
    closed = summed([*grown.closed, *by.parts([grown.suffix]), *y.closed])
    return Fragment(grown.prefix, True, [closed], y.suffix)


def finished(x: Fragment, by: Aligner) -> Part:
    """The whole text's part: its start and its end are cuts too."""
    return summed([*by.parts([x.prefix]), *x.closed, *by.parts([x.suffix])])


FRAGMENTS = pa.schema(
    [("key", pa.int64()), ("place", pa.int64()), ("doc_id", pa.int64()), ("prefix", pa.string()),
     ("cut", pa.bool_()), ("suffix", pa.string()), ("n_a", pa.int64()), ("n_b", pa.int64()),
     ("n_groups", pa.int64()), ("n_links", pa.int64()), ("text", pa.string()), ("codes", pa.binary()),
     ("occ", pa.binary()), ("bad", pa.bool_())]
)
FRAGMENTS_DDL = (
    "key long, place long, doc_id long, prefix string, cut boolean, suffix string, n_a long, n_b long, n_groups long, "
    "n_links long, text string, codes binary, occ binary, bad boolean"
)
BLOCKS_DDL = (
    "block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "groups_sha256 array<string>, sizes array<long>, links binary, occ binary, pairs binary, held binary"
)


def _fragment_row(key: int, place: int, doc_id: int | None, x: Fragment) -> tuple:
    p = summed(x.closed) if x.closed else Part()
    return key, place, doc_id, x.prefix, x.cut, x.suffix, p.n_a, p.n_b, p.n_groups, p.n_links, p.text, p.codes, p.occ, p.bad


def _fragment_of(row: dict) -> Fragment:
    closed = Part(*[row[c] for c in ("n_a", "n_b", "n_groups", "n_links", "text", "codes", "occ", "bad")])
    return Fragment(row["prefix"], row["cut"], [closed], row["suffix"])


def _fragment_table(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in FRAGMENTS]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, FRAGMENTS, strict=True)], schema=FRAGMENTS
    )


class Block:
    """Aligned documents of one task, their id pairs numbered together."""

    def __init__(self, number: int):
        self.number, self.docs, self.links = number, [], 0

    def add(self, doc_id: int | None, part: Part) -> None:
        if part.bad:
            part = Part()
        digest = hashlib.sha256(part.text.encode()).hexdigest() if part.n_groups else ""
        codes = np.frombuffer(part.codes, np.int64)
        if len(codes) and not np.all(codes[1:] > codes[:-1]):
            part = summed([part, Part()])
            codes = np.frombuffer(part.codes, np.int64)
        self.docs.append((doc_id, part.n_a, part.n_b, part.n_groups, part.n_links, digest, codes, part.occ))
        self.links += len(codes)

    def full(self) -> bool:
        return self.links >= BLOCK_LINKS or len(self.docs) >= BLOCK_DOCS

    def row(self) -> pa.RecordBatch:
        ids, n_a, n_b, n_groups, n_links, digests, codes, occ = zip(*self.docs, strict=True)
        pairs, links, held = np.unique(np.concatenate(codes), return_inverse=True, return_counts=True)
        lists = [pa.array([list(x)], pa.list_(pa.int64())) for x in (ids, n_a, n_b, n_groups, n_links)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([self.number], pa.int64()), *lists, pa.array([list(digests)], pa.list_(pa.string())),
                pa.array([[len(c) for c in codes]], pa.list_(pa.int64())),
                pa.array([links.astype(np.uint32).tobytes()], pa.binary()), pa.array([b"".join(occ)], pa.binary()),
                pa.array([pairs.tobytes()], pa.binary()), pa.array([held.astype(np.int64).tobytes()], pa.binary()),
            ],
            names=[c.split()[0] for c in BLOCKS_DDL.split(", ")],
        )


def _blocks(rows: Iterator[tuple[int | None, Part]], kind: int) -> Iterator[pa.RecordBatch]:
    """Rows of aligned documents as blocks; numbers tell kind, task and flush apart."""
    number = (kind << 62) | (TaskContext.get().partitionId() << 32)
    block = Block(number)
    for doc_id, part in rows:
        block.add(doc_id, part)
        if block.full():
            yield block.row()
            block = Block(block.number + 1)
    if block.docs:
        yield block.row()


def _short(first: str, second: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = aligner(first, second)

        def parts() -> Iterator[tuple[int | None, Part]]:
            for batch in batches:
                for at in range(0, batch.num_rows, ROWS):
                    rows = batch.slice(at, ROWS)
                    texts = [" " + t if t else "" for t in rows.column("text").to_pylist()]
                    yield from zip(rows.column("doc_id").to_pylist(), by.parts(texts), strict=True)

        with task_memory():
            yield from _blocks(parts(), 0)
            by.forget()

    return run


def _ranges(chunk_bytes: int):
    """Byte ranges of long texts, ends moved to the next character: key, place, doc_id, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = TaskContext.get().partitionId() << 32
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                data, start, place = b" " + text.encode("utf-8", "surrogatepass"), 0, 0
                while start < len(data):
                    end = start + chunk_bytes
                    while end < len(data) and data[end] & 0xC0 == 0x80:
                        end += 1
                    yield pa.RecordBatch.from_pydict(
                        {"key": [key], "place": [place], "doc_id": pa.array([doc_id], pa.int64()),
                         "text": [data[start:end].decode("utf-8", "surrogatepass")]}
                    )
                    start, place = end, place + 1
                key += 1

    return run


def _fragments(first: str, second: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = aligner(first, second)
        with task_memory():
            for batch in batches:
                for r in batch.to_pylist():
                    found = fragment(r["text"], by)
                    yield _fragment_table([_fragment_row(r["key"], r["place"], r["doc_id"], found)])
            by.forget()

    return run


def _compose(first: str, second: str, fan_in: int):
    def run(rows: pa.Table) -> pa.Table:
        by = aligner(first, second)
        found = sorted(rows.to_pylist(), key=lambda r: r["place"])
        whole = _fragment_of(found[0])
        for r in found[1:]:
            whole = composed(whole, _fragment_of(r), by)
        by.forget()
        row = _fragment_row(found[0]["key"], found[0]["place"] // fan_in, found[0]["doc_id"], whole)
        return pa.Table.from_batches([_fragment_table([row])])

    return run


def _finish(first: str, second: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = aligner(first, second)
        rows = (r for batch in batches for at in range(batch.num_rows) for r in batch.slice(at, 1).to_pylist())
        with task_memory():
            yield from _blocks(((r["doc_id"], finished(_fragment_of(r), by)) for r in rows), 1)
            by.forget()

    return run


def _long_blocks(texts: DataFrame, first: str, second: str, chunk_bytes: int, fan_in: int) -> DataFrame:
    """Blocks of the documents that are longer than a byte range."""
    ranges = stored(texts.mapInArrow(_ranges(chunk_bytes), "key long, place long, doc_id long, text string"), "align-ranges")
    dealt = ranges.repartition("key", "place")
    level = stored(dealt.mapInArrow(_fragments(first, second), FRAGMENTS_DDL), "align-fragments")
    while level.agg(F.max("place")).first()[0]:
        by_parent = level.groupBy("key", F.expr(f"place div {fan_in}").alias("parent"))
        level = stored(by_parent.applyInArrow(_compose(first, second, fan_in), FRAGMENTS_DDL), "align-fragments")
    return level.mapInArrow(_finish(first, second), BLOCKS_DDL)


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            pairs, held = np.frombuffer(r["pairs"], np.int64), np.frombuffer(r["held"], np.int64)
            block = pa.array(np.full(len(pairs), r["block"]))
            yield pa.RecordBatch.from_arrays([block, pa.array(pairs), pa.array(held)], ["block", "pair", "held"])


RESULT_DDL = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


def _counted(blocks: pa.Table, counts: pa.Table) -> pa.Table:
    """The documents of one block with the corpus-wide counts of its pairs."""
    block = blocks.to_pylist()[0]
    order = np.argsort(counts.column("pair").to_numpy())
    n, best = (counts.column(c).to_numpy()[order].astype(np.int64) for c in ("n", "best"))
    links, occ = np.frombuffer(block["links"], np.uint32), np.frombuffer(block["occ"], np.int64)
    ends = np.cumsum([0, *block["sizes"]])

    def per_document(values: np.ndarray) -> pa.Array:
        total = np.r_[0, np.cumsum(values)]
        return pa.array(total[ends[1:]] - total[ends[:-1]], pa.int64())

    kept = [pa.array(block[c], pa.int64()) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
    added = [per_document(occ * best[links]), per_document(occ * n[links])]
    return pa.table(
        [*kept, *added, pa.array(block["groups_sha256"], pa.string())],
        names=[c.split()[0] for c in RESULT_DDL.split(", ")],
    )


def align(
    docs: DataFrame, first: str, second: str, chunk_bytes: int = CHUNK_BYTES, fan_in: int = FAN_IN
) -> DataFrame:
    """Token alignment of every whole text by a byte-level BPE file and a sentencepiece model.

    Returns doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256, one row per input row. The first tokenizer reads a blank and
    the text, the second the text, to which it adds the blank itself. Byte
    offsets where tokens of both end cut the text into groups; all pairs of
    token occurrences of a group are links. A pair's count is the number of
    documents that hold it linked; ``n_best`` counts the links whose count is
    the highest of their first id, ``count_sum`` adds the counts over the links.

    Texts above ``chunk_bytes`` are dealt over tasks as byte ranges and composed
    ``fan_in`` at a time. Documents are aligned once and kept in blocks of
    bounded size with the distinct pairs of each; only these pairs travel to be
    counted and come back, so a pair that all documents hold is one row a block.

    A missing or empty text, and one that either tokenizer does not give back
    byte by byte, has no tokens: zeros and an empty digest. Repeated rows count
    as documents of their own; a missing id is kept; an empty table gives no
    rows; other columns are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    long = F.octet_length("text") >= chunk_bytes
    short = texts.filter(~long).mapInArrow(_short(first, second), BLOCKS_DDL)
    composed_blocks = _long_blocks(texts.filter(long), first, second, chunk_bytes, fan_in)
    blocks = stored(short.unionByName(composed_blocks), "align-blocks", "zstd")
    held = blocks.select("block", "pairs", "held").mapInArrow(_unpack, "block long, pair long, held long")
    # An id has at most as many partners as the second tokenizer has ids.
    of_first = Window.partitionBy(F.shiftright("pair", 32))
    counts = held.groupBy("pair").agg(F.sum("held").alias("n"))
    counts = counts.select("pair", "n", (F.col("n") == F.max("n").over(of_first)).alias("best"))
    found = held.select("block", "pair").join(stored(counts, "align-counts"), "pair")
    by_block = blocks.drop("pairs", "held").groupBy("block")
    return by_block.cogroup(found.groupBy("block")).applyInArrow(_counted, RESULT_DDL)
