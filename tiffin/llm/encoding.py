"""Token ids of whole texts by a tokenizer file; a task encodes each distinct word once."""

from __future__ import annotations

import hashlib
import itertools
import os
import re
import string
import sys
from array import array
from collections.abc import Iterator
from contextlib import contextmanager
from types import SimpleNamespace

import numpy as np
import pyarrow as pa

from tiffin.llm.common import task_memory

MEMO_BYTES = 96 << 20  # of words that a task remembers; beyond half of it, those not met since the last time go
ENTRY_BYTES = 250  # what an entry takes beside its characters and ids
MEMO_CHARS = 64  # longer words are not remembered
CHUNK_CHARS = 1 << 20  # texts are cut into words together until they have so many characters
# Letters below U+0250, written as ranges; texts with later characters, with the
# one letter whose lower case is more than letters, or with control characters
# and blanks that only some engines count as white space, go to the tokenizer
# whole.
LETTERS = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ"
ASCII_UNSAFE = "\x1c\x1d\x1e\x1f"
UNSAFE = r"[\x1c-\x1f\x85\xa0\u0130\u0250-\U0010ffff]"
# The same letters by the bytes they have in UTF-8; the few other characters among these are set by _is_letter.
LETTER_BYTES = np.isin(np.arange(256), [*string.ascii_letters.encode(), *range(0x80, 0xC0), *range(0xC3, 0xCA)])
# What takes the next letters along: an apostrophe may begin a contraction, and
# white space other than a blank is split by what follows.
JOINS = {keeps: np.isin(np.arange(256), list(joins)) for keeps, joins in ((True, b"'\t\n\v\f\r"), (False, b"'"))}


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def file_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def _is_letter(data: np.ndarray) -> np.ndarray:
    """For each byte of UTF-8 text of characters below U+0250 whether it belongs to a letter."""
    letter = LETTER_BYTES[data]
    at = np.flatnonzero(data[:-1] == 0xC2)
    letter[at] = letter[at + 1] = np.isin(data[at + 1], [0xAA, 0xB5, 0xBA])
    at = np.flatnonzero((data[:-1] == 0xC3) & ((data[1:] | 0x20) == 0xB7))  # the signs of times and division
    letter[at] = letter[at + 1] = False
    return letter


def parts(texts: list[str], keeps_space: bool) -> tuple[pa.Array, np.ndarray]:
    """The words of texts and what lies between them, all in a row, and the places in it where each text ends.

    With ``keeps_space`` a word has the blank before it, if any. Letters right
    after a character of JOINS are one part with what precedes them.
    """
    coded = [t.encode() for t in texts]
    data = b"".join(coded)
    if not data:
        return pa.array([], pa.large_string()), np.zeros(len(texts), np.int64)
    ends = np.cumsum([len(c) for c in coded])
    found = np.frombuffer(data, np.uint8)
    letter = _is_letter(found)
    begins = np.zeros(len(data), bool)
    begins[1:] = letter[1:] != letter[:-1]
    begins[1:] &= ~(letter[1:] & JOINS[keeps_space][found[:-1]])
    if keeps_space:
        leads = found == 0x20
        leads[:-1] &= letter[1:]
        leads[ends[ends > 0] - 1] = False
        begins[1:] &= ~leads[:-1]
        begins |= leads
    begins[ends[ends < len(data)]] = True
    begins[0] = True
    starts = np.flatnonzero(begins)
    offsets = np.append(starts, len(data))
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data))
    return words, np.searchsorted(starts, ends)


@contextmanager
def word_encoder(path: str, keeps_space: bool) -> Iterator[WordEncoder]:
    """The worker's encoder for this file; the tokenizer outlives a task, its words do not."""
    held = sys.modules.setdefault("tiffin_worker_encoders", SimpleNamespace(by_file={}))
    key = (path, keeps_space)
    if key not in held.by_file:
        held.by_file[key] = WordEncoder(path, keeps_space)
    encoder = held.by_file[key]
    with task_memory():
        try:
            yield encoder
        finally:
            encoder.forget()


class WordEncoder:
    """Ids of texts as little-endian unsigned 32-bit bytes, as the ``tokenizers`` library gives them.

    The pre-tokenizers used here never join a word with what follows it, so the
    ids of a text are those of its parts in a row. ``keeps_space`` says that a
    blank belongs to the word after it; else the tokenizer drops white space.
    Texts with an added token or an unsafe character are encoded whole.
    """

    def __init__(self, path: str, keeps_space: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = re.compile("|".join([UNSAFE, *map(re.escape, added)]))
        self.ascii_whole = [*ASCII_UNSAFE, *added]
        self.keeps_space = keeps_space
        self.in_a_row = re.compile(rf" [{LETTERS}]+").fullmatch if keeps_space else None
        vocabulary = self.tokenizer.get_vocab()
        self.lengths = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.lengths[list(vocabulary.values())] = list(map(len, vocabulary))
        self.forget()

    def forget(self) -> None:
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # met before ``memo`` was begun
        self.memo_bytes = 0

    def _is_whole(self, text: str) -> bool:
        """Whether a text goes to the tokenizer as it is."""
        if text.isascii():  # the same question, without a look at each character
            return any(stop in text for stop in self.ascii_whole)
        return self.whole.search(text) is not None

    def _by_library(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _row(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words with a blank before them, encoded as one text and taken apart by the bytes of its tokens.

        A byte-level token has a character for each of its bytes. Should a word
        not end where a token does, none is given.
        """
        ids = np.array(self.tokenizer.encode_batch_fast(["".join(words)], add_special_tokens=False)[0].ids, np.uint32)
        ends, reached = np.cumsum([len(w.encode()) for w in words]), np.cumsum(self.lengths[ids])
        at = np.searchsorted(reached, ends)
        if not len(ids) or at[-1] >= len(ids) or not np.array_equal(reached[at], ends):
            return {}
        cuts, data = [0, *(4 * (at + 1)).tolist()], ids.tobytes()
        return {w: data[i:j] for w, i, j in zip(words, cuts, cuts[1:], strict=False)}

    def _ids(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words, remembered if short."""
        if self.memo_bytes > MEMO_BYTES // 2:
            self.older, self.memo, self.memo_bytes = self.memo, {}, 0
        missing = [w for w in words if w not in self.memo]
        again = {w: self.older[w] for w in missing if w in self.older}
        new = [w for w in missing if w not in again]
        row = list(filter(self.in_a_row, new)) if self.in_a_row else []
        found = self._row(row) if row else {}
        left = [w for w in new if w not in found]
        found.update(zip(left, self._by_library(left), strict=True))
        for known in (again, found):
            self.memo.update(known)
            self.memo_bytes += ENTRY_BYTES * len(known) + sum(map(len, known)) + sum(map(len, known.values()))
        ids = list(map(self.memo.__getitem__, words))
        for w in [w for w in found if len(w) > MEMO_CHARS]:
            del self.memo[w]
        return ids

    def _in_parts(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of texts that may be cut; each distinct part of them is looked up once."""
        words, ends = parts(texts, self.keeps_space)
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = pa.array(self._ids(distinct), pa.large_binary()).take(coded.indices)
        _, offsets, data = ids.buffers()
        cuts = np.append(0, np.frombuffer(offsets, np.int64)[ends]) if len(ids) else np.zeros(len(ends) + 1, np.int64)
        return (data[i:j].to_pybytes() if i < j else b"" for i, j in itertools.pairwise(cuts.tolist()))

    def encode(self, texts: list[str]) -> list[bytes]:
        whole = [self._is_whole(t) for t in texts]
        out = [self._by_library([t])[0] if w else b"" for t, w in zip(texts, whole, strict=True)]
        at, size = [], 0
        for i, text in enumerate(texts):
            if not whole[i]:
                at.append(i)
                size += len(text)
            if at and (size >= CHUNK_CHARS or i == len(texts) - 1):
                for place, ids in zip(at, self._in_parts([texts[j] for j in at]), strict=True):
                    out[place] = ids
                at, size = [], 0
        return out
