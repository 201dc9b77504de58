"""How texts are cut into parts, and that a part met again in the same texts costs no look-up."""

from __future__ import annotations

import random
import re

import pytest
from tokenizers import Tokenizer

from tiffin.llm import encoding
from tiffin.llm.encoding import LETTERS, WordEncoder, parts, tokenizer_path

# A part, written as a pattern.
PATTERNS = {
    True: rf" ?[{LETTERS}]+|(?:[^{LETTERS} ]| (?![{LETTERS}]))+(?:(?<=['\t-\r])[{LETTERS}]+)?",
    False: rf"[{LETTERS}]+|[^{LETTERS}]+(?:(?<=')[{LETTERS}]+)?",
}
OFTEN = "ab Z  '\t\n\x0b\x0c\r.1-é×÷ßªºµ¿«\xad\xbf\xc0\xffĀɏ\x00~\x7f"


@pytest.mark.parametrize("keeps_space", [True, False])
def test_parts_are_those_of_the_pattern(keeps_space):
    rng = random.Random(3)
    every = [chr(c) for c in range(0x250)]
    for _ in range(3000):
        letters = OFTEN if rng.random() < 0.8 else every
        texts = ["".join(rng.choices(letters, k=rng.randrange(14))) for _ in range(rng.randrange(1, 6))]
        words, ends = parts(texts, keeps_space)
        found = words.to_pylist()
        got = [found[i:j] for i, j in zip([0, *ends.tolist()], ends.tolist(), strict=False)]
        assert got == [re.findall(PATTERNS[keeps_space], t) for t in texts], texts


def test_a_part_is_looked_up_once_for_all_its_places():
    class Counted(dict):
        asked = 0

        def __getitem__(self, word):
            Counted.asked += 1
            return super().__getitem__(word)

    path = tokenizer_path("byte_bpe_50k.json")
    encoder = WordEncoder(path, True)
    encoder.memo = Counted()
    text = "again and again " * 500
    want = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    assert [list(memoryview(ids).cast("I")) for ids in encoder.encode([text] * 3)] == [want] * 3
    assert Counted.asked < 10


def test_texts_stay_in_order_over_chunks(monkeypatch):
    """Chunks of a few texts, with empty ones and ones that go whole between them."""
    monkeypatch.setattr(encoding, "CHUNK_CHARS", 12)
    path = tokenizer_path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    texts = ["", "one two", "語", "", "three ", " four, five", "a\x1cb", "six's", "", "   ", "語 seven"]
    for last in range(len(texts) + 1):
        got = WordEncoder(path, True).encode(texts[:last])
        assert [list(memoryview(ids).cast("I")) for ids in got] == [
            plain.encode(t, add_special_tokens=False).ids for t in texts[:last]
        ]
