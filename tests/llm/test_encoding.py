"""Which words a task encodes again."""

from __future__ import annotations

from tokenizers import Tokenizer

from tiffin.llm import encoding
from tiffin.llm.encoding import WordEncoder, tokenizer_path


def test_common_words_outlive_a_full_memory(monkeypatch):
    """Rare words fill the memory over and over; words met in every slice of texts are encoded once."""
    monkeypatch.setattr(encoding, "MEMO_BYTES", 40_000)
    path = tokenizer_path("byte_bpe_50k.json")
    encoder, encoded = WordEncoder(path, True), []
    by_row, by_library = encoder._row, encoder._by_library
    monkeypatch.setattr(encoder, "_row", lambda words: encoded.extend(words) or by_row(words))
    monkeypatch.setattr(encoder, "_by_library", lambda texts: encoded.extend(texts) or by_library(texts))
    plain = Tokenizer.from_file(path)
    letters = "abcdefghijklmnopqrst"
    for i in range(60):
        rare = "".join(f" {letters[i % 20]}{letters[i // 20]}{a}{b}" for a in letters[:5] for b in letters[:8])
        text = f"Common words return.{rare}"
        assert list(memoryview(encoder.encode([text])[0]).cast("I")) == plain.encode(text, add_special_tokens=False).ids
    assert encoded.count(" return") == 1 and encoded.count(" words") == 1
    assert len(encoder.memo) + len(encoder.older) < 400


def test_control_characters_and_added_tokens_go_whole():
    encoder = WordEncoder(tokenizer_path("byte_bpe_50k.json"), True)
    added = next(t.content for t in encoder.tokenizer.get_added_tokens_decoder().values() if t.content.isascii())
    assert all(encoder._is_whole(t) for t in (f"a{added}b", "a\x1cb", "a\x1fb", "é\x85", "α"))
    assert not any(encoder._is_whole(t) for t in ("", "plain text.\n", "é", added[:-1]))
