from __future__ import annotations

import random

import pytest
from tokenizers import Tokenizer

from tiffin.llm.encoding import WordEncoder, tokenizer_path
from tiffin.llm.tokens import token_counts

FILES = [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)]
PARTS = [
    "word", "Wörter", " ", "  ", "   ", "\n", "\n\n", "\t", "\r\n", "'s", "'", "''", "don't", "I'LL", "12", "3", ".", ",", "...",
    "é", "É", "́", "naª", "µm", "α", "语言", "😀", " ", " ", "\x1c", "\x85", "<|endoftext|>", "<|startoftext|>", "<|",
    "×", "÷", "ǅ", "ı", "İ", "ß", "-", "_", "\x00", "​", "A", "zz", "(''s", "x'restaurant", "_word",
]


@pytest.mark.parametrize(("name", "keeps_space"), FILES)
def test_words_chain_to_the_same_ids(name, keeps_space):
    rng = random.Random(1)
    texts = ["".join(rng.choices(PARTS, k=rng.randrange(1, 12))) for _ in range(6000)] + ["", " ", "\n \n", "a" * 5000]
    encoder = WordEncoder(tokenizer_path(name), keeps_space)
    plain = Tokenizer.from_file(tokenizer_path(name))
    got = encoder.encode(texts)
    for text, ids in zip(texts, got, strict=True):
        want = plain.encode(text, add_special_tokens=False).ids
        assert list(memoryview(ids).cast("I")) == want, text


def brute(rows, name, limit):
    plain = Tokenizer.from_file(tokenizer_path(name))
    out = []
    for doc_id, text in rows:
        n = len(plain.encode(text or "", add_special_tokens=False).ids)
        out.append((doc_id, len((text or "").encode()), n, n > limit))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("name", "keeps_space"), FILES)
def test_edge_rows_cold_and_warm(edge_docs, tmp_path, name, keeps_space):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.select("doc_id", "text").collect()]
    cache = str(tmp_path / "cache")

    def count(docs):
        got = token_counts(docs, tokenizer_path(name), cache=cache, limit=2048, keeps_space=keeps_space)
        return sorted((tuple(r) for r in got.drop("digest").collect()), key=repr)

    some = [r for r in rows if r[0] in (1, 4, 7)]
    assert count(edge_docs.filter("doc_id in (1, 4, 7)")) == brute(some, name, 2048)
    before = edge_docs.sparkSession.read.parquet(cache).count()
    assert count(edge_docs) == brute(rows, name, 2048)
    after = edge_docs.sparkSession.read.parquet(cache)
    assert after.count() > before and after.count() == after.select("version", "digest").distinct().count()
    assert count(edge_docs) == brute(rows, name, 2048)
    assert edge_docs.sparkSession.read.parquet(cache).count() == after.count()


def test_a_cache_of_another_tokenizer_is_not_used(spark, tmp_path):
    cache = str(tmp_path / "cache")
    docs = spark.createDataFrame([(1, "Internationalization of words")], "doc_id long, text string")
    a = token_counts(docs, tokenizer_path("word_bpe_49k.json"), cache=cache).first()["n_tokens"]
    b = token_counts(docs, tokenizer_path("byte_bpe_50k.json"), cache=cache, keeps_space=True).first()["n_tokens"]
    assert [(1, 29, a, False)] == brute([(1, "Internationalization of words")], "word_bpe_49k.json", 2048)
    assert [(1, 29, b, False)] == brute([(1, "Internationalization of words")], "byte_bpe_50k.json", 2048)


def test_empty_table(no_docs):
    assert token_counts(no_docs, tokenizer_path("word_bpe_49k.json")).count() == 0
