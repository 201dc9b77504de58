"""Language identification with hyperdimensional n-gram profiles."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiffin.llm.common import bucket_of_id, drawn, task_memory, whole_text

DIMENSIONS = 1024
SEED = 20
UNKNOWN = "und"
DOCS_PER_LANGUAGE = 1_000  # bound of the learning sample
ROWS = 256  # texts worked on together
SEGMENT_CHARS = 1_000_000  # characters counted at a time
GRAM_BLOCK = 8_192  # n-gram vectors held at a time
BLANK = 0  # code of everything that is not a letter


def letter_vectors(codes: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """A random vector of +1 and -1 for every code point; the same one wherever it is drawn."""
    draws = [np.random.default_rng([SEED, int(c)]).integers(0, 2, dimensions, dtype=np.int8) for c in codes]
    return np.array(draws, dtype=np.float32).reshape(len(codes), dimensions) * 2 - 1


def document_vectors(texts: list[str], dimensions: int = DIMENSIONS) -> np.ndarray:
    """Bundled trigram vectors, one row per text; a text without letters is a zero row.

    A text is its lower-cased letters, each run of other characters one blank,
    with a blank at both ends. The vector of a trigram binds (multiplies) the
    vectors of its letters, the first rotated twice, the second once.
    """
    out = np.zeros((len(texts), dimensions), dtype=np.float32)
    for owners, pieces in _segments([t.lower() for t in texts]):
        points = np.frombuffer("".join(pieces).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
        text = np.repeat(np.arange(len(pieces)), [len(p) for p in pieces])
        seen = np.zeros(sys.maxunicode + 1, dtype=bool)
        seen[points] = True
        letters = np.array([BLANK] + [v for v in np.flatnonzero(seen).tolist() if chr(v).isalpha()])
        number = np.zeros(len(seen), dtype=np.int64)
        number[letters] = np.arange(len(letters))
        codes = number[points]
        starts = np.append(True, text[1:] != text[:-1])
        kept = starts | (codes > 0) | np.append(True, codes[:-1] > 0)
        codes, text = codes[kept], text[kept]
        k = len(letters)
        gram = (codes[:-2] * k + codes[1:-1]) * k + codes[2:]
        whole = text[:-2] == text[2:]
        row = text[:-2][whole]
        grams, place = _numbered(gram[whole], k**3)
        counts = np.bincount(row * len(grams) + place, minlength=len(pieces) * len(grams))
        counts = counts.reshape(len(pieces), len(grams)).astype(np.float32)
        base = letter_vectors(letters, dimensions)
        once, twice = np.roll(base, 1, axis=1), np.roll(base, 2, axis=1)
        found = np.zeros((len(pieces), dimensions), dtype=np.float32)
        for at in range(0, len(grams), GRAM_BLOCK):
            g = grams[at : at + GRAM_BLOCK]
            bound = twice[g // (k * k)]
            bound *= once[g // k % k]
            bound *= base[g % k]
            found += counts[:, at : at + GRAM_BLOCK] @ bound
        np.add.at(out, owners, found)
    return out


def _numbered(values: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order and each value's place among them; ``bound`` is above all of them."""
    if bound > 1 << 23:
        return np.unique(values, return_inverse=True)
    seen = np.zeros(bound, dtype=bool)
    seen[values] = True
    distinct = np.flatnonzero(seen)
    number = np.zeros(bound, dtype=np.int64)
    number[distinct] = np.arange(len(distinct))
    return distinct, number[values]


def _segments(texts: list[str]) -> Iterator[tuple[np.ndarray, list[str]]]:
    """(text numbers, padded pieces) of bounded size; a long text comes in pieces that overlap by two characters."""
    owners, held, n = [], [], 0
    for i, text in enumerate(texts):
        padded = f" {text} "
        for at in range(0, max(1, len(padded) - 2), SEGMENT_CHARS):
            piece = padded[at : at + SEGMENT_CHARS + 2]
            if held and n + len(piece) > SEGMENT_CHARS:
                yield np.array(owners), held
                owners, held, n = [], [], 0
            owners.append(i)
            held.append(piece)
            n += len(piece)
    if held:
        yield np.array(owners), held


@dataclass(frozen=True)
class Prototypes:
    """Unit vectors of the learned languages."""

    languages: tuple[str, ...]
    vectors: np.ndarray

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and cosine (not below 0) of each text; ``und`` and 0 without letters or languages."""
        found = document_vectors(texts, self.vectors.shape[1])
        length = np.linalg.norm(found, axis=1)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        cosine = found @ self.vectors.T / np.where(length > 0, length, 1)[:, None]
        best = cosine.argmax(axis=1)
        names = [self.languages[b] if n > 0 else UNKNOWN for b, n in zip(best, length, strict=True)]
        return names, np.where(length > 0, cosine.max(axis=1), 0).clip(0, 1).astype(float)


def learn(
    labelled: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE, dimensions: int = DIMENSIONS
) -> Prototypes:
    """Prototypes from a bounded sample of ``labelled`` (doc_id, text, lang).

    Of every language the ``docs_per_language`` documents with the smallest hash
    are used, whole texts of any length. Rows are counted per language first, so
    only about twice that many of each are put in order. Tasks bundle their
    documents; one vector per task and language reaches the driver.
    """
    usable = labelled.filter("lang is not null and text is not null")
    counts = usable.groupBy("lang").agg(F.count("*").alias("n_lang"))
    drawing = usable.select("doc_id", "lang", "text", F.xxhash64("doc_id", "text").alias("draw")).join(counts, "lang")
    sample = (
        drawing.filter(drawn(F.col("draw"), docs_per_language, F.col("n_lang")))
        .withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("draw", "doc_id")))
        .filter(F.col("place") <= docs_per_language)
    )

    def bundle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with task_memory():
            for batch in batches:
                for at in range(0, len(batch), ROWS):
                    rows = batch.iloc[at : at + ROWS]
                    vectors = document_vectors(rows["text"].tolist(), dimensions)
                    for lang, places in rows.groupby("lang").indices.items():
                        total = vectors[places].sum(axis=0).astype(float).tolist()
                        yield pd.DataFrame({"lang": [lang], "vector": [total]})

    sums: dict[str, np.ndarray] = {}
    for row in sample.select("lang", "text").mapInPandas(bundle, "lang string, vector array<double>").toLocalIterator():
        sums[row["lang"]] = sums.get(row["lang"], 0) + np.array(row["vector"])
    names = tuple(sorted(name for name, v in sums.items() if np.linalg.norm(v) > 0))
    vectors = np.array([sums[n] / np.linalg.norm(sums[n]) for n in names], dtype=np.float32).reshape(-1, dimensions)
    return Prototypes(names, vectors)


def language_of(prototypes: Prototypes, text: Column) -> Column:
    """Struct of language and score of a text column."""

    def predict(texts: pd.Series) -> pd.DataFrame:
        names, score = prototypes.predict(texts.fillna("").tolist())
        return pd.DataFrame({"lang_pred": names, "score": score})

    return F.pandas_udf(predict, "lang_pred string, score double")(text)


def identify(docs: DataFrame, folds: int = 5, held_out: int = 0, **options) -> DataFrame:
    """Language of every whole text: doc_id, held_out, lang_pred, score, one row per input row.

    Learns from text and lang of documents whose crc32(id) modulo ``folds`` is
    not ``held_out``; prediction sees the text alone. A missing text, or one
    without a letter, is ``und`` with score 0, and so is every text if nothing
    could be learned. An empty table gives no rows; repeated rows repeat; other
    columns are ignored.
    """
    out_of_sample = bucket_of_id(folds) == held_out
    prototypes = learn(docs.filter(~out_of_sample).select("doc_id", "text", "lang"), **options)
    found = docs.select(
        "doc_id", out_of_sample.alias("held_out"), language_of(prototypes, whole_text()).alias("found")
    )
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score")
