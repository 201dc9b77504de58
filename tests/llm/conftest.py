"""Rows that every operator must bear: nulls, blanks, long texts, ties, repeats and clashing columns."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

LONG = "lorem ipsum dolor sit amet " * 4000

# doc_id, text, lang, source
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away", "en", "a"),
    (2, "The  quick brown\tfox jumps over the lazy dog and runs away\n", "en", "a"),
    (3, "the quick brown fox jumps over the lazy dog and runs home", "en", "b"),
    (4, None, None, None),
    (5, "", "en", "b"),
    (6, " \n\t ", None, "a"),
    (7, LONG, "en", "a"),
    (8, LONG, "fr", None),
    (8, LONG, "fr", None),
    (9, "Ein kleiner Text über die Grüße", "de", ""),
    (None, "a text without an id", "en", "b"),
    (10, "one", "en", "b"),
    (11, "one", "en", "c"),
    (12, "x" * 5000, "en", "c"),
    (13, "emoji 😀 and <|endoftext|> inside don't  ''quote", "en", "c"),
    (14, "12 34 .. !!", "en", "c"),
    (15, "tab\there\n\nnew   lines\x0b\x0cand\x1cfile sep", "en", "d"),
]
# Names that the operators use themselves.
CLASHING = (
    "size block key draw score kept fp sha norm points digest node root token signature stack active kind host path "
    "rule verdict taken target budget before vector id cell best fill open slots group n a b"
).split()


@pytest.fixture(scope="session")
def edge_docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string").withColumn(
        "n_chars", F.length("text").cast("long")
    )
    return df.select("*", *[F.lit("clash").alias(c) for c in CLASHING]).repartition(5)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
