"""From raw documents to packed training sequences, five stages that each write what they keep."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.llm import exact_dedup, mixing, near_dedup, packing, quality
from tiffin.llm.common import stored, table, whole_text
from tiffin.llm.encoding import tokenizer_path
from tiffin.session import configure

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text scores at least the threshold; a missing text is scored as an empty one.

    Where either label had no text to learn from, all documents are kept.
    """
    configure(spark)
    model = quality.learn_from(docs, table(spark, sf_dir, "labels"))
    if not model.learned:
        return docs
    return docs.filter(quality.quality_of(model, whole_text()) >= F.lit(quality.THRESHOLD))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that are equal up to white space."""
    configure(spark)
    return exact_dedup.without_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8 or more."""
    configure(spark)
    return near_dedup.without_near_duplicates(docs, words=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, repeated for every epoch that reaches them; texts stay whole."""
    configure(spark)
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 tokens; a document taken twice is packed twice."""
    configure(spark)
    return packing.pack(docs, tokenizer_path(packing.TOKENIZER))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_good),
    ("exact dedup", drop_exact_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]

# Compression, MinHash and the tokenizer have no counterpart in SQL; the tests hold
# every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{number}")
    return docs
