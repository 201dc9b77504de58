"""Token counts through a cache of content digests."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.llm.common import stored, whole_text
from tiffin.llm.encoding import file_digest, word_encoder
from tiffin.session import scratch_dir

TOKENIZER = "word_bpe_49k.json"
LIMIT = 2048
SLICE = 256  # texts encoded together
CACHE_SCHEMA = "version string, digest string, n_tokens long"


def content(column: str = "text", keeps_space: bool = False) -> Column:
    """What decides the count: the text, with white space runs as one blank where the tokenizer drops them."""
    text = whole_text(column)
    return text if keeps_space else F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " "))


def token_counts(
    docs: DataFrame, path: str, cache: str | None = None, limit: int = LIMIT, keeps_space: bool = False
) -> DataFrame:
    """Tokens of every whole text: doc_id, n_bytes, n_tokens, over_limit, digest, one row per input row.

    Counts live in the table ``cache``, keyed by the digest of the tokenizer
    file and the digest of the normalised content; without a folder named, a new
    one in the shared scratch folder. Only contents that it lacks are encoded,
    each once, and appended. A stopped run may leave rows that a later one
    appends again, so the cache is read as one count per key.

    A missing text is empty and has no tokens; repeated rows give repeated
    rows; an empty table gives none. Other columns are ignored.
    """
    spark = docs.sparkSession
    cache = cache or scratch_dir(spark, "token-cache")
    version = file_digest(path)
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").partitionBy("version").parquet(cache)

    def known() -> DataFrame:
        table = spark.read.schema(CACHE_SCHEMA).parquet(cache).filter(F.col("version") == version)
        return table.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))

    digest = F.sha2(content(keeps_space=keeps_space).cast("binary"), 256).alias("digest")
    slim = stored(
        docs.select("doc_id", F.octet_length(whole_text()).cast("long").alias("n_bytes"), digest), "token-slim"
    )
    missing = stored(slim.select("digest").distinct().join(known(), "digest", "left_anti"), "token-misses")
    # Copies are combined in the tasks before they travel.
    texts = (
        docs.select(whole_text().alias("text"), digest)
        .groupBy("digest")
        .agg(F.first("text").alias("text"))
        .join(missing, "digest", "left_semi")
    )
    (
        texts.mapInArrow(_counter(path, keeps_space), "digest string, n_tokens long")
        .select(F.lit(version).alias("version"), "digest", "n_tokens")
        .write.mode("append")
        .partitionBy("version")
        .parquet(cache)
    )
    return slim.join(known(), "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "digest"
    )


def _counter(path: str, keeps_space: bool):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with word_encoder(path, keeps_space) as encoder:
            for batch in batches:
                for start in range(0, batch.num_rows, SLICE):
                    part = batch.slice(start, SLICE)
                    sizes = [len(ids) // 4 for ids in encoder.encode(part.column("text").to_pylist())]
                    yield pa.RecordBatch.from_arrays(
                        [part.column("digest"), pa.array(sizes, pa.int64())], ["digest", "n_tokens"]
                    )

    return count
