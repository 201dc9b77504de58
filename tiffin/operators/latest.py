"""Latest version per key, last write wins, and fixed-size samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[Column | str], newest_first: Sequence[Column]) -> DataFrame:
    """One row per key: the first one in ``newest_first`` order.

    The ``= 1`` filter lets Spark keep one row per key in every map task before
    the shuffle, so a key with very many versions does not travel whole. The
    order must be total up to identical rows. Filter bad rows out before: a bad
    newest version then gives way to an older good one.
    """
    w = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def newest_load_first(hash_column: str = "_record_hash") -> list[Column]:
    """Order of the raw tables. Rows of one load share ``_ingested_at``, hence
    the file, the hash of all fields and the batch as tie-breakers."""
    return [
        F.desc_nulls_last("_ingested_at"),
        F.desc_nulls_last("_source_file"),
        F.desc_nulls_last(hash_column),
        F.desc_nulls_last("_batch_id"),
    ]


def fixed_sample(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """``n`` rows in random, repeatable order of a seeded hash of the key.

    Each task keeps its first ``n`` rows, so this is one pass and no full sort.
    Spark's own ``TABLESAMPLE (n ROWS)`` is a plain limit.
    """
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")))
    return df.orderBy(order, F.col(key)).limit(n)
