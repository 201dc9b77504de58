"""What the operators share: reading tables, written intermediate tables, word rules."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.session import scratch_dir

# The white space that separates words and is ignored by exact dedup.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written to the shared scratch folder and read again.

    Cuts the lineage: a lost executor costs its own tasks only, and every later
    use sees the same rows in the same blocks.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def bucket_of_id(parts: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``parts``; a missing id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))), F.lit(parts))


@contextmanager
def task_memory() -> Iterator[None]:
    """Gives memory that a task freed back to the machine at its end; workers live on from task to task."""
    try:
        yield
    finally:
        import pyarrow as pa

        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # another C library
            pass


def drawn(hashed: Column, wanted: int, out_of: Column) -> Column:
    """Whether a 64-bit hash is among the smallest: true for about twice ``wanted`` rows of ``out_of``.

    A rank over what is left costs no more than that many rows, whatever the
    size of the group. Small groups pass whole.
    """
    return hashed / F.lit(2.0**64) + 0.5 < F.lit(2.0 * wanted + 50) / F.greatest(out_of, F.lit(1))
