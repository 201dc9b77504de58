"""What a table keeps about the keys of its directories: least and greatest key, and a Bloom filter.

The filter is a row per word of 64 bits: a key's hash chooses the word and ``FUNCTIONS``
bits of it. So a key is one row of one hash aggregate, whatever the size of the
directory, and nothing of the size of the keys reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FUNCTIONS = 4
WORD = 64  # bits
KEYS_PER_WORD = 2  # at most, on average: about one key in a thousand passes that is not there
# With more keys than this, some pass any filter by chance, and asking costs more than reading the stored keys.
ASKED_KEYS = 4_096

FILTER_SCHEMA = "path string, words bigint, word bigint, mask bigint"


def words_for(rows: int) -> int:
    """Words of the filter of so many keys: a power of two."""
    return 1 << max(0, -(-rows // KEYS_PER_WORD) - 1).bit_length()


def _mask(hashed: Column) -> Column:
    """``FUNCTIONS`` bits of a word, by the last six bits each of a hash."""
    bit = lambda i: F.shiftright(hashed, 6 * i).bitwiseAND(F.lit(WORD - 1)).cast("int")
    return reduce(Column.bitwiseOR, [F.call_function("shiftleft", F.lit(1).cast("bigint"), bit(i)) for i in range(FUNCTIONS)])


def _placed(keyed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keyed`` (with a column words) with word and mask of its keys."""
    place = F.pmod(F.xxhash64(F.lit("word"), *keys), F.col("words"))
    return keyed.withColumn("word", place).withColumn("mask", _mask(F.xxhash64(*keys)))


def spans(stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """path, rows and the least and greatest first key of every directory; ``stored`` has path and the keys."""
    return stored.groupBy("path").agg(
        F.count("*").alias("rows"), F.min(keys[0]).cast("string").alias("low"), F.max(keys[0]).cast("string").alias("high")
    )


def filters(stored: DataFrame, sizes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The filters of the directories; ``sizes`` has path and words, a row per directory."""
    found = _placed(stored.select("path", *keys).join(F.broadcast(sizes), "path"), keys)
    return found.groupBy("path", "words", "word").agg(F.bit_or("mask").alias("mask"))


def may_hold(held: DataFrame, batch: DataFrame, keys: Sequence[str], sizes: Sequence[int]) -> DataFrame:
    """Directories (path) whose filter passes at least one key of ``batch``, which is small.

    ``held`` are the filters of the directories in question, ``sizes`` the
    numbers of words among them. A directory is left out only if it surely holds
    none of the keys; one whose filter was written in another form stays.
    """
    asked = batch.select(*keys).withColumn("words", F.explode(F.array(*[F.lit(n).cast("long") for n in sizes])))
    asked = _placed(asked, keys).select("words", "word", F.col("mask").alias("wanted")).distinct()
    passed = held.join(F.broadcast(asked), ["words", "word"]).filter(F.col("mask").bitwiseAND(F.col("wanted")) == F.col("wanted"))
    return passed.select("path").unionByName(held.filter("words IS NULL").select("path")).distinct()
