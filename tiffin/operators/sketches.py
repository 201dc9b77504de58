"""Sketches that are stored per day and merged for any period: quantiles (KLL) and distinct counts (HLL, Theta)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RANK_SIZE = 800  # of a quantile sketch: ranks are off by well under RANK_ERROR
RANK_ERROR = 0.02
COUNT_BITS = 14  # of a distinct sketch: relative standard error about 0.8 %
COUNT_ERROR = 0.05


def quantile_sketches(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One sketch of ``value`` per group: keys, sketch. Missing values take no part; groups without values are left out."""
    held = df.filter(F.col(value).isNotNull())
    return held.groupBy(*keys).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(RANK_SIZE)).alias("sketch"))


def merged_quantiles(sketches: DataFrame, keys: Sequence[str], wanted: dict[str, float]) -> DataFrame:
    """Quantiles of the values behind all sketches of each group, by column name; ranks are within ``RANK_ERROR``."""
    merged = sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    found = [F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias(name) for name, q in wanted.items()]
    return merged.select(*keys, F.kll_sketch_get_n_double("sketch").alias("n"), *found)


def distinct_sketches(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One sketch of the distinct values per group: keys, sketch."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(value, COUNT_BITS).alias("sketch"))


def rolling_distinct(sketches: DataFrame, day: str, days: int) -> DataFrame:
    """Distinct values of the ``days`` days up to each day that has a sketch: day, distinct.

    A day's sketch is sent to the windows it belongs to and united there, so
    rows are read once, when their day is sketched.
    """
    later = F.explode(F.sequence(F.col(day), F.date_add(day, days - 1)))
    ends = sketches.select(F.col(day).alias("_end")).distinct()
    spread = sketches.select(later.alias("_end"), "sketch").join(ends, "_end", "left_semi")
    return spread.groupBy(F.col("_end").alias(day)).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct"))


def exact_rolling_distinct(df: DataFrame, day: str, value: str, days: int) -> DataFrame:
    """The same without sketches: day, distinct, for each day that has a row.

    A value counts from a day it comes on until ``days`` later or until it comes
    again. So a row makes two changes whatever the length of the window, and
    only their sums, a row per day, are added up in one task.
    """
    seen = df.filter(F.col(day).isNotNull()).select(F.col(day).alias("_day"), F.col(value).alias("_value")).distinct()
    again = F.lead("_day").over(Window.partitionBy("_value").orderBy("_day"))
    spans = seen.filter("_value IS NOT NULL").withColumn("_until", F.least(F.date_add("_day", days), again))
    changes = spans.select(F.inline(F.array(
        F.struct(F.col("_day"), F.lit(1).alias("_change"), F.lit(1).alias("_rows")),
        F.struct(F.col("_until").alias("_day"), F.lit(-1).alias("_change"), F.lit(0).alias("_rows")),
    )))
    missing = seen.filter("_value IS NULL").select("_day", F.lit(0).alias("_change"), F.lit(1).alias("_rows"))
    by_day = changes.unionByName(missing).groupBy("_day").agg(F.sum("_change").alias("_change"), F.sum("_rows").alias("_rows"))
    to_here = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, 0)
    running = by_day.withColumn("distinct", F.sum("_change").over(to_here)).filter("_rows > 0")
    return running.select(F.col("_day").alias(day), "distinct")


def period_sketches(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Sketches that can be intersected: keys, sketch."""
    return df.groupBy(*keys).agg(F.theta_sketch_agg(value, COUNT_BITS).alias("sketch"))


def returning(sketches: DataFrame, period: str, earlier: str = "earlier") -> DataFrame:
    """Values of each period that the one before had too: period, distinct, returning. Periods are whole numbers."""
    before = sketches.select((F.col(period) + 1).alias(period), F.col("sketch").alias(earlier))
    both = sketches.join(before, period, "left")
    shared = F.theta_sketch_estimate(F.theta_intersection("sketch", earlier))
    return both.select(
        period,
        F.theta_sketch_estimate("sketch").alias("distinct"),
        F.when(F.col(earlier).isNull(), F.lit(0).cast("bigint")).otherwise(shared).alias("returning"),
    )
