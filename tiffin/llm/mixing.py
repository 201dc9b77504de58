"""Mixing sources to target weights by hash order, distributed prefix sums and exact cuts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiffin.llm.common import WORD, stored, whole_text

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = "mix-1"


def word_count(column: str = "text") -> Column:
    return F.regexp_count(whole_text(column), F.lit(WORD)).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """Target of every source: columns no_source, source_key, source_size, target, budget.

    ``sizes`` has one row per source, so the windows here sort sources, not
    documents. Sources in code point order, the missing one last, get the
    weights in turn. Sharing the total by weight, capping at ``max_epochs``
    times the size and sharing the excess anew ends at one level: sorted by
    size / weight, the first source that its share does not overfill fixes the
    words per unit of weight for itself and all after it.
    """
    by_name = Window.orderBy("no_source", "source_key")
    weight = F.element_at(
        F.array(*[F.lit(int(w)) for w in weights]), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int")
    )
    ranked = sizes.withColumn("place", F.row_number().over(by_name)).withColumn("weight", weight)
    by_fill = Window.orderBy(F.col("source_size") / F.col("weight"), "place")
    everything = by_fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    after = by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("source_size").over(before), F.lit(0)) * max_epochs
    cap = F.col("source_size") * max_epochs
    level = left / F.sum("weight").over(after)
    return (
        ranked.withColumn("level", level)
        .withColumn("open", F.col("level") * F.col("weight") <= cap)
        .withColumn("level", F.first(F.when(F.col("open"), F.col("level")), ignorenulls=True).over(everything))
        .withColumn("target", F.when(F.col("open"), F.col("level") * F.col("weight")).otherwise(cap).cast("double"))
        .withColumn("budget", F.least(F.round("target").cast("long"), cap))
        .select("no_source", "source_key", "source_size", "target", "budget")
    )


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """Words that the mix takes of every document.

    Returns doc_id, source, size, source_size, target, taken, one row per input
    row. Documents are ordered by a hash of seed and id inside their source;
    whole epochs are taken while the budget lasts, and of the last epoch the
    first documents in that order, the one on the cut in part, so a source's
    taken words equal its rounded target.

    The order is split into ranges of (source, hash): a source of any size
    spreads over many blocks, each block adds up its own documents, and the
    sums of the earlier blocks (one row per block and source) are added to it.

    A missing text has size 0, a missing source is a source of its own, rows
    with equal ids are ordered by size (equal rows are interchangeable), an
    empty table gives no rows. Other columns are ignored.
    """
    keyed = docs.select(
        "doc_id",
        F.col("source").isNull().alias("no_source"),
        F.coalesce("source", F.lit("")).alias("source_key"),
        word_count().alias("size"),
        F.md5(F.concat_ws("|", F.lit(seed), F.col("doc_id").cast("string")).cast("binary")).alias("draw"),
    )
    order = ["draw", "doc_id", "size"]
    source = ["no_source", "source_key"]
    ranged = stored(
        keyed.repartitionByRange(*source, *order).withColumn("block", F.spark_partition_id()),
        "mix-order",
    )
    blocks = stored(ranged.groupBy(*source, "block").agg(F.sum("size").alias("block_size")), "mix-blocks")
    targets = source_targets(blocks.groupBy(*source).agg(F.sum("block_size").alias("source_size")), weights, max_epochs)
    earlier = Window.partitionBy(*source).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    cuts = blocks.withColumn("base", F.coalesce(F.sum("block_size").over(earlier), F.lit(0))).join(targets, source)
    running = Window.partitionBy(*source, "block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    epochs = F.expr("if(source_size = 0, 0, budget div source_size)")
    rest = F.expr("if(source_size = 0, 0, budget % source_size)")
    start = F.col("base") + F.coalesce(F.sum("size").over(running), F.lit(0))
    return (
        ranged.join(cuts, [*source, "block"])
        .withColumn("before", start)
        .withColumn("taken", epochs * F.col("size") + F.greatest(F.lit(0), F.least("size", rest - F.col("before"))))
        .select(
            "doc_id",
            F.when(~F.col("no_source"), F.col("source_key")).alias("source"),
            "size",
            "source_size",
            "target",
            F.col("taken").cast("long").alias("taken"),
        )
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with all their columns.

    A document that is taken in part comes whole, so a source overshoots its
    target by less than one document. Rows alike in id and source and size get
    the same number of copies; sizes of 0 are not taken.
    """
    plan = mix(docs, **options).filter("taken > 0").select(
        F.col("doc_id").alias("_mix_id"),
        F.col("source").alias("_mix_source"),
        F.col("size").alias("_mix_size"),
        F.expr("(taken + size - 1) div size").cast("int").alias("_mix_copies"),
    )
    plan = plan.groupBy("_mix_id", "_mix_source", "_mix_size").agg(F.max("_mix_copies").alias("_mix_copies"))
    counted = docs.withColumn("_mix_words", word_count())
    same = (
        F.col("doc_id").eqNullSafe(F.col("_mix_id"))
        & F.col("source").eqNullSafe(F.col("_mix_source"))
        & (F.col("_mix_words") == F.col("_mix_size"))
    )
    return (
        counted.join(plan, same)
        .withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_copies"))))
        .select(*docs.columns)
    )
