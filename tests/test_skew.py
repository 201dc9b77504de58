"""One key with a third of all rows: results stay whole and the work is split."""

from __future__ import annotations

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from tiffin.operators import quality
from tiffin.plans import marts, semantic

ROWS = 90_000


@contextmanager
def settings(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def small_partitions(spark):
    """The limits of a cluster scaled down to this data."""
    with settings(
        spark,
        {
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        },
    ):
        yield


def hot(column):
    return F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 1000 + 2).alias(column)


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()  # not the plan looked at; warms up
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_an_order_with_a_third_of_all_lines(spark, small_partitions):
    items = spark.range(ROWS, numPartitions=12).select(
        F.col("id").alias("order_item_id"), hot("order_id"), F.lit(1).alias("restaurant_id"), F.lit("f").alias("f_id"),
        F.lit(1).cast("decimal(10,2)").alias("price"), F.lit(1).alias("quantity"),
        F.lit(1).cast("decimal(10,2)").alias("line_amount"),
    )
    orders = spark.range(1, 1002).select(
        F.col("id").alias("order_id"), F.lit("2024-01-01").cast("timestamp_ntz").alias("order_timestamp"),
        F.lit("2024-01-01").cast("date").alias("order_date"), F.lit("c").alias("city"),
    )
    out = marts.fact_order_items(items, orders)
    assert "skew=true" in final_plan(out)
    assert out.count() == ROWS


def test_a_customer_with_a_third_of_all_orders(spark, small_partitions):
    columns = [c for c in semantic.VIEWS["sem_orders"][1] if c not in ("order_id", "customer_id", "age_segment")]
    orders = spark.range(ROWS, numPartitions=12).select(
        F.col("id").alias("order_id"), hot("customer_id"), *[F.lit("x").alias(c) for c in columns]
    )
    customers = spark.range(1, 900).select(F.col("id").alias("customer_id"), F.lit("Boomer").alias("age_segment"))
    out = semantic.sem_orders(orders, customers)
    assert "skew=true" in final_plan(out)
    assert out.count() == ROWS and out.filter("customer_id = 1 and age_segment = 'Boomer'").count() == ROWS // 3


def test_a_parent_with_a_third_of_all_children_is_looked_up_once(spark):
    tables = {
        "child": spark.range(ROWS, numPartitions=12).select(hot("fk")),
        "parent": spark.range(2, 2000).select(F.col("id").alias("pk")),
    }
    check = quality.Check("child", "fk", "relationships", parent="parent", parent_column="pk")
    results = quality.run_checks(tables, [check])
    assert results.first().failures == ROWS // 3
