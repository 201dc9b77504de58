"""A TPC-H-like order schema read as the engine's order, item and review tables.

Typed frames feed the marts; the ``raw_*`` frames write the same data as text,
with several loads per key and unclean fields, and feed the staging models.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.functions.cleaning import first_digits, record_hash
from tiffin.sources.landing import SOURCE_COLUMNS

# Order status of the trade schema and of the marts.
STATUS = {"F": "Delivered", "P": "Cancelled", "O": "Refunded"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_status(code: str = "o_orderstatus") -> Column:
    out = F.when(F.lit(False), F.lit(None))
    for key, name in STATUS.items():
        out = out.when(F.col(code) == key, name)
    return out.otherwise(F.col(code))


def _money(c: str, digits: int = 12) -> Column:
    return F.col(c).cast(f"decimal({digits},2)")


def _text(number: Column) -> Column:
    return number.cast("decimal(12,4)").cast("string")


def order_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order columns that need no order line."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    places = c.join(n, c.c_nationkey == n.n_nationkey, "left")
    return o.join(places, o.o_custkey == places.c_custkey, "left").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").alias("order_timestamp"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_custkey").alias("customer_id"),
        F.col("n_name").alias("city"),
        F.col("o_orderpriority").alias("cuisine"),
        F.col("c_mktsegment").alias("payment_method"),
        order_status().alias("order_status"),
        (order_status() == "Delivered").alias("is_delivered"),
        _money("o_totalprice").alias("sales_amount"),
        first_digits("o_orderpriority").alias("customer_rating"),
    )


def order_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line measures per order. The restaurant is the order's lowest supplier."""
    price = _money("l_extendedprice")
    part = lambda share: F.round(price * F.col(share).cast("decimal(4,2)"), 2)
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("order_id"))
        .agg(
            F.min("l_suppkey").alias("restaurant_id"),
            F.count("*").alias("items_count"),
            F.sum(F.col("l_quantity").cast("bigint")).alias("sales_qty"),
            F.sum(price).cast("decimal(12,2)").alias("subtotal"),
            F.sum(part("l_discount")).cast("decimal(12,2)").alias("discount"),
            F.sum(part("l_tax")).cast("decimal(12,2)").alias("gst"),
            F.max("l_shipdate").cast("date").alias("_delivered_on"),
        )
    )


def orders_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of fact_orders. Delivery time is days to the last shipment."""
    heads = order_heads(spark, sf_dir)
    totals = order_totals(spark, sf_dir)
    return (
        heads.join(totals, "order_id", "left")
        .withColumn("delivery_time_min", F.datediff("_delivered_on", "order_date").cast("bigint"))
        .withColumn("delivery_fee", F.lit(0).cast("decimal(12,2)"))
        .drop("_delivered_on")
    )


def restaurants_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    return s.join(n, s.s_nationkey == n.n_nationkey, "left").select(
        F.col("s_suppkey").alias("restaurant_id"),
        F.col("s_name").alias("restaurant_name"),
        F.col("n_name").alias("city"),
        F.lit(None).cast("decimal(3,1)").alias("rating"),
        F.lit(None).cast("bigint").alias("rating_count"),
        F.lit(None).cast("bigint").alias("cost_for_two"),
        F.concat(F.lit("Cuisine "), F.col("s_nationkey")).alias("cuisine"),
    )


def reviews_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as reviews: the city is the source, the rating comes from the
    quality label where there is one."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    q = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return d.join(q, "doc_id", "left").select(
        F.col("doc_id").alias("review_id"),
        F.col("text").alias("comment"),
        F.col("source").alias("city"),
        (F.col("quality") * 3 + 2).cast("bigint").alias("rating"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("doc_id", F.lit(365)).cast("int")).alias("review_date"),
    )


# --- the same data as text, load by load -----------------------------------


def _load(df: DataFrame, source: str, number: int, loaded_at: Column | None = None) -> DataFrame:
    """Stamp a frame of text columns as the ``number``-th load of a source."""
    names = SOURCE_COLUMNS[source]
    have = {c for c in df.columns}
    at = loaded_at if loaded_at is not None else F.lit(f"2024-01-0{number} 00:00:00")
    return df.select(
        *[F.col(c).cast("string").alias(c) if c in have else F.lit(None).cast("string").alias(c) for c in names],
        at.cast("timestamp").alias("_ingested_at"),
        F.lit(f"{source}/{number}.csv").alias("_source_file"),
        F.lit(f"load-{number}").alias("_batch_id"),
    ).withColumn("_record_hash", record_hash(names))


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    places = c.join(n, c.c_nationkey == n.n_nationkey, "left")
    base = o.join(places, o.o_custkey == places.c_custkey, "left").select(
        "o_orderstatus",
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_orderdate").alias("order_timestamp"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_custkey").alias("user_id"),
        F.pmod("c_nationkey", F.lit(10)).alias("r_id"),
        F.concat_ws(", ", "c_mktsegment", "n_name").alias("restaurant_city"),
        F.col("o_orderpriority").alias("cuisine"),
        F.concat("c_nationkey", F.lit(".5")).alias("items_count"),
        F.col("o_orderpriority").alias("sales_qty"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("subtotal"),
        F.when(F.col("o_orderstatus") == "O", "--").otherwise("1.005").alias("discount"),
        F.lit("2.50").alias("delivery_fee"),
        F.lit("99999999999.99").alias("gst"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("sales_amount"),
        F.lit("INR").alias("currency"),
        F.col("c_mktsegment").alias("payment_method"),
        order_status().alias("order_status"),
        F.left("o_orderpriority", F.lit(1)).alias("customer_rating"),
        F.lit("abc").alias("delivery_time_min"),
    )
    placed = base.withColumn("order_status", F.lit("Refunded"))
    # The same key with a leading zero, and one that does not parse.
    closed = base.filter("o_orderstatus <> 'O'").withColumn("order_id", F.concat(F.lit("0"), "order_id"))
    broken = base.filter("o_orderstatus = 'P'").withColumn("order_id", F.concat(F.lit("x"), "order_id"))
    return _union([_load(placed, "orders", 1), _load(closed, "orders", 2), _load(broken, "orders", 3)])


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items; an order and line number may come several times."""
    li = table(spark, sf_dir, "lineitem")
    items = li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_suppkey").alias("r_id"),
        F.concat(F.lit("fd"), F.col("l_partkey")).alias("f_id"),
        _money("l_extendedprice").alias("price"),
        F.col("l_quantity").cast("decimal(12,2)").alias("quantity"),
        _money("l_extendedprice").alias("line_amount"),
        "l_shipdate",
    )
    return _load(items, "order_items", 1, F.col("l_shipdate"))


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    age = F.when(F.col("c_acctbal") < 0, F.lit("n/a")).otherwise(_text(_money("c_acctbal") / 100))
    base = c.select(
        "c_acctbal",
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("name"),
        F.concat("c_name", F.lit("@Example.COM")).alias("email"),
        F.lit("secret").alias("password"),
        age.alias("age"),
        F.col("c_mktsegment").alias("occupation"),
        F.col("c_nationkey").alias("family_size"),
    )
    moved = base.filter("c_acctbal > 5000").withColumn("occupation", F.lit("MOVED"))
    return _union([_load(base, "users", 1), _load(moved, "users", 2)])


def raw_restaurants(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    poor = F.col("s_acctbal") < 0
    base = s.join(n, s.s_nationkey == n.n_nationkey, "left").select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.when(poor, F.col("n_name")).otherwise(F.concat(F.lit("Old Town, "), F.col("n_name"))).alias("city"),
        F.when(poor, "--").otherwise(_text(_money("s_acctbal") / 2000)).alias("rating"),
        F.when(poor, "Too Few").otherwise(F.concat("s_suppkey", F.lit("+ ratings"))).alias("rating_count"),
        F.concat(F.lit("Rs "), "s_nationkey", F.lit(" for two")).alias("cost"),
        F.concat(F.lit("Cuisine "), "s_nationkey").alias("cuisine"),
        F.concat(F.lit("L"), "s_suppkey").alias("lic_no"),
    )
    return _load(base, "restaurants", 1)


def raw_food(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    base = p.select(
        F.concat(F.lit("fd"), F.col("p_partkey")).alias("f_id"),
        F.col("p_name").alias("item"),
        F.concat_ws("-", F.lower("p_type"), F.upper("p_brand")).alias("veg_or_non_veg"),
    )
    return _load(base, "food", 1)


def raw_menu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads; the newer one has no usable price for the larger parts."""
    p = table(spark, sf_dir, "part")
    base = p.select(
        F.concat(F.lit("mn"), F.col("p_partkey")).alias("menu_id"),
        F.col("p_size").alias("r_id"),
        F.concat(F.lit("fd"), F.col("p_partkey")).alias("f_id"),
        F.col("p_type").alias("cuisine"),
        F.concat(_money("p_retailprice").cast("string"), F.lit("5")).alias("price"),
        "p_size",
    )
    newer = base.withColumn("cuisine", F.lower("cuisine")).withColumn(
        "price", F.when(F.col("p_size") > 25, F.lit("0")).otherwise(F.lit("12.345"))
    )
    return _union([_load(base, "menu", 1), _load(newer, "menu", 2)])


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads; the newer one has lost the comment of every low-quality text."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    q = table(spark, sf_dir, "labels").select("doc_id", "quality")
    base = d.join(q, "doc_id", "left").select(
        "quality",
        F.col("doc_id").alias("review_id"),
        F.col("doc_id").alias("order_id"),
        F.col("doc_id").alias("user_id"),
        F.regexp_extract("source", "[0-9]+", 0).alias("restaurant_id"),
        F.coalesce((F.col("quality") * 3 + 2).cast("string"), F.lit("none")).alias("rating"),
        F.col("text").alias("comment"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("doc_id", F.lit(365)).cast("int")).alias("review_date"),
    )
    newer = base.filter("quality is not null").withColumn("rating", F.lit("4"))
    newer = newer.withColumn("comment", F.when(F.col("quality") == 1, F.col("comment")))
    return _union([_load(base, "reviews", 1), _load(newer, "reviews", 2)])


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "restaurants": raw_restaurants(spark, sf_dir),
        "users": raw_users(spark, sf_dir),
        "food": raw_food(spark, sf_dir),
        "menu": raw_menu(spark, sf_dir),
        "orders": raw_orders(spark, sf_dir),
        "order_items": raw_order_items(spark, sf_dir),
        "reviews": raw_reviews(spark, sf_dir),
    }
