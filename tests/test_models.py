"""Staging rules and mart definitions on rows written out by hand."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from tiffin.operators.latest import fixed_sample, latest_per_key, newest_load_first
from tiffin.plans import marts, staging
from tiffin.sources.landing import SOURCE_COLUMNS


def raw(spark, source, rows):
    """Rows as dicts with fields of the source and a load number."""
    columns = SOURCE_COLUMNS[source]
    data = [
        (*[r.get(c) for c in columns], f"2024-01-0{r['load']} 00:00:00", f"{source}/{r['load']}", f"b{r['load']}", "h")
        for r in rows
    ]
    schema = ", ".join(f"`{c}` string" for c in [*columns, "at", "_source_file", "_batch_id", "_record_hash"])
    return spark.createDataFrame(data, schema).withColumn("_ingested_at", F.to_timestamp("at")).drop("at")


def test_orders_keep_the_newest_row_per_parsed_key(spark):
    df = raw(spark, "orders", [
        {"order_id": "1", "order_status": "Cancelled", "load": 1},
        {"order_id": "01", "order_status": "Delivered", "load": 2},
        {"order_id": "abc", "load": 2},
        {"order_id": None, "load": 2},
    ])
    got = staging.stg_orders(df).collect()
    assert [(r.order_id, r.order_status, r.is_delivered) for r in got] == [(1, "Delivered", True)]


def test_unknown_status_gives_unknown_flag(spark):
    got = staging.stg_orders(raw(spark, "orders", [{"order_id": "1", "load": 1}])).first()
    assert got.is_delivered is None


def test_bad_newest_price_gives_way_to_older_row(spark):
    df = raw(spark, "menu", [
        {"menu_id": "m1", "r_id": "1", "price": "10", "load": 1},
        {"menu_id": "m1", "r_id": "1", "price": "0", "load": 2},
        {"menu_id": "m2", "r_id": "1", "price": "-1", "load": 1},
        {"menu_id": "m3", "r_id": "x", "price": "5", "load": 1},
        {"menu_id": "m4", "r_id": "2", "price": "12.345", "load": 1},
    ])
    got = {r.menu_id: r.price for r in staging.stg_menu(df).collect()}
    assert got == {"m1": Decimal("10.00"), "m4": Decimal("12.35")}


def test_restaurant_fields(spark):
    df = raw(spark, "restaurants", [
        {"id": "1", "city": "Area, City", "rating": "--", "rating_count": "500+ ratings", "cost": "Rs 200 for two",
         "load": 1},
        {"id": "2", "city": "City", "rating": "4.2", "rating_count": "Too Few", "load": 1},
        {"id": "3", "city": None, "rating": "abc", "load": 1},
    ])
    got = {r.restaurant_id: (r.city, r.rating, r.rating_count, r.cost_for_two) for r in
           staging.stg_restaurants(df).collect()}
    assert got == {1: ("City", None, 500, 200), 2: ("City", Decimal("4.2"), None, None), 3: (None, None, None, None)}


def test_users_drop_the_password_and_lower_the_address(spark):
    df = raw(spark, "users", [{"user_id": "7", "email": "A@B.COM", "password": "p", "age": "x", "load": 1}])
    out = staging.stg_users(df)
    assert "password" not in out.columns
    assert out.first().customer_email == "a@b.com" and out.first().customer_age is None


def test_reviews_need_a_comment_and_may_lack_a_restaurant(spark):
    reviews = raw(spark, "reviews", [
        {"review_id": "1", "restaurant_id": "9", "comment": "good", "rating": "x", "load": 1},
        {"review_id": "1", "restaurant_id": "9", "comment": None, "load": 2},
        {"review_id": "2", "restaurant_id": None, "comment": "fine", "rating": "4", "load": 1},
        {"review_id": "3", "comment": None, "load": 1},
    ])
    restaurants = spark.createDataFrame([(9, "Pune")], "restaurant_id bigint, city string")
    got = {r.review_id: (r.comment, r.rating, r.city) for r in staging.stg_reviews(reviews, restaurants).collect()}
    assert got == {1: ("good", None, "Pune"), 2: ("fine", 4, None)}


def test_age_segments(spark):
    ages = [24, 25, 39, 40, 54, 55, None]
    df = spark.createDataFrame([(a,) for a in ages], "customer_age bigint")
    got = [r[0] for r in df.select(marts.age_segment()).collect()]
    assert got == ["Gen Z", "Millennial", "Millennial", "Gen X", "Gen X", "Boomer", "Unknown"]


def test_calendar(spark):
    days = marts.dim_date(spark)
    assert days.count() == 1096
    row = days.filter("date_day = date'2024-02-03'").first()
    assert (row.month_name, row.day_name, row.is_weekend) == ("Feb", "Sat", True)


ORDER = "order_date string, city string, order_status string, is_delivered boolean, sales_amount decimal(12,2)"


def test_daily_revenue_with_unknown_flags(spark):
    orders = spark.createDataFrame([
        ("d1", "a", "Delivered", True, Decimal("10.00")),
        ("d1", "a", "Delivered", True, None),
        ("d1", "a", "Cancelled", False, Decimal("99.00")),
        ("d1", "a", None, None, Decimal("5.00")),
        ("d2", "a", "Cancelled", False, Decimal("1.00")),
        ("d3", "a", "Delivered", True, None),
    ], ORDER)
    got = {r.order_date: r for r in marts.mart_daily_city_revenue(orders).collect()}
    d1 = got["d1"]
    assert (d1.orders, d1.delivered_orders, d1.cancel_rate) == (4, 2, Decimal("0.2500"))
    assert (d1.gross_merchandise_value, d1.average_order_value) == (Decimal("10.00"), Decimal("5.00"))
    assert (got["d2"].gross_merchandise_value, got["d2"].average_order_value) == (Decimal("0.00"), Decimal("0.00"))
    assert got["d3"].gross_merchandise_value is None and got["d3"].average_order_value is None


def test_late_means_over_the_threshold(spark):
    orders = spark.createDataFrame(
        [("a", "2024-01-01 10:15:00", True, 45), ("a", "2024-01-01 10:45:00", True, 46),
         ("a", "2024-01-01 10:50:00", True, None), ("a", "2024-01-01 10:50:00", False, 500)],
        "city string, t string, is_delivered boolean, delivery_time_min bigint",
    ).withColumn("order_timestamp", F.col("t").cast("timestamp_ntz"))
    for wide in (False, True):
        (row,) = marts.mart_delivery_sla(orders, wide_values=wide).collect()
        assert (row.order_hour, row.delivered_orders, row.late_rate) == (10, 3, Decimal("0.3333"))
        assert (row.p50_delivery_min, row.p90_delivery_min) == (45.5, 45.9)


def test_restaurants_without_a_dimension_row_stay(spark):
    orders = spark.createDataFrame(
        [(1, "Delivered", True, Decimal("3.00"), 4, 30), (1, "Refunded", False, Decimal("9.00"), 5, None),
         (2, "Cancelled", False, Decimal("1.00"), None, None), (None, "Delivered", True, Decimal("2.00"), 1, 1)],
        "restaurant_id bigint, order_status string, is_delivered boolean, sales_amount decimal(12,2), "
        "customer_rating bigint, delivery_time_min bigint",
    )
    names = spark.createDataFrame([(1, "One", "a", "thai")], "restaurant_id bigint, restaurant_name string, "
                                  "city string, cuisine string")  # fmt: skip
    got = {r.restaurant_id: r for r in marts.mart_restaurant_performance(orders, names).collect()}
    assert set(got) == {1, 2, None}
    assert (got[1].restaurant_name, got[1].orders, got[1].revenue) == ("One", 2, Decimal("3.00"))
    assert float(got[1].avg_customer_rating) == 4.5 and float(got[1].avg_delivery_min) == 30.0
    assert got[2].restaurant_name is None and got[2].avg_customer_rating is None


def test_latest_per_key_limits_groups_before_the_shuffle(spark):
    """A key that holds a third of all rows leaves each task as one row."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id").cast("timestamp").alias("_ingested_at"),
        F.lit("f").alias("_source_file"), F.lit("h").alias("_record_hash"), F.lit("b").alias("_batch_id"),
    )
    out = latest_per_key(df, ["k"], newest_load_first())
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert out.count() == 20_001
    assert out.filter("k = 0").first()._ingested_at.timestamp() == 29_997


def test_fixed_sample_is_repeatable(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    one = {r.k for r in fixed_sample(df.repartition(7), "k", 50, seed=1).collect()}
    assert len(one) == 50
    assert one == {r.k for r in fixed_sample(df.repartition(3), "k", 50, seed=1).collect()}
    assert one != {r.k for r in fixed_sample(df, "k", 50, seed=2).collect()}
