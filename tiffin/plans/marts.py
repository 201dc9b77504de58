"""Dimensions, facts and business marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.functions import metrics as m
from tiffin.operators.percentiles import exact_percentiles, null_safe_left_join

# Upper age bounds (exclusive) of the segments.
AGE_SEGMENTS = [(25, "Gen Z"), (40, "Millennial"), (55, "Gen X")]
OLDEST_SEGMENT = "Boomer"
NO_AGE = "Unknown"

# First and last day of the calendar.
CALENDAR = ("2024-01-01", "2026-12-31")

FACT_ORDERS = [
    "order_id", "order_timestamp", "order_date", "customer_id", "restaurant_id", "city", "cuisine",
    "payment_method", "order_status", "is_delivered", "items_count", "sales_qty", "subtotal", "discount",
    "delivery_fee", "gst", "sales_amount", "customer_rating", "delivery_time_min",
]


def age_segment(age: str = "customer_age"):
    c = F.col(age)
    segment = F.when(c.isNull(), NO_AGE)
    for upper, name in AGE_SEGMENTS:
        segment = segment.when(c < upper, name)
    return segment.otherwise(OLDEST_SEGMENT)


def dim_customer(users: DataFrame) -> DataFrame:
    return users.select(
        "customer_id",
        "customer_name",
        "customer_email",
        "customer_age",
        age_segment().alias("age_segment"),
        "gender",
        "marital_status",
        "occupation",
        "income_band",
        "education",
        "family_size",
    )


def dim_restaurants(restaurants: DataFrame) -> DataFrame:
    return restaurants.select(
        "restaurant_id", "restaurant_name", "city", "rating", "rating_count", "cost_for_two", "cuisine"
    )


def dim_food(food: DataFrame) -> DataFrame:
    return food.select("f_id", "food_name", "veg_or_non_veg")


def dim_date(spark: SparkSession, first: str = CALENDAR[0], last: str = CALENDAR[1]) -> DataFrame:
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    d = F.col("date_day")
    return spark.range(1).select(F.explode(days).alias("date_day")).select(
        "date_day",
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.monthname(d).alias("month_name"),
        F.dayname(d).alias("day_name"),
        (F.weekday(d) >= 5).alias("is_weekend"),
    )


def fact_orders(orders: DataFrame) -> DataFrame:
    return orders.select(*FACT_ORDERS)


def fact_order_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Order lines with the time and city of their order.

    Neither side is hinted: the run-time plan broadcasts a side it has measured
    to be small and splits the partitions of an order with very many lines.
    """
    head = orders.select("order_id", F.col("order_timestamp").alias("order_ts"), "order_date", "city")
    return items.join(head, "order_id").select(
        "order_item_id",
        "order_id",
        "restaurant_id",
        "f_id",
        "order_ts",
        "order_date",
        "city",
        "price",
        "quantity",
        "line_amount",
    )


def mart_daily_city_revenue(orders: DataFrame) -> DataFrame:
    return orders.groupBy("order_date", "city").agg(
        F.count("*").alias("orders"),
        m.delivered_orders().alias("delivered_orders"),
        m.cancellation_rate().alias("cancel_rate"),
        m.gross_merchandise_value().alias("gross_merchandise_value"),
        m.average_order_value().alias("average_order_value"),
    )


def mart_restaurant_performance(orders: DataFrame, restaurants: DataFrame) -> DataFrame:
    """One row per restaurant over orders of every status.

    Aggregating before the join leaves one row per restaurant to be joined;
    ``restaurants`` is unique on restaurant_id, so the result is the same.
    """
    totals = orders.groupBy("restaurant_id").agg(
        F.count("*").alias("orders"),
        m.gross_merchandise_value().alias("revenue"),
        m.rounded_average("customer_rating", 2).alias("avg_customer_rating"),
        m.rounded_average("delivery_time_min", 1).alias("avg_delivery_min"),
        m.cancellation_rate().alias("cancel_rate"),
    )
    names = restaurants.select("restaurant_id", "restaurant_name", "city", "cuisine")
    return totals.join(names, "restaurant_id", "left").select(
        "restaurant_id",
        "restaurant_name",
        "city",
        "cuisine",
        "orders",
        "revenue",
        "avg_customer_rating",
        "avg_delivery_min",
        "cancel_rate",
    )


def mart_delivery_sla(
    orders: DataFrame,
    threshold: float = m.LATE_AFTER_MINUTES,
    wide_values: bool = False,
) -> DataFrame:
    """Delivery times of delivered orders per city and hour.

    Whole minutes have few distinct values, so the built-in percentiles need
    little memory. ``wide_values`` is for delivery times with a wide domain.
    """
    done = orders.filter("is_delivered").withColumn("order_hour", F.hour("order_timestamp"))
    keys = ["city", "order_hour"]
    counts = [m.delivered_orders().alias("delivered_orders"), m.late_rate(threshold=threshold).alias("late_rate")]
    if wide_values:
        times = exact_percentiles(
            done, keys, "delivery_time_min", {"p50_delivery_min": 0.5, "p90_delivery_min": 0.9}
        )
        joined = null_safe_left_join(done.groupBy(*keys).agg(*counts), times, keys)
    else:
        joined = done.groupBy(*keys).agg(
            *counts,
            F.median("delivery_time_min").alias("p50_delivery_min"),
            F.percentile("delivery_time_min", 0.9).alias("p90_delivery_min"),
        )
    return joined.select(
        "city",
        "order_hour",
        "delivered_orders",
        F.round("p50_delivery_min", 1).alias("p50_delivery_min"),
        F.round("p90_delivery_min", 1).alias("p90_delivery_min"),
        "late_rate",
    )


def mart_review_insights(enriched: DataFrame, reviews: DataFrame) -> DataFrame:
    """Enriched reviews by city, topic and label."""
    facts = enriched.select("review_id", "topic", "sentiment_label", "sentiment_score", "key_issue")
    return (
        facts.join(reviews.select("review_id", "city", "rating"), "review_id")
        .groupBy("city", "topic", "sentiment_label")
        .agg(
            F.count("*").alias("reviews"),
            m.rounded_average("sentiment_score", 3, scale=9).alias("avg_sentiment_score"),
            m.rounded_average("rating", 2).alias("avg_star_rating"),
            F.count("key_issue").alias("flagged_issues"),
        )
    )
