"""Typed, deduplicated tables over the all-text raw tables.

Every function takes raw DataFrames and returns a lazy DataFrame, so the
optimizer sees through a staging table into whatever reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.functions.cleaning import (
    first_digits,
    last_part,
    strict_date,
    strict_number,
    strict_timestamp,
    title_case,
    to_decimal,
    to_number,
)
from tiffin.operators.latest import latest_per_key, newest_load_first


def _latest_by_number(raw: DataFrame, key: str) -> DataFrame:
    """Latest row per parsed key; ``'1'`` and ``'01'`` are the same key."""
    good = raw.withColumn("_key", to_number(key)).filter(F.col("_key").isNotNull())
    return latest_per_key(good, ["_key"], newest_load_first())


def stg_restaurants(raw: DataFrame) -> DataFrame:
    return _latest_by_number(raw, "id").select(
        F.col("_key").alias("restaurant_id"),
        F.col("name").alias("restaurant_name"),
        last_part("city").alias("city"),
        to_decimal(F.nullif(F.col("rating"), F.lit("--")), 3, 1).alias("rating"),
        first_digits("rating_count").alias("rating_count"),
        first_digits("cost").alias("cost_for_two"),
        "cuisine",
        F.col("lic_no").alias("license_no"),
        "_batch_id",
    )


def stg_users(raw: DataFrame) -> DataFrame:
    return _latest_by_number(raw, "user_id").select(
        F.col("_key").alias("customer_id"),
        F.col("name").alias("customer_name"),
        F.lower("email").alias("customer_email"),
        to_number("age").alias("customer_age"),
        "gender",
        "marital_status",
        "occupation",
        F.col("monthly_income").alias("income_band"),
        "education",
        to_number("family_size").alias("family_size"),
        "_batch_id",
    )


def stg_food(raw: DataFrame) -> DataFrame:
    good = raw.filter(F.col("f_id").isNotNull())
    return latest_per_key(good, ["f_id"], newest_load_first()).select(
        "f_id",
        F.col("item").alias("food_name"),
        title_case("veg_or_non_veg").alias("veg_or_non_veg"),
        "_batch_id",
    )


def stg_menu(raw: DataFrame) -> DataFrame:
    price = to_decimal("price", 10, 2)
    good = raw.filter(to_number("r_id").isNotNull() & (price > 0))
    return latest_per_key(good, ["menu_id"], newest_load_first()).select(
        "menu_id",
        to_number("r_id").alias("restaurant_id"),
        "f_id",
        "cuisine",
        price.alias("price"),
        "_batch_id",
    )


def latest_good_orders(raw: DataFrame) -> DataFrame:
    """The raw row that staging takes of each order."""
    return _latest_by_number(raw, "order_id").drop("_key")


def stg_orders(raw: DataFrame) -> DataFrame:
    return _latest_by_number(raw, "order_id").select(
        F.col("_key").alias("order_id"),
        strict_timestamp("order_timestamp").alias("order_timestamp"),
        strict_date("order_date").alias("order_date"),
        strict_number("user_id").alias("customer_id"),
        strict_number("r_id").alias("restaurant_id"),
        last_part("restaurant_city").alias("city"),
        "cuisine",
        to_number("items_count").alias("items_count"),
        to_number("sales_qty").alias("sales_qty"),
        *[
            to_decimal(c, 12, 2).alias(c)
            for c in ("subtotal", "discount", "delivery_fee", "gst", "sales_amount")
        ],
        "currency",
        "payment_method",
        "order_status",
        (F.col("order_status") == "Delivered").alias("is_delivered"),
        to_number("customer_rating").alias("customer_rating"),
        to_number("delivery_time_min").alias("delivery_time_min"),
        "_batch_id",
    )


def stg_order_items(raw: DataFrame) -> DataFrame:
    return _latest_by_number(raw, "order_item_id").select(
        F.col("_key").alias("order_item_id"),
        strict_number("order_id").alias("order_id"),
        strict_number("r_id").alias("restaurant_id"),
        "f_id",
        to_decimal("price", 10, 2).alias("price"),
        to_number("quantity").alias("quantity"),
        to_decimal("line_amount", 10, 2).alias("line_amount"),
        "_batch_id",
    )


def stg_reviews(raw: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Reviews with a comment, with the city of their restaurant.

    ``restaurants`` is the staged table: unique on restaurant_id.
    """
    good = raw.filter(F.col("comment").isNotNull())
    reviews = _latest_by_number(good, "review_id").select(
        F.col("_key").alias("review_id"),
        strict_number("order_id").alias("order_id"),
        strict_number("user_id").alias("customer_id"),
        strict_number("restaurant_id").alias("restaurant_id"),
        to_number("rating").alias("rating"),
        "comment",
        strict_date("review_date").alias("review_date"),
        "_batch_id",
    )
    cities = restaurants.select("restaurant_id", "city")
    return reviews.join(cities, "restaurant_id", "left").select(
        "review_id",
        "order_id",
        "customer_id",
        "restaurant_id",
        "rating",
        "comment",
        "review_date",
        "city",
        "_batch_id",
    )


STAGING = {
    "restaurants": stg_restaurants,
    "users": stg_users,
    "food": stg_food,
    "menu": stg_menu,
    "orders": stg_orders,
    "order_items": stg_order_items,
}


def build_staging(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All staging tables from the raw tables, keyed ``stg_<source>``."""
    out = {f"stg_{name}": model(raw[name]) for name, model in STAGING.items()}
    out["stg_reviews"] = stg_reviews(raw["reviews"], out["stg_restaurants"])
    return out
