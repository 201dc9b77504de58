"""Business metrics, each defined once as an aggregate expression.

Ratios are taken on exact decimals and rounded last, so a result does not
depend on the order in which tasks finish.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tiffin.functions.cleaning import safe_ratio

CANCELLED = "Cancelled"
LATE_AFTER_MINUTES = 45


def _exact(count: Column) -> Column:
    return count.cast("decimal(20,0)")


def delivered_orders(is_delivered: str = "is_delivered") -> Column:
    return F.count_if(F.col(is_delivered))


def gross_merchandise_value(is_delivered: str = "is_delivered", amount: str = "sales_amount") -> Column:
    return F.sum(F.when(F.col(is_delivered), F.col(amount)).otherwise(F.lit(0)))


def cancellation_rate(status: str = "order_status", cancelled: str = CANCELLED) -> Column:
    hits = F.count_if(F.col(status) == cancelled)
    return F.round(safe_ratio(_exact(hits), _exact(F.count(F.lit(1)))), 4)


def average_order_value(is_delivered: str = "is_delivered", amount: str = "sales_amount") -> Column:
    value = gross_merchandise_value(is_delivered, amount)
    return F.round(safe_ratio(value, _exact(delivered_orders(is_delivered))), 2)


def late_rate(minutes: str = "delivery_time_min", threshold: float = LATE_AFTER_MINUTES) -> Column:
    hits = F.count_if(F.col(minutes) > threshold)
    return F.round(safe_ratio(_exact(hits), _exact(F.count(F.lit(1)))), 4)


def rounded_average(value: str, digits: int, scale: int = 0) -> Column:
    """``round(avg(value), digits)`` over the non-null values, NULL if there are
    none. ``scale`` is the number of decimals of ``value`` that count."""
    exact = F.col(value).cast(f"decimal({18 + scale},{scale})")
    return F.round(F.try_divide(F.sum(exact), _exact(F.count(value))), digits)


def customer_count(customer: str = "customer_id") -> Column:
    return F.count_distinct(F.col(customer))
