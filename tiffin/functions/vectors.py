"""Vector arithmetic on ARRAY columns, in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column | str, b: Column | str) -> Column:
    a, b = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    pairs = F.zip_with(a.cast("array<double>"), b.cast("array<double>"), lambda x, y: x * y)
    return F.aggregate(pairs, F.lit(0.0), lambda total, x: total + x)


def norm(a: Column | str) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity; 0 when either vector has no length."""
    length = norm(a) * norm(b)
    return F.when(length == 0, F.lit(0.0)).otherwise(F.try_divide(dot(a, b), length))
