from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tiffin.functions import cleaning as c


def values(spark, column, texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "i int, v string").orderBy("i")
    return [r[0] for r in df.select(column).collect()]


def test_to_number_rounds_and_rejects(spark):
    assert values(spark, c.to_number("v"), ["4.5", "x", None, "007", "-2.5", ""]) == [5, None, None, 7, -3, None]


def test_to_decimal_rounds_half_up_and_drops_overflow(spark):
    got = values(spark, c.to_decimal("v", 10, 2).cast("string"), ["12.345", "1e20", "--", "3"])
    assert got == ["12.35", None, None, "3.00"]


def test_strict_casts_fail_the_job(spark):
    assert values(spark, c.strict_number("v"), ["12", None]) == [12, None]
    for cast in (c.strict_number, c.strict_timestamp, c.strict_date):
        with pytest.raises(PySparkException):
            values(spark, cast("v"), ["not a value"])


def test_title_case_breaks_on_punctuation(spark):
    got = values(spark, c.title_case("v"), ["non-veg", "VEG", "a b.c_d", None, ""])
    assert got == ["Non-Veg", "Veg", "A B.C_D", None, ""]


def test_last_part_and_first_digits(spark):
    assert values(spark, c.last_part("v"), ["Area, City", "City", "a,b, c ", "x,", None]) == [
        "City", "City", "c", "x,", None,
    ]
    assert values(spark, c.first_digits("v"), ["500+ ratings", "Too Few", "200 for 2", None]) == [500, None, 200, None]


def test_record_hash_tells_null_from_empty_and_shifted_fields(spark):
    df = spark.createDataFrame(
        [("a", None, "b"), ("a", "b", None), ("a", "", "b"), ("a", None, "b")], "x string, y string, z string"
    )
    hashes = [r[0] for r in df.select(c.record_hash(["x", "y", "z"])).collect()]
    assert len(set(hashes)) == 3 and hashes[0] == hashes[3]
    old = [r[0] for r in df.select(c.record_hash(["x", "y", "z"], compat=True)).collect()]
    assert old[0] is None and old[2] is not None


def test_safe_ratio(spark):
    df = spark.createDataFrame([(1, 2), (1, 0), (None, 0), (None, 5), (1, None)], "a int, b int")
    got = [r[0] for r in df.select(c.safe_ratio(F.col("a"), F.col("b"))).collect()]
    assert got == [0.5, 0.0, None, None, None]
