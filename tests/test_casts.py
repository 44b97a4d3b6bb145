import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from orderlens.functions import conform, readable_quantity, safe_int, safe_str, settle, to_raw_orders
from orderlens.schema import RAW


@pytest.mark.parametrize(
    ("kind", "given", "expected"),
    [
        ("double", [12.7, -12.7, math.nan, math.inf, -math.inf, None], [12, -12, None, None, None, None]),
        ("string", [" 12 ", "12", "12.7", "abc", "", None], [12, 12, None, None, None, None]),
        ("bigint", [2**40, 0, None], [2**40, 0, None]),
    ],
)
def test_safe_int(spark, kind, given, expected):
    df = spark.createDataFrame(list(enumerate(given)), f"i int, x {kind}")
    assert [r.y for r in df.select("i", safe_int("x").alias("y")).orderBy("i").collect()] == expected


def test_safe_int_out_of_range_is_null(spark):
    df = spark.createDataFrame([(300,), (12,)], "x int")
    assert rows(df.select(safe_int("x", "tinyint"))) == [(None,), (12,)]


def test_safe_str(spark):
    text = spark.createDataFrame([(None,), ("x",), ("",)], "x string")
    assert rows(text.select(safe_str("x"))) == [("",), ("x",), ("",)]
    number = spark.createDataFrame([(None,), (math.nan,), (1.5,)], "x double")
    assert rows(number.select(safe_str("x", floating=True))) == [("",), ("",), ("1.5",)]


def test_raw_orders_has_no_null_text(items):
    raw = to_raw_orders(items({"department": None, "product_name": None, "aisle": None, "user_id": None}))
    assert raw.schema.fieldNames() == RAW.fieldNames()
    row = raw.first()
    assert (row.department, row.product_name, row.aisle, row.user_id) == ("", "", "", None)


def test_conform_fills_and_casts(spark):
    df = spark.createDataFrame([(1.0, "7", "x")], "days_since_prior_order double, order_id string, extra string")
    row = conform(df, RAW).first()
    assert (row.days_since_prior_order, row.order_id, row.user_id) == (1, 7, None)
    assert conform(df, RAW).schema == RAW


@pytest.mark.parametrize(
    ("n", "text"),
    [(0, "0.00"), (999, "999.00"), (1024, "1.02 thousand"), (1234000, "1.23 million"), (4567000000, "4.57 billion"),
     (98765432101234, "98.77 trillion"), (2 * 10**15, "2.00 quadrillion"), (-1500, "-1.50 thousand"), (None, None)],
)
def test_readable_quantity(spark, n, text):
    df = spark.createDataFrame([(n,)], "n bigint")
    assert df.select(readable_quantity(F.col("n")).alias("t")).first().t == text


def test_settle_ignores_the_last_bits(spark):
    df = spark.createDataFrame([(0.125,), (0.12499999999999999,), (1e300,)], "x double")
    assert rows(df.select(settle(F.col("x"), 2))) == [(0.13,), (0.13,), (1e300,)]
