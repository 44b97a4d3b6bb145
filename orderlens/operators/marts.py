"""The three aggregate marts.

``total_orders`` counts order items with a non-null order id, and ``reorder_rate`` is rounded to
two decimals inside the mart; every report above sees the rounded value.

All measures are additive, so a coarser mart can be rolled up from a finer one: the departments
from the products, and all three from :func:`mart_grain`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions.casts import to_raw_orders
from orderlens.functions.ratios import ratio

GRAIN = ("product_name", "department", "order_hour_of_day")


def _item_count() -> Column:
    return F.count("order_id").alias("total_orders")


def _reorder_count() -> Column:
    return F.count_if(F.col("reordered") == 1).alias("reorder_count")


def _with_rate(products: DataFrame) -> DataFrame:
    share = ratio(F.col("reorder_count"), F.col("total_orders"))
    return products.select(
        "product_name",
        "department",
        "total_orders",
        "reorder_count",
        F.round(F.coalesce(share, F.lit(0.0)), 2).alias("reorder_rate"),
    )


def product_analytics(raw: DataFrame) -> DataFrame:
    """Items, reordered items and reorder rate by product name and department."""
    return _with_rate(raw.groupBy("product_name", "department").agg(_item_count(), _reorder_count()))


def hourly_analytics(raw: DataFrame) -> DataFrame:
    """Items by hour of day."""
    return raw.groupBy("order_hour_of_day").agg(_item_count())


def department_analytics(raw: DataFrame) -> DataFrame:
    """Items by department."""
    return raw.groupBy("department").agg(_item_count())


def roll_up_departments(products: DataFrame) -> DataFrame:
    """:func:`department_analytics` from the product mart, without touching the detail rows."""
    return products.groupBy("department").agg(F.sum("total_orders").alias("total_orders"))


def mart_grain(raw: DataFrame) -> DataFrame:
    """Items and reordered items by product name, department and hour: one pass for all marts.

    It has up to 24 times the groups of the product mart. :func:`build_marts` reads the detail rows
    twice instead, the second time two narrow columns, which is faster unless reading dominates.
    """
    return raw.groupBy(*GRAIN).agg(_item_count(), _reorder_count())


def marts_from_grain(grain: DataFrame) -> dict[str, DataFrame]:
    """The three marts as roll-ups of :func:`mart_grain`."""
    items = F.sum("total_orders").alias("total_orders")
    reorders = F.sum("reorder_count").alias("reorder_count")
    products = _with_rate(grain.groupBy("product_name", "department").agg(items, reorders))
    return {
        "product_analytics": products,
        "hourly_analytics": grain.groupBy("order_hour_of_day").agg(items),
        "department_analytics": roll_up_departments(products),
    }


def build_marts(raw: DataFrame, products: DataFrame | None = None) -> dict[str, DataFrame]:
    """The detail table and the three marts of one raw frame, by table name.

    The marts come from the raw rows as they are, so a missing department is a NULL group there
    and an empty string in the detail table. ``products`` is the product mart if it has already
    been written; the departments are rolled up from it.
    """
    products = product_analytics(raw) if products is None else products
    return {
        "raw_orders": to_raw_orders(raw),
        "product_analytics": products,
        "hourly_analytics": hourly_analytics(raw),
        "department_analytics": roll_up_departments(products),
    }
