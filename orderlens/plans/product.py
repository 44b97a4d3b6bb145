"""Reports on the product mart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions import labels
from orderlens.functions.ratios import ratio
from orderlens.operators.ranking import top_ranked


def _top(products: DataFrame, column: str, n: int, ascending: bool = False) -> DataFrame:
    """The first ``n`` rows by the column; names break ties, so that reruns agree."""
    key = F.asc_nulls_last(column) if ascending else F.desc_nulls_last(column)
    return products.orderBy(key, F.asc_nulls_last("product_name"), F.asc_nulls_last("department")).limit(n)


def a1_top_products(products: DataFrame, n: int = 10) -> DataFrame:
    """Products with the most items."""
    return _top(products, "total_orders", n)


def a2_top_reorder(products: DataFrame, min_orders: int = 5, n: int = 10) -> DataFrame:
    """Products with the highest reorder rate among those with enough items."""
    return _top(products.filter(F.col("total_orders") >= min_orders), "reorder_rate", n)


def a3_lowest_reorder(products: DataFrame, n: int = 10) -> DataFrame:
    """Products with the lowest reorder rate."""
    return _top(products, "reorder_rate", n, ascending=True)


def a4_department_breadth(products: DataFrame) -> DataFrame:
    """Number of products and items per department."""
    return (
        products.groupBy("department")
        .agg(F.count("product_name").alias("total_products"), F.sum("total_orders").alias("total_orders_dept"))
        .orderBy(F.desc("total_orders_dept"))
    )


def a5_department_avg_rate(products: DataFrame) -> DataFrame:
    """Mean reorder rate over a department's products, each product counting once.

    The rates have two decimals, so they are added as decimals: the mean does not depend on the
    order of addition.
    """
    rates = F.sum(F.col("reorder_rate").cast("decimal(18,2)")).cast("double")
    return (
        products.groupBy("department")
        .agg(
            F.round(F.try_divide(rates, F.count("reorder_rate")), 4).alias("avg_reorder_rate"),
            F.sum("total_orders").alias("total_orders"),
        )
        .orderBy(F.desc("avg_reorder_rate"))
    )


def a6_top_per_department(products: DataFrame, n: int = 5) -> DataFrame:
    """Products ranked at most ``n`` by items within their department, ties included."""
    ranked = top_ranked(products, "department", "total_orders", n, "rank_in_dept")
    return ranked.select("department", "product_name", "total_orders", "reorder_rate", "rank_in_dept").orderBy(
        F.asc_nulls_last("department"), "rank_in_dept"
    )


def a7_evergreen(products: DataFrame, min_orders: int = 30, n: int = 15) -> DataFrame:
    """Products with many items, by items times reorder rate."""
    scored = products.filter(F.col("total_orders") >= min_orders).select(
        "product_name",
        "department",
        "total_orders",
        "reorder_rate",
        F.round(F.col("total_orders") * F.col("reorder_rate"), 2).alias("loyalty_score"),
    )
    return _top(scored, "loyalty_score", n)


def a8_rate_buckets(
    products: DataFrame,
    floors: Sequence[tuple[float, str]] = labels.RATE_BUCKETS,
    rest: str = labels.RATE_REST,
) -> DataFrame:
    """Products and items per reorder-rate bucket."""
    return (
        products.groupBy(labels.at_least(F.col("reorder_rate"), floors, rest).alias("reorder_bucket"))
        .agg(F.count(F.lit(1)).alias("product_count"), F.sum("total_orders").alias("total_orders"))
        .orderBy(F.desc("total_orders"))
    )


def a9_orders_vs_reorders(products: DataFrame) -> DataFrame:
    """Items, reordered items and their ratio per department."""
    sums = products.groupBy("department").agg(
        F.sum("total_orders").alias("total_orders"), F.sum("reorder_count").alias("total_reorders")
    )
    rate = F.round(ratio(F.col("total_reorders"), F.col("total_orders")), 4)
    return sums.withColumn("dept_reorder_rate", rate).orderBy(F.desc("dept_reorder_rate"))


def a10_first_time_dominant(
    products: DataFrame, max_rate: float = 0.3, min_orders: int = 10, n: int = 15
) -> DataFrame:
    """Products bought mostly by new buyers."""
    chosen = products.filter((F.col("reorder_rate") < max_rate) & (F.col("total_orders") >= min_orders))
    fresh = (F.col("total_orders") - F.col("reorder_count")).alias("new_buyer_orders")
    return _top(
        chosen.select("product_name", "department", "total_orders", "reorder_rate", fresh), "new_buyer_orders", n
    )
