"""Reports on the order items.

Distinct counts are exact. Spark deduplicates on (group, value) before it groups, so the rows of a
hot department, user or period spread over all tasks by value; each task first drops the repeats
it holds itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions import labels
from orderlens.functions.ratios import percent, ratio, settle
from orderlens.operators.sketches import KEYS, SIZE, sketched_counts


def _rows() -> Column:
    return F.count(F.lit(1))


def d1_totals(raw: DataFrame, approx: bool = False) -> DataFrame:
    """Rows and distinct orders, users and products; ``approx`` uses sketches and no shuffle.

    Exact counts take one aggregate per key, each reading one column; the rows are counted along
    with the users. Three distinct counts in one aggregate would expand every row fourfold.
    """
    if approx:
        sketches = raw.agg(_rows().alias("total_rows"), *(F.hll_sketch_agg(k, SIZE).alias(f"{k}_sketch") for k in KEYS))
        counts = [F.col(f"{k}_count").alias(name) for k, name in zip(KEYS, ("unique_orders", "unique_users", "unique_products"), strict=True)]
        return sketched_counts(sketches).select("total_rows", *counts)

    def distinct(key: str) -> Column:
        return raw.filter(F.col(key).isNotNull()).select(key).distinct().agg(_rows()).scalar()

    users = raw.groupBy("user_id").agg(_rows().alias("items"))
    totals = users.agg(
        F.coalesce(F.sum("items"), F.lit(0)).alias("total_rows"), F.count("user_id").alias("unique_users")
    )
    return totals.select(
        "total_rows",
        distinct("order_id").alias("unique_orders"),
        "unique_users",
        distinct("product_id").alias("unique_products"),
    )


def d2_items_per_order(raw: DataFrame) -> DataFrame:
    """Mean items per order and the largest and smallest cart position."""
    return raw.agg(
        F.round(ratio(_rows(), F.count_distinct("order_id")), 2).alias("avg_items_per_order"),
        F.max("add_to_cart_order").alias("max_items_in_one_order"),
        F.min("add_to_cart_order").alias("min_items_in_one_order"),
    )


def d3_by_weekday(raw: DataFrame) -> DataFrame:
    """Items per weekday."""
    days = raw.groupBy("order_dow").agg(_rows().alias("total_orders"))
    return days.select(
        "order_dow", labels.weekday_name(F.col("order_dow")).alias("day_name"), "total_orders"
    ).orderBy(F.asc_nulls_last("order_dow"))


def d4_active_users(raw: DataFrame, n: int = 10) -> DataFrame:
    """Users with the most orders. The mean interval is over items, so large orders weigh more."""
    return (
        raw.groupBy("user_id")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            _rows().alias("total_items"),
            F.round(F.avg("days_since_prior_order"), 1).alias("avg_days_between_orders"),
        )
        .orderBy(F.desc("total_orders"), F.asc_nulls_last("user_id"))
        .limit(n)
    )


def d5_department_reorder(raw: DataFrame) -> DataFrame:
    """Items, reordered items and their percentage per department."""
    sums = raw.groupBy("department").agg(
        _rows().alias("total_items"), F.sum("reordered").alias("reordered_items")
    )
    rate = percent(F.col("reordered_items"), F.col("total_items"))
    return sums.withColumn("reorder_rate_pct", rate).orderBy(F.desc("reorder_rate_pct"))


def d6_top_aisles(raw: DataFrame, n: int = 10) -> DataFrame:
    """Aisles with the most orders."""
    return (
        raw.groupBy("aisle", "department")
        .agg(F.count_distinct("order_id").alias("unique_orders"), _rows().alias("total_items"))
        .orderBy(F.desc("unique_orders"), F.asc_nulls_last("aisle"), F.asc_nulls_last("department"))
        .limit(n)
    )


def d7_consistent_users(raw: DataFrame, min_items: int = 50, n: int = 20) -> DataFrame:
    """Users with enough items, by the share of reordered ones."""
    return (
        raw.groupBy("user_id")
        .agg(
            _rows().alias("total_items"),
            F.round(F.avg("reordered") * 100, 2).alias("reorder_rate_pct"),
            F.count_distinct("product_id").alias("unique_products"),
        )
        .filter(F.col("total_items") >= min_items)
        .orderBy(F.desc_nulls_last("reorder_rate_pct"), F.desc("total_items"), F.asc_nulls_last("user_id"))
        .limit(n)
    )


def d8_department_share(raw: DataFrame) -> DataFrame:
    """Each department's share of all items."""
    sums = raw.groupBy("department").agg(_rows().alias("total_items"))
    total = sums.agg(F.sum("total_items")).scalar()
    return sums.withColumn("contribution_pct", percent(F.col("total_items"), total)).orderBy(
        F.desc("contribution_pct")
    )


def d9_shopping_periods(
    raw: DataFrame,
    spans: Sequence[tuple[int, int, str]] = labels.SHOPPING_PERIODS,
    rest: str = labels.SHOPPING_REST,
) -> DataFrame:
    """Orders, users and items per order by time of day."""
    period = labels.within(F.col("order_hour_of_day"), spans, rest)
    return (
        raw.groupBy(period.alias("shopping_period"))
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.count_distinct("user_id").alias("active_users"),
            F.round(ratio(_rows(), F.count_distinct("order_id")), 2).alias("avg_items_per_order"),
        )
        .orderBy(F.desc("total_orders"))
    )


def d10_loyal_departments(raw: DataFrame) -> DataFrame:
    """Means over a department's users of their orders and reorder rates, each user counting once."""
    users = raw.groupBy("department", "user_id").agg(
        F.count_distinct("order_id").alias("orders"), F.avg("reordered").alias("rate")
    )
    return (
        users.groupBy("department")
        .agg(
            F.round(F.avg("orders"), 2).alias("avg_orders_per_user"),
            settle(F.avg("rate") * 100, 2).alias("avg_reorder_rate_pct"),
            F.count("user_id").alias("total_users"),
        )
        .orderBy(F.desc("avg_orders_per_user"))
    )


def d11_retention(
    raw: DataFrame,
    edges: Sequence[int] = (7, 14, 30),
    names: Sequence[str] = labels.RETENTION_NAMES,
) -> DataFrame:
    """Users, orders and reorder percentage by interval since the previous order."""
    interval = F.col("days_since_prior_order")
    return (
        raw.filter(interval.isNotNull())
        .groupBy(labels.at_most(interval, edges, names).alias("retention_group"))
        .agg(
            F.count_distinct("user_id").alias("total_users"),
            F.count_distinct("order_id").alias("total_orders"),
            F.round(F.avg("reordered") * 100, 2).alias("reorder_rate_pct"),
        )
        .orderBy(F.desc("total_users"))
    )


def d12_basket_depth(
    raw: DataFrame,
    edges: Sequence[int] = (5, 15),
    names: Sequence[str] = labels.BASKET_NAMES,
) -> DataFrame:
    """Orders and items by depth of the cart position; one long order counts at several depths."""
    depth = labels.at_most(F.col("add_to_cart_order"), edges, names)
    return (
        raw.groupBy(depth.alias("basket_depth"))
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            _rows().alias("total_items"),
            F.round(ratio(_rows(), F.count_distinct("order_id")), 2).alias("avg_items_per_order"),
        )
        .orderBy(F.desc("avg_items_per_order"))
    )
