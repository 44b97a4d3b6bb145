"""Figures that the dashboards describe in words, as parameterised reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions import labels
from orderlens.functions.ratios import percent
from orderlens.operators.ranking import tie_order


def i1_overall_rate(raw: DataFrame) -> DataFrame:
    """Percentage of reordered items."""
    return raw.agg(F.round(F.avg("reordered") * 100, 2).alias("reorder_rate_pct"))


def i2_interval_modes(raw: DataFrame, n: int = 2) -> DataFrame:
    """The most frequent intervals between orders, counted over items."""
    return (
        raw.filter(F.col("days_since_prior_order").isNotNull())
        .groupBy("days_since_prior_order")
        .agg(F.count(F.lit(1)).alias("total_items"))
        .orderBy(F.desc("total_items"), "days_since_prior_order")
        .limit(n)
    )


def i3_rate_by_tenure(raw: DataFrame, cut: int = 10) -> DataFrame:
    """Reorder percentage of orders after a user's first ``cut`` orders and of the rest."""
    tenure = F.when(F.col("order_number") > cut, F.lit(f"more than {cut}")).otherwise(F.lit(f"up to {cut}"))
    return (
        raw.groupBy(tenure.alias("order_tenure"))
        .agg(
            F.count(F.lit(1)).alias("total_items"),
            F.round(F.avg("reordered") * 100, 2).alias("reorder_rate_pct"),
        )
        .orderBy("order_tenure")
    )


def i4_pareto(departments: DataFrame) -> DataFrame:
    """Cumulative share of items from the largest department down; equal totals share a value."""
    ties = tie_order(departments, "total_orders", "department").select(
        F.col("total_orders").alias("_total"), "running"
    )
    total = departments.agg(F.sum("total_orders")).scalar()
    return (
        departments.join(ties, F.col("total_orders") == F.col("_total"))
        .select(
            "department",
            "total_orders",
            F.col("running").alias("cumulative_orders"),
            percent(F.col("running"), total).alias("cumulative_pct"),
        )
        .orderBy(F.desc("total_orders"), F.asc_nulls_last("department"))
    )


def i5_peak_window(hours: DataFrame, width: int = 4) -> DataFrame:
    """The span of ``width`` consecutive hours with the most items; the earliest of equals."""
    hour = F.col("order_hour_of_day").cast("bigint")  # each hour counts for the spans that reach it, and a span starts at an hour
    back = F.explode(F.sequence(F.lit(0), F.lit(width - 1))).alias("back")
    spread = hours.where(hour.isNotNull()).select(hour.alias("hour"), "total_orders", back)
    spans = spread.groupBy((F.col("hour") - F.col("back")).alias("start")).agg(
        F.sum("total_orders").alias("total_orders"), F.bool_or(F.col("back") == 0).alias("is_hour")
    )
    start = F.col("start").cast(hours.schema["order_hour_of_day"].dataType)
    return (
        spans.where("is_hour")
        .select(start.alias("start_hour"), (start + width).alias("end_hour"), "total_orders")
        .orderBy(F.desc("total_orders"), "start_hour")
        .limit(1)
    )


def i6_share_with_others(departments: DataFrame, min_pct: float = 5) -> DataFrame:
    """Shares of the departments that reach ``min_pct``, and of all others together."""
    total = departments.agg(F.sum("total_orders")).scalar()
    shown = F.col("total_orders") * F.lit(100.0) >= F.lit(float(min_pct)) * F.col("whole")
    slices = (
        departments.withColumn("whole", total)
        .groupBy(F.when(shown, F.col("department")).otherwise(F.lit(labels.OTHERS)).alias("department"), "whole")
        .agg(F.sum("total_orders").alias("total_orders"))
    )
    return slices.select(
        "department", "total_orders", percent(F.col("total_orders"), F.col("whole")).alias("market_share_pct")
    ).orderBy(F.desc("total_orders"))


def i7_lowest_departments(departments: DataFrame, n: int = 2) -> DataFrame:
    """Departments with the fewest items."""
    return departments.orderBy("total_orders", F.asc_nulls_last("department")).limit(n)
