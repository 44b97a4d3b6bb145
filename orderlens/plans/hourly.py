"""Reports on the hourly mart.

Totals and means over the whole mart are scalar subqueries: Spark computes them once from partial
aggregates and reuses the mart's shuffle, where a window without partition would move all rows to
one task. The running total is a prefix sum by spans of hours; the mart should have one row per hour of day, but
nothing relies on it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions import labels
from orderlens.functions.ratios import percent
from orderlens.operators.ranking import running_total

HOUR = "order_hour_of_day"


def _by_hour() -> Column:
    return F.asc_nulls_last(HOUR)


def b1_hour_share(hours: DataFrame) -> DataFrame:
    """Each hour's share of all items."""
    total = hours.agg(F.sum("total_orders")).scalar()
    share = percent(F.col("total_orders"), total).alias("pct_of_day")
    return hours.select(HOUR, "total_orders", share).orderBy(_by_hour())


def b2_time_segments(
    hours: DataFrame,
    spans: Sequence[tuple[int, int, str]] = labels.TIME_SEGMENTS,
    rest: str = labels.TIME_REST,
) -> DataFrame:
    """Items and share per part of the day."""
    segments = hours.groupBy(labels.within(F.col(HOUR), spans, rest).alias("time_segment")).agg(
        F.sum("total_orders").alias("total_orders")
    )
    total = hours.agg(F.sum("total_orders")).scalar()
    return segments.withColumn("pct", percent(F.col("total_orders"), total)).orderBy(F.desc("total_orders"))


def b3_running_total(hours: DataFrame) -> DataFrame:
    """Items from the start of the day through each hour."""
    span = F.shiftright(HOUR, 20)  # 4,096 of them for whole numbers in 32 bits, one for hours of the day
    running = running_total(hours.select(HOUR, "total_orders"), HOUR, span, "total_orders", "cumulative_orders")
    return running.orderBy(_by_hour())


def b4_hour_vs_avg(hours: DataFrame) -> DataFrame:
    """Each hour against the mean hour; only strictly more is above."""
    mean = hours.agg(F.avg("total_orders")).scalar()
    return hours.select(
        HOUR,
        "total_orders",
        F.round(mean, 2).alias("daily_avg"),
        F.when(F.col("total_orders") > mean, labels.ABOVE).otherwise(labels.BELOW).alias("vs_avg"),
    ).orderBy(_by_hour())
