"""Reports on the department mart. Whole-mart figures are scalar subqueries, as for the hours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions import labels
from orderlens.functions.ratios import percent, settle
from orderlens.operators.ranking import tie_order


def _orders() -> Column:
    return F.col("total_orders")


def c1_market_share(departments: DataFrame) -> DataFrame:
    """Each department's share of all items."""
    total = departments.agg(F.sum("total_orders")).scalar()
    return departments.select(
        "department", "total_orders", percent(_orders(), total).alias("market_share_pct")
    ).orderBy(F.desc("total_orders"))


def c2_concentration(departments: DataFrame, threshold: int = 50) -> DataFrame:
    """How many departments are large, and the share of items they hold."""
    large = _orders() >= threshold
    return departments.agg(
        F.count(F.lit(1)).alias("total_departments"),
        F.sum(F.when(large, 1).otherwise(0)).alias("major_departments"),
        percent(F.sum(F.when(large, _orders()).otherwise(0)), F.sum("total_orders")).alias(
            "pct_orders_from_major_departments"
        ),
    )


def c3_zscore(departments: DataFrame, z: float = 2) -> DataFrame:
    """Distance from the mean in population deviations; NULL and normal when all are equal."""
    stats = departments.agg(F.avg("total_orders").alias("mean"), F.stddev_pop("total_orders").alias("deviation"))
    mean, deviation = stats.select("mean").scalar(), stats.select("deviation").scalar()
    scored = departments.select("department", "total_orders", F.try_divide(_orders() - mean, deviation).alias("score"))
    return scored.select(
        "department",
        "total_orders",
        settle(F.col("score"), 2).alias("z_score"),
        F.when(F.abs("score") >= z, labels.ANOMALY).otherwise(labels.NORMAL).alias("anomaly_status"),
    ).orderBy(F.desc("z_score"))


def c4_vs_average(departments: DataFrame) -> DataFrame:
    """Each department against the unrounded mean; only strictly more is above."""
    mean = departments.agg(F.avg("total_orders")).scalar()
    return departments.select(
        "department",
        "total_orders",
        F.round(mean, 2).alias("avg_orders"),
        F.when(_orders() > mean, labels.ABOVE).otherwise(labels.BELOW).alias("performance"),
    ).orderBy(F.desc("total_orders"))


def c5_gap_to_next(departments: DataFrame, lead_default: int | None = None) -> DataFrame:
    """Rank by items and the gap to the next department (equal totals: by name).

    ``lead_default`` stands for the total after the last department: None gives a NULL gap there.
    """
    ties = tie_order(departments, "total_orders", "department").select(
        F.col("total_orders").alias("_total"), "rank", "next_value", "last_name"
    )
    following = F.coalesce(F.col("next_value"), F.lit(lead_default).cast("bigint"))
    is_last = F.col("department").eqNullSafe(F.col("last_name"))
    return (
        departments.join(ties, _orders() == F.col("_total"))
        .select(
            "department",
            "total_orders",
            F.col("rank").alias("dept_rank"),
            F.when(is_last, _orders() - following).otherwise(F.lit(0)).alias("gap_to_next"),
        )
        .orderBy(F.desc("total_orders"), F.asc_nulls_last("department"))
    )
