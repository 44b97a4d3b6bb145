"""All dashboard reports by name."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame

from orderlens.plans import department, detail, hourly, insights, product


@dataclass(frozen=True)
class Report:
    """A report, the table it reads and, for the detail table, the columns it needs."""

    build: Callable[..., DataFrame]
    table: str
    columns: tuple[str, ...] = ()


_DETAIL_COLUMNS: dict[Callable[..., DataFrame], tuple[str, ...]] = {
    detail.d1_totals: ("order_id", "user_id", "product_id"),
    detail.d2_items_per_order: ("order_id", "add_to_cart_order"),
    detail.d3_by_weekday: ("order_dow",),
    detail.d4_active_users: ("user_id", "order_id", "days_since_prior_order"),
    detail.d5_department_reorder: ("department", "reordered"),
    detail.d6_top_aisles: ("aisle", "department", "order_id"),
    detail.d7_consistent_users: ("user_id", "reordered", "product_id"),
    detail.d8_department_share: ("department",),
    detail.d9_shopping_periods: ("order_hour_of_day", "order_id", "user_id"),
    detail.d10_loyal_departments: ("department", "user_id", "order_id", "reordered"),
    detail.d11_retention: ("days_since_prior_order", "user_id", "order_id", "reordered"),
    detail.d12_basket_depth: ("add_to_cart_order", "order_id"),
    insights.i1_overall_rate: ("reordered",),
    insights.i2_interval_modes: ("days_since_prior_order",),
    insights.i3_rate_by_tenure: ("order_number", "reordered"),
}

_MART_REPORTS: dict[str, tuple[Callable[..., DataFrame], ...]] = {
    "product_analytics": (
        product.a1_top_products,
        product.a2_top_reorder,
        product.a3_lowest_reorder,
        product.a4_department_breadth,
        product.a5_department_avg_rate,
        product.a6_top_per_department,
        product.a7_evergreen,
        product.a8_rate_buckets,
        product.a9_orders_vs_reorders,
        product.a10_first_time_dominant,
    ),
    "hourly_analytics": (
        hourly.b1_hour_share,
        hourly.b2_time_segments,
        hourly.b3_running_total,
        hourly.b4_hour_vs_avg,
        insights.i5_peak_window,
    ),
    "department_analytics": (
        department.c1_market_share,
        department.c2_concentration,
        department.c3_zscore,
        department.c4_vs_average,
        department.c5_gap_to_next,
        insights.i4_pareto,
        insights.i6_share_with_others,
        insights.i7_lowest_departments,
    ),
}

REPORTS: dict[str, Report] = {
    **{f.__name__: Report(f, table) for table, functions in _MART_REPORTS.items() for f in functions},
    **{f.__name__: Report(f, "raw_orders", columns) for f, columns in _DETAIL_COLUMNS.items()},
}


def run(name: str, tables: Mapping[str, DataFrame], **params: Any) -> DataFrame:
    """The report ``name`` over the warehouse tables; ``params`` replace its default thresholds."""
    if name not in REPORTS:
        raise KeyError(f"no report named {name!r}; there are {', '.join(sorted(REPORTS))}")
    report = REPORTS[name]
    return report.build(tables[report.table], **params)


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make the tables and all reports with their default thresholds available to SQL by name."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    for name in REPORTS:
        run(name, tables).createOrReplaceTempView(name)
