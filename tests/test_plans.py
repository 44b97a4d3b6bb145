"""What the plans must and must not contain, with broadcasting off as for large tables."""

import re

import pytest

from orderlens.plans import REPORTS, run
from orderlens.sources.star_tables import order_items

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    from orderlens.plans import load_tables
    from orderlens.sinks import read_tables

    root = str(tmp_path_factory.mktemp("warehouse"))
    load_tables(order_items(spark, SF), root)
    return read_tables(spark, root)


@pytest.fixture(scope="module")
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", REPORTS)
def test_report_plans(tables, no_broadcast, name):
    plan = plan_of(run(name, tables))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BroadcastExchange" not in plan
    assert "Python" not in plan and "ObjectHashAggregate" not in plan
    # rows reach a single partition only as partial aggregates, or as totals of a bounded number of spans
    for below, keys in re.findall(r"Exchange SinglePartition[^\n]*\n[^A-Za-z]*(?:\*\(\d+\) )?(\w+)(?:\(keys?=\[([^\]]*))?", plan):
        assert below in ("HashAggregate", "SortAggregate"), plan
        assert not keys or re.fullmatch(r"_span#\d+", keys), plan


@pytest.mark.parametrize("name", [n for n, r in REPORTS.items() if r.table == "raw_orders"])
def test_detail_reports_read_only_their_columns(tables, name):
    plan = plan_of(run(name, tables))
    read = set(re.findall(r"(\w+):", " ".join(re.findall(r"ReadSchema: struct<([^>]*)>", plan))))
    assert read == set(REPORTS[name].columns)


def test_filters_reach_the_scan(tables):
    assert "GreaterThanOrEqual(total_orders,30)" in plan_of(run("a7_evergreen", tables))
    assert "IsNotNull(days_since_prior_order)" in plan_of(run("d11_retention", tables))


def test_unneeded_tables_are_not_read(spark):
    plan = plan_of(order_items(spark, SF, ["order_id", "department"]))
    assert "part.parquet" in plan and "orders.parquet" not in plan
    assert "Join" not in plan_of(order_items(spark, SF, ["order_id", "product_id"]))


def test_top_k_reports_do_not_sort_everything(tables):
    for name in ("a1_top_products", "a3_lowest_reorder", "d4_active_users", "d6_top_aisles", "d7_consistent_users"):
        assert "TakeOrderedAndProject" in plan_of(run(name, tables))
