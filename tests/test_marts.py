import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from orderlens.operators import (
    build_marts,
    dedupe_latest,
    department_analytics,
    hourly_analytics,
    mart_grain,
    marts_from_grain,
    product_analytics,
)
from orderlens.plans import run
from orderlens.plans.product import a8_rate_buckets
from orderlens.sources.star_tables import order_items


def test_nulls_in_groups_and_counts(items):
    raw = items(
        {"order_id": 1, "product_name": "a", "reordered": None},
        {"order_id": None, "product_name": "a", "reordered": 1},
        {"order_id": 2, "product_name": None, "reordered": 1},
        {"order_id": None, "product_name": "b", "reordered": 1},
    )
    assert {r[0]: r[2:] for r in rows(product_analytics(raw))} == {
        "a": (1, 1, 1.0),
        None: (1, 1, 1.0),
        "b": (0, 1, 0.0),
    }


def test_only_ones_count_as_reorders(items):
    raw = items(*({"reordered": r} for r in (0, 1, 2, None)))
    assert rows(product_analytics(raw)) == [("milk", "dairy", 4, 1, 0.25)]


def test_rate_is_rounded_in_the_mart(items):
    raw = items(*({"reordered": int(i < 159)} for i in range(200)))
    mart = product_analytics(raw)
    assert mart.first().reorder_rate == 0.8
    assert a8_rate_buckets(mart).first().reorder_bucket == "High (>=80%)"


def test_missing_department_is_null_in_marts_and_empty_in_detail(items):
    tables = build_marts(items({"department": None}))
    assert tables["department_analytics"].first().department is None
    assert tables["product_analytics"].first().department is None
    assert tables["raw_orders"].first().department == ""


@pytest.mark.parametrize("build_all", [build_marts, lambda raw: marts_from_grain(mart_grain(raw))])
def test_roll_ups_equal_direct_marts(items, spark, build_all):
    raw = order_items(spark, "/root/testdata/sf0.001").unionByName(
        items({"department": None}, {"product_name": None}, {"order_hour_of_day": None}, {"order_id": None})
    )
    rolled = build_all(raw)
    for build in (product_analytics, hourly_analytics, department_analytics):
        direct = build(raw)
        assert rolled[build.__name__].dtypes == direct.dtypes
        assert sorted(rows(rolled[build.__name__]), key=str) == sorted(rows(direct), key=str)


def test_marts_add_up(spark):
    raw = order_items(spark, "/root/testdata/sf0.001")
    tables = build_marts(raw)
    totals = {name: tables[name].agg(F.sum("total_orders")).first()[0] for name in tables if name != "raw_orders"}
    assert set(totals.values()) == {6000}
    by_department = tables["product_analytics"].groupBy("department").agg(F.sum("total_orders"))
    assert sorted(rows(by_department)) == sorted(rows(tables["department_analytics"]))


def test_dedupe_keeps_the_rows_of_the_latest_landing(items):
    early, late = "2024-01-01 00:00:00", "2024-01-02 00:00:00"
    raw = items(
        {"product_id": 1, "ingestion_timestamp": early, "add_to_cart_order": 9},
        # one basket with the product at two places
        {"product_id": 1, "ingestion_timestamp": late, "add_to_cart_order": 3},
        {"product_id": 1, "ingestion_timestamp": late, "add_to_cart_order": 4},
        {"product_id": 2, "ingestion_timestamp": early},
        {"product_id": 2, "ingestion_timestamp": None, "add_to_cart_order": 8},
        {"product_id": 3, "ingestion_timestamp": None, "add_to_cart_order": 5},
        {"product_id": None, "add_to_cart_order": 1},
        {"product_id": None, "add_to_cart_order": 2},
        {"order_id": None, "add_to_cart_order": 6},
    )
    kept = dedupe_latest(raw)
    assert kept.columns == raw.columns
    assert sorted((r.product_id or 0, r.add_to_cart_order) for r in kept.collect()) == [
        (0, 1), (0, 2), (1, 3), (1, 4), (1, 6), (2, 1), (3, 5),
    ]


def test_dedupe_reduces_copies_before_the_shuffle(items):
    plan = dedupe_latest(items({}))._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_dedupe_equals_brute_force(spark):
    """Random rows, a third of them copies of one key."""
    rng = random.Random(5)
    data = [
        (
            1 if rng.random() < 0.35 else rng.choice([None, 2, 3, 4]),
            1 if rng.random() < 0.35 else rng.choice([None, 2, 3]),
            rng.choice([None, 1, 2, 3]),
            rng.choice([None, *(f"2024-01-0{d} 00:00:00" for d in (1, 2, 3))]),
        )
        for _ in range(400)
    ]
    schema = "order_id bigint, product_id bigint, add_to_cart_order int, ingestion_timestamp string"
    df = spark.createDataFrame(data, schema).repartition(7)
    newest = {}
    for order, product, _, stamp in data:
        newest[order, product] = max(newest.get((order, product), ""), stamp or "")
    want = [d for d in data if None in d[:2] or (d[3] or "") == newest[d[:2]]]
    assert sorted(rows(dedupe_latest(df)), key=str) == sorted(want, key=str)


def test_reports_add_up(spark):
    tables = build_marts(order_items(spark, "/root/testdata/sf0.001"))
    assert rows(run("b3_running_total", tables))[-1][2] == 6000
    assert max(r[3] for r in rows(run("i4_pareto", tables))) == 100
    for name, column in (("b1_hour_share", 2), ("c1_market_share", 2), ("d8_department_share", 2), ("b2_time_segments", 2)):
        shares = [r[column] for r in rows(run(name, tables))]
        assert sum(shares) == pytest.approx(100, abs=0.005 * len(shares))
