"""All reports against DuckDB on random items with NULLs everywhere and one hot value per column."""

import random

import duckdb
import pandas as pd
import pytest
from conftest import rows

from checks.oracles import ITEMS, oracle_sql
from orderlens.operators import department_analytics, hourly_analytics, product_analytics
from orderlens.plans import REPORTS, run
from orderlens.schema import RAW


def random_items(seed: int, size: int) -> list[tuple]:
    rng = random.Random(seed)

    def value(hot, others, missing=0.05):
        return None if rng.random() < missing else hot if rng.random() < 0.35 else rng.choice(others)

    return [
        (
            value(1, range(1, 200)), value(1, range(1, 30)), value(1, range(1, 20)), value(0, range(8)),
            value(10, range(24)), value(7, range(40), missing=0.2), value(1, range(1, 40)),
            value("milk", ["pear", "egg", "tea", "rice", ""]), value("dairy", ["fruit", "dry", "drinks", ""]),
            value("cold", ["a", "b"]), value(1, range(1, 20)), value(0, [0, 1, 1, 2], missing=0.1),
            value("2024-01-01 00:00:00", ["2024-01-02 00:00:00"]),
        )
        for _ in range(size)
    ]


@pytest.fixture(scope="module", params=[(1, 3000), (2, 400), (3, 7)], ids=lambda p: f"{p[1]} items")
def both(request, spark):
    data = random_items(*request.param)
    raw = spark.createDataFrame(data, RAW).repartition(5)
    tables = {m.__name__: m(raw) for m in (product_analytics, hourly_analytics, department_analytics)}
    types = {"bigint": "Int64", "int": "Int32", "string": "object"}
    frame = pd.DataFrame(data, columns=RAW.fieldNames()).astype({f.name: types[f.dataType.simpleString()] for f in RAW})
    duck = duckdb.connect()
    duck.register("given", frame)
    return {"raw_orders": raw, **tables}, duck


@pytest.mark.parametrize("name", REPORTS)
def test_report_on_random_items(both, name):
    tables, duck = both
    result = duck.execute(oracle_sql()[name].replace(ITEMS, "items AS (FROM given)"))
    names = [c[0] for c in result.description]
    got = run(name, tables)
    assert got.columns == names
    assert sorted(map(repr, rows(got))) == sorted(map(repr, result.fetchall()))
