import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from orderlens.operators import (
    describe_numeric,
    exact_percentiles,
    preview,
    profile_columns,
    sample_rows,
    validate_raw,
)


@pytest.mark.parametrize("size", [1, 2, 5, 100, 4001])
def test_percentiles_equal_numpy(spark, size):
    rng = np.random.default_rng(size)
    x = rng.normal(0, 100, size)
    hot = np.where(rng.random(size) < 0.4, 3, rng.integers(0, 50, size))
    df = spark.createDataFrame([(float(a), int(h)) for a, h in zip(x, hot)], "x double, hot int")
    fractions = (0.0, 0.1, 0.25, 0.5, 0.9, 1.0)
    got = {(r.column_name, r.fraction): r.value for r in exact_percentiles(df, ["x", "hot"], fractions).collect()}
    assert len(got) == 2 * len(fractions)
    for name, values in (("x", x), ("hot", hot)):
        for f in fractions:
            assert float(got[name, f]) == pytest.approx(np.quantile(values, f), abs=1e-9)


def test_percentiles_skip_null_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (None,), (float("nan"),)], "x double")
    assert rows(exact_percentiles(df, ["x"], (0.25,))) == [("x", 0.25, 1.75)]


def test_digits_beyond_doubles_are_kept(spark):
    ids = [(2**53 + 1 + 2 * i,) for i in range(5)]
    row = describe_numeric(spark.createDataFrame(ids, "id bigint")).first()
    assert [int(row[c]) for c in ("min", "p25", "p50", "p75", "max")] == [i for i, in ids]


@pytest.mark.parametrize("kept", [60, 5000])
def test_brackets_of_many_rows(spark, monkeypatch, kept):
    """Sketches narrow ranges down, once or several times."""
    monkeypatch.setattr("orderlens.operators.profiling.KEPT", kept)
    monkeypatch.setattr("orderlens.operators.profiling.ACCURACY", 100)
    rng = np.random.default_rng(7)
    wide, hot = rng.integers(-(10**12), 10**12, 20_000), np.where(rng.random(20_000) < 0.35, 5, rng.integers(0, 9, 20_000))
    df = spark.createDataFrame(list(zip(wide.tolist(), hot.tolist(), rng.normal(0, 1, 20_000).tolist(), strict=True)), "wide bigint, hot int, x double").repartition(5)
    for columns in (["wide", "hot"], ["wide", "x"]):
        for r in exact_percentiles(df, columns, (0.0, 0.1, 0.25, 0.5, 0.999, 1.0)).collect():
            values = [v[r.column_name] for v in df.select(r.column_name).collect()]
            assert float(r.value) == pytest.approx(np.quantile(values, r.fraction), rel=1e-12)


def test_percentiles_move_and_keep_little(spark):
    df = spark.range(1000)
    plan = describe_numeric(df)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_describe(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "d"), (None, "e")], "n int, s string")
    assert rows(describe_numeric(df)) == [("n", 4, 2.5, 1.290994, 1.0, 1.75, 2.5, 3.25, 4.0)]


def test_profile_columns(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "`a.b` int, s string")
    assert rows(profile_columns(df)) == [("a.b", "int", 1), ("s", "string", 2)]


def test_preview_and_sample(spark):
    df = spark.range(1000).withColumn("x", F.col("id") % 7)
    assert [r.id for r in preview(df, 3, ["id"]).collect()] == [0, 1, 2]
    assert preview(df, 3).count() == 3
    first = rows(sample_rows(df, ["id"]))
    assert len(set(first)) == 5
    assert rows(sample_rows(df.repartition(13), ["id"])) == first
    assert rows(sample_rows(df, ["id"], seed=1)) != first


def test_sample_is_spread_evenly(spark):
    ids = [r.id for r in sample_rows(spark.range(10000), ["id"], n=500).collect()]
    assert 4500 < np.mean(ids) < 5500


def test_validation_counts_each_rule(items):
    raw = items({}, {"user_id": None}, {"order_id": -1}, {"order_id": 2**32}, {"order_hour_of_day": 256},
                {"department": None}, {"days_since_prior_order": None}, {"days_since_prior_order": 65536})
    found = {r.rule: r.violations for r in validate_raw(raw).collect()}
    assert {k: v for k, v in found.items() if v} == {
        "user_id not null": 1, "order_id fits uint32": 2, "order_hour_of_day fits uint8": 1,
        "department not null": 1, "days_since_prior_order fits uint16": 1,
    }
    assert len(found) == 21


def test_nan_is_missing_and_names_may_have_dots(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0, 1), (2.0, 2), (nan, 3), (None, None), (float("inf"), 4)], "`a.b` double, `c d` int")
    found = {r[0]: r[1:] for r in rows(describe_numeric(df.where("`a.b` is null or `a.b` < 10 or isnan(`a.b`)")))}
    assert found["a.b"] == (2, 1.5, 0.707107, 1.0, 1.25, 1.5, 1.75, 2.0)
    assert found["c d"] == (3, 2.0, 1.0, 1.0, 1.5, 2.0, 2.5, 3.0)
    infinite = {r[0]: r[1:] for r in rows(describe_numeric(df))}["a.b"]
    assert infinite[0] == 3 and infinite[3:6] == (1.0, 1.5, 2.0) and infinite[7] == float("inf")
    only = spark.createDataFrame([(nan,), (None,)], "x double")
    assert rows(describe_numeric(only)) == [("x", 0, None, None, None, None, None, None, None)]


def test_plan_does_not_grow_with_fractions(spark):
    df = spark.createDataFrame([tuple(range(9))] * 3, ", ".join(f"c{i} int" for i in range(9)))
    df = df.unionByName(spark.range(9).select(*(F.col("id").cast("int").alias(c) for c in df.columns)))
    plans = [exact_percentiles(df, df.columns[:n], fractions)._jdf.queryExecution().optimizedPlan().toString()
             for n, fractions in ((1, (0.5,)), (9, (0.1, 0.2, 0.5, 0.9)))]
    assert plans[0].count("\n") - plans[1].count("\n") in (0, 1)  # a projection for a single column
    assert "subquery" not in describe_numeric(df)._jdf.queryExecution().executedPlan().toString()
