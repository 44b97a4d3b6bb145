import random

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from orderlens.operators import tie_order, top_ranked
from orderlens.operators.ranking import running_total, value_span


@pytest.mark.parametrize("seed", range(4))
def test_top_ranked_equals_a_plain_window(spark, seed):
    """Against rank() over whole groups, with one group and one value holding most rows."""
    rng = random.Random(seed)
    data = [
        (n, rng.choice(["hot"] * 4 + ["a", "b", None]), rng.choice([1] * 5 + list(range(1, 12)))) for n in range(600)
    ]
    df = spark.createDataFrame(data, "id int, g string, v bigint")
    n = rng.choice([1, 3, 5, 40])
    window = Window.partitionBy("g").orderBy(F.col("v").desc())
    expected = df.withColumn("place", F.rank().over(window)).filter(F.col("place") <= n)
    assert sorted(rows(top_ranked(df, "g", "v", n, "place")), key=str) == sorted(rows(expected), key=str)


def test_tie_order(spark):
    df = spark.createDataFrame([("a", 5), ("b", 5), (None, 5), ("c", 9), ("d", 1)], "name string, v bigint")
    got = tie_order(df, "v", "name").orderBy(F.desc("v"))
    assert [tuple(r) for r in got.select("v", "tied", "rank", "next_value", "last_name", "running").collect()] == [
        (9, 1, 1, 5, "c", 9), (5, 3, 2, 1, None, 24), (1, 1, 5, None, "d", 25),
    ]


@pytest.mark.parametrize("seed", range(3))
def test_tie_order_equals_plain_windows(spark, seed):
    """Totals over many spans, a hot tie, zeros and a missing total."""
    rng = random.Random(seed)
    totals = [rng.choice([0, 1, 2, 7, 7, 7, int(2 ** rng.uniform(0, 40)), 10**6 + rng.randrange(50)]) for _ in range(400)]
    df = spark.createDataFrame([(f"n{i}", v) for i, v in enumerate(totals)], "name string, v bigint")
    got = {r["v"]: r for r in tie_order(df, "v", "name").collect()}
    levels = sorted(set(totals), reverse=True)
    assert set(got) == set(levels)
    for v, following in zip(levels, [*levels[1:], None], strict=True):
        r = got[v]
        assert (r["rank"], r["running"]) == (1 + sum(t > v for t in totals), sum(t for t in totals if t >= v))
        assert (r["next_value"], r["tied"]) == (following, totals.count(v))
        assert r["last_name"] == max(f"n{i}" for i, t in enumerate(totals) if t == v)


def test_spans_ascend_and_are_few(spark):
    values = sorted({*range(3000), *(2**p + d for p in range(12, 62) for d in (-1, 0, 1)), 2**63 - 1})
    spans = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v bigint").select(value_span(F.col("v"))).collect()]
    assert spans == sorted(spans) and 0 <= spans[0] and spans[-1] <= 4032
    assert max(spans.count(s) for s in set(spans[2000:3000])) <= 2000 / 32


@pytest.mark.parametrize("width", [1, 5, 1000])
def test_running_total_equals_a_plain_window(spark, width):
    rng = random.Random(width)
    data = [(rng.choice([None, *range(-20, 60)]), rng.choice([None, 1, 5, 100])) for _ in range(200)]
    df = spark.createDataFrame(data, "k int, v bigint")
    through = Window.orderBy(F.asc_nulls_last("k")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    expected = df.withColumn("s", F.sum("v").over(through))
    got = running_total(df, "k", F.floor(F.col("k") / width), "v", "s")
    assert sorted(rows(got), key=str) == sorted(rows(expected), key=str)
    assert running_total(df.limit(0), "k", F.col("k"), "v", "s").count() == 0


def test_groups_are_trimmed_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", "g", 1)], "id string, g string, v bigint")
    plan = top_ranked(df, "g", "v", 5, "place")._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 5, Partial" in plan.replace("\n", " ")
