import pytest
from conftest import rows
from pyspark.sql import functions as F

from orderlens.operators import distinct_sketches, merge_sketches, sketched_counts
from orderlens.plans import run

KEYS = ("user_id",)


@pytest.fixture(scope="module")
def visits(spark):
    """30,000 rows of 20,000 users over 3 groups and 10 days, a third of the rows with one user."""
    n = F.col("id")
    user = F.when(n % 3 == 0, 7).otherwise(F.pmod(F.xxhash64(n), F.lit(20_000)))
    return spark.range(30_000).select((n % 3).alias("g"), (n % 10).alias("day"), user.alias("user_id"))


def test_merged_sketches_stay_near_however_they_were_cut(visits):
    """By day or by batch, and also when a batch is merged twice."""
    exact = [r["n"] for r in visits.groupBy("g").agg(F.count_distinct("user_id").alias("n")).orderBy("g").collect()]
    first, second = (distinct_sketches(visits.where(F.col("day") % 2 == half), ("g",), KEYS) for half in (0, 1))
    both = first.unionByName(second)
    for sketches in (distinct_sketches(visits, ("g", "day"), KEYS), both, both.unionByName(first)):
        found = sketched_counts(merge_sketches(sketches, ("g",), KEYS), KEYS).orderBy("g")
        assert [r[1] for r in rows(found)] == pytest.approx(exact, rel=0.04)


def test_nothing_and_nulls(visits):
    none = visits.limit(0)
    assert rows(sketched_counts(distinct_sketches(none, ("g",), KEYS), KEYS)) == []
    assert rows(sketched_counts(distinct_sketches(none, (), KEYS), KEYS)) == [(0,)]
    missing = visits.withColumn("user_id", F.when(F.col("g") == 1, F.col("user_id")))
    found = dict(rows(sketched_counts(distinct_sketches(missing, ("g",), KEYS), KEYS)))
    assert found[2] == 0 and found[1] > 0


def test_totals_by_sketches(items):
    raw = items(*({"order_id": n // 3, "user_id": n % 40, "product_id": n % 7} for n in range(300)))
    exact, near = run("d1_totals", {"raw_orders": raw}).first(), run("d1_totals", {"raw_orders": raw}, approx=True).first()
    assert exact.asDict().keys() == near.asDict().keys() and near["total_rows"] == 300
    assert [near[c] for c in exact.asDict()] == pytest.approx(list(exact), rel=0.04)
    assert tuple(run("d1_totals", {"raw_orders": raw.limit(0)}, approx=True).first()) == (0, 0, 0, 0)
