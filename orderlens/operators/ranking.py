"""Ranks and running totals over tie groups.

Rows that share a value share a rank, so ranking needs only the distinct values and how many rows
hold each. That aggregate is built with map-side partial counts; the window runs on it, and the
rows get their rank back by an equi-join. No task ever sorts all rows of a group, however large
the group or a tie in it is.

Figures that run over all rows, without groups, are prefix sums in two steps: rows are dealt to at most 4,096
spans of neighbouring values by a formula, so nothing is sampled and a retried task deals alike; a window runs
within each span, and another one over the spans' totals. No task sorts all values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


SPANS = 64  # to a doubling


def value_span(value: Column) -> Column:
    """Spans of neighbouring counts, ascending: 64 to a doubling, 4,032 in all; one for counts under 2 and NULL.

    Totals of N items: a span at v holds at most v / 64 different ones, and at most N / v that occur, so sqrt(N) / 8 by
    either bound: 125,000 for 10**12 items.
    """
    return F.floor(F.log2(F.greatest(value, F.lit(1)).cast("double")) * SPANS).cast("int")


def running_total(df: DataFrame, key: str, span: Column, value: str, name: str) -> DataFrame:
    """``df`` with the sum of ``value`` over all rows up to and including those of the same ``key``.

    NULL keys come last. ``span`` ascends with the key, has few values (4,096 at most) and is NULL, or a span of its own
    at the end, for a NULL key. The sum is NULL as long as all values are.
    """
    rows = df.withColumn("_span", span)
    spans = rows.groupBy("_span").agg(F.sum(value).alias("_within"))
    ahead = Window.orderBy(F.asc_nulls_last("_span")).rowsBetween(Window.unboundedPreceding, -1)
    before = spans.select(F.col("_span").alias("_of"), F.sum("_within").over(ahead).alias("_before"))
    through = Window.partitionBy("_span").orderBy(F.asc_nulls_last(key))
    within = rows.withColumn("_within", F.sum(value).over(through.rangeBetween(Window.unboundedPreceding, Window.currentRow)))
    total = F.coalesce(F.col("_before") + F.col("_within"), "_before", "_within")
    joined = within.join(before, F.col("_span").eqNullSafe(F.col("_of")))
    return joined.select(*(F.col(f"`{c}`") for c in df.columns), total.alias(name))


def _rank(order) -> Column:
    ahead = F.sum("tied").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return (F.lit(1) + F.coalesce(ahead, F.lit(0))).cast("int")


def top_ranked(df: DataFrame, group: str, value: str, n: int, rank: str) -> DataFrame:
    """Rows whose ``rank()`` by descending ``value`` within ``group`` is at most ``n``, ties kept.

    Only the ``n`` largest distinct values of a group can qualify, and the row-number filter lets
    each task drop all others before the shuffle by group.
    """
    order = Window.partitionBy(group).orderBy(F.col(value).desc_nulls_last())
    levels = df.groupBy(group, value).agg(F.count(F.lit(1)).alias("tied"))
    best = (
        levels.withColumn("level", F.row_number().over(order))
        .filter(F.col("level") <= n)
        .withColumn(rank, _rank(order))
        .filter(F.col(rank) <= n)
        .select(F.col(group).alias("_group"), F.col(value).alias("_value"), rank)
    )
    same = F.col(group).eqNullSafe(F.col("_group")) & F.col(value).eqNullSafe(F.col("_value"))
    return df.join(best, same).drop("_group", "_value")


def tie_order(df: DataFrame, value: str, name: str) -> DataFrame:
    """One row per distinct ``value``, largest first in rank.

    Columns: ``value``; ``tied``, the rows that hold it; ``rank``; ``next_value``, the next smaller
    value; ``last_name``, the last of the tied ``name`` in ascending order with NULL at the end;
    ``running``, the total of all rows down to and including this tie.
    """
    levels = df.groupBy(value).agg(
        F.count(F.lit(1)).alias("tied"),
        F.max(name).alias("_max_name"),
        F.max(F.col(name).isNull()).alias("_any_null"),
    )
    levels = levels.withColumn("_span", value_span(F.col(value)))
    spans = levels.groupBy("_span").agg(
        F.sum("tied").alias("_tied"), F.max(value).alias("_top"), F.sum(F.col(value) * F.col("tied")).alias("_sum")
    )
    down = Window.orderBy(F.desc("_span"))
    above = down.rowsBetween(Window.unboundedPreceding, -1)
    before = spans.select(
        F.col("_span").alias("_of"),
        F.coalesce(F.sum("_tied").over(above), F.lit(0)).alias("_ranks"),
        F.sum("_sum").over(above).alias("_before"),
        F.lead("_top").over(down).alias("_below"),
    )
    order = Window.partitionBy("_span").orderBy(F.col(value).desc())
    through = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = levels.withColumns(
        {
            "_rank": _rank(order),
            "_next": F.lead(value).over(order),
            "_within": F.sum(F.col(value) * F.col("tied")).over(through),
        }
    )
    return within.join(before, F.col("_span") == F.col("_of")).select(
        value,
        "tied",
        (F.col("_ranks") + F.col("_rank")).cast("int").alias("rank"),
        F.coalesce("_next", "_below").alias("next_value"),
        F.when(~F.col("_any_null"), F.col("_max_name")).alias("last_name"),
        F.coalesce(F.col("_before") + F.col("_within"), "_before", "_within").alias("running"),
    )
