"""Order items derived from a star schema (``lineitem``, ``orders``, ``part``).

The mapping gives any star-schema data set the shape of the lake. Keys, names and brands are used as
they are; the fields a star schema lacks (weekly rhythm, cart position, reorder flag) are computed
from the row's own keys, so no window and no sort is needed and a hot key costs nothing extra.

The joins are on unique keys of ``orders`` and ``part`` and keep every line, so a table none of
whose columns is asked for is not read at all. Both joins leave the strategy to Spark, which
broadcasts a side only below its size threshold and splits skewed partitions otherwise.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.schema import RAW

STAMP = "2024-01-01 00:00:00"


def _order_columns() -> dict[str, Column]:
    key, user = F.col("o_orderkey"), F.col("o_custkey")
    number = F.lit(1) + (key + user) % 24
    return {
        "user_id": user,
        "order_number": number,
        "order_dow": F.dayofweek("o_orderdate") - 1,
        "order_hour_of_day": key % 12 + user % 13,
        "days_since_prior_order": F.when(number > 1, (key * 7 + user * 3) % 41),
    }


def _part_columns() -> dict[str, Column]:
    brand_number = F.coalesce(F.substring("p_brand", 7, 10).try_cast("int"), F.lit(0))
    return {
        "product_name": F.col("p_name"),
        "department": F.col("p_brand"),
        "aisle": F.concat("p_brand", F.lit(" / "), "p_type"),
        "reorder_tenths": (F.length("p_name") * 3 + brand_number) % 11,
    }


def _line_columns() -> dict[str, Column]:
    draw = (F.col("l_orderkey") + F.col("l_linenumber") * 3 + F.col("l_suppkey")) % 10
    return {
        "order_id": F.col("l_orderkey"),
        "product_id": F.col("l_partkey"),
        "add_to_cart_order": F.col("l_linenumber") + (F.col("l_suppkey") % 3) * 6,
        "reordered": F.when(draw < F.col("reorder_tenths"), 1).otherwise(0),
        "ingestion_timestamp": F.lit(STAMP),
    }


def order_items(spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None) -> DataFrame:
    """The lake columns (or only ``columns``) for every row of ``lineitem``."""
    wanted = set(columns if columns is not None else RAW.fieldNames())

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")

    items = table("lineitem")
    of_order, of_part = _order_columns(), _part_columns()
    if wanted & of_order.keys():
        orders = table("orders").select("o_orderkey", *(c.alias(n) for n, c in of_order.items()))
        items = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    if wanted & {*of_part, "reordered"}:
        parts = table("part").select("p_partkey", *(c.alias(n) for n, c in of_part.items()))
        items = items.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
    of_line = _line_columns()
    return items.select(
        *(of_line.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in RAW.fields if f.name in wanted)
    )
