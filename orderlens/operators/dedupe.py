"""Drop rows that a later landing repeats."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedupe_latest(
    raw: DataFrame,
    keys: Sequence[str] = ("order_id", "product_id"),
    by: str = "ingestion_timestamp",
) -> DataFrame:
    """Every row that carries the largest ``by`` of its key; rows with a NULL in a key all stay.

    Copies are rows of an older landing. One landing may hold a key several times, such as a
    product at two places of one basket, and these rows are kept. A NULL in ``by`` is older than
    any value. Each task first reduces its rows of a key to one timestamp; the join back is on the
    key and the timestamp, and a key of any frequency is split there.
    """
    named = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
    newest = raw.where(named).groupBy(*keys).agg(F.max(by).alias("_newest"))
    rows = raw.where(named).join(newest, list(keys))
    latest = rows.where(F.col(by).eqNullSafe(F.col("_newest"))).select(*raw.columns)
    return latest.unionByName(raw.where(~named))
