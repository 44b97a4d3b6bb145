"""Shares, rates and their rounding (half up, NULL when the divisor is zero)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(part: Column, whole: Column) -> Column:
    return F.try_divide(part, whole)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(F.try_divide(part * F.lit(100.0), whole), digits)


def settle(value: Column, digits: int) -> Column:
    """Round a value that came out of a floating sum.

    The last bits of such a sum depend on the order in which tasks finish. Going through 12
    decimals first removes them, so reruns agree. Values too wide for that are rounded directly.
    """
    exact = F.round(value.try_cast("decimal(28,12)"), digits).cast("double")
    return F.coalesce(exact, F.round(value, digits))
