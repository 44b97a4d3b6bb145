"""Readable text for counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The unit names of the readable form, largest first.
UNITS = ((1e15, " quadrillion"), (1e12, " trillion"), (1e9, " billion"), (1e6, " million"), (1e3, " thousand"))


def readable_quantity(count: Column) -> Column:
    """``1234567`` as ``1.23 million``: two decimals and the largest unit that fits."""
    text = F.when(count.isNull(), F.lit(None).cast("string"))
    for size, unit in UNITS:
        scaled = F.format_string("%.2f", count.cast("double") / F.lit(size))
        text = text.when(F.abs(count) >= F.lit(size), F.concat(scaled, F.lit(unit)))
    return text.otherwise(F.format_string("%.2f", count.cast("double")))
