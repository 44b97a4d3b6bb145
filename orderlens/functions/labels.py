"""Report labels and the bounds that go with them.

Fixed values: the names and cut-offs below are part of the result contract.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

WEEKDAYS = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")

RATE_BUCKETS = ((0.8, "High (>=80%)"), (0.5, "Medium (50-79%)"), (0.2, "Low (20-49%)"))
RATE_REST = "Very Low (<20%)"

TIME_SEGMENTS = ((5, 11, "Morning (05-11)"), (12, 17, "Afternoon (12-17)"), (18, 21, "Evening (18-21)"))
TIME_REST = "Night (22-04)"

SHOPPING_PERIODS = ((6, 10, "Morning"), (11, 15, "Afternoon"), (16, 20, "Evening"))
SHOPPING_REST = "Night"

RETENTION_NAMES = ("Weekly", "Biweekly", "Monthly", "Inactive")
BASKET_NAMES = ("Small Basket", "Medium Basket", "Large Basket")

ABOVE, BELOW = "Above Average", "Below Average"
ANOMALY, NORMAL = "Anomaly", "Normal"
OTHERS = "Others"


def _cases(branches: Sequence[tuple[Column, str]], rest: str) -> Column:
    condition, name = branches[0]
    chain = F.when(condition, F.lit(name))
    for condition, name in branches[1:]:
        chain = chain.when(condition, F.lit(name))
    return chain.otherwise(F.lit(rest))


def at_least(value: Column, floors: Sequence[tuple[float, str]], rest: str) -> Column:
    """Name of the first floor the value reaches; ``floors`` go from high to low."""
    return _cases([(value >= F.lit(floor), name) for floor, name in floors], rest)


def at_most(value: Column, edges: Sequence[float], names: Sequence[str]) -> Column:
    """Name of the first edge the value does not exceed; the last name is for the rest."""
    return _cases([(value <= F.lit(edge), name) for edge, name in zip(edges, names)], names[len(edges)])


def within(value: Column, spans: Sequence[tuple[int, int, str]], rest: str) -> Column:
    """Name of the inclusive span that holds the value."""
    return _cases([(value.between(low, high), name) for low, high, name in spans], rest)


def weekday_name(dow: Column) -> Column:
    """English name for 0 (Sunday) to 6 (Saturday), NULL for anything else."""
    names = F.array(*(F.lit(day) for day in WEEKDAYS))
    return F.when(dow.between(0, 6), F.get(names, dow))
