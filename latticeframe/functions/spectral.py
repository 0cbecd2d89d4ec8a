"""Band arithmetic (PRJ-09, PRJ-10, PRJ-16 .. PRJ-18, PRJ-24)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from latticeframe.functions.nulls import finite, ratio, value

# Weights of the broadband albedo proxy.
ALBEDO_WEIGHTS = {"B02": 0.2266, "B03": 0.1236, "B04": 0.1573, "B08": 0.3417, "B11": 0.1170, "B12": 0.0338}


def normalised_difference(a: str | Column, b: str | Column) -> Column:
    """(a - b) / (a + b); NULL where the sum is 0 or an operand is missing."""
    a, b = value(a), value(b)
    return ratio(a - b, a + b)


def weighted_sum(weights: dict[str, float]) -> Column:
    total = F.lit(0.0)
    for name, w in weights.items():
        total = total + value(name) * w
    return total


def surface(terrain: Column, height: Column) -> Column:
    """PRJ-18: terrain, plus the height where it is above 0."""
    h = value(height)
    return F.when(h > 0, value(terrain) + h).otherwise(value(terrain))


def highest(*surfaces: Column) -> Column:
    """The largest of several surfaces; missing ones are skipped."""
    return F.greatest(*(value(s) for s in surfaces))


def imperviousness(code: Column) -> Column:
    """PRJ-09: 0 and 5, 15 .. 95 stand for themselves, 255 for nothing, every other code for 100."""
    c = code.cast("int")
    steps = (c >= 5) & (c <= 95) & (c % 10 == 5)
    return F.when(c == 255, F.lit(None)).when((c == 0) | steps, c).when(c.isNotNull(), F.lit(100)).cast("double")


def metres_of_decimetres(c: Column) -> Column:
    """PRJ-10: dm to m; no value is no vegetation, 0."""
    return F.coalesce(value(c) * 0.1, F.lit(0.0))


def risk(*parts: Column) -> Column:
    """PRJ-24: sum of fractions; missing and non-finite ones count 0."""
    total = F.lit(0.0)
    for p in parts:
        total = total + F.when(finite(p), value(p)).otherwise(F.lit(0.0))
    return total
