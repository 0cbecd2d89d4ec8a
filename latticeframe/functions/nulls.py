"""NaN at rest, NULL inside operators: Spark orders NaN above every number and lets it poison aggregates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def value(c: str | Column) -> Column:
    """NaN and NULL become NULL (PRJ-28)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def layer(c: Column) -> Column:
    """NULL becomes NaN again, as layers hold it."""
    return F.coalesce(c, F.lit(float("nan")))


def finite(c: str | Column) -> Column:
    """Neither NULL nor NaN nor infinite; never NULL itself."""
    v = value(c)
    return F.coalesce(F.abs(v) < float("inf"), F.lit(False))


def nansum(c: Column) -> Column:
    """Sum over values; 0, not NULL, where there are none."""
    return F.coalesce(F.sum(value(c)), F.lit(0.0))


def ratio(a: Column, b: Column) -> Column:
    """a / b, NULL where b is 0."""
    return F.try_divide(a.cast("double"), b.cast("double"))
