"""Weather expressions (PRJ-19, PRJ-29)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KELVIN = 273.15


def saturation_pressure(kelvin: Column) -> Column:
    """Tetens, in kPa."""
    c = kelvin - KELVIN
    return 0.6108 * F.exp(17.27 * c / (c + 237.3))


def vapour_pressure_deficit(t2m: Column, d2m: Column) -> Column:
    vpd = saturation_pressure(t2m) - saturation_pressure(d2m)
    return F.when(vpd < 0, 0.0).otherwise(vpd)  # greatest would turn a NULL into 0


def wind_speed(u: Column, v: Column) -> Column:
    return F.hypot(u, v)


def nearest_hour(ts: Column) -> Column:
    """From minute 30 on the next hour."""
    return F.date_trunc("hour", ts + F.expr("INTERVAL 30 MINUTES"))
