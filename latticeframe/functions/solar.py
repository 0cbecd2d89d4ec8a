"""Position of the sun from UTC time and place, as column expressions (PRJ-20)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Series of the public NOAA solar calculator (cosine and sine terms by order).
EQUATION_OF_TIME = (229.18, 0.000075, ((0.001868, -0.032077), (-0.014615, -0.04089)))
DECLINATION = (1.0, 0.006918, ((-0.399912, 0.070257), (-0.006758, 0.000907), (-0.002697, 0.00148)))


def _series(terms, gamma: Column) -> Column:
    scale, total, waves = terms[0], F.lit(terms[1]), terms[2]
    for k, (c, s) in enumerate(waves, 1):
        total = total + c * F.cos(gamma * k) + s * F.sin(gamma * k)
    return total * scale


def solar_position(ts: Column, lat: Column | float, lon: Column | float) -> tuple[Column, Column]:
    """(azimuth clockwise from north, elevation) in degrees; mirrored after solar noon."""
    lat, lon = (x if isinstance(x, Column) else F.lit(float(x)) for x in (lat, lon))
    hour = F.hour(ts)
    gamma = (2 * math.pi / 365) * (F.dayofyear(ts) - 1 + (hour - 12) / F.lit(24.0))
    decl = _series(DECLINATION, gamma)
    minutes = hour * 60 + F.minute(ts) + F.second(ts) / F.lit(60.0) + _series(EQUATION_OF_TIME, gamma) + 4 * lon
    angle = minutes / 4 - 180
    phi, ha = F.radians(lat), F.radians(angle)
    unit = lambda c: F.greatest(F.lit(-1.0), F.least(F.lit(1.0), c))
    elevation = F.asin(unit(F.sin(phi) * F.sin(decl) + F.cos(phi) * F.cos(decl) * F.cos(ha)))
    az = F.degrees(F.acos(unit((F.sin(decl) * F.cos(phi) - F.cos(decl) * F.sin(phi) * F.cos(ha)) / F.cos(elevation))))
    return F.when(angle > 0, 360 - az).otherwise(az), F.degrees(elevation)
