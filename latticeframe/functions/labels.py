"""Labels and lookups (PRJ-11, PRJ-23, PRJ-27, AG-11, JN-06)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Edges and labels of the support histogram; bins are open to the right, 1.0 has its own.
SUPPORT_EDGES = (0.0, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0)
# Building vintages and the scene years that each serves, both ends included.
VINTAGE_YEARS = ((2017, 2017, 2020), (2021, 2021, 2021), (2022, 2022, 2023), (2024, 2024, 2026))


def platform(scene_id: Column) -> Column:
    prefix = F.substring(scene_id, 1, 4)
    return F.when(prefix == "LC08", "landsat-8").when(prefix == "LC09", "landsat-9").otherwise("unknown")


def season(month: Column) -> Column:
    """Thirds of the warm season: up to June, July, later."""
    return F.when(month <= 6, "early").when(month == 7, "peak").otherwise("late")


def cloudiness(cover: Column) -> Column:
    c = F.coalesce(cover, F.lit(0.0))
    return F.when(c < 10, "low").when(c < 30, "mid").otherwise("high")


def imperviousness_vintage(year: Column) -> Column:
    return F.when(year <= 2019, 2016).otherwise(2021)


def support_bin(fraction: Column) -> Column:
    """Label of a fraction's bin; NULL outside [0, 1]."""
    out = F.when(fraction == 1.0, F.lit("1.00"))
    for lo, hi in zip(SUPPORT_EDGES[:-1], SUPPORT_EDGES[1:], strict=True):
        out = out.when((fraction >= lo) & (fraction < hi), F.lit(f"{lo:.2f}-{hi:.2f}"))
    return out


def geometry_id(vintage: Column) -> Column:
    return F.concat(F.lit("dgm1-2021__lod2-"), vintage.cast("string"), F.lit("__vh-2020"))
