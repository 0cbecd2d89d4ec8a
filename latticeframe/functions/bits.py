"""Quality bits: raw masks of three sensors to one flag byte (PRJ-01 .. PRJ-06, PRJ-26)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from latticeframe.functions.nulls import value

# Bits of the flag byte; 6 and 7 are reserved.
FILL, CLOUDY, SHADOW, CIRRUS, SATURATED, SNOW_ICE = 1, 2, 4, 8, 16, 32
FLAGS = {"fill": FILL, "cloudy": CLOUDY, "shadow": SHADOW, "cirrus": CIRRUS, "saturated": SATURATED, "snow_ice": SNOW_ICE}
# Scene classes that aren't clear.
UNCLEAR_CLASSES = (0, 1, 3, 8, 9, 10, 11)
# Scale and offset of the thermal band, and the reflectance scale.
THERMAL_SCALE, THERMAL_OFFSET = 0.00341802, 149.0
REFLECTANCE_SCALE = 10000.0


def bit(c: Column, n: int, width: int = 1) -> Column:
    return F.shiftright(c.cast("int"), n).bitwiseAND((1 << width) - 1)


def has(flag: Column, mask: int) -> Column:
    return flag.cast("int").bitwiseAND(mask) != 0


def all_of(*marks: tuple[Column, int]) -> Column:
    """The flags whose conditions hold, in one byte; a NULL condition sets nothing."""
    out = F.lit(0)
    for condition, mask in marks:
        out = out.bitwiseOR(F.when(condition, F.lit(mask)).otherwise(F.lit(0)))
    return out


def thermal_cloudy(qa: Column) -> Column:
    """The raw cloud bit counts from medium confidence on."""
    return (bit(qa, 3) != 0) & (bit(qa, 8, 2) >= 2)


def thermal_clear(qa: Column) -> Column:
    """PRJ-01: none of fill, cirrus, cloud of medium confidence, cloud shadow."""
    return ~((bit(qa, 0) != 0) | thermal_cloudy(qa) | (bit(qa, 4) != 0) | (bit(qa, 2) != 0))


def thermal_flag(qa: Column, dn: Column, buffer: Column) -> Column:
    """PRJ-02: raw 0 and the dilated cloud buffer are fill."""
    dn = value(dn)
    return all_of(
        ((bit(qa, 0) != 0) | (F.coalesce(dn, F.lit(0.0)) == 0) | buffer, FILL),
        (thermal_cloudy(qa), CLOUDY),
        (bit(qa, 4) != 0, SHADOW),
        (bit(qa, 2) != 0, CIRRUS),
        (bit(qa, 5) != 0, SNOW_ICE),
    )


def kelvin(dn: Column, flag: Column) -> Column:
    """Surface temperature; NULL on fill."""
    return F.when(~has(flag, FILL), value(dn) * THERMAL_SCALE + THERMAL_OFFSET)


def whole_class(c: Column) -> Column:
    """PRJ-25: NaN is class 0; halves round to even."""
    return F.bround(F.coalesce(value(c), F.lit(0.0))).cast("int")


def class_clear(scl: Column) -> Column:
    """PRJ-06."""
    return ~scl.isin(*UNCLEAR_CLASSES)


def class_flag(scl: Column, projected_shadow: Column | None = None) -> Column:
    """PRJ-03: scene classes to flags, with the projected cloud shadow on top."""
    shadow = scl == 3
    if projected_shadow is not None:
        shadow = shadow | F.coalesce(projected_shadow, F.lit(False))
    return all_of(
        (scl == 0, FILL), (scl.isin(8, 9), CLOUDY), (shadow, SHADOW), (scl == 10, CIRRUS), (scl == 1, SATURATED), (scl == 11, SNOW_ICE)
    )


def reflectance(dn: Column, flag: Column, any_flag: bool) -> Column:
    """PRJ-04: DN / 10000 clipped to [0, 1]; NULL on fill, or on any flag before upsampling."""
    good = flag == 0 if any_flag else ~has(flag, FILL)
    v = value(dn) / REFLECTANCE_SCALE
    return F.when(good & v.isNotNull(), F.least(F.greatest(v, F.lit(0.0)), F.lit(1.0)))


def granule_flag(cloud: Column, water: Column, qc: Column, lst: Column) -> Column:
    """PRJ-05: four layers to flags; afterwards a value is missing exactly where fill is set."""
    low = qc.cast("int").bitwiseAND(3)
    fill = (cloud == 255) | water.isin(1, 255) | (low == 3) | value(lst).isNull()
    return all_of((fill, FILL), ((cloud == 1) | (low == 1), CLOUDY))


def residual_hint(qa: Column) -> Column:
    """PRJ-26: clear by the canonical rule, yet the raw cloud or the dilated bit is set."""
    return thermal_clear(qa) & ((bit(qa, 3) != 0) | (bit(qa, 1) != 0))


def fractions(flag: Column) -> list[Column]:
    """AG-19: share of pixels with each bit."""
    return [F.avg(has(flag, mask).cast("double")).alias(f"{name}_frac") for name, mask in FLAGS.items()]
