"""Layer contracts: declared order, types, ranges and nodata rules as data (VAL-16, VAL-17, PRJ-07, PRJ-08, PRJ-22)."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latticeframe.functions.nulls import layer, value


@dataclass(frozen=True)
class LayerContract:
    name: str
    lo: float
    hi: float
    unit: str = ""
    dtype: str = "float"
    family: str = ""
    codes: tuple[int, ...] = ()  # where given, the only values allowed

    def valid(self, c: Column | None = None) -> Column:
        """Finite and within the range; never NULL."""
        v = value(self.name if c is None else c)
        ok = v.isin(*map(float, self.codes)) if self.codes else v.between(self.lo, self.hi)
        return F.coalesce(ok, F.lit(False))


def _several(names: str, lo: float, hi: float, unit: str, family: str, **more) -> list[LayerContract]:
    return [LayerContract(n, lo, hi, unit, family=family, **more) for n in names.split()]


# The 24 channels in order, with their valid ranges.
CHANNELS: tuple[LayerContract, ...] = (
    *_several("B02 B03 B04 B08 B11 B12", 0, 1, "1", "reflectance"),
    *_several("ndvi ndwi_mcfeeters ndbi", -1, 1, "1", "index"),
    *_several("s2_broadband_albedo", 0, 1, "1", "index"),
    *_several("building_dsm vegetation_dsm combined_dsm", -10, 600, "m", "morphology"),
    *_several("svf", -0.01, 1.01, "1", "morphology"),
    *_several("t2m_scene", 200, 350, "K", "weather"),
    *_several("ssrd_scene ssrd_antecedent_72h_mean", -1, 1500, "W m-2", "weather"),
    *_several("vpd_scene", 0, 10, "kPa", "weather"),
    *_several("wind_speed_10m_scene", 0, 50, "m s-1", "weather"),
    *_several("tp_0_24h tp_24_48h tp_48_72h", 0, 500, "mm", "weather"),
    *_several("shadow_building shadow_vegetation", 0, 1, "1", "shadow", codes=(0, 1)),
)
TEMPERATURE = LayerContract("lst", 150, 400, "K")


def all_valid(contracts) -> Column:
    return reduce(lambda a, b: a & b, (c.valid() for c in contracts))


def shadow_value(c: Column) -> Column:
    """PRJ-08: 255 is no value."""
    return F.when(c != 255, c.cast("double"))


def enforce(df: DataFrame, contracts, keys: list[str]) -> DataFrame:
    """VAL-17: declared columns in declared order and type; a missing one raises."""
    missing = [c.name for c in contracts if c.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing: {missing}")
    return df.select(*keys, *(F.col(c.name).cast(c.dtype).alias(c.name) for c in contracts))


def masked_stack(df: DataFrame, contracts, keys: list[str], extra: Column | None = None) -> DataFrame:
    """PRJ-22: channels in registry order, all NaN where the pixel isn't valid, and the mask."""
    ok = all_valid(contracts) if extra is None else all_valid(contracts) & extra
    df = df.withColumn("feature_valid", ok)
    stack = [layer(F.when(F.col("feature_valid"), value(c.name))).cast(c.dtype).alias(c.name) for c in contracts]
    return df.select(*keys, *stack, F.col("feature_valid").cast("smallint").alias("feature_valid"))


def roster_findings(present: DataFrame, contracts) -> DataFrame:
    """VAL-16: `scene_id, layer, problem` for missing and extra layers of every scene in `present` (scene_id, layer)."""
    spark = present.sparkSession
    names = spark.createDataFrame([(c.name,) for c in contracts], "layer string")
    scenes = present.select("scene_id").distinct()
    # The roster is a handful of rows, so this product is bounded by it.
    wanted = scenes.join(F.broadcast(names))
    missing = wanted.join(present, ["scene_id", "layer"], "left_anti").withColumn("problem", F.lit("missing"))
    extra = present.join(F.broadcast(names), "layer", "left_anti").select("scene_id", "layer").withColumn("problem", F.lit("extra"))
    return missing.unionByName(extra)
