"""Pixel tables: co-registration, blocks, coverage, profiles (JN-11 .. JN-13, JN-18, JN-20, AG-01 .. AG-22, SRC-05, SRC-07, SRC-14)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latticeframe.functions import bits
from latticeframe.functions.contracts import LayerContract
from latticeframe.functions.labels import support_bin
from latticeframe.functions.lattice import parent, present
from latticeframe.functions.nulls import ratio, value

CELL = ["row", "col"]


def window(df: DataFrame, row0: int, col0: int, rows: int, cols: int) -> DataFrame:
    """SRC-05: the cells of a window with addresses counted from its corner; bounds reach the scan as filters."""
    inside = F.col("row").between(row0, row0 + rows - 1) & F.col("col").between(col0, col0 + cols - 1)
    return df.filter(inside).withColumns({"row": F.col("row") - row0, "col": F.col("col") - col0})


def sampled_range(df: DataFrame, column: str, step: int = 32) -> DataFrame:
    """SRC-07: least and largest value over every `step`-th row and column, and over all cells."""
    v, on = value(column), (F.col("row") % step == 0) & (F.col("col") % step == 0)
    return df.agg(
        F.min(F.when(on, v)).alias("sample_min"), F.max(F.when(on, v)).alias("sample_max"), F.min(v).alias("min"), F.max(v).alias("max")
    )


def mosaic(items: DataFrame, keys: list[str], order: str, bands: list[str]) -> DataFrame:
    """SRC-14: overlapping items of a day fused per pixel; the last item with a value wins, band by band."""
    return items.groupBy(*keys).agg(*(F.max_by(value(b), F.when(value(b).isNotNull(), F.col(order))).alias(b) for b in bands))


def co_register(layers: list[DataFrame], keys: list[str]) -> DataFrame:
    """JN-11: layers of one lattice side by side. All joins are on the same keys, so each layer is shuffled once."""
    return reduce(lambda a, b: a.join(b, keys), layers)


def inside_area(df: DataFrame, area: DataFrame) -> DataFrame:
    """JN-12: `df` plus `inside`; cells that the area table doesn't name are outside."""
    a = area.select(*CELL, (F.col("inside") == 1).alias("__in"))
    return df.join(a, CELL, "left").withColumn("inside", F.coalesce("__in", F.lit(False))).drop("__in")


def with_static_validity(scenes: DataFrame, static: DataFrame, contracts: list[LayerContract], profile: str = "geometry_id") -> DataFrame:
    """JN-20: pixels of many scenes with the validity of their geometry's static layers, derived once per geometry."""
    from latticeframe.functions.contracts import all_valid

    mask = static.select(profile, *CELL, all_valid(contracts).alias("static_valid"))
    return scenes.join(mask, [profile, *CELL], "left").withColumn("static_valid", F.coalesce("static_valid", F.lit(False)))


def area_metrics(df: DataFrame, keys: list[str], flag: str = "flag", inside: Column | None = None) -> DataFrame:
    """AG-01: pixel counts per flag, clear, fill and total without fill, and the clear fraction (NULL if no total)."""
    f = F.col(flag).cast("int")
    inside = F.lit(True) if inside is None else F.coalesce(inside, F.lit(False))
    counts = [F.count_if(inside & bits.has(f, mask)).alias(f"{name}_px") for name, mask in bits.FLAGS.items()]
    told = df.groupBy(*keys).agg(
        *counts,
        F.count_if(inside & (f == 0)).alias("clear_px"),
        F.count_if(inside & ~bits.has(f, bits.FILL)).alias("total_px"),
        F.count_if(inside).alias("overlap_px"),
    )
    return told.withColumn("clear_frac", ratio(F.col("clear_px"), F.col("total_px")))


def clear_fraction(df: DataFrame, keys: list[str], clear: Column, inside: Column) -> DataFrame:
    """AG-02."""
    told = df.groupBy(*keys).agg(F.count_if(clear & inside).alias("clear_px"), F.count_if(inside).alias("total_px"))
    return told.withColumn("clear_frac", ratio(F.col("clear_px"), F.col("total_px")))


def block_support(df: DataFrame, keys: list[str], valid: Column, factor: int, rows: int, cols: int) -> DataFrame:
    """AG-08, AG-09: valid and present children of every block; blocks at ragged edges have fewer."""
    r, c = parent(F.col("row"), factor).alias("brow"), parent(F.col("col"), factor).alias("bcol")
    told = df.groupBy(*keys, r, c).agg(F.count_if(F.coalesce(valid, F.lit(False))).alias("valid_px"))
    there = present(F.col("brow"), factor, rows) * present(F.col("bcol"), factor, cols)
    return told.withColumn("present_px", there.cast("long"))


def scene_support(blocks: DataFrame, keys: list[str], target: Column, factor: int = 10) -> DataFrame:
    """AG-10: coarse cells with a valid target, how many have all children, full support, and the mean support."""
    t, v, p = F.coalesce(target, F.lit(False)), F.col("valid_px"), F.col("present_px")
    return blocks.groupBy(*keys).agg(
        F.count_if(t).alias("target_valid_cells"),
        F.count_if(t & (v == factor * factor)).alias("all_children_cells"),
        F.count_if(t & (v == p)).alias("full_support_cells"),
        F.round(F.avg(F.when(t, v / p)), 6).alias("support_mean_frac"),
    )


def support_histogram(blocks: DataFrame, keys: list[str], target: Column) -> DataFrame:
    """AG-11: cells per bin of the support fraction as a sorted map; empty bins are left out."""
    label = support_bin(ratio(F.col("valid_px"), F.col("present_px")))
    bins = blocks.filter(target).groupBy(*keys, label.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return as_map(bins, keys, "bin", "n", "histogram")


def as_map(rows: DataFrame, keys: list[str], label: str, n: str, name: str) -> DataFrame:
    """Counts per label to one map per key, labels in order. The labels of a key are few by declaration."""
    return rows.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(label, n)))).alias(name))


def invalid_layers(df: DataFrame, keys: list[str], contracts: list[LayerContract]) -> DataFrame:
    """AG-12: invalid pixels per layer, and their share of the pixels of the scenes that were scanned."""
    sums = df.agg(
        F.count(F.lit(1)).alias("px"),
        F.count_distinct(*keys).alias("scenes"),
        *(F.count_if(~c.valid()).alias(c.name) for c in contracts),
    )
    parts = F.array(*(F.struct(F.lit(c.name).alias("layer"), F.col(c.name).alias("invalid_px")) for c in contracts))
    return sums.select("px", "scenes", F.explode(parts).alias("p")).select(
        "p.layer", "p.invalid_px", ratio(F.col("p.invalid_px"), F.col("px")).alias("invalid_frac"), "scenes"
    )


def with_totals(df: DataFrame, key: str, measures: list[Column]) -> DataFrame:
    """AG-13: one row per `key` and one for all, where the key is NULL and `is_total` true."""
    return df.rollup(key).agg(*measures, (F.grouping(key) == 1).alias("is_total"))


def profile(df: DataFrame, keys: list[str], contracts: list[LayerContract], where: Column | None = None) -> DataFrame:
    """AG-14: per (key, channel) count, min, max, mean and population deviation.

    All channels are measured in one pass without unpivoting pixels, then become one row each; a channel without
    values has NULL statistics, and its row is there.
    """
    where = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    aggs: list[Column] = []
    for k, c in enumerate(contracts):
        v = F.when(where, value(c.name))
        for name, f in (("n", F.count), ("lo", F.min), ("hi", F.max), ("mean", F.avg), ("std", F.stddev_pop)):
            aggs.append(f(v).alias(f"{name}{k}"))
    wide = df.groupBy(*keys).agg(*aggs)
    rows = [
        F.struct(
            F.lit(k).alias("channel_index"),
            F.lit(c.name).alias("channel_name"),
            F.col(f"n{k}").alias("valid_px"),
            *(F.round(F.col(f"{s}{k}"), 6).alias(a) for s, a in (("lo", "min"), ("hi", "max"), ("mean", "mean"), ("std", "std"))),
        )
        for k, c in enumerate(contracts)
    ]
    return wide.select(*keys, F.explode(F.array(*rows)).alias("p")).select(*keys, "p.*")


def histograms(df: DataFrame, keys: list[str], contracts: list[LayerContract], bins: int = 20, where: Column | None = None) -> DataFrame:
    """AG-15: `channel_index, channel_name, bin, n` of equal-width bins over the declared range.

    Values outside fall into the end bins; empty bins have no row. A pixel becomes one small row per channel, which
    partial sums fold before anything is shuffled.
    """
    where = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    at = F.array(*(bin_number(value(c.name), c.lo, c.hi, bins) for c in contracts))
    rows = df.filter(where).select(*keys, F.posexplode(at).alias("channel_index", "__bin")).filter("__bin is not null")
    names = F.array(*(F.lit(c.name) for c in contracts))
    label = F.lpad(F.col("__bin").cast("string"), 3, "0").alias("bin")
    counts = rows.groupBy(*keys, "channel_index", "__bin").agg(F.count(F.lit(1)).alias("n"))
    return counts.select(*keys, "channel_index", F.get(names, F.col("channel_index")).alias("channel_name"), label, "n")


def profile_with_histogram(df: DataFrame, keys: list[str], contracts: list[LayerContract], bins: int = 20, where: Column | None = None) -> DataFrame:
    """Both in one row per (key, channel); the histogram of a channel without values is empty."""
    maps = as_map(histograms(df, keys, contracts, bins, where), [*keys, "channel_index"], "bin", "n", "histogram")
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<bigint>"))
    out = profile(df, keys, contracts, where).join(maps, [*keys, "channel_index"], "left")
    return out.withColumn("histogram", F.coalesce("histogram", empty))


def bin_number(v: Column, lo: float, hi: float, bins: int) -> Column:
    """0-based equal-width bin with values beyond the range in the end bins; NULL for no value."""
    at = F.floor((v - lo) / (hi - lo) * bins)
    # greatest and least would skip a NULL
    return F.when(v.isNotNull(), F.greatest(F.least(at, F.lit(bins - 1)), F.lit(0)).cast("int"))


def downsample(df: DataFrame, keys: list[str], factor: int, column: str, how: str = "avg") -> DataFrame:
    """AG-17: average or maximum of the children that have a value."""
    v = value(column)
    agg = F.avg(v) if how == "avg" else F.max(v)
    return df.groupBy(*keys, parent(F.col("row"), factor).alias("row"), parent(F.col("col"), factor).alias("col")).agg(agg.alias(column))


def all_pool(df: DataFrame, keys: list[str], factor: int, clear: Column) -> DataFrame:
    """AG-18: a coarse cell is clear if all its children are; edge cells judge the children that they have."""
    r, c = parent(F.col("row"), factor).alias("row"), parent(F.col("col"), factor).alias("col")
    return df.groupBy(*keys, r, c).agg(F.bool_and(F.coalesce(clear, F.lit(False))).alias("clear"))


def mask_comparison(published: DataFrame, native: DataFrame, keys: list[str]) -> DataFrame:
    """JN-18: published clear (pooled) against the native one: missed clouds and extra shadow."""
    both = published.select(*keys, *CELL, F.col("clear").alias("p")).join(native.select(*keys, *CELL, F.col("clear").alias("n")), [*keys, *CELL])
    return both.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("cells"), F.count_if(F.col("p") & ~F.col("n")).alias("missed"), F.count_if(~F.col("p") & F.col("n")).alias("extra")
    )


def product_stats(df: DataFrame, column: str) -> DataFrame:
    """AG-20."""
    v = value(column)
    return df.agg(
        F.round(F.avg(v.isNotNull().cast("double")), 4).alias("valid_frac"), F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean")
    )


def coverage(scenes: DataFrame, valid: str, inside: str, sparse_below: float = 0.01) -> DataFrame:
    """AG-22: totals, share and the number of scenes with sparse support; a scene without area has share 0."""
    share = F.coalesce(ratio(F.col(valid), F.col(inside)), F.lit(0.0))
    return scenes.agg(
        F.count(F.lit(1)).alias("scenes"),
        F.sum(valid).alias("valid_px"),
        F.sum(inside).alias("inside_px"),
        F.round(F.coalesce(ratio(F.sum(valid), F.sum(inside)), F.lit(0.0)), 6).alias("valid_frac"),
        F.count_if(share < sparse_below).alias("sparse_scenes"),
    )


def mask_mismatches(df: DataFrame, keys: list[str], contracts: list[LayerContract], mask: str = "feature_valid", inside: Column | None = None) -> DataFrame:
    """AG-27: counts of mask values that aren't 0 or 1, of masks that contradict the channels, of valid cells outside."""
    from latticeframe.functions.contracts import all_valid
    from latticeframe.functions.nulls import finite

    m, ok = F.col(mask), all_valid(contracts)
    some = reduce(lambda a, b: a | b, (finite(c.name) for c in contracts))
    outside = F.lit(False) if inside is None else ~F.coalesce(inside, F.lit(False))
    return df.groupBy(*keys).agg(
        F.count_if(~F.coalesce(m.isin(0, 1), F.lit(False))).alias("bad_mask_px"),
        F.count_if((m == 1) & ~ok).alias("valid_but_missing_px"),
        F.count_if((m == 0) & some).alias("finite_under_mask_px"),
        F.count_if((m == 1) & outside).alias("valid_outside_px"),
    )
