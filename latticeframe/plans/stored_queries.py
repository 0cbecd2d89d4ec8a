"""Queries over tables that are stored for later jobs: bucketed layers, pixel files in Morton order, profile states."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from latticeframe.functions.contracts import LayerContract
from latticeframe.functions.nulls import value
from latticeframe.operators import grids, profile_states
from latticeframe.plans import views as v
from latticeframe.plans.grid_queries import _LONG, _STACK, STACK, _stack
from latticeframe.plans.registry import query
from latticeframe.sources import layers, sinks
from latticeframe.sources.work import kept, work_folder

PIXEL = ["scene_id", "row", "col"]


@query(f"WITH {v.PIXELS} SELECT scene_id, row, col, round(b04, 9) AS b04, round(b08, 9) AS b08, flag, round(height, 6) AS height FROM px")
def stored_layer_stack(spark: SparkSession, d: str) -> DataFrame:
    """JN-11, JN-20: three layers stored in buckets of the pixel, side by side without a shuffle."""
    px, folder = v.pixels(spark, d), work_folder(spark, "layers")
    stored = [
        layers.store_layer(px.select(*PIXEL, *names), f"layer_{names[0]}_{uuid.uuid4().hex}", f"{folder}/{names[0]}", PIXEL, 8)
        for names in (["b04", "b08"], ["flag"], ["height"])
    ]
    out = grids.co_register(stored, PIXEL)
    return out.select(*PIXEL, F.round(value("b04"), 9).alias("b04"), F.round("b08", 9).alias("b08"), "flag", F.round("height", 6).alias("height"))


@query(f"WITH {v.PIXELS} SELECT CAST(scene_id AS INT) AS scene_id, row - 4 AS row, col - 30 AS col, b08 FROM px WHERE row BETWEEN 4 AND 23 AND col BETWEEN 30 AND 69")
def morton_window(spark: SparkSession, d: str) -> DataFrame:
    """SNK-06, SRC-05: pixel files in Morton order, and a window of them."""
    path = work_folder(spark, "pixels")
    sinks.write_pixels(v.pixels(spark, d), [LayerContract("b08", 0, 1, dtype="double")], path, 64)
    return grids.window(spark.read.parquet(path), 4, 30, 20, 40).select(F.col("scene_id").cast("int").alias("scene_id"), "row", "col", "b08")


_BIN = "lpad(CAST(greatest(least(CAST(floor((x + 0.5) / 1e0 * 20) AS INT), 19), 0) AS VARCHAR), 3, '0')"
_SETS = "GROUPING SETS ((scene_id, channel_index, channel_name), (channel_index, channel_name))"


@query(f"""WITH {_STACK}, {_LONG}, p AS (SELECT scene_id, channel_index, channel_name, grouping(scene_id) = 1 AS is_total, count(x) AS valid_px, round(min(x), 6) AS min, round(max(x), 6) AS max, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std FROM long GROUP BY {_SETS}),
k AS (SELECT scene_id, channel_index, channel_name, {_BIN} AS k, count(*) AS n FROM long WHERE x IS NOT NULL GROUP BY ALL),
s AS (SELECT scene_id, channel_index, channel_name, k, sum(n) AS n, grouping(scene_id) = 1 AS is_total FROM k GROUP BY GROUPING SETS ((scene_id, channel_index, channel_name, k), (channel_index, channel_name, k))),
h AS (SELECT scene_id, channel_index, is_total, string_agg(k || '=' || CAST(n AS BIGINT), ',' ORDER BY k) AS histogram FROM s GROUP BY ALL)
SELECT p.*, h.histogram FROM p JOIN h ON p.scene_id IS NOT DISTINCT FROM h.scene_id AND p.is_total = h.is_total AND p.channel_index = h.channel_index""")
def profile_totals(spark: SparkSession, d: str) -> DataFrame:
    """AG-13 .. AG-15: profiles of all scenes and their total from stored states, the odd scenes added to the even ones."""
    folder, stack = work_folder(spark, "profiles"), _stack(spark, d)
    scenes = kept(stack.select("scene_id").distinct().withColumn("version", F.lit(1)), "scenes")
    profile_states.refresh(stack, scenes.filter("scene_id % 2 = 0"), folder, STACK)
    profile_states.refresh(stack, scenes, folder, STACK)
    out = profile_states.with_totals(profile_states.held(spark, folder), "scene_id")
    text = F.transform(F.map_entries("histogram"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return out.withColumn("histogram", F.array_join(text, ","))
