"""Queries on pixel grids and shapes."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from latticeframe.functions import bits, lattice, solar, spectral
from latticeframe.functions.contracts import LayerContract, all_valid, masked_stack
from latticeframe.functions.nulls import value
from latticeframe.operators import checks, grids, neighbourhood, shapes, terrain
from latticeframe.plans import views as v
from latticeframe.plans.registry import query

BANDS = [LayerContract("b04", 0, 0.5), LayerContract("b08", 0.1, 1)]
_VALID = "(b04 IS NOT NULL AND b04 BETWEEN 0 AND 0.5 AND b08 BETWEEN 0.1 AND 1)"
_FLAGS = ", ".join(f"count(*) FILTER (flag & {m} <> 0) AS {n}_px" for n, m in bits.FLAGS.items())


@query(f"""WITH {v.PIXELS} SELECT scene_id, {_FLAGS}, count(*) FILTER (flag = 0) AS clear_px, count(*) FILTER (flag & 1 = 0) AS total_px, count(*) AS overlap_px,
  round(count(*) FILTER (flag = 0) / CAST(count(*) FILTER (flag & 1 = 0) AS DOUBLE), 6) AS clear_frac FROM px GROUP BY 1""")
def flag_area_metrics(spark: SparkSession, d: str) -> DataFrame:
    """AG-01."""
    return grids.area_metrics(v.pixels(spark, d), ["scene_id"]).withColumn("clear_frac", F.round("clear_frac", 6))


@query(f"""WITH {v.PIXELS}, c AS (SELECT scene_id, qa & 1 = 0 AND qa & 4 = 0 AND qa & 16 = 0 AND NOT (qa & 8 <> 0 AND (qa >> 8) & 3 >= 2) AS a, scl NOT IN (0, 1, 3, 8, 9, 10, 11) AS b FROM px)
SELECT scene_id, count(*) FILTER (a) AS first_clear_px, count(*) FILTER (b) AS second_clear_px, count(*) FILTER (a AND b) AS joint_clear_px, count(*) AS total_px,
  round(count(*) FILTER (a AND b) / CAST(count(*) FILTER (a) AS DOUBLE), 6) AS joint_clear_frac FROM c GROUP BY 1""")
def joint_clear_frac(spark: SparkSession, d: str) -> DataFrame:
    """AG-03, PRJ-01, PRJ-06."""
    from latticeframe.operators.couple import joint_clear_fraction

    out = joint_clear_fraction(v.pixels(spark, d), ["scene_id"], bits.thermal_clear(F.col("qa")), bits.class_clear(F.col("scl")))
    return out.withColumn("joint_clear_frac", F.round("joint_clear_frac", 6))


@query(f"""WITH {v.PIXELS} SELECT scene_id, row, col, CASE WHEN scl = 0 THEN 1 WHEN scl IN (8, 9) THEN 2 WHEN scl = 3 THEN 4 WHEN scl = 10 THEN 8 WHEN scl = 1 THEN 16 WHEN scl = 11 THEN 32 ELSE 0 END AS class_flag,
  (CASE WHEN qa & 1 <> 0 OR custkey % 50 = 0 THEN 1 ELSE 0 END) | (CASE WHEN qa & 8 <> 0 AND (qa >> 8) & 3 >= 2 THEN 2 ELSE 0 END) | (CASE WHEN qa & 16 <> 0 THEN 4 ELSE 0 END)
  | (CASE WHEN qa & 4 <> 0 THEN 8 ELSE 0 END) | (CASE WHEN qa & 32 <> 0 THEN 32 ELSE 0 END) AS thermal_flag,
  CASE WHEN qa & 1 = 0 AND custkey % 50 <> 0 THEN round((custkey % 50) * 341802e-8 * 1000 + 149, 6) END AS kelvin FROM px""")
def sensor_flags(spark: SparkSession, d: str) -> DataFrame:
    """PRJ-02, PRJ-03."""
    px = v.pixels(spark, d).withColumn("dn", (F.col("custkey") % 50 * 1000).cast("double"))
    px = px.withColumn("thermal_flag", bits.thermal_flag(F.col("qa"), F.col("dn"), F.lit(False)))
    kelvin = F.round(bits.kelvin(F.col("dn"), F.col("thermal_flag")), 6)
    return px.select("scene_id", "row", "col", bits.class_flag(F.col("scl")).alias("class_flag"), "thermal_flag", kelvin.alias("kelvin"))


@query(f"""WITH {v.PIXELS} SELECT row, col, round((b08 - b04) / nullif(b08 + b04, 0), 6) AS ndvi, round(b04 * 0.1573 + b08 * 0.3417, 6) AS albedo,
  CASE WHEN flag & 1 = 0 THEN round(least(greatest(custkey / 10000e0, 0), 1), 6) END AS reflectance FROM px""")
def spectral_indices(spark: SparkSession, d: str) -> DataFrame:
    """PRJ-04, PRJ-16, PRJ-17."""
    px = v.pixels(spark, d)
    return px.select(
        "row", "col", F.round(spectral.normalised_difference("b08", "b04"), 6).alias("ndvi"), F.round(spectral.weighted_sum({"b04": 0.1573, "b08": 0.3417}), 6).alias("albedo"),
        F.round(bits.reflectance(F.col("custkey"), F.col("flag"), False), 6).alias("reflectance"),
    )


@query(f"""WITH {v.PIXELS} SELECT scene_id, row, col, CAST(({_VALID} AND flag = 0) AS SMALLINT) AS feature_valid,
  CASE WHEN {_VALID} AND flag = 0 THEN b04 END AS b04, CASE WHEN {_VALID} AND flag = 0 THEN b08 END AS b08 FROM px""")
def feature_validity(spark: SparkSession, d: str) -> DataFrame:
    """PRJ-07, PRJ-22."""
    doubles = [LayerContract(c.name, c.lo, c.hi, dtype="double") for c in BANDS]
    out = masked_stack(v.pixels(spark, d), doubles, ["scene_id", "row", "col"], F.col("flag") == 0)
    return out.select("scene_id", "row", "col", "feature_valid", *(value(c.name).alias(c.name) for c in BANDS))


def _blocks_sql(extra: str = "") -> str:
    return f"""WITH {v.PIXELS}, size AS (SELECT max(row) + 1 AS h FROM px), blocks AS (SELECT CAST(row // 10 AS INT) AS brow, CAST(col // 10 AS INT) AS bcol,
      count(*) FILTER ({_VALID}) AS valid_px, min(height) AS height, least(10, any_value(h) - 10 * (row // 10)) * least(10, {v.COLS} - 10 * (col // 10)) AS present_px
      FROM px, size GROUP BY row // 10, col // 10){extra} """


def _blocks(spark: SparkSession, d: str) -> DataFrame:
    px = v.pixels(spark, d)
    return grids.block_support(px, [], all_valid(BANDS), 10, v.rows_of(spark, d), v.COLS)


@query(_blocks_sql() + "SELECT brow, bcol, valid_px, CAST(present_px AS BIGINT) AS present_px FROM blocks")
def block_support(spark: SparkSession, d: str) -> DataFrame:
    """AG-08, AG-09."""
    return _blocks(spark, d)


def _targets(spark: SparkSession, d: str) -> DataFrame:
    """JN-13: blocks with a coarse layer joined on their parent cell."""
    px = v.pixels(spark, d)
    coarse = px.groupBy(lattice.parent(F.col("row"), 10).alias("brow"), lattice.parent(F.col("col"), 10).alias("bcol")).agg(F.min("height").alias("height"))
    return _blocks(spark, d).join(coarse, ["brow", "bcol"]).withColumns({"target": F.col("height") < 1.5, "all": F.lit(1)})


@query(_blocks_sql() + """SELECT count(*) FILTER (height < 1.5) AS target_valid_cells, count(*) FILTER (height < 1.5 AND valid_px = 100) AS all_children_cells,
  count(*) FILTER (height < 1.5 AND valid_px = present_px) AS full_support_cells, round(avg(valid_px / CAST(present_px AS DOUBLE)) FILTER (height < 1.5), 6) AS support_mean_frac FROM blocks""")
def scene_support(spark: SparkSession, d: str) -> DataFrame:
    """AG-10, JN-13."""
    return grids.scene_support(_targets(spark, d), ["all"], F.col("target")).drop("all")


@query(_blocks_sql(", f AS (SELECT valid_px / CAST(present_px AS DOUBLE) AS x FROM blocks)") + """SELECT string_agg(bin || '=' || n, ',' ORDER BY bin) AS histogram FROM (
  SELECT CASE WHEN x = 1 THEN '1.00' WHEN x < .25 THEN '0.00-0.25' WHEN x < .5 THEN '0.25-0.50' WHEN x < .75 THEN '0.50-0.75' WHEN x < .9 THEN '0.75-0.90' WHEN x < .99 THEN '0.90-0.99' ELSE '0.99-1.00' END AS bin, count(*) AS n FROM f GROUP BY 1)""")
def support_histogram(spark: SparkSession, d: str) -> DataFrame:
    """AG-11."""
    told = grids.support_histogram(_blocks(spark, d).withColumn("all", F.lit(1)), ["all"], F.lit(True))
    entries = F.transform(F.map_entries("histogram"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return told.select(F.array_join(entries, ",").alias("histogram"))


@query(f"""WITH {v.PIXELS}, n AS (SELECT count(*) AS px, count(DISTINCT scene_id) AS scenes, count(*) FILTER (NOT coalesce(b04 BETWEEN 0 AND 0.5, false)) AS a,
  count(*) FILTER (NOT coalesce(b08 BETWEEN 0.1 AND 1, false)) AS b FROM px)
SELECT 'b04' AS layer, a AS invalid_px, round(a / CAST(px AS DOUBLE), 6) AS invalid_frac, scenes FROM n UNION ALL SELECT 'b08', b, round(b / CAST(px AS DOUBLE), 6), scenes FROM n""")
def layer_invalid(spark: SparkSession, d: str) -> DataFrame:
    """AG-12."""
    return grids.invalid_layers(v.pixels(spark, d), ["scene_id"], BANDS).withColumn("invalid_frac", F.round("invalid_frac", 6))


@query(f"WITH {v.PIXELS} SELECT scene_id, count(*) AS n, count(*) FILTER ({_VALID}) AS valid_px, grouping(scene_id) = 1 AS is_total FROM px GROUP BY ROLLUP (scene_id)")
def scene_and_total(spark: SparkSession, d: str) -> DataFrame:
    """AG-13."""
    return grids.with_totals(v.pixels(spark, d), "scene_id", [F.count(F.lit(1)).alias("n"), F.count_if(all_valid(BANDS)).alias("valid_px")])


STACK = [LayerContract(f"c{i:02d}", -0.5, 0.5) for i in range(24)]
_STACK = f"stack AS (SELECT vec_id, label AS scene_id, {', '.join(f'CAST(embedding[{i + 1}] AS DOUBLE) AS c{i:02d}' for i in range(24))} FROM embeddings)"
_LONG = "long AS (" + " UNION ALL ".join(f"SELECT scene_id, {i} AS channel_index, 'c{i:02d}' AS channel_name, c{i:02d} AS x FROM stack" for i in range(24)) + ")"


def _stack(spark: SparkSession, d: str) -> DataFrame:
    e = v.table(spark, d, "embeddings")
    return e.select(F.col("label").alias("scene_id"), *(F.get("embedding", F.lit(i)).cast("double").alias(c.name) for i, c in enumerate(STACK)))


@query(f"""WITH {_STACK}, {_LONG} SELECT scene_id, channel_index, channel_name, count(x) AS valid_px, round(min(x), 6) AS min, round(max(x), 6) AS max, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std
FROM long GROUP BY 1, 2, 3""")
def channel_profile(spark: SparkSession, d: str) -> DataFrame:
    """AG-14."""
    return grids.profile(_stack(spark, d), ["scene_id"], STACK)


@query(f"""WITH {_STACK}, {_LONG}, b AS (SELECT scene_id, channel_name, greatest(least(CAST(floor((x + 0.5) / 1e0 * 20) AS INT), 19), 0) AS k FROM long)
SELECT scene_id, channel_name, lpad(CAST(k AS VARCHAR), 3, '0') AS bin, count(*) AS n FROM b GROUP BY ALL""")
def channel_histogram(spark: SparkSession, d: str) -> DataFrame:
    """AG-15."""
    return grids.histograms(_stack(spark, d), ["scene_id"], STACK).drop("channel_index")


@query(f"""WITH {v.PIXELS}, core AS (SELECT row, col FROM px WHERE flag & 2 <> 0), near AS (
  SELECT DISTINCT row + dr AS row, col + dc AS col FROM core, (SELECT unnest(range(-2, 3)) AS dr) a, (SELECT unnest(range(-2, 3)) AS dc) b)
SELECT row, col, near.row IS NOT NULL AND flag & 2 = 0 AS buffer FROM px LEFT JOIN near USING (row, col)""")
def dilate_mask(spark: SparkSession, d: str) -> DataFrame:
    """NB-01."""
    px = v.pixels(spark, d).select("row", "col", "flag")
    return neighbourhood.dilate(px, [], bits.has(F.col("flag"), bits.CLOUDY), 2).select("row", "col", "buffer")


@query(f"""WITH {v.PIXELS}, core AS (SELECT scene_id, row, col FROM px WHERE flag & 4 <> 0), wide AS (SELECT DISTINCT scene_id, row, c AS col FROM (SELECT *, unnest(range(col - 50, col + 51)) AS c FROM core)),
near AS (SELECT DISTINCT scene_id, r AS row, col FROM (SELECT *, unnest(range(row - 50, row + 51)) AS r FROM wide))
SELECT scene_id, row, col, near.row IS NOT NULL AND flag & 4 = 0 AS buffer FROM px LEFT JOIN near USING (scene_id, row, col)""")
def dilate_wide(spark: SparkSession, d: str) -> DataFrame:
    """NB-01 with a radius of 50 cells, by scene."""
    px = v.pixels(spark, d).select("scene_id", "row", "col", "flag")
    return neighbourhood.dilate(px, ["scene_id"], F.col("flag").bitwiseAND(4) != 0, 50).drop("flag")


@query(f"""WITH {v.PIXELS}, size AS (SELECT max(row) + 1 AS h FROM px), s AS (SELECT DISTINCT row + 3 AS row, col - 6 AS col FROM px WHERE flag & 2 <> 0)
SELECT CAST(row AS INT) AS row, CAST(col AS INT) AS col FROM s, size WHERE row BETWEEN 0 AND h - 1 AND col BETWEEN 0 AND {v.COLS - 1}""")
def shift_mask(spark: SparkSession, d: str) -> DataFrame:
    """NB-02: sun at azimuth 64, elevation 56, clouds at 100 m, cells of 10 m."""
    dr, dc = neighbourhood.shadow_shift(64.0, 56.0, 100.0, 10.0)
    px = v.pixels(spark, d).select("row", "col", "flag")
    return neighbourhood.shifted(px, [], bits.has(F.col("flag"), bits.CLOUDY), F.lit(dr), F.lit(dc), v.rows_of(spark, d), v.COLS)




@query(f"""WITH {v.PIXELS}, src AS (SELECT row, col, b04 * pi() AS b04 FROM px), size AS (SELECT max(row) + 1 AS h FROM px),
t AS (SELECT r.row * 2 + i AS row, c.col * 2 + j AS col FROM (SELECT DISTINCT row FROM px) r, (SELECT DISTINCT col FROM px) c, range(2) a(i), range(2) b(j)),
u AS (SELECT row, col, (row + 0.5e0) / 2 - 0.5e0 AS sr, (col + 0.5e0) / 2 - 0.5e0 AS sc FROM t),
w AS (SELECT u.row, u.col, floor(sr) + i AS srow, floor(sc) + j AS scol, (CASE WHEN i = 1 THEN sr - floor(sr) ELSE 1 - (sr - floor(sr)) END) * (CASE WHEN j = 1 THEN sc - floor(sc) ELSE 1 - (sc - floor(sc)) END) AS w
  FROM u, range(2) a(i), range(2) b(j))
SELECT CAST(w.row AS INT) AS row, CAST(w.col AS INT) AS col, round(sum(w * b04) / nullif(sum(CASE WHEN b04 IS NOT NULL THEN w END), 0), 6) AS b04
FROM w LEFT JOIN src ON src.row = srow AND src.col = scol GROUP BY 1, 2""")
def bilinear_up2(spark: SparkSession, d: str) -> DataFrame:
    """NB-03: the whole grid, twice finer."""
    # pi: no value stands on a rounding border, where engines that sum in another order could differ
    px = v.pixels(spark, d).select("row", "col", (F.col("b04") * math.pi).alias("b04"))
    half = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)))
    fine = px.select(F.explode(half).alias("h"), "row", "col").select((F.col("row") * 2 + F.col("h.i")).alias("row"), (F.col("col") * 2 + F.col("h.j")).alias("col"))
    return neighbourhood.upsample2(fine, px, [], ["b04"]).withColumn("b04", F.round("b04", 6))


@query(f"""WITH {v.PIXELS} SELECT CAST(row // 3 AS INT) AS row, CAST(col // 3 AS INT) AS col, round(avg(b04), 6) AS b04, round(max(height), 6) AS height FROM px GROUP BY 1, 2""")
def downsample_avg_max(spark: SparkSession, d: str) -> DataFrame:
    """AG-17."""
    px = v.pixels(spark, d)
    a, b = grids.downsample(px, [], 3, "b04"), grids.downsample(px, [], 3, "height", "max")
    return a.join(b, ["row", "col"]).select("row", "col", F.round("b04", 6).alias("b04"), F.round("height", 6).alias("height"))


@query(f"WITH {v.PIXELS} SELECT CAST(row // 2 AS INT) AS row, CAST(col // 2 AS INT) AS col, bool_and(flag = 0) AS clear FROM px GROUP BY 1, 2")
def all_pool_2x2(spark: SparkSession, d: str) -> DataFrame:
    """AG-18."""
    return grids.all_pool(v.pixels(spark, d), [], 2, F.col("flag") == 0)


@query(f"""WITH {v.PIXELS}, p AS (SELECT scene_id, row, col, flag = 0 AS p, scl NOT IN (0, 1, 3, 8, 9, 10, 11) AS n FROM px)
SELECT scene_id, count(*) AS cells, count(*) FILTER (p AND NOT n) AS missed, count(*) FILTER (NOT p AND n) AS extra FROM p GROUP BY 1""")
def mask_comparison(spark: SparkSession, d: str) -> DataFrame:
    """JN-18."""
    px = v.pixels(spark, d)
    key = ["scene_id", "row", "col"]
    published = px.select(*key, (F.col("flag") == 0).alias("clear"))
    return grids.mask_comparison(published, px.select(*key, bits.class_clear(F.col("scl")).alias("clear")), ["scene_id"])


@query(f"""WITH {v.PIXELS} SELECT row, col, height + b08 AS building, CASE WHEN b04 > 0.3 THEN height + b04 ELSE height END AS vegetation,
  greatest(height + b08, CASE WHEN b04 > 0.3 THEN height + b04 ELSE height END) AS combined FROM px""")
def surface_models(spark: SparkSession, d: str) -> DataFrame:
    """PRJ-18."""
    px = v.pixels(spark, d)
    b = spectral.surface(F.col("height"), F.col("b08"))
    g = spectral.surface(F.col("height"), F.when(F.col("b04") > 0.3, F.col("b04")))
    return px.select("row", "col", b.alias("building"), g.alias("vegetation"), spectral.highest(b, g).alias("combined"))


@query(f"""WITH {v.PIXELS}, h AS (SELECT row, col, custkey, (custkey * 10) % 360 + 0.25 AS az, list_transform(range(36), lambda i: CASE WHEN (custkey + i) % 97 = 0 THEN 65535 ELSE (custkey * (i + 3)) % 4500 END) AS hz FROM px),
b AS (SELECT *, CAST(floor(az / 10) AS INT) % 36 AS lo, az / 10 - floor(az / 10) AS f FROM h), c AS (SELECT *, hz[lo + 1] AS a, hz[(lo + 1) % 36 + 1] AS z FROM b)
SELECT row, col, CASE WHEN a = 65535 OR z = 65535 THEN 255 WHEN (a * (1 - f) + z * f) / 100 > 20 THEN 1 ELSE 0 END AS shadow FROM c""")
def shadow_from_horizon(spark: SparkSession, d: str) -> DataFrame:
    """PRJ-21."""
    k = F.col("custkey")
    px = v.pixels(spark, d).select("row", "col", "custkey")
    bands = F.transform(F.sequence(F.lit(0), F.lit(35)), lambda i: F.when((k + i) % 97 == 0, F.lit(65535)).otherwise((k * (i + 3)) % 4500))
    return px.withColumn("hz", bands).select("row", "col", terrain.shadow(F.col("hz"), (k * 10) % 360 + F.lit(0.25), F.lit(20.0)).alias("shadow"))


def _steps_sql(directions: int, radius: int) -> str:
    """The cells that each ray visits, as rows."""
    rows = [f"({k}, {r}, {dr}, {dc})" for k, way in enumerate(terrain._steps(directions, radius, "compass")) for dr, dc, r in way]
    return f"steps(k, r, dr, dc) AS (VALUES {', '.join(rows)})"


_ANGLES = """seen AS (SELECT a.row, a.col, s.k, degrees(atan2(b.height - a.height, s.r * 10e0)) AS angle FROM px a, steps s LEFT JOIN px b ON b.row = a.row + s.dr AND b.col = a.col + s.dc),
best AS (SELECT row, col, k, greatest(coalesce(max(angle), 0), 0) AS angle FROM seen GROUP BY 1, 2, 3)"""


@query(f"WITH {v.PIXELS}, {_steps_sql(36, 6)}, {_ANGLES} SELECT row, col, string_agg(CAST(CAST(round_even(angle * 100, 0) AS INT) AS VARCHAR), ',' ORDER BY k) AS horizon FROM best GROUP BY 1, 2")
def horizon_scan(spark: SparkSession, d: str) -> DataFrame:
    """NB-07: the horizon of every cell, its bands in one text; the tests hold it against a plain loop too."""
    px = v.pixels(spark, d).select("row", "col", "height")
    made = terrain.horizon(px, [], "height", 10.0, 60.0, tile=64)
    return made.select("row", "col", F.array_join(F.col("horizon").cast("array<string>"), ",").alias("horizon"))


@query(f"WITH {v.PIXELS}, {_steps_sql(16, 3)}, {_ANGLES} SELECT row, col, round(1 - avg(sin(radians(angle))), 6) AS svf FROM best GROUP BY 1, 2")
def sky_view(spark: SparkSession, d: str) -> DataFrame:
    """NB-08."""
    px = v.pixels(spark, d).select("row", "col", "height")
    return terrain.sky_view(px, [], "height", 10.0, tile=64).withColumn("svf", F.round("svf", 6))


_CELLS = f"""{v.SHAPES}, cells AS (SELECT shape_id, height, CAST(r AS INT) AS row, CAST(c AS INT) AS col, (side - 0.5e0) * (side - 0.5e0) AS area FROM
  (SELECT *, unnest(range(CAST(ceil(y0 - 0.5) AS BIGINT), CAST(ceil(y0 + side - 0.5 - 0.5) AS BIGINT))) AS r FROM shapes) s, LATERAL (SELECT unnest(range(CAST(ceil(x0 - 0.5) AS BIGINT), CAST(ceil(x0 + side - 0.5 - 0.5) AS BIGINT))) AS c) q)"""


def _cells(spark: SparkSession, d: str) -> DataFrame:
    s = v.shapes(spark, d)
    far = F.col("side") - 0.5
    return shapes.box_cells(s.withColumn("area", far * far), F.col("x0"), F.col("y0"), F.col("x0") + far, F.col("y0") + far)


# An L with a slanted side, and a hole in it; (x, y) from its corner, in units of its side
_OUTLINE = [(0.0, 0.0), (3.0, 0.3), (3.0, 1.1), (1.3, 1.2), (1.1, 3.0), (0.2, 2.6)]
_HOLE = [(0.4, 0.4), (0.9, 0.5), (0.7, 1.9)]


def _footprints(spark: SparkSession, d: str) -> DataFrame:
    s = v.shapes(spark, d)
    ring = lambda points: F.array(*(F.struct((F.col("x0") + a * F.col("side")).alias("x"), (F.col("y0") + b * F.col("side")).alias("y")) for a, b in points))
    return s.select("shape_id", F.explode(F.array(ring(_OUTLINE), ring(_HOLE))).alias("ring"))


_EDGES = ", ".join(f"({a}e0, {b}e0, {c}e0, {e}e0)" for ring in (_OUTLINE, _HOLE) for (a, b), (c, e) in zip(ring, ring[1:] + ring[:1], strict=True))


@query(f"""WITH {v.SHAPES}, edges(xa, ya, xb, yb) AS (VALUES {_EDGES}),
own AS (SELECT shape_id, x0 + xa * side AS xa, y0 + ya * side AS ya, x0 + xb * side AS xb, y0 + yb * side AS yb FROM shapes, edges),
boxes AS (SELECT shape_id, CAST(floor(min(xa)) AS INT) AS c0, CAST(ceil(max(xa)) AS INT) AS c1, CAST(floor(min(ya)) AS INT) AS r0, CAST(ceil(max(ya)) AS INT) AS r1 FROM own GROUP BY 1),
near AS (SELECT shape_id, CAST(r AS INT) AS row, CAST(c AS INT) AS col FROM (SELECT *, unnest(range(r0, r1 + 1)) AS r FROM boxes) b, LATERAL (SELECT unnest(range(c0, c1 + 1)) AS c) q)
SELECT shape_id, row, col FROM near JOIN own USING (shape_id)
WHERE row + 0.5e0 >= least(ya, yb) AND row + 0.5e0 < greatest(ya, yb) AND xa + (row + 0.5e0 - ya) / (yb - ya) * (xb - xa) > col + 0.5e0
GROUP BY ALL HAVING count(*) % 2 = 1""")
def footprint_cells(spark: SparkSession, d: str) -> DataFrame:
    """NB-10: cells of concave footprints with holes."""
    return shapes.ring_cells(_footprints(spark, d), ["shape_id"])


@query(f"""WITH {_CELLS}, l AS (SELECT * FROM cells WHERE shape_id % 2 = 0), h AS (SELECT row, col, count(*) AS hits FROM cells WHERE shape_id % 2 = 1 GROUP BY 1, 2)
SELECT shape_id, count(*) AS own_cells, round(coalesce(sum(hits), 0) / CAST(count(*) AS DOUBLE), 6) AS overlap_frac, coalesce(sum(hits), 0) / CAST(count(*) AS DOUBLE) >= 0.5 AS kept
FROM l LEFT JOIN h USING (row, col) GROUP BY 1""")
def overlap_filter(spark: SparkSession, d: str) -> DataFrame:
    """JN-15, NB-10."""
    c = _cells(spark, d).select("shape_id", "row", "col")
    out = shapes.overlap_filter(c.filter("shape_id % 2 = 0"), c.filter("shape_id % 2 = 1"), "shape_id")
    return out.withColumn("overlap_frac", F.round("overlap_frac", 6))


@query(f"""WITH {_CELLS}, a AS (SELECT *, area / count(*) OVER (PARTITION BY shape_id) AS cell_area FROM cells)
SELECT row, col, round(avg(height), 6) AS height_mean, round(coalesce(stddev_samp(height), 0), 6) AS height_std, round(greatest(least(sum(cell_area) / 2e0, 1), 0), 6) AS coverage, max(height) AS height_max, count(*) AS n_shapes FROM a GROUP BY 1, 2""")
def cell_shape_stats(spark: SparkSession, d: str) -> DataFrame:
    """AG-16."""
    c = shapes.spread_area(_cells(spark, d), "shape_id", "area")
    out = shapes.cell_stats(c, "height", cell_size=2.0)
    return out.select("row", "col", *(F.round(x, 6).alias(x) for x in ("height_mean", "height_std", "coverage")), "height_max", "n_shapes")


@query("""SELECT o_orderkey AS id, CASE WHEN c = 255 THEN NULL WHEN c = 0 OR (c BETWEEN 5 AND 95 AND c % 10 = 5) THEN CAST(c AS DOUBLE) ELSE 100e0 END AS imperviousness,
  CASE WHEN year(o_orderdate) <= 1996 THEN 'x' ELSE 'y' END AS side FROM (SELECT *, o_custkey % 256 AS c FROM orders)""")
def code_lookup(spark: SparkSession, d: str) -> DataFrame:
    """PRJ-09."""
    o = v.table(spark, d, "orders")
    return o.select(F.col("o_orderkey").alias("id"), spectral.imperviousness(F.col("o_custkey") % 256).alias("imperviousness"), F.when(F.year("o_orderdate") <= 1996, "x").otherwise("y").alias("side"))


@query(f"WITH {v.PIXELS} SELECT scene_id, " + ", ".join(f"round(avg(CASE WHEN flag & {m} <> 0 THEN 1e0 ELSE 0e0 END), 6) AS {n}_frac" for n, m in bits.FLAGS.items()) + " FROM px GROUP BY 1")
def flag_fractions(spark: SparkSession, d: str) -> DataFrame:
    """AG-19."""
    out = v.pixels(spark, d).groupBy("scene_id").agg(*bits.fractions(F.col("flag")))
    return out.select("scene_id", *(F.round(f"{n}_frac", 6).alias(f"{n}_frac") for n in bits.FLAGS))


@query(f"""WITH {v.PIXELS}, r AS (SELECT 'b04' AS key, min(b04) AS lo, max(b04) AS hi, 0 AS a, 0.5 AS b FROM px UNION ALL SELECT 'b08', min(b08), max(b08), 0.1, 1 FROM px)
SELECT 'out_of_range' AS rule, key FROM r WHERE lo < a OR hi > b UNION ALL SELECT 'no_valid_pixel', key FROM r WHERE lo IS NULL""")
def range_findings(spark: SparkSession, d: str) -> DataFrame:
    """VAL-06."""
    return checks.range_findings(v.pixels(spark, d), BANDS).select("rule", "key")


@query(f"""WITH {v.PIXELS}, p AS (SELECT scene_id, count(*) FILTER ((b04 IS NULL) <> (flag & 1 <> 0)) AS n FROM px GROUP BY 1)
SELECT 'fill_mismatch' AS rule, CAST(scene_id AS VARCHAR) AS key, CAST(n AS VARCHAR) AS detail FROM p WHERE n > 0""")
def fill_equivalence(spark: SparkSession, d: str) -> DataFrame:
    """VAL-07."""
    return checks.fill_equivalence(v.pixels(spark, d), ["scene_id"], "b04", bits.has(F.col("flag"), bits.FILL))


@query(f"""WITH {v.PIXELS} SELECT scene_id, count(*) FILTER (flag NOT IN (0, 1)) AS bad_mask_px, count(*) FILTER (flag = 1 AND NOT {_VALID}) AS valid_but_missing_px,
  count(*) FILTER (flag = 0 AND (b04 IS NOT NULL OR b08 IS NOT NULL)) AS finite_under_mask_px, count(*) FILTER (flag = 1 AND row < 50) AS valid_outside_px FROM px GROUP BY 1""".replace(f"NOT {_VALID}", f"NOT coalesce({_VALID}, false)"))
def mask_mismatches(spark: SparkSession, d: str) -> DataFrame:
    """AG-27, VAL-08."""
    return grids.mask_mismatches(v.pixels(spark, d), ["scene_id"], BANDS, "flag", F.col("row") >= 50)


@query(f"WITH {v.PIXELS} SELECT CAST(count(*) FILTER (row % 32 = 0 AND col % 32 = 0) AS BIGINT) AS sampled, round(min(height), 6) AS min, round(max(height), 6) AS max, round(min(height) FILTER (row % 32 = 0 AND col % 32 = 0), 6) AS sample_min, round(max(height) FILTER (row % 32 = 0 AND col % 32 = 0), 6) AS sample_max FROM px")
def sampled_range(spark: SparkSession, d: str) -> DataFrame:
    """SRC-07."""
    px = v.pixels(spark, d)
    n = px.agg(F.count_if((F.col("row") % 32 == 0) & (F.col("col") % 32 == 0)).alias("sampled"))
    told = grids.sampled_range(px, "height")
    return n.join(F.broadcast(told)).select("sampled", *(F.round(c, 6).alias(c) for c in ("min", "max", "sample_min", "sample_max")))


@query(f"WITH {v.PIXELS} SELECT CAST(row - 20 AS INT) AS row, CAST(col - 30 AS INT) AS col, b04 FROM px WHERE row BETWEEN 20 AND 69 AND col BETWEEN 30 AND 99")
def window_scan(spark: SparkSession, d: str) -> DataFrame:
    """SRC-05, PRJ-14."""
    px = v.pixels(spark, d).select("row", "col", value("b04").alias("b04"))
    return grids.window(px, 20, 30, 50, 70)


@query(f"""WITH {v.PIXELS}, items AS (SELECT row // 4 AS row, col // 4 AS col, scene_id, row AS item, b04 FROM px)
SELECT CAST(row AS INT) AS row, CAST(col AS INT) AS col, scene_id, arg_max(b04, item) FILTER (b04 IS NOT NULL) AS b04 FROM (SELECT * FROM items QUALIFY row_number() OVER (PARTITION BY row, col, scene_id, item ORDER BY b04) = 1) GROUP BY 1, 2, 3""")
def same_day_mosaic(spark: SparkSession, d: str) -> DataFrame:
    """SRC-14."""
    px = v.pixels(spark, d)
    items = px.groupBy(lattice.parent(F.col("row"), 4).alias("r"), lattice.parent(F.col("col"), 4).alias("c"), "scene_id", F.col("row").alias("item")).agg(F.min(value("b04")).alias("b04"))
    return grids.mosaic(items.withColumnsRenamed({"r": "row", "c": "col"}), ["row", "col", "scene_id"], "item", ["b04"])


@query(f"""WITH {v.PIXELS} SELECT count(*) AS n, round(avg(CASE WHEN b04 IS NULL THEN 0e0 ELSE 1e0 END), 4) AS valid_frac, round(min(b04), 6) AS min, round(max(b04), 6) AS max, round(avg(b04), 6) AS mean FROM px""")
def product_stats(spark: SparkSession, d: str) -> DataFrame:
    """AG-20."""
    px = v.pixels(spark, d)
    told = grids.product_stats(px, "b04").select("valid_frac", *(F.round(c, 6).alias(c) for c in ("min", "max", "mean")))
    return px.agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(told))


@query(f"""WITH {v.PIXELS}, s AS (SELECT scene_id, row, count(*) FILTER ({_VALID}) AS valid_px, count(*) FILTER (row >= 20) AS inside_px FROM px GROUP BY 1, 2)
SELECT count(*) AS scenes, CAST(sum(valid_px) AS BIGINT) AS valid_px, CAST(sum(inside_px) AS BIGINT) AS inside_px, round(coalesce(sum(valid_px) / nullif(CAST(sum(inside_px) AS DOUBLE), 0), 0), 6) AS valid_frac,
  count(*) FILTER (coalesce(valid_px / nullif(CAST(inside_px AS DOUBLE), 0), 0) < 0.01) AS sparse_scenes FROM s""")
def coverage_summary(spark: SparkSession, d: str) -> DataFrame:
    """AG-22."""
    s = v.pixels(spark, d).groupBy("scene_id", "row").agg(F.count_if(all_valid(BANDS)).alias("valid_px"), F.count_if(F.col("row") >= 20).alias("inside_px"))
    return grids.coverage(s, "valid_px", "inside_px")


@query("""WITH t AS (SELECT o_orderkey AS id, o_orderdate + INTERVAL 1 HOUR * (o_orderkey % 24) + INTERVAL 1 MINUTE * (o_orderkey % 60) AS ts FROM orders),
g AS (SELECT *, 2 * pi() / 365 * (dayofyear(ts) - 1 + (hour(ts) - 12) / 24e0) AS g FROM t),
e AS (SELECT *, 229.18 * (0.000075 + 0.001868 * cos(g) - 0.032077 * sin(g) - 0.014615 * cos(2 * g) - 0.04089 * sin(2 * g)) AS eq,
  0.006918 - 0.399912 * cos(g) + 0.070257 * sin(g) - 0.006758 * cos(2 * g) + 0.000907 * sin(2 * g) - 0.002697 * cos(3 * g) + 0.00148 * sin(3 * g) AS decl FROM g),
h AS (SELECT *, (hour(ts) * 60e0 + minute(ts) + second(ts) / 60e0 + eq + 4 * 13.42) / 4 - 180 AS ha FROM e),
el AS (SELECT *, asin(greatest(-1, least(1, sin(radians(52.51)) * sin(decl) + cos(radians(52.51)) * cos(decl) * cos(radians(ha))))) AS el FROM h),
az AS (SELECT *, degrees(acos(greatest(-1, least(1, (sin(decl) * cos(radians(52.51)) - cos(decl) * sin(radians(52.51)) * cos(radians(ha))) / cos(el))))) AS az FROM el)
SELECT id, round(CASE WHEN ha > 0 THEN 360 - az ELSE az END, 4) AS azimuth, round(degrees(el), 4) AS elevation FROM az""")
def solar_positions(spark: SparkSession, d: str) -> DataFrame:
    """PRJ-20."""
    k = F.col("o_orderkey")
    ts = F.timestamp_seconds(F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + (k % 24) * 3600 + (k % 60) * 60)
    az, el = solar.solar_position(F.col("ts"), 52.51, 13.42)
    return v.table(spark, d, "orders").select(k.alias("id"), ts.alias("ts")).select("id", F.round(az, 4).alias("azimuth"), F.round(el, 4).alias("elevation"))


@query(f"WITH {v.PIXELS} SELECT row, col, 369190 + (col + 0.5) * 10 AS x, 5838410 - (row + 0.5) * 10 AS y, CAST(row // 7 AS INT) AS row70, CAST(col // 7 AS INT) AS col70 FROM px")
def grid_addresses(spark: SparkSession, d: str) -> DataFrame:
    """PRJ-15."""
    g = lattice.GridSpec()
    px = v.pixels(spark, d).withColumns({"x": g.centre_x(F.col("col")), "y": g.centre_y(F.col("row"))})
    return px.select(g.row(F.col("y")).alias("row"), g.col(F.col("x")).alias("col"), "x", "y", g.coarser(7).row(F.col("y")).alias("row70"), g.coarser(7).col(F.col("x")).alias("col70"))


@query(f"""WITH {v.PIXELS}, p AS (SELECT o_orderkey AS k FROM orders) SELECT scene_id, 'warning_low_overlap' AS rule, n AS overlap_px FROM (SELECT scene_id, count(*) AS n FROM px GROUP BY 1) WHERE n < 100000""")
def low_overlap(spark: SparkSession, d: str) -> DataFrame:
    """VAL-19."""
    told = checks.low_overlap(grids.area_metrics(v.pixels(spark, d), ["scene_id"]), "scene_id", 100000)
    return told.select(F.col("key").cast("int").alias("scene_id"), "rule", F.col("detail").cast("long").alias("overlap_px"))


