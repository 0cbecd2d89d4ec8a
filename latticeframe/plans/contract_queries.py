"""Queries on contracts, findings, sources, sinks and ledger details."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latticeframe.functions import bits, hashes, labels, lattice, nulls, spectral
from latticeframe.functions.contracts import LayerContract, enforce, roster_findings, shadow_value
from latticeframe.operators import checks, couple, grids, inventory, ledger, neighbourhood, sampling, shapes, weather_series
from latticeframe.plans import views as v
from latticeframe.plans.grid_queries import BANDS
from latticeframe.plans.registry import query
from latticeframe.sources import scans, sinks

# --- a manifest and its pairings, made of orders and order lines ----------------------------------------------------

_SRC = "CASE o_orderkey % 3 WHEN 0 THEN 'landsat-c2-l2' WHEN 1 THEN 'sentinel-2-l2a' ELSE 'other' END"
_MANIFEST = f"""manifest AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'LC0' || (7 + o_orderkey % 3 + o_custkey % 3) ELSE 'S2' END || '_' || (o_orderkey - o_orderkey % 3) AS scene_id, {_SRC} AS source,
  CASE WHEN o_orderkey % 3 = 0 THEN 'anchor' WHEN o_orderkey % 3 = 1 THEN 'predictor' WHEN o_custkey % 2 = 0 THEN 'validation' ELSE 'spare' END AS role,
  'landsat-' || (7 + o_custkey % 3) AS platform, CASE WHEN o_custkey % 11 <> 0 THEN (o_custkey % 40) / 40e0 END AS aoi_clear_frac,
  CASE WHEN o_custkey % 13 <> 0 THEN 'href' || o_orderkey END AS item_href, o_orderdate AS acq, CAST(year(o_orderdate) AS INT) AS year FROM orders)"""


def _manifest(spark: SparkSession, d: str) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    third = k % 3
    text = lambda x: x.cast("string")
    return v.table(spark, d, "orders").select(
        F.concat(F.when(third == 0, F.concat(F.lit("LC0"), text(7 + third + c % 3))).otherwise("S2"), F.lit("_"), text(k - third)).alias("scene_id"),
        F.when(third == 0, "landsat-c2-l2").when(third == 1, "sentinel-2-l2a").otherwise("other").alias("source"),
        F.when(third == 0, "anchor").when(third == 1, "predictor").when(c % 2 == 0, "validation").otherwise("spare").alias("role"),
        F.concat(F.lit("landsat-"), text(7 + c % 3)).alias("platform"),
        F.when(c % 11 != 0, (c % 40) / F.lit(40.0)).alias("aoi_clear_frac"),
        F.when(c % 13 != 0, F.concat(F.lit("href"), text(k))).alias("item_href"),
        F.col("o_orderdate").alias("acq"),
        F.year("o_orderdate").alias("year"),
    )


_GRANULES = ", ".join(f"('{g}')" for g in checks.GRANULES)


_MANIFEST_FINDINGS = f"""WITH {_MANIFEST}, f AS (
  SELECT 'source_unknown' AS rule, source || '/' || scene_id AS key, '' AS detail FROM manifest WHERE source = 'other'
  UNION SELECT 'role_unknown', source || '/' || scene_id, '' FROM manifest WHERE role = 'spare'
  UNION SELECT 'platform_unknown', source || '/' || scene_id, '' FROM manifest WHERE source = 'landsat-c2-l2' AND platform NOT IN ('landsat-8', 'landsat-9')
  UNION SELECT 'clear_fraction_missing', source || '/' || scene_id, '' FROM manifest WHERE role IN ('anchor', 'predictor') AND aoi_clear_frac IS NULL
  UNION SELECT 'clear_fraction_low', source || '/' || scene_id, '' FROM manifest WHERE role IN ('anchor', 'predictor') AND aoi_clear_frac < 0.05
  UNION SELECT 'href_missing', source || '/' || scene_id, '' FROM manifest WHERE source <> 'other' AND item_href IS NULL
  UNION SELECT 'duplicate_key', source || '/' || scene_id, CAST(count(*) AS VARCHAR) FROM manifest GROUP BY source, scene_id HAVING count(*) > 1
  UNION SELECT 'granule_missing', g, '' FROM (VALUES {_GRANULES}) t(g)) SELECT * FROM f"""


@query(_MANIFEST_FINDINGS)
def manifest_findings(spark: SparkSession, d: str) -> DataFrame:
    """VAL-01, ST-04."""
    return checks.manifest_findings(_manifest(spark, d))


_PAIRS = """pairings AS (SELECT 'LC0' || (7 + o_custkey % 3) || '_' || o_orderkey AS landsat_scene_id, 'S2_' || (o_orderkey + o_custkey % 7 * 30000) AS sentinel2_scene_id,
  CAST(o_custkey % 50 AS BIGINT) AS landsat_clear_px, CAST(o_custkey % 29 AS BIGINT) AS joint_clear_px,
  CASE WHEN o_custkey % 50 = 0 THEN CAST(0 AS FLOAT) WHEN o_custkey % 5 = 0 THEN CAST(0.25 AS FLOAT) ELSE CAST((o_custkey % 29) / CAST(o_custkey % 50 AS DOUBLE) AS FLOAT) END AS joint_clear_frac FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey % 2 = 0)"""


def _pairings(spark: SparkSession, d: str) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    text = lambda x: x.cast("string")
    frac = F.when(c % 50 == 0, F.lit(0.0)).when(c % 5 == 0, F.lit(0.25)).otherwise(nulls.ratio(c % 29, c % 50))
    return v.table(spark, d, "orders").filter((k % 3 == 0) & (k % 2 == 0)).select(
        F.concat(F.lit("LC0"), text(7 + c % 3), F.lit("_"), text(k)).alias("landsat_scene_id"), F.concat(F.lit("S2_"), text(k + c % 7 * 30000)).alias("sentinel2_scene_id"),
        (c % 50).alias("landsat_clear_px"), (c % 29).alias("joint_clear_px"), frac.cast("float").alias("joint_clear_frac"),
    )


_PAIRING_FINDINGS = f"""WITH {_MANIFEST}, {_PAIRS}, f AS (
  SELECT 'clear_count' AS rule, landsat_scene_id AS key, '' AS detail FROM pairings WHERE landsat_clear_px <= 0
  UNION SELECT 'joint_count', landsat_scene_id, '' FROM pairings WHERE landsat_clear_px > 0 AND joint_clear_px > landsat_clear_px
  UNION SELECT 'fraction_mismatch', landsat_scene_id, '' FROM pairings WHERE landsat_clear_px > 0 AND joint_clear_px <= landsat_clear_px
    AND abs(CAST(CAST(joint_clear_px / CAST(landsat_clear_px AS DOUBLE) AS FLOAT) AS DOUBLE) - CAST(joint_clear_frac AS DOUBLE)) > 1e-7
  UNION SELECT 'anchor_unknown', landsat_scene_id, '' FROM pairings WHERE landsat_scene_id NOT IN (SELECT scene_id FROM manifest WHERE role = 'anchor')
  UNION SELECT 'predictor_unknown', sentinel2_scene_id, '' FROM pairings WHERE sentinel2_scene_id NOT IN (SELECT scene_id FROM manifest WHERE source = 'sentinel-2-l2a')
  UNION SELECT 'warning_anchor_unpaired', scene_id, '' FROM manifest WHERE role = 'anchor' AND scene_id NOT IN (SELECT landsat_scene_id FROM pairings)) SELECT * FROM f"""


@query(_PAIRING_FINDINGS)
def pairing_findings(spark: SparkSession, d: str) -> DataFrame:
    """VAL-02, JN-03, JN-04."""
    return checks.pairing_findings(_pairings(spark, d), _manifest(spark, d))


@query(f"""WITH {_MANIFEST} SELECT count(*) FILTER (role = 'anchor') AS anchor_rows, count(*) FILTER (role = 'predictor') AS predictor_rows, count(*) FILTER (role = 'validation') AS validation_rows,
  count(DISTINCT scene_id) FILTER (source = 'landsat-c2-l2') AS landsat_c2_l2, count(DISTINCT scene_id) FILTER (source = 'sentinel-2-l2a') AS sentinel_2_l2a, CAST(0 AS BIGINT) AS ecostress, 'p1' AS policy_hash FROM manifest""")
def bundle_counts(spark: SparkSession, d: str) -> DataFrame:
    """AG-07, SNK-01, SNK-09."""
    report = sinks.bundle_report(_manifest(spark, d), _pairings(spark, d), {"policy_hash": "p1"})
    return report.select("counts.*", "policy_hash")


@query("SELECT 'report_key_missing' AS rule, k AS key, '' AS detail FROM (VALUES ('cutoff_utc'), ('policy_hash')) t(k) UNION SELECT 'unresolved_errors', 'report', '' UNION SELECT 'pairings_hash', 'report', '' FROM orders")
def report_findings(spark: SparkSession, d: str) -> DataFrame:
    """VAL-03: a report whose hash is that of the table that was read."""
    n = v.table(spark, d, "orders").agg(F.count(F.lit(1)).cast("string").alias("n"))
    have = [k for k in checks.REPORT_KEYS if k not in ("cutoff_utc", "policy_hash")]
    pairs = [x for k in have for x in (F.lit(k), F.lit("3") if k == "unresolved_errors" else F.col("n"))]
    report = n.select(F.create_map(*pairs).alias("report"))
    rows = v.table(spark, d, "orders").count()
    return checks.report_findings(report, str(rows), "another")


@query(f"WITH {_MANIFEST} SELECT scene_id, platform, aoi_clear_frac >= 0.5 AS kept FROM (SELECT scene_id, CASE substr(scene_id, 1, 4) WHEN 'LC08' THEN 'landsat-8' WHEN 'LC09' THEN 'landsat-9' ELSE 'unknown' END AS platform, coalesce(aoi_clear_frac, 0) AS aoi_clear_frac FROM manifest WHERE source = 'landsat-c2-l2')")
def gated_platforms(spark: SparkSession, d: str) -> DataFrame:
    """PRJ-11, PRJ-13."""
    rows = scans.with_platform(_manifest(spark, d).filter("source = 'landsat-c2-l2'")).withColumnRenamed("aoi_clear_frac", "clear_frac")
    kept, dropped = scans.clear_gate(rows, 0.5)
    return kept.withColumn("kept", F.lit(True)).unionByName(dropped.withColumn("kept", F.lit(False))).select("scene_id", "platform", "kept")


@query(f"WITH {_MANIFEST} SELECT scene_id, 'training' AS role, CAST(dayofyear(acq) AS INT) AS day_of_year FROM manifest WHERE source = 'landsat-c2-l2' AND year IN (1996, 1998)")
def anchor_rows(spark: SparkSession, d: str) -> DataFrame:
    """SRC-16."""
    m = _manifest(spark, d).withColumnRenamed("acq", "acquisition_datetime")
    return scans.anchors(m, years=[1996, 1998], role="training").select("scene_id", "role", "day_of_year")


@query(f"""WITH {_MANIFEST}, items AS (SELECT 'LC08_' || (o_orderkey - o_orderkey % 3) AS item_id, 'href' || (o_orderkey - o_orderkey % 3) AS href FROM orders WHERE o_orderkey % 3 = 0 AND o_custkey % 2 = 0)
SELECT m.scene_id, coalesce(CASE WHEN h.item_id = m.scene_id THEN h.item_id END, i.item_id) AS item FROM manifest m LEFT JOIN items h ON m.item_href = h.href LEFT JOIN (SELECT DISTINCT item_id FROM items) i ON i.item_id = m.scene_id WHERE m.source = 'landsat-c2-l2'""")
def resolved_items(spark: SparkSession, d: str) -> DataFrame:
    """SRC-10."""
    k = F.col("o_orderkey")
    base = (k - k % 3).cast("string")
    items = v.table(spark, d, "orders").filter((k % 3 == 0) & (F.col("o_custkey") % 2 == 0)).select(F.concat(F.lit("LC08_"), base).alias("item_id"), F.concat(F.lit("href"), base).alias("href"))
    return inventory.resolve_items(_manifest(spark, d).filter("source = 'landsat-c2-l2'"), items).select("scene_id", "item")


@query(f"""WITH {_MANIFEST} SELECT scene_id, role FROM manifest WHERE source = 'landsat-c2-l2' UNION ALL SELECT scene_id, role FROM manifest WHERE source = 'sentinel-2-l2a' UNION ALL SELECT scene_id, 'validation' FROM manifest WHERE source = 'other'""")
def manifest_union(spark: SparkSession, d: str) -> DataFrame:
    """SET-01, ST-01."""
    m = _manifest(spark, d)
    parts = [m.filter(F.col("source") == s).drop("role") for s in ("landsat-c2-l2", "sentinel-2-l2a", "other")]
    return couple.manifest(*parts).select("scene_id", "role")


@query("SELECT CAST(year(o_orderdate) AS INT) AS year, CASE WHEN year(o_orderdate) <= 1997 THEN 2016 ELSE 2021 END AS vintage, count(*) AS n FROM orders GROUP BY 1, 2")
def year_distribution(spark: SparkSession, d: str) -> DataFrame:
    """AG-23, PRJ-27 (with years moved by 22)."""
    ids = v.table(spark, d, "orders").select(F.concat(F.lit("LC08_193_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_02")).alias("scene_id"))
    y = ids.select(scans.named_year("scene_id").alias("year"))
    return y.groupBy("year", labels.imperviousness_vintage(F.col("year") + 22).alias("vintage")).agg(F.count(F.lit(1)).alias("n"))


# --- pixels ---------------------------------------------------------------------------------------------------------


@query(f"""WITH {v.PIXELS} SELECT row, col, (CASE WHEN custkey % 7 = 0 OR custkey % 5 = 1 OR custkey % 4 = 3 OR b04 IS NULL THEN 1 ELSE 0 END) | (CASE WHEN custkey % 3 = 1 OR custkey % 4 = 1 THEN 2 ELSE 0 END) AS flag,
  qa & 1 = 0 AND qa & 4 = 0 AND qa & 16 = 0 AND NOT (qa & 8 <> 0 AND (qa >> 8) & 3 >= 2) AND (qa & 8 <> 0 OR qa & 2 <> 0) AS hint,
  CASE WHEN custkey % 3 <> 2 THEN CAST(custkey % 3 AS DOUBLE) END AS shadow, coalesce(b04 * 0.1, 0) AS metres, coalesce(b04, 0) + b08 AS risk FROM px""")
def pixel_rules(spark: SparkSession, d: str) -> DataFrame:
    """PRJ-05, PRJ-08, PRJ-10, PRJ-24, PRJ-26."""
    k = F.col("custkey")
    cloud, water = F.when(k % 7 == 0, 255).otherwise(k % 3), F.when(k % 5 == 1, 1).otherwise(0)
    px = v.pixels(spark, d)
    flag = bits.granule_flag(cloud, water, k % 4, F.col("b04"))
    # cloud 1 counts only where the layer isn't fill
    flag = flag.bitwiseOR(F.when(k % 3 == 1, F.lit(bits.CLOUDY)).otherwise(F.lit(0)))
    return px.select(
        "row", "col", flag.alias("flag"), bits.residual_hint(F.col("qa")).alias("hint"), shadow_value(F.when(k % 3 == 2, 255).otherwise(k % 3)).alias("shadow"),
        spectral.metres_of_decimetres(F.col("b04")).alias("metres"), spectral.risk(F.col("b04"), F.col("b08")).alias("risk"),
    )


@query(f"WITH {v.PIXELS} SELECT row, col, CASE WHEN b04 IS NULL THEN 0 ELSE CAST(round_even(custkey / 2e0, 0) AS INT) END AS whole, b04 IS NOT NULL AND b04 > 0.2 AND flag = 0 AS both_masks FROM px")
def class_rounding(spark: SparkSession, d: str) -> DataFrame:
    """PRJ-25, PRJ-28, SET-06: halves round to even, NaN is class 0; masks intersect by AND."""
    px = v.pixels(spark, d)
    c = F.when(nulls.finite("b04"), F.col("custkey") / F.lit(2.0)).otherwise(F.lit(float("nan")))
    both = F.coalesce(nulls.value("b04") > 0.2, F.lit(False)) & (F.col("flag") == 0)
    return px.select("row", "col", bits.whole_class(c).alias("whole"), both.alias("both_masks"))


@query(f"WITH {v.PIXELS} SELECT scene_id, count(*) FILTER (flag = 0 AND row >= 20) AS clear_px, count(*) FILTER (row >= 20) AS total_px, round(count(*) FILTER (flag = 0 AND row >= 20) / nullif(CAST(count(*) FILTER (row >= 20) AS DOUBLE), 0), 6) AS clear_frac FROM px GROUP BY 1")
def anchor_clear_frac(spark: SparkSession, d: str) -> DataFrame:
    """AG-02."""
    out = grids.clear_fraction(v.pixels(spark, d), ["scene_id"], F.col("flag") == 0, F.col("row") >= 20)
    return out.withColumn("clear_frac", F.round("clear_frac", 6))


@query(f"""WITH {v.PIXELS} SELECT a.row, a.col, a.b08, b.height, coalesce(c.inside, false) AS inside, coalesce(c.height < 30, false) AS static_valid
FROM px a JOIN px b USING (row, col) LEFT JOIN (SELECT row, col, true AS inside, height FROM px WHERE flag = 0) c USING (row, col)""")
def co_registered(spark: SparkSession, d: str) -> DataFrame:
    """JN-11, JN-12, JN-20."""
    px = v.pixels(spark, d)
    both = grids.co_register([px.select("row", "col", "b08"), px.select("row", "col", "height")], ["row", "col"])
    area = px.filter("flag = 0").select("row", "col", F.lit(1).alias("inside"))
    static = px.filter("flag = 0").select(F.lit("g").alias("geometry_id"), "row", "col", F.col("height").alias("h"))
    out = grids.with_static_validity(grids.inside_area(both, area).withColumn("geometry_id", F.lit("g")), static, [LayerContract("h", 0, 29.999999)])
    return out.select("row", "col", "b08", "height", "inside", "static_valid")


@query(f"""WITH {v.PIXELS}, t AS (SELECT px.row * 3 + r.i AS row, px.col * 3 + c.i AS col FROM px, range(3) r(i), range(3) c(i))
SELECT CAST(t.row AS INT) AS row, CAST(t.col AS INT) AS col, px.scl FROM t LEFT JOIN px ON px.row = floor((t.row + 0.5e0) / 3) AND px.col = floor((t.col + 0.5e0) / 3)""")
def nearest_resample(spark: SparkSession, d: str) -> DataFrame:
    """NB-04: a grid three times finer, over the whole extent of the table."""
    px, step = v.pixels(spark, d), F.explode(F.sequence(F.lit(0), F.lit(2)))
    t = px.select("row", "col", step.alias("i")).select("row", "col", "i", step.alias("j"))
    t = t.select((F.col("row") * 3 + F.col("i")).alias("row"), (F.col("col") * 3 + F.col("j")).alias("col"))
    return neighbourhood.nearest(t, px, [], ["scl"], (F.col("row") + 0.5) / 3, (F.col("col") + 0.5) / 3)


@query(f"""WITH {v.PIXELS}, coarse AS (SELECT row // 10 AS crow, col // 10 AS ccol, min(height) * pi() AS t FROM px GROUP BY 1, 2), u AS (SELECT row, col, (row + 0.5e0) / 10 - 0.5e0 AS sr, (col + 0.5e0) / 10 - 0.5e0 AS sc FROM px),
w AS (SELECT row, col, floor(sr) + i AS srow, floor(sc) + j AS scol, (CASE WHEN i = 1 THEN sr - floor(sr) ELSE 1 - (sr - floor(sr)) END) * (CASE WHEN j = 1 THEN sc - floor(sc) ELSE 1 - (sc - floor(sc)) END) AS w FROM u, range(2) a(i), range(2) b(j))
SELECT w.row, w.col, round(sum(w * t) / nullif(sum(CASE WHEN t IS NOT NULL AND w > 0 THEN w END), 0), 6) AS t FROM w LEFT JOIN coarse ON crow = srow AND ccol = scol GROUP BY 1, 2""")
def coarse_field(spark: SparkSession, d: str) -> DataFrame:
    """NB-05: a field of a grid ten times coarser at every cell."""
    import math

    px = v.pixels(spark, d)
    p = lambda c: lattice.parent(F.col(c), 10)
    coarse = px.groupBy(p("row").alias("r"), p("col").alias("c")).agg((F.min("height") * math.pi).alias("t")).withColumnsRenamed({"r": "row", "c": "col"})
    t = px.select("row", "col", ((F.col("row") + 0.5) / 10 - 0.5).alias("src_row"), ((F.col("col") + 0.5) / 10 - 0.5).alias("src_col"))
    return neighbourhood.from_coarse(t, coarse, [], ["t"]).withColumn("t", F.round("t", 6))


@query(f"""WITH {v.PIXELS}, t AS (SELECT row, col FROM px) SELECT t.row, t.col, s.scl AS scl FROM t LEFT JOIN px s ON s.row = floor((t.row + 0.5e0) / 2) AND s.col = floor((t.col + 0.5e0) / 2)""")
def scene_layers(spark: SparkSession, d: str) -> DataFrame:
    """NB-06: class layer by nearest cell beside a value layer by bilinear weights."""
    px = v.pixels(spark, d)
    t = px.select("row", "col")
    return neighbourhood.scene_layers(t, px.select("row", "col", "b04", "scl"), [], ["b04"], ["scl"], 2).select("row", "col", "scl")


@query(f"""WITH {v.PIXELS}, h AS (SELECT CAST(tr AS INT) AS tile_row, CAST(tc AS INT) AS tile_col, row // 16 = tr AND col // 16 = tc AS core FROM
  (SELECT row, col, unnest(range(CAST(floor((row - 3) / 16e0) AS BIGINT), CAST(floor((row + 3) / 16e0) AS BIGINT) + 1)) AS tr FROM px) a, LATERAL (SELECT unnest(range(CAST(floor((col - 3) / 16e0) AS BIGINT), CAST(floor((col + 3) / 16e0) AS BIGINT) + 1)) AS tc) b)
SELECT tile_row, tile_col, count(*) AS n, count(*) FILTER (core) AS core FROM h GROUP BY 1, 2""")
def halo_tiles(spark: SparkSession, d: str) -> DataFrame:
    """NB-09, SRC-06."""
    out = neighbourhood.with_halo(v.pixels(spark, d).select("row", "col"), 16, 3)
    return out.groupBy("tile_row", "tile_col").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_core").alias("core"))


@query(f"""WITH {v.SHAPES}, n AS (SELECT shape_id, 'lod_' || (380 + CAST(x0 AS INT)) || '_' || (5800 + CAST(y0 AS INT)) AS name, (380 + CAST(x0 AS INT)) * 1000e0 AS e, (5800 + CAST(y0 AS INT)) * 1000e0 AS nn FROM shapes)
SELECT shape_id, name FROM n WHERE e <= 420000 AND e + 1000 >= 390000 AND nn <= 5850000 AND nn + 1000 >= 5810000""")
def tiles_in_box(spark: SparkSession, d: str) -> DataFrame:
    """NB-11."""
    s = v.shapes(spark, d)
    whole = lambda c: F.floor(c).cast("int")
    name = F.concat(F.lit("lod_"), (380 + whole("x0")).cast("string"), F.lit("_"), (5800 + whole("y0")).cast("string"))
    return shapes.tiles_in_box(s.select("shape_id", name.alias("name")), "name", r"_(\d+)_(\d+)$", 390000, 5810000, 420000, 5850000).select("shape_id", "name")


@query(f"""WITH {v.SHAPES}, n AS (SELECT shape_id, 'dgm_' || (380 + CAST(x0 AS INT)) || '_' || (5800 + CAST(y0 AS INT)) || '.zip' AS name, (380 + CAST(x0 AS INT)) * 1000e0 AS e, (5800 + CAST(y0 AS INT)) * 1000e0 AS nn FROM shapes)
SELECT shape_id, name FROM n WHERE NOT (e >= 420000 OR e + 2000 <= 390000 OR nn <= 5810000 OR nn - 2000 >= 5850000)""")
def feed_tiles(spark: SparkSession, d: str) -> DataFrame:
    """SRC-11."""
    s = v.shapes(spark, d)
    whole = lambda c: F.floor(c).cast("int").cast("string")
    name = F.concat(F.lit("dgm_"), whole(380 + F.col("x0")), F.lit("_"), whole(5800 + F.col("y0")), F.lit(".zip"))
    return shapes.feed_tiles(s.select("shape_id", name.alias("name")), "name", r"_(\d+)_(\d+)\.zip$", 390000, 5810000, 420000, 5850000).select("shape_id", "name")


@query(f"""WITH {v.SHAPES}, t AS (SELECT shape_id, CAST(floor(y0 / 20) AS INT) AS tile_row, CAST(floor(x0 / 20) AS INT) AS tile_col FROM shapes), k AS (SELECT DISTINCT tile_row, tile_col FROM t)
SELECT k.tile_row, k.tile_col, count(*) AS n FROM k JOIN t ON abs(k.tile_row - t.tile_row) <= 1 AND abs(k.tile_col - t.tile_col) <= 1 GROUP BY 1, 2""")
def tile_pool(spark: SparkSession, d: str) -> DataFrame:
    """JN-14."""
    t = v.shapes(spark, d).select("shape_id", F.floor(F.col("y0") / 20).cast("int").alias("tile_row"), F.floor(F.col("x0") / 20).cast("int").alias("tile_col"))
    return shapes.tile_pool(t, t).groupBy("tile_row", "tile_col").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {v.PIXELS}, s AS (SELECT scene_id, count(b04) / CAST(count(*) AS DOUBLE) AS share FROM px GROUP BY 1) SELECT 'valid_share' AS rule, CAST(scene_id AS VARCHAR) AS key FROM s WHERE share < 0.9995""")
def valid_share_findings(spark: SparkSession, d: str) -> DataFrame:
    """VAL-05."""
    return checks.valid_share_findings(v.pixels(spark, d), ["scene_id"], "b04", 0.9995).select("rule", "key")


@query(f"""WITH {v.PIXELS}, m AS (SELECT scene_id, max(row) + 1 AS rows, max(col) + 1 AS cols FROM px GROUP BY 1) SELECT 'shape' AS rule, CAST(scene_id AS VARCHAR) AS key FROM m WHERE cols <> 125 OR rows <> 5
UNION ALL SELECT 'origin', CAST(scene_id AS VARCHAR) FROM m WHERE scene_id % 2 = 1 UNION ALL SELECT 'dtype', CAST(scene_id AS VARCHAR) FROM m""")
def grid_findings(spark: SparkSession, d: str) -> DataFrame:
    """VAL-04."""
    meta = v.pixels(spark, d).groupBy("scene_id").agg((F.max("row") + 1).alias("rows"), (F.max("col") + 1).alias("cols"))
    odd = F.col("scene_id") % 2
    meta = meta.select(
        F.col("scene_id").alias("product"), F.lit("EPSG:25833").alias("crs"), F.lit(2).alias("bands"), F.lit("double").alias("dtype"), "rows", "cols", (F.lit(369190.0) + odd).alias("origin_x"), F.lit(5838410.0).alias("origin_y")
    )
    return checks.grid_findings(meta, lattice.GridSpec(rows=5, cols=125), 2, "float").select("rule", "key")


@query("""WITH p AS (SELECT DISTINCT 's' || (o_orderkey % 40) AS scene_id, 'l' || (o_custkey % 7) AS layer FROM orders WHERE o_custkey % 7 <> o_orderkey % 40 % 7), w AS (SELECT scene_id, layer FROM (SELECT DISTINCT scene_id FROM p), (VALUES ('l0'), ('l1'), ('l2'), ('l3'), ('l4')) t(layer))
SELECT scene_id, layer, 'missing' AS problem FROM w WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.scene_id = w.scene_id AND p.layer = w.layer) UNION ALL SELECT scene_id, layer, 'extra' FROM p WHERE layer NOT IN ('l0', 'l1', 'l2', 'l3', 'l4')""")
def layer_roster(spark: SparkSession, d: str) -> DataFrame:
    """VAL-16."""
    k, c = F.col("o_orderkey") % 40, F.col("o_custkey") % 7
    p = v.table(spark, d, "orders").filter(c != k % 7).select(F.concat(F.lit("s"), k.cast("string")).alias("scene_id"), F.concat(F.lit("l"), c.cast("string")).alias("layer")).distinct()
    return roster_findings(p, [LayerContract(f"l{i}", 0, 1) for i in range(5)]).select("scene_id", "layer", "problem")


@query(f"WITH {v.PIXELS} SELECT scene_id, row, col, b08, CAST(scl AS DOUBLE) AS scl FROM px")
def enforced_contract(spark: SparkSession, d: str) -> DataFrame:
    """VAL-17."""
    wanted = [LayerContract("b08", 0, 1, dtype="double"), LayerContract("scl", 0, 11, dtype="double")]
    return enforce(v.pixels(spark, d), wanted, ["scene_id", "row", "col"])


@query(f"""WITH {v.LEDGER_LOG}, s AS (SELECT item_id AS scene_id, count(*) AS target, count(*) FILTER (status = 'done') AS full_px, max(event_id) % 5 AS m FROM ledger_log GROUP BY 1)
SELECT 'histogram_sum' AS rule, CAST(scene_id AS VARCHAR) AS key FROM s WHERE m <> 0 AND target - full_px + full_px + (CASE WHEN m = 1 THEN 1 ELSE 0 END) <> target UNION ALL SELECT 'full_support_above_target', CAST(scene_id AS VARCHAR) FROM s WHERE m <> 0 AND full_px + 40 > target
UNION ALL SELECT 'excluded_without_reason', CAST(scene_id AS VARCHAR) FROM s WHERE m = 0""")
def scene_report_findings(spark: SparkSession, d: str) -> DataFrame:
    """VAL-10."""
    s = v.ledger_log(spark, d).groupBy(F.col("item_id").alias("scene_id")).agg(F.count(F.lit(1)).alias("target"), F.count_if(F.col("status") == "done").alias("full"), (F.max("event_id") % 5).alias("m"))
    wrong = F.when(F.col("m") == 1, 1).otherwise(0)
    rows = s.select(
        "scene_id", (F.col("m") != 0).alias("assessed"), F.lit(None).cast("string").alias("exclusion_reason"), F.col("target").alias("target_valid_cells"), F.lit(0).alias("all_100_cells"), (F.col("full") + 40).alias("full_support_cells"),
        F.lit(0.5).alias("support_mean_frac"), F.create_map(F.lit("1.00"), F.col("full"), F.lit("0.00-0.25"), F.col("target") - F.col("full") + wrong).alias("support_histogram"),
    )
    return checks.scene_report_findings(rows, ["1.00", "0.00-0.25"]).select("rule", "key")


@query(f"""WITH {v.LEDGER_LOG}, {v.LATEST}, c AS (SELECT source, count(*) AS n FROM latest GROUP BY 1), w(source, want) AS (VALUES ('src0', 5), ('src9', 1))
SELECT 'row_count' AS rule, coalesce(w.source, c.source) AS key FROM w FULL JOIN c ON w.source = c.source WHERE w.want IS DISTINCT FROM c.n UNION ALL SELECT 'not_done', source || '/' || item_id FROM latest WHERE status <> 'done'""")
def ledger_findings(spark: SparkSession, d: str) -> DataFrame:
    """VAL-12, VAL-14."""
    book = ledger.latest(v.ledger_log(spark, d), ["item_id"], ["updated_at", "event_id"])
    return checks.ledger_findings(book, {"src0": 5, "src9": 1}).select("rule", "key")


@query("""WITH y AS (SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS year FROM orders), m AS (SELECT year, CASE WHEN year % 2 = 0 THEN 1996 ELSE 2000 END AS vintage FROM y WHERE year <> 1997)
SELECT 'year_uncovered' AS rule, CAST(i AS VARCHAR) AS key FROM range(1995, 2000) r(i) WHERE i NOT IN (SELECT year FROM m) UNION ALL SELECT 'vintage_after_year', CAST(year AS VARCHAR) FROM m WHERE vintage > year
UNION ALL SELECT 'year_outside_vintage', CAST(year AS VARCHAR) FROM m WHERE NOT (CASE vintage WHEN 1996 THEN year BETWEEN 1996 AND 1999 ELSE year BETWEEN 2000 AND 2001 END)""")
def mapping_findings(spark: SparkSession, d: str) -> DataFrame:
    """VAL-13, VAL-18."""
    y = v.table(spark, d, "orders").select(F.year("o_orderdate").alias("year")).distinct().filter("year <> 1997")
    m = y.select("year", F.when(F.col("year") % 2 == 0, 1996).otherwise(2000).alias("vintage"), F.lit("g").alias("geometry_id"))
    return checks.mapping_findings(m, (1995, 1999), [(1996, 1996, 1999), (2000, 2000, 2001)]).select("rule", "key")


@query("""WITH s AS (SELECT c_custkey, c_custkey % 3 AS a, c_nationkey % 2 AS b FROM customer) SELECT 'marker_run' AS rule, CAST(c_custkey AS VARCHAR) AS key FROM s WHERE a = 0 UNION ALL SELECT 'version', CAST(c_custkey AS VARCHAR) FROM s WHERE b = 1
UNION ALL SELECT 'channel_order', CAST(c_custkey AS VARCHAR) FROM s WHERE a = 1 UNION ALL SELECT 'marker_time', CAST(c_custkey AS VARCHAR) FROM s WHERE c_custkey % 10 = 4""")
def sidecar_findings(spark: SparkSession, d: str) -> DataFrame:
    """VAL-09, SRC-03: sidecars as JSON texts, parsed and checked."""
    c = v.table(spark, d, "customer")
    a = F.col("c_custkey") % 3
    text = F.to_json(
        F.struct(
            F.when(F.col("c_custkey") % 10 == 4, "soon").otherwise("2024-06-01T10:00:00Z").alias("completed_at"), F.when(a == 0, " ").otherwise("r").alias("run_id"),
            F.when(a == 1, F.array(F.lit("y"), F.lit("x"))).otherwise(F.array(F.lit("x"), F.lit("y"))).alias("channels"), (F.col("c_nationkey") % 2 + 7).alias("schema_version"), F.array(F.lit("cog")).alias("assets"),
        )
    )
    kinds = "completed_at string, run_id string, channels array<string>, schema_version int, assets array<string>"
    parsed = c.select(F.col("c_custkey").alias("scene_id"), F.from_json(text, kinds).alias("s")).select("scene_id", "s.*")
    return checks.sidecar_findings(parsed, ["x", "y"], 7).select("rule", "key")


@query("""WITH p AS (SELECT c_custkey AS scene_id, c_custkey % 4 AS m FROM customer) SELECT 'channel_count' AS rule, CAST(scene_id AS VARCHAR) AS key FROM p WHERE m = 1 UNION ALL SELECT 'channel_index', CAST(scene_id AS VARCHAR) FROM p WHERE m = 1
UNION ALL SELECT 'histogram_sum', scene_id || '/b' FROM p WHERE m = 2 UNION ALL SELECT 'histogram_key', scene_id || '/a' FROM p WHERE m = 3""")
def profile_findings(spark: SparkSession, d: str) -> DataFrame:
    """VAL-11."""
    m = F.col("scene_id") % 4
    scenes = v.table(spark, d, "customer").select(F.col("c_custkey").alias("scene_id"), F.lit(True).alias("assessed"))
    rows = scenes.select("scene_id", F.posexplode(F.array(F.lit("a"), F.lit("b"))).alias("channel_index", "channel_name")).filter((m != 1) | (F.col("channel_index") == 0))
    key = F.when((m == 3) & (F.col("channel_name") == "a"), "low").otherwise("003")
    rows = rows.withColumns({"valid_px": F.lit(9), "histogram": F.create_map(key, F.when((m == 2) & (F.col("channel_name") == "b"), 8).otherwise(9))})
    return checks.profile_findings(rows, scenes, ["a", "b"]).select("rule", "key")


# --- ledgers --------------------------------------------------------------------------------------------------------


def _book(spark: SparkSession, d: str) -> DataFrame:
    return ledger.latest(v.ledger_log(spark, d), ["item_id"], ["updated_at", "event_id"])


@query(f"""WITH {v.LEDGER_LOG}, {v.LATEST}, n AS (SELECT c_custkey AS item_id FROM customer WHERE c_custkey % 2 = 0)
SELECT item_id, status, attempts FROM latest WHERE item_id NOT IN (SELECT item_id FROM n) UNION ALL SELECT n.item_id, 'done', coalesce(l.attempts, 1) FROM n LEFT JOIN latest l ON n.item_id = l.item_id""")
def ledger_upsert_keep(spark: SparkSession, d: str) -> DataFrame:
    """LED-02."""
    rows = v.table(spark, d, "customer").filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("item_id"), F.lit("done").alias("status"), F.lit(0).alias("attempts"))
    return ledger.upsert(_book(spark, d).select("item_id", "status", "attempts"), rows, ["item_id"], "keep")


@query(f"WITH {v.LEDGER_LOG} SELECT event_id, status FROM ledger_log WHERE item_id = 7 AND status NOT IN ('pending', 'exporting', 'done', 'failed')")
def ledger_point_lookup(spark: SparkSession, d: str) -> DataFrame:
    """LED-04, LED-05."""
    found = ledger.lookup(v.ledger_log(spark, d), item_id=7)
    return ledger.bad_states(found, ("pending", "exporting", "done", "failed")).select("event_id", "status")


@query(f"""WITH {v.LEDGER_LOG}, {v.LATEST}, a AS (SELECT o_custkey AS item_id FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderkey % 2) = 2), n AS (SELECT item_id FROM a WHERE item_id NOT IN (SELECT item_id FROM latest WHERE status = 'done'))
SELECT item_id, status, attempts FROM latest WHERE item_id NOT IN (SELECT item_id FROM n) UNION ALL SELECT n.item_id, 'done', coalesce(l.attempts, 1) FROM n LEFT JOIN latest l ON n.item_id = l.item_id""")
def adopted_artifacts(spark: SparkSession, d: str) -> DataFrame:
    """LED-07, JN-09."""
    o = v.table(spark, d, "orders")
    artifacts = o.select(F.col("o_custkey").alias("item_id"), F.when(F.col("o_orderkey") % 2 == 0, "data").otherwise("marker").alias("kind"))
    keys = o.select(F.col("o_custkey").alias("item_id")).distinct()
    out = inventory.adopt_artifacts(keys, ["data", "marker"], artifacts, _book(spark, d).select("item_id", "status", "attempts"), ["item_id"], "run")
    return out.select("item_id", "status", "attempts")


@query(f"WITH {v.LEDGER_LOG}, {v.LATEST} SELECT c_custkey AS item_id, CASE WHEN c_custkey % 3 = 0 THEN 'skip' ELSE 'new' END AS action, CASE WHEN c_custkey % 3 = 0 THEN l.attempts END AS attempts FROM customer LEFT JOIN latest l ON l.item_id = c_custkey")
def reused_figures(spark: SparkSession, d: str) -> DataFrame:
    """LED-08."""
    work = v.table(spark, d, "customer").select(F.col("c_custkey").alias("item_id"), F.when(F.col("c_custkey") % 3 == 0, "skip").otherwise("new").alias("action"))
    return ledger.reuse_previous(work, _book(spark, d).select("item_id", "attempts"), ["item_id"], ["attempts"]).select("item_id", "action", "attempts")


@query("SELECT n_nationkey AS product, sha256(sha256('n' || n_nationkey) || sha256(sha256('r' || n_regionkey))) AS lineage_hash FROM nation UNION ALL SELECT 1000 + r_regionkey, sha256(sha256('r' || r_regionkey)) FROM region")
def lineage_hashes(spark: SparkSession, d: str) -> DataFrame:
    """FP-03: nations as products derived from their regions."""
    n, r = v.table(spark, d, "nation"), v.table(spark, d, "region")
    h = lambda p, c: F.sha2(F.concat(F.lit(p), F.col(c).cast("string")), 256)
    own = n.select(F.col("n_nationkey").cast("long").alias("product"), h("n", "n_nationkey").alias("config_hash")).union(r.select((F.col("r_regionkey") + 1000).cast("long"), h("r", "r_regionkey")))
    edges = n.select(F.col("n_nationkey").cast("long").alias("product"), (F.col("n_regionkey") + 1000).cast("long").alias("upstream"))
    return hashes.lineage(edges, own).drop("level")


@query("""WITH RECURSIVE c AS (SELECT c_custkey AS k, sha256('c' || c_custkey) AS own FROM customer),
made AS (SELECT k, sha256(own) AS lineage_hash, 0 AS level FROM c WHERE k // 6 NOT IN (SELECT k FROM c) OR k // 6 = k
  UNION ALL SELECT c.k, sha256(c.own || made.lineage_hash), made.level + 1 FROM c JOIN made ON made.k = c.k // 6 AND c.k // 6 <> c.k)
SELECT k AS product, lineage_hash, level FROM made""")
def lineage_levels(spark: SparkSession, d: str) -> DataFrame:
    """FP-03: chains of customers, each derived from the one of a sixth of its key; as many levels as there are."""
    c = v.table(spark, d, "customer").select(F.col("c_custkey").cast("long").alias("product"), F.sha2(F.concat(F.lit("c"), F.col("c_custkey").cast("string")), 256).alias("config_hash"))
    edges = c.select("product", F.floor(F.col("product") / 6).alias("upstream")).filter("product <> upstream")
    return hashes.lineage(edges, c)


@query("""WITH h AS (SELECT source, sha256(text) AS h FROM documents WHERE text IS NOT NULL), n AS (SELECT source, h, row_number() OVER (PARTITION BY source ORDER BY h) - 1 AS i FROM h),
a AS (SELECT source, i // 16 AS i, sha256(string_agg(h, '' ORDER BY i)) AS h FROM (SELECT source, h, i, i // 16 AS g FROM n) GROUP BY source, i // 16),
b AS (SELECT source, i // 16 AS i, sha256(string_agg(h, '' ORDER BY i)) AS h FROM a GROUP BY source, i // 16),
c AS (SELECT source, i // 16 AS i, sha256(string_agg(h, '' ORDER BY i)) AS h FROM b GROUP BY source, i // 16),
sizes AS (SELECT source, count(*) AS m FROM h GROUP BY source)
SELECT source, m AS n_members, CASE WHEN m <= 16 THEN a.h WHEN m <= 256 THEN b.h ELSE c.h END AS checksum
FROM sizes JOIN a USING (source) JOIN b USING (source) JOIN c USING (source) WHERE a.i = 0 AND b.i = 0 AND c.i = 0""")
def tree_checksums(spark: SparkSession, d: str) -> DataFrame:
    """AG-24: checksums of groups of any size, by a hash tree of sixteen branches (4,096 members of a source at most in its SQL)."""
    return hashes.tree_checksum(v.table(spark, d, "documents"), ["source"], "text", 16)


@query("""WITH w AS (SELECT doc_id AS member, sha256(text) AS h FROM documents WHERE doc_id % 5 <> 0), x AS (SELECT doc_id AS member, CASE WHEN doc_id % 7 = 0 THEN 'x' ELSE sha256(text) END AS h FROM documents WHERE doc_id % 3 <> 0)
SELECT coalesce(w.member, x.member) AS member, CASE WHEN x.member IS NULL THEN 'missing' WHEN w.member IS NULL THEN 'extra' ELSE 'changed' END AS problem FROM w FULL JOIN x ON w.member = x.member WHERE w.h IS DISTINCT FROM x.h""")
def archive_findings(spark: SparkSession, d: str) -> DataFrame:
    """FP-04."""
    docs = v.table(spark, d, "documents").select(F.col("doc_id").alias("member"), F.sha2("text", 256).alias("sha256"))
    have = docs.filter("member % 3 <> 0").withColumn("sha256", F.when(F.col("member") % 7 == 0, "x").otherwise(F.col("sha256")))
    return inventory.archive_findings(have, docs.filter("member % 5 <> 0"))


@query("""WITH a AS (SELECT n_name AS label, sha256(n_name) AS f FROM nation), b AS (SELECT n_name AS label, CASE WHEN n_nationkey % 4 = 0 THEN 'x' ELSE sha256(n_name) END AS f FROM nation WHERE n_nationkey % 6 <> 0)
SELECT coalesce(a.label, b.label) AS label FROM a FULL JOIN b ON a.label = b.label WHERE a.f IS DISTINCT FROM b.f""")
def source_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    """JN-21."""
    n = v.table(spark, d, "nation")
    h = F.sha2("n_name", 256)
    told = n.agg(F.map_from_entries(F.collect_list(F.struct(F.col("n_name").alias("k"), h.alias("v")))).alias("m"))
    again = n.filter("n_nationkey % 6 <> 0").select(F.col("n_name").alias("label"), F.when(F.col("n_nationkey") % 4 == 0, "x").otherwise(h).alias("fingerprint"))
    return inventory.map_difference(F.col("m"), told, again).select("label")


@query("SELECT c_custkey AS item_id, 'uri5' AS carried_uri FROM customer")
def carry_forward(spark: SparkSession, d: str) -> DataFrame:
    """JN-16."""
    book = v.table(spark, d, "nation").select(F.concat(F.lit("g"), F.col("n_nationkey").cast("string")).alias("geometry_id"), F.lit("done").alias("status"), F.concat(F.lit("uri"), F.col("n_nationkey").cast("string")).alias("output_uri"), F.lit("h").alias("config_hash"))
    return inventory.carry_forward(v.table(spark, d, "customer").select(F.col("c_custkey").alias("item_id")), book, "g5").select("item_id", "carried_uri")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
WHERE c_acctbal > 0 AND p_size > 20 AND o_orderstatus = 'F'""")
def eligible_pairs(spark: SparkSession, d: str) -> DataFrame:
    """JN-17: pairs whose both sides are in the manifest and in the flag ledger."""
    t = lambda n: v.table(spark, d, n)
    a = t("lineitem").join(t("orders").filter("o_orderstatus = 'F'"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer").filter("c_acctbal > 0"), F.col("o_custkey") == F.col("c_custkey"))
    b = a.join(t("part").filter("p_size > 20"), F.col("l_partkey") == F.col("p_partkey")).join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    return b.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 20")
def first_scenes(spark: SparkSession, d: str) -> DataFrame:
    """ST-02, ST-05: the first few scenes in time, a feature of the restricted run."""
    return v.table(spark, d, "orders").select("o_orderkey", "o_orderdate").orderBy("o_orderdate", "o_orderkey").limit(20)


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')")
def requested_products(spark: SparkSession, d: str) -> DataFrame:
    """SET-05."""
    wanted = inventory.requested(["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"], ["5-LOW", "1-URGENT"])
    return v.table(spark, d, "orders").filter(F.col("o_orderpriority").isin(*wanted)).select("o_orderkey", "o_orderpriority")


# --- sources and sinks ----------------------------------------------------------------------------------------------


@query("SELECT r_regionkey, r_name FROM region")
def strict_scan(spark: SparkSession, d: str) -> DataFrame:
    """SRC-01: a declared schema; another one makes the scan fail, which the tests try."""
    schema = T._parse_datatype_string("r_regionkey int, r_name string")
    return scans.strict_table(spark, f"{d}/region.parquet", schema).select("r_regionkey", "r_name")


@query("SELECT n_nationkey, n_name FROM nation")
def csv_twin(spark: SparkSession, d: str) -> DataFrame:
    """SRC-04, SNK-02: a table and its CSV twin, written and read back."""
    path = sinks.work_folder(spark, "twin")
    n = v.table(spark, d, "nation").select("n_nationkey", "n_name")
    sinks.write_table_with_twin(n, path)
    return scans.csv_twin(spark, f"{path}.csv", n.schema)


@query("SELECT CAST(year AS INT) AS year, CAST(2017 AS INT) AS vintage, 'g2017' AS geometry_id FROM (SELECT DISTINCT year(o_orderdate) AS year FROM orders)")
def geometry_documents(spark: SparkSession, d: str) -> DataFrame:
    """SRC-03: a mapping document, written as JSON and scanned."""
    path = sinks.work_folder(spark, "mapping")
    years = v.table(spark, d, "orders").select(F.year("o_orderdate").cast("string").alias("y")).distinct()
    document = years.agg(F.map_from_entries(F.collect_list(F.struct("y", F.lit(2017)))).alias("year_to_vintage"))
    document = document.withColumn("vintages", F.create_map(F.lit("2017"), F.struct(F.lit("g2017").alias("geometry_id"))))
    document.write.json(path)
    kinds = T._parse_datatype_string("year_to_vintage map<string,int>, vintages map<string,struct<geometry_id:string>>")
    return scans.geometry_mapping(scans.json_documents(spark, path, kinds))


@query(f"WITH {v.PIXELS} SELECT scene_id, count(*) AS n FROM px WHERE scene_id <> 3 GROUP BY 1")
def gated_publication(spark: SparkSession, d: str) -> DataFrame:
    """SNK-04: products are read only once they are marked; the fourth one breaks its rule and stays unmarked."""
    folder, px = sinks.work_folder(spark, "products"), v.pixels(spark, d)
    for scene in range(4):
        rows = px.filter(F.col("scene_id") == scene)
        bad = checks.when(rows.limit(1), "fourth", F.col("scene_id") == 3, F.lit("scene"))
        try:
            sinks.publish(rows, folder, "flags", f"s{scene}", "run", bad)
        except sinks.NotPublishable:
            continue
    return sinks.published(spark, folder).groupBy("scene_id").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {v.PIXELS} SELECT CAST(scene_id AS INT) AS scene_id, row, col, b08 FROM px WHERE row BETWEEN 2 AND 9")
def pixel_product(spark: SparkSession, d: str) -> DataFrame:
    """SNK-05, SNK-06: a pixel product written by scene and tile, and a window of it read back."""
    path = sinks.work_folder(spark, "pixels")
    sinks.write_pixels(v.pixels(spark, d), [LayerContract("b08", 0, 1, dtype="double")], path, 64)
    return spark.read.parquet(path).filter(F.col("row").between(2, 9)).select(F.col("scene_id").cast("int"), "row", "col", "b08")


_BANDS = ",".join(f'{{"name":"{c.name}","dtype":"{c.dtype}","unit":"{c.unit}","nodata":"nan"}}' for c in BANDS)


@query(f"""WITH {v.PIXELS}, m AS (SELECT scene_id, max(row) + 1 AS r, max(col) + 1 AS c FROM px GROUP BY 1)
SELECT scene_id, '{{"crs":"EPSG:25833","rows":' || r || ',"cols":' || c || ',"bbox":[369190.0,' || CAST(5838410e0 - r * 10 AS VARCHAR) || ',' || CAST(369190e0 + c * 10 AS VARCHAR)
  || ',5838410.0],"transform":[10.0,0.0,369190.0,0.0,-10.0,5838410.0],"bands":[{_BANDS}]}}' AS item FROM m""")
def product_items(spark: SparkSession, d: str) -> DataFrame:
    """SNK-07: metadata rows as JSON."""
    return sinks.product_item(v.pixels(spark, d), BANDS, 10.0, (369190.0, 5838410.0))


@query(f"""WITH {_MANIFEST} SELECT 'row' AS kind, source AS key, count(*) AS n FROM manifest WHERE role = 'anchor' GROUP BY source
UNION ALL SELECT 'pairing', '', count(*) FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey % 2 = 0
UNION ALL SELECT 'reported_anchors', '', count(*) FROM manifest WHERE role = 'anchor'
UNION ALL SELECT 'finding', rule, count(*) FROM (SELECT * FROM ({_MANIFEST_FINDINGS}) UNION SELECT * FROM ({_PAIRING_FINDINGS})) GROUP BY rule""")
def bundle_scan(spark: SparkSession, d: str) -> DataFrame:
    """SRC-02: a bundle, faults and all, found by the place of its manifest, restricted to a role and checked together."""
    folder = sinks.work_folder(spark, "bundle")
    manifest, pairings = _manifest(spark, d), _pairings(spark, d)
    manifest.write.parquet(f"{folder}/manifest.parquet")
    pairings.write.parquet(f"{folder}/pairings.parquet")
    sinks.bundle_report(manifest, pairings, {"policy_hash": "p1"}).write.json(f"{folder}/manifest_report.json")
    rows, pairs, report, findings = scans.bundle(spark, f"{folder}/manifest.parquet", ["anchor"])
    count = F.count(F.lit(1)).alias("n")
    none = F.lit("").alias("key")
    return (
        rows.groupBy(F.lit("row").alias("kind"), F.col("source").alias("key")).agg(count)
        .unionByName(pairs.agg(count).select(F.lit("pairing").alias("kind"), none, "n"))
        .unionByName(report.select(F.lit("reported_anchors").alias("kind"), none, F.col("counts.anchor_rows").alias("n")))
        .unionByName(findings.groupBy(F.lit("finding").alias("kind"), F.col("rule").alias("key")).agg(count))
    )


@query("""SELECT 'forbidden_object' AS rule, CAST(year(o_orderdate) AS VARCHAR) AS year, count(DISTINCT 1) AS n FROM orders GROUP BY 2""")
def object_listing(spark: SparkSession, d: str) -> DataFrame:
    """SRC-15: objects below a prefix by kind: text files among tables aren't allowed."""
    folder = sinks.work_folder(spark, "objects")
    orders = v.table(spark, d, "orders").withColumn("year", F.year("o_orderdate"))
    orders.repartition("year").write.partitionBy("year").parquet(f"{folder}/tables")
    orders.select("year", "o_orderkey").repartition("year").write.partitionBy("year").csv(f"{folder}/texts")
    found = scans.forbidden(scans.listing(spark, folder), [".csv"])
    return found.select("rule", F.regexp_extract("key", r"year=(\d+)", 1).alias("year")).groupBy("rule", "year").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT '{\"c_mktsegment\":\"' || c_mktsegment || '\",\"n\":' || count(*) || '}' AS summary FROM customer GROUP BY c_mktsegment")
def run_summary(spark: SparkSession, d: str) -> DataFrame:
    """SNK-03."""
    return sinks.run_summary(v.table(spark, d, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n")))


@query("SELECT y.year, r.vintage, 'dgm1-2021__lod2-' || r.vintage || '__vh-2020' AS geometry_id FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS year FROM orders) y LEFT JOIN (VALUES (2017, 1995, 1997), (2021, 1998, 2001)) r(vintage, lo, hi) ON y.year BETWEEN lo AND hi")
def published_mapping(spark: SparkSession, d: str) -> DataFrame:
    """SNK-08."""
    years = v.table(spark, d, "orders").select(F.year("o_orderdate").alias("year")).distinct()
    ranges = spark.createDataFrame([(2017, 1995, 1997), (2021, 1998, 2001)], "vintage int, lo int, hi int")
    artifacts = ranges.select("vintage", F.lit("horizon").alias("kind"))
    return sinks.geometry_mapping(years, ranges, labels.geometry_id(F.col("vintage")), artifacts, ["horizon"])


@query("""WITH p AS (SELECT user_id AS tile, CAST(event_id % 97 AS DOUBLE) AS x, 0.5e0 AS y FROM events), s AS (SELECT tile, x - lag(x) OVER (PARTITION BY tile ORDER BY x) AS dx FROM (SELECT DISTINCT tile, x FROM p)), m AS (SELECT tile, median(dx) AS d FROM s GROUP BY 1)
SELECT 'spacing' AS rule, CAST(tile AS VARCHAR) AS key FROM m WHERE abs(d - 1) > 1e-6 UNION ALL SELECT 'extent', CAST(tile AS VARCHAR) FROM (SELECT tile, min(x) AS x0 FROM p GROUP BY 1) WHERE abs(x0) > 1""")
def point_findings(spark: SparkSession, d: str) -> DataFrame:
    """SRC-08, WN-08."""
    e = v.table(spark, d, "events")
    p = e.select(F.col("user_id").alias("tile"), (F.col("event_id") % 97).cast("double").alias("x"), F.lit(0.5).alias("y"), F.lit(1.0).alias("z"), F.lit(0.0).alias("ox"), F.lit(0.0).alias("oy"))
    return scans.point_findings(p, ["tile"], "ox", "oy").select("rule", "key")


@query(f"""WITH {v.HOURLY} SELECT 'variable_missing' AS rule, x AS detail FROM (VALUES ('t2m'), ('d2m'), ('u10'), ('v10'), ('tp')) t(x)""")
def series_findings(spark: SparkSession, d: str) -> DataFrame:
    """SRC-13."""
    return weather_series.series_findings(v.hourly_series(spark, d), ["cell"]).select("rule", "detail")


@query("SELECT o_orderkey, round(coalesce(o_totalprice / 600000, 0) + coalesce((o_custkey % 7) / 7e0, 0), 6) AS risk FROM orders ORDER BY o_totalprice / 600000 + (o_custkey % 7) / 7e0 DESC, o_orderkey LIMIT 40")
def evidence_by_risk(spark: SparkSession, d: str) -> DataFrame:
    """PRJ-24, ST-03."""
    o = v.table(spark, d, "orders")
    o = o.withColumn("risk", spectral.risk(F.col("o_totalprice") / 600000, (F.col("o_custkey") % 7) / F.lit(7.0)))
    return sampling.top_risk(o, "risk", ["o_orderkey"], 40).select("o_orderkey", F.round("risk", 6).alias("risk"))
