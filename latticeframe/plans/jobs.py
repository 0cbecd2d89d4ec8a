"""User-level jobs, each a composition of operators over DataFrames (JOB-01 .. JOB-11).

A job takes tables and returns tables; reading, writing and marking is done by `sources`, so any of them can run on
files, on streams' batches or on tables of a test.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latticeframe.functions import bits, lattice, spectral, weather
from latticeframe.functions.contracts import CHANNELS, LayerContract, all_valid, masked_stack, shadow_value
from latticeframe.functions.labels import cloudiness, season
from latticeframe.functions.nulls import value
from latticeframe.operators import checks, couple, grids, inventory, ledger, neighbourhood, sampling, shapes, terrain, weather_series
from latticeframe.sources import scans
from latticeframe.sources.work import few_broadcast
from latticeframe.sources.work import kept as stored

PIXEL = ["scene_id", "row", "col"]


@dataclass
class Bundle:
    manifest: DataFrame
    pairings: DataFrame
    dropped: DataFrame
    findings: DataFrame


def couple_scenes(anchors: DataFrame, candidates: DataFrame, validation: DataFrame, threshold: float, least_clear: float = 0.05, window_days: float = 3) -> Bundle:
    """JOB-01. anchors: scene_id, acq, platform, item_href, clear_frac; candidates the same with joint counts."""
    kept, thin = scans.clear_gate(anchors, least_clear)
    kept = kept.withColumnRenamed("clear_frac", "aoi_clear_frac")
    cand = candidates.withColumnRenamed("scene_id", "partner_id")
    cand = cand.select("partner_id", "acq", "clear_frac", "landsat_clear_px", "joint_clear_px")
    # Manifest, pairings, reasons and findings all start from this table
    carry = ("cand_acq", "landsat_clear_px", "joint_clear_px")
    matched = stored(couple.best_by_time(kept, cand, "scene_id", "partner_id", threshold, window_days=window_days, carry=carry), "matched")
    good = matched.filter("status = 'coupled'")
    # A row without a winner, or whose candidate has no name, is no pairing
    rows = good.filter("partner_id is not null")
    pairings = rows.select(
        F.col("scene_id").alias("landsat_scene_id"),
        F.col("partner_id").alias("sentinel2_scene_id"),
        F.abs(F.unix_seconds(F.col("cand_acq").cast("timestamp")) - F.unix_seconds(F.col("acq").cast("timestamp"))).alias("dt_seconds"),
        "landsat_clear_px",
        "joint_clear_px",
        F.col("clear_frac").cast("float").alias("joint_clear_frac"),
        F.col("score").cast("float").alias("score"),
    )
    used = couple.first_partner(rows.select("scene_id", "acq", "partner_id", "clear_frac"), "partner_id", "acq", "scene_id")
    used = stored(used.select(F.col("partner_id").alias("scene_id"), F.col("clear_frac").alias("aoi_clear_frac")), "used")

    def described(df: DataFrame, source: str) -> DataFrame:
        return df.withColumns({"source": F.lit(source), "year": F.year("acq")}).withColumnRenamed("acq", "acquisition_datetime")

    shared = ["scene_id", "acquisition_datetime", "source", "year", "platform", "item_href", "aoi_clear_frac"]
    a = described(scans.with_platform(good.select("scene_id", "acq", "item_href", "aoi_clear_frac")), checks.SOURCES[0]).select(*shared)
    p = described(candidates.select("scene_id", "acq", "item_href", "platform").join(used, "scene_id"), checks.SOURCES[1]).select(*shared)
    listed = couple.roles(a, p, validation)
    dropped = matched.filter("status <> 'coupled'").select("scene_id", "reason").unionByName(thin.select("scene_id", F.lit("below_clear_gate").alias("reason")))
    # Findings don't depend on the manifest's order, so they don't sort it
    findings = checks.union(checks.manifest_findings(listed), checks.pairing_findings(pairings, listed))
    return Bundle(couple.in_order(listed), pairings, dropped, findings)


def mask_scenes(raw: DataFrame, rows: int, cols: int, buffer: int = 2) -> tuple[DataFrame, DataFrame]:
    """JOB-02 for the thermal sensor: (pixels with flag and temperature, area metrics) from scene_id, row, col, dn, qa, inside."""
    near = neighbourhood.dilate(raw, ["scene_id"], bits.bit(F.col("qa"), 1) != 0, buffer)
    px = near.withColumn("flag", bits.thermal_flag(F.col("qa"), F.col("dn"), F.col("buffer")))
    px = px.withColumn("lst", bits.kelvin(F.col("dn"), F.col("flag"))).filter(F.col("row").between(0, rows - 1) & F.col("col").between(0, cols - 1))
    return px.drop("buffer"), grids.area_metrics(px, ["scene_id"], inside=F.col("inside"))


def mask_optical(raw: DataFrame, sun: DataFrame, rows: int, cols: int, height: float = 1000.0, resolution: float = 10.0) -> DataFrame:
    """JOB-02 for the optical sensor: flags with projected cloud shadow, and reflectances (scene_id, row, col, scl, B..).

    `sun` has one row per scene (azimuth, elevation); its shift is a column, so all scenes go through one plan.
    """
    far = F.lit(height) * F.tan(F.radians(90 - F.col("elevation")))
    up = (F.col("elevation") > 0.5) & (far >= 1)
    south, east = far * F.cos(F.radians("azimuth")), -far * F.sin(F.radians("azimuth"))
    cell = lambda m: F.when(up, F.floor(m / resolution + 0.5))
    moved = raw.join(sun.select("scene_id", cell(south).alias("dr"), cell(east).alias("dc")), "scene_id")
    dark = neighbourhood.shifted(moved, ["scene_id"], F.col("scl").isin(8, 9), F.col("dr"), F.col("dc"), rows, cols)
    px = raw.join(dark.withColumn("dark", F.lit(True)), PIXEL, "left").withColumn("flag", bits.class_flag(F.col("scl"), F.col("dark")))
    bands = {b: bits.reflectance(F.col(b), F.col("flag"), b in ("B11", "B12")) for b in raw.columns if b.startswith("B")}
    return px.withColumns(bands).drop("dark")


def static_sources(points: DataFrame, tile_keys: list[str], codes: DataFrame, vegetation: DataFrame, buildings: DataFrame) -> dict[str, DataFrame]:
    """JOB-03: terrain from points (x, y, z), imperviousness codes, vegetation heights (dm), building cells."""
    g = lattice.GridSpec()
    cells = points.withColumns({"row": g.row(F.col("y")), "col": g.col(F.col("x"))})
    return {
        "terrain": cells.groupBy("row", "col").agg(F.avg(value("z")).alias("terrain_height")),
        "imperviousness": codes.select("row", "col", spectral.imperviousness(F.col("code")).alias("imperviousness")),
        "vegetation": vegetation.select("row", "col", spectral.metres_of_decimetres(F.col("dm")).alias("vegetation_height")),
        "morphology": shapes.cell_stats(shapes.spread_area(buildings, "building_id", "area"), "height"),
    }


def static_derived(terrain_df: DataFrame, morphology: DataFrame, vegetation: DataFrame, cell: float = 10.0, radius_m: float = 200.0) -> dict[str, DataFrame]:
    """JOB-04: the three surface models, two horizons and the sky view of the combined one."""
    base = terrain_df.join(morphology.select("row", "col", "height_mean"), ["row", "col"], "left").join(vegetation, ["row", "col"], "left")
    b = spectral.surface(F.col("terrain_height"), F.col("height_mean"))
    g = spectral.surface(F.col("terrain_height"), F.col("vegetation_height"))
    dsm = base.select("row", "col", b.alias("building_dsm"), g.alias("vegetation_dsm"), spectral.highest(b, g).alias("combined_dsm"))
    return {
        "dsm": dsm,
        "horizon_building": terrain.horizon(dsm, [], "building_dsm", cell, radius_m),
        "horizon_vegetation": terrain.horizon(dsm, [], "vegetation_dsm", cell, radius_m),
        "svf": terrain.sky_view(dsm, [], "combined_dsm", cell),
    }


def vintage_morphology(new: DataFrame, old_pool: DataFrame, heights: DataFrame, threshold: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """JOB-05: shapes of a vintage that the older stock confirms, and their cell statistics.

    new, old_pool: building_id, tile_row, tile_col, row, col; heights: building_id, height, area.
    """
    pool = shapes.tile_pool(new.select("tile_row", "tile_col"), old_pool).select("row", "col", "building_id").distinct()
    judged = shapes.overlap_filter(new, pool.select("row", "col"), "building_id", threshold)
    kept = new.join(judged.filter("kept").select("building_id"), "building_id", "left_semi").join(heights, "building_id")
    return judged, shapes.cell_stats(shapes.spread_area(kept, "building_id", "area"), "height")


def dynamic_products(scenes: DataFrame, series: DataFrame, cell: list[str], horizon: DataFrame, sun: DataFrame) -> tuple[DataFrame, DataFrame]:
    """JOB-06: weather per scene (scene_id, acq, cell) and shadow masks from horizons and the sun's place."""
    # Cells that no scene asks for are left out first; all look-ups read one stored table
    cells = few_broadcast(stored(scenes.select(*cell).distinct(), "cells"))
    hourly = weather_series.hourly(series.join(cells, cell, "left_semi"), cell, "ssrd", "ssrd_h", 3600)
    hourly = stored(weather_series.hourly(hourly, cell, "tp", "tp_h", clamp=True), "hourly")
    sums = weather_series.at_targets(scenes, hourly.select(*cell, "ts", "ssrd_h", "tp_h"), "scene_id", cell, "ssrd_h", "tp_h")
    # A scene keeps its row through both look-ups, so no table of scenes is joined by id; one without an id finds nothing
    hour = F.when(F.col("scene_id").isNotNull(), weather.nearest_hour(F.col("__acq")))
    asked = sums.withColumnRenamed("acq", "__acq").withColumn("acq", hour)
    now = couple.nearest_in_time(asked, hourly.select(*cell, "ts", "t2m", "d2m", "u10", "v10", "ssrd_h"), "scene_id", tuple(cell))
    now = now.select(
        *(F.col("__acq").alias(c) if c == "acq" else F.col(c) for c in sums.columns),
        F.col("t2m").alias("t2m_scene"),
        F.col("ssrd_h").alias("ssrd_scene"),
        weather.vapour_pressure_deficit(F.col("t2m"), F.col("d2m")).alias("vpd_scene"),
        weather.wind_speed(F.col("u10"), F.col("v10")).alias("wind_speed_10m_scene"),
    )
    # One row per scene against the cells of its geometry; Spark broadcasts the scenes while they are few
    lit = horizon.join(sun, "geometry_id").select("scene_id", "row", "col", terrain.shadow(F.col("horizon"), F.col("azimuth"), F.col("elevation")).alias("shadow"))
    return now, lit


def feature_stacks(optical: DataFrame, static: DataFrame, dynamic: DataFrame, area: DataFrame, contracts: tuple[LayerContract, ...] = CHANNELS) -> tuple[DataFrame, DataFrame]:
    """JOB-07: (stack with mask, coverage) of co-registered layers.

    optical: scene_id, geometry_id, row, col, bands; static: geometry_id, row, col, layers; dynamic: scene_id and
    scene-wide weather, or pixel layers; area: row, col, inside.
    """
    px = optical.join(static, ["geometry_id", "row", "col"], "left")
    px = px.join(dynamic, PIXEL if "row" in dynamic.columns else ["scene_id"], "left")
    px = grids.inside_area(px, area)
    made = {
        "ndvi": spectral.normalised_difference("B08", "B04"),
        "ndwi_mcfeeters": spectral.normalised_difference("B03", "B08"),
        "ndbi": spectral.normalised_difference("B11", "B08"),
        "s2_broadband_albedo": spectral.weighted_sum(spectral.ALBEDO_WEIGHTS),
    } | {s: shadow_value(F.col(s)) for s in ("shadow_building", "shadow_vegetation") if s in px.columns}
    stack = masked_stack(px.withColumns(made), contracts, [*PIXEL, "inside"], F.col("inside"))
    per_scene = stack.groupBy("scene_id").agg(
        F.sum("feature_valid").alias("feature_valid_px"), F.count_if("inside").alias("inside_aoi_px")
    )
    return stack.drop("inside"), per_scene


def stage1_qa(px: DataFrame, contracts: list[LayerContract], target: DataFrame, rows: int, cols: int, reasons: DataFrame) -> dict[str, DataFrame]:
    """JOB-08: scene metrics and histograms, layer counters, exclusions and findings of raw inputs."""
    blocks = grids.block_support(px, ["scene_id"], all_valid(contracts), 10, rows, cols)
    coarse = target.select("scene_id", F.col("row").alias("brow"), F.col("col").alias("bcol"), F.col("valid").alias("target"))
    blocks = blocks.join(coarse, ["scene_id", "brow", "bcol"])
    scenes = grids.scene_support(blocks, ["scene_id"], F.col("target")).join(
        grids.support_histogram(blocks, ["scene_id"], F.col("target")), "scene_id", "left"
    )
    return {
        "scenes": scenes,
        "layers": grids.invalid_layers(px, ["scene_id"], contracts),
        "reasons": inventory.reason_counts(reasons, "exclusion_reason"),
        "findings": checks.union(checks.range_findings(px, contracts), checks.unexpected_exclusions(reasons, [])),
    }


def stage2_qa(stack: DataFrame, contracts: list[LayerContract], scenes: DataFrame) -> dict[str, DataFrame]:
    """JOB-09: channel profiles with histograms, mask rules and profile rules of finished stacks."""
    good = F.col("feature_valid") == 1
    profiles = grids.profile_with_histogram(stack, ["scene_id"], contracts, where=good)
    mismatches = grids.mask_mismatches(stack, ["scene_id"], contracts)
    findings = checks.union(checks.mask_findings(mismatches, ["scene_id"]), checks.profile_findings(profiles, scenes, [c.name for c in contracts]))
    return {"profiles": profiles, "mismatches": mismatches, "findings": findings}


def mask_audit(pairs: DataFrame, diagnostics: DataFrame, seed: int, n: int, keep: int) -> dict[str, DataFrame]:
    """JOB-10: a stratified sample of pairs, their diagnostics by risk, and quantile lines of the diagnostics."""
    cells = pairs.withColumns({"season": season(F.month("acq")), "cloud": cloudiness(F.col("cloud_cover"))})
    sample = sampling.stratified_sample(cells, ["season", "cloud"], "anchor_id", "partner_id", seed, n)
    told = sample.join(diagnostics, ["anchor_id", "partner_id"], "left")
    parts: list[Column] = [F.col(c) for c in ("missed_frac", "extra_frac", "hint_frac")]
    told = told.withColumn("risk", spectral.risk(*parts))
    lines = [sampling.quantile_line(told, [], c).withColumn("measure", F.lit(c)) for c in ("missed_frac", "extra_frac", "hint_frac")]
    out = lines[0]
    for line in lines[1:]:
        out = out.unionByName(line)
    return {"sample": sample, "index": told, "evidence": sampling.top_risk(told, "risk", ["anchor_id", "partner_id"], keep), "quantiles": out}


def validate_products(expected: DataFrame, book: DataFrame, artifacts: DataFrame, kinds: list[str], counts: dict[str, int]) -> DataFrame:
    """JOB-11: findings over a published product family: key sets, completeness, states."""
    lost = inventory.completeness(expected.select("item_id"), kinds, artifacts, ["item_id"])
    return checks.union(
        checks.key_set_findings(expected, book, ["item_id"]),
        checks.ledger_findings(book, counts),
        lost.select(F.lit("artifact_missing").alias("rule"), F.concat_ws("/", F.col("item_id").cast("string"), "kind").alias("key"), F.lit("").alias("detail")),
    )


def pending_work(work: DataFrame, log: DataFrame, keys: list[str], config_hash: str) -> DataFrame:
    """The shared head of all jobs: what is to be done now, by the latest ledger rows and the configuration hash."""
    book = ledger.latest(log, keys, ["updated_at"])
    todo = ledger.reconcile_by_hash(work, book, keys, F.col("n.config_hash") == config_hash, F.col("n.output_uri").isNotNull(), F.col("n.completion_uri").isNotNull())
    return todo.filter("action <> 'skip'")
