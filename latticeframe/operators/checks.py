"""Contract and quality checks: each returns findings `rule, key, detail`; no rows means it holds (VAL-01 .. VAL-19)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latticeframe.functions.contracts import LayerContract
from latticeframe.functions.lattice import GridSpec
from latticeframe.functions.nulls import value
from latticeframe.operators.inventory import duplicate_keys, key_difference, orphans

FINDINGS = "rule string, key string, detail string"
# Domains of the manifest, and the granules that validation must hold.
SOURCES = ("landsat-c2-l2", "sentinel-2-l2a", "ecostress")
ROLES = ("anchor", "predictor", "validation")
PLATFORMS = ("landsat-8", "landsat-9")
GRANULES = tuple(
    f"ECOv002_L2T_LSTE_{orbit}_{tile}_20180825T{time}_0712_01"
    for orbit, time in (("00770_009", "082058"), ("00771_005", "095710"))
    for tile in ("32UQD", "33UUU", "33UVU")
)
REPORT_KEYS = "bundle_id generated_at cutoff_utc policy_hash schema_version manifest_hash pairings_hash counts unresolved_errors".split()
LEAST_CLEAR = 0.05


def none(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], FINDINGS)


def when(df: DataFrame, rule: str, condition: Column, key: Column, detail: Column | None = None) -> DataFrame:
    """One finding per row for which the condition holds."""
    said = F.lit("") if detail is None else detail.cast("string")
    return df.filter(F.coalesce(condition, F.lit(False))).select(F.lit(rule).alias("rule"), key.cast("string").alias("key"), said.alias("detail"))


def several(df: DataFrame, key: Column, rules: dict[str, Column]) -> DataFrame:
    """Many row rules in one pass over the table: each row yields the names of the rules that it breaks."""
    broken = F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in rules.items())))
    return df.select(F.explode(broken).alias("rule"), key.cast("string").alias("key"), F.lit("").alias("detail"))


def union(*findings: DataFrame) -> DataFrame:
    """ST-04: distinct findings in order."""
    return reduce(DataFrame.unionByName, findings).distinct().orderBy("rule", "key", "detail")


def schema_findings(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns that are missing, extra or of another type."""
    have, want = {f.name: f.dataType for f in df.schema}, {f.name: f.dataType for f in schema}
    rows = [("column_missing", n, t.simpleString()) for n, t in want.items() if n not in have]
    rows += [("column_extra", n, t.simpleString()) for n, t in have.items() if n not in want]
    rows += [("column_type", n, have[n].simpleString()) for n in want if n in have and have[n] != want[n]]
    return df.sparkSession.createDataFrame(rows, FINDINGS)


def manifest_findings(manifest: DataFrame, require_href: bool = True) -> DataFrame:
    """VAL-01."""
    src, sid, role, clear = F.col("source"), F.col("scene_id"), F.col("role"), value("aoi_clear_frac")
    gated = role.isin("anchor", "predictor")
    blank = F.trim(F.coalesce("item_href", F.lit(""))) == ""
    rules = {
        "source_unknown": ~F.coalesce(src.isin(*SOURCES), F.lit(False)),
        "role_unknown": ~F.coalesce(role.isin(*ROLES), F.lit(False)),
        "platform_unknown": (src == SOURCES[0]) & ~F.coalesce(F.col("platform").isin(*PLATFORMS), F.lit(False)),
        "granule_not_allowed": (src == SOURCES[2]) & ~sid.isin(*GRANULES),
        "granule_role": (src == SOURCES[2]) & (role != "validation"),
        "clear_fraction_missing": gated & clear.isNull(),
        "clear_fraction_low": gated & (clear < LEAST_CLEAR),
        "href_missing": F.lit(require_href) & src.isin(*SOURCES[:2]) & blank,
    }
    key = F.concat_ws("/", src, sid)
    twice = duplicate_keys(manifest, ["source", "scene_id"]).select(
        F.lit("duplicate_key").alias("rule"), key.alias("key"), F.col("n").cast("string").alias("detail")
    )
    wanted = manifest.sparkSession.createDataFrame([(g,) for g in GRANULES], "scene_id string")
    absent = orphans(wanted, manifest.filter(src == SOURCES[2]), "scene_id", "scene_id")
    empty = manifest.agg(F.count(F.lit(1)).alias("n")).filter("n = 0")
    return union(
        several(manifest, key, rules),
        twice,
        absent.select(F.lit("granule_missing").alias("rule"), F.col("scene_id").alias("key"), F.lit("").alias("detail")),
        empty.select(F.lit("manifest_empty").alias("rule"), F.lit("").alias("key"), F.lit("").alias("detail")),
    )


def pairing_findings(pairings: DataFrame, manifest: DataFrame) -> DataFrame:
    """VAL-02: foreign keys, duplicates, counts in range, and a fraction that its counts give back in float32."""
    src = F.col("source")
    anchors = manifest.filter((src == SOURCES[0]) & (F.col("role") == "anchor"))
    predictors = manifest.filter(src == SOURCES[1])
    lcf, jcp, jcf = F.col("landsat_clear_px"), F.col("joint_clear_px"), F.col("joint_clear_frac").cast("double")
    counted = F.coalesce(lcf > 0, F.lit(False))
    joint = F.coalesce((jcp >= 0) & (jcp <= lcf), F.lit(False))
    ranged = F.coalesce(jcf.between(0.0, 1.0), F.lit(False))
    again = F.abs(F.try_divide(jcp.cast("double"), lcf.cast("double")).cast("float").cast("double") - jcf.cast("float").cast("double"))
    rules = {
        "clear_count": ~counted,
        "joint_count": counted & ~joint,
        "joint_fraction": counted & joint & ~ranged,
        "fraction_mismatch": counted & joint & ranged & (again > 1e-7),
    }
    key = F.col("landsat_scene_id")

    def orphan(rule: str, rows: DataFrame, column: str) -> DataFrame:
        return rows.select(F.lit(rule).alias("rule"), F.col(column).alias("key"), F.lit("").alias("detail"))

    return union(
        several(pairings, key, rules),
        orphan("anchor_unknown", orphans(pairings, anchors, "landsat_scene_id", "scene_id"), "landsat_scene_id"),
        orphan("predictor_unknown", orphans(pairings, predictors, "sentinel2_scene_id", "scene_id"), "sentinel2_scene_id"),
        orphan("warning_anchor_unpaired", orphans(anchors, pairings, "scene_id", "landsat_scene_id"), "scene_id"),
        duplicate_keys(pairings, ["landsat_scene_id"]).select(
            F.lit("duplicate_anchor").alias("rule"), F.col("landsat_scene_id").alias("key"), F.col("n").cast("string").alias("detail")
        ),
    )


def report_findings(report: DataFrame, manifest_hash: str, pairings_hash: str) -> DataFrame:
    """VAL-03 on a one-row report with a string map `report`."""
    r = F.col("report")
    absent = report.select(F.explode(F.array_except(F.array(*map(F.lit, REPORT_KEYS)), F.map_keys(r))).alias("key"))
    rules = {
        "unresolved_errors": r["unresolved_errors"].cast("long") > 0,
        "manifest_hash": r["manifest_hash"] != manifest_hash,
        "pairings_hash": r["pairings_hash"] != pairings_hash,
    }
    return union(
        absent.select(F.lit("report_key_missing").alias("rule"), "key", F.lit("").alias("detail")), several(report, F.lit("report"), rules)
    )


def grid_findings(meta: DataFrame, grid: GridSpec, bands: int, dtype: str) -> DataFrame:
    """VAL-04 on one row per product: crs, bands, dtype, rows, cols, origin_x, origin_y."""
    off = lambda c, x: F.abs(F.col(c) - x) > 0.01
    rules = {
        "crs": F.col("crs") != "EPSG:25833",
        "band_count": F.col("bands") != bands,
        "dtype": F.col("dtype") != dtype,
        "shape": (F.col("rows") != grid.rows) | (F.col("cols") != grid.cols),
        "origin": off("origin_x", grid.origin_x) | off("origin_y", grid.origin_y),
    }
    return several(meta, F.col("product"), rules)


def valid_share_findings(df: DataFrame, keys: list[str], column: str, least: float = 0.01) -> DataFrame:
    """VAL-05."""
    share = F.avg(value(column).isNotNull().cast("double"))
    told = df.groupBy(*keys).agg(share.alias("share"))
    return when(told, "valid_share", F.col("share") < least, F.concat_ws("/", *keys), F.round("share", 6))


def range_findings(df: DataFrame, contracts: list[LayerContract]) -> DataFrame:
    """VAL-06: layers with values out of range, and layers without any value."""
    aggs = []
    for c in contracts:
        v = value(c.name)
        aggs += [F.min(v).alias(f"{c.name}__lo"), F.max(v).alias(f"{c.name}__hi")]
    told = df.agg(*aggs)
    rows = F.array(
        *(
            F.struct(F.lit(c.name).alias("key"), F.col(f"{c.name}__lo").alias("lo"), F.col(f"{c.name}__hi").alias("hi"), F.lit(float(c.lo)).alias("least"), F.lit(float(c.hi)).alias("most"))
            for c in contracts
        )
    )
    told = told.select(F.explode(rows).alias("r")).select("r.*")
    return union(
        when(told, "no_valid_pixel", F.col("lo").isNull(), F.col("key")),
        when(told, "out_of_range", (F.col("lo") < F.col("least")) | (F.col("hi") > F.col("most")), F.col("key"), F.concat_ws("..", "lo", "hi")),
    )


def fill_equivalence(df: DataFrame, keys: list[str], column: str, fill: Column) -> DataFrame:
    """VAL-07: pixels where a missing value and the fill flag disagree."""
    told = df.groupBy(*keys).agg(F.count_if(value(column).isNull() != fill).alias("n"))
    return when(told, "fill_mismatch", F.col("n") > 0, F.concat_ws("/", *keys), F.col("n"))


def mask_findings(mismatches: DataFrame, keys: list[str]) -> DataFrame:
    """VAL-08: from the counts of `grids.mask_mismatches`."""
    names = ["bad_mask_px", "valid_but_missing_px", "finite_under_mask_px", "valid_outside_px"]
    return several(mismatches, F.concat_ws("/", *keys), {n.removesuffix("_px"): F.col(n) > 0 for n in names})


def sidecar_findings(sidecars: DataFrame, channels: list[str], version: int) -> DataFrame:
    """VAL-09 on parsed sidecars: completed_at, run_id, channels (array), schema_version, assets (array)."""
    rules = {
        "marker_time": F.to_timestamp(F.col("completed_at")).isNull() if dict(sidecars.dtypes)["completed_at"] != "string" else F.expr("try_to_timestamp(completed_at)").isNull(),
        "marker_run": F.trim(F.coalesce("run_id", F.lit(""))) == "",
        "channel_order": ~F.col("channels").eqNullSafe(F.array(*map(F.lit, channels))),
        "version": ~F.col("schema_version").eqNullSafe(F.lit(version)),
        "assets": F.coalesce(F.size("assets"), F.lit(0)) < 1,
    }
    return several(sidecars, F.col("scene_id"), rules)


def map_sum(m: Column) -> Column:
    return F.aggregate(F.map_values(m), F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))


def scene_report_findings(scenes: DataFrame, labels: list[str]) -> DataFrame:
    """VAL-10: arithmetic of a stage-1 scene table."""
    t, a, f, h = (F.col(c) for c in ("target_valid_cells", "all_100_cells", "full_support_cells", "support_histogram"))
    seen = F.col("assessed")
    rules = {
        "all_children_above_target": seen & (a > t),
        "full_support_above_target": seen & (f > t),
        "histogram_sum": seen & (map_sum(h) != t),
        "histogram_label": seen & (F.size(F.array_except(F.map_keys(h), F.array(*map(F.lit, labels)))) > 0),
        "fraction_range": seen & ~F.coalesce(F.col("support_mean_frac").between(0, 1), t == 0),
        "assessed_with_reason": seen & F.col("exclusion_reason").isNotNull(),
        "excluded_without_reason": ~seen & F.col("exclusion_reason").isNull(),
    }
    return several(scenes, F.col("scene_id"), rules)


def total_findings(scenes: DataFrame, total: int) -> DataFrame:
    """VAL-10, VAL-14: assessed and excluded scenes make up the expected number."""
    told = scenes.agg(F.count(F.lit(1)).alias("n"))
    return when(told, "scene_count", F.col("n") != total, F.lit("scenes"), F.col("n"))


def profile_findings(profiles: DataFrame, scenes: DataFrame, channels: list[str]) -> DataFrame:
    """VAL-11: every assessed scene has all channels once, in numbered bins whose counts add up."""
    want = scenes.filter("assessed").select("scene_id")
    got = profiles.groupBy("scene_id").agg(
        F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_set("channel_index")).alias("idx")
    )
    joined = want.join(got, "scene_id", "left")
    full = F.array(*(F.lit(i) for i in range(len(channels))))
    rules = {
        "channel_count": ~F.col("n").eqNullSafe(F.lit(len(channels))),
        "channel_index": ~F.col("idx").eqNullSafe(full),
    }
    numeric = F.forall(F.map_keys("histogram"), lambda k: k.rlike("^[0-9]+$"))
    bins = {"histogram_sum": map_sum(F.col("histogram")) != F.col("valid_px"), "histogram_key": ~numeric}
    return union(several(joined, F.col("scene_id"), rules), several(profiles, F.concat_ws("/", "scene_id", "channel_name"), bins))


def ledger_findings(ledger: DataFrame, expected: dict[str, int], role: str | None = None) -> DataFrame:
    """VAL-12: rows per source as expected, all done, the role there and equal."""
    told = ledger.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    want = ledger.sparkSession.createDataFrame(list(expected.items()), "source string, want long")
    joined = want.join(told, "source", "full_outer")
    rules = {"not_done": F.col("status") != "done", "status_missing": F.col("status").isNull()}
    if role is not None:
        rules |= {"role": ~F.col("role").eqNullSafe(F.lit(role))}
    return union(
        when(joined, "row_count", ~F.col("want").eqNullSafe(F.col("n")), F.col("source"), F.col("n")),
        several(ledger, F.concat_ws("/", "source", "item_id"), rules),
    )


def mapping_findings(mapping: DataFrame, years: tuple[int, int], ranges) -> DataFrame:
    """VAL-13 on (year, vintage, geometry_id): no year uncovered, no later vintage, each year within its vintage's range."""
    spark = mapping.sparkSession
    wanted = spark.range(years[0], years[1] + 1).select(F.col("id").cast("int").alias("year"))
    gaps = wanted.join(mapping.select("year"), "year", "left_anti")
    table = F.broadcast(spark.createDataFrame(list(ranges), "vintage int, lo int, hi int"))
    placed = mapping.join(table, "vintage", "left")
    return union(
        when(gaps, "year_uncovered", F.lit(True), F.col("year")),
        when(mapping, "vintage_after_year", F.col("vintage") > F.col("year"), F.col("year"), F.col("vintage")),
        when(placed, "year_outside_vintage", ~F.coalesce(F.col("year").between(F.col("lo"), F.col("hi")), F.lit(False)), F.col("year"), F.col("vintage")),
        when(mapping, "geometry_missing", F.coalesce("geometry_id", F.lit("")) == "", F.col("year")),
    )


def unexpected_exclusions(scenes: DataFrame, expected: list[str]) -> DataFrame:
    """VAL-15: a reason that nobody expected is a finding."""
    return when(scenes, "unexpected_exclusion", F.col("exclusion_reason").isNotNull() & ~F.col("exclusion_reason").isin(*expected), F.col("scene_id"), F.col("exclusion_reason"))


def precondition_findings(anchors: DataFrame, mapping: DataFrame, latest_year: int, current_year: int, cutoff: str | None) -> DataFrame:
    """VAL-18."""
    spark = anchors.sparkSession
    rows = [("cutoff_required", str(latest_year), "")] if latest_year >= current_year and not cutoff else []
    empty = anchors.agg(F.count(F.lit(1)).alias("n"))
    uncovered = anchors.select("year").distinct().join(mapping.select("year"), "year", "left_anti")
    return union(
        spark.createDataFrame(rows, FINDINGS),
        when(empty, "no_anchors", F.col("n") == 0, F.lit("anchors")),
        when(uncovered, "year_uncovered", F.lit(True), F.col("year")),
    )


def low_overlap(metrics: DataFrame, key: str, least: int = 50) -> DataFrame:
    """VAL-19."""
    return when(metrics, "warning_low_overlap", F.col("overlap_px") < least, F.col(key), F.col("overlap_px"))


def key_set_findings(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Both differences of two key sets as findings."""
    diff = key_difference(a, b, keys)
    return diff.select(F.concat(F.lit("only_"), "side").alias("rule"), F.concat_ws("/", *keys).alias("key"), F.lit("").alias("detail"))
