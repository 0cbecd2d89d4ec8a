"""Writers: bundles, reports, gated and immutable products (SNK-01 .. SNK-09)."""

from __future__ import annotations

import uuid
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latticeframe.functions.contracts import LayerContract, enforce
from latticeframe.functions.hashes import fingerprint_columns, table_fingerprint
from latticeframe.functions.lattice import morton
from latticeframe.operators import checks
from latticeframe.operators.inventory import completeness, in_range
from latticeframe.sources.work import work_folder  # noqa: F401


class NotPublishable(ValueError):
    """A product broke its own rules; nothing was marked."""


def _first(findings: DataFrame, n: int = 20) -> list[str]:
    """The first few findings, for an error message."""
    return [f"{r['rule']}: {r['key']}" for r in findings.limit(n).collect()]


def write_bundle(manifest: DataFrame, pairings: DataFrame, folder: str, facts: dict[str, str]) -> DataFrame:
    """SNK-01: both tables, checked before anything is written, and a report with their hashes and counts."""
    errors = checks.union(checks.manifest_findings(manifest), checks.pairing_findings(pairings, manifest)).filter(
        ~F.col("rule").startswith("warning")
    )
    if said := _first(errors):
        raise NotPublishable("; ".join(said))
    manifest.write.mode("errorifexists").parquet(f"{folder}/manifest.parquet")
    pairings.write.mode("errorifexists").parquet(f"{folder}/pairings.parquet")
    report = bundle_report(manifest, pairings, facts)
    report.write.mode("errorifexists").json(f"{folder}/manifest_report.json")
    return report


def bundle_report(manifest: DataFrame, pairings: DataFrame, facts: dict[str, str]) -> DataFrame:
    """AG-07, SNK-09: one row with hashes, counts and the given facts (policy hash, cutoff, versions)."""
    counts = manifest.agg(
        *(F.count_if(F.col("role") == r).alias(f"{r}_rows") for r in checks.ROLES),
        *(F.count_distinct(F.when(F.col("source") == s, F.col("scene_id"))).alias(s.replace("-", "_")) for s in checks.SOURCES),
    )
    m, p = table_fingerprint(manifest), table_fingerprint(pairings)
    one = counts.select(F.struct(*counts.columns).alias("counts"))
    # Three single rows
    return (
        one.join(F.broadcast(m.select(F.col("row_hash_sum").alias("manifest_hash"))))
        .join(F.broadcast(p.select(F.col("row_hash_sum").alias("pairings_hash"), F.col("n_rows").alias("pairings_rows"))))
        .select("*", *(F.lit(v).alias(k) for k, v in facts.items()), F.lit(0).alias("unresolved_errors"))
    )


def write_table_with_twin(df: DataFrame, path: str) -> None:
    """SNK-02: Parquet, and the same rows as CSV with maps and arrays as JSON."""
    df.write.mode("errorifexists").parquet(f"{path}.parquet")
    flat = [F.to_json(c).alias(c) if t.startswith(("map", "array", "struct")) else F.col(c) for c, t in df.dtypes]
    df.select(*flat).write.mode("errorifexists").option("header", True).csv(f"{path}.csv")


def run_summary(rows: DataFrame) -> DataFrame:
    """SNK-03: each row as one JSON text."""
    return rows.select(F.to_json(F.struct("*")).alias("summary"))


def write_observed(df: DataFrame, path: str, rules: dict[str, Column] | None = None) -> dict[str, int | str]:
    """Write `df` to a new folder, and what the writing pass saw: `n_rows`, `row_hash_sum` and rows breaking each rule.

    Rules are conditions that rows must meet (NULL doesn't). The source is computed once, so it may be one that gives
    other rows each time.
    """
    seen = Observation(f"written-{uuid.uuid4().hex}")
    counts = [F.count_if(~F.coalesce(rule, F.lit(False))).alias(f"broken_{name}") for name, rule in (rules or {}).items()]
    df.observe(seen, *fingerprint_columns(df), *counts).write.mode("errorifexists").parquet(path)
    return dict(seen.get)


def _broken(seen: dict) -> list[str]:
    return [f"{name.removeprefix('broken_')}: {n} rows" for name, n in seen.items() if name.startswith("broken_") and n]


def publish(df: DataFrame, folder: str, product: str, key: str, run_id: str, findings: DataFrame | None = None, rules: dict[str, Column] | None = None) -> None:
    """SNK-04: data first, then the checks, and the marker last; readers trust marked products only.

    Each call writes a folder of its own, which the marker names, so a refused run never touches what was published.
    `rules` are counted in the pass that writes; `findings` are tables of their own, and cost passes of their own.
    """
    if not product or not key:
        raise ValueError("a product and a key need names")
    run = f"{run_id}-{uuid.uuid4().hex}"
    where = "/".join(f"{name}={quote(x, safe='')}" for name, x in (("product", product), ("key", key), ("run", run)))
    said = _broken(write_observed(df, f"{folder}/data/{where}", rules))
    if said := said + (_first(findings) if findings is not None else []):
        raise NotPublishable("; ".join(said))
    spark = df.sparkSession
    earlier = 0
    if _exists(spark, f"{folder}/markers"):
        earlier = spark.read.schema(_MARKER).parquet(f"{folder}/markers").filter((F.col("product") == product) & (F.col("key") == key)).count()
    marker = spark.range(1).select(
        F.lit(product).alias("product"), F.lit(key).alias("key"), F.lit(run).alias("run"), F.lit(earlier).cast("long").alias("sequence"), F.current_timestamp().alias("completed_at")
    )
    marker.write.mode("append").parquet(f"{folder}/markers")


_MARKER = "product string, key string, run string, sequence long, completed_at timestamp"


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def published(spark: SparkSession, folder: str) -> DataFrame:
    """SNK-04: rows of marked products, of the run that was marked last (of equal times, the one of more markers before it).

    Names of products, keys and runs stay as they were given: `007`, `1e3` and `2024-01-01` are texts.
    """
    names = ("product", "key", "run")
    reader = spark.read.option("basePath", f"{folder}/data")
    found = reader.parquet(f"{folder}/data").schema
    told = T.StructType([T.StructField(f.name, T.StringType() if f.name in names else f.dataType, True) for f in found])
    data = reader.schema(told).parquet(f"{folder}/data")
    marks = spark.read.schema(_MARKER).parquet(f"{folder}/markers").groupBy("product", "key")
    last = F.max_by("run", F.struct("completed_at", F.coalesce("sequence", F.lit(-1)), "run"))
    return data.join(marks.agg(last.alias("run")), list(names), "left_semi").select(*data.columns)


def publish_once(df: DataFrame, path: str, check, rules: dict[str, Column] | None = None) -> DataFrame:
    """SNK-05: fails if the target is there; what is read back must be what the writing pass saw, and pass the check."""
    seen = write_observed(df, path, rules)
    again = df.sparkSession.read.parquet(path)
    if (seen["n_rows"], seen["row_hash_sum"]) != tuple(table_fingerprint(again).first()):
        raise NotPublishable(f"{path} isn't what was written")
    if said := _broken(seen) + _first(check(again)):
        raise NotPublishable("; ".join(said))
    return again


def write_pixels(df: DataFrame, contracts: list[LayerContract], path: str, tile: int = 1024) -> None:
    """SNK-06: declared columns and types, files by scene, cells in the order of a space-filling curve.

    Rows are range-partitioned on scene and Morton key, and sorted by it, so each file, row group and page covers a
    compact piece of the grid and its least and largest row and column let a window skip it. No file holds more than
    `tile` x `tile` cells. Cells off the grid (negative or NULL addresses) come first in their scene.

    The ranges are sampled from `df`, which is computed once more for it; a dear source is better stored before.
    """
    rows = enforce(df, contracts, ["scene_id", "row", "col"])
    at = morton(F.col("row"), F.col("col"))
    dealt = rows.repartitionByRange("scene_id", at).sortWithinPartitions("scene_id", at)
    dealt.write.mode("overwrite").option("maxRecordsPerFile", tile * tile).partitionBy("scene_id").parquet(path)


def product_item(rows: DataFrame, contracts: list[LayerContract], resolution: float, origin: tuple[float, float], crs: str = "EPSG:25833") -> DataFrame:
    """SNK-07: one metadata row per scene: shape, transform, box, bands; NaN as nodata is spelled out."""
    told = rows.groupBy("scene_id").agg((F.max("row") + 1).alias("rows"), (F.max("col") + 1).alias("cols"))
    x0, y0 = origin
    bands = F.array(
        *(F.struct(F.lit(c.name).alias("name"), F.lit(c.dtype).alias("dtype"), F.lit(c.unit).alias("unit"), F.lit("nan").alias("nodata")) for c in contracts)
    )
    box = F.array(F.lit(x0), F.lit(y0) - F.col("rows") * resolution, F.lit(x0) + F.col("cols") * resolution, F.lit(y0))
    grid = F.array(F.lit(resolution), F.lit(0.0), F.lit(x0), F.lit(0.0), F.lit(-resolution), F.lit(y0))
    return told.select("scene_id", F.to_json(F.struct(F.lit(crs).alias("crs"), "rows", "cols", box.alias("bbox"), grid.alias("transform"), bands.alias("bands"))).alias("item"))


def geometry_mapping(years: DataFrame, ranges: DataFrame, geometry: Column, artifacts: DataFrame, kinds: list[str]) -> DataFrame:
    """SNK-08: `year, vintage, geometry_id`, only if every vintage's artifacts are complete."""
    lost = completeness(ranges.select("vintage"), kinds, artifacts, ["vintage"])
    if said := [f"{r['vintage']}/{r['kind']}" for r in lost.limit(20).collect()]:
        raise NotPublishable("incomplete: " + ", ".join(said))
    return in_range(years, ranges, "year").select("year", "vintage", geometry.alias("geometry_id"))
