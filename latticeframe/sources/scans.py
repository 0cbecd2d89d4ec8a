"""Readers: strict tables, bundles, documents, listings, points, catalogues (SRC-01 .. SRC-17)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latticeframe.functions.labels import platform
from latticeframe.operators import checks


class SchemaMismatch(ValueError):
    """A table isn't of its declared schema."""


def _kinds(schema: T.StructType) -> list[tuple[str, T.DataType]]:
    return [(f.name, f.dataType) for f in schema]


def strict_table(spark: SparkSession, path: str, schema: T.StructType, missing_ok: bool = True) -> DataFrame:
    """SRC-01: a Parquet table of exactly this schema; a table that isn't there is an empty one."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException as e:
        if missing_ok and e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return spark.createDataFrame([], schema)
        raise
    if _kinds(df.schema) != _kinds(schema):
        raise SchemaMismatch(f"{path}: {df.schema.simpleString()}, not {schema.simpleString()}")
    return df


def bundle(spark: SparkSession, manifest_path: str, roles: list[str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """SRC-02: manifest, pairings and report that lie side by side, and what is wrong with them."""
    folder = manifest_path.rpartition("/")[0]
    manifest, pairings = spark.read.parquet(manifest_path), spark.read.parquet(f"{folder}/pairings.parquet")
    report = json_documents(spark, f"{folder}/manifest_report.json")
    findings = checks.union(checks.manifest_findings(manifest), checks.pairing_findings(pairings, manifest))
    if roles is not None:
        manifest = manifest.filter(F.col("role").isin(*roles))
    return manifest, pairings, report, findings


def json_documents(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """SRC-03: whole-file JSON; fields that a declared schema names and a document lacks are NULL."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def geometry_mapping(documents: DataFrame) -> DataFrame:
    """SRC-03: `year, vintage, geometry_id` of a mapping (maps `year_to_vintage` and `vintages`)."""
    years = documents.select(F.explode("year_to_vintage").alias("year", "vintage"), "vintages")
    found = F.element_at("vintages", F.col("vintage").cast("string"))
    return years.select(F.col("year").cast("int"), F.col("vintage").cast("int"), found["geometry_id"].alias("geometry_id"))


def csv_twin(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """SRC-04."""
    return spark.read.option("header", True).schema(schema).csv(path)


def listing(spark: SparkSession, path: str) -> DataFrame:
    """SRC-15: `path, length` of all objects below a prefix; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", "length")


def forbidden(objects: DataFrame, suffixes: list[str]) -> DataFrame:
    """SRC-15: objects of kinds that must not be there."""
    bad = F.lit(False)
    for s in suffixes:
        bad = bad | F.lower("path").endswith(s.lower())
    return checks.when(objects, "forbidden_object", bad, F.col("path"))


def points(spark: SparkSession, path: str) -> DataFrame:
    """SRC-08: X Y Z rows of text."""
    return spark.read.option("sep", " ").schema("x double, y double, z double").csv(path)


def point_findings(df: DataFrame, keys: list[str], origin_x: str, origin_y: str, size: float = 1000.0, spacing: float = 1.0) -> DataFrame:
    """SRC-08 per tile: it isn't empty, its spacing is right along both axes, and it lies at its corner."""

    def median_step(axis: str) -> DataFrame:
        w = W.partitionBy(*keys).orderBy(axis)
        steps = df.select(*keys, axis).distinct().withColumn("d", F.col(axis) - F.lag(axis).over(w))
        return steps.groupBy(*keys).agg(F.percentile("d", 0.5).alias(f"d{axis}"))

    told = df.groupBy(*keys).agg(
        F.count("z").alias("n"), F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"),
        F.first(origin_x).alias("ox"), F.first(origin_y).alias("oy"),
    )
    told = told.join(median_step("x"), keys, "left").join(median_step("y"), keys, "left")
    off = lambda a, b: F.abs(F.col(a) - F.col(b)) > 1
    far = (F.col("x1") - F.col("ox") > size + 1) | (F.col("y1") - F.col("oy") > size + 1)
    rules = {
        "tile_empty": F.col("n") == 0,
        "spacing": (F.abs(F.col("dx") - spacing) > 1e-6) | (F.abs(F.col("dy") - spacing) > 1e-6),
        "extent": off("x0", "ox") | off("y0", "oy") | far,
    }
    return checks.several(told, F.concat_ws("/", *keys), rules)


def search(
    catalogue: DataFrame,
    collections: list[str] | None = None,
    box: tuple[float, float, float, float] | None = None,
    since: str | None = None,
    until: str | None = None,
    ids: list[str] | None = None,
    max_cloud: float | None = 20.0,
    max_items: int | None = None,
) -> DataFrame:
    """SRC-09: items of a catalogue table (item_id, collection, acq, min_x .. max_y, cloud_cover) by the usual filters."""
    q = catalogue
    if collections is not None:
        q = q.filter(F.col("collection").isin(*collections))
    if ids is not None:
        q = q.filter(F.col("item_id").isin(*ids))
    if box is not None:
        x0, y0, x1, y1 = box
        q = q.filter((F.col("min_x") <= x1) & (F.col("max_x") >= x0) & (F.col("min_y") <= y1) & (F.col("max_y") >= y0))
    if since is not None:
        q = q.filter(F.col("acq").cast("timestamp") >= F.lit(since).cast("timestamp"))
    if until is not None:
        q = q.filter(F.col("acq").cast("timestamp") <= F.lit(until).cast("timestamp"))
    if max_cloud is not None:
        q = q.filter(F.col("cloud_cover") < max_cloud)
    return q if max_items is None else q.orderBy("acq", "item_id").limit(max_items)


def season_anchors(items: DataFrame, platforms: list[str], months: list[int], years: list[int], cutoff: str | None = None) -> DataFrame:
    """PRJ-12: items of allowed platforms, months and years, not after the cutoff; without a time they are dropped."""
    t = F.col("acq").cast("timestamp")
    keep = t.isNotNull() & F.col("platform").isin(*platforms) & F.month(t).isin(*months) & F.year(t).isin(*years)
    if cutoff is not None:
        keep = keep & (t <= F.lit(cutoff).cast("timestamp"))
    return items.filter(keep).orderBy("acq", "scene_id")


def clear_gate(items: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """PRJ-13: (kept, dropped) by clear fraction; a missing one is dropped."""
    ok = F.coalesce(F.col("clear_frac") >= least, F.lit(False))
    return items.filter(ok), items.filter(~ok)


def anchors(manifest: DataFrame, years: list[int] | None = None, scene_ids: list[str] | None = None, role: str | None = None) -> DataFrame:
    """SRC-16: anchor rows by explicit ids, else by years; the given role stands in for theirs, and the day of year."""
    rows = manifest.filter(F.col("source") == checks.SOURCES[0])
    if scene_ids is not None:
        rows = rows.filter(F.col("scene_id").isin(*scene_ids))
    elif years is not None:
        rows = rows.filter(F.col("year").isin(*years))
    rows = rows.withColumn("day_of_year", F.dayofyear("acquisition_datetime"))
    return rows if role is None else rows.withColumn("role", F.coalesce(F.lit(role), F.col("role")))


def granules(ids: DataFrame, column: str = "granule_id") -> tuple[DataFrame, DataFrame]:
    """SRC-17: (parsed, unparseable): acquisition time and tile from allowed granule ids."""
    stamp = F.regexp_extract(column, r"_(\d{8}T\d{6})_", 1)
    t = F.try_to_timestamp(F.nullif(stamp, F.lit("")), F.lit("yyyyMMdd'T'HHmmss"))
    parsed = ids.withColumns({"acq": t, "tile": F.get(F.split(column, "_"), F.lit(5)), "allowed": F.col(column).isin(*checks.GRANULES)})
    return parsed.filter("acq is not null and allowed").drop("allowed"), parsed.filter("acq is null or not allowed")


def with_platform(items: DataFrame) -> DataFrame:
    """PRJ-11."""
    return items.withColumn("platform", platform(F.col("scene_id")))


def named_year(column: str) -> Column:
    """AG-23: the year of an eight-digit date part of an id."""
    return F.nullif(F.regexp_extract(column, r"_(\d{4})\d{4}_", 1), F.lit("")).cast("int")
