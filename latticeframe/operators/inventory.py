"""Inventories: which scenes can be assessed, and why not (JN-03 .. JN-10, JN-16, JN-21, AG-06, AG-26, SET-03)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latticeframe.operators import asof


#: Ranges that are broadcast
MOST_RANGES = 10_000
#: Different versions that become one array of constants
MOST_VERSIONS = 1000


def first_reason(*rules: tuple[Column, str]) -> Column:
    """The name of the first rule that holds; NULL if none does."""
    return F.coalesce(*(F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for c, name in rules))


def key_difference(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """JN-10, SET-03: keys on one side only, with `side` left or right."""
    left = a.select(*keys).distinct().withColumn("__l", F.lit(True))
    right = b.select(*keys).distinct().withColumn("__r", F.lit(True))
    both = left.join(right, keys, "full_outer").filter("__l is null or __r is null")
    return both.select(*keys, F.when(F.col("__l").isNull(), "right").otherwise("left").alias("side"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """AG-26."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """JN-03, JN-04: rows of `child` whose key isn't among the parents'; NULL keys are orphans.

    A task holds its share of the different parent keys only; a merge would sort the children as well, and Spark deals
    tasks by compressed size, which for keys is a small part of what they take in memory.
    """
    keys = parent.select(F.col(parent_key).alias("__k")).distinct().hint("shuffle_hash")
    return child.join(keys, F.col(child_key) == F.col("__k"), "left_anti")


def in_range(rows: DataFrame, ranges: DataFrame, column: str, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """JN-06: the range that holds each value, both ends included; rows without one stay, with NULLs.

    A table of a few ranges is broadcast once it is counted; more are joined on cells of their own size.
    """
    if ranges.limit(MOST_RANGES + 1).count() > MOST_RANGES:
        return asof.range_join(rows, ranges, column, lo, hi)
    c = F.col(column)
    return rows.join(F.broadcast(ranges), (c >= F.col(lo)) & (c <= F.col(hi)), "left")


def as_of(rows: DataFrame, versions: DataFrame, column: str, version: str) -> DataFrame:
    """The latest version not after each value, for any number of versions.

    A few become one array of constants, so nothing is joined at all; more are joined bucket by bucket.
    """
    distinct = versions.select(version).distinct().dropna()
    known = [r[version] for r in distinct.limit(MOST_VERSIONS + 1).collect()]
    if len(known) > MOST_VERSIONS:
        found = asof.as_of_join(rows, distinct.select(F.col(version).alias("__v")), column, "__v", payload="__found")
        return found.withColumn(version, F.col("__found.__v")).drop("__found")
    steps = F.array(*(F.lit(v) for v in known)).cast(T.ArrayType(versions.schema[version].dataType))
    return rows.withColumn(version, F.array_max(F.filter(steps, lambda v: v <= F.col(column))))


def completeness(keys: DataFrame, kinds: list[str], artifacts: DataFrame, on: list[str]) -> DataFrame:
    """JN-09: (key, kind) that no artifact covers."""
    wanted = keys.withColumn("kind", F.explode(F.array(*(F.lit(k) for k in kinds))))
    return wanted.join(artifacts.select(*on, "kind").distinct(), [*on, "kind"], "left_anti")


def carry_forward(rows: DataFrame, ledger: DataFrame, geometry_id: str) -> DataFrame:
    """JN-16: the one done row of a fixed geometry as constant columns; an error if there isn't exactly one."""
    found = ledger.filter((F.col("geometry_id") == geometry_id) & (F.col("status") == "done"))
    one = found.agg(F.count(F.lit(1)).alias("n"), F.first("output_uri").alias("carried_uri"), F.first("config_hash").alias("carried_hash"))
    one = one.select(
        F.when(F.col("n") == 1, F.col("carried_uri")).otherwise(F.raise_error(F.lit(f"not exactly one done row: {geometry_id}"))).alias("carried_uri"),
        "carried_hash",
    )
    return rows.join(F.broadcast(one))


def map_difference(declared: Column, found: DataFrame, recomputed: DataFrame) -> DataFrame:
    """JN-21: labels whose declared fingerprint isn't the recomputed one (`label, fingerprint`)."""
    told = found.select(F.explode(declared).alias("label", "declared"))
    both = told.join(recomputed.withColumnRenamed("fingerprint", "actual"), "label", "full_outer")
    return both.filter(~F.col("declared").eqNullSafe(F.col("actual")))


def reason_counts(rows: DataFrame, reason: str = "reason") -> DataFrame:
    """AG-06."""
    return rows.filter(F.col(reason).isNotNull()).groupBy(reason).agg(F.count(F.lit(1)).alias("n"))


def resolve_items(manifest: DataFrame, items: DataFrame) -> DataFrame:
    """SRC-10: the item of each row by exact href, else by id; `item` is NULL where neither is found."""
    by_href = items.select(F.col("href").alias("item_href"), F.col("item_id").alias("__by_href"), F.col("item_id").alias("__href_id"))
    by_id = items.select(F.col("item_id").alias("scene_id"), F.col("item_id").alias("__by_id")).distinct()
    joined = manifest.join(by_href, "item_href", "left").join(by_id, "scene_id", "left")
    # An href that leads to another scene's item doesn't count.
    ok = F.when(F.col("__href_id") == F.col("scene_id"), F.col("__by_href"))
    return joined.withColumn("item", F.coalesce(ok, F.col("__by_id"))).drop("__by_href", "__href_id", "__by_id")


def requested(known: list[str], asked: list[str] | None) -> list[str]:
    """SET-05: the asked products in known order; all if none is asked for, an error for unknown names."""
    if asked is None:
        return list(known)
    if unknown := sorted(set(asked) - set(known)):
        raise ValueError(f"unknown products: {unknown}")
    return [k for k in known if k in asked]


def archive_findings(members: DataFrame, declared: DataFrame) -> DataFrame:
    """FP-04: `member, problem` of archive members (member, sha256) against the published list."""
    both = declared.select("member", F.col("sha256").alias("__want")).join(members.select("member", F.col("sha256").alias("__have")), "member", "full_outer")
    problem = F.when(F.col("__have").isNull(), "missing").when(F.col("__want").isNull(), "extra").when(F.col("__want") != F.col("__have"), "changed")
    return both.select("member", problem.alias("problem")).filter("problem is not null")


def adopt_artifacts(keys: DataFrame, kinds: list[str], artifacts: DataFrame, ledger: DataFrame, on: list[str], run_id: str) -> DataFrame:
    """LED-07: ledger with done rows for every key whose artifacts are complete and that it doesn't have as done yet."""
    from latticeframe.operators.ledger import upsert

    lost = completeness(keys, kinds, artifacts, on)
    full = keys.join(lost.select(*on).distinct(), on, "left_anti").select(*on)
    new = full.join(ledger.filter("status = 'done'").select(*on), on, "left_anti")
    rows = new.withColumns({"status": F.lit("done"), "attempts": F.lit(1), "run_id": F.lit(run_id)})
    return upsert(ledger, rows.select(*ledger.columns) if set(ledger.columns) <= set(rows.columns) else rows, on, "keep")
