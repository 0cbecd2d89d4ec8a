"""Channel profiles as stored states that merge, so that a new scene costs its own pixels only (AG-13 .. AG-15).

A state is one row per key and channel: count, mean, sum of squared deviations, least and largest value, counts per bin
and the declared range. States of disjoint pixels merge into the state of all of them, in any order.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from latticeframe.functions.contracts import LayerContract
from latticeframe.functions.nulls import value
from latticeframe.operators.grids import bin_number
from latticeframe.sources.sinks import _exists

CHANNEL = ["channel_index", "channel_name", "range_lo", "range_hi"]
#: Scene ids that are pushed into the scan as a list; more of them are joined
MOST_LISTED = 1000


def states(df: DataFrame, keys: list[str], contracts: list[LayerContract], bins: int = 20, where: Column | None = None) -> DataFrame:
    """States of the pixels of `df` that meet `where`; a channel without values has count 0 and NULL statistics.

    A pixel becomes one small row per channel, which is summed up per bin on the map side: what is shuffled is a row
    per task, key, channel and bin. NaN and NULL count as no value, and as the bin -1.
    """
    where = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    named = lambda k, c: [F.lit(k).alias("channel_index"), F.lit(c.name).alias("channel_name"), F.lit(float(c.lo)).alias("range_lo"), F.lit(float(c.hi)).alias("range_hi")]
    cells = []
    for k, c in enumerate(contracts):
        v = F.when(where, value(c.name))
        cells.append(F.struct(*named(k, c), v.cast("double").alias("x"), F.coalesce(bin_number(v, c.lo, c.hi, bins), F.lit(-1)).alias("at")))
    long = df.select(*keys, F.explode(F.array(*cells)).alias("p")).select(*keys, "p.*")
    parts = long.groupBy(*keys, *CHANNEL, "at").agg(
        F.count("x").alias("n"), F.avg("x").alias("mean"), (F.var_pop("x") * F.count("x")).alias("m2"), F.min("x").alias("lo"), F.max("x").alias("hi")
    )
    counts = F.array(*(F.when(F.col("at") == i, F.col("n")).otherwise(0) for i in range(bins)))
    return merge(parts.withColumn("bins", counts).drop("at"), keys, bins)


def merge(parts: DataFrame, keys: list[str], bins: int = 20) -> DataFrame:
    """States of `parts` with equal `keys` and channel put together; no keys give the totals.

    Deviations are summed about the middle of the declared range, which is a constant of the channel, so that one
    grouped sum with partial sums does, and no cancellation of large means occurs. States of other ranges stay apart;
    bins beyond a state's own count as empty.
    """
    n, off = F.col("n"), F.col("mean") - (F.col("range_lo") + F.col("range_hi")) / 2
    sums = parts.groupBy(*keys, *CHANNEL).agg(
        F.sum(n).alias("n"),
        F.sum(n * off).alias("__s1"),
        F.sum(F.col("m2") + n * off * off).alias("__s2"),
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
        F.array(*(F.sum(F.coalesce(F.get("bins", F.lit(i)), F.lit(0))) for i in range(bins))).alias("bins"),
    )
    some, s1 = F.col("n") > 0, F.col("__s1")
    mean = F.when(some, s1 / F.col("n") + (F.col("range_lo") + F.col("range_hi")) / 2)
    m2 = F.when(some, F.greatest(F.col("__s2") - s1 * s1 / F.col("n"), F.lit(0.0)))
    return sums.select(*keys, *CHANNEL, "n", mean.alias("mean"), m2.alias("m2"), "lo", "hi", "bins")


def profile_of(merged: DataFrame, keys: list[str]) -> DataFrame:
    """The report of states: valid_px, min, max, mean, std (6 digits) and the histogram without empty bins."""
    six = lambda c: F.round(c, 6)
    pairs = F.transform("bins", lambda x, i: F.struct(F.lpad(i.cast("string"), 3, "0").alias("bin"), x.alias("n")))
    return merged.select(
        *keys,
        "channel_index",
        "channel_name",
        F.col("n").alias("valid_px"),
        six(F.col("lo")).alias("min"),
        six(F.col("hi")).alias("max"),
        six(F.col("mean")).alias("mean"),
        six(F.sqrt(F.col("m2") / F.nullif(F.col("n"), F.lit(0)))).alias("std"),
        F.map_from_entries(F.filter(pairs, lambda p: p["n"] > 0)).alias("histogram"),
    )


def with_totals(held: DataFrame, key: str, bins: int = 20) -> DataFrame:
    """Profiles of every `key`, and of all together with a NULL key and `is_total`; no pixel is read."""
    each = profile_of(held, [key]).withColumn("is_total", F.lit(False))
    everything = profile_of(merge(held, [], bins), []).withColumns({key: F.lit(None).cast(held.schema[key].dataType), "is_total": F.lit(True)})
    return each.unionByName(everything)


def pending(spark: SparkSession, folder: str, scenes: DataFrame, key: str = "scene_id") -> DataFrame:
    """Rows of `scenes` (`key`, `version`) whose version isn't the one that the ledger of `folder` names last; none without a key."""
    scenes = scenes.filter(F.col(key).isNotNull())
    if not _exists(spark, f"{folder}/ledger"):
        return scenes
    done = _last(spark, folder, key).select(F.col(key).alias("__key"), F.col("version").alias("__version"))
    return scenes.join(done, (F.col(key) == F.col("__key")) & F.col("version").eqNullSafe(F.col("__version")), "left_anti")


def _last(spark: SparkSession, folder: str, key: str) -> DataFrame:
    book = spark.read.parquet(f"{folder}/ledger")
    return book.groupBy(key).agg(F.max_by(F.struct("version", "run"), F.struct("sequence", "run")).alias("b")).select(key, "b.version", "b.run")


def refresh(pixels: DataFrame, scenes: DataFrame, folder: str, contracts: list[LayerContract], key: str = "scene_id", bins: int = 20, where: Column | None = None) -> int:
    """Bring the states under `folder` up to `scenes` (`key`, `version`; one row each); returns how many were redone.

    Only pixels of scenes that the ledger doesn't name with this version are read: up to `MOST_LISTED` ids reach the
    scan as a list, which prunes files by partition, and more are a semi-join. States are written to a folder of their
    own and the ledger rows last, so a run that is lost leaves the earlier states as they are and is done again.
    """
    spark = pixels.sparkSession
    todo = pending(spark, folder, scenes, key)
    listed = todo.select(key, "version").limit(MOST_LISTED + 1).collect()
    if not listed:
        return 0
    run = f"run-{uuid.uuid4().hex}"  # a text even where a folder's name is read as a number
    if len(listed) <= MOST_LISTED:
        mine = pixels.filter(F.col(key).isin([r[key] for r in listed]))
        todo = spark.createDataFrame([(r[key], r["version"]) for r in listed], todo.select(key, "version").schema)
    else:
        mine = pixels.join(todo.select(key), key, "left_semi")
    states(mine, [key], contracts, bins, where).write.parquet(f"{folder}/states/run={run}")
    earlier = spark.read.parquet(f"{folder}/ledger").agg(F.max("sequence")).first()[0] if _exists(spark, f"{folder}/ledger") else 0
    book = todo.select(key, "version", F.lit(run).alias("run"), F.lit(earlier + 1).cast("long").alias("sequence"))
    book.write.mode("append").parquet(f"{folder}/ledger")
    return len(listed) if len(listed) <= MOST_LISTED else spark.read.parquet(f"{folder}/ledger").filter(F.col("run") == run).count()


def held(spark: SparkSession, folder: str, key: str = "scene_id") -> DataFrame:
    """The states under `folder`, of each scene those of its last ledger row."""
    told = spark.read.parquet(f"{folder}/states")
    return told.join(_last(spark, folder, key).select(key, "run"), [key, "run"], "left_semi").drop("run")
