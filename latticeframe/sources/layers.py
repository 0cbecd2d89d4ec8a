"""Layers stored by buckets of their join key, so that jobs join them without a shuffle (JN-11, JN-20)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def store_layer(df: DataFrame, name: str, path: str, keys: list[str], buckets: int) -> DataFrame:
    """Write `df` as table `name` under `path`, in `buckets` buckets of `keys`, and return it as it will be read.

    The layer is shuffled here, once; every later join on `keys` between layers of equal bucket counts, or of counts
    that divide each other where `spark.sql.bucketing.coalesceBucketsInJoin.enabled` is set, needs no exchange. Each
    bucket is one file, sorted by `keys`. A pixel's key is hashed whole, so buckets are even whatever one scene or tile
    holds. Choose the number of buckets so that a bucket of the largest layer suits one task.
    """
    if buckets < 1 or not keys:
        raise ValueError("a stored layer needs keys and at least one bucket")
    dealt = df.repartition(buckets, *keys).sortWithinPartitions(*keys)
    dealt.write.mode("errorifexists").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def open_layer(spark: SparkSession, name: str, path: str, columns: str, keys: list[str], buckets: int) -> DataFrame:
    """A layer that another session stored, declared anew where no catalog is shared; `columns` is its DDL.

    Keys and buckets must be those of `store_layer`: Spark trusts the declaration.
    """
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(f"CREATE TABLE `{name}` ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {int(buckets)} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def exchanges(df: DataFrame) -> int:
    """Shuffles in the plan of `df`, as first planned."""
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    return plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning") + plan.count("Exchange SinglePartition")
