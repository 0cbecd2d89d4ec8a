"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a written table that a join may broadcast
MOST_BROADCAST = 100_000


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared one that the session names (spark.checkpoint.dir); in local mode it may name none."""
    shared = spark.conf.get("spark.checkpoint.dir", "") or ""
    if not shared:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        shared = tempfile.mkdtemp(prefix="lattice-work-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """`df` written to a work folder and read again: computed once, cut from its lineage, safe from lost executors."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def few_broadcast(table: DataFrame) -> DataFrame:
    """A written table, marked for joins: broadcast if it has few rows, else shuffled.

    Spark goes by the compressed size of its files, which lets through millions of narrow rows; a hash table of those
    takes the driver's memory.
    """
    return F.broadcast(table) if table.count() <= MOST_BROADCAST else table.hint("merge")
