"""Ledgers fed by streams: the same operators, batch by batch."""

from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def status_windows(events: DataFrame, lateness: str = "10 minutes", window: str = "1 hour") -> DataFrame:
    """Status counts per source and time window of a stream of ledger rows, with late rows bounded by a watermark."""
    e = events.withColumn("updated_at", F.col("updated_at").cast("timestamp")).withWatermark("updated_at", lateness)
    counts = e.groupBy(F.window("updated_at", window), "source", "status").agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("window.start").alias("start"), "source", "status", "n")


#: Seconds for which readers may go on with the files of an earlier batch
GRACE = 86_400.0


def merge_into(path: str, keys: list[str], order: list[str], buckets: int = 64, compact_every: int = 1000, grace: float = GRACE):
    """A `foreachBatch` function that keeps the latest ledger row per key under `path`.

    Rows lie in `buckets` by a hash of their key, and a batch only rewrites the buckets that it touches: into a folder
    of its own, which the pointer table names last. So readers never see half of a batch, a batch that is run again
    gives the same state, and a stream that starts anew goes on with the ledger as it is. `buckets` stays what it was
    for the first batch; another number raises. Every `compact_every` batches, what no bucket names any more is
    deleted (see `compact`).
    """
    from latticeframe.operators.ledger import latest

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
        rows = latest(batch, keys, order).persist()
        try:
            touched = [r["b"] for r in rows.select(bucket.alias("b")).distinct().collect()]  # `buckets` rows at most
            if not touched:
                return
            folders = _folders(spark, path)
            if any(n != buckets for n, _, _ in folders.values()):
                raise ValueError(f"{path} doesn't have {buckets} buckets")
            old = [f"{folder}/__bucket={b}" for b, (_, _, folder) in folders.items() if b in touched]
            merged = latest(spark.read.parquet(*old).unionByName(rows), keys, order) if old else rows
            folder = f"{path}/run={uuid.uuid4().hex}"
            merged.withColumn("__bucket", bucket).hint("rebalance", "__bucket").write.partitionBy("__bucket").parquet(folder)
            seq = 1 + max((n for _, n, _ in folders.values()), default=0)
            pointer = spark.createDataFrame([(b, buckets, seq, folder) for b in touched], POINTER)
            pointer.coalesce(1).write.mode("append").parquet(f"{path}-pointer")
            if seq % compact_every == 0:
                compact(spark, path, grace)
        finally:
            rows.unpersist()

    return run


POINTER = "bucket int, buckets int, seq long, folder string"


def _folders(spark: SparkSession, path: str) -> dict[int, tuple[int, int, str]]:
    """The number of buckets, and the number and folder of the last finished run, for each bucket."""
    try:
        pointer = spark.read.schema(POINTER).parquet(f"{path}-pointer")
        last = pointer.groupBy("bucket").agg(F.max(F.struct("seq", "folder", "buckets")).alias("l")).collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    return {r["bucket"]: (r["l"]["buckets"], r["l"]["seq"], r["l"]["folder"]) for r in last}


def current(spark: SparkSession, path: str) -> DataFrame | None:
    """The ledger as the last finished batch left it; None before the first."""
    folders = _folders(spark, path)
    return spark.read.parquet(*(f"{folder}/__bucket={b}" for b, (_, _, folder) in folders.items())) if folders else None


def compact(spark: SparkSession, path: str, grace: float = GRACE) -> tuple[int, int]:
    """Delete files that the ledger under `path` no longer needs; returns how many pointer files and run folders went.

    The pointer is written once more as one file first, so that the earlier ones are only history. What was written
    within the last `grace` seconds stays: a reader may still be on it, or a batch be writing it. One stream writes a
    ledger, and the same one compacts it; a run that stops half way leaves files that the next one deletes.
    """
    folders = _folders(spark, path)
    if not folders:
        return 0, 0
    hadoop = spark._jvm.org.apache.hadoop.fs
    at, pointer = hadoop.Path(path), hadoop.Path(f"{path}-pointer")
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    limit = (time.time() - grace) * 1000
    old = [f.getPath() for f in fs.listStatus(pointer) if f.getPath().getName().endswith(".parquet") and f.getModificationTime() <= limit]
    if len(old) > 1:
        rows = [(b, n, seq, folder) for b, (n, seq, folder) in folders.items()]
        spark.createDataFrame(rows, POINTER).coalesce(1).write.mode("append").parquet(f"{path}-pointer")
        for file in old:
            fs.delete(file, False)
    named = {folder.rsplit("/", 1)[-1] for _, _, folder in folders.values()}
    gone = 0
    for f in fs.listStatus(at):
        if f.getPath().getName().startswith("run=") and f.getPath().getName() not in named and 0 < _written(fs, f.getPath()) <= limit:
            fs.delete(f.getPath(), True)
            gone += 1
    return (len(old) if len(old) > 1 else 0), gone


def _written(fs, folder) -> int:
    """When the youngest file below a folder was written, in milliseconds; 0 if there is none."""
    files, last = fs.listFiles(folder, True), 0
    while files.hasNext():
        last = max(last, files.next().getModificationTime())
    return last
