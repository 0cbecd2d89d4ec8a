"""The driver's tables seen as scenes, grids, ledgers and series: one DataFrame and one SQL text for each view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Size of the pixel grid that orders make: 120 x 125, ragged at the right edge for blocks of 10
COLS = 125
BAND = 600000.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def anchors(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("anchor_id"), F.col("o_orderdate").alias("acq"))


ANCHORS = "anchors AS (SELECT o_orderkey AS anchor_id, o_orderdate AS acq FROM orders)"


def candidates(spark: SparkSession, d: str) -> DataFrame:
    """One scene for each l_returnflag and day, from all line items; its clear fraction is spread evenly at any scale."""
    return table(spark, d, "lineitem").groupBy("l_returnflag", F.col("l_shipdate").alias("acq")).agg(
        (F.sum(F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 101 / F.lit(100.0)).alias("clear_frac"), F.count(F.lit(1)).alias("n_items")
    ).select(F.concat("l_returnflag", F.lit("_"), F.date_format("acq", "yyyyMMdd")).alias("cand_id"), "acq", "clear_frac", "n_items")


CANDIDATES = """cand AS (SELECT l_returnflag || '_' || strftime(l_shipdate, '%Y%m%d') AS cand_id, l_shipdate AS acq,
  CAST(sum(CAST(l_orderkey AS BIGINT) * 7 + l_linenumber) % 101 AS DOUBLE) / 100e0 AS clear_frac, count(*) AS n_items FROM lineitem GROUP BY l_returnflag, l_shipdate)"""


def pixels(spark: SparkSession, d: str) -> DataFrame:
    """One scene in four as a grid of 125 columns; `b04` has NaN, `flag` is mostly clear."""
    k = F.col("o_orderkey")
    return table(spark, d, "orders").select(
        (k % 4).cast("int").alias("scene_id"),
        F.floor(k / COLS).cast("int").alias("row"),
        (k % COLS).cast("int").alias("col"),
        F.when(k % 997 == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice").cast("double") / BAND).alias("b04"),
        ((F.col("o_custkey") % 100) / 100.0).cast("double").alias("b08"),
        F.when(k % 41 == 0, (F.col("o_custkey") % 64).cast("int")).otherwise(0).alias("flag"),
        (F.col("o_custkey") % 1024).cast("int").alias("qa"),
        (F.col("o_custkey") % 12).cast("int").alias("scl"),
        F.col("o_custkey").cast("long").alias("custkey"),
        (F.col("o_totalprice").cast("double") / 10000).alias("height"),
    )


#: NaN is NULL on the SQL side.
PIXELS = f"""px AS (SELECT CAST(o_orderkey % 4 AS INT) AS scene_id, CAST(floor(o_orderkey / {COLS}e0) AS INT) AS row,
  CAST(o_orderkey % {COLS} AS INT) AS col, CASE WHEN o_orderkey % 997 <> 0 THEN CAST(o_totalprice AS DOUBLE) / {BAND} END AS b04,
  CAST((o_custkey % 100) / 100e0 AS DOUBLE) AS b08, CASE WHEN o_orderkey % 41 = 0 THEN CAST(o_custkey % 64 AS INT) ELSE 0 END AS flag,
  CAST(o_custkey % 1024 AS INT) AS qa, CAST(o_custkey % 12 AS INT) AS scl, CAST(o_custkey AS BIGINT) AS custkey,
  CAST(o_totalprice AS DOUBLE) / 10000 AS height FROM orders)"""


def rows_of(spark: SparkSession, d: str) -> int:
    """Rows of the grid (from the largest key; one small aggregate)."""
    return table(spark, d, "orders").agg(F.max("o_orderkey").alias("m")).first()["m"] // COLS + 1


def hourly_series(spark: SparkSession, d: str) -> DataFrame:
    """Per user and hour that has events: values summed up since 01 UTC, as accumulated weather fields are."""
    from pyspark.sql import Window as W

    hour = F.date_trunc("hour", F.col("ts"))
    e = table(spark, d, "events").groupBy(F.col("user_id").alias("cell"), hour.alias("ts")).agg(
        F.sum(F.coalesce(F.col("value"), F.lit(0.0))).alias("v")
    )
    day = F.to_date(F.col("ts") - F.expr("INTERVAL 1 HOUR"))
    w = W.partitionBy("cell", day).orderBy("ts").rowsBetween(W.unboundedPreceding, 0)
    return e.withColumn("ssrd", F.sum("v").over(w)).select("cell", "ts", "v", "ssrd")


HOURLY = """hours AS (SELECT user_id AS cell, date_trunc('hour', ts) AS ts, sum(coalesce(value, 0)) AS v FROM events GROUP BY 1, 2),
series AS (SELECT cell, ts, v, sum(v) OVER (PARTITION BY cell, CAST(ts - INTERVAL 1 HOUR AS DATE) ORDER BY ts) AS ssrd FROM hours)"""


def ledger_log(spark: SparkSession, d: str) -> DataFrame:
    kinds = {"purchase": "done", "error": "failed", "view": "exporting", "signup": "pending"}
    status: Column = F.lit("skipped")
    for event, name in kinds.items():
        status = F.when(F.col("event_type") == event, F.lit(name)).otherwise(status)
    return table(spark, d, "events").select(
        F.col("user_id").alias("item_id"), status.alias("status"), (F.col("event_id") % 5).cast("int").alias("attempts"),
        F.concat(F.lit("h"), (F.col("event_id") % 3).cast("string")).alias("config_hash"), F.col("ts").alias("updated_at"), "event_id",
        F.concat(F.lit("src"), (F.col("user_id") % 3).cast("string")).alias("source"),
    )


LEDGER_LOG = """ledger_log AS (SELECT user_id AS item_id,
  CASE event_type WHEN 'purchase' THEN 'done' WHEN 'error' THEN 'failed' WHEN 'view' THEN 'exporting' WHEN 'signup' THEN 'pending' ELSE 'skipped' END AS status,
  CAST(event_id % 5 AS INT) AS attempts, 'h' || (event_id % 3) AS config_hash, ts AS updated_at, event_id, 'src' || (user_id % 3) AS source FROM events)"""
LATEST = """latest AS (SELECT * FROM ledger_log QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY updated_at DESC, event_id DESC) = 1)"""


def shapes(spark: SparkSession, d: str) -> DataFrame:
    """Parts as boxes on a grid, with a height."""
    k, size = F.col("p_partkey"), (F.col("p_size") % 7) + 1
    return table(spark, d, "part").select(
        k.alias("shape_id"), (k * 7 % 120 + 0.25).cast("double").alias("y0"), (k * 13 % 125 + 0.25).cast("double").alias("x0"), size.alias("side"),
        (F.col("p_retailprice").cast("double") / 100).alias("height"),
    )


SHAPES = """shapes AS (SELECT p_partkey AS shape_id, CAST(p_partkey * 7 % 120 + 0.25 AS DOUBLE) AS y0, CAST(p_partkey * 13 % 125 + 0.25 AS DOUBLE) AS x0,
  (p_size % 7) + 1 AS side, CAST(p_retailprice AS DOUBLE) / 100 AS height FROM part)"""
