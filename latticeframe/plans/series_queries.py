"""Queries on hourly series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from latticeframe.functions import weather
from latticeframe.operators import weather_series
from latticeframe.plans import views as v
from latticeframe.plans.registry import query


@query(f"""WITH {v.HOURLY} SELECT cell, ts, round(CASE WHEN hour(ts) = 1 THEN ssrd ELSE ssrd - lag(ssrd) OVER (PARTITION BY cell, CAST(ts - INTERVAL 1 HOUR AS DATE) ORDER BY ts) END / 3600, 6) AS flux FROM series""")
def hourly_from_cumulative(spark: SparkSession, d: str) -> DataFrame:
    """WN-02."""
    s = weather_series.hourly(v.hourly_series(spark, d), ["cell"], "ssrd", "flux", 3600)
    return s.select("cell", "ts", F.round("flux", 6).alias("flux"))


@query(f"""WITH {v.HOURLY} SELECT cell, ts, round(avg(v) OVER (PARTITION BY cell ORDER BY ts RANGE BETWEEN INTERVAL '71:59:59' HOUR TO SECOND PRECEDING AND CURRENT ROW), 6) AS v_trailing_mean FROM series""".replace("INTERVAL '71:59:59' HOUR TO SECOND", "INTERVAL 259199 SECONDS"))
def trailing_72h(spark: SparkSession, d: str) -> DataFrame:
    """WN-03."""
    s = weather_series.trailing_mean(v.hourly_series(spark, d), ["cell"], "v")
    return s.select("cell", "ts", F.round("v_trailing_mean", 6).alias("v_trailing_mean"))


_BINS = ", ".join(f"round(1000 * coalesce(sum(s.v) FILTER (age >= {a} AND age < {a + 24}), 0), 6) AS v_{a}_{a + 24}h" for a in (0, 24, 48))


@query(f"""WITH {v.HOURLY}, t AS (SELECT o_orderkey AS target, CAST(o_custkey % 150 AS BIGINT) AS cell, CAST(TIMESTAMP '2024-01-04' + INTERVAL 1 HOUR * (o_orderkey % 600) AS TIMESTAMP) AS acq FROM orders),
j AS (SELECT t.target, t.cell, s.v, (epoch_us(t.acq) - epoch_us(s.ts)) / 3600e6 AS age FROM t JOIN series s ON t.cell = s.cell AND s.ts <= t.acq AND s.ts > t.acq - INTERVAL 72 HOUR)
SELECT t.target, t.cell, round(avg(s.v), 6) AS v_antecedent_mean, {_BINS}, count(s.v) AS n_hours FROM t LEFT JOIN j s ON t.target = s.target GROUP BY 1, 2""")
def rain_bins(spark: SparkSession, d: str) -> DataFrame:
    """WN-03, WN-04."""
    k = F.col("o_orderkey")
    start = F.unix_seconds(F.to_timestamp(F.lit("2024-01-04")))
    t = v.table(spark, d, "orders").select(
        k.alias("target"), (F.col("o_custkey") % 150).alias("cell"), F.timestamp_seconds(start + k % 600 * 3600).alias("acq")
    )
    out = weather_series.at_targets(t, v.hourly_series(spark, d).select("cell", "ts", "v"), "target", ["cell"], "v", "v")
    means = [c for c in out.columns if c.startswith("v_")]
    return out.select("target", "cell", *(F.round(c, 6).alias(c) for c in means), "n_hours")


@query("""WITH t AS (SELECT l_orderkey, l_linenumber, l_quantity, 280 + CAST(l_quantity AS DOUBLE) / 5 AS t2m, 280 + CAST(l_quantity AS DOUBLE) / 7 - CAST(l_discount AS DOUBLE) * 10 + CAST(l_tax AS DOUBLE) * 30 AS d2m, CAST(l_discount AS DOUBLE) * 10 AS u, CAST(l_tax AS DOUBLE) * 10 AS v FROM lineitem),
p AS (SELECT *, 0.6108 * exp(17.27 * (t2m - 273.15) / (t2m - 273.15 + 237.3)) AS es, 0.6108 * exp(17.27 * (d2m - 273.15) / (d2m - 273.15 + 237.3)) AS ea FROM t)
SELECT l_orderkey, l_linenumber, round(greatest(es - ea, 0), 5) AS vpd, round(sqrt(u * u + v * v), 5) AS wind FROM p""")
def vpd_wind(spark: SparkSession, d: str) -> DataFrame:
    """PRJ-19."""
    c = lambda n: F.col(n).cast("double")
    t2m, d2m = 280 + c("l_quantity") / 5, 280 + c("l_quantity") / 7 - c("l_discount") * 10 + c("l_tax") * 30
    li = v.table(spark, d, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", F.round(weather.vapour_pressure_deficit(t2m, d2m), 5).alias("vpd"), F.round(weather.wind_speed(c("l_discount") * 10, c("l_tax") * 10), 5).alias("wind")
    )


@query("SELECT event_id, date_trunc('hour', ts + INTERVAL 30 MINUTE) AS hour FROM events")
def nearest_hour(spark: SparkSession, d: str) -> DataFrame:
    """PRJ-29."""
    return v.table(spark, d, "events").select("event_id", weather.nearest_hour(F.col("ts")).alias("hour"))


@query("SELECT user_id AS cell, event_id, ts FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY value, event_id) AS before FROM events) WHERE ts < before")
def time_order_findings(spark: SparkSession, d: str) -> DataFrame:
    """WN-08."""
    e = v.table(spark, d, "events").select(F.col("user_id").alias("cell"), "event_id", "ts", F.struct("value", "event_id").alias("place"))
    return weather_series.unordered(e, ["cell"], "place").select("cell", "event_id", "ts")


@query(f"""WITH {v.HOURLY} SELECT cell, ts, v FROM series WHERE ts >= TIMESTAMP '2024-01-10 12:00:00' - INTERVAL 73 HOUR AND ts <= TIMESTAMP '2024-01-10 12:00:00'""")
def time_slice(spark: SparkSession, d: str) -> DataFrame:
    """SRC-12."""
    return weather_series.time_slice(v.hourly_series(spark, d), "2024-01-10 12:00:00").select("cell", "ts", "v")
