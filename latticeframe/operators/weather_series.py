"""Hourly weather series (SRC-12, SRC-13, WN-02 .. WN-04, WN-08)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from latticeframe.functions.nulls import finite, value
from latticeframe.operators import asof
from latticeframe.sources.work import kept

VARIABLES = ("t2m", "d2m", "u10", "v10", "ssrd", "tp")


def hourly(df: DataFrame, cell: list[str], column: str, name: str, seconds: float = 1.0, clamp: bool = False) -> DataFrame:
    """WN-02: a sum that starts anew each day to the hour's own share.

    At 01 UTC the value itself counts, else the difference to the hour before (NULL without one); divided by
    `seconds` for fluxes, and not below 0 where `clamp`. Windows are cut by day, plus the last hour of the day
    before, so one cell's whole history never has to be sorted in one task.
    """
    # The reading at 00 UTC closes the day before.
    day = F.to_date(F.col("ts") - F.expr("INTERVAL 1 HOUR"))
    w = W.partitionBy(*cell, "__day").orderBy("ts")
    out = df.withColumn("__day", day)
    v = value(column)
    own = F.when(F.hour("ts") == 1, v).otherwise(v - F.lag(v).over(w)) / seconds
    return out.withColumn(name, F.when(own < 0, 0.0).otherwise(own) if clamp else own).drop("__day")


#: Running sums are exact to 18 digits, so they don't depend on the order of rows; for sums below 1e20.
_EXACT = "decimal(38,18)"


def at_targets(targets: DataFrame, series: DataFrame, key: str, cell: list[str], irradiance: str, rain: str, hours: int = 72) -> DataFrame:
    """WN-03, WN-04: per target time `acq`: mean of `irradiance` over (t-72h, t], and rain (m to mm) of three days.

    The three sums cover [0, 24), [24, 48) and [48, 72) hours before; an empty one is 0. NaN and infinite readings don't
    count. A window is the difference of two running sums of its cell, so a target looks up one sum for each day's
    end, whatever the number of readings in between, and targets of one cell and time look them up once.
    """
    steps = list(range(0, hours + 1, 24))
    day = 24 * 3_600_000_000
    # Without a key a target finds nothing, as in a join by key
    at_time = F.when(F.col(key).isNotNull(), F.unix_micros(F.col("acq").cast("timestamp")))
    t = kept(targets.select(*cell, at_time.alias("__at")).filter("__at is not null").distinct(), "times")
    asked = t.withColumn("__k", F.explode(F.sequence(F.lit(0), F.lit(len(steps) - 1)))).withColumn("__t", F.col("__at") - F.col("__k") * day)
    for c in cell:
        asked = asked.filter(F.col(c).isNotNull())
    i, p = (F.when(finite(c), value(c)) for c in (irradiance, rain))
    measures = {
        "__i": i.try_cast(_EXACT), "__n": F.when(i.isNotNull(), 1).otherwise(0).cast("long"), "__p": p.try_cast(_EXACT), "__rows": F.lit(1).cast("long"),
    }
    timed = series.withColumn("__t", F.unix_micros(F.col("ts").cast("timestamp")))
    sums = asof.running_at(asked.select(*cell, "__t").distinct(), timed, tuple(cell), measures)
    at = lambda c, k: F.max(F.when(F.col("__k") == k, F.col(c)))
    span = lambda c, a, b: at(c, a) - at(c, b)
    last = len(steps) - 1
    rains = [(span("__p", k, k + 1).cast("double") * 1000).alias(f"{rain}_{24 * k}_{24 * k + 24}h") for k in range(last)]
    mean = F.try_divide(span("__i", 0, last).cast("double"), span("__n", 0, last)).alias(f"{irradiance}_antecedent_mean")
    made = asked.join(sums, [*cell, "__t"]).groupBy(*cell, "__at").agg(mean, *rains, span("__rows", 0, last).alias("n_hours"))
    out = targets.withColumn("__at", at_time).join(made, [*cell, "__at"], "left")
    out = out.select(*targets.columns, *(c for c in made.columns if c not in (*cell, "__at")))
    fill = {f"{rain}_{a}_{a + 24}h": 0.0 for a in steps[:-1]} | {"n_hours": 0}
    return out.fillna(fill)


def trailing_mean(series: DataFrame, cell: list[str], column: str, hours: int = 72) -> DataFrame:
    """WN-03 for every row of a series: mean over (t - hours, t]."""
    w = W.partitionBy(*cell).orderBy(F.unix_seconds(F.col("ts").cast("timestamp"))).rangeBetween(-hours * 3600 + 1, 0)
    return series.withColumn(f"{column}_trailing_mean", F.avg(value(column)).over(w))


def time_slice(series: DataFrame, acq: str, hours: int = 73, month: str = "ym") -> DataFrame:
    """SRC-12: rows in [acq - hours, acq], read from the partitions (`ym`) of this and the month before only."""
    t = F.lit(acq).cast("timestamp")
    months = [F.date_format(x, "yyyy-MM") for x in (t, F.add_months(t, -1))]
    rows = series.filter(F.col(month).isin(*months)) if month in series.columns else series
    return rows.filter((F.col("ts").cast("timestamp") <= t) & (F.col("ts").cast("timestamp") >= t - F.make_dt_interval(hours=F.lit(hours)))).orderBy("ts")


def short_slices(slices: DataFrame, keys: list[str], least: int = 72) -> DataFrame:
    """Warning rows: slices with fewer hours than wanted."""
    return slices.groupBy(*keys).agg(F.count_distinct("ts").alias("n_hours")).filter(F.col("n_hours") < least)


def series_findings(series: DataFrame, cell: list[str]) -> DataFrame:
    """SRC-13, WN-08: `rule, detail` for missing variables, fewer than two steps, and times that repeat in a cell."""
    spark = series.sparkSession
    missing = [("variable_missing", v) for v in VARIABLES if v not in series.columns]
    out = spark.createDataFrame(missing, "rule string, detail string")
    if "ts" not in series.columns:
        return out
    steps = series.agg(F.count_distinct("ts").alias("n")).filter("n < 2")
    again = series.groupBy(*cell, "ts").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    out = out.union(steps.select(F.lit("too_few_steps"), F.col("n").cast("string")))
    return out.union(again.select(F.lit("time_repeats"), F.concat_ws("/", *(F.col(c).cast("string") for c in [*cell, "ts"]))))


def unordered(series: DataFrame, cell: list[str], position: str) -> DataFrame:
    """WN-08: rows whose time is earlier than that of the row before them by `position`."""
    w = W.partitionBy(*cell).orderBy(position)
    return series.withColumn("before", F.lag("ts").over(w)).filter(F.col("ts") < F.col("before"))
