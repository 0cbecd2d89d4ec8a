"""Joins along an ordered axis without a bound on either side (JN-06, JN-19, WN-03, WN-04).

Time is cut into buckets, and a group's rows meet bucket by bucket, so one group, however hot, is many tasks. What a
bucket needs from those before it (their last row, or their sums) is one small row: a scan over the buckets, not over
the rows, carries it on, and it joins its bucket as the first row there. Only distinct times are looked up, and the
answers joined back, so very many rows of one time don't meet in a task either.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latticeframe.sources.work import few_broadcast, kept

#: Rows that a bucket holds on average
BUCKET_ROWS = 65_536
#: Rows and ranges of one cell that meet in one task at once
TILE_ROWS, TILE_RANGES = 16_384, 4096
#: Above all size classes of ranges
NO_RANGE = 1000


def axis(df: DataFrame, column: str) -> Column:
    """A column as a number that can be cut: microseconds, days, or its own value; NaN is NULL."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(column)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(column).cast("timestamp"))
    if isinstance(kind, T.IntegralType):
        return F.col(column).cast("long")
    return F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))


def bucket_width(times: DataFrame, rows: int = BUCKET_ROWS) -> float:
    """Width of buckets of about `rows` rows each, from count and span of `__t`."""
    s = times.agg(F.count(F.lit(1)).alias("n"), F.min("__t").alias("lo"), F.max("__t").alias("hi")).first()
    if not s["n"] or s["lo"] == s["hi"]:
        return 1.0
    return max(float(s["hi"] - s["lo"]) * rows / s["n"], 1e-9)


def _bucket(width: float) -> Column:
    return F.floor(F.col("__t") / F.lit(width)).alias("__bucket")


def _present(df: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        df = df.filter(F.col(c).isNotNull())
    return df


def as_of_join(
    left: DataFrame, right: DataFrame, left_time: str, right_time: str, on: tuple[str, ...] = (), direction: str = "backward", width: float | None = None,
    payload: str = "found",
) -> DataFrame:
    """`left` plus `payload`, a struct of `right`'s other columns: the row of `right` next to each row's time.

    `backward` takes the last row not after it, `forward` the first one not before it, `nearest` the closer of the two
    (the backward one on a tie). Of rows of `right` with equal times the smallest struct counts. Columns `on` must be
    equal. NULL times or NULL `on` find nothing, rows that find nothing have a NULL struct; no row of `left` is lost
    or repeated. `width` is the buckets' width on the axis; by default they hold `BUCKET_ROWS` rows on average.
    """
    rest = [c for c in right.columns if c not in on]
    keyed = left.withColumn("__t", axis(left, left_time))
    keys = _present(keyed.select(*on, "__t"), *on, "__t").distinct()
    own = _present(right.select(*on, axis(right, right_time).alias("__t"), F.struct(*rest).alias("__r")), *on, "__t")
    own = own.groupBy(*on, "__t").agg(F.min("__r").alias("__r")).withColumn("__r", F.struct(F.col("__t").alias("at"), F.col("__r").alias("row")))
    width = width or bucket_width(keys.select("__t").unionAll(own.select("__t")))
    keys, own = keys.withColumn("__bucket", _bucket(width)), own.withColumn("__bucket", _bucket(width))
    nothing = F.lit(None).cast(own.schema["__r"].dataType)

    # One row for each bucket: its first and last row, and whether anybody asks there
    ends = own.groupBy(*on, "__bucket").agg(F.min_by("__r", "__t").alias("__first"), F.max_by("__r", "__t").alias("__last"), F.lit(False).alias("__asked"))
    asked = keys.select(*on, "__bucket").distinct().select(*on, "__bucket", nothing.alias("__first"), nothing.alias("__last"), F.lit(True).alias("__asked"))
    both = ends.unionByName(asked).groupBy(*on, "__bucket")
    both = both.agg(F.max("__first").alias("__first"), F.max("__last").alias("__last"), F.max("__asked").alias("__asked"))
    over = W.partitionBy(*on).orderBy("__bucket")
    carried = both.withColumns({
        "__before": F.last("__last", ignorenulls=True).over(over.rowsBetween(W.unboundedPreceding, -1)),
        "__after": F.first("__first", ignorenulls=True).over(over.rowsBetween(1, W.unboundedFollowing)),
    }).filter("__asked")

    no_time = F.lit(None).cast(own.schema["__t"].dataType).alias("__t")
    # __k orders what is carried in, the bucket's rows, what is carried back; __s puts rows before askers of their time
    rows = own.select(*on, "__bucket", F.lit(1).alias("__k"), "__t", F.lit(0).alias("__s"), "__r")
    for k, name, wanted in ((0, "__before", "backward"), (2, "__after", "forward")):
        if direction in (wanted, "nearest"):
            rows = rows.unionByName(carried.filter(F.col(name).isNotNull()).select(*on, "__bucket", F.lit(k).alias("__k"), no_time, F.lit(0).alias("__s"), F.col(name).alias("__r")))
    rows = rows.unionByName(keys.select(*on, "__bucket", F.lit(1).alias("__k"), "__t", F.lit(1).alias("__s"), nothing.alias("__r")))
    part = W.partitionBy(*on, "__bucket")
    until = (W.unboundedPreceding, W.currentRow)
    back = F.last("__r", ignorenulls=True).over(part.orderBy("__k", "__t", "__s").rowsBetween(*until))
    ahead = F.last("__r", ignorenulls=True).over(part.orderBy(F.desc("__k"), F.desc("__t"), "__s").rowsBetween(*until))
    if direction == "nearest":
        rows = rows.withColumns({"__b": back, "__a": ahead})
        closer = F.col("__b").isNull() | (F.col("__a.at") - F.col("__t") < F.col("__t") - F.col("__b.at"))
        rows = rows.withColumn("__f", F.when(F.col("__a").isNotNull() & closer, F.col("__a")).otherwise(F.col("__b")))
    else:
        rows = rows.withColumn("__f", back if direction == "backward" else ahead)
    found = rows.filter("__s = 1").select(*on, "__t", F.col("__f.row").alias(payload))
    return keyed.join(found, [*on, "__t"], "left").select(*left.columns, payload)


def running_at(keys: DataFrame, series: DataFrame, on: tuple[str, ...], measures: dict[str, Column], width: float | None = None) -> DataFrame:
    """Prefix sums: `keys` (`on`, `__t`, distinct) with each measure summed over the rows of `series` up to that time.

    `series` has the columns `on` and `__t`; rows of a key's own time count. Sums start at 0.
    """
    series = _present(series, *on, "__t").groupBy(*on, "__t").agg(*(F.coalesce(F.sum(m), F.lit(0)).alias(name) for name, m in measures.items()))
    width = width or bucket_width(keys.select("__t").unionAll(series.select("__t")))
    keys, series = keys.withColumn("__bucket", _bucket(width)), series.withColumn("__bucket", _bucket(width))
    zero = [F.lit(0).cast(series.schema[name].dataType).alias(name) for name in measures]
    totals = series.groupBy(*on, "__bucket").agg(*(F.sum(name).cast(series.schema[name].dataType).alias(name) for name in measures), F.lit(False).alias("__asked"))
    asked = keys.select(*on, "__bucket").distinct().select(*on, "__bucket", *zero, F.lit(True).alias("__asked"))
    both = totals.unionByName(asked).groupBy(*on, "__bucket").agg(*(F.sum(name).alias(name) for name in measures), F.max("__asked").alias("__asked"))
    before = W.partitionBy(*on).orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    carried = both.select(*on, "__bucket", "__asked", *(F.sum(name).over(before).cast(series.schema[name].dataType).alias(name) for name in measures)).filter("__asked")
    none = F.lit(None).cast(series.schema["__t"].dataType).alias("__t")
    # NULL times sort first: what is carried in stands before the bucket's rows, these before keys of their time
    rows = series.select(*on, "__bucket", "__t", F.lit(0).alias("__s"), *measures)
    rows = rows.unionByName(carried.select(*on, "__bucket", none, F.lit(0).alias("__s"), *measures))
    rows = rows.unionByName(keys.select(*on, "__bucket", "__t", F.lit(1).alias("__s"), *zero))
    until = W.partitionBy(*on, "__bucket").orderBy("__t", "__s").rowsBetween(W.unboundedPreceding, W.currentRow)
    sums = rows.select(*on, "__t", "__s", *(F.sum(name).over(until).alias(name) for name in measures))
    return sums.filter("__s = 1").drop("__s")


def _on_cells(rows: DataFrame, ranges: DataFrame, column: str, lo: str, hi: str) -> tuple[DataFrame, DataFrame, list[int]]:
    """`rows` with their place `__t`; a row for each range and cell it touches; the size classes there are.

    A range of class k is over 4 and up to 16 cells of width 4^(k-2) long, so nearly all of what shares a cell matches.
    """
    own = ranges.select(F.struct(*ranges.columns).alias("__r"), axis(ranges, lo).alias("__lo"), axis(ranges, hi).alias("__hi")).filter("__lo <= __hi")
    a, b = F.col("__lo").cast("double"), F.col("__hi").cast("double")
    # Points have a length too, one that keeps the numbers of their cells exact; classes end where widths are infinite
    length = F.greatest(b - a, F.abs(a) * 2.0**-40, F.abs(b) * 2.0**-40, F.lit(1e-9))
    own = own.withColumn("__size", F.ceil(F.least(F.log2(length) / 2, F.lit(520.0))).cast("int"))
    sizes = sorted(r[0] for r in own.select("__size").distinct().collect())
    own = own.withColumn("__cell", F.explode(F.sequence(_cell("__lo"), _cell("__hi"))))
    return rows.withColumn("__t", axis(rows, column)), own, sizes


def _cell(place: str) -> Column:
    return F.floor(F.col(place).cast("double") / F.pow(F.lit(4.0), F.col("__size") - 2))


def _hashable(df: DataFrame) -> list[str]:
    return [c for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]


def _asked(places: DataFrame, sizes: list[int]) -> DataFrame:
    """`places` once for each size class, with the cell they are in."""
    every = _present(places, "__t").withColumn("__size", F.explode(F.array(*map(F.lit, sizes)).cast("array<int>")))
    return every.withColumn("__cell", _cell("__t"))


def range_join(rows: DataFrame, ranges: DataFrame, column: str, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """`rows` with every range that holds their value, ends included; rows without one stay, with NULLs.

    Ranges are cut into cells a quarter to a sixteenth of their length wide and travel as blocks, one row for many
    ranges of a cell; a row goes to its cell of each size class (few, as lengths are doubles), and pairs are only made
    there, by unfolding blocks. So what is shuffled follows the rows and ranges, not their pairs. Cells with very many
    are dealt as tiles of `TILE_ROWS` by `TILE_RANGES`, to which each row and range there goes as often as tiles need
    it. Equal rows, and equal ranges, stay in one tile.
    """
    keyed, own, sizes = _on_cells(rows, ranges, column, lo, hi)
    cell = ["__size", "__cell"]
    n = own.groupBy(*cell).agg(F.count(F.lit(1)).cast("double").alias("__n"))
    m = _asked(keyed.select("__t"), sizes).groupBy(*cell).agg(F.count(F.lit(1)).cast("double").alias("__m"))
    counts = kept(n.join(m, cell), "cells")
    most = counts.agg(F.sum(F.col("__n") * F.col("__m"))).first()[0] or 0.0
    tasks = math.ceil(most / (TILE_ROWS * TILE_RANGES))
    if tasks > 1:
        tasks = max(tasks, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # By pairs: Spark would deal tasks by the size of blocks
    spread = lambda df, *keys: df.repartition(tasks, *keys) if tasks > 1 else df
    each = lambda k: F.explode(F.sequence(F.lit(0), k - 1))
    crowded = counts.filter((F.col("__n") > TILE_RANGES) | (F.col("__m") > TILE_ROWS))
    crowded = few_broadcast(crowded.select(*cell, F.ceil(F.col("__n") / TILE_RANGES).cast("int").alias("__parts"), F.ceil(F.col("__m") / TILE_ROWS).cast("int").alias("__deals")))
    parts, deals = (F.coalesce(F.col(c), F.lit(1)) for c in ("__parts", "__deals"))

    own = own.join(crowded, cell, "left").withColumn("__part", F.pmod(F.xxhash64(*(F.col("__r")[c] for c in _hashable(ranges))), parts).cast("int"))
    blocks = own.groupBy(*cell, "__part").agg(F.collect_list(F.struct("__r", "__lo", "__hi")).alias("__block"), F.max(deals).alias("__deals"))
    blocks = kept(blocks, "blocks")
    holds = lambda x: (F.col("__t") >= x["__lo"]) & (F.col("__t") <= x["__hi"])
    held = _asked(_present(keyed.select("__t"), "__t").distinct(), sizes).join(blocks.hint("shuffle_hash"), cell).filter(F.exists("__block", holds))

    # Rows without a range go to a class of their own, whose blocks hold one NULL: a union would make every pair twice
    tile, none, shares = [*cell, "__part", "__deal"], F.lit(NO_RANGE), max(tasks, 16)
    asked = keyed.join(held.select("__t", F.lit(True).alias("__held")).distinct(), "__t", "left")
    asked = asked.withColumn("__size", F.explode(F.when(F.col("__held"), F.array(*map(F.lit, sizes)).cast("array<int>")).otherwise(F.array(none))))
    asked = asked.withColumn("__cell", F.when(F.col("__size") == none, F.lit(0).cast("long")).otherwise(_cell("__t"))).join(crowded, cell, "left")
    deals = F.when(F.col("__size") == none, F.lit(shares)).otherwise(deals)
    asked = asked.withColumns({"__deal": F.pmod(F.xxhash64(*_hashable(rows)), deals).cast("int"), "__part": each(parts)}).drop("__parts", "__deals", "__held")
    empty = rows.sparkSession.range(shares).select(none.alias("__size"), F.lit(0).cast("long").alias("__cell"), F.lit(0).alias("__part"), F.col("id").cast("int").alias("__deal"))
    empty = empty.withColumn("__block", F.array(F.lit(None).cast(blocks.schema["__block"].dataType.elementType)))
    dealt = blocks.withColumn("__deal", each(F.col("__deals"))).drop("__deals").unionByName(empty)
    pairs = spread(asked, *tile).join(spread(dealt, *tile).hint("shuffle_hash"), tile).withColumn("__x", F.explode("__block"))
    return pairs.filter((F.col("__size") == none) | holds(F.col("__x"))).select(*rows.columns, "__x.__r.*")
