"""Joins along an axis: every bucket width, hot groups, ties, NULLs, against plain Python."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from latticeframe.operators import asof, couple, inventory


def tables(spark, seed):
    random.seed(seed)
    # Group `a` holds most rows of either side; many rows share a time
    g = lambda: random.choice(["a"] * 8 + ["b", "c", None])
    left = [(k, g(), random.choice([None, random.randint(-50, 50), random.randint(-5, 5)])) for k in range(300)]
    right = [(g(), random.choice([None, random.randint(-40, 40) * 2]), random.randint(0, 9)) for _ in range(120)]
    return left, right, spark.createDataFrame(left, "k long, g string, t long"), spark.createDataFrame(right, "g string, u long, v long")


@pytest.mark.parametrize("width", [None, 1.0, 7.0, 1000.0])
@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
def test_as_of_join(spark, direction, width):
    left, right, l, r = tables(spark, 3)
    got = {x.k: tuple(x.found) if x.found else None for x in asof.as_of_join(l, r, "t", "u", ("g",), direction, width).collect()}
    assert len(got) == len(left)
    for k, g, t in left:
        own = [(u, v) for h, u, v in right if h == g and u is not None] if g is not None and t is not None else []
        back = max((u for u, _ in own if u <= t), default=None)
        ahead = min((u for u, _ in own if u >= t), default=None)
        want = back if direction == "backward" else ahead
        if direction == "nearest":
            want = ahead if back is None or (ahead is not None and ahead - t < t - back) else back
        assert got[k] == (None if want is None else min((u, v) for u, v in own if u == want)), (k, g, t)


def test_one_group_is_many_tasks(spark):
    l = spark.range(4000).select("id", F.lit("hot").alias("g"), (F.col("id") * 10).alias("t"))
    r = spark.range(1000).select(F.lit("hot").alias("g"), (F.col("id") * 40 + 3).alias("u"), F.col("id").alias("v"))
    out = asof.as_of_join(l, r, "t", "u", ("g",), width=100.0)
    assert "hashpartitioning(g" in out._jdf.queryExecution().executedPlan().toString() and "__bucket" in out._jdf.queryExecution().executedPlan().toString()
    assert all((x.found.v if x.found else -1) == math.floor((x.t - 3) / 40) for x in out.collect())
    assert asof.as_of_join(l.limit(0), r, "t", "u", ("g",)).count() == 0
    assert asof.as_of_join(l.limit(5), r.limit(0), "t", "u", ("g",)).filter("found is null").count() == 5


def test_doubles_and_dates_as_axes(spark):
    l = spark.createDataFrame([(1, 2.5), (2, float("nan")), (3, -1.0)], "k long, t double")
    r = spark.createDataFrame([(2.25, "x"), (-1.0, "y"), (float("nan"), "z")], "u double, v string")
    assert {x.k: x.found and x.found.v for x in asof.as_of_join(l, r, "t", "u").collect()} == {1: "x", 2: None, 3: "y"}
    d = spark.sql("select * from values (1, timestamp'2024-01-02 23:00:00'), (2, timestamp'2024-01-10 01:00:00'), (3, null) as t(k, acq)")
    s = spark.sql("select * from values (timestamp'2024-01-01 22:00:00', 'a'), (timestamp'2024-01-03 09:00:00', 'b'), (timestamp'2024-01-03 08:00:00', 'c') as t(ts, v)")
    got = {x.k: x.v for x in couple.nearest_in_time(d, s, "k", by_date=True).collect()}
    assert got == {1: "a", 2: "c", 3: None}  # a day before and a day after: the earlier one


@pytest.mark.parametrize("width", [None, 1.0, 9.0, 1000.0])
def test_running_sums(spark, width):
    left, right, l, r = tables(spark, 5)
    keys = l.select("g", F.col("t").alias("__t")).dropna().distinct()
    sums = asof.running_at(keys, r.withColumnRenamed("u", "__t"), ("g",), {"s": F.col("v"), "n": F.lit(1).cast("long")}, width)
    got = {(x.g, x["__t"]): (x.s, x.n) for x in sums.collect()}
    assert len(got) == len({(g, t) for _, g, t in left if g is not None and t is not None})
    for (g, t), found in got.items():
        own = [v for h, u, v in right if h == g and u is not None and u <= t]
        assert found == (sum(own), len(own))


def test_ranges_of_all_lengths(spark):
    random.seed(8)
    ranges = [(k, lo, lo + random.choice([-1, 0, 0, 1, 3, 16, 1000, 10**9])) for k in range(80) for lo in [random.randint(-60, 60)]] + [(98, None, 5), (99, 5, None)]
    values = [(k, random.choice([None, random.randint(-100, 200)])) for k in range(200)]
    r, x = spark.createDataFrame(ranges, "name long, lo long, hi long"), spark.createDataFrame(values, "k long, t long")
    got = sorted((a.k, -1 if a.name is None else a.name) for a in asof.range_join(x, r, "t").collect())
    want = []
    for k, t in values:
        found = [n for n, lo, hi in ranges if None not in (t, lo, hi) and lo <= t <= hi]
        want += [(k, n) for n in found] or [(k, -1)]
    assert got == sorted(want)


def _shuffled_rows(plan) -> int:
    """Rows written to exchanges by a query that has run."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        return _shuffled_rows(plan.executedPlan())
    if "QueryStage" in plan.nodeName():
        return _shuffled_rows(plan.plan())
    found, below = plan.metrics().get("shuffleRecordsWritten"), plan.children()
    own = found.get().value() if plan.nodeName() == "Exchange" and found.isDefined() else 0
    return own + sum(_shuffled_rows(below.apply(k)) for k in range(below.size()))


def test_pairs_of_ranges_are_not_shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        x = spark.range(300).select(F.col("id").alias("k"), (F.col("id") / 3).alias("t"))
        r = spark.range(300).select(F.col("id").alias("name"), (-F.col("id") / 7).alias("lo"), (F.col("id") / 7 + 100).alias("hi"))
        df = asof.range_join(x, r, "t")
        assert len(df.collect()) == 300 * 300
        assert _shuffled_rows(df._jdf.queryExecution().executedPlan()) < 300 * 300 / 10
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("tile", [(16_384, 4096), (5, 3)])
def test_odd_ranges_in_tiles(spark, monkeypatch, tile):
    monkeypatch.setattr(asof, "TILE_ROWS", tile[0])
    monkeypatch.setattr(asof, "TILE_RANGES", tile[1])
    random.seed(9)
    inf, nan = float("inf"), float("nan")
    ends = [-inf, -1.7e308, -1e12, -3.0, -0.0, 0.0, 1e-300, 0.1, 0.30000000000000004, 7.0, 1e12, 1e12 + 0.001, 1.7e308, inf, nan, None]
    ranges = [(k, a, b) for k, (a, b) in enumerate((a, b) for a in ends for b in ends)] + [(k, 2.0, 9.0) for k in range(300, 320)] + [(0, -inf, inf)] * 2
    values = [(k, t) for k, t in enumerate(ends + [random.uniform(-5, 10) for _ in range(20)] + [5.0] * 15)] + [(0, 5.0)] * 2
    r, x = spark.createDataFrame(ranges, "name long, lo double, hi double"), spark.createDataFrame(values, "k long, t double")
    usual = lambda v: None if v is None or v != v else v
    for kept in (ranges, [y for y in ranges if y[0] >= 300 and y[2] == 9.0], []):
        got = asof.range_join(x, r.filter(F.col("name").isin([y[0] for y in kept])) if kept else r.limit(0), "t").collect()
        want = []
        for k, t in values:
            found = [n for n, lo, hi in kept if None not in map(usual, (t, lo, hi)) and lo <= t <= hi]
            want += [(k, n) for n in found] or [(k, -1)]
        assert sorted((a.k, -1 if a.name is None else a.name) for a in got) == sorted(want)


def test_lookups_beyond_the_broadcast_bounds(spark, monkeypatch):
    rows = spark.range(-3, 50).select(F.col("id").alias("year"))
    versions = spark.range(0, 40, 4).select(F.col("id").alias("version"))
    few = sorted(inventory.as_of(rows, versions, "year", "version").collect(), key=lambda x: x.year)
    ranges = spark.createDataFrame([(1, 0, 9), (2, 5, 12), (3, 30, 30)], "v long, lo long, hi long")
    told = sorted(tuple(x) for x in inventory.in_range(rows, ranges, "year").fillna(-1).collect())
    monkeypatch.setattr(inventory, "MOST_VERSIONS", 3)
    monkeypatch.setattr(inventory, "MOST_RANGES", 1)
    assert sorted(inventory.as_of(rows, versions, "year", "version").collect(), key=lambda x: x.year) == few
    assert sorted(tuple(x) for x in inventory.in_range(rows, ranges, "year").fillna(-1).collect()) == told
