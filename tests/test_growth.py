"""Work that must not grow faster than the input: what a step joins, broadcasts and holds."""

from __future__ import annotations

import datetime as dt

from oracle import SF, both
from pyspark.sql import functions as F

from latticeframe.operators import couple, shapes
from latticeframe.plans import registry


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_anchors_of_one_time_are_matched_once(spark, monkeypatch):
    asked, inner = [], couple.interval_join

    def watched(anchors, *rest, **more):
        asked.append((anchors.count(), anchors.select("acq").distinct().count()))
        return inner(anchors, *rest, **more)

    monkeypatch.setattr(couple, "interval_join", watched)
    for name in ("couple_best_match", "first_partner", "couple_drop_reasons", "couple_tally", "couple_job", "couple_manifest_job"):
        registry.queries()[name](spark, SF).count()
    assert len(asked) >= 6 and all(rows == times for rows, times in asked)


def test_best_by_time_equals_best_of_pairs(spark):
    start = dt.datetime(2020, 1, 1)
    anchors = spark.createDataFrame([(k, start + dt.timedelta(hours=7 * (k % 40)) if k % 13 else None) for k in range(1, 120)] + [(None, start)], "id int, acq timestamp")
    cand = spark.createDataFrame(
        [(f"c{k:02d}", start + dt.timedelta(hours=11 * k), (k * 37 % 10) / 10 if k % 7 else float("nan"), k) for k in range(30)], "cand string, acq timestamp, clear_frac double, size int"
    )
    for strict in (False, True):
        want = couple.best_match(anchors, couple.interval_join(anchors, cand), "id", "cand", 0.6, strict=strict)
        got = couple.best_by_time(anchors, cand, "id", "cand", 0.6, strict=strict, carry=("size", "cand_acq"))
        assert sorted(map(str, got.drop("size", "cand_acq").collect())) == sorted(map(str, want.collect()))
        assert {(r["cand"], r["size"]) for r in got.collect() if r["cand"]} <= {(f"c{k:02d}", k) for k in range(30)}


def test_counts_of_many_shapes_are_not_broadcast(spark):
    cells = spark.range(150_000).select(F.col("id").alias("shape_id"), F.lit(1).alias("row"), F.lit(2).alias("col"), F.lit(3.0).alias("area"))
    many = shapes.spread_area(cells, "shape_id", "area")
    assert "Broadcast" not in _plan(many)
    assert "Broadcast" in _plan(shapes.spread_area(cells.limit(10), "shape_id", "area"))
    assert many.filter("cell_area = 3").count() == 150_000


def test_stage2_values_beyond_the_range_are_none(spark, tmp_path):
    rows = [(k, k % 3, [(-1) ** k * (0.02 * (k % 30) + (0.3 if i % 5 == 0 else 0.0)) for i in range(24)]) for k in range(60)]
    rows += [(60, 7, [0.9] * 24), (61, 7, [float("nan")] * 24), (62, 8, [0.5, -0.5] * 12)]
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    table.toPandas().to_parquet(tmp_path / "embeddings.parquet")
    ours, theirs = both(spark, registry.queries()["stage2_profiles"], registry.oracle_sql()["stage2_profiles"], str(tmp_path))
    assert ours == theirs and ours


def test_orphans_and_nearest_hash_the_smaller_side(spark):
    from latticeframe.operators import inventory, neighbourhood

    child, parent = spark.range(50).select(F.when(F.col("id") % 9 > 0, F.col("id")).alias("k")), spark.range(0, 50, 2).select(F.col("id").alias("p"))
    lost = inventory.orphans(child, parent, "k", "p")
    assert "ShuffledHashJoin" in _plan(lost) and lost.count() == 6 + sum(1 for k in range(50) if k % 9 and k % 2)
    px = spark.range(400).select((F.col("id") / 20).cast("int").alias("row"), (F.col("id") % 20).cast("int").alias("col"), F.col("id").alias("x"))
    near = neighbourhood.nearest(px.select("row", "col"), px, [], ["x"], (F.col("row") + 0.5) / 2, (F.col("col") + 0.5) / 2)
    assert "ShuffledHashJoin" in _plan(near)
    assert all(r["x"] == r["row"] // 2 * 20 + r["col"] // 2 for r in near.collect())


def test_tree_of_more_members_than_its_sql_has_levels_for(spark):
    import hashlib

    from latticeframe.functions import hashes

    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    level = sorted(sha(str(k)) for k in range(5000))
    while len(level) > 1:
        level = [sha("".join(level[i : i + 16])) for i in range(0, len(level), 16)]
    got = hashes.tree_checksum(spark.range(5000).select(F.lit("a").alias("source"), F.col("id").cast("string").alias("text")), ["source"], "text", 16).collect()
    assert [(r["source"], r["n_members"], r["checksum"]) for r in got] == [("a", 5000, level[0])]


def test_weather_job_reads_asked_cells_and_looks_each_time_up_once(spark, monkeypatch):
    from latticeframe.operators import asof, weather_series
    from latticeframe.plans import jobs

    seen, targets, running = {}, weather_series.at_targets, asof.running_at
    monkeypatch.setattr(weather_series, "at_targets", lambda t, s, *rest: seen.update(cells={r["cell"] for r in s.select("cell").distinct().collect()}) or targets(t, s, *rest))
    monkeypatch.setattr(asof, "running_at", lambda keys, *rest: seen.update(keys=keys.count()) or running(keys, *rest))
    start = dt.datetime(2024, 1, 1)
    hours = [(c, start + dt.timedelta(hours=h), float(h % 24), 290.0) for c in range(6) for h in range(100)]
    series = spark.createDataFrame(hours, "cell long, ts timestamp, ssrd double, t2m double").selectExpr("*", "ssrd as tp", "t2m - 5 as d2m", "1D as u10", "2D as v10")
    noon = start + dt.timedelta(days=3, hours=12, minutes=20)
    rows = [(k, k % 2, noon) for k in range(30)] + [(None, 0, noon), (99, 5, None), (100, None, noon)]
    scenes = spark.createDataFrame(rows, "scene_id long, cell long, acq timestamp")
    none = spark.createDataFrame([], "geometry_id string, row int, col int, horizon array<float>"), spark.createDataFrame([], "geometry_id string, scene_id long, azimuth double, elevation double")
    out = jobs.dynamic_products(scenes, series, ["cell"], *none)[0]
    assert seen == {"cells": {0, 1, 5}, "keys": 2 * 4}
    got = out.collect()
    assert len(got) == len(rows) and {r["acq"] for r in got} == {noon, None}
    assert all((r["n_hours"], r["t2m_scene"]) == ((72, 290.0) if r["scene_id"] in range(30) else (0, None)) for r in got)
