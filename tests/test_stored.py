"""Stored layers without exchange, Morton order with pruning, profile states that merge."""

from __future__ import annotations

import math
import random
import uuid

import pytest
from pyspark.sql import functions as F

from latticeframe.functions.contracts import LayerContract
from latticeframe.functions.lattice import morton
from latticeframe.operators import grids, profile_states
from latticeframe.sources import layers, sinks

PIXEL = ["scene_id", "row", "col"]


def _name() -> str:
    return f"t_{uuid.uuid4().hex}"


def test_stored_layers_join_without_exchange(spark, tmp_path):
    px = spark.range(4000).select((F.col("id") % 3).cast("int").alias("scene_id"), F.expr("cast(id div 50 as int) as row"), (F.col("id") % 50).cast("int").alias("col"), (F.col("id") * 2).alias("a"), (F.col("id") + 1).alias("b"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        one = layers.store_layer(px.select(*PIXEL, "a"), _name(), f"{tmp_path}/a", PIXEL, 5)
        layers.store_layer(px.select(*PIXEL, "b"), _name(), f"{tmp_path}/b", PIXEL, 5)
        # As another session without a common catalog would find it
        two = layers.open_layer(spark, _name(), f"{tmp_path}/b", "scene_id int, row int, col int, b bigint", PIXEL, 5)
        both = grids.co_register([one, two, one.select(*PIXEL, F.col("a").alias("c"))], PIXEL)
        assert layers.exchanges(both) == 0
        assert layers.exchanges(grids.co_register([px.select(*PIXEL, "a"), px.select(*PIXEL, "b")], PIXEL)) == 2
        assert both.count() == 4000 and both.filter("b <> a / 2 + 1 or c <> a").count() == 0
        assert len(list((tmp_path / "a").glob("*.parquet"))) == 5
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    with pytest.raises(ValueError):
        layers.store_layer(px, _name(), f"{tmp_path}/c", PIXEL, 0)


def test_a_static_layer_and_scenes_of_it(spark, tmp_path):
    static = spark.range(600).select(F.lit("g").alias("geometry_id"), F.expr("cast(id div 30 as int) as row"), (F.col("id") % 30).cast("int").alias("col"), F.when(F.col("id") % 7 != 0, F.col("id").cast("double")).alias("height"))
    scenes = spark.range(1800).select((F.col("id") % 3).cast("int").alias("scene_id"), F.lit("g").alias("geometry_id"), F.expr("cast(id div 3 div 30 as int) as row"), (F.expr("id div 3") % 30).cast("int").alias("col"))
    keys = ["geometry_id", "row", "col"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        s = layers.store_layer(static, _name(), f"{tmp_path}/s", keys, 4)
        x = layers.store_layer(scenes, _name(), f"{tmp_path}/x", keys, 4)
        out = grids.with_static_validity(x, s, [LayerContract("height", 0, 1000)])
        assert layers.exchanges(out) == 0
        assert out.filter("static_valid").count() == 3 * (600 - 86)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_morton_interleaves_bits(spark):
    rng = random.Random(3)
    cells = [(0, 0), (0, 1), (1, 0), (2**31 - 1, 2**31 - 1), (2**31 - 1, 0)] + [(rng.randrange(2**31), rng.randrange(2**31)) for _ in range(50)]
    plain = [sum(((r >> i & 1) << (2 * i + 1)) | ((c >> i & 1) << (2 * i)) for i in range(31)) for r, c in cells]
    rows = spark.createDataFrame([(i, r, c) for i, (r, c) in enumerate(cells)], "i int, row int, col int")
    assert [r[0] for r in rows.orderBy("i").select(morton(F.col("row"), F.col("col"))).collect()] == plain
    off = spark.createDataFrame([(-1, 2), (None, 2), (2, None)], "row int, col int")
    assert [r[0] for r in off.select(morton(F.col("row"), F.col("col"))).collect()] == [None] * 3


def _rows_scanned(df) -> int:
    df._jdf.collectToPython()
    plan = df._jdf.queryExecution().executedPlan()
    while plan.children().size():
        plan = plan.children().head()
    if plan.getClass().getSimpleName().startswith("AdaptiveSparkPlan"):
        plan = plan.executedPlan()
    return plan.metrics().apply("numOutputRows").value()


def test_a_window_reads_few_row_groups(spark, tmp_path):
    n = 400
    px = spark.range(n * n).select(F.lit(1).alias("scene_id"), F.expr(f"cast(id div {n} as int) as row"), (F.col("id") % n).cast("int").alias("col"), F.rand(7).alias("b"))
    sinks.write_pixels(px, [LayerContract("b", 0, 1, dtype="double")], str(tmp_path / "px"), 32)
    stored = spark.read.parquet(str(tmp_path / "px"))
    assert stored.count() == n * n
    got = grids.window(stored, 130, 200, 40, 40)
    assert got.count() == 1600 and got.agg(F.max("row"), F.max("col")).first()[:] == (39, 39)
    # One file holds 32 x 32 cells in one row group, so rows that leave the scan are rows of the groups that were read.
    assert 1600 <= _rows_scanned(got.select("row", "col", "b")) < 0.05 * n * n


def test_pixels_off_the_grid_are_written_too(spark, tmp_path):
    rows = [(1, -1, 0, 0.5), (1, 0, 0, 0.25), (1, None, 3, 0.75), (2, 5, 5, float("nan")), (2, 5, 5, float("nan"))]
    sinks.write_pixels(spark.createDataFrame(rows, "scene_id int, row int, col int, b double"), [LayerContract("b", 0, 1, dtype="double")], str(tmp_path / "px"))
    got = spark.read.parquet(str(tmp_path / "px"))
    assert got.count() == 5 and got.filter("isnan(b)").count() == 2 and got.filter("row is null").count() == 1


WANTED = [LayerContract("a", 0, 10), LayerContract("k", 200, 350)]


def _scene(scene: int, n: int, seed: int):
    rng = random.Random(seed)
    return [(scene, rng.uniform(-2, 12) if i % 5 else float("nan"), rng.gauss(290, 0.01) if i % 3 else None) for i in range(n)]


SCHEMA = "scene_id int, a double, k double"


def test_merged_states_equal_one_pass(spark):
    rows = _scene(1, 300, 1) + _scene(2, 50, 2) + _scene(3, 1, 3) + [(4, float("nan"), None)]
    px = spark.createDataFrame(rows, SCHEMA)
    held = profile_states.states(px, ["scene_id"], WANTED)
    got = profile_states.profile_of(held, ["scene_id"])
    plain = grids.profile_with_histogram(px, ["scene_id"], WANTED)
    by = lambda df: {(r["scene_id"], r["channel_name"]): r.asDict() for r in df.collect()}
    assert by(got) == by(plain.select(*got.columns))
    totals = {r["channel_name"]: r for r in profile_states.with_totals(held, "scene_id").filter("is_total").collect()}
    for k, name in ((1, "a"), (2, "k")):
        xs = [r[k] for r in rows if r[k] is not None and not math.isnan(r[k])]
        mean = math.fsum(xs) / len(xs)
        std = math.sqrt(math.fsum((x - mean) ** 2 for x in xs) / len(xs))
        t = totals[name]
        assert (t["valid_px"], t["scene_id"]) == (len(xs), None) and sum(t["histogram"].values()) == len(xs)
        assert t["mean"] == pytest.approx(mean, abs=1e-6) and t["std"] == pytest.approx(std, abs=1e-6)
        assert (t["min"], t["max"]) == (round(min(xs), 6), round(max(xs), 6))
    # In any order and grouping
    half = profile_states.merge(held.filter("scene_id < 3"), []).unionByName(profile_states.merge(held.filter("scene_id >= 3"), []))
    again = {r["channel_name"]: r for r in profile_states.profile_of(profile_states.merge(half, []), []).collect()}
    assert all(again[n]["histogram"] == totals[n]["histogram"] and again[n]["std"] == totals[n]["std"] for n in again)
    assert profile_states.states(px.limit(0), ["scene_id"], WANTED).count() == 0


def test_a_new_scene_reads_its_own_files_only(spark, tmp_path):
    px, folder = str(tmp_path / "px"), str(tmp_path / "states")
    spark.createDataFrame(_scene(1, 200, 1) + _scene(2, 100, 2), SCHEMA).write.partitionBy("scene_id").parquet(px)
    scenes = lambda *rows: spark.createDataFrame(rows, "scene_id int, version string")
    assert profile_states.refresh(spark.read.parquet(px), scenes((1, "v"), (2, "v"), (None, "v")), folder, WANTED) == 2
    assert profile_states.refresh(spark.read.parquet(px), scenes((1, "v"), (2, "v")), folder, WANTED) == 0

    # A third scene: the files of the first two may be gone
    reader = spark.read.schema(SCHEMA)
    spark.createDataFrame(_scene(3, 80, 3), SCHEMA).write.partitionBy("scene_id").mode("append").parquet(px)
    listed = reader.parquet(px)
    for f in (tmp_path / "px" / "scene_id=1").glob("*"):
        f.unlink()
    assert profile_states.refresh(listed, scenes((1, "v"), (2, "v"), (3, "v")), folder, WANTED) == 1
    totals = profile_states.with_totals(profile_states.held(spark, folder), "scene_id")
    everything = spark.createDataFrame(_scene(1, 200, 1) + _scene(2, 100, 2) + _scene(3, 80, 3), SCHEMA)
    full = {r["channel_name"]: r for r in profile_states.profile_of(profile_states.states(everything, [], WANTED), []).collect()}
    for r in totals.filter("is_total").collect():
        assert all(r[c] == pytest.approx(full[r["channel_name"]][c], abs=1e-6) for c in ("valid_px", "mean", "std", "min", "max"))
        assert r["histogram"] == full[r["channel_name"]]["histogram"]

    # A new version replaces a scene's states; a scene that lost all pixels has none
    spark.createDataFrame(_scene(2, 10, 9), SCHEMA).write.partitionBy("scene_id").mode("append").parquet(px)
    assert profile_states.refresh(reader.parquet(px), scenes((1, "w"), (2, "w"), (3, "v")), folder, WANTED) == 2
    held = profile_states.held(spark, folder)
    assert {r["scene_id"] for r in held.collect()} == {2, 3}
    assert held.filter("scene_id = 2 and channel_name = 'k'").first()["n"] == sum(1 for r in _scene(2, 100, 2) + _scene(2, 10, 9) if r[2] is not None)
    # States without ledger rows, of a run that was lost, don't count
    profile_states.states(everything, ["scene_id"], WANTED).write.parquet(f"{folder}/states/run=run-lost")
    assert profile_states.held(spark, folder).count() == held.count()


def test_more_scenes_than_fit_a_list_are_joined(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(profile_states, "MOST_LISTED", 1)
    px = spark.createDataFrame(_scene(1, 20, 1) + _scene(2, 30, 2) + _scene(5, 9, 5), SCHEMA)
    scenes = spark.createDataFrame([(1, "v"), (2, "v")], "scene_id int, version string")
    folder = str(tmp_path / "s")
    assert profile_states.refresh(px, scenes, folder, WANTED) == 2
    assert {r["scene_id"] for r in profile_states.held(spark, folder).collect()} == {1, 2}
    assert profile_states.refresh(px, scenes, folder, WANTED) == 0
