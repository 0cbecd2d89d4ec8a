"""Neighbourhood operators against plain NumPy on a ragged grid, for several tile sizes."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from latticeframe.operators import grids, neighbourhood, shapes, terrain

ROWS, COLS = 37, 53
rng = np.random.default_rng(5)


def as_table(spark, **layers):
    names = list(layers)
    rows = [(r, c, *(layers[n][r, c].item() for n in names)) for r in range(ROWS) for c in range(COLS)]
    return spark.createDataFrame(rows, "row int, col int, " + ", ".join(f"{n} double" for n in names))


def as_grid(df, name, rows=ROWS, cols=COLS):
    out = np.full((rows, cols), np.nan)
    for r in df.collect():
        out[r["row"], r["col"]] = np.nan if r[name] is None else float(r[name])
    return out


@pytest.mark.parametrize("radius", [1, 3])
def test_dilate(spark, radius):
    mask = rng.random((ROWS, COLS)) < 0.02
    got = as_grid(neighbourhood.dilate(as_table(spark, m=mask.astype(float)), [], F.col("m") == 1, radius), "buffer")
    near = np.zeros_like(mask)
    for r, c in zip(*np.nonzero(mask), strict=True):
        near[max(0, r - radius) : r + radius + 1, max(0, c - radius) : c + radius + 1] = True
    assert (got == (near & ~mask)).all()


@pytest.mark.parametrize("azimuth,elevation", [(180.0, 45.0), (90.0, 30.0), (225.0, 60.0), (10.0, 0.4), (0.0, 90.0)])
def test_shift(spark, azimuth, elevation):
    mask = rng.random((ROWS, COLS)) < 0.1
    step = neighbourhood.shadow_shift(azimuth, elevation, 60.0, 10.0)
    if elevation <= 0.5 or elevation == 90:
        assert step is None
        return
    got = neighbourhood.shifted(as_table(spark, m=mask.astype(float)), [], F.col("m") == 1, F.lit(step[0]), F.lit(step[1]), ROWS, COLS)
    want = {(r + step[0], c + step[1]) for r, c in zip(*np.nonzero(mask), strict=True)}
    assert {(x["row"], x["col"]) for x in got.collect()} == {(r, c) for r, c in want if 0 <= r < ROWS and 0 <= c < COLS}


def test_shadow_falls_away_from_the_sun():
    assert neighbourhood.shadow_shift(180.0, 45.0, 100.0, 10.0) == (-10, 0)  # sun in the south, shadow to the north
    assert neighbourhood.shadow_shift(90.0, 45.0, 100.0, 10.0) == (0, -10)


def test_upsample(spark):
    z = rng.random((ROWS, COLS))
    z[rng.random((ROWS, COLS)) < 0.2] = np.nan
    fine = spark.createDataFrame([(r, c) for r in range(2 * ROWS) for c in range(2 * COLS)], "row int, col int")
    got = as_grid(neighbourhood.upsample2(fine, as_table(spark, z=z), [], ["z"]), "z", 2 * ROWS, 2 * COLS)
    for r in range(2 * ROWS):
        for c in range(2 * COLS):
            y, x = (r + 0.5) / 2 - 0.5, (c + 0.5) / 2 - 0.5
            total = weight = 0.0
            for i in (math.floor(y), math.floor(y) + 1):
                for j in (math.floor(x), math.floor(x) + 1):
                    w = (1 - abs(y - i)) * (1 - abs(x - j))
                    if w > 0 and 0 <= i < ROWS and 0 <= j < COLS and not np.isnan(z[i, j]):
                        total, weight = total + w * z[i, j], weight + w
            assert np.isnan(got[r, c]) if weight == 0 else abs(got[r, c] - total / weight) < 1e-9


def plain_horizon(z, cell, radius, n, east_north):
    out = np.full((*z.shape, n), 65535)
    for r in range(z.shape[0]):
        for c in range(z.shape[1]):
            if np.isnan(z[r, c]):
                continue
            for k in range(n):
                east, north = east_north(2 * math.pi * k / n)
                best = 0.0
                for s in range(1, radius + 1):
                    i, j = r + round(-north * s), c + round(east * s)
                    if 0 <= i < z.shape[0] and 0 <= j < z.shape[1] and not np.isnan(z[i, j]):
                        best = max(best, math.degrees(math.atan2(z[i, j] - z[r, c], s * cell)))
                out[r, c, k] = round(best * 100)
    return out


@pytest.mark.parametrize("convention", ["compass", "math"])
def test_horizon_for_every_tile_size(spark, convention):
    z = np.round(rng.random((ROWS, COLS)) * 40, 2)
    z[3, 4] = z[20, 20] = np.nan
    way = (lambda a: (math.sin(a), math.cos(a))) if convention == "compass" else (lambda a: (math.cos(a), math.sin(a)))
    want = plain_horizon(z, 10.0, 5, 36, way)
    table = as_table(spark, z=z)
    for tile in (8, 16, 64):
        got = terrain.horizon(table, [], "z", 10.0, 50.0, tile=tile, convention=convention).collect()
        assert len(got) == ROWS * COLS
        for x in got:
            assert np.abs(np.array(x["horizon"]) - want[x["row"], x["col"]]).max() <= 1


def test_flat_ground_has_no_horizon_and_full_sky(spark):
    flat = as_table(spark, z=np.full((ROWS, COLS), 3.0))
    assert {tuple(x["horizon"]) for x in terrain.horizon(flat, [], "z", 10.0, 50.0).collect()} == {(0,) * 36}
    assert {x["svf"] for x in terrain.sky_view(flat, [], "z", 10.0).collect()} == {1.0}


def test_shadow(spark):
    bands = list(range(0, 3600, 100))
    df = spark.createDataFrame([(bands, 355.0, 17.4), (bands, 355.0, 17.6), (bands, 5.0, 0.4), (bands, 360.0, 0.0), (bands[:-1] + [65535], 355.0, 1.0)], "h array<int>, az double, el double")
    got = [x[0] for x in df.select(terrain.shadow(F.col("h"), F.col("az"), F.col("el"))).collect()]
    assert got == [1, 0, 1, 255, 255]


def test_blocks_on_a_ragged_grid(spark):
    ok = rng.random((ROWS, COLS)) < 0.9
    got = grids.block_support(as_table(spark, m=ok.astype(float)), [], F.col("m") == 1, 10, ROWS, COLS).collect()
    assert len(got) == 4 * 6
    for x in got:
        part = ok[x["brow"] * 10 : x["brow"] * 10 + 10, x["bcol"] * 10 : x["bcol"] * 10 + 10]
        assert (x["valid_px"], x["present_px"]) == (part.sum(), part.size)


def test_halo_holds_the_padded_box(spark):
    got = neighbourhood.with_halo(as_table(spark, m=np.zeros((ROWS, COLS))), 16, 3).groupBy("tile_row", "tile_col").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_core").alias("core")
    )
    seen = {(x.tile_row, x.tile_col): (x.n, x.core) for x in got.collect()}
    assert seen[1, 1] == (22 * 22 if ROWS >= 35 else 0, 256)
    assert sum(core for _, core in seen.values()) == ROWS * COLS


def test_box_cells_and_overlap(spark):
    boxes = spark.createDataFrame([(1, 0.0, 0.0, 2.0, 2.0), (2, 0.4, 0.4, 1.4, 1.4), (3, 0.6, 0.6, 0.9, 0.9)], "k long, x0 double, y0 double, x1 double, y1 double")
    cells = shapes.box_cells(boxes, *(F.col(c) for c in ("x0", "y0", "x1", "y1"))).select("k", "row", "col")
    got = {}
    for x in cells.collect():
        got.setdefault(x.k, set()).add((x.row, x.col))
    assert got == {1: {(0, 0), (0, 1), (1, 0), (1, 1)}, 2: {(0, 0)}}
    other = spark.createDataFrame([(0, 0), (0, 0), (0, 1)], "row int, col int")
    told = {x.k: x for x in shapes.overlap_filter(cells, other, "k").collect()}
    assert (told[1].overlap_frac, told[1].kept) == (0.75, True)
    assert (told[2].overlap_frac, told[2].kept) == (2.0, True)  # overlapping shapes are summed, not united


def test_histogram_edges(spark):
    from latticeframe.functions.contracts import LayerContract

    df = spark.createDataFrame([(x,) for x in (0.0, 0.05, 0.999, 1.0, 5.0, -5.0, float("nan"), None)], "a double")
    got = {x.bin: x.n for x in grids.histograms(df.withColumn("k", F.lit(1)), ["k"], [LayerContract("a", 0, 1)], 10).collect()}
    assert got == {"000": 3, "009": 3}
    empty = grids.profile_with_histogram(df.filter("a is null").withColumn("k", F.lit(1)), ["k"], [LayerContract("a", 0, 1)]).first()
    assert empty.valid_px == 0 and empty["mean"] is None and empty.histogram == {}


def test_rings_of_any_outline(spark):
    random = np.random.default_rng(11)
    rings = {k: [[tuple(p) for p in random.uniform(-3, 17, (random.integers(3, 9), 2))] for _ in range(random.integers(1, 4))] for k in range(12)}
    square = lambda a, b: [(a, a), (b, a), (b, b), (a, b)]
    rings |= {50: [square(0.0, 9.0), square(2.0, 7.0)[::-1], square(4.0, 5.0)], 51: [square(0.5, 2.5) + [(0.5, 0.5)]], 52: [[(0.0, 0.0), (5.0, 5.0)]], 53: [[(1.0, 2.0), (8.0, 2.0), (3.0, 2.0)]]}
    rows = [(k, [(float(x), float(y)) for x, y in ring]) for k, own in rings.items() for ring in own]
    rows += [(54, [(0.0, 0.0), (float("nan"), 1.0), (4.0, 0.0), None, (4.0, 4.0)]), (55, None), (56, [])]
    df = spark.createDataFrame(rows, "k long, ring array<struct<x: double, y: double>>")
    got = {(r.k, r.row, r.col) for r in shapes.ring_cells(df, ["k"]).collect()}
    rings[54] = [[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0)]]

    def inside(own, x, y):
        odd = False
        for ring in own:
            for (xa, ya), (xb, yb) in zip(ring, ring[1:] + ring[:1], strict=True):
                if min(ya, yb) <= y < max(ya, yb) and xa + (y - ya) / (yb - ya) * (xb - xa) > x:
                    odd = not odd
        return odd

    want = {(k, r, c) for k, own in rings.items() for r in range(-4, 18) for c in range(-4, 18) if inside(own, c + 0.5, r + 0.5)}
    assert got == want
    assert shapes.ring_cells(df.limit(0), ["k"]).count() == 0


@pytest.mark.parametrize("radius", [0, 1, 3, 31, 32, 50])
def test_dilate_across_tiles_and_scenes(spark, radius):
    random = np.random.default_rng(radius)
    masks = {"a": random.random((70, 101)) < 0.002, None: random.random((9, 70)) < 0.01, "c": np.zeros((3, 3), bool)}
    rows = [(g, r - 5, c - 40, bool(m[r, c]) or None) for g, m in masks.items() for r in range(m.shape[0]) for c in range(m.shape[1])]
    df = spark.createDataFrame(rows, "g string, row int, col int, m boolean")
    for tile in (32, 64):
        got = {(x.g, x.row, x.col): x.buffer for x in neighbourhood.dilate(df, ["g"], F.col("m"), radius, tile).collect()}
        assert len(got) == len(rows)
        for g, m in masks.items():
            want = np.zeros_like(m)
            for r, c in zip(*np.nonzero(m), strict=True):
                want[max(r - radius, 0) : r + radius + 1, max(c - radius, 0) : c + radius + 1] = True
            assert all(got[g, r - 5, c - 40] == (want[r, c] and not m[r, c]) for r in range(m.shape[0]) for c in range(m.shape[1]))
