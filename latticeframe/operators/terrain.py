"""Horizons, sky view and shadows over surface models (NB-07, NB-08, PRJ-21)."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from latticeframe.operators.neighbourhood import with_halo

# Bands of a horizon cube, their unit and the value for no data.
DIRECTIONS, CENTIDEGREES, NO_HORIZON, NO_SHADOW = 36, 100, 65535, 255


def _steps(n: int, radius: int, convention: str) -> list[list[tuple[int, int, int]]]:
    """Per direction the (row, col) offsets of each step and its number."""
    out = []
    for k in range(n):
        a = 2 * math.pi * k / n
        # compass: 0 is north, clockwise; math: 0 is east, counter-clockwise. Rows grow to the south.
        east, north = (math.sin(a), math.cos(a)) if convention == "compass" else (math.cos(a), math.sin(a))
        out.append([(round(-north * r), round(east * r), r) for r in range(1, radius + 1)])
    return out


def _tile_angles(z: np.ndarray, core: tuple[slice, slice], steps, cell: float) -> np.ndarray:
    """Largest elevation angle (degrees, 0 at least) in each direction for the core of a padded tile."""
    rows, cols = z[core].shape
    top, left = core[0].start, core[1].start
    base = z[core]
    out = np.zeros((len(steps), rows, cols))
    for k, way in enumerate(steps):
        for dr, dc, r in way:
            seen = z[top + dr : top + dr + rows, left + dc : left + dc + cols]
            angle = np.degrees(np.arctan2(seen - base, r * cell))
            np.fmax(out[k], angle, out=out[k])  # fmax: a target without height hides nothing
    return out


def _per_tile(df: DataFrame, keys: list[str], height: str, tile: int, halo: int, schema: str, finish) -> DataFrame:
    """Run `finish(padded heights, core slices) -> columns` on every tile; absent cells are NaN."""
    halod = with_halo(df.select(*keys, "row", "col", F.col(height).cast("double").alias("__z")), tile, halo)

    wanted = to_arrow_schema(T._parse_datatype_string(schema))

    def run(cells: pa.Table) -> pa.Table:
        row, col = cells["row"].to_numpy(), cells["col"].to_numpy()
        tr, tc = cells["tile_row"][0].as_py(), cells["tile_col"][0].as_py()
        size = tile + 2 * halo
        z = np.full((size, size), np.nan)
        z[row - tr * tile + halo, col - tc * tile + halo] = cells["__z"].to_numpy()
        core = slice(halo, halo + tile)
        own = cells.filter(cells["is_core"])
        r, c = own["row"].to_numpy() - tr * tile, own["col"].to_numpy() - tc * tile
        out = [own[k].combine_chunks().cast(wanted.field(k).type) for k in (*keys, "row", "col")]
        for name, values in finish(z, (core, core)).items():
            if values.ndim == 3:
                at = np.arange(len(r) + 1, dtype=np.int32) * values.shape[0]
                out.append(pa.ListArray.from_arrays(at, np.ascontiguousarray(values[:, r, c].T).ravel()).cast(wanted.field(name).type))
            else:
                out.append(pa.array(values[r, c], wanted.field(name).type))
        return pa.Table.from_arrays(out, schema=wanted)

    return halod.groupBy(*keys, "tile_row", "tile_col").applyInArrow(run, schema)


def _key_schema(df: DataFrame, keys: list[str]) -> str:
    return "".join(f"`{k}` {df.schema[k].dataType.simpleString()}, " for k in keys) + "`row` int, `col` int, "


def horizon(
    df: DataFrame, keys: list[str], height: str, cell: float, radius_m: float, directions: int = DIRECTIONS, tile: int = 256, convention: str = "compass"
) -> DataFrame:
    """NB-07: `horizon`, an array of whole centidegrees per direction; 65535 where the observer has no height.

    Tiles with a halo are worked on one by one, so memory is bounded by the tile and not by the grid; the result
    doesn't depend on the tile size.
    """
    radius = math.ceil(radius_m / cell)
    steps = _steps(directions, radius, convention)

    def finish(z, core):
        angles = np.rint(_tile_angles(z, core, steps, cell) * CENTIDEGREES)
        return {"horizon": np.where(np.isnan(z[core]), NO_HORIZON, angles).astype(np.int32)}

    schema = _key_schema(df, keys) + "horizon array<int>"
    return _per_tile(df, keys, height, tile, radius, schema, finish)


def sky_view(df: DataFrame, keys: list[str], height: str, cell: float, radius: int = 3, directions: int = 16, tile: int = 256) -> DataFrame:
    """NB-08: sky-view factor, 1 minus the mean sine of the horizon angles; NaN where there is no height."""
    steps = _steps(directions, radius, "compass")

    def finish(z, core):
        svf = 1 - np.sin(np.radians(_tile_angles(z, core, steps, cell))).mean(axis=0)
        return {"svf": np.where(np.isnan(z[core]), np.nan, svf)}

    return _per_tile(df, keys, height, tile, radius, _key_schema(df, keys) + "svf double", finish)


def shadow(horizon_bands: Column, azimuth: Column, elevation: Column, directions: int = DIRECTIONS) -> Column:
    """PRJ-21: 1 where the horizon at the sun's azimuth, blended between its two bands, stands above the sun.

    255 where either band has no data or the sun is down.
    """
    at = F.pmod(azimuth.cast("double"), F.lit(360.0)) / (360.0 / directions)
    low = (F.floor(at) % directions).cast("int")
    share = at - F.floor(at)
    a, b = F.get(horizon_bands, low), F.get(horizon_bands, (low + 1) % directions)
    blended = (a * (1 - share) + b * share) / CENTIDEGREES
    dark = F.coalesce(elevation <= 0, F.lit(True)) | a.isNull() | b.isNull() | (a == NO_HORIZON) | (b == NO_HORIZON)
    return F.when(dark, NO_SHADOW).when(blended > elevation, 1).otherwise(0)
