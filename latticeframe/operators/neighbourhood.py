"""Pixels that look at other pixels (NB-01 .. NB-06, NB-09)."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latticeframe.functions.nulls import value

CELL = ["row", "col"]


def offsets(rows: range, cols: range) -> Column:
    return F.array(*(F.struct(F.lit(r).alias("dr"), F.lit(c).alias("dc")) for r in rows for c in cols))


#: Cells of a row that travel as the bits of one number
WORD = 32


def _windows(a: np.ndarray, radius: int, axis: int) -> np.ndarray:
    """OR over 2 * radius + 1 neighbours along an axis, by doubling; the result is shorter by 2 * radius."""
    a, n, size = np.moveaxis(a, axis, 0), 2 * radius + 1, 1
    while 2 * size <= n:
        a, size = a[:-size] | a[size:], 2 * size
    if n > size:
        a = a[: size - n] | a[n - size :]
    return np.moveaxis(a, 0, axis)


def dilate(df: DataFrame, keys: list[str], core: Column, radius: int, tile: int = 1024) -> DataFrame:
    """NB-01: `df` plus `buffer`: cells within a square of `radius` around a core cell that aren't core themselves.

    Core cells are packed to numbers of 32 cells; only these travel, to their tile and to those whose halo they stand
    in. A tile ORs rows and then columns with themselves in doubling shifts, so the work doesn't depend on the radius
    but for the halo, and the result goes back as bits, joined once for 32 cells.
    """
    tile = -(-tile // WORD) * WORD
    halo = -(-radius // WORD) * WORD  # whole words to either side
    bit = F.expr(f"shiftleft(1L, cast(pmod(col, {WORD}) as int))")
    word = F.floor(F.col("col") / WORD)
    packed = df.filter(F.coalesce(core, F.lit(False))).groupBy(*keys, F.col("row").cast("long").alias("row"), word.alias("__word")).agg(F.bit_or(bit).alias("__bits"))
    touched = lambda lo, hi: F.explode(F.sequence(F.floor((lo - radius) / tile), F.floor((hi + radius) / tile)))
    left = F.col("__word") * WORD
    dealt = packed.withColumn("__tr", touched(F.col("row"), F.col("row"))).withColumn("__tc", touched(left, left + (WORD - 1)))
    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    schema = f"{kinds + ', ' if kinds else ''}row long, __word long, __bits long"

    def spread(table: pa.Table) -> pa.Table:
        top, first = table["__tr"][0].as_py() * tile, table["__tc"][0].as_py() * tile
        rows = table["row"].to_numpy() - (top - radius)
        cols = table["__word"].to_numpy() * WORD - (first - halo)
        bits = np.unpackbits(table["__bits"].to_numpy().astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little").astype(bool)
        cells = np.zeros((tile + 2 * radius, tile + 2 * halo), bool)
        cells[rows[:, None], cols[:, None] + np.arange(WORD)] = bits
        near = _windows(_windows(cells, radius, 0), radius, 1)[:, halo - radius : halo - radius + tile]
        words = np.packbits(near.reshape(tile, -1, WORD), axis=2, bitorder="little").view("<u4")[:, :, 0]
        r, w = np.nonzero(words)
        same = table.select(keys).slice(0, 1).take(pa.array(np.zeros(len(r), np.int64))) if keys else None
        made = {"row": r + top, "__word": w + first // WORD, "__bits": words[r, w].astype(np.int64)}
        columns = [same[k].combine_chunks() for k in keys] + [pa.array(c) for c in made.values()]
        return pa.Table.from_arrays(columns, names=[*keys, *made])

    square = dealt.groupBy(*keys, "__tr", "__tc").applyInArrow(spread, schema).withColumnRenamed("row", "__row")
    same = (F.col("row") == F.col("__row")) & (word == F.col("__word"))
    for k in keys:
        same = same & F.col(f"__of_{k}").eqNullSafe(F.col(k))
    near = df.join(square.withColumnsRenamed({k: f"__of_{k}" for k in keys}), same, "left")
    hit = F.coalesce(F.expr(f"shiftright(__bits, cast(pmod(col, {WORD}) as int)) & 1 = 1"), F.lit(False))
    return near.withColumn("buffer", hit & ~F.coalesce(core, F.lit(False))).select(*df.columns, "buffer")


def shadow_shift(azimuth: float, elevation: float, height: float, resolution: float) -> tuple[int, int] | None:
    """NB-02: whole (rows, cols) by which a cloud's shadow lies away from it; None for a sun too low or a tiny offset.

    Rows grow to the south. The nearest cell counts, halves rounded up.
    """
    if elevation <= 0.5:
        return None
    far = height * math.tan(math.radians(90 - elevation))
    if far < 1:
        return None
    east, north = -far * math.sin(math.radians(azimuth)), -far * math.cos(math.radians(azimuth))
    return math.floor(-north / resolution + 0.5), math.floor(east / resolution + 0.5)


def shifted(df: DataFrame, keys: list[str], mask: Column, dr: Column, dc: Column, rows: int, cols: int) -> DataFrame:
    """Cells that the mask covers once it is moved by (dr, dc); what leaves the grid is gone, NULL shifts move nothing."""
    r, c = (F.col("row") + dr).cast("int").alias("row"), (F.col("col") + dc).cast("int").alias("col")
    moved = df.filter(F.coalesce(mask, F.lit(False))).select(*keys, r, c).distinct()
    return moved.filter(F.col("row").between(0, rows - 1) & F.col("col").between(0, cols - 1))


def _squares(source: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """The values of every two by two square of cells, by the lower corner `srow, scol`: `__{column}_{corner}`.

    A grouped maximum of four copies of a cell, combined on the map side; a square may reach over the edge.
    """
    corners = F.array(*(F.struct((F.col("row") - i).alias("srow"), (F.col("col") - j).alias("scol"), F.lit(2 * i + j).alias("k")) for i in (0, 1) for j in (0, 1)))
    cells = source.select(*keys, F.explode(corners).alias("__at"), *(value(n).alias(f"__{m}") for m, n in enumerate(columns)))
    at = [*keys, F.col("__at.srow").alias("srow"), F.col("__at.scol").alias("scol")]
    return cells.groupBy(*at).agg(*(F.max(F.when(F.col("__at.k") == k, F.col(f"__{m}"))).alias(f"__{m}_{k}") for m in range(len(columns)) for k in range(4)))


def bilinear(targets: DataFrame, source: DataFrame, keys: list[str], columns: list[str], src_row: Column, src_col: Column) -> DataFrame:
    """Weighted mean of the up to four source cells around a fractional index; cells without a value are left out.

    `src_row`, `src_col` are expressions over the targets, in source indices of cell centres. The source, the smaller
    table as a rule, is put into squares, so that a target is one row that meets one square.
    """
    t = targets.select(*keys, *CELL, src_row.cast("double").alias("__r"), src_col.cast("double").alias("__c"))
    t = t.withColumns({"srow": F.floor("__r").cast("int"), "scol": F.floor("__c").cast("int")})
    joined = t.join(_squares(source, keys, columns), [*keys, "srow", "scol"], "left")
    down, right = F.col("__r") - F.col("srow"), F.col("__c") - F.col("scol")
    weights = [(down if i else 1 - down) * (right if j else 1 - right) for i in (0, 1) for j in (0, 1)]

    def mean(m: int) -> Column:
        total, weight = F.lit(0.0), F.lit(0.0)
        for k, w in enumerate(weights):
            v = F.col(f"__{m}_{k}")
            used = v.isNotNull() & (w > 0)
            total, weight = total + F.when(used, v * w).otherwise(0.0), weight + F.when(used, w).otherwise(0.0)
        return F.try_divide(total, weight).alias(columns[m])

    return joined.select(*keys, *CELL, *(mean(m) for m in range(len(columns))))


def upsample2(targets: DataFrame, coarse: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """NB-03: twice finer; cell centres of the two lattices are a quarter of a coarse cell apart."""
    return bilinear(targets, coarse, keys, columns, (F.col("row") + 0.5) / 2 - 0.5, (F.col("col") + 0.5) / 2 - 0.5)


def from_coarse(targets: DataFrame, coarse: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """NB-05: fields of a coarse regular grid at cells that carry their fractional source index (`src_row`, `src_col`)."""
    return bilinear(targets, coarse, keys, columns, F.col("src_row"), F.col("src_col"))


def nearest(targets: DataFrame, source: DataFrame, keys: list[str], columns: list[str], src_row: Column, src_col: Column) -> DataFrame:
    """NB-04: the source cell that holds the target's centre; src_* are in source indices of outer edges.

    A task holds its share of the source, the smaller table with one row for each cell, and targets pass by unsorted.
    """
    t = targets.withColumns({"srow": F.floor(src_row).cast("int"), "scol": F.floor(src_col).cast("int")})
    s = source.select(*keys, F.col("row").alias("srow"), F.col("col").alias("scol"), *columns)
    return t.join(s.hint("shuffle_hash"), [*keys, "srow", "scol"], "left").drop("srow", "scol")


def scene_layers(targets: DataFrame, source: DataFrame, keys: list[str], values: list[str], classes: list[str], factor: float) -> DataFrame:
    """NB-06: bilinear for value layers and nearest for class layers of one scene, `factor` target cells to a source cell."""
    centre = lambda c: (F.col(c) + 0.5) / factor
    smooth = bilinear(targets, source, keys, values, centre("row") - 0.5, centre("col") - 0.5)
    return nearest(smooth, source, keys, classes, centre("row"), centre("col"))


def with_halo(df: DataFrame, tile: int, halo: int) -> DataFrame:
    """NB-09: every cell in every tile whose padded box contains it, with `tile_row`, `tile_col` and `is_core`.

    A cell is copied to few tiles only, whatever the size of the grid.
    """
    reach = lambda c, d: F.floor((F.col(c) + d) / F.lit(float(tile))).cast("int")
    out = df.withColumn("tile_row", F.explode(F.sequence(reach("row", -halo), reach("row", halo))))
    out = out.withColumn("tile_col", F.explode(F.sequence(reach("col", -halo), reach("col", halo))))
    core = (F.col("tile_row") == reach("row", 0)) & (F.col("tile_col") == reach("col", 0))
    return out.withColumn("is_core", core)
