"""Shapes as sets of cells (NB-10, NB-11, JN-14, JN-15, AG-16)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latticeframe.sources.work import few_broadcast, kept


def box_cells(shapes: DataFrame, x0: Column, y0: Column, x1: Column, y1: Column) -> DataFrame:
    """NB-10: `row, col` of every cell whose centre lies in a box (upper edges excluded); coordinates in cells."""
    first = lambda a: F.ceil(a - 0.5).cast("int")
    last = lambda b: F.ceil(b - 0.5).cast("int") - 1
    some = (last(y1) >= first(y0)) & (last(x1) >= first(x0))
    rows = shapes.filter(some).withColumn("row", F.explode(F.sequence(first(y0), last(y1))))
    return rows.withColumn("col", F.explode(F.sequence(first(x0), last(x1))))


def ring_cells(rings: DataFrame, keys: list[str], ring: str = "ring") -> DataFrame:
    """NB-10: `keys, row, col` of every cell whose centre lies in a shape of any outline; coordinates in cells.

    `rings` has one row for each ring: an array of (x, y) in order, closed or not. A shape may have several rings; a
    centre that an odd number of them surrounds is inside, so holes, islands in holes and parts need no marks. A
    centre on an edge to its left (or below) is inside, on one to its right (or above) it isn't, so shapes that share
    an edge share no cell. Points with NULL or NaN coordinates are left out, rings of fewer than three points are empty.

    Scan-line fill: edges become one row for each row of cells that they cross, crossings are sorted along the row, and
    every second gap between them is filled. Nothing is compared with all edges of a shape, and a large shape is as
    many groups as it has rows.
    """
    real = F.filter(ring, lambda p: ~F.isnan(p["x"]) & ~F.isnan(p["y"]) & p["x"].isNotNull() & p["y"].isNotNull())
    points = rings.select(*keys, real.alias("__p")).filter(F.size("__p") >= 3)
    after = lambda k: F.get("__p", (k + 1) % F.size("__p"))
    edges = points.select(*keys, F.explode(F.transform("__p", lambda p, k: F.struct(p.alias("a"), after(k).alias("b")))).alias("e"))
    edges = edges.select(*keys, *(F.col(f"e.{p}.{c}").cast("double").alias(f"__{c}{p}") for p in "ab" for c in "xy"))
    low, high = F.least("__ya", "__yb"), F.greatest("__ya", "__yb")
    # Rows whose centre lies in [low, high): level edges cross none, and a corner counts for one of its two edges.
    first, last = F.ceil(low - 0.5).cast("int"), F.ceil(high - 0.5).cast("int") - 1
    crossed = edges.filter(last >= first).withColumn("row", F.explode(F.sequence(first, last)))
    x = F.col("__xa") + (F.col("row") + 0.5 - F.col("__ya")) / (F.col("__yb") - F.col("__ya")) * (F.col("__xb") - F.col("__xa"))
    lines = crossed.groupBy(*keys, "row").agg(F.array_sort(F.collect_list(x)).alias("__x"))
    gaps = F.transform(F.sequence(F.lit(0), F.size("__x") - 2, F.lit(2)), lambda k: F.struct(F.get("__x", k).alias("from"), F.get("__x", k + 1).alias("to")))
    spans = lines.filter(F.size("__x") >= 2).select(*keys, "row", F.explode(gaps).alias("g"))
    first, last = F.ceil(F.col("g.from") - 0.5).cast("int"), F.ceil(F.col("g.to") - 0.5).cast("int") - 1
    return spans.filter(last >= first).select(*keys, "row", F.explode(F.sequence(first, last)).alias("col"))


def spread_area(cells: DataFrame, key: str, area: str) -> DataFrame:
    """Each shape's area spread evenly over its cells, as `cell_area`.

    The counts are written before they are joined, as Spark can split a skewed join, such as one shape of very many
    cells, only if neither side is still being grouped by its key.
    """
    n = few_broadcast(kept(cells.groupBy(key).agg(F.count(F.lit(1)).alias("n_cells")), "cells"))
    return cells.join(n, key).withColumn("cell_area", F.col(area) / F.col("n_cells"))


def overlap_filter(left: DataFrame, right: DataFrame, key: str, threshold: float = 0.5) -> DataFrame:
    """JN-15: `key, own_cells, overlap_frac, kept` of the left shapes (tables of key, row, col).

    Shared cells are summed over all right shapes, so the fraction can exceed 1 where these overlap each other.
    """
    hits = right.groupBy("row", "col").agg(F.count(F.lit(1)).alias("hits"))
    joined = left.join(hits, ["row", "col"], "left")
    told = joined.groupBy(key).agg(F.count(F.lit(1)).alias("own_cells"), F.coalesce(F.sum("hits"), F.lit(0)).alias("shared"))
    frac = F.col("shared") / F.col("own_cells")
    return told.select(key, "own_cells", frac.alias("overlap_frac"), (frac >= threshold).alias("kept"))


def cell_stats(cells: DataFrame, height: str, keys: list[str] | None = None, cell_size: float = 100.0) -> DataFrame:
    """AG-16: per cell mean, sample deviation (0 for one shape), coverage (area / cell, in [0, 1]) and largest height."""
    return cells.groupBy(*(keys or []), "row", "col").agg(
        F.avg(height).alias("height_mean"),
        F.coalesce(F.stddev_samp(height), F.lit(0.0)).alias("height_std"),
        F.greatest(F.least(F.sum("cell_area") / cell_size, F.lit(1.0)), F.lit(0.0)).alias("coverage"),
        F.max(height).alias("height_max"),
        F.count(F.lit(1)).alias("n_shapes"),
    )


def neighbour_tiles(tiles: DataFrame, row: str = "tile_row", col: str = "tile_col") -> DataFrame:
    """JN-14: every tile with itself and its eight neighbours as `near_row, near_col`."""
    around = F.array(*(F.struct(F.lit(a).alias("dr"), F.lit(b).alias("dc")) for a in (-1, 0, 1) for b in (-1, 0, 1)))
    out = tiles.withColumn("__o", F.explode(around))
    return out.withColumns({"near_row": F.col(row) + F.col("__o.dr"), "near_col": F.col(col) + F.col("__o.dc")}).drop("__o")


def tile_pool(tiles: DataFrame, content: DataFrame) -> DataFrame:
    """The content (tile_row, tile_col, ...) of the 3 x 3 tiles around each tile."""
    near = neighbour_tiles(tiles.select("tile_row", "tile_col").distinct())
    inner = content.withColumnsRenamed({"tile_row": "near_row", "tile_col": "near_col"})
    return near.join(inner, ["near_row", "near_col"])


def _placed(names: DataFrame, column: str, pattern: str) -> DataFrame:
    """Names with `easting, northing` in metres from the kilometres in them; names without these are left out."""
    e = F.regexp_extract(column, pattern, 1).try_cast("double") * 1000
    n = F.regexp_extract(column, pattern, 2).try_cast("double") * 1000
    return names.withColumns({"easting": e, "northing": n}).filter("easting is not null and northing is not null")


def feed_tiles(names: DataFrame, column: str, pattern: str, x0: float, y0: float, x1: float, y1: float, size: float = 2000.0) -> DataFrame:
    """SRC-11: tiles of a feed whose name gives their north-west corner in km, that share area with a box; touching isn't enough."""
    inside = (F.col("easting") < x1) & (F.col("easting") + size > x0) & (F.col("northing") > y0) & (F.col("northing") - size < y1)
    return _placed(names, column, pattern).filter(inside).orderBy("northing", "easting")


def tiles_in_box(names: DataFrame, column: str, pattern: str, x0: float, y0: float, x1: float, y1: float, size: float = 1000.0) -> DataFrame:
    """NB-11: tiles whose name gives their south-west corner in km, that touch a box (edges count); by northing, easting."""
    t = _placed(names, column, pattern)
    touch = (F.col("easting") <= x1) & (F.col("easting") + size >= x0) & (F.col("northing") <= y1) & (F.col("northing") + size >= y0)
    return t.filter(touch).orderBy("northing", "easting")
