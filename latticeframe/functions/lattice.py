"""The nested lattice: grid addresses, parents, tiles, blocks, space-filling order (PRJ-14, PRJ-15, SRC-06, SNK-06, AG-09)."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class GridSpec:
    """A regular north-up grid: origin is the outer corner of cell (0, 0)."""

    origin_x: float = 369190.0
    origin_y: float = 5838410.0
    resolution: float = 10.0
    rows: int | None = None
    cols: int | None = None

    def coarser(self, factor: int) -> GridSpec:
        """Nested parent grid; ragged edges get cells of their own."""
        up = lambda n: None if n is None else -(-n // factor)
        return GridSpec(self.origin_x, self.origin_y, self.resolution * factor, up(self.rows), up(self.cols))

    def row(self, y: Column) -> Column:
        return F.floor((F.lit(self.origin_y) - y) / self.resolution).cast("int")

    def col(self, x: Column) -> Column:
        return F.floor((x - F.lit(self.origin_x)) / self.resolution).cast("int")

    def centre_x(self, col: Column) -> Column:
        return F.lit(self.origin_x) + (col + 0.5) * self.resolution

    def centre_y(self, row: Column) -> Column:
        return F.lit(self.origin_y) - (row + 0.5) * self.resolution

    def inside(self, row: Column, col: Column) -> Column:
        return (row >= 0) & (row < self.rows) & (col >= 0) & (col < self.cols)

    def snapped_window(self, min_x: float, min_y: float, max_x: float, max_y: float, factor: int = 10) -> tuple[int, int, int, int]:
        """PRJ-14: first row, first col, rows and cols of a box, snapped outward to the lattice `factor` times coarser."""
        step = self.resolution * factor
        r0, c0 = math.floor((self.origin_y - max_y) / step), math.floor((min_x - self.origin_x) / step)
        r1, c1 = math.ceil((self.origin_y - min_y) / step), math.ceil((max_x - self.origin_x) / step)
        return r0 * factor, c0 * factor, (r1 - r0) * factor, (c1 - c0) * factor


def parent(index: Column, factor: int) -> Column:
    """floor(index / factor), also for negative indices."""
    return F.floor(index / F.lit(float(factor))).cast("int")


def present(block: Column, factor: int, size: int) -> Column:
    """AG-09: children that a block has along one axis of a grid with `size` cells."""
    return F.least(F.lit(factor), F.lit(size) - block * factor)


def tiles(size: int, step: int) -> list[tuple[int, int]]:
    """SRC-06: (start, length) of the tiles along one axis, the last one truncated."""
    return [(a, min(step, size - a)) for a in range(0, size, step)]


#: Distances and masks by which the bits of a 32-bit number are moved apart
_SPREAD = ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555))


def morton(row: Column, col: Column) -> Column:
    """SNK-06: the bits of row and column interleaved, so that cells near each other are near in this order.

    Defined for addresses from 0 to 2^31 - 1; any other address, or NULL, gives NULL.
    """

    def spread(x: Column) -> Column:
        x = F.when(x.between(0, 2**31 - 1), x.cast("long"))
        for far, mask in _SPREAD:
            x = x.bitwiseOR(F.shiftleft(x, far)).bitwiseAND(F.lit(mask))
        return x

    return F.shiftleft(spread(row), 1).bitwiseOR(spread(col))
