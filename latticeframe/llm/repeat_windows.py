"""Anchors, window hashes and radix passes over byte strings, in numpy."""

from __future__ import annotations

import numpy as np

from latticeframe.llm.shingle_sets import _BYTE, Ranges, mix, powers

GRAM = 24  # bytes whose hash chooses an anchor


class Corpus:
    """Several byte strings side by side, with prefix sums from which any range is hashed at once."""

    def __init__(self, raw: list[bytes]):
        self.sizes = np.array([len(r) for r in raw], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)
        self.data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        n = len(self.data)
        # Places of anchors: any function of the bytes would do, so sums modulo 2**64 are good enough.
        self.up, self.down = powers(n + 1)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTE[self.data] * self.up[:n], out=self.sums[1:], dtype=np.uint64)
        self.ranges = Ranges(self.data)

    def hashes(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of the ranges [a, b): equal for equal bytes."""
        return self.ranges.hashes(a, b)


def sliding_argmin(values: np.ndarray, w: int) -> np.ndarray:
    """Position of the leftmost least of values[i:i+w], for every i that has so many (32-bit values)."""
    n = len(values)
    if n < w:
        return np.zeros(0, np.int64)
    keyed = (values.astype(np.uint64) << np.uint64(32)) | np.arange(n, dtype=np.uint64)
    pad = -n % w
    if pad:
        keyed = np.concatenate([keyed, np.full(pad, np.uint64(0xFFFFFFFFFFFFFFFF))])
    grid = keyed.reshape(-1, w)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[: n - w + 1], ahead[w - 1 : n])
    return (least & np.uint64(0xFFFFFFFF)).astype(np.int64)


def classes(c: Corpus, length: int, w: int) -> tuple[np.ndarray, ...]:
    """Windows of `length` bytes by their anchor: (text, anchor, first and last start of the class), chunk positions.

    The anchor of a window is the place of the least hash of `GRAM` bytes among its first `w` places. It depends on
    the window's own bytes only, so equal windows have their anchors at the same place.
    """
    n = len(c.data)
    none = (np.zeros(0, np.int64),) * 4
    if n < length:
        return none
    at = np.arange(n - GRAM + 1, dtype=np.int64)
    gram = mix((c.sums[GRAM:] - c.sums[: n - GRAM + 1]) * c.down[: n - GRAM + 1]) >> np.uint64(32)
    anchor = sliding_argmin(gram, w)
    # Windows that lie within one text
    last = c.starts[1:] - length
    good = np.zeros(n + 1, np.int32)
    ok = last >= c.starts[:-1]
    np.add.at(good, c.starts[:-1][ok], 1)
    np.add.at(good, last[ok] + 1, -1)
    p = np.flatnonzero(np.cumsum(good)[: n - length + 1])
    if not len(p):
        return none
    text = np.searchsorted(c.starts, p, side="right") - 1
    # Empty texts share a start with the next one; `right` picks the last of them, which is the one with bytes.
    a = anchor[p]
    first = np.concatenate([[True], (a[1:] != a[:-1]) | (text[1:] != text[:-1])])
    begin = np.flatnonzero(first)
    end = np.concatenate([begin[1:], [len(p)]]) - 1
    return text[begin], a[begin], p[begin], p[end]


def anchor_places(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """All windows of byte strings of these sizes: (which string, offset in it)."""
    counts = np.maximum(sizes - length + 1, 0)
    row = np.repeat(np.arange(len(sizes)), counts)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)


def equal_to_depth(core: np.ndarray, anchor: np.ndarray, raw: list[bytes], length: int, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows (which string, offset) that are equal to another one to depth `length`, in order.

    String k holds windows whose anchor is at `anchor[k]`, and from there `length - w + 1` bytes that `core[k]` stands
    for. Most-significant-digit passes: core and distance to the anchor first, then 8 bytes a pass of what is left of a
    window around its core; a window that is alone in its group is dropped after each pass.
    """
    sizes = np.array([len(r) for r in raw], np.int64)
    starts = np.cumsum(sizes) - sizes
    # Some slack behind the last window, as a digit may reach over its end
    data = np.frombuffer(b"".join([*raw, bytes(16)]), np.uint8)
    row, off = anchor_places(sizes, length)
    ahead = (anchor[row] - off).astype(np.int64)  # bytes of a window before its core
    place = starts[row] + off
    group, digit = core[row], ahead
    skip, rest = length - w + 1, w - 1
    for k in range(0, rest + 8, 8):
        order = np.lexsort((digit, group))
        g, d = group[order], digit[order]
        new = np.empty(len(order) + 1, bool)
        new[0] = new[-1] = True
        new[1:-1] = (g[1:] != g[:-1]) | (d[1:] != d[:-1])
        among = ~(new[:-1] & new[1:])
        order = order[among]
        row, off, ahead, place = row[order], off[order], ahead[order], place[order]
        group = np.cumsum(new[:-1])[among]
        if k >= rest or not len(row):
            break
        digit = np.zeros(len(place), np.uint64)
        for at in range(k, k + 8):
            digit <<= np.uint64(8)
            if at < rest:
                digit |= data[place + np.where(at < ahead, at, at + skip)]
    order = np.lexsort((off, row))
    return row[order], off[order]
