"""Best-fit packing of token pieces under several capacities (operator 1).

Method: vector best-fit, largest items first. A bin has residual tokens, document places and attention cost (squared
piece lengths). An item goes to the bin, among those with room in every capacity, that is left with the least
weighted residual norm (`rule="norm"`), or whose residual has the largest weighted dot product with the item
(`rule="dot"`); if no bin has room it opens a new one.

Pieces are dealt into groups of bounded size by their row numbers, so each group has the length mix of the whole and packs on its
own. Bins that stay notably unfilled are opened again and packed in a second round over all groups.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latticeframe.llm.common import map_rows, only, stored
from latticeframe.llm.word_tokens import word_tokens

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@dataclass(frozen=True)
class Capacity:
    """Limits of one sequence; None is no limit, and then the weight counts for nothing."""

    tokens: int = 2048
    documents: int | None = None
    attention: int | None = None
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05)
    rule: str = "norm"




def all_capacities(tokens: int) -> Capacity:
    """Token, place and attention capacities of a sequence of `tokens` tokens.

    A piece has a token at least, and squares of lengths add up to no more than the square of their sum, so the second
    and third never cost a sequence; they weigh on which of the bins with room for a piece is the best one.
    """
    return Capacity(tokens=tokens, documents=tokens, attention=tokens**2)


#: Pieces of a group that one task packs
GROUP = 8192
#: Bins filled less than this are packed again
WELL_FILLED = 0.99


def tokenised_pieces(docs: DataFrame, path: str, tokens: int, separator: int = 0) -> DataFrame:
    """Whole texts as ids, one separator each, cut only where a document is longer than a sequence.

    Null text is empty: a piece of the separator alone. Null ids and repeated rows are documents of their own.
    """

    def make():
        w, tail, size = word_tokens(path), separator.to_bytes(4, "little"), 4 * tokens

        def rows(ids, texts):
            out = []
            for i, t in zip(ids, texts, strict=True):
                coded = w.ids(t or "") + tail
                for k, at in enumerate(range(0, len(coded), size)):
                    part = coded[at : at + size]
                    out.append((i, k, at // 4, len(part) // 4, zlib.crc32(part)))
            return out

        return rows

    return map_rows(only(docs, doc_id="long", text="string"), PIECES, make)


def pack(lengths: np.ndarray, cap: Capacity) -> np.ndarray:
    """A bin number for each item."""
    limit = np.array(
        [cap.tokens, cap.documents or len(lengths) + 1, cap.attention or float(cap.tokens) ** 2 * (len(lengths) + 1)],
        dtype=float,
    )
    items = np.stack([lengths, np.ones(len(lengths)), lengths.astype(float) ** 2], axis=1)
    weights = np.array(cap.weights) * [1, cap.documents is not None, cap.attention is not None]
    order = np.argsort(-(weights * items / limit).sum(axis=1), kind="stable")
    least = lengths.min() if len(lengths) else 0
    left = np.zeros((64, 3))
    names = np.zeros(64, np.int64)
    bins = n = 0
    out = np.zeros(len(lengths), np.int64)
    for x in order:
        item = items[x]
        room = np.flatnonzero((left[:n] >= item).all(axis=1))
        if len(room):
            share = (left[room] - item) / limit
            if cap.rule == "norm":
                best = room[np.argmin((weights * share * share).sum(axis=1))]
            else:
                best = room[np.argmax((weights * (left[room] / limit) * (item / limit)).sum(axis=1))]
        else:
            if n == len(left):  # close bins that nothing fits any more, then make room
                alive = np.flatnonzero(left[:n, 0] >= least)
                left[: len(alive)], names[: len(alive)], n = left[alive], names[alive], len(alive)
                if 2 * n > len(left):
                    left, names = np.concatenate([left, np.zeros_like(left)]), np.concatenate([names, np.zeros_like(names)])
            best = n
            left[n], names[n] = limit, bins
            n, bins = n + 1, bins + 1
        if (item > limit).any():
            raise ValueError("an item is larger than a bin")
        left[best] -= item
        out[x] = names[best]
    return out


def _packed(pieces: DataFrame, n: int, cap: Capacity, round_no: int) -> DataFrame:
    """Pieces with `grp, bin, offset, fill`, dealt by the row numbers that were written with them."""
    groups = max(1, -(-n // GROUP))
    dealt = pieces.withColumn("grp", F.pmod(F.xxhash64("row", F.lit(round_no)), groups))

    def pack_group(table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_numpy()
        bins = pack(lengths, cap)
        order = np.lexsort((table.column("row").to_numpy(), bins))
        bins, lengths = bins[order], lengths[order]
        before = np.cumsum(lengths) - lengths
        first = np.searchsorted(bins, bins)
        fill = np.bincount(bins, weights=lengths).astype(np.int64)[bins]
        out = table.take(pa.array(order))
        for name, value in (("bin", bins), ("offset", before - before[first]), ("fill", fill)):
            out = out.append_column(name, pa.array(value))
        return out

    return dealt.groupBy("grp").applyInArrow(pack_group, f"{PIECES}, row long, grp long, bin long, offset long, fill long")


def pack_pieces(pieces: DataFrame, cap: Capacity) -> DataFrame:
    """`pieces` plus `sequence_id` and `offset`.

    Pieces are packed by their row in the written table, so null ids, repeated ids and repeated rows are spread like
    any others. An empty table stays empty.
    """
    names = pieces.columns
    pieces = stored(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    whole = pieces.filter(F.col("length") >= cap.tokens)
    rest = pieces.filter(F.col("length") < cap.tokens)
    first = stored(_packed(rest, rest.count(), cap, 1), "first")
    good = first.filter(F.col("fill") >= WELL_FILLED * cap.tokens)
    again = first.filter(F.col("fill") < WELL_FILLED * cap.tokens)
    second = _packed(again.select(*names, "row"), again.count(), cap, 2)

    def numbered(df: DataFrame, kind: int) -> DataFrame:
        # group, bin and kind side by side: a group has fewer bins than rows, and rows of a task fit into 32 bits
        number = F.shiftleft("grp", 34) + F.shiftleft("bin", 2) + kind
        return df.select(*names, number.alias("sequence_id"), "offset")

    alone = whole.select(*names, (F.shiftleft("row", 2) + 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return alone.unionByName(numbered(good, 0)).unionByName(numbered(second, 1))


def pack_documents(docs: DataFrame, path: str, cap: Capacity = Capacity()) -> DataFrame:
    """Where every piece of every document goes: `doc_id, piece, start, length, ids_crc32, sequence_id, offset`.

    Null text is empty and makes one piece of the separator; a very long text makes many pieces; null ids, repeated
    ids and repeated rows are documents of their own; extra columns are ignored; an empty table gives an empty one.
    """
    return pack_pieces(tokenised_pieces(docs, path, cap.tokens), cap)
