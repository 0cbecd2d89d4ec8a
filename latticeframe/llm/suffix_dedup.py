"""Repeated byte passages by a depth-limited radix sort of suffixes (operator 10).

Method: only the first `length` bytes of a suffix matter, so suffixes are ordered by most significant digits to that
depth, and whatever is alone in its group is dropped as soon as it appears; equal groups at the full depth are the
repeated windows.

* Suffixes travel in classes: neighbouring suffixes whose windows have the same anchor (the place of the least hash
  among their first places). An anchor is a property of a window's own bytes, so equal windows are in classes that meet.
* First digit: the bytes from the anchor that all windows of a class contain. Classes alone in their group hold no
  repeated window.
* Second digit: all bytes that any window of a class contains. Classes equal in it have all windows repeated at once.
* What is left are classes at the borders of repeated passages. Their suffixes are ordered, many groups of the first
  digit together, by the distance to the anchor and then by 8-byte digits, pass after pass, until depth `length`.

Equal classes are counted once before anything is gathered. The suffixes of a first digit with very many different
classes become rows that are counted and dealt by a digit over the whole window, each to one task, so no group has to
fit into one task; a window that is itself very common is known from its count and isn't gathered at all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latticeframe.llm.common import CHUNK_BYTES, discard, map_rows, row_slices, stored
from latticeframe.llm.repeat_windows import GRAM, Corpus, anchor_places, classes, equal_to_depth
from latticeframe.llm.shingle_sets import mix

LENGTH = 400
#: Different classes of one first digit, and equal windows, that a task takes at once
GROUP_CLASSES = 2048
#: Very common windows that may be sent to every task
BROADCAST_WINDOWS = 1_000_000
#: Tasks over which the classes of one kind are dealt
SALTS = 16
#: Bytes of one piece of a very long text
PIECE_BYTES = 2 << 20
_BITS = 10  # of a class's width, and of its first window's distance to the anchor, below the first start in `ref`
_LOW = (1 << _BITS) - 1

#: What names a text: its id and a 64-bit hash of its content. Rows with both equal have equal texts.
KEY = ["doc_id", "mark"]
_KEY = "doc_id long, mark long"


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text"))


def _width(length: int) -> int:
    """Places among which a window's anchor is sought."""
    return min(length // 2, _LOW)


def _unpacked(ref: Column) -> dict[str, Column]:
    """First start and last start of the class behind `ref`."""
    first = F.shiftright(ref, 2 * _BITS)
    return {"first": first, "last": first + F.shiftright(ref, _BITS).bitwiseAND(_LOW)}


def _raw(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _pieces(raw: list[bytes], length: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Texts side by side, a few MB at a time: (number of the text, offset in it, bytes).

    Long texts are cut into pieces that overlap by one byte less than a window, so each window is in one piece.
    """
    owner, offset, parts, held = [], [], [], 0
    for k, text in enumerate(raw):
        for at in range(0, max(len(text) - length + 1, 0), PIECE_BYTES):
            part = text[at : at + PIECE_BYTES + length - 1]
            if held and held + len(part) > CHUNK_BYTES:
                yield owner, offset, parts
                owner, offset, parts, held = [], [], [], 0
            owner.append(k)
            offset.append(at)
            parts.append(part)
            held += len(part)
    if parts:
        yield owner, offset, parts


def _classes(docs: DataFrame, length: int) -> DataFrame:
    """`doc_id, mark, ref, core, whole`: the classes of all windows; `ref` packs first start, width and anchor."""
    w = _width(length)

    def run(batches):
        for batch in batches:
            for part in row_slices(batch):
                for owner, offset, raw in _pieces([_raw(t) for t in part.column(2).to_pylist()], length):
                    c = Corpus(raw)
                    piece, anchor, first, last = classes(c, length, w)
                    core = c.hashes(anchor, anchor + length - w + 1)
                    place = mix(((anchor - first) << 32 | (last - first)).astype(np.uint64))
                    whole = mix(c.hashes(first, last + length) ^ place)
                    start = first - c.starts[piece] + np.array(offset, np.int64)[piece]
                    ref = start << 2 * _BITS | (last - first) << _BITS | (anchor - first)
                    of = pa.array(np.array(owner, np.int64)[piece])
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column(0).take(of),
                            part.column(1).take(of),
                            pa.array(ref),
                            pa.array(core.view(np.int64)),
                            pa.array(whole.view(np.int64)),
                        ],
                        names=[*KEY, "ref", "core", "whole"],
                    )

    return docs.mapInArrow(run, f"{_KEY}, ref long, core long, whole long")


def _joined(docs: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """`docs` with the list that belongs to each text."""
    other = lists.withColumnsRenamed({"doc_id": "__id", "mark": "__mark"})
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("mark") == F.col("__mark"))
    return docs.join(other, same, how).drop("__id", "__mark")


def _contexts(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of wanted classes: `core, open, doc_id, mark, ref, bytes`."""
    lists = wanted.groupBy(*KEY).agg(F.collect_list(F.struct("core", "open", "ref")).alias("wanted"))
    rows = _joined(docs, lists, "inner").select(*KEY, "text", "wanted")

    def make():
        def rows_of(ids, marks, texts, lists):
            out = []
            for i, mark, t, wants in zip(ids, marks, texts, lists, strict=True):
                raw = _raw(t)
                for x in wants:
                    ref = x["ref"]
                    first = ref >> 2 * _BITS
                    last = first + (ref >> _BITS & _LOW)
                    out.append((x["core"], x["open"], i, mark, ref, raw[first : last + length]))
            return out

        return rows_of

    return map_rows(rows, f"core long, open boolean, {_KEY}, ref long, bytes binary", make, chunk=64)


def _runs(row: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of neighbouring offsets in the same row begin and end."""
    new = np.flatnonzero((row[1:] != row[:-1]) | (off[1:] != off[:-1] + 1)) + 1
    if not len(row):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([[0], new]), np.concatenate([new, [len(row)]]) - 1


def _border_windows(contexts: DataFrame, length: int) -> DataFrame:
    """Starts of repeated windows in open classes, as `doc_id, mark, first, last`."""
    w = _width(length)

    def solve(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches)
        core, ref = (table.column(n).to_numpy() for n in ("core", "ref"))
        row, off = equal_to_depth(core, ref & _LOW, table.column("bytes").to_pylist(), length, w)
        is_open = table.column("open").to_numpy()[row]
        row, off = row[is_open], off[is_open]
        begin, end = _runs(row, off)
        of = pa.array(row[begin])
        start = ref[row[begin]] >> 2 * _BITS
        keys = [table.column(n).take(of).combine_chunks() for n in KEY]
        return pa.RecordBatch.from_arrays(
            [*keys, pa.array(start + off[begin]), pa.array(start + off[end])], names=[*KEY, "first", "last"]
        )

    def run(batches):
        # Whole groups of the first digit are solved together, some thousand rows at a time; the last may go on.
        held, rows = [], 0
        for batch in batches:
            core = batch.column(0).to_numpy()
            at = 0
            while at < len(core):
                if held and core[at] != held[-1].column(0)[-1].as_py() and rows >= GROUP_CLASSES:
                    yield solve(held)
                    held, rows = [], 0
                # To the end of the group that the last row taken is in
                end = int(np.searchsorted(core, core[min(at + GROUP_CLASSES, len(core)) - 1], side="right"))
                held.append(batch.slice(at, end - at))
                rows += end - at
                at = end
        if held:
            yield solve(held)

    dealt = contexts.repartition("core").sortWithinPartitions("core")
    return dealt.mapInArrow(run, f"{_KEY}, first long, last long")


def _spread_windows(contexts: DataFrame, length: int) -> DataFrame:
    """As `_border_windows`, for first digits with more classes than a task takes: a row for each window."""

    def run(batches):
        for batch in batches:
            for part in row_slices(batch, 1024):
                raw = part.column("bytes").to_pylist()
                c = Corpus(raw)
                row, off = anchor_places(c.sizes, length)
                p = c.starts[row] + off
                of = pa.array(row)
                columns = [part.column(n).take(of) for n in ("core", "open", *KEY, "ref")]
                columns += [pa.array(off.astype(np.int32)), pa.array(c.hashes(p, p + length).view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["core", "open", *KEY, "ref", "off", "hash"])

    key = ["core", "hash"]
    rows = stored(contexts.mapInArrow(run, f"core long, open boolean, {_KEY}, ref long, off int, hash long"), "windows")
    counts = stored(rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "counts")
    common = counts.filter(F.col("n") > GROUP_CLASSES).select(*key, F.lit(True).alias("common"))
    if common.count() <= BROADCAST_WINDOWS:
        common = F.broadcast(common)
    # Common windows are hits by their count alone; of the others a task gets a bounded number.
    known = rows.filter("open").join(common, key, "left")
    rare = counts.filter(F.col("n") <= GROUP_CLASSES).select(*key)
    hits = known.filter("common").drop("common").unionByName(known.filter("common is null").drop("common").join(rare, key))

    def make():
        def rows_of(ids, marks, refs, lists):
            out = []
            for i, mark, ref, offs in zip(ids, marks, refs, lists, strict=True):
                offs = np.sort(np.array(offs, dtype=np.int64))
                for a, b in zip(*_runs(np.zeros(len(offs), np.int64), offs), strict=True):
                    out.append((i, mark, (ref >> 2 * _BITS) + int(offs[a]), (ref >> 2 * _BITS) + int(offs[b])))
            return out

        return rows_of

    lists = hits.groupBy("core", *KEY, "ref").agg(F.collect_set("off").alias("offs")).select(*KEY, "ref", "offs")
    return map_rows(lists, f"{_KEY}, first long, last long", make)


def repeated_windows(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """`doc_id, mark, first, last`: all starts (byte offsets) of windows of `length` bytes that occur more than once.

    `mark` tells texts with the same id apart. A null text is empty; a text shorter than `length` has no window; an
    empty table gives an empty one. Extra columns are ignored.
    """
    return _repeated(_keyed(docs), length)


def _repeated(docs: DataFrame, length: int) -> DataFrame:
    if length < 2 * GRAM:
        raise ValueError(f"length must be {2 * GRAM} at least")
    table = stored(_classes(docs, length), "classes")
    # Written first: a join whose side is still an aggregate on the same key couldn't be split where a digit is common.
    shared = stored(table.groupBy("core").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("core"), "shared")
    alive = stored(table.join(shared, "core"), "alive")
    discard(table, shared)
    kinds = stored(
        alive.groupBy("core", "whole").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*KEY, "ref")).alias("one")),
        "kinds",
    )
    # A passage in a third of all texts is one kind with very many classes; salts deal it over several tasks.
    salted = alive.withColumn("salt", F.pmod(F.xxhash64("mark", "ref"), SALTS))
    many = kinds.filter("n > 1").select("core", "whole", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    full = salted.join(many, ["core", "whole", "salt"]).select(*KEY, "ref")
    # Groups with several kinds, one of which at least occurs once only
    mixed = (
        kinds.groupBy("core")
        .agg(F.count(F.lit(1)).alias("m"), F.min("n").alias("rarest"))
        .filter("m > 1 and rarest = 1")
        .select("core", (F.col("m") > GROUP_CLASSES).alias("large"))
    )
    wanted = stored(
        kinds.join(mixed, "core").select("core", "large", (F.col("n") == 1).alias("open"), "one.doc_id", "one.mark", "one.ref"),
        "wanted",
    )
    border = _border_windows(_contexts(docs, wanted.filter("not large"), length), length)
    if wanted.filter("large").limit(1).count():
        border = border.unionByName(_spread_windows(_contexts(docs, wanted.filter("large"), length), length))
    found = stored(full.select(*KEY, *(c.alias(n) for n, c in _unpacked(F.col("ref")).items())).unionByName(border), "intervals")
    discard(alive, kinds, wanted)
    return found


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per row of `docs`: `doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept` (the bytes that stay).

    Removed is every byte that a window of `length` bytes covers which also starts anywhere else, be it in the same
    text, overlapping, or in a row that repeats this one. Null text is empty; texts shorter than `length` stay whole;
    null and repeated ids keep rows of their own; an empty table gives an empty one. Texts of any length are worked
    through in pieces. Extra columns are ignored, whatever they are called.
    """
    docs = _keyed(docs)
    found = _repeated(docs, length)
    lists = found.groupBy(*KEY).agg(F.collect_list(F.struct("first", "last")).alias("found"))
    rows = _joined(docs, lists, "left").select("doc_id", "text", "found")

    def make():
        def rows_of(ids, texts, lists):
            out = []
            for i, t, found in zip(ids, texts, lists, strict=True):
                raw = _raw(t)
                spans = []
                for a, b in sorted((x["first"], x["last"] + length) for x in found or ()):
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], b)
                    else:
                        spans.append([a, b])
                kept, at = [], 0
                for a, b in spans:
                    kept.append(raw[at:a])
                    at = b
                rest = b"".join([*kept, raw[at:]])
                out.append((i, len(raw), len(raw) - len(rest), len(spans), hashlib.sha256(rest).hexdigest(), rest))
            return out

        return rows_of

    return map_rows(rows, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary", make, chunk=128)


def kept_texts(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """`remove_repeats` with the bytes that stay as `text`; a character cut in two leaves a replacement mark."""
    out = remove_repeats(docs, length)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", F.make_valid_utf8(F.col("kept").cast("string")).alias("text"))
