"""Repeated line runs from a suffix array over line-ID sequences (operator 9).

Method: every line is an id (a hash of its content), and each document a sequence of ids. The suffixes of all sequences
are put in order by distributed prefix doubling: the rank of a suffix by its first 2h lines follows from its own rank
by h lines and that of the suffix h lines on. Ranks come from a range-partitioned sort of the different keys only, and
a suffix whose rank is its own is dropped at once, as nothing shares its prefix: a round only carries what repeats.
Lengths that are no power of two come from two overlapping halves.

Neighbours in the array by `min_lines` lines have a longest common prefix of `min_lines` or more exactly if their ranks
are equal, so equal ranks are the longest-common-prefix intervals of that depth. Each interval knows its first suffix
in reading order; every other suffix in it starts a later copy. Where these overlap or touch they make up the maximal
repeated runs, and the lines of the later copies are deleted. Which lines go is the same at any greater depth, as a
longer repeat is made of repeats of `min_lines` lines; so doubling stops there.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latticeframe.llm.common import ASCII_SPACE, discard, map_rows, row_slices, stored
from latticeframe.llm.shingle_sets import mix, word_hashes

#: A run of so many lines counts as repeated text ...
MIN_LINES = 3
#: ... and so does a single line of so many words.
MIN_WORDS = 12


def line_ids(docs: DataFrame) -> DataFrame:
    """`doc_id, mark, at, line, words` of `doc_id, mark, text`: every line with a word, numbered among these.

    Two lines are equal if their words are, whatever white space stands between these; `line` is a hash of the words.
    """

    def run(batches):
        for batch in batches:
            for part in row_slices(batch):
                lines = [(t or "").split("\n") for t in part.column(2).to_pylist()]
                hashes, where = word_hashes([x for own in lines for x in own], lower=False)
                counts = np.bincount(where, minlength=sum(map(len, lines))).astype(np.int64)
                # Hash of a line: its words' hashes, weighted by their places
                places = np.arange(len(hashes)) - np.repeat(np.cumsum(counts) - counts, counts)
                sums = np.zeros(len(counts), np.uint64)
                np.add.at(sums, where, mix(hashes + places.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
                owner = np.repeat(np.arange(len(lines)), [len(own) for own in lines])
                full = counts > 0
                owner, line, words = owner[full], mix(sums[full] + counts[full].astype(np.uint64)), counts[full]
                first = np.searchsorted(owner, np.arange(len(lines)))
                of = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(of),
                        part.column(1).take(of),
                        pa.array((np.arange(len(owner)) - first[owner]).astype(np.int32)),
                        pa.array(line.view(np.int64)),
                        pa.array(words.astype(np.int32)),
                    ],
                    names=["doc_id", "mark", "at", "line", "words"],
                )

    return docs.select("doc_id", "mark", "text").mapInArrow(run, "doc_id long, mark long, at int, line long, words int")


def _place() -> Column:
    return F.struct("doc_id", "mark", "at")


def _ranked(suffixes: DataFrame, by: list[str]) -> DataFrame:
    """Suffixes that share their key `by` with another one, with `rank` (of the key, ascending) and `first` (of those).

    Keys are counted with partial sums, so a line that stands in a third of all documents costs one row per task
    there, and only one row per key is sorted. A row's number in the sorted table is its rank: numbers ascend within
    and between partitions. Ranks are written before they are joined, as Spark can't split a skewed join one side of
    which is still being grouped by the same key.
    """
    suffixes = stored(suffixes, "suffixes")
    shared = suffixes.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min(_place()).alias("first")).filter("n > 1")
    ranks = stored(shared.drop("n").orderBy(*by).withColumn("rank", F.monotonically_increasing_id()), "ranks")
    out = stored(suffixes.join(ranks, by).drop(*by), "array")
    discard(suffixes, ranks)
    return out


def _doubled(array: DataFrame, shift: int) -> DataFrame:
    """Suffixes keyed by their own rank (`left`) and that of the suffix `shift` lines on (`right`), if both repeat."""
    on = array.select(
        F.col("doc_id").alias("d"), F.col("mark").alias("m"), (F.col("at") - shift).alias("a"), F.col("rank").alias("right")
    )
    own = array.select("doc_id", "mark", "at", F.col("rank").alias("left"))
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("mark") == F.col("m")) & (F.col("at") == F.col("a"))
    return own.join(on, same).select("doc_id", "mark", "at", "left", "right")


def suffix_array(lines: DataFrame, depth: int) -> DataFrame:
    """`doc_id, mark, at, rank, first`: suffixes with equal ranks have a common prefix of `depth` lines or more.

    Ranks ascend with the prefixes (lines ordered by their ids). Suffixes without a partner aren't there.
    """
    array, h = _ranked(lines.select("doc_id", "mark", "at", "line"), ["line"]), 1
    while h < depth:
        # Two halves of h lines; overlapping ones where fewer than 2h lines are left to go.
        shift = min(h, depth - h)
        longer = _ranked(_doubled(array, shift), ["left", "right"])
        discard(array)
        array, h = longer, h + shift
    return array


def _keyed(doc_id: Column, text: Column) -> list[Column]:
    """What names a text: its id and a hash of its content."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return [doc_id.cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text")]


def repeated_lines(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """`doc_id, mark, first, last`: runs of lines (numbers among lines with a word) that have an earlier copy.

    Earlier means a smaller document id (null ids come first, equal ids are ordered by their marks) or an earlier
    line of the same document. Rows that repeat an id and a text are one document here. Runs may touch or overlap.
    """
    return _repeated(docs.select(*_keyed(F.col("doc_id"), F.col("text"))), min_lines, min_words)


def _repeated(docs: DataFrame, min_lines: int, min_words: int) -> DataFrame:
    lines = stored(line_ids(docs).dropDuplicates(["doc_id", "mark", "at"]), "lines")
    later = _place() != F.col("first")

    def found(array: DataFrame, length: int) -> DataFrame:
        return array.filter(later).select("doc_id", "mark", F.col("at").alias("first"), (F.col("at") + (length - 1)).alias("last"))

    long = suffix_array(lines.filter(F.col("words") >= min_words), 1)
    runs = suffix_array(lines, min_lines)
    out = stored(found(long, 1).unionByName(found(runs, min_lines)), "runs")
    discard(lines, long, runs)
    return out


def _edited(docs: DataFrame, min_lines: int, min_words: int, schema, finish) -> DataFrame:
    names = docs.columns
    at = names.index("text")
    # Positions as names, so that helper columns can't clash with columns of the input
    own = [f"c{k}" for k in range(len(names))]
    rows = docs.toDF(*own)
    *key, text = _keyed(F.col(own[names.index("doc_id")]), F.col(own[at]))
    lists = _repeated(rows.select(*key, text), min_lines, min_words).groupBy("doc_id", "mark")
    lists = lists.agg(F.collect_list(F.struct("first", "last")).alias("runs")).toDF("of_id", "of_mark", "runs")
    same = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("mark") == F.col("of_mark"))
    joined = rows.select(*own, *key).join(lists, same, "left").select(*own, "runs")

    def make():
        def rows_of(*columns):
            out = []
            texts = [t or "" for t in columns[at]]
            for row, text in zip(zip(*columns, strict=True), texts, strict=True):
                lines = text.split("\n")
                full = [k for k, x in enumerate(lines) if x.strip(ASCII_SPACE)]
                gone = {k for x in row[-1] or () for k in full[x["first"] : x["last"] + 1]}
                kept = "\n".join([x for k, x in enumerate(lines) if k not in gone]) if gone else text
                out += finish(row[:-1], kept, len(full), len(gone))
            return out

        return rows_of

    return map_rows(joined, schema, make)


def delete_repeats(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of `docs` without later copies of repeated runs; `n_chars`, if there, follows the new text.

    Blank lines stay. A document that loses all its lines is dropped; one without lines (empty or null text) stays.
    Rows with the same id and text are treated alike; other columns are kept, whatever they are called; an empty table
    stays empty; a text is taken whole, however long.
    """
    names = docs.columns
    at, n_at = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def finish(row, kept, n, gone):
        if gone == n and n:
            return []
        if gone:
            row = list(row)
            row[at] = kept
            if n_at is not None:
                row[n_at] = len(kept)
        return [tuple(row)]

    return _edited(docs, min_lines, min_words, docs.schema, finish)


def report(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """Per row: `doc_id, n_lines, n_deleted, kept_sha256` (of the text that stays); cases as in `delete_repeats`."""

    def finish(row, kept, n, gone):
        return [(row[0], n, gone, hashlib.sha256(kept.encode("utf-8", "surrogatepass")).hexdigest())]

    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return _edited(docs, min_lines, min_words, "doc_id long, n_lines long, n_deleted long, kept_sha256 string", finish)
