"""Importance resampling towards a target distribution over hashed word runs (operator 13).

Method: segment deduplication. Separator newlines cut texts into lines. Equal lines are grouped, each different line's
features (runs of 1 to 3 words inside it) are hashed once and counted as often as the line occurs; the few runs that
reach over a line's end are counted with the document that they are in. Both sides' counts give one gain per bucket.
Each different line is weighed once, documents collect the weights of their lines, and the draw adds a Gumbel term
that depends on the document's id and the seed alone, so the highest scores are a weighted sample without replacement.

Only bucket counts (a number for each bucket, whatever the input) and one row for each sorted partition come to the
driver. Lines are counted with partial sums, and joined from written tables, so a line that stands in a third of all
documents is split like any other skewed key.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latticeframe.llm.common import discard, only, row_slices, stored
from latticeframe.llm.ngram_buckets import Words

BUCKETS = 10_000
#: Documents with fewer words aren't drawn.
LEAST_WORDS = 20


def _segments() -> Column:
    return F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: x != "")


def _names(line: Column) -> list[Column]:
    """Two 64-bit hashes with different seeds, by which a line is known."""
    return [F.xxhash64(line).alias("k1"), F.xxhash64(F.lit(1), line).alias("k2")]


def _lists(text: np.ndarray, bucket: np.ndarray, n: int) -> pa.Array:
    offsets = np.searchsorted(text, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(bucket.astype(np.int16)))


def hashed_lines(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """`k1, k2, n, buckets` of `text`: each different line, how often it occurs, and its features' buckets."""
    lines = texts.select(F.explode(_segments()).alias("line")).groupBy("line").count()

    def run(batches):
        for batch in batches:
            for part in row_slices(batch, 4096):
                words = Words(part.column(3).to_pylist())
                found = _lists(*words.runs(buckets, crossing=False), part.num_rows)
                yield pa.RecordBatch.from_arrays([*part.columns[:3], found], names=["k1", "k2", "n", "buckets"])

    named = lines.select(*_names(F.col("line")), F.col("count").alias("n"), "line")
    return named.mapInArrow(run, "k1 long, k2 long, n long, buckets array<smallint>")


def documents_of_lines(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """`doc_id, n_words, lines, buckets` per row: the names of its lines, and features that reach over a line's end."""
    lines = F.transform(_segments(), lambda x: F.struct(*_names(x)))

    def run(batches):
        for batch in batches:
            for part in row_slices(batch):
                words = Words(part.column(2).to_pylist())
                counts = pa.array(words.counts(part.num_rows))
                found = _lists(*words.runs(buckets, crossing=True), part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column(0), counts, part.column(1), found], names=["doc_id", "n_words", "lines", "buckets"])

    kind = "doc_id long, n_words long, lines array<struct<k1: long, k2: long>>, buckets array<smallint>"
    return docs.select("doc_id", lines.alias("lines"), "text").mapInArrow(run, kind)


def _owned(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and the row of each."""
    return column.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(column)), np.diff(column.offsets.to_numpy()))


def _sums(df: DataFrame, buckets: int) -> DataFrame:
    """`bucket, n` of `n, buckets`: at most one row for each bucket and task."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            found, row = _owned(batch.column(1))
            times = batch.column(0).to_numpy(zero_copy_only=False)[row]
            total += np.bincount(found, times, buckets).astype(np.int64)
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(total[full])], names=["bucket", "n"])

    return df.select("n", "buckets").mapInArrow(run, "bucket long, n long")


def feature_counts(lines: DataFrame, docs: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Features in each bucket: those of the lines, as often as these occur, and those over the lines' ends."""
    both = _sums(lines, buckets).unionByName(_sums(docs.withColumn("n", F.lit(1).cast("long")), buckets))
    out = [0] * buckets
    for r in both.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row for each bucket at most
        out[r.bucket] = r.n
    return out


def gains(raw: list[int], target: list[int]) -> list[int]:
    """Thousandths of the log ratio of each bucket's smoothed shares, rounded down."""
    s, t, b = float(sum(raw)), float(sum(target)), float(len(raw))
    return [math.floor(1000 * math.log((y + 1.0) * (s + b) / ((x + 1.0) * (t + b)))) for x, y in zip(raw, target, strict=True)]


def _weighed(df: DataFrame, gain: list[int]) -> DataFrame:
    """`df` with `weight`, the sum of gains over its last column `buckets`, in place of that."""
    *names, _ = df.columns
    value = np.array(gain, np.int64)

    def run(batches):
        for batch in batches:
            found, row = _owned(batch.column(len(names)))
            # Integers below 2**53, so sums of doubles are exact
            weight = np.bincount(row, value[found], batch.num_rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(weight)], names=[*names, "weight"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields[:-1])
    return df.mapInArrow(run, f"{kinds}, weight long")


def gumbel(doc_id: Column, seed: int) -> Column:
    """Thousandths of a Gumbel variate that depends on id and seed only, rounded down."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def numbered(df: DataFrame, *order) -> DataFrame:
    """`df`, written in this order, with `place` (0, 1, 2 ... over all rows): no task holds more than its range."""
    rows = stored(df.orderBy(*order).withColumn("__at", F.monotonically_increasing_id()), "numbered")
    part, at = F.shiftright("__at", 33), F.col("__at").bitwiseAND((1 << 33) - 1)
    sizes = sorted(rows.groupBy(part.alias("part")).count().collect())  # one row for each partition written
    before = dict(zip([s[0] for s in sizes], np.cumsum([0, *(s[1] for s in sizes)]).tolist(), strict=False))
    starts = df.sparkSession.createDataFrame(list(before.items()), "__part long, __before long")
    return rows.join(F.broadcast(starts), part == F.col("__part")).withColumn("place", at + F.col("__before")).drop("__at", "__part", "__before")


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, seed: int = 42, least_words: int = LEAST_WORDS, buckets: int = BUCKETS) -> DataFrame:
    """`doc_id, n_features, weight, score, rank` per row of `docs` (`doc_id, text`), for `text` of `target`.

    `rank` numbers the `percent` per cent (rounded down) of the rows with `least_words` words or more that have the
    highest scores; ties go to the smaller id (null last), then to either of the rows that share it. It is null for all
    others. A null or empty text has no features and weighs 0; a null id counts as an empty one in the Gumbel term;
    repeated rows are rows of their own; texts are taken whole, however long; other columns are ignored; an empty
    `docs` gives an empty table, an empty `target` counts of 0.
    """
    docs, target = only(docs, doc_id="long", text="string"), only(target, text="string")
    lines = stored(hashed_lines(docs, buckets), "lines")
    rows = stored(documents_of_lines(docs, buckets).withColumn("row", F.monotonically_increasing_id()), "rows")
    aims = target.withColumn("doc_id", F.lit(None).cast("long"))
    gain = gains(
        feature_counts(lines, rows, buckets), feature_counts(hashed_lines(target, buckets), documents_of_lines(aims, buckets), buckets)
    )
    weights = stored(_weighed(lines.select("k1", "k2", "buckets"), gain), "weights")
    own = _weighed(rows.select("row", "doc_id", "n_words", "buckets"), gain)
    parts = rows.select("row", F.explode("lines").alias("l")).select("row", "l.k1", "l.k2").join(weights, ["k1", "k2"])
    none = F.lit(None).cast("long")
    parts = parts.select("row", none.alias("doc_id"), none.alias("n_words"), "weight")
    whole = own.unionByName(parts).groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n"), F.sum("weight").alias("weight"))
    drawable = F.col("n") >= least_words
    scored = whole.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)).withColumn("drawable", drawable)
    placed = numbered(scored, F.desc("drawable"), F.desc("score"), F.asc_nulls_last("doc_id"), "row")
    drawn = rows.filter(F.col("n_words") >= least_words).count() * percent // 100
    discard(lines, weights)
    features = F.col("n") + F.greatest(F.col("n") - 1, F.lit(0)) + F.greatest(F.col("n") - 2, F.lit(0))
    return placed.select(
        "doc_id", features.alias("n_features"), "weight", "score", F.when(F.col("place") < drawn, F.col("place") + 1).alias("rank")
    )
