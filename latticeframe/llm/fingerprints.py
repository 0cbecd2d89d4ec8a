"""Document fingerprints (operator 2, built-in functions only).

Method: a threshold-scaled sketch. Of the hashes of all word shingles of a text, exactly those below a fixed fraction
of the hash range are kept, so the sketch of a union is the union of sketches and containment between very unequal
documents can be estimated without either side's size being known in advance. The least hash of a text is kept too
(the union's least is the least of leasts), so that a short text never has an empty sketch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from latticeframe.llm.native_text import let, shingles, words

SHINGLE = 5
#: Kept: shingle hashes below this fraction of the range.
FRACTION = 0.25
#: Hashes are unsigned and 48 bits wide.
HASH_BITS = 48
#: Documents are put in order in ranges of ids: quantiles that cut these first, rows meant for one range, most ranges,
#: and bits of the hash that cuts ids which are too frequent for one range
CELLS = 256
RANGE_ROWS = 512
MAX_RANGES = 1 << 18
MARK_BITS = 10


def sketch(text: Column, size: int = SHINGLE, fraction: float = FRACTION) -> Column:
    """Ascending distinct hashes kept of a text; empty only for a text without words."""
    limit = int((1 << HASH_BITS) * fraction)
    hashes = let(
        words(text),
        lambda w: F.transform(shingles(w, size), lambda h: F.shiftrightunsigned(h, 64 - HASH_BITS)),
    )

    return let(
        hashes,
        lambda h: F.when(F.size(h) == 0, F.array().cast("array<bigint>")).otherwise(
            let(
                F.array_min(h),
                lambda low: F.sort_array(F.array_distinct(F.filter(h, lambda x: (x < limit) | (x == low)))),
            )
        ),
    )


def as_string(s: Column) -> Column:
    return F.array_join(F.transform(s, lambda h: F.lower(F.hex(h))), " ")


def merged(a: Column, b: Column, fraction: float = FRACTION) -> Column:
    """The sketch of the two texts' shingles together."""
    limit = int((1 << HASH_BITS) * fraction)
    both = F.sort_array(F.array_union(a, b))
    return F.filter(both, lambda x, i: (x < limit) | (i == 0))


def likeness(a: Column, b: Column) -> Column:
    """Estimated resemblance, 0 to 1. Two texts without words are alike (1), one without and one with aren't (0)."""
    common = F.size(F.array_intersect(a, b))
    total = F.size(a) + F.size(b) - common
    return F.when(total == 0, F.lit(1.0)).otherwise(common / total)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b has; 1 for a text without words."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def _ranges(docs: DataFrame) -> Column:
    """The range of a row of `docs` (columns doc_id, mark), ascending in the order of `_place`.

    Ids are cut at quantiles, and between two of these evenly, so far-off ids don't empty the other ranges. Ids that
    reach over several quantiles, and null ones, are cut by `mark` too.
    """
    k = F.col("doc_id")
    told = docs.agg(F.percentile_approx(k, [i / CELLS for i in range(CELLS + 1)]).alias("q"), F.count(F.lit(1)).alias("n")).first()
    cuts = told["q"] or [0]
    parts = max(1, min(told["n"] // RANGE_ROWS, MAX_RANGES) // CELLS)
    often = sorted({x for x, y in zip(cuts, cuts[1:], strict=False) if x == y}) or [cuts[0]]
    longs = lambda x: F.array(*(F.lit(v).cast("long") for v in x))
    cell = F.size(F.filter(longs(cuts[1:-1]), lambda c: c <= k)) if len(cuts) > 2 else F.lit(0)
    low = F.get(longs(cuts[:-1] or cuts), cell).cast("double")
    high = F.get(longs(cuts[1:] or cuts), cell).cast("double")
    # In doubles, as differences of ids can be wider than a long; rounding keeps the order.
    part = F.floor((k.cast("double") - low) / F.greatest(high - low, F.lit(1.0)) * parts)
    part = F.coalesce(F.least(F.greatest(part, F.lit(0)), F.lit(parts - 1)), F.lit(0))
    by_mark = F.when(k.isNull() | k.isin(often), F.shiftright("mark", 64 - MARK_BITS)).otherwise(F.lit(0))
    return F.struct(k.isNull().alias("none"), (-cell).alias("cell"), (-part).alias("part"), by_mark.alias("by_mark"))


def _place() -> Column:
    """Ascending where `doc_id` descends; null ids come last, repeated ids in the order of their marks."""
    return F.struct(F.col("doc_id").isNull().alias("none"), F.bitwise_not("doc_id").alias("down"), F.col("mark").alias("mark"))


def with_next(docs: DataFrame, more: dict[str, Column]) -> DataFrame:
    """`docs` (doc_id long, text string) with the columns `more`, and `next_text` and `next_<column>` for each of these.

    The next row is the one that follows by descending id; after the last comes the first. Rows are dealt into ranges
    of ids in one shuffle; each range also gets a copy of the first row of the range that follows, so no window spans
    more than one range. Ids may have gaps and any width. Repeated ids stand in the order of a hash of their texts,
    null ones after all others.
    """
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("mark"))
    marked = docs.withColumn("range", _ranges(docs)).withColumn("place", _place())
    # The first row of each range and the range before it: a table of (MAX_RANGES + marks of frequent ids) rows at most.
    firsts = marked.groupBy("range").agg(F.min("place").alias("first"))
    around = W.orderBy("range")
    before = F.coalesce(F.lag("range").over(around), F.max("range").over(W.partitionBy()))
    firsts = firsts.select(F.col("range").alias("of"), "first", before.alias("before"))
    heads = marked.join(F.broadcast(firsts), (F.col("range") == F.col("of")) & (F.col("place") == F.col("first")))
    heads = heads.select("doc_id", "text", "place", F.col("before").alias("range"), F.lit(True).alias("copy"))
    rows = marked.select("doc_id", "text", "place", "range", F.lit(False).alias("copy")).unionByName(heads).withColumns(more)
    follow = W.partitionBy("range").orderBy("copy", "place")
    # One lead per column: a lead over a struct of them would make a second copy of every text in the shuffle.
    lead = {f"next_{c}": F.lead(c).over(follow) for c in ("text", *more)}
    return rows.withColumns(lead).filter(~F.col("copy")).drop("copy", "range", "place")


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edit, whose second half is the first half of the next document.

    Null text is empty; equal texts have equal fingerprints, whatever their ids; a lone document is its own next.
    Texts are taken whole, however long; null and repeated ids and repeated rows keep rows of their own (their order is
    that of `with_next`); extra columns are ignored; an empty table gives an empty one.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = with_next(texts, {"sketch": sketch(F.col("text"))})
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.left("text", n - half), F.left("next_text", half))
    rows = rows.withColumn("n_chars", n.cast("long")).withColumn("edited", edited)
    rows = rows.withColumn("edited_sketch", sketch(F.col("edited")))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        as_string(F.col("sketch")).alias("fingerprint"),
        as_string(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        containment(F.col("edited_sketch"), F.col("sketch")).alias("edited_in_text"),
    )
