"""MinHash near-duplicates with sequential Bayesian verification (operator 3).

Method: texts become sets of word shingles with MinHash signatures. Texts with the same set are one class from the
start. Classes that share a band of their signatures are candidates; the number of bands follows from the chosen
probability of missing a pair at the threshold. Candidates are gathered in families (components of the band graph).
Within a family, the signatures of pairs that share a band are compared batch by batch, and a pair is dropped as soon as
the posterior probability that its similarity reaches the threshold falls under the chosen miss probability; all
survivors are verified on their full sets. Pairs that are linked already through others are not compared again, which loses no component.

Large families are cut into blocks, by members and by the sizes of their sets, and every pair of blocks is a task of
its own, so neither a task nor a group grows with the size of a family beyond a bound. No task emits more links than it has members.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latticeframe.llm.common import cut, map_rows
from latticeframe.llm.components import connected_components
from latticeframe.llm.shingle_sets import overlap, set_digest, shingle_sets, signatures

ROWS = 5  # hashes in a band
BATCH = 16  # hashes compared between two looks at the posterior
MISS = 1e-5
BLOCK = (512, 1 << 20)  # members of a block and shingles in their sets, more where a family would have over 16 blocks
BLOCK_MOST = (8192, 1 << 22)
BROADCAST_BYTES = 64 << 20
MEMBER_BYTES = 256  # of a row of `members` in a broadcast table, all its columns of fixed width


def bands_for(threshold: float, miss: float = MISS, rows: int = ROWS) -> int:
    """Bands with which a pair at the threshold is missed with probability `miss` at most."""
    return math.ceil(math.log(miss) / math.log(1 - threshold**rows))


def posterior_tail(matches: int, n: int, threshold: float) -> float:
    """P(similarity >= threshold) after `matches` of `n` equal hashes, from a uniform prior: a Beta tail."""
    return math.fsum(_terms(n + 1, threshold, matches + 1))


def _terms(m: int, p: float, count: int) -> Iterator[float]:
    """The first terms of a binomial distribution, by logarithms, as the coefficients don't fit into a float."""
    for j in range(count):
        log_of = math.lgamma(m + 1) - math.lgamma(j + 1) - math.lgamma(m - j + 1)
        yield math.exp(log_of + j * math.log(p) + (m - j) * math.log1p(-p))


def least_matches(hashes: int, threshold: float, miss: float) -> list[tuple[int, int]]:
    """(hashes looked at so far, matches that a pair needs to stay) after each batch."""
    out = []
    for n in [*range(BATCH, hashes, BATCH), hashes]:
        tails = itertools.accumulate(_terms(n + 1, threshold, n + 1))
        out.append((n, next(m for m, tail in enumerate(tails) if tail >= miss)))
    return out


# --- signatures ----------------------------------------------------------------------------------------------------


def _mark() -> Column:
    """Tells texts with the same id apart."""
    return F.xxhash64(F.col("text").cast("string"))


def band_names(sig: np.ndarray) -> np.ndarray:
    """One 64-bit name per band of each signature; the band's number is part of it."""
    parts = sig.reshape(len(sig), -1, ROWS)
    names = np.zeros(parts.shape[:2], np.uint64)
    for k in range(ROWS):
        names = (names ^ parts[:, :, k]) * np.uint64(0x9E3779B97F4A7C15)
        names ^= names >> np.uint64(29)
    return ((names ^ np.arange(names.shape[1], dtype=np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64)


def sketch(docs: DataFrame, shingle: int, bands: int) -> DataFrame:
    """`doc_id, mark` (of the text), `n_shingles, digest` (of the whole set; null for an empty one) and the hashes of all `bands`."""

    def make():
        def rows(ids, texts, marks):
            value, at = shingle_sets([t or "" for t in texts], shingle)
            sig = signatures(value, at, bands * ROWS)
            names = band_names(sig)
            out = []
            for k, i in enumerate(ids):
                n = int(at[k + 1] - at[k])
                out.append((i, marks[k], n, set_digest(value[at[k] : at[k + 1]]) if n else None, names[k].tolist() if n else []))
            return out

        return rows

    return map_rows(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), _mark()),
        "doc_id long, mark long, n_shingles long, digest binary, bands array<long>",
        make,
    )


# --- verification --------------------------------------------------------------------------------------------------


class Forest:
    """Union-find over the members of one task."""

    def __init__(self, n: int):
        self.root = np.arange(n)  # kept flat, so that whole rows of members can be compared at once

    def link(self, a: int, b: int) -> None:
        ra, rb = self.root[a], self.root[b]
        if ra != rb:
            self.root[self.root == max(ra, rb)] = min(ra, rb)


def find_links(sets: list[np.ndarray], sig: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int, looks) -> list:
    """Links (positions) that connect whatever is similar enough among `left` x `right`, without needless ones.

    Candidates are the pairs that share a band of their signatures.
    """
    names = band_names(sig)
    sizes = np.array([len(s) for s in sets])
    forest, found = Forest(len(sets)), []
    for x in left:
        cand = right[forest.root[right] != forest.root[x]]
        # A pair can only reach the threshold if its sizes are close enough.
        small, large = np.minimum(sizes[cand], sizes[x]), np.maximum(sizes[cand], sizes[x])
        cand = cand[(100 * small >= percent * large) & (cand != x)]
        cand = cand[(names[cand] == names[x]).any(axis=1)]
        matches, done = np.zeros(len(cand), np.int64), 0
        for n, need in looks:
            if not len(cand):
                break
            matches = matches + (sig[cand, done:n] == sig[x, done:n]).sum(axis=1)
            stay = matches >= need
            cand, matches, done = cand[stay], matches[stay], n
        for y in cand[np.argsort(-matches, kind="stable")]:
            if forest.root[x] == forest.root[y]:
                continue
            common = overlap(sets[x], sets[y])
            if 100 * common >= percent * (len(sets[x]) + len(sets[y]) - common):
                forest.link(x, y)
                found.append((int(x), int(y)))
    return found


def _family_sets(docs: DataFrame, members: DataFrame, shingle: int) -> DataFrame:
    """`family, blocks, block, name, values` of the classes in `members`, their sets as sorted 64-bit values.

    A class is read from the text of its first row, found by id and mark; copies of that row are combined if they have
    no id and else passed over within a task.
    """
    small = F.broadcast(members) if members.count() * MEMBER_BYTES <= BROADCAST_BYTES else members
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), _mark().alias("mark"))
    of_class = ["name", "family", "blocks", "block", "digest"]
    with_id = texts.filter("doc_id is not null").join(small.filter("doc_id is not null"), ["doc_id", "mark"]).select(*of_class, "text")
    without = texts.filter("doc_id is null").drop("doc_id").join(small.filter("doc_id is null").drop("doc_id"), "mark")
    without = without.groupBy(*of_class).agg(F.first("text").alias("text"))

    def make():
        seen: set[int] = set()

        def rows_of(names, families, blocks, block, digests, texts):
            new = [k for k, name in enumerate(names) if name not in seen and not seen.add(name)]
            value, at = shingle_sets([texts[k] or "" for k in new], shingle)
            out = []
            for n, k in enumerate(new):
                own = value[at[n] : at[n + 1]]
                if set_digest(own) == digests[k]:
                    out.append((families[k], blocks[k], block[k], names[k], own.tobytes()))
            return out

        return rows_of

    return map_rows(with_id.unionByName(without), "family long, blocks int, block int, name long, values binary", make)


def _verified(sets: DataFrame, percent: int, hashes: int, miss: float) -> DataFrame:
    """Links `a, b` between classes, from one task for each pair of blocks of a family."""
    looks = least_matches(hashes, percent / 100, miss)
    pairs = sets.select(
        "family",
        "block",
        "name",
        "values",
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.col("blocks") - 1),
                lambda o: F.struct(F.least(F.col("block"), o).alias("i"), F.greatest(F.col("block"), o).alias("j")),
            )
        ).alias("p"),
    ).select("family", F.col("p.i").alias("i"), F.col("p.j").alias("j"), "block", "name", "values")

    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("name")
        ids = pdf["name"].to_numpy()
        own = [np.frombuffer(v, np.uint64) for v in pdf["values"]]
        at = np.concatenate([[0], np.cumsum([len(s) for s in own])])
        sig = signatures(np.concatenate(own), at, hashes)
        block, i, j = pdf["block"].to_numpy(), pdf["i"].iloc[0], pdf["j"].iloc[0]
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        links = find_links(own, sig, left, right, percent, looks)
        return pd.DataFrame({"a": [ids[x] for x, _ in links], "b": [ids[y] for _, y in links]}, dtype="int64")

    return pairs.groupBy("family", "i", "j").applyInPandas(verify, "a long, b long")


# --- operator ------------------------------------------------------------------------------------------------------


def _judged(docs: DataFrame, shingle: int, percent: int, miss: float) -> DataFrame:
    """The columns of `near_duplicates` and `mark`. Classes are named by their sets, as an id may have several texts."""
    bands = bands_for(percent / 100, miss)
    base = cut(sketch(docs, shingle, bands))
    full = base.filter("digest is not null")
    # The first row of a class: the smallest id, nulls last, then the smallest mark
    first_row = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "mark")
    classes = full.groupBy("digest").agg(F.min(first_row).alias("rep"), F.first("bands").alias("bands"), F.first("n_shingles").alias("size"))
    classes = classes.withColumn("name", F.xxhash64("digest"))
    named = classes.select("name", F.explode("bands").alias("band"))
    # Grouped minima and counts are written before they are joined, so that Spark can split a skewed join.
    shared = cut(named.groupBy("band").agg(F.min("name").alias("centre"), F.count(F.lit(1)).alias("n")).filter("n > 1"))
    stars = named.join(shared, "band").filter("name <> centre").select(F.col("name").alias("a"), F.col("centre").alias("b"))
    families = connected_components(stars)

    known = cut(families.join(classes.select(F.col("name").alias("id"), "rep", "digest", "size"), "id"))
    sizes = cut(known.groupBy("root").agg(F.count(F.lit(1)).alias("m"), F.sum("size").alias("s")))
    few, most = (F.greatest(F.ceil(F.col("m") / b[0]), F.ceil(F.col("s") / b[1])) for b in (BLOCK, BLOCK_MOST))
    blocks = F.when(few <= 16, few).otherwise(F.greatest(F.lit(16), most)).cast("int")
    members = cut(
        known.join(sizes, "root")
        .select(
            F.col("rep.doc_id").alias("doc_id"),
            F.col("rep.mark").alias("mark"),
            F.col("id").alias("name"),
            F.col("root").alias("family"),
            blocks.alias("blocks"),
            F.pmod(F.xxhash64("id"), blocks).cast("int").alias("block"),
            "digest",
        )
    )
    links = _verified(_family_sets(docs, members, shingle), percent, bands * ROWS, miss)
    merged = connected_components(links).withColumnRenamed("id", "name")
    own = F.struct("rep", "digest")
    firsts = cut(merged.join(classes, "name").groupBy("root").agg(F.min(own).alias("first")))
    roots = (
        classes.join(merged.join(firsts, "root").select("name", "first"), "name", "left")
        .withColumn("first", F.coalesce("first", own))
        .select("digest", F.col("first.rep").alias("leader"), (F.col("first.digest") == F.col("digest")).alias("leads"))
    )
    same_row = F.col("doc_id").eqNullSafe(F.col("leader.doc_id")) & (F.col("doc_id").isNotNull() | (F.col("mark") == F.col("leader.mark")))
    empty = F.col("digest").isNull()
    return base.join(roots, "digest", "left").select(
        "doc_id",
        "mark",
        "n_shingles",
        F.when(empty, F.col("doc_id")).otherwise(F.col("leader.doc_id")).alias("component_id"),
        F.when(empty, True).otherwise(F.col("leads") & same_row).alias("kept"),
    )


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, miss: float = MISS) -> DataFrame:
    """`doc_id, n_shingles, component_id, kept` for every row of `docs` (columns doc_id and text).

    Two texts are linked if 100 * |intersection| >= percent * |union| of their shingle sets; a component is named by
    its smallest id, which is the one kept. A null text is empty; a text without words is linked with nothing and
    kept. Rows with the same id stay rows of their own and share their verdict if their texts do. Null ids come after
    all others: a component without any id is named null, and its text of the smallest 64-bit hash is the one kept.
    Texts are taken whole, however long; extra columns are ignored, whatever they are called; an empty table gives an
    empty one.
    """
    return _judged(docs, shingle, percent, miss).drop("mark")


def keep_one(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs` that `near_duplicates` keeps: the first row of each component, and everything without words.

    A row goes by its id and its text; rows that repeat both stay or go together. One without an id goes if its
    component has an id, or else another text that comes first. Other columns are kept, whatever they are called; an
    empty table stays empty.
    """
    names = docs.columns
    lost = _judged(docs, shingle, percent, MISS).filter("not kept")
    gone = lost.select(F.col("doc_id").alias("gone_id"), F.col("mark").alias("gone_mark")).distinct()
    # Positions as names, so that helper columns can't clash with columns of the input
    rows = docs.toDF(*(f"c{k}" for k in range(len(names))))
    own_id, own_text = (F.col(f"c{names.index(n)}") for n in ("doc_id", "text"))
    same = own_id.cast("long").eqNullSafe(F.col("gone_id")) & F.xxhash64(own_text.cast("string")).eqNullSafe(F.col("gone_mark"))
    return rows.join(gone, same, "left_anti").toDF(*names)
