"""Samples, ranks and quantiles (WN-05, ST-03, ST-05, AG-21)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from latticeframe.functions.nulls import value
from latticeframe.sources.work import kept


def stratified_sample(pairs: DataFrame, cells: list[str], key: str, partner: str, seed: int, n: int) -> DataFrame:
    """Round robin over cells in a seeded order: first of each cell, then second ..., one use of each partner.

    The greedy loop always takes a partner's first turn, so keeping that turn alone gives the same sample. Only the
    first turns of each cell are ranked, which Spark prunes before it shuffles; the number of turns grows until the
    sample is full or all rows were looked at, so the result is that of ranking everything.
    """
    order = [F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256), F.col(key)]
    turn = F.row_number().over(W.partitionBy(*cells).orderBy(*order))
    largest = pairs.groupBy(*cells).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).first()["n"] or 0
    depth = max(n, 1)
    while True:
        turns = pairs.withColumn("__turn", turn).filter(F.col("__turn") <= depth)
        first = turns.groupBy(partner).agg(F.min(F.struct("__turn", *cells, key)).alias("__f"))
        kept = first.select(
            F.col("__f.__turn").alias("turn"), *(F.col(f"__f.{c}").alias(c) for c in cells), F.col(f"__f.{key}").alias(key), partner
        )
        sample = kept.orderBy("turn", *cells, key).limit(n)
        if depth >= largest or sample.count() >= n:
            return sample
        depth *= 4


def top_risk(rows: DataFrame, score: str, ids: list[str], k: int) -> DataFrame:
    """ST-03: the k largest scores; ids break ties."""
    return rows.orderBy(F.col(score).desc(), *ids).limit(k)


def _key_struct(keys: list[str]) -> Column:
    return F.struct(*(F.col(k) for k in keys), F.lit(0).alias("__all")).alias("__g")


def exact_quantiles(rows: DataFrame, keys: list[str], column: str, probabilities: list[float], limit: int = 65_536, splits: int = 64) -> DataFrame:
    """`keys, n, min, max, q` per group: interpolated quantiles over finite values, exact for groups of any size.

    Selection by rank: a quantile lies on one or two ranks of its group. Splitters from a mergeable sketch cut the
    bracket that holds a rank, counts tell which piece holds it, and that piece is the next bracket, until the bracket
    has one value or at most `limit` rows; these are sorted. A task or a state never holds more than that, and
    after the first round only rows within brackets are looked at. Brackets are a few rows for each group.
    """
    data = rows.select(_key_struct(keys), value(column).alias("__v"))
    data = data.withColumn("__v", F.when(F.abs("__v") < float("inf"), F.col("__v")))
    groups = kept(data.groupBy("__g").agg(F.count("__v").alias("n"), F.min("__v").alias("min"), F.max("__v").alias("max")), "groups")
    data = data.filter("__v is not null")
    place = F.explode(F.array(*(F.struct(F.lit(p).alias("p"), ((F.col("n") - 1) * F.lit(float(p))).alias("at")) for p in probabilities)))
    asked = groups.filter("n > 0").select("__g", place.alias("x")).select("__g", F.explode(F.array(F.floor("x.at"), F.ceil("x.at"))).alias("rank")).distinct()
    bounds = groups.select("__g", "n", F.col("min").alias("a"), F.col("max").alias("b"))
    # A bracket is [a, b]; `rank` counts from its first row, `of` from the group's.
    open_ranks = asked.join(bounds, "__g").select("__g", F.col("rank").alias("of"), "rank", "n", "a", "b")
    open_ranks = kept(open_ranks, "ranks")
    found = None
    while True:
        done = open_ranks.filter("a = b").select("__g", "of", F.col("a").alias("v"))
        few = open_ranks.filter(f"a < b and n <= {limit}")
        # Equal brackets of a group are read once for all their ranks.
        inside = data.join(few.select("__g", "a", "b").distinct(), "__g").filter("__v >= a and __v <= b")
        nth = F.row_number().over(W.partitionBy("__g", "a", "b").orderBy("__v")) - 1
        ranked = inside.withColumn("rank", nth.cast("long")).join(few, ["__g", "a", "b", "rank"])
        now = kept(done.unionByName(ranked.select("__g", "of", F.col("__v").alias("v"))), "found")
        found = now if found is None else found.unionByName(now)
        wide = open_ranks.filter(f"a < b and n > {limit}")
        if not wide.head(1):
            break
        brackets = wide.select("__g", "a", "b").distinct()
        inside = data.join(brackets, "__g").filter("__v >= a and __v <= b")
        at = [k / splits for k in range(1, splits)]
        cuts = kept(inside.groupBy("__g", "a", "b").agg(F.array_distinct(F.percentile_approx("__v", at, 50 * splits)).alias("cuts")), "cuts")
        pieces = data.join(cuts, "__g").filter("__v >= a and __v <= b")
        # A cut's own value is a piece of its own, so every round takes at least one value out of a bracket.
        piece = (2 * F.size(F.filter("cuts", lambda c: c < F.col("__v"))) + F.array_contains("cuts", F.col("__v")).cast("int")).alias("piece")
        counts = pieces.groupBy("__g", "a", "b", piece).agg(F.count(F.lit(1)).alias("m"), F.min("__v").alias("lo"), F.max("__v").alias("hi"))
        before = F.sum("m").over(W.partitionBy("__g", "a", "b").orderBy("piece")) - F.col("m")
        told = counts.withColumn("before", before)
        next_ranks = wide.join(told, ["__g", "a", "b"]).filter("rank >= before and rank < before + m")
        open_ranks = kept(next_ranks.select("__g", "of", (F.col("rank") - F.col("before")).alias("rank"), F.col("m").alias("n"), F.col("lo").alias("a"), F.col("hi").alias("b")), "ranks")
    values = F.map_from_entries(F.collect_list(F.struct("of", "v")))  # two for each probability at most
    ranks = found.groupBy("__g").agg(values.alias("by_rank"))

    def interpolated(p: float) -> Column:
        at = (F.col("n") - 1) * F.lit(float(p))
        lo, hi = F.element_at("by_rank", F.floor(at)), F.element_at("by_rank", F.ceil(at))
        return F.when(F.floor(at) == F.ceil(at), lo).otherwise((F.ceil(at) - at) * lo + (at - F.floor(at)) * hi)

    out = groups.join(ranks, "__g", "left").withColumn("q", F.when(F.col("n") > 0, F.array(*map(interpolated, probabilities))))
    return out.select(*(F.col(f"__g.{k}").alias(k) for k in keys), "n", "min", "max", "q")


def quantile_line(rows: DataFrame, keys: list[str], column: str, exact: bool = True) -> DataFrame:
    """AG-21: n, min, p50, p75, max over finite values; with fewer than two only n.

    Exact quantiles interpolate and are found by distributed selection; `exact=False` takes a mergeable sketch in one
    pass (an actual value within 1 / 10000 of the rank).
    """
    if exact:
        told = exact_quantiles(rows, keys, column, [0.5, 0.75])
    else:
        v = F.when(F.abs(value(column)) < float("inf"), value(column))
        approx = F.percentile_approx(v, F.array(F.lit(0.5), F.lit(0.75)), 10_000)
        told = rows.groupBy(*keys).agg(F.count(v).alias("n"), F.min(v).alias("min"), approx.alias("q"), F.max(v).alias("max"))
    some = lambda c: F.when(F.col("n") >= 2, c)
    return told.select(
        *keys, "n", some(F.col("min")).alias("min"), some(F.get("q", F.lit(0))).alias("p50"), some(F.get("q", F.lit(1))).alias("p75"), some(F.col("max")).alias("max")
    )
