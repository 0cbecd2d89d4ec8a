"""Fingerprints of configurations, rows and tables (FP-01 .. FP-03, AG-24)."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from latticeframe.sources.work import kept


def config_fingerprint(config: dict, length: int = 16) -> str:
    """First hex digits of the SHA-256 of canonical JSON."""
    return hashlib.sha256(json.dumps(config, sort_keys=True, separators=(",", ":")).encode()).hexdigest()[:length]


def row_fingerprint(*columns: str, length: int = 16) -> Column:
    """The same for a row: SHA-256 of the JSON of its columns, named in order."""
    return F.substring(F.sha2(F.to_json(F.struct(*sorted(columns))), 256), 1, length)


#: Members of a group whose hashes may be put into one row
MOST_MEMBERS = 10_000_000


def combined_checksum(df: DataFrame, keys: list[str], member: str) -> DataFrame:
    """AG-24: `keys, n_members, checksum`: hash of the sorted member hashes of each group; NULL members don't count.

    The hash is over one text, so a group's hashes have to meet in one row. Groups are counted first, and one with
    more than `MOST_MEMBERS` is an error; `tree_checksum` and `table_fingerprint` have no such bound.
    """
    counts = df.groupBy(*keys).agg(F.count(member).alias("n"))
    if (most := counts.agg(F.max("n").alias("n")).first()["n"] or 0) > MOST_MEMBERS:
        raise ValueError(f"a group of {most} members; use tree_checksum")
    one = F.sha2(F.concat_ws("", F.array_sort(F.collect_list(F.sha2(F.col(member), 256)))), 256)
    return df.groupBy(*keys).agg(F.count(member).alias("n_members"), one.alias("checksum"))


def fingerprint_columns(df: DataFrame) -> list[Column]:
    """FP-02 as aggregates: `n_rows` and `row_hash_sum`, a sum of row hashes that doesn't depend on order or partitions."""
    h = F.xxhash64(*(F.col(f"`{c}`") for c in sorted(df.columns))).cast("decimal(38,0)")
    return [F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(h), F.lit(0)).cast("string").alias("row_hash_sum")]


def table_fingerprint(df: DataFrame) -> DataFrame:
    """FP-02: count and sum of row hashes in one row."""
    return df.agg(*fingerprint_columns(df))


def _peeled(edges: DataFrame, start: DataFrame, near: str, far: str) -> DataFrame:
    """Products of `start` left after those without `near` neighbours were taken off again and again, from one end."""
    left = start
    size = left.count()
    while size:
        among = edges.join(left.select(F.col("product").alias(near)), near, "left_semi")
        left = kept(left.join(among.select(F.col(far).alias("product")).distinct(), "product", "left_semi"), "left")
        was, size = size, left.count()
        if was == size:
            break
    return left


def lineage_cycles(edges: DataFrame) -> DataFrame:
    """`product` of `edges` (product, upstream): those on a cycle, or on a way from one cycle to another."""
    links = edges.select("product", "upstream").distinct()
    names = links.select("product").union(links.select("upstream")).distinct()
    return _peeled(links, _peeled(links, names, "upstream", "product"), "product", "upstream")


def lineage(edges: DataFrame, own: DataFrame) -> DataFrame:
    """FP-03: `product, lineage_hash, level`: hash of each product's own configuration and of everything upstream.

    `own` has product, config_hash; `edges` has product, upstream. A change reaches exactly the products that stand
    downstream of it. Products are hashed level by level, each once, as soon as all that is upstream of them is, so
    chains may have any length; `level` is that of the longest chain from a root. Products on a cycle, and all
    downstream of it, have no hash: their hash and level are NULL, and `lineage_cycles` names the cycle. Upstreams
    that `own` doesn't know, and repeated edges, don't count.
    """
    names = own.select(F.col("product").alias("upstream"))
    links = kept(edges.select("product", "upstream").distinct().join(names, "upstream", "left_semi"), "links")
    waiting = kept(own.select("product", "config_hash"), "waiting")
    made, level, size = None, 0, waiting.count()
    while size:
        # What waits for something that waits itself isn't ready.
        held = links.join(waiting.select(F.col("product").alias("upstream")), "upstream", "left_semi").select("product").distinct()
        ready = waiting.join(held, "product", "left_anti")
        hashed = ready.withColumn("ups", F.lit(""))
        if made is not None:
            up = links.join(made.select(F.col("product").alias("upstream"), F.col("lineage_hash").alias("up")), "upstream").join(ready.select("product"), "product", "left_semi")
            folded = up.groupBy("product").agg(F.concat_ws("", F.array_sort(F.collect_list("up"))).alias("ups"))
            hashed = ready.join(folded, "product", "left").withColumn("ups", F.coalesce("ups", F.lit("")))
        now = hashed.select("product", F.sha2(F.concat("config_hash", "ups"), 256).alias("lineage_hash"), F.lit(level).alias("level"))
        now = kept(now, "hashes")
        waiting = kept(waiting.join(now.select("product"), "product", "left_anti"), "waiting")
        made = now if made is None else made.unionByName(now)
        was, size, level = size, waiting.count(), level + 1
        if was == size:
            break
    stuck = waiting.select("product", F.lit(None).cast("string").alias("lineage_hash"), F.lit(None).cast("int").alias("level"))
    return stuck if made is None else made.unionByName(stuck)


#: Members that are hashed at once, and hashes that a node of the tree holds
FAN_OUT = 1024


def tree_checksum(df: DataFrame, keys: list[str], member: str, fan_out: int = FAN_OUT) -> DataFrame:
    """AG-24 for groups of any size: `keys, n_members, checksum` by a hash tree over sorted member hashes.

    Sorted hashes are numbered within their group, runs of `fan_out` of them are one text each, and the texts' hashes
    are the next level, until one is left. So the result depends on the members alone, not on partitions, and no task
    holds more of a group than `fan_out` hashes. NULL members don't count; a group without members has the hash of an
    empty text. It differs from `combined_checksum`, which hashes all of a group's hashes at once.
    """
    group = F.struct(*(F.col(k) for k in keys), F.lit(0).alias("__all")).alias("__g")
    rows = df.select(group, F.sha2(F.col(member).cast("string"), 256).alias("h"))
    groups = kept(rows.groupBy("__g").agg(F.count("h").alias("n_members")), "groups")
    # A range-partitioned sort: numbers ascend within a written part, and a group's first number in a part and its rows in the parts before place it.
    level = kept(rows.filter("h is not null").orderBy("__g", "h").withColumn("at", F.monotonically_increasing_id()), "hashes")
    part = F.shiftright("at", 33).alias("part")
    parts = level.groupBy("__g", part).agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    of_group = W.partitionBy("__g")
    before = F.sum("n").over(of_group.orderBy("part")) - F.col("n")
    offsets = kept(parts.select("__g", "part", "first", before.alias("before"), F.sum("n").over(of_group).alias("n")), "offsets")
    level = level.withColumn("part", part).join(offsets, ["__g", "part"]).select("__g", "n", "h", (F.col("at") - F.col("first") + F.col("before")).alias("i"))
    largest, reach, tops = groups.agg(F.max("n_members")).first()[0] or 0, 1, None
    while True:
        nodes = level.groupBy("__g", "n", F.floor(F.col("i") / fan_out).alias("i"))
        text = F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct(F.col("i").alias("k"), "h"))), lambda x: x["h"]))
        level, reach = kept(nodes.agg(F.sha2(text, 256).alias("h")), "level"), reach * fan_out
        top = level.filter(F.col("n") <= reach).select("__g", "h")
        tops = top if tops is None else tops.unionByName(top)
        if largest <= reach:
            break
        level = level.filter(F.col("n") > reach)
    out = groups.join(tops, "__g", "left")
    return out.select(*(F.col(f"__g.{k}").alias(k) for k in keys), "n_members", F.coalesce("h", F.sha2(F.lit(""), 256)).alias("checksum"))
