"""Prefix trie of conversations (operator 12).

Method: truncation peeling. Each conversation is the list of names of its own prefixes, a name being a digest over all
(role, text) up to there. From the greatest depth up, the conversations that end at a depth join the nodes that came
from below; equal lists are one node, with its figures summed in the same grouping; then the last turn is stripped, and
what is left meets at the next depth. So nodes are found and aggregated in one pass, and only nodes, not conversations,
go on.

A round of Spark for each depth would make one deep conversation cost hundreds of them. So the trie is cut into subtrees
of bounded size, below a first turn, or where that is too common below the second, fourth, eighth ...: these are peeled
inside tasks, all at once. Only what lies above them, the prefixes that very many conversations share, is peeled by
Spark's groupings, which have partial sums.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latticeframe.llm.common import discard, map_rows, only, row_slices, stored

#: Ids whose decimals are joined at once
PIECE = 4096
#: Turns of a subtree's different conversations that a task peels at once
LIMIT = 8192
_PATH = "array<struct<name: binary, chars: long>>"


def conversations(turns: DataFrame) -> DataFrame:
    """`conv_id, turns` of `conv_id, turn, role, text`: by turn (null first), then role, then text; null is empty there."""
    blank = [F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")]
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", *blank))).alias("turns"))


def rebuilt(turns: DataFrame, family: int = 100, heads: int = 6) -> DataFrame:
    """`conv_id, turns`: the first h turns of conversation c - c % family, then c's own after its first h.

    h is the crc32 of c's decimals modulo `heads`. A null id has no decimals (h = 0) and keeps its own turns.
    """
    own = conversations(turns)
    first = conversations(turns.filter(F.col("conv_id") % family == 0))
    first = first.select(F.col("conv_id").alias("of_id"), F.slice("turns", 1, heads - 1).alias("head"))
    h = (F.crc32(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).cast("binary")) % heads).cast("int")
    joined = own.join(first, F.col("conv_id") - F.col("conv_id") % family == F.col("of_id"), "left")
    head = F.coalesce(F.slice("head", F.lit(1), h), F.array().cast("array<struct<turn: long, role: string, text: string>>"))
    return joined.select("conv_id", F.concat(head, F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))).alias("turns"))


def prefix_names(convs: DataFrame) -> DataFrame:
    """`conv_id, depth, path`: for each turn the name of the prefix that it ends, and the code points of its text."""

    def make():
        def rows(ids, lists):
            out = []
            for i, own in zip(ids, lists, strict=True):
                state, path = hashlib.sha256(), []
                for t in own:
                    # Lengths in front keep role and text apart.
                    for x in (t["role"].encode("utf-8", "surrogatepass"), t["text"].encode("utf-8", "surrogatepass")):
                        state.update(len(x).to_bytes(8, "little"))
                        state.update(x)
                    path.append({"name": state.digest(), "chars": len(t["text"])})
                out.append((i, len(path), path))
            return out

        return rows

    return map_rows(convs.select("conv_id", "turns"), f"conv_id long, depth int, path {_PATH}", make, chunk=64)


def _name(path: str, back: int) -> Column:
    """Name of the node `back` turns above the end of a path; the root's is empty."""
    return F.coalesce(F.get(path, F.size(path) - 1 - back)["name"], F.lit(b""))


def _merged(paths: DataFrame) -> DataFrame:
    """`path, depth, conv_id, n, ends_sha256`: equal conversations as one, with the digest of their ids."""
    same = paths.groupBy("path", "depth").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n"))
    same = stored(same.withColumn("name", _name("path", 0)), "same")
    hashes = stored(_id_digests(paths.select(_name("path", 0).alias("name"), "conv_id")), "hashes")
    out = stored(same.join(hashes, "name").drop("name"), "merged")
    discard(same, hashes)
    return out


def _least(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else min(a, b)


def peel(rows: list[tuple], top: int) -> list[tuple]:
    """Nodes, down to depth `top`, of whole subtrees: (path, depth, conv_id, n, ends_sha256) of all that ends there.

    A node is (path or None, name, depth, conv_id, parent_id, n_convs, n_children, n_leaves, saved, ends_sha256); those
    at depth `top` carry their paths, as their parents are found elsewhere.
    """
    ended: dict[int, list[tuple]] = {}
    for row in rows:
        ended.setdefault(row[1], []).append(row)
    out, below, depth = [], [], max(ended, default=top)
    while depth >= top:
        level: dict[bytes, list] = {}  # name -> path, conv_id, n_convs, n_children, n_leaves, saved, ends_sha256
        for path, _, conv_id, n, digest in ended.pop(depth, ()):
            level[path[depth - 1]["name"]] = [path, conv_id, n, 0, 0, 0, digest]
        for _, (path, conv_id, n, _, leaves, saved, _) in below:
            node = level.setdefault(path[depth - 1]["name"], [path, None, 0, 0, 0, 0, None])
            node[1:6] = _least(node[1], conv_id), node[2] + n, node[3] + 1, node[4] + leaves, node[5] + saved
        for name, node in below:
            out.append((None, name, depth + 1, node[1], level[node[0][depth - 1]["name"]][1], *node[2:]))
        for node in level.values():
            node[4] = node[4] or 1
            node[5] += (node[2] - 1) * node[0][depth - 1]["chars"]
        below = list(level.items())
        depth -= 1
    out += [(node[0][:top], name, top, node[1], None, *node[2:]) for name, node in below]
    return out


_NODE = f"path {_PATH}, name binary, depth int, conv_id long, parent_id long, n_convs long, n_children long, n_leaves long, saved long, ends_sha256 string"


def _peel_small(rows: DataFrame, top: int) -> DataFrame:
    """Nodes of `rows` (`top, path, depth, conv_id, n, ends_sha256`); each task takes some whole subtrees at a time."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(T._parse_datatype_string(_NODE))

    def nodes(held):
        cols = zip(*peel(held, top), strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    def run(batches):
        held, names, last = [], 0, None
        for batch in batches:
            for part in row_slices(batch, 256):
                for of, *row in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    if names >= LIMIT and of != last:
                        yield nodes(held)
                        held, names = [], 0
                    last = of
                    held.append(row)
                    names += row[1]
        if held:
            yield nodes(held)

    dealt = rows.repartition("top").sortWithinPartitions("top").select("top", "path", "depth", "conv_id", "n", "ends_sha256")
    return dealt.mapInArrow(run, _NODE)


def _peel_top(ended: DataFrame, tops: DataFrame, deepest: int) -> list[DataFrame]:
    """A written table of nodes for each depth from `deepest` up to the root: `ended` joined by roots of peeled subtrees."""
    none, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    figures = ["n_convs", "n_children", "n_leaves", "saved"]
    below, nodes = None, []
    for depth in range(deepest, -1, -1):
        level = ended.filter(F.col("depth") == depth).select(
            "path", "conv_id", F.col("n").alias("n_convs"), none.alias("n_children"), none.alias("n_leaves"), none.alias("saved"), "ends_sha256"
        )
        for up in (below, tops.filter(F.col("depth") == depth + 1)):
            if up is not None:
                stripped = F.slice("path", F.lit(1), F.size("path") - 1).alias("path")
                ends = F.lit(None).cast("string").alias("ends_sha256")
                level = level.unionByName(up.select(stripped, "conv_id", "n_convs", one.alias("n_children"), "n_leaves", "saved", ends))
        last = F.coalesce(F.element_at("path", -1)["chars"], none) if depth else none
        below = stored(
            level.groupBy("path")
            .agg(F.min("conv_id").alias("conv_id"), *(F.sum(c).alias(c) for c in figures), F.max("ends_sha256").alias("ends_sha256"))
            .withColumn("n_leaves", F.when(F.col("n_children") == 0, one).otherwise(F.col("n_leaves")))
            .withColumn("saved", F.col("saved") + (F.col("n_convs") - 1) * last)
            .withColumn("depth", F.lit(depth)),
            "nodes",
        )
        nodes.append(below)
    return nodes


def _id_digests(ends: DataFrame) -> DataFrame:
    """`name, ends_sha256` of `name, conv_id`: ids in ascending order (null, as an empty string, last), comma-joined.

    One range-partitioned sort puts all ids in order; runs of ids are joined to strings piece by piece wherever they
    are, and a node's pieces pass through one hash in order, as a stream: nothing holds a node's ids at once.
    """
    order = ["name", F.asc_nulls_last("conv_id")]
    rows = stored(ends.orderBy(*order).withColumn("at", F.monotonically_increasing_id()), "ends")
    piece = F.floor(F.col("at") / PIECE).alias("piece")  # a piece never reaches over two tasks' numbers
    decimals = F.coalesce(F.col("conv_id").cast("string"), F.lit(""))
    joined = F.concat_ws(",", F.transform(F.sort_array(F.collect_list(F.struct("at", decimals.alias("d")))), lambda x: x["d"]))
    pieces = stored(rows.groupBy("name", piece).agg(joined.alias("ids")), "pieces")
    discard(rows)

    def run(batches):
        name, state = None, None
        for batch in batches:
            done = []
            for part in row_slices(batch, 4096):
                for of, ids in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    if state is not None and of == name:
                        state.update(b",")
                    else:
                        if state is not None:
                            done.append((name, state.hexdigest()))
                        name, state = of, hashlib.sha256()
                    state.update(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=["name", "ends_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([state.hexdigest()])], names=["name", "ends_sha256"])

    dealt = pieces.repartition("name").sortWithinPartitions("name", "piece").select("name", "ids")
    return dealt.mapInArrow(run, "name binary, ends_sha256 string")


def trie(convs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row per node of the trie over `conv_id, turns` (array of `role, text`): columns as in `rebuilt_trie`.

    A subtree whose different conversations hold at most `limit` turns is peeled within a task.
    """
    paths = stored(prefix_names(convs), "paths")
    merged = _merged(paths)
    ended, rest = merged.filter("depth = 0"), merged.filter("depth > 0")
    local, top = merged.sparkSession.createDataFrame([], _NODE), 1
    while rest.head(1):
        keyed = rest.withColumn("top", F.get("path", F.lit(top - 1))["name"])
        common = keyed.groupBy("top").agg(F.sum("depth").alias("turns")).filter(F.col("turns") > limit).select("top", F.lit(True).alias("common"))
        marked = keyed.join(stored(common, "common"), "top", "left")
        local = local.unionByName(stored(_peel_small(marked.filter("common is null"), top), "local"))
        large = stored(marked.filter("common").drop("common", "top"), "large")
        ended, rest = ended.unionByName(large.filter(F.col("depth") < 2 * top)), large.filter(F.col("depth") >= 2 * top)
        top *= 2
    roots = local.filter("path is not null")
    deepest = max(ended.agg(F.max("depth")).first()[0] or 0, (roots.agg(F.max("depth")).first()[0] or 1) - 1)
    levels = _peel_top(ended, roots, deepest)
    above = levels[0]
    for level in levels[1:]:
        above = above.unionByName(level)
    root = levels[-1].select("conv_id").first()
    figures = ["conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends_sha256"]
    open_nodes = above.unionByName(roots.select(*above.columns)).withColumn("above", _name("path", 1))
    parents = above.filter("n_children > 0 and depth > 0").select(_name("path", 0).alias("above"), F.col("conv_id").alias("parent_id"))
    deep = open_nodes.filter("depth > 1").join(parents, "above")
    # A node at depth 1 has the root for parent.
    flat = open_nodes.filter("depth <= 1").withColumn("parent_id", F.when(F.col("depth") == 1, F.lit(root.conv_id if root else None).cast("long")))
    out = local.filter("path is null")
    for part in (deep, flat):
        out = out.select("depth", "parent_id", *figures).unionByName(part.select("depth", "parent_id", *figures))
    discard(paths, merged)
    return out.select(
        "conv_id", F.col("depth").cast("long").alias("depth"), F.col("parent_id").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"),
    )


def rebuilt_trie(turns: DataFrame) -> DataFrame:
    """`conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256` per node.

    Null role or text is empty. Rows with equal turns are ordered by role, then text; repeated rows are turns of their
    own; rows without a conv_id are one conversation, whose id is null: it is the smallest member only where there is
    no other, and comes last in `ends_sha256` as an empty string. A conversation that is left without turns ends at
    the root. Other columns are ignored. An empty table has no conversation and gives an empty table.
    """
    return trie(rebuilt(only(turns, conv_id="long", turn="long", role="string", text="string")))
