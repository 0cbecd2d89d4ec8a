"""Exact quantiles, hash trees, lineage levels and observed writes."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from latticeframe.functions import hashes
from latticeframe.operators import checks, sampling
from latticeframe.sources import sinks


@pytest.mark.parametrize("limit", [20, 65_536])
def test_quantiles_of_groups_of_any_size(spark, limit):
    random.seed(2)
    rows = [("hot", random.choice([random.gauss(0, 1), 0.5, round(random.random(), 1)])) for _ in range(3000)]
    rows += [("one", 4.0), ("two", 1.0), ("two", 2.0), ("none", None), ("none", float("nan")), ("same", 7.0), ("same", 7.0), ("same", float("inf")), (None, 3.0), (None, 5.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    at = [0.0, 0.1, 0.5, 0.75, 1.0]
    got = {r.g: r for r in sampling.exact_quantiles(df, ["g"], "x", at, limit=limit, splits=8).collect()}
    for g in {r[0] for r in rows}:
        own = [x for h, x in rows if h == g and x is not None and np.isfinite(x)]
        assert got[g].n == len(own)
        if own:
            assert np.allclose(got[g].q, np.quantile(own, at), atol=1e-12)
        else:
            assert got[g].q is None
    everything = sampling.exact_quantiles(df, [], "x", [0.5], limit=limit).first()
    assert abs(everything.q[0] - np.median([x for _, x in rows if x is not None and np.isfinite(x)])) < 1e-12
    assert sampling.exact_quantiles(df.limit(0), ["g"], "x", [0.5]).count() == 0


def test_hash_tree_depends_on_members_only(spark):
    members = [("a", str(k % 70)) for k in range(300)] + [("b", "x"), ("b", None), ("c", None), (None, "y")]
    df = spark.createDataFrame(members, "g string, m string")

    def tree(texts, fan):
        level = sorted(hashlib.sha256(t.encode()).hexdigest() for t in texts)
        while True:
            level = [hashlib.sha256("".join(level[k : k + fan]).encode()).hexdigest() for k in range(0, max(len(level), 1), fan)]
            if len(level) == 1:
                return level[0]

    for parts in (1, 5):
        got = {r.g: (r.n_members, r.checksum) for r in hashes.tree_checksum(df.repartition(parts), ["g"], "m", 4).collect()}
        for g in ("a", "b", "c", None):
            own = [m for h, m in members if h == g and m is not None]
            assert got[g] == (len(own), tree(own, 4))
    assert hashes.tree_checksum(df.limit(0), ["g"], "m").count() == 0


def test_lineage_of_long_chains_and_cycles(spark):
    n = 9
    own = [(f"p{k:02d}", f"h{k}") for k in range(n)] + [("x", "1"), ("y", "2"), ("z", "3"), ("w", "4")]
    edges = [(f"p{k:02d}", f"p{k - 1:02d}") for k in range(1, n)] + [("p05", "p03"), ("p05", "p03"), ("p02", "unknown"), ("x", "y"), ("y", "x"), ("z", "x"), ("x", "w")]
    o, e = spark.createDataFrame(own, "product string, config_hash string"), spark.createDataFrame(edges, "product string, upstream string")
    got = {r.product: r for r in hashes.lineage(e, o).collect()}
    made, known = {}, dict(own)
    for k in range(n):
        p = f"p{k:02d}"
        ups = sorted(made[u] for u in {u for q, u in edges if q == p} if u in made)
        made[p] = hashlib.sha256((known[p] + "".join(ups)).encode()).hexdigest()
    assert {p: got[p].lineage_hash for p in made} == made and got["p08"].level == 8
    assert got["w"].level == 0 and all(got[p].lineage_hash is None for p in "xyz")
    assert {r.product for r in hashes.lineage_cycles(e).collect()} == {"x", "y"}
    assert hashes.lineage(e, o.limit(0)).count() == 0


def test_published_keys_stay_texts(spark, tmp_path):
    folder = str(tmp_path / "p")
    keys = ["007", "8", "1e3", "2024-01-02", "a/b=c d", "true"]
    for k, key in enumerate(keys):
        sinks.publish(spark.range(k + 1), folder, "01", key, "2024-01-01", checks.none(spark.range(1)))
    got = {(r["product"], r["key"]): r["n"] for r in sinks.published(spark, folder).groupBy("product", "key").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {("01", key): k + 1 for k, key in enumerate(keys)}
    with pytest.raises(ValueError):
        sinks.publish(spark.range(1), folder, "01", "", "run")


def test_of_markers_with_one_time_the_later_counts(spark, tmp_path):
    folder = str(tmp_path / "p")
    for n in (1, 2, 3):
        sinks.publish(spark.range(n), folder, "x", "k", "run")
    same = spark.read.parquet(f"{folder}/markers").withColumn("completed_at", F.timestamp_seconds(F.lit(0))).collect()
    spark.createDataFrame(same, sinks._MARKER).write.mode("overwrite").parquet(f"{folder}/markers")
    assert sinks.published(spark, folder).count() == 3


def test_writes_are_checked_in_the_pass_that_writes(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            calls.add(len(b))
            yield b

    df = spark.range(0, 500, 1, 3).withColumn("x", F.rand()).mapInPandas(counted, "id long, x double")
    again = sinks.publish_once(df, str(tmp_path / "once"), lambda d: checks.none(d), {"in_range": F.col("x").between(0, 1)})
    assert again.count() == 500 and calls.value == 500  # random rows, computed once and verified
    with pytest.raises(sinks.NotPublishable, match="high: [0-9]+ rows"):
        sinks.publish(df, str(tmp_path / "p"), "a", "k", "run", rules={"high": F.col("x") < 0.5})
    assert calls.value == 1000
    seen = sinks.write_observed(spark.range(7), str(tmp_path / "w"), {"null": F.lit(None).cast("boolean")})
    assert seen["n_rows"] == 7 and seen["broken_null"] == 7
