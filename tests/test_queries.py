"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest
from oracle import SF, both

from latticeframe.plans import registry


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, name):
    ours, theirs = both(spark, registry.queries()[name], registry.oracle_sql()[name])
    assert ours == theirs


def test_entry_and_names(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0 and "status" in df.columns
    assert set(e.oracle_sql()) <= set(e.queries())


def test_interval_join_has_no_nested_loop(spark):
    from latticeframe.operators import couple
    from latticeframe.plans import views

    df = couple.interval_join(views.anchors(spark, SF), views.candidates(spark, SF))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_scan_is_pruned_and_filtered(spark):
    from pyspark.sql import functions as F

    df = spark.read.parquet(f"{SF}/orders.parquet").filter("o_orderkey % 10 = 0").select(F.col("o_orderkey"))
    assert "ReadSchema: struct<o_orderkey:bigint>" in df._jdf.queryExecution().executedPlan().toString()
