from __future__ import annotations

import math
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from latticeframe.functions import bits, contracts, hashes, labels, lattice, nulls, solar, spectral, weather

NAN = float("nan")


def one(spark, column, **values):
    row = {k: v for k, v in values.items()}
    kinds = {int: "long", float: "double", str: "string", bool: "boolean", datetime: "timestamp", type(None): "double"}
    schema = ", ".join(f"{k} {kinds[type(v)]}" for k, v in row.items())
    return spark.createDataFrame([tuple(row.values())], schema).select(column.alias("x")).first()["x"]


def test_nulls(spark):
    assert one(spark, nulls.value("a"), a=NAN) is None
    assert one(spark, nulls.value("a"), a=2.0) == 2.0
    assert one(spark, nulls.finite("a"), a=float("inf")) is False
    assert one(spark, nulls.finite("a"), a=None) is False
    assert math.isnan(one(spark, nulls.layer(F.col("a")), a=None))
    df = spark.createDataFrame([(NAN,), (None,)], "a double")
    assert df.agg(nulls.nansum(F.col("a")).alias("s")).first()["s"] == 0.0


@pytest.mark.parametrize(
    "qa,clear", [(0, True), (1, False), (4, False), (16, False), (8, True), (8 | 512, False), (8 | 256, True), (64, True), (192, True), (2, True)]
)
def test_thermal_clear(spark, qa, clear):
    assert one(spark, bits.thermal_clear(F.col("q")), q=qa) is clear


def test_flags(spark):
    assert one(spark, bits.thermal_flag(F.col("q"), F.col("d"), F.lit(False)), q=8 | 512 | 16, d=5.0) == bits.CLOUDY | bits.SHADOW
    assert one(spark, bits.thermal_flag(F.col("q"), F.col("d"), F.lit(False)), q=0, d=0.0) == bits.FILL
    assert one(spark, bits.thermal_flag(F.col("q"), F.col("d"), F.lit(True)), q=0, d=7.0) == bits.FILL
    want = {0: 1, 1: 16, 2: 0, 3: 4, 4: 0, 7: 0, 8: 2, 9: 2, 10: 8, 11: 32}
    for scl, flag in want.items():
        assert one(spark, bits.class_flag(F.col("s")), s=scl) == flag
    flag = bits.granule_flag(F.col("c"), F.col("w"), F.col("q"), F.col("t"))
    assert one(spark, flag, c=0, w=0, q=0, t=NAN) == bits.FILL
    assert one(spark, flag, c=1, w=0, q=1, t=300.0) == bits.CLOUDY
    assert one(spark, flag, c=0, w=1, q=3, t=300.0) == bits.FILL
    assert one(spark, bits.whole_class(F.col("s")), s=2.5) == 2
    assert one(spark, bits.whole_class(F.col("s")), s=NAN) == 0
    assert one(spark, bits.reflectance(F.col("d"), F.col("f"), False), d=12000, f=2) == 1.0
    assert one(spark, bits.reflectance(F.col("d"), F.col("f"), True), d=12000, f=2) is None
    assert one(spark, bits.residual_hint(F.col("q")), q=2) is True


def test_spectral(spark):
    assert one(spark, spectral.normalised_difference("a", "b"), a=1.0, b=-1.0) is None
    assert one(spark, spectral.normalised_difference("a", "b"), a=NAN, b=1.0) is None
    assert one(spark, spectral.surface(F.col("t"), F.col("h")), t=5.0, h=NAN) == 5.0
    assert one(spark, spectral.surface(F.col("t"), F.col("h")), t=5.0, h=-1.0) == 5.0
    assert one(spark, spectral.highest(F.col("a"), F.col("b")), a=NAN, b=3.0) == 3.0
    for code, want in {0: 0, 5: 5, 95: 95, 10: 100, 96: 100, 254: 100, 255: None}.items():
        assert one(spark, spectral.imperviousness(F.col("c")), c=code) == want
    assert one(spark, spectral.risk(F.col("a"), F.col("b"), F.col("c")), a=0.5, b=NAN, c=float("inf")) == 0.5
    assert one(spark, spectral.metres_of_decimetres(F.col("a")), a=NAN) == 0.0


def test_weather(spark):
    assert one(spark, weather.vapour_pressure_deficit(F.col("t"), F.col("d")), t=290.0, d=295.0) == 0.0
    t = one(spark, weather.nearest_hour(F.col("t")), t=datetime(2024, 1, 31, 23, 30))
    assert t == datetime(2024, 2, 1, 0, 0)
    assert one(spark, weather.nearest_hour(F.col("t")), t=datetime(2024, 1, 31, 23, 29, 59)) == datetime(2024, 1, 31, 23)


def test_sun_is_high_in_the_south_at_noon(spark):
    az, el = solar.solar_position(F.col("t"), 52.51, 13.42)
    noon = datetime(2024, 6, 21, 11, 8)
    assert abs(one(spark, az, t=noon) - 180) < 4
    assert abs(one(spark, el, t=noon) - (90 - 52.51 + 23.44)) < 0.5
    assert one(spark, el, t=datetime(2024, 6, 21, 23, 8)) < 0


def test_lattice(spark):
    g = lattice.GridSpec(0, 1000, 10, 37, 53)
    assert one(spark, g.row(F.col("y")), y=1000.0) == 0 and one(spark, g.row(F.col("y")), y=1000.1) == -1
    assert one(spark, lattice.parent(F.col("r"), 10), r=-7) == -1
    assert [one(spark, lattice.present(F.col("b"), 10, 37), b=b) for b in (0, 3)] == [10, 7]
    assert lattice.tiles(37, 10)[-1] == (30, 7)
    assert (g.coarser(10).rows, g.coarser(10).cols) == (4, 6)
    assert g.snapped_window(101, 899, 199, 950) == (0, 10, 20, 10)


def test_labels(spark):
    want = {0.0: "0.00-0.25", 0.25: "0.25-0.50", 0.9: "0.90-0.99", 0.99: "0.99-1.00", 1.0: "1.00", 1.5: None}
    for x, label in want.items():
        assert one(spark, labels.support_bin(F.col("x")), x=x) == label
    assert one(spark, labels.cloudiness(F.col("x")), x=None) == "low"
    assert one(spark, labels.platform(F.col("x")), x="LC09_L2SP") == "landsat-9"


def test_fingerprints(spark):
    assert hashes.config_fingerprint({"b": 1, "a": [2]}) == hashes.config_fingerprint({"a": [2], "b": 1})
    a = spark.range(100).repartition(7)
    assert hashes.table_fingerprint(a).first() == hashes.table_fingerprint(spark.range(100)).first()
    assert hashes.table_fingerprint(a).first() != hashes.table_fingerprint(spark.range(101)).first()
    own = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3"), ("z", "9")], "product string, config_hash string")
    edges = spark.createDataFrame([("b", "a"), ("c", "b")], "product string, upstream string")
    before = {r.product: r.lineage_hash for r in hashes.lineage(edges, own).collect()}
    changed = own.replace("1", "x", "config_hash")
    after = {r.product: r.lineage_hash for r in hashes.lineage(edges, changed).collect()}
    assert {p for p in before if before[p] != after[p]} == {"a", "b", "c"}


def test_contracts(spark):
    assert len(contracts.CHANNELS) == 24
    two = [contracts.LayerContract("a", 0, 1), contracts.LayerContract("b", 0, 1, codes=(0, 1))]
    df = spark.createDataFrame([(1, 0.5, 1.0), (2, NAN, 1.0), (3, 0.5, 0.5), (4, 1.0, None)], "k long, a double, b double")
    out = {r.k: r for r in contracts.masked_stack(df, two, ["k"]).collect()}
    assert [out[k].feature_valid for k in (1, 2, 3, 4)] == [1, 0, 0, 0]
    assert np.isnan(out[3].a) and out[1].a == 0.5
    with pytest.raises(ValueError):
        contracts.enforce(df.drop("b"), two, ["k"])
    present = spark.createDataFrame([("s", "a"), ("s", "x")], "scene_id string, layer string")
    assert {(r.layer, r.problem) for r in contracts.roster_findings(present, two).collect()} == {("b", "missing"), ("x", "extra")}
