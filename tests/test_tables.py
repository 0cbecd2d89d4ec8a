"""Scenes, ledgers, inventories, checks, sources and sinks on small hand-made tables."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latticeframe import streaming
from latticeframe.operators import checks, couple, inventory, ledger, sampling, weather_series
from latticeframe.plans import jobs
from latticeframe.sources import scans, sinks

T0 = datetime(2024, 6, 10, 10, 0)


def findings(df):
    return {(r["rule"], r["key"]) for r in df.collect()}


def test_interval_join_edges(spark):
    a = spark.createDataFrame([("a", T0), ("b", None)], "id string, acq timestamp")
    c = spark.createDataFrame([(n, T0 + timedelta(days=d)) for n, d in (("x", 3), ("y", -3), ("z", 3.001), ("w", 0), ("v", -2.5))], "c string, acq timestamp")
    got = couple.interval_join(a, c, 3)
    assert {r.c for r in got.collect()} == {"x", "y", "w", "v"}
    got = couple.interval_join(a, c, 3, cutoff="2024-06-10 12:00:00")
    assert {r.c for r in got.collect()} == {"y", "w", "v"}
    assert couple.interval_join(a.limit(0), c, 3).count() == 0


def test_best_match_rules(spark):
    a = spark.createDataFrame([(k,) for k in "abcde"], "id string")
    rows = [
        ("a", "p", 1.0, 0.8), ("a", "q", 1.0, 0.8),  # tie in score and dt: smaller id
        ("b", "p", 3.0, 0.55), ("b", "q", 0.0, 0.46),  # winner below the threshold, as the maximum decides
        ("c", "p", 1.0, 0.2), ("d", "p", 0.0, None),
    ]
    pairs = spark.createDataFrame(rows, "id string, cand string, dt_days double, clear_frac double")
    got = {r.id: r for r in couple.best_match(a, pairs, "id", "cand", 0.5).collect()}
    assert (got["a"].status, got["a"].cand) == ("coupled", "p")
    assert (got["b"].status, got["b"].cand) == ("coupled", "q")
    assert (got["c"].reason, got["d"].reason, got["e"].reason) == ("none_above_threshold", "none_above_threshold", "no_candidate_in_window")
    strict = {r.id: r for r in couple.best_match(a, pairs, "id", "cand", 0.5, strict=True).collect()}
    assert strict["b"].status == "dropped"


def test_nearest_takes_the_earlier_on_a_tie(spark):
    t = spark.createDataFrame([(1, T0)], "k long, acq timestamp")
    s = spark.createDataFrame([(T0 + timedelta(hours=1), "late"), (T0 - timedelta(hours=1), "early")], "ts timestamp, v string")
    assert couple.nearest_in_time(t, s, "k").first()["v"] == "early"


def test_nearest_per_group_against_brute_force(spark):
    import random

    random.seed(8)
    t = [(k, random.choice("ab"), T0 + timedelta(minutes=random.randint(0, 200))) for k in range(60)] + [(99, "none", T0), (98, "a", None)]
    s = [(random.choice("ab"), T0 + timedelta(minutes=random.randint(0, 200)), i) for i in range(40)]
    got = couple.nearest_in_time(spark.createDataFrame(t, "k long, g string, acq timestamp"), spark.createDataFrame(s, "g string, ts timestamp, v long"), "k", ("g",))
    seen = {r.k: r.ts for r in got.collect()}
    assert len(seen) == len(t)
    for k, g, acq in t:
        own = [ts for h, ts, _ in s if h == g]
        assert seen[k] == (min(own, key=lambda ts: (abs(ts - acq), ts)) if own and acq else None)


BOOK = "item_id string, status string, attempts int, version int, files boolean"


def test_reconcile_every_case(spark):
    rows = [
        ("done", "done", 1, 8, True), ("other", "done", 1, 7, True), ("lost", "done", 1, 8, False), ("again", "failed", 2, 8, False),
        ("spent", "failed", 3, 8, False), ("cut", "exporting", 1, 8, False), ("cut3", "exporting", 3, 8, False), ("wait", "pending", 0, 8, False),
        ("skip", "skipped", 0, 8, False), ("gone", "exhausted", 3, 8, False),
    ]
    book = spark.createDataFrame(rows, BOOK)
    work = spark.createDataFrame([(r[0],) for r in rows] + [("fresh",)], "item_id string")
    got = {r.item_id: r.action for r in ledger.reconcile(work, book, ["item_id"], F.col("n.version") == 8, F.col("n.files")).collect()}
    assert got == {
        "done": "skip", "other": "schema_changed", "lost": "interrupted", "again": "retry", "spent": "exhausted", "cut": "interrupted",
        "cut3": "exhausted", "wait": "new", "skip": "skip", "gone": "skip", "fresh": "new",
    }


def test_reconcile_by_hash(spark):
    rows = [("a", "done", "h", True, True), ("b", "done", "g", True, True), ("c", "done", "h", True, False), ("d", "done", "h", False, False), ("e", "failed", "h", False, False), ("f", "exporting", "h", False, False)]
    book = spark.createDataFrame(rows, "item_id string, status string, config_hash string, out boolean, mark boolean")
    work = spark.createDataFrame([(k,) for k in "abcdefg"], "item_id string")
    got = ledger.reconcile_by_hash(work, book, ["item_id"], F.col("n.config_hash") == "h", F.col("n.out"), F.col("n.mark"))
    assert {r.item_id: r.action for r in got.collect()} == dict(zip("abcdefg", ["skip", "config_changed", "incomplete", "interrupted", "retry", "interrupted", "new"], strict=True))


def test_upsert_attempts_and_idempotency(spark):
    book = spark.createDataFrame([("a", "failed", 998, 1, True), ("b", "done", 2, 1, True)], BOOK)
    rows = spark.createDataFrame([("a", "done", 0, 1, True), ("c", "done", 0, 1, True)], BOOK)
    once = ledger.upsert(book, rows, ["item_id"], "count")
    assert {r.item_id: r.attempts for r in once.collect()} == {"a": 999, "b": 2, "c": 1}
    assert {r.item_id: r.attempts for r in ledger.upsert(once, rows, ["item_id"], "count").collect()}["a"] == 999
    kept = ledger.upsert(book, rows, ["item_id"], "keep")
    again = ledger.upsert(kept, rows, ["item_id"], "keep")
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, again.collect()))
    begun = {r.item_id: (r.status, r.attempts) for r in ledger.upsert(book, rows, ["item_id"], "begin").collect()}
    assert begun["a"] == ("exporting", 999) and begun["c"] == ("exporting", 1)


def test_inventory(spark):
    keys = spark.createDataFrame([("a",), ("b",)], "k string")
    got = inventory.completeness(keys, ["data", "flag"], spark.createDataFrame([("a", "data"), ("a", "flag"), ("b", "flag")], "k string, kind string"), ["k"])
    assert [tuple(r) for r in got.collect()] == [("b", "data")]
    items = spark.createDataFrame([("i1", "h1"), ("i2", "h2")], "item_id string, href string")
    rows = spark.createDataFrame([("i1", "h1"), ("i2", "h1"), ("i3", None)], "scene_id string, item_href string")
    assert {r.scene_id: r["item"] for r in inventory.resolve_items(rows, items).collect()} == {"i1": "i1", "i2": "i2", "i3": None}
    assert inventory.requested(["a", "b"], None) == ["a", "b"]
    with pytest.raises(ValueError):
        inventory.requested(["a"], ["z"])
    have, want = (spark.createDataFrame(x, "member string, sha256 string") for x in ([("a", "1"), ("b", "2")], [("a", "1"), ("b", "3"), ("c", "4")]))
    assert {(r.member, r.problem) for r in inventory.archive_findings(have, want).collect()} == {("b", "changed"), ("c", "missing")}
    book = spark.createDataFrame([("g", "done", "u", "h")], "geometry_id string, status string, output_uri string, config_hash string")
    assert inventory.carry_forward(keys, book, "g").first()["carried_uri"] == "u"
    with pytest.raises(Exception, match="not exactly one"):
        inventory.carry_forward(keys, book, "x").collect()


def greedy(items, seed_order, n):
    cells = {}
    for key, cell, partner in items:
        cells.setdefault(cell, []).append((seed_order[key], key, partner))
    for v in cells.values():
        v.sort()
    out, seen, turn = [], set(), 0
    while len(out) < n and turn < max(map(len, cells.values())):
        for cell in sorted(cells):
            if turn < len(cells[cell]) and cells[cell][turn][2] not in seen and len(out) < n:
                out.append(cells[cell][turn][1])
                seen.add(cells[cell][turn][2])
        turn += 1
    return out


def test_stratified_sample_is_the_greedy_loop(spark):
    import random

    random.seed(3)
    items = [(k, f"c{random.randint(0, 4)}", random.randint(0, 25)) for k in range(120)]
    df = spark.createDataFrame(items, "k long, cell string, partner long")
    order = {r.k: r.h for r in df.select("k", F.sha2(F.concat(F.lit("7:"), F.col("k").cast("string")), 256).alias("h")).collect()}
    for n in (5, 17, 200):
        got = [r.k for r in sampling.stratified_sample(df, ["cell"], "k", "partner", 7, n).orderBy("turn", "cell", "k").collect()]
        assert got == greedy(items, order, n)


def manifest(spark, **change):
    base = {"scene_id": "LC08_1", "source": "landsat-c2-l2", "role": "anchor", "platform": "landsat-8", "aoi_clear_frac": 0.5, "item_href": "x"}
    rows = [base | change, {"scene_id": "S2_1", "source": "sentinel-2-l2a", "role": "predictor", "platform": "s2", "aoi_clear_frac": 0.6, "item_href": "y"}]
    rows += [{"scene_id": g, "source": "ecostress", "role": "validation", "platform": "iss", "aoi_clear_frac": None, "item_href": None} for g in checks.GRANULES]
    schema = "scene_id string, source string, role string, platform string, aoi_clear_frac double, item_href string"
    return spark.createDataFrame([tuple(r[k] for k in base) for r in rows], schema)


@pytest.mark.parametrize(
    "change,rule",
    [
        ({}, None), ({"platform": "landsat-7"}, "platform_unknown"), ({"aoi_clear_frac": 0.04}, "clear_fraction_low"), ({"aoi_clear_frac": float("nan")}, "clear_fraction_missing"),
        ({"item_href": " "}, "href_missing"), ({"role": "x"}, "role_unknown"), ({"source": "x"}, "source_unknown"),
    ],
)
def test_manifest_rules(spark, change, rule):
    got = {r for r, _ in findings(checks.manifest_findings(manifest(spark, **change)))}
    assert got == (set() if rule is None else {rule})


def test_manifest_sets(spark):
    m = manifest(spark)
    assert {r for r, _ in findings(checks.manifest_findings(m.union(m)))} == {"duplicate_key"}
    assert {r for r, _ in findings(checks.manifest_findings(m.filter("source <> 'ecostress'")))} == {"granule_missing"}
    assert "manifest_empty" in {r for r, _ in findings(checks.manifest_findings(m.limit(0)))}


def pairings(spark, **change):
    base = {"landsat_scene_id": "LC08_1", "sentinel2_scene_id": "S2_1", "landsat_clear_px": 5000, "joint_clear_px": 4000, "joint_clear_frac": 0.8}
    schema = "landsat_scene_id string, sentinel2_scene_id string, landsat_clear_px long, joint_clear_px long, joint_clear_frac float"
    return spark.createDataFrame([tuple((base | change)[k] for k in base)], schema)


@pytest.mark.parametrize(
    "change,rules",
    [
        ({}, set()), ({"joint_clear_frac": 0.81}, {"fraction_mismatch"}), ({"joint_clear_px": 6000}, {"joint_count"}), ({"landsat_clear_px": 0}, {"clear_count"}),
        ({"sentinel2_scene_id": "z"}, {"predictor_unknown"}), ({"landsat_scene_id": "z"}, {"anchor_unknown", "warning_anchor_unpaired"}),
    ],
)
def test_pairing_rules(spark, change, rules):
    assert {r for r, _ in findings(checks.pairing_findings(pairings(spark, **change), manifest(spark)))} == rules


def test_mapping_and_ledger_rules(spark):
    m = spark.createDataFrame([(2017, 2017, "g"), (2018, 2021, "g"), (2020, 2017, "")], "year int, vintage int, geometry_id string")
    got = findings(checks.mapping_findings(m, (2017, 2020), [(2017, 2017, 2020), (2021, 2021, 2021)]))
    assert got == {("year_uncovered", "2019"), ("vintage_after_year", "2018"), ("year_outside_vintage", "2018"), ("geometry_missing", "2020")}
    book = spark.createDataFrame([("s", "a", "done", "x"), ("s", "b", "failed", None)], "source string, item_id string, status string, role string")
    assert findings(checks.ledger_findings(book, {"s": 2, "t": 1}, "x")) == {("row_count", "t"), ("not_done", "s/b"), ("role", "s/b")}


def test_strict_table_and_sinks(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    path = str(tmp_path / "t.parquet")
    assert scans.strict_table(spark, path, schema).count() == 0
    df = spark.createDataFrame([(1, "x")], schema)
    sinks.publish_once(df, path, lambda d: checks.none(d))
    assert scans.strict_table(spark, path, schema).count() == 1
    with pytest.raises(scans.SchemaMismatch):
        scans.strict_table(spark, path, T.StructType([T.StructField("a", T.StringType())]))
    with pytest.raises(Exception, match="(?i)exists"):
        sinks.publish_once(df, path, lambda d: checks.none(d))
    assert {r.rule for r in checks.schema_findings(df.withColumn("c", F.lit(1)).drop("a"), schema).collect()} == {"column_missing", "column_extra"}


def test_readers_trust_marked_products_only(spark, tmp_path):
    folder = str(tmp_path / "p")
    df = spark.createDataFrame([(1,)], "v int")
    sinks.publish(df, folder, "svf", "one", "run", checks.none(df))
    with pytest.raises(sinks.NotPublishable):
        sinks.publish(df, folder, "svf", "two", "run", checks.when(df, "bad", F.lit(True), F.lit("k")))
    assert {r.key for r in sinks.published(spark, folder).collect()} == {"one"}
    sinks.publish(df, folder, "svf", "two", "run", checks.none(df))
    assert {r.key for r in sinks.published(spark, folder).collect()} == {"one", "two"}
    worse = df.limit(1)
    with pytest.raises(sinks.NotPublishable):
        sinks.publish(worse, folder, "svf", "two", "run", checks.when(worse, "bad", F.lit(True), F.lit("k")))
    assert sinks.published(spark, folder).filter("key = 'two'").count() == df.count()
    sinks.publish(worse, folder, "svf", "two", "run", checks.none(df))
    assert sinks.published(spark, folder).filter("key = 'two'").count() == 1


def test_twin_points_listing_granules(spark, tmp_path):
    df = spark.createDataFrame([("s", {"a": 1})], "scene_id string, histogram map<string,long>")
    sinks.write_table_with_twin(df, str(tmp_path / "r"))
    twin = scans.csv_twin(spark, str(tmp_path / "r.csv"), T._parse_datatype_string("scene_id string, histogram string"))
    assert twin.first()["histogram"] == '{"a":1}'
    assert scans.forbidden(scans.listing(spark, str(tmp_path)), [".CSV"]).count() >= 1
    pts = spark.createDataFrame([("t", x + 0.5, y + 0.5, 1.0, 0.0, 0.0) for x in range(3) for y in range(3)] + [("u", float(2 * x), 0.5, 1.0, 0.0, 0.0) for x in range(3)], "tile string, x double, y double, z double, ox double, oy double")
    assert {k for r, k in findings(scans.point_findings(pts, ["tile"], "ox", "oy")) if r == "spacing"} == {"u"}
    ids = spark.createDataFrame([(checks.GRANULES[0],), ("nonsense",)], "granule_id string")
    good, bad = scans.granules(ids)
    assert good.first()["acq"] == datetime(2018, 8, 25, 8, 20, 58) and good.first()["tile"] == "009"[:0] + good.first()["granule_id"].split("_")[5]
    assert bad.count() == 1


def test_hourly_series(spark):
    day = datetime(2024, 1, 31)
    rows = [("c", day + timedelta(hours=h), float(h)) for h in range(1, 25)] + [("c", day + timedelta(hours=25), 7.0), ("c", day + timedelta(hours=26), 6.0)]
    s = spark.createDataFrame(rows, "cell string, ts timestamp, tp double")
    got = {r.ts: r.h for r in weather_series.hourly(s, ["cell"], "tp", "h", clamp=True).collect()}
    assert got[day + timedelta(hours=1)] == 1.0 and got[day + timedelta(hours=24)] == 1.0
    assert got[day + timedelta(hours=25)] == 7.0 and got[day + timedelta(hours=26)] == 0.0
    assert findings(weather_series.series_findings(s.union(s.limit(1)), ["cell"]).withColumnRenamed("detail", "key")) >= {("variable_missing", "t2m")}


def test_rain_windows(spark):
    t = spark.createDataFrame([("s", "c", T0), ("n", "none", T0)], "scene_id string, cell string, acq timestamp")
    s = spark.createDataFrame([("c", T0 - timedelta(hours=h), 1.0, 0.001) for h in range(0, 80)], "cell string, ts timestamp, r double, p double")
    got = {r.scene_id: r for r in weather_series.at_targets(t, s, "scene_id", ["cell"], "r", "p").collect()}
    assert [round(got["s"][f"p_{a}_{a + 24}h"], 9) for a in (0, 24, 48)] == [24.0, 24.0, 24.0] and got["s"].n_hours == 72
    assert got["n"].p_0_24h == 0.0 and got["n"].r_antecedent_mean is None


def test_couple_job(spark):
    a = spark.createDataFrame([("LC08_1", T0, "x", 0.5), ("LC09_2", T0, "x", 0.01)], "scene_id string, acq timestamp, item_href string, clear_frac double")
    c = spark.createDataFrame([("S2_1", T0 + timedelta(hours=1), "y", "s2", 0.8, 5000, 4000)], "scene_id string, acq timestamp, item_href string, platform string, clear_frac double, landsat_clear_px long, joint_clear_px long")
    v = manifest(spark).filter("source = 'ecostress'").withColumns({"acquisition_datetime": F.lit(T0), "year": F.lit(2018)}).drop("role")
    made = jobs.couple_scenes(a, c, v, 0.1)
    assert made.findings.count() == 0
    assert made.pairings.first()["dt_seconds"] == 3600 and made.manifest.count() == 8
    assert [tuple(r) for r in made.dropped.collect()] == [("LC09_2", "below_clear_gate")]


def test_stream_keeps_the_latest(spark, tmp_path):
    source, state = str(tmp_path / "in"), str(tmp_path / "ledger")
    schema = "item_id string, status string, updated_at timestamp"

    def put(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)

    def step():
        q = (
            spark.readStream.schema(schema).parquet(source).writeStream.foreachBatch(streaming.merge_into(state, ["item_id"], ["updated_at"]))
            .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        )
        q.awaitTermination(120)

    assert streaming.current(spark, state) is None
    put([("a", "pending", T0), ("b", "done", T0)])
    step()
    put([("a", "done", T0 + timedelta(hours=1)), ("b", "failed", T0 - timedelta(hours=1))])
    step()
    assert {r.item_id: r.status for r in streaming.current(spark, state).collect()} == {"a": "done", "b": "done"}


def test_stream_buckets_repeat_and_restart(spark, tmp_path):
    state = str(tmp_path / "state")
    run = streaming.merge_into(state, ["item_id"], ["updated_at"], buckets=4)
    rows = lambda status, hours, ids: spark.createDataFrame(
        [(f"k{i}", status, T0 + timedelta(hours=hours)) for i in ids], "item_id string, status string, updated_at timestamp"
    )
    run(rows("pending", 0, range(40)), 0)
    before = streaming._folders(spark, state)
    for batch_id in (1, 1, 0):  # run again after a failure, then from a stream that starts anew
        run(rows("done", 1, [7]), batch_id)
    run(rows("done", 1, []), 2)
    got = {r.item_id: r.status for r in streaming.current(spark, state).collect()}
    assert got == {f"k{i}": "done" if i == 7 else "pending" for i in range(40)}
    after = streaming._folders(spark, state)
    assert sum(before[b] != after[b] for b in before) == 1
    with pytest.raises(ValueError):
        streaming.merge_into(state, ["item_id"], ["updated_at"], buckets=8)(rows("done", 2, [1]), 3)


def test_as_of_knows_all_versions(spark):
    rows = spark.range(3000).select(F.col("id").alias("year"))
    twice = spark.range(2000).select((F.col("id") % 1000).cast("int").alias("version"))
    got = inventory.as_of(rows, twice, "year", "version")
    assert got.filter("version = least(year, 999)").count() == 3000
    more = inventory.as_of(rows, spark.range(1001).select(F.col("id").alias("version")), "year", "version")
    assert more.filter("version = least(year, 1000)").count() == 3000


def test_stream_compaction_keeps_the_state(spark, tmp_path):
    state = str(tmp_path / "ledger")
    rows = lambda status, n, items: spark.createDataFrame([(i, status, T0 + timedelta(minutes=n)) for i in items], "item_id int, status string, updated_at timestamp")
    run = streaming.merge_into(state, ["item_id"], ["updated_at"], buckets=2, compact_every=3, grace=0)
    assert streaming.compact(spark, state, 0) == (0, 0)
    told = lambda: {(r.item_id, r.status) for r in streaming.current(spark, state).collect()}
    files = lambda: (len(list((tmp_path / "ledger-pointer").glob("*.parquet"))), len(list((tmp_path / "ledger").glob("run=*"))))
    for n in range(2):
        run(rows(f"s{n}", n, range(6)), n)
    assert files() == (2, 2)
    assert streaming.compact(spark, state, 3600) == (0, 0)  # readers may still be on them
    run(rows("s2", 2, range(6)), 2)
    assert files() == (1, 1) and told() == {(i, "s2") for i in range(6)}
    # A folder of a lost batch goes, and later batches go on from the compacted pointer
    rows("lost", 9, [1]).write.parquet(f"{state}/run=lost")
    run(rows("s3", 3, [0, 1]), 3)
    pointers, folders = streaming.compact(spark, state, 0)
    assert pointers == 2 and folders >= 1 and not (tmp_path / "ledger" / "run=lost").exists()
    assert told() == {(i, "s3" if i < 2 else "s2") for i in range(6)}
