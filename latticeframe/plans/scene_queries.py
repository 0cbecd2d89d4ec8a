"""Queries on scenes, ledgers and inventories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from latticeframe.functions import hashes, labels
from latticeframe.operators import asof, checks, couple, inventory, ledger, sampling
from latticeframe.plans import views as v
from latticeframe.plans.registry import query
from latticeframe.sources import scans

THRESHOLD = 0.95

_MATCHED = f"""WITH {v.ANCHORS}, {v.CANDIDATES}, pairs AS (
  SELECT a.anchor_id, c.cand_id, c.acq AS cand_acq, c.clear_frac, abs(epoch_us(c.acq) - epoch_us(a.acq)) / 86400e6 AS dt_days
  FROM anchors a JOIN cand c ON abs(epoch_us(c.acq) - epoch_us(a.acq)) / 86400e6 <= 3 + 1e-6
), scored AS (SELECT *, clear_frac - 0.1 * dt_days / 3 AS score FROM pairs),
top AS (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, dt_days, cand_id) AS rn,
  max(clear_frac) OVER (PARTITION BY anchor_id) AS most FROM scored),
matched AS (SELECT a.anchor_id, CASE WHEN t.most >= {THRESHOLD} THEN 'coupled' ELSE 'dropped' END AS status,
  CASE WHEN t.most IS NULL THEN 'no_candidate_in_window' WHEN t.most < {THRESHOLD} THEN 'none_above_threshold' END AS reason,
  round(coalesce(t.most, 0), 6) AS max_clear_frac, CASE WHEN t.most >= {THRESHOLD} THEN t.cand_id END AS cand_id,
  CASE WHEN t.most >= {THRESHOLD} THEN round(t.dt_days, 6) END AS dt_days, CASE WHEN t.most >= {THRESHOLD} THEN round(t.score, 6) END AS score
  FROM anchors a LEFT JOIN top t ON a.anchor_id = t.anchor_id AND t.rn = 1)
"""


def _coupled(spark: SparkSession, d: str) -> DataFrame:
    return couple.best_by_time(v.anchors(spark, d), v.candidates(spark, d), "anchor_id", "cand_id", THRESHOLD)


@query(_MATCHED + "SELECT anchor_id, status, reason, max_clear_frac, cand_id, dt_days, score FROM matched")
def couple_best_match(spark: SparkSession, d: str) -> DataFrame:
    """JN-01, JN-02, WN-01."""
    out = _coupled(spark, d)
    return out.select(
        "anchor_id", "status", "reason", F.round("max_clear_frac", 6).alias("max_clear_frac"), "cand_id",
        F.round("dt_days", 6).alias("dt_days"), F.round("score", 6).alias("score"),
    )


@query(_MATCHED + "SELECT reason, count(*) AS n FROM matched WHERE reason IS NOT NULL GROUP BY 1")
def couple_drop_reasons(spark: SparkSession, d: str) -> DataFrame:
    """AG-06."""
    return inventory.reason_counts(_coupled(spark, d))


@query(_MATCHED + "SELECT count(*) AS total, count(*) FILTER (status = 'coupled') AS succeeded, count(*) FILTER (status <> 'coupled') AS failed, round(avg(CASE WHEN status = 'coupled' THEN 1e0 ELSE 0e0 END), 6) AS rate FROM matched")
def couple_tally(spark: SparkSession, d: str) -> DataFrame:
    """AG-28."""
    return ledger.run_tally(_coupled(spark, d))


@query(_MATCHED + "SELECT cand_id, min(anchor_id) AS anchor_id FROM (SELECT cand_id, anchor_id, row_number() OVER (PARTITION BY cand_id ORDER BY m.acq, anchor_id) AS rn FROM (SELECT matched.*, anchors.acq FROM matched JOIN anchors USING (anchor_id)) m WHERE status = 'coupled') WHERE rn = 1 GROUP BY 1")
def first_partner(spark: SparkSession, d: str) -> DataFrame:
    """WN-06."""
    pairs = _coupled(spark, d).filter("status = 'coupled'")
    return couple.first_partner(pairs, "cand_id", "acq", "anchor_id").select("cand_id", "anchor_id")


@query("""SELECT 'child_unknown' AS rule, l_orderkey AS key FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F')
UNION ALL SELECT 'parent_unpaired', o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def pairing_fk_findings(spark: SparkSession, d: str) -> DataFrame:
    """JN-03, JN-04: order lines as pairings, orders as the manifest."""
    lines, orders = v.table(spark, d, "lineitem"), v.table(spark, d, "orders")
    lost = inventory.orphans(lines, orders.filter("o_orderstatus <> 'F'"), "l_orderkey", "o_orderkey")
    bare = inventory.orphans(orders, lines, "o_orderkey", "l_orderkey")
    return lost.select(F.lit("child_unknown").alias("rule"), F.col("l_orderkey").alias("key")).union(
        bare.select(F.lit("parent_unpaired").alias("rule"), F.col("o_orderkey").alias("key"))
    )


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    """AG-26."""
    return inventory.duplicate_keys(v.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""SELECT coalesce(a.k, b.k) AS custkey, CASE WHEN a.k IS NULL THEN 'right' ELSE 'left' END AS side
FROM (SELECT DISTINCT o_custkey AS k FROM orders) a FULL JOIN (SELECT DISTINCT c_custkey AS k FROM customer WHERE c_custkey % 3 = 0) b ON a.k = b.k
WHERE a.k IS NULL OR b.k IS NULL""")
def key_set_diff(spark: SparkSession, d: str) -> DataFrame:
    """JN-10, SET-03."""
    a = v.table(spark, d, "orders").select(F.col("o_custkey").alias("custkey"))
    b = v.table(spark, d, "customer").filter("c_custkey % 3 = 0").select(F.col("c_custkey").alias("custkey"))
    return inventory.key_difference(a, b, ["custkey"])


@query(f"WITH {v.LEDGER_LOG}, {v.LATEST} SELECT item_id, status, attempts, config_hash, event_id FROM latest")
def ledger_latest(spark: SparkSession, d: str) -> DataFrame:
    """WN-07."""
    log = v.ledger_log(spark, d)
    return ledger.latest(log, ["item_id"], ["updated_at", "event_id"]).select("item_id", "status", "attempts", "config_hash", "event_id")


def _latest(spark: SparkSession, d: str) -> DataFrame:
    return ledger.latest(v.ledger_log(spark, d), ["item_id"], ["updated_at", "event_id"])


_PIVOT = ", ".join(f"count(*) FILTER (status = '{s}') AS {s}" for s in ledger.ARD_STATES)


@query(f"WITH {v.LEDGER_LOG} SELECT source, {_PIVOT}, count(*) AS total FROM ledger_log GROUP BY 1")
def ledger_status_pivot(spark: SparkSession, d: str) -> DataFrame:
    """AG-04, AG-25."""
    return ledger.status_counts(v.ledger_log(spark, d), "source")


@query(f"""WITH {v.LEDGER_LOG}, {v.LATEST}, t AS (SELECT *, attempts / 4e0 AS clear, event_id % 7 <> 0 AS here FROM latest)
SELECT source, count(*) AS total, {_PIVOT}, count(*) FILTER (status = 'done' AND here) AS artifacts_exist,
  count(*) FILTER (status = 'done' AND NOT here) AS artifacts_missing, round(avg(clear) FILTER (status = 'done'), 6) AS clear_mean,
  min(clear) FILTER (status = 'done') AS clear_min, max(clear) FILTER (status = 'done') AS clear_max,
  count(*) FILTER (status IN ('failed', 'exhausted')) + count(*) FILTER (status = 'done' AND NOT here) AS failed_total,
  count(*) FILTER (status IN ('failed', 'exhausted')) + count(*) FILTER (status = 'done' AND NOT here) = 0 AS success
FROM t GROUP BY 1""")
def ledger_qa_report(spark: SparkSession, d: str) -> DataFrame:
    """AG-05."""
    told = ledger.qa_report(_latest(spark, d), "source", F.col("event_id") % 7 != 0, F.col("attempts") / F.lit(4.0))
    return told.withColumn("clear_mean", F.round("clear_mean", 6))


_WORK = "work AS (SELECT c_custkey AS item_id FROM customer)"


def _work(spark: SparkSession, d: str) -> DataFrame:
    return v.table(spark, d, "customer").select(F.col("c_custkey").alias("item_id"))


@query(f"""WITH {v.LEDGER_LOG}, {v.LATEST}, {_WORK} SELECT w.item_id, CASE
  WHEN status IS NULL OR status = 'pending' THEN 'new' WHEN status = 'done' AND event_id % 2 <> 0 THEN 'schema_changed'
  WHEN status = 'done' THEN CASE WHEN event_id % 3 <> 0 THEN 'skip' ELSE 'interrupted' END
  WHEN status = 'failed' THEN CASE WHEN attempts >= 3 THEN 'exhausted' ELSE 'retry' END
  WHEN status = 'exporting' THEN CASE WHEN attempts >= 3 THEN 'exhausted' ELSE 'interrupted' END ELSE 'skip' END AS action
FROM work w LEFT JOIN latest l ON w.item_id = l.item_id""")
def reconcile_worklist(spark: SparkSession, d: str) -> DataFrame:
    """JN-07."""
    e = F.col("n.event_id")
    return ledger.reconcile(_work(spark, d), _latest(spark, d), ["item_id"], e % 2 == 0, e % 3 != 0)


@query(f"""WITH {v.LEDGER_LOG}, {v.LATEST}, {_WORK} SELECT w.item_id, CASE
  WHEN status IS NULL OR status = 'pending' THEN 'new' WHEN status = 'done' AND config_hash <> 'h0' THEN 'config_changed'
  WHEN status = 'done' AND event_id % 2 = 0 AND event_id % 5 <> 0 THEN 'skip' WHEN status = 'done' AND event_id % 2 = 0 THEN 'incomplete'
  WHEN status IN ('done', 'exporting') THEN 'interrupted' WHEN status = 'failed' THEN 'retry' ELSE 'skip' END AS action
FROM work w LEFT JOIN latest l ON w.item_id = l.item_id""")
def reconcile_by_hash(spark: SparkSession, d: str) -> DataFrame:
    """JN-08."""
    e = F.col("n.event_id")
    return ledger.reconcile_by_hash(_work(spark, d), _latest(spark, d), ["item_id"], F.col("n.config_hash") == "h0", e % 2 == 0, e % 5 != 0)


@query(f"""WITH {v.LEDGER_LOG}, {v.LATEST}, new_rows AS (SELECT c_custkey AS item_id FROM customer WHERE c_custkey % 2 = 0)
SELECT item_id, status, attempts FROM latest WHERE item_id NOT IN (SELECT item_id FROM new_rows)
UNION ALL SELECT n.item_id, 'exporting', coalesce(l.attempts, 0) + 1 FROM new_rows n LEFT JOIN latest l ON n.item_id = l.item_id""")
def ledger_begin_attempt(spark: SparkSession, d: str) -> DataFrame:
    """SET-02, LED-01."""
    book = _latest(spark, d).select("item_id", "status", "attempts")
    rows = _work(spark, d).filter("item_id % 2 = 0").withColumns({"status": F.lit("pending"), "attempts": F.lit(0)})
    return ledger.upsert(book, rows, ["item_id"], "begin")


@query(f"""WITH {v.LEDGER_LOG}, {v.LATEST}, new_rows AS (SELECT c_custkey AS item_id FROM customer WHERE c_custkey % 2 = 0)
SELECT item_id, status, attempts FROM latest WHERE item_id NOT IN (SELECT item_id FROM new_rows)
UNION ALL SELECT n.item_id, 'done', least(coalesce(l.attempts, 0) + 1, 999) FROM new_rows n LEFT JOIN latest l ON n.item_id = l.item_id""")
def ledger_count_attempts(spark: SparkSession, d: str) -> DataFrame:
    """LED-03."""
    book = _latest(spark, d).select("item_id", "status", "attempts")
    rows = _work(spark, d).filter("item_id % 2 = 0").withColumns({"status": F.lit("done"), "attempts": F.lit(0)})
    return ledger.upsert(book, rows, ["item_id"], "count")


@query(f"WITH {v.LEDGER_LOG}, {v.LATEST}, {_WORK} SELECT item_id FROM work WHERE item_id NOT IN (SELECT item_id FROM latest WHERE status = 'done')")
def resume_worklist(spark: SparkSession, d: str) -> DataFrame:
    """SET-04."""
    return ledger.resume(_work(spark, d), _latest(spark, d).filter("status = 'done'"), ["item_id"])


_RANGES = "ranges(vintage, lo, hi) AS (VALUES (2017, 1995, 1996), (2021, 1997, 1997), (2022, 1998, 1999), (2024, 2000, 2001))"


def _ranges(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(2017, 1995, 1996), (2021, 1997, 1997), (2022, 1998, 1999), (2024, 2000, 2001)], "vintage int, lo int, hi int")


@query(f"""WITH {_RANGES}, o AS (SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year FROM orders)
SELECT o_orderkey, year, vintage, 'dgm1-2021__lod2-' || vintage || '__vh-2020' AS geometry_id, CASE WHEN year >= 2000 THEN 2000 WHEN year >= 1996 THEN 1996 END AS version
FROM o LEFT JOIN ranges r ON o.year BETWEEN r.lo AND r.hi""")
def vintage_asof(spark: SparkSession, d: str) -> DataFrame:
    """JN-06: range lookup and as-of lookup."""
    o = v.table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    versions = spark.createDataFrame([(1996,), (2000,)], "version int")
    out = inventory.as_of(inventory.in_range(o, _ranges(spark), "year"), versions, "year", "version")
    return out.select("o_orderkey", "year", "vintage", labels.geometry_id(F.col("vintage")).alias("geometry_id"), "version")


_INVENTORY = f"""WITH {v.LEDGER_LOG}, {v.LATEST}, {_RANGES}, scenes AS (SELECT o_orderkey AS scene_id, o_custkey AS item_id, CAST(year(o_orderdate) AS INT) AS year FROM orders),
t AS (SELECT s.*, l.status, l.source, r.vintage, CASE WHEN year >= 2001 THEN 'inference year' WHEN status IS NULL THEN 'no ledger row'
  WHEN status <> 'done' AND source = 'src0' THEN 'first source not done' WHEN vintage IS NULL THEN 'year not in mapping'
  WHEN status <> 'done' THEN 'other source not done' END AS exclusion_reason
  FROM scenes s LEFT JOIN latest l ON s.item_id = l.item_id LEFT JOIN ranges r ON s.year BETWEEN r.lo AND r.hi)
"""


def _inventory(spark: SparkSession, d: str) -> DataFrame:
    scenes = v.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("scene_id"), F.col("o_custkey").alias("item_id"), F.year("o_orderdate").alias("year")
    )
    book = _latest(spark, d).select("item_id", "status", "source")
    t = inventory.in_range(scenes.join(book, "item_id", "left"), _ranges(spark), "year")
    done = F.col("status") == "done"
    reason = inventory.first_reason(
        (F.col("year") >= 2001, "inference year"), (F.col("status").isNull(), "no ledger row"), (~done & (F.col("source") == "src0"), "first source not done"),
        (F.col("vintage").isNull(), "year not in mapping"), (~done, "other source not done"),
    )
    return t.withColumn("exclusion_reason", reason)


@query(_INVENTORY + "SELECT scene_id, year, vintage, exclusion_reason FROM t")
def inventory_exclusions(spark: SparkSession, d: str) -> DataFrame:
    """JN-05."""
    return _inventory(spark, d).select("scene_id", "year", "vintage", "exclusion_reason")


@query(_INVENTORY + "SELECT exclusion_reason AS reason, count(*) AS n FROM t WHERE exclusion_reason IS NOT NULL GROUP BY 1")
def inventory_reason_counts(spark: SparkSession, d: str) -> DataFrame:
    """AG-06, VAL-15."""
    return inventory.reason_counts(_inventory(spark, d).withColumnRenamed("exclusion_reason", "reason"))


@query(_INVENTORY + "SELECT 'unexpected_exclusion' AS rule, CAST(scene_id AS VARCHAR) AS key, exclusion_reason AS detail FROM t WHERE exclusion_reason NOT IN ('inference year', 'no ledger row')")
def unexpected_exclusions(spark: SparkSession, d: str) -> DataFrame:
    """VAL-15."""
    return checks.unexpected_exclusions(_inventory(spark, d), ["inference year", "no ledger row"])


@query("""SELECT c_custkey AS item_id, kind FROM customer, (VALUES ('data'), ('flag'), ('marker')) k(kind)
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c_custkey AND kind = CASE o_orderkey % 3 WHEN 0 THEN 'data' WHEN 1 THEN 'flag' ELSE 'marker' END)""")
def artifact_completeness(spark: SparkSession, d: str) -> DataFrame:
    """JN-09."""
    k = F.col("o_orderkey") % 3
    kind = F.when(k == 0, "data").when(k == 1, "flag").otherwise("marker")
    artifacts = v.table(spark, d, "orders").select(F.col("o_custkey").alias("item_id"), kind.alias("kind"))
    return inventory.completeness(_work(spark, d), ["data", "flag", "marker"], artifacts, ["item_id"])


@query("""WITH s AS (SELECT user_id, ts, event_id, value FROM events), t AS (SELECT o_orderkey AS anchor_id, CAST(o_custkey % 150 AS BIGINT) AS user_id,
  CAST(TIMESTAMP '2024-01-01' + INTERVAL 1 SECOND * (o_orderkey * 7 % 2592000) AS TIMESTAMP) AS acq FROM orders)
SELECT anchor_id, event_id FROM (SELECT t.anchor_id, s.event_id, row_number() OVER (PARTITION BY t.anchor_id ORDER BY abs(epoch_us(s.ts) - epoch_us(t.acq)), s.ts, s.event_id) AS rn
  FROM t JOIN s ON t.user_id = s.user_id) WHERE rn = 1
UNION ALL SELECT anchor_id, NULL FROM t WHERE user_id NOT IN (SELECT user_id FROM s)""")
def nearest_in_time(spark: SparkSession, d: str) -> DataFrame:
    """JN-19."""
    start = F.to_timestamp(F.lit("2024-01-01"))
    t = v.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("anchor_id"), (F.col("o_custkey") % 150).alias("user_id"),
        F.timestamp_seconds(F.unix_seconds(start) + F.col("o_orderkey") * 7 % 2592000).alias("acq"),
    )
    s = v.table(spark, d, "events").select("user_id", "ts", "event_id")
    return couple.nearest_in_time(t, s, "anchor_id", ("user_id",)).select("anchor_id", "event_id")


@query("""WITH t AS (SELECT o_orderkey AS anchor_id, CAST(o_custkey % 150 AS BIGINT) AS user_id, CAST(TIMESTAMP '2024-01-01' + INTERVAL 1 SECOND * (o_orderkey * 7 % 2592000) AS TIMESTAMP) AS acq FROM orders)
SELECT t.anchor_id, e.event_id, e.ts AS event_ts FROM t ASOF LEFT JOIN (SELECT user_id, ts, min(event_id) AS event_id FROM events GROUP BY ALL) e ON t.user_id = e.user_id AND t.acq >= e.ts""")
def asof_user_event(spark: SparkSession, d: str) -> DataFrame:
    """JN-06: each order's last event of its user."""
    t = _timed_orders(spark, d)
    e = v.table(spark, d, "events").select("user_id", "event_id", "ts")
    out = asof.as_of_join(t, e, "acq", "ts", ("user_id",))
    return out.select("anchor_id", "found.event_id", F.col("found.ts").alias("event_ts"))


@query("""WITH t AS (SELECT o_orderkey AS anchor_id, CAST(TIMESTAMP '2024-01-01' + INTERVAL 1 SECOND * (o_orderkey * 7 % 2592000) AS TIMESTAMP) AS acq FROM orders),
e AS (SELECT ts, min(event_id) AS event_id FROM events GROUP BY ts)
SELECT b.anchor_id, b.event_id AS before_id, a.event_id AS after_id FROM (SELECT t.*, e.event_id FROM t ASOF LEFT JOIN e ON t.acq >= e.ts) b
JOIN (SELECT t.*, e.event_id FROM t ASOF LEFT JOIN e ON t.acq <= e.ts) a ON a.anchor_id = b.anchor_id""")
def asof_any_event(spark: SparkSession, d: str) -> DataFrame:
    """JN-06: the events before and after each order, all events being one group of many buckets."""
    t, e = _timed_orders(spark, d), v.table(spark, d, "events").select("event_id", "ts")
    width = 3_600_000_000.0  # an hour
    out = asof.as_of_join(t, e, "acq", "ts", width=width, payload="before")
    out = asof.as_of_join(out, e, "acq", "ts", direction="forward", width=width, payload="after")
    return out.select("anchor_id", F.col("before.event_id").alias("before_id"), F.col("after.event_id").alias("after_id"))


_BANDS = "bands AS (SELECT s_suppkey, CAST(s_acctbal AS DOUBLE) - s_suppkey % 40 AS lo, CAST(s_acctbal AS DOUBLE) + power(3, s_suppkey % 8) AS hi FROM supplier)"


@query(f"WITH {_BANDS} SELECT c_custkey, s_suppkey FROM customer LEFT JOIN bands ON c_acctbal >= lo AND c_acctbal <= hi")
def range_lookup(spark: SparkSession, d: str) -> DataFrame:
    """JN-06: balances in overlapping ranges of very different lengths."""
    balance = F.col("s_acctbal").cast("double")
    bands = v.table(spark, d, "supplier").select(
        "s_suppkey", (balance - F.col("s_suppkey") % 40).alias("lo"), (balance + F.pow(F.lit(3.0), F.col("s_suppkey") % 8)).alias("hi")
    )
    c = v.table(spark, d, "customer").select("c_custkey", F.col("c_acctbal").cast("double").alias("c_acctbal"))
    return asof.range_join(c, bands, "c_acctbal").select("c_custkey", "s_suppkey")


def _timed_orders(spark: SparkSession, d: str) -> DataFrame:
    start = F.unix_seconds(F.to_timestamp(F.lit("2024-01-01")))
    return v.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("anchor_id"), (F.col("o_custkey") % 150).alias("user_id"), F.timestamp_seconds(start + F.col("o_orderkey") * 7 % 2592000).alias("acq")
    )


@query("SELECT o_orderkey AS id, CASE WHEN m <= 6 THEN 'early' WHEN m = 7 THEN 'peak' ELSE 'late' END AS season, CASE WHEN c < 10 THEN 'low' WHEN c < 30 THEN 'mid' ELSE 'high' END AS cloud FROM (SELECT o_orderkey, month(o_orderdate) AS m, o_custkey % 100 AS c FROM orders)")
def sampling_bins(spark: SparkSession, d: str) -> DataFrame:
    """PRJ-23."""
    o = v.table(spark, d, "orders")
    return o.select(F.col("o_orderkey").alias("id"), labels.season(F.month("o_orderdate")).alias("season"), labels.cloudiness(F.col("o_custkey") % 100).alias("cloud"))


@query("""WITH t AS (SELECT CAST(month(o_orderdate) AS INT) AS month, o_orderpriority, o_orderkey, o_custkey, CAST(row_number() OVER (PARTITION BY month(o_orderdate), o_orderpriority ORDER BY sha256('42:' || o_orderkey), o_orderkey) AS INT) AS turn FROM orders),
f AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY turn, month, o_orderpriority, o_orderkey) AS rn FROM t)
SELECT turn, month, o_orderpriority, o_orderkey, o_custkey FROM f WHERE rn = 1 ORDER BY turn, month, o_orderpriority, o_orderkey LIMIT 200""")
def stratified_sample(spark: SparkSession, d: str) -> DataFrame:
    """WN-05, a sampling operator; the tests hold it against the greedy loop too."""
    o = v.table(spark, d, "orders").select("o_orderkey", "o_orderpriority", F.month("o_orderdate").alias("month"), "o_custkey")
    return sampling.stratified_sample(o, ["month", "o_orderpriority"], "o_orderkey", "o_custkey", 42, 200)


@query("SELECT o_orderkey, o_custkey, round(o_totalprice, 6) AS score FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def risk_topk(spark: SparkSession, d: str) -> DataFrame:
    """ST-03: a report of the largest scores."""
    o = v.table(spark, d, "orders").select("o_orderkey", "o_custkey", F.col("o_totalprice").cast("double").alias("score"))
    return sampling.top_risk(o, "score", ["o_orderkey"], 50).withColumn("score", F.round("score", 6))


@query("""SELECT o_orderpriority, count(*) AS n, round(min(p), 6) AS min, round(quantile_cont(p, 0.5), 6) AS p50, round(quantile_cont(p, 0.75), 6) AS p75, round(max(p), 6) AS max
FROM (SELECT o_orderpriority, CAST(o_totalprice AS DOUBLE) AS p FROM orders) GROUP BY 1""")
def quantile_lines(spark: SparkSession, d: str) -> DataFrame:
    """AG-21."""
    out = sampling.quantile_line(v.table(spark, d, "orders"), ["o_orderpriority"], "o_totalprice")
    return out.select("o_orderpriority", "n", *(F.round(c, 6).alias(c) for c in ("min", "p50", "p75", "max")))


@query("SELECT source, count(*) AS n_members, sha256(string_agg(h, '' ORDER BY h)) AS checksum FROM (SELECT source, sha256(text) AS h FROM documents) GROUP BY 1")
def combined_checksum(spark: SparkSession, d: str) -> DataFrame:
    """AG-24, FP-02."""
    return hashes.combined_checksum(v.table(spark, d, "documents"), ["source"], "text")


@query("SELECT c_custkey, substr(sha256('{\"c_mktsegment\":\"' || c_mktsegment || '\",\"c_nationkey\":' || c_nationkey || '}'), 1, 16) AS fingerprint FROM customer")
def policy_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    """FP-01."""
    c = v.table(spark, d, "customer")
    return c.select("c_custkey", hashes.row_fingerprint("c_nationkey", "c_mktsegment").alias("fingerprint"))


@query("SELECT page_id, nullif(regexp_extract(url, '/(\\d+)', 1), '') AS number, lower(regexp_extract(url, '//([^/?#]+)', 1)) AS host FROM pages")
def url_parts(spark: SparkSession, d: str) -> DataFrame:
    """SRC-11, SRC-17: names taken apart."""
    p = v.table(spark, d, "pages")
    return p.select("page_id", F.nullif(F.regexp_extract("url", r"/(\d+)", 1), F.lit("")).alias("number"), F.lower(F.regexp_extract("url", "//([^/?#]+)", 1)).alias("host"))


@query("SELECT o_orderkey AS item_id, o_orderdate AS acq FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate <= TIMESTAMP '1997-06-30' AND o_custkey % 100 < 20")
def catalogue_search(spark: SparkSession, d: str) -> DataFrame:
    """SRC-09."""
    c = v.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("item_id"), F.col("o_orderpriority").alias("collection"), F.col("o_orderdate").alias("acq"), (F.col("o_custkey") % 100).alias("cloud_cover")
    )
    return scans.search(c, ["1-URGENT", "2-HIGH"], since="1996-01-01", until="1997-06-30").select("item_id", "acq")


@query("SELECT o_orderkey AS scene_id, o_orderdate AS acq FROM orders WHERE o_orderstatus IN ('F', 'O') AND month(o_orderdate) BETWEEN 5 AND 9 AND year(o_orderdate) IN (1996, 1997) AND o_orderdate <= TIMESTAMP '1997-08-01'")
def season_anchors(spark: SparkSession, d: str) -> DataFrame:
    """PRJ-12."""
    o = v.table(spark, d, "orders").select(F.col("o_orderkey").alias("scene_id"), F.col("o_orderdate").alias("acq"), F.col("o_orderstatus").alias("platform"))
    return scans.season_anchors(o, ["F", "O"], [5, 6, 7, 8, 9], [1996, 1997], "1997-08-01").select("scene_id", "acq")


@query(f"""WITH {v.LEDGER_LOG}, {v.LATEST} SELECT c_custkey AS item_id, coalesce(l.status, '') <> 'failed' AND c_custkey % 5 <> 0 AS run
FROM customer LEFT JOIN latest l ON l.item_id = c_custkey""")
def circuit_breaker(spark: SparkSession, d: str) -> DataFrame:
    """LED-06."""
    return ledger.circuit_breaker(_work(spark, d), _latest(spark, d), ["item_id"], F.col("o.item_id") % 5 != 0)
