"""State tables: upsert, attempts, reconcile (SET-02, SET-04, LED-01 .. LED-08, JN-07, JN-08, WN-07, AG-04, AG-05, AG-25)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# States of the two ledgers.
ARD_STATES = ("pending", "exporting", "done", "failed", "skipped", "exhausted")
SECONDARY_STATES = ("pending", "exporting", "done", "failed", "skipped")
MOST_ATTEMPTS = 999


def _same(keys: list[str], a: str = "o", b: str = "n") -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
    return out


def latest(log: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """WN-07: the last row per key; one grouped aggregate, combined on the map side."""
    rest = [c for c in log.columns if c not in keys]
    top = F.max_by(F.struct(*rest), F.struct(*order))
    return log.groupBy(*keys).agg(top.alias("__l")).select(*keys, "__l.*").select(*log.columns)


def upsert(ledger: DataFrame, rows: DataFrame, keys: list[str], attempts: str = "keep") -> DataFrame:
    """Rows replace those with the same key. `rows` holds a key once.

    attempts: "given" takes the rows' own, "keep" the ledger's (1 if new), "begin" the ledger's plus one with status
    exporting (LED-01), "count" the ledger's plus one, at most 999 (LED-03).
    """
    if attempts != "given":
        before = ledger.select(*keys, F.col("attempts").alias("__before"))
        rows = rows.alias("o").join(before.alias("n"), _same(keys), "left").select("o.*", "__before")
        n = F.coalesce("__before", F.lit(0))
        rule = {
            "keep": F.coalesce("__before", F.lit(1)),
            "begin": n + 1,
            "count": F.least(n + 1, F.lit(MOST_ATTEMPTS)),
        }[attempts]
        rows = rows.withColumn("attempts", rule.cast(dict(ledger.dtypes)["attempts"])).drop("__before")
        if attempts == "begin":
            rows = rows.withColumn("status", F.lit("exporting"))
    kept = ledger.alias("o").join(rows.alias("n"), _same(keys), "left_anti")
    return kept.unionByName(rows, allowMissingColumns=True)


def lookup(ledger: DataFrame, **key) -> DataFrame:
    """LED-04."""
    for k, v in key.items():
        ledger = ledger.filter(F.col(k).eqNullSafe(F.lit(v)))
    return ledger


def bad_states(ledger: DataFrame, states=ARD_STATES) -> DataFrame:
    """LED-05."""
    return ledger.filter(~F.coalesce(F.col("status").isin(*states), F.lit(False)))


def reconcile(work: DataFrame, ledger: DataFrame, keys: list[str], version: Column, files_exist: Column, max_attempts: int = 3) -> DataFrame:
    """JN-07: `work` plus `action`: new, retry, interrupted, schema_changed, skip or exhausted.

    `version` and `files_exist` are expressions over the ledger's row. `exhausted` rows are those to be marked so.
    """
    joined = work.alias("o").join(ledger.alias("n"), _same(keys), "left")
    status, tries = F.col("n.status"), F.coalesce(F.col("n.attempts"), F.lit(0))
    spent = tries >= max_attempts
    action = (
        F.when(status.isNull() | (status == "pending"), "new")
        .when((status == "done") & ~version, "schema_changed")
        .when(status == "done", F.when(files_exist, "skip").otherwise("interrupted"))
        .when(status == "failed", F.when(spent, "exhausted").otherwise("retry"))
        .when(status == "exporting", F.when(spent, "exhausted").otherwise("interrupted"))
        .otherwise("skip")
    )
    return joined.select(*(F.col(f"o.{c}") for c in work.columns), action.alias("action"))


def reconcile_by_hash(work: DataFrame, ledger: DataFrame, keys: list[str], same_hash: Column, output: Column, marker: Column) -> DataFrame:
    """JN-08: `work` plus `action`: new, retry, interrupted, config_changed, incomplete or skip; no attempt ceiling."""
    joined = work.alias("o").join(ledger.alias("n"), _same(keys), "left")
    status = F.col("n.status")
    action = (
        F.when(status.isNull() | (status == "pending"), "new")
        .when((status == "done") & ~same_hash, "config_changed")
        .when((status == "done") & output & marker, "skip")
        .when((status == "done") & output, "incomplete")
        .when(status.isin("done", "exporting"), "interrupted")
        .when(status == "failed", "retry")
        .otherwise("skip")
    )
    return joined.select(*(F.col(f"o.{c}") for c in work.columns), action.alias("action"))


def resume(work: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """SET-04: what isn't finished yet."""
    return work.alias("o").join(done.alias("n"), _same(keys), "left_anti")


def circuit_breaker(work: DataFrame, upstream: DataFrame, keys: list[str], inputs_ok: Column) -> DataFrame:
    """LED-06: `work` plus `run`: false where the upstream failed in this run or an input is missing."""
    failed = upstream.filter("status = 'failed'").select(*keys).distinct().withColumn("__f", F.lit(True))
    joined = work.alias("o").join(failed.alias("n"), _same(keys), "left")
    run = F.col("__f").isNull() & F.coalesce(inputs_ok, F.lit(False))
    return joined.select(*(F.col(f"o.{c}") for c in work.columns), run.alias("run"))


def status_counts(ledger: DataFrame, by: str, states=ARD_STATES) -> DataFrame:
    """AG-04: one row per `by`, one column per state; the states are declared, so no extra pass finds them."""
    counts = [F.count_if(F.col("status") == s).alias(s) for s in states]
    return ledger.groupBy(by).agg(*counts, F.count(F.lit(1)).alias("total"))


def qa_report(ledger: DataFrame, by: str, exists: Column, clear: Column, states=ARD_STATES) -> DataFrame:
    """AG-05: totals, states, artifacts that exist or are missing, clear-area statistics of done rows, success."""
    done = F.col("status") == "done"
    ok = F.coalesce(exists, F.lit(False))
    told = ledger.groupBy(by).agg(
        F.count(F.lit(1)).alias("total"),
        *(F.count_if(F.col("status") == s).alias(s) for s in states),
        F.count_if(done & ok).alias("artifacts_exist"),
        F.count_if(done & ~ok).alias("artifacts_missing"),
        F.avg(F.when(done, clear)).alias("clear_mean"),
        F.min(F.when(done, clear)).alias("clear_min"),
        F.max(F.when(done, clear)).alias("clear_max"),
    )
    failed = F.col("failed") + (F.col("exhausted") if "exhausted" in states else 0) + F.col("artifacts_missing")
    return told.withColumn("failed_total", failed).withColumn("success", failed == 0)


def reuse_previous(work: DataFrame, previous: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """LED-08: skipped work takes the figures of the product that it reuses."""
    before = previous.select(*keys, *(F.col(c).alias(f"__{c}") for c in columns))
    joined = work.join(before, keys, "left")
    filled = {c: F.when(F.col("action") == "skip", F.col(f"__{c}")) for c in columns}
    return joined.withColumns(filled).drop(*(f"__{c}" for c in columns))


def run_tally(rows: DataFrame) -> DataFrame:
    """AG-28: succeeded, failed, rate."""
    ok = F.col("status").isin("done", "coupled")
    return rows.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(ok).alias("succeeded"),
        F.count_if(~ok).alias("failed"),
        F.round(F.avg(ok.cast("double")), 6).alias("rate"),
    )
