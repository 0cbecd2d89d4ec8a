"""Coupling scenes in time (JN-01, JN-02, JN-19, AG-03, WN-01, WN-06, SET-01, ST-01, ST-02)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latticeframe.functions.nulls import ratio, value
from latticeframe.operators import asof
from latticeframe.sources.work import few_broadcast, kept

SLACK_DAYS = 1e-6


def _days(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp")) / F.lit(86_400_000_000.0)


def interval_join(
    anchors: DataFrame, candidates: DataFrame, window_days: float = 3, cutoff: str | None = None, on: tuple[str, ...] = ()
) -> DataFrame:
    """Candidates within +-`window_days` of each anchor, ends included, with `dt_days`.

    Both sides have a time column `acq`; the candidates' one is returned as `cand_acq`. Candidates after `cutoff` are
    left out. Anchors are put on their day and candidates on the few days around theirs, so the range becomes an
    equi-join with an exact check, and anchors, the larger side as a rule, stay one row each; `on` names further
    columns that must be equal.
    """
    if cutoff is not None:
        candidates = candidates.filter(F.col("acq").cast("timestamp") <= F.lit(cutoff).cast("timestamp"))
    reach = int(-(-window_days // 1))
    a = anchors.filter("acq is not null").withColumn("__day", F.floor(_days(F.col("acq"))))
    c = candidates.filter("acq is not null").withColumn("__day", F.floor(_days(F.col("acq"))))
    c = c.withColumn("__day", F.explode(F.sequence(F.col("__day") - reach - 1, F.col("__day") + reach + 1))).withColumnRenamed("acq", "cand_acq")
    joined = a.join(c, ["__day", *on]).drop("__day")
    joined = joined.withColumn("dt_days", F.abs(_days(F.col("cand_acq")) - _days(F.col("acq"))))
    return joined.filter(F.col("dt_days") <= window_days + SLACK_DAYS)


def best_match(
    anchors: DataFrame,
    pairs: DataFrame,
    key: str,
    candidate: str,
    threshold: float,
    lam: float = 0.1,
    window_days: float = 3.0,
    strict: bool = False,
) -> DataFrame:
    """One row per anchor: its best candidate, or why it has none.

    `pairs` has the anchor key, the candidate id, `clear_frac` and `dt_days`. Score is clear_frac - lam * dt / window;
    ties go to the shorter dt, then the smaller id. Candidates without a clear fraction don't compete. An anchor is
    dropped if no candidate reaches the threshold; the winner itself may stay below it unless `strict`.
    """
    return _judged(anchors, anchors.join(_best(pairs, [key], candidate, lam, window_days), key, "left"), candidate, threshold, strict)


def best_by_time(
    anchors: DataFrame,
    candidates: DataFrame,
    key: str,
    candidate: str,
    threshold: float,
    lam: float = 0.1,
    window_days: float = 3.0,
    strict: bool = False,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """`best_match` over `interval_join`, for anchors whose `key` is their own, plus the winner's columns `carry`.

    A match depends on an anchor's time alone, so each distinct time is matched once and the answer joined back: the
    pairs are as many as times and candidates make, however many anchors share a time, and anchors aren't shuffled
    while times are few. An anchor without a key or a time has no candidate. Scores are over three days, as the
    default of `best_match`, whatever the window.
    """
    times = anchors.filter(F.col(key).isNotNull()).select("acq").distinct()
    found = kept(_best(interval_join(times, candidates, window_days), ["acq"], candidate, lam, 3.0, carry), "best")
    asked = anchors.withColumn("__at", F.when(F.col(key).isNotNull(), F.col("acq")))
    joined = asked.join(few_broadcast(found.withColumnRenamed("acq", "__time")), F.col("__at") == F.col("__time"), "left")
    return _judged(anchors, joined, candidate, threshold, strict, carry)


def _best(pairs: DataFrame, keys: list[str], candidate: str, lam: float, window_days: float, carry: tuple[str, ...] = ()) -> DataFrame:
    scored = pairs.select(*keys, candidate, "dt_days", value("clear_frac").alias("clear_frac"), *carry)
    scored = scored.withColumn("score", F.col("clear_frac") - lam * F.col("dt_days") / window_days)
    best = F.min_by(
        F.struct(candidate, "dt_days", "clear_frac", "score", *carry),
        F.when(F.col("score").isNotNull(), F.struct(-F.col("score"), F.col("dt_days"), F.col(candidate))),
    )
    # Grouped aggregates combine on the map side; a ranking window would ship every pair.
    return scored.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_candidates"), F.max("clear_frac").alias("max_clear_frac"), best.alias("b"))


def _judged(anchors: DataFrame, out: DataFrame, candidate: str, threshold: float, strict: bool, carry: tuple[str, ...] = ()) -> DataFrame:
    top = F.col("b.clear_frac") if strict else F.col("max_clear_frac")
    status = F.coalesce(top >= threshold, F.lit(False))
    reason = F.when(F.col("n_candidates").isNull(), "no_candidate_in_window").when(~status, "none_above_threshold")
    won = lambda c: F.when(status, F.col(f"b.{c}")).alias(c)
    return out.select(
        *anchors.columns,
        F.when(status, "coupled").otherwise("dropped").alias("status"),
        reason.alias("reason"),
        F.coalesce("max_clear_frac", F.lit(0.0)).alias("max_clear_frac"),
        *map(won, (candidate, "dt_days", "clear_frac", "score", *carry)),
    )


def joint_clear_fraction(pixels: DataFrame, keys: list[str], first: Column, second: Column) -> DataFrame:
    """AG-03: pixels clear in the first, in the second, in both and in all, and both / first (NULL if none)."""
    a, b = F.coalesce(first, F.lit(False)), F.coalesce(second, F.lit(False))
    counts = pixels.groupBy(*keys).agg(
        F.count_if(a).alias("first_clear_px"),
        F.count_if(b).alias("second_clear_px"),
        F.count_if(a & b).alias("joint_clear_px"),
        F.count(F.lit(1)).alias("total_px"),
    )
    return counts.withColumn("joint_clear_frac", ratio(F.col("joint_clear_px"), F.col("first_clear_px")))


def once_per_time(pairs: DataFrame, time: str, measure) -> DataFrame:
    """Evaluate `measure(distinct times)` once per time and give the result to every tile of that time."""
    return pairs.join(measure(pairs.select(time).distinct()), time, "left")


def nearest_in_time(targets: DataFrame, slices: DataFrame, key: str, on: tuple[str, ...] = (), by_date: bool = False) -> DataFrame:
    """The slice closest to each target's `acq` (by UTC date if asked); the earlier one on a tie.

    `slices` has `ts` and other columns. Targets keep their rows, whatever their `key`; a NULL time finds nothing.
    Both tables may be of any size, with or without equal columns `on`.
    """
    rest = [c for c in slices.columns if c not in on and c != "ts"]
    if not by_date:
        found = asof.as_of_join(targets, slices.select(*on, "ts", *rest), "acq", "ts", on, "nearest", payload="__s")
    else:
        # Of a day's slices the earliest counts, as `ts` is the struct's first column.
        days = slices.select(*on, F.col("ts").alias("ts"), *rest, F.to_date("ts").alias("__day"))
        asked = targets.withColumn("__on_day", F.to_date("acq"))
        found = asof.as_of_join(asked, days, "__on_day", "__day", on, "nearest", payload="__s")
    return found.select(*targets.columns, "__s.ts", *(f"__s.{c}" for c in rest))


def first_partner(pairs: DataFrame, partner: str, time: str, anchor: str) -> DataFrame:
    """WN-06: of the pairs that share a partner, the one with the earliest anchor (no time comes last)."""
    rest = [c for c in pairs.columns if c != partner]
    order = F.struct(F.col(time).isNull(), F.col(time), F.col(anchor))
    best = pairs.groupBy(partner).agg(F.min_by(F.struct(*rest), order).alias("__b"))
    return best.select(partner, "__b.*").select(*pairs.columns)


def manifest(anchors: DataFrame, predictors: DataFrame, validation: DataFrame) -> DataFrame:
    """SET-01, ST-01: one table of the three roles; anchors first, then by id."""
    return in_order(roles(anchors, predictors, validation))


def roles(anchors: DataFrame, predictors: DataFrame, validation: DataFrame) -> DataFrame:
    """The rows of a manifest in any order, for those that only count or join them."""
    return (
        anchors.withColumn("role", F.lit("anchor"))
        .unionByName(predictors.withColumn("role", F.lit("predictor")), allowMissingColumns=True)
        .unionByName(validation.withColumn("role", F.lit("validation")), allowMissingColumns=True)
    )


def in_order(rows: DataFrame) -> DataFrame:
    return rows.orderBy(F.col("role") != "anchor", "scene_id", "role")
