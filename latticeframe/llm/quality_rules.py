"""Quality rules with adaptive thresholds (operator 8, built-in functions only).

Method: every document gets a few ratios; per (lang, source) group their quantiles come from mergeable KLL sketches,
and a document fails where a ratio lies outside a fence around the quartiles of its own group, shrunk towards those
of all documents by the group's size. The fences replace
fixed cut-offs: a group that writes longer words or more symbols as a whole gets wider limits by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latticeframe.llm.common import stored
from latticeframe.llm.native_text import count_any, count_spaces, let, word_windows, words, words_in_repeats

SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: ratio -> least spread that a fence is built from, so that a group of equal values doesn't reject small deviations
RATIOS = {"symbol_ratio": 0.01, "dup_line_ratio": 0.15, "mean_word_chars": 1.0}
#: fences stand this many spreads beyond the quartiles
REACH = 3.0
#: at this size a group's own quartiles and those of all documents weigh the same
PRIOR = 30
#: most groups whose fences are broadcast; beyond it the join shuffles
BROADCAST_GROUPS = 50_000


def _prefixed(name: str) -> str:
    return f"__q_{name}"


def with_metrics(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` plus `__q_*` columns: counts, ratios and the base verdict. Null text has no words."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(" \t\x0b\x0c\r")) != "")
    df = docs.withColumn(_prefixed("words"), words(t)).withColumn(_prefixed("lines"), lines)
    w, ln = F.col(_prefixed("words")), F.col(_prefixed("lines"))
    df = df.withColumns(
        {
            _prefixed("n_words"): F.size(w).cast("bigint"),
            _prefixed("word_chars"): (F.length(t) - count_spaces(t)).cast("bigint"),
            _prefixed("n_symbols"): count_any(t, SYMBOLS).cast("bigint"),
            _prefixed("n_dup_lines"): (F.size(ln) - F.size(F.array_distinct(ln))).cast("bigint"),
            _prefixed("n_lines"): F.size(ln).cast("bigint"),
            _prefixed("windows"): word_windows(w, WINDOW),
        }
    )
    n, chars = F.col(_prefixed("n_words")), F.col(_prefixed("word_chars"))
    df = df.withColumns(
        {
            _prefixed("n_repeat_words"): words_in_repeats(F.col(_prefixed("windows")), WINDOW),
            _prefixed("symbol_ratio"): F.coalesce(F.try_divide(F.col(_prefixed("n_symbols")), chars), F.lit(0.0)),
            _prefixed("dup_line_ratio"): F.coalesce(
                F.try_divide(F.col(_prefixed("n_dup_lines")), F.col(_prefixed("n_lines"))), F.lit(0.0)
            ),
            _prefixed("mean_word_chars"): F.coalesce(F.try_divide(chars, n), F.lit(0.0)),
        }
    )
    return df.withColumn(_prefixed("base_failed"), (n < 10) | (F.col(_prefixed("n_repeat_words")) * 100 > n * 20)).drop(
        _prefixed("words"), _prefixed("lines"), _prefixed("windows")
    )


def fences(measured: DataFrame) -> DataFrame:
    """Per (lang, source): the limits of each ratio, from KLL sketches of all its documents.

    Sketches are built per (lang, source), written once, and merged to the one over everything. The quartiles of a
    group of n documents weigh n squared against `PRIOR` squared for those of all documents, so a small group leans on
    the others, a larger one soon stands alone, and no group size switches anything. A null language or source is a
    group of its own.
    """
    keys = [F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source")]
    parts = stored(
        measured.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("n"), *(F.kll_sketch_agg_double(_prefixed(r)).alias(r) for r in RATIOS)
        ),
        "sketches",
    )
    whole = parts.agg(*(F.kll_merge_agg_double(r).alias(f"all_{r}") for r in RATIOS))

    n = F.col("n").cast("double")
    share = n * n / (n * n + PRIOR**2)

    def limits(own: Column, every: Column, least: float) -> Column:
        quartiles = F.array(F.lit(0.25), F.lit(0.75))
        q = F.struct(F.kll_sketch_get_quantile_double(own, quartiles).alias("a"), F.kll_sketch_get_quantile_double(every, quartiles).alias("b"))
        mean = lambda v, k: F.get(v["b"], k) + (F.get(v["a"], k) - F.get(v["b"], k)) * share
        return let(
            q,
            lambda v: let(
                F.greatest(mean(v, 1) - mean(v, 0), F.lit(least)) * REACH,
                lambda s: F.struct((mean(v, 0) - s).alias("lo"), (mean(v, 1) + s).alias("hi")),
            ),
        )

    # `whole` is a single row, so this join is bounded whatever the number of groups.
    return parts.join(F.broadcast(whole)).select(
        "lang", "source", *(limits(F.col(r), F.col(f"all_{r}"), least).alias(r) for r, least in RATIOS.items())
    )


def judge(docs: DataFrame, text: str = "text") -> DataFrame:
    """`row` (a struct of the columns of `docs`), its metrics as `__q_*` columns, and `__q_kept`.

    Rejected are documents that fail the base rule (under 10 words, or over a fifth of the words in repeated
    five-word windows) or leave a fence of their group. Null text has no words; repeated rows are judged alike, each
    for itself; texts are judged whole, however long; an empty table stays empty; columns of `docs` may have any
    names, as they travel in one struct. Metrics are computed from the scan twice (the cheap ratios first, for the
    fences), which moves no text between executors.
    """
    names = {"text": text, "lang": "lang", "source": "source"}
    rows = docs.select(F.struct("*").alias("row"), *(F.col(c).alias(n) for n, c in names.items()))
    measured = with_metrics(rows).drop("text")
    table = stored(fences(measured), "fences").withColumnsRenamed({"lang": "of_lang", "source": "of_source"})
    # The number of groups is only known from the data: its count decides about broadcasting.
    if table.count() <= BROADCAST_GROUPS:
        table = F.broadcast(table)
    joined = measured.join(
        table,
        F.col("lang").cast("string").eqNullSafe(F.col("of_lang")) & F.col("source").cast("string").eqNullSafe(F.col("of_source")),
        "left",
    )
    inside = F.lit(True)
    for r in RATIOS:
        inside = inside & F.coalesce(F.col(_prefixed(r)).between(F.col(f"{r}.lo"), F.col(f"{r}.hi")), F.lit(True))
    verdict = (~F.col(_prefixed("base_failed")) & inside).alias("__q_kept")
    return joined.select("row", *(c for c in measured.columns if c.startswith("__q_")), verdict)


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that pass, with its columns."""
    return judge(docs).filter("__q_kept").select("row.*")


def report(docs: DataFrame) -> DataFrame:
    """Counts and verdicts per document."""
    judged = judge(docs.select("doc_id", "text", "lang", "source"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select(F.col("row.doc_id").cast("long").alias("doc_id"), *(F.col(_prefixed(n)).alias(n) for n in names))


__all__ = ["fences", "judge", "keep_good", "report", "with_metrics"]
