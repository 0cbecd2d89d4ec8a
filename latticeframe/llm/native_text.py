"""Word and shingle expressions made of built-in functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from latticeframe.llm.common import ASCII_SPACE

def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once per row, also where `body` uses it inside another lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def plain_spaces(text: Column) -> Column:
    """`text` with every ASCII white space as a space; byte searches, which a regular expression would be slower than."""
    for c in ASCII_SPACE:
        if c != " ":
            text = F.replace(text, F.lit(c), F.lit(" "))
    return text


def words(text: Column) -> Column:
    """The words of a text between ASCII white space; none for an empty or blank text."""
    return F.array_remove(F.split(plain_spaces(text), " "), "")


def count_spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(plain_spaces(text), F.lit(" "), F.lit("")))


def count_any(text: Column, chars: str) -> Column:
    """How many characters of `text` are among `chars`."""
    rest = text
    for c in chars:
        rest = F.replace(rest, F.lit(c), F.lit(""))
    return F.length(text) - F.length(rest)


def word_windows(w: Column, size: int) -> Column:
    """64-bit hashes of all runs of `size` neighbouring words, in order; none where there are fewer words."""
    return F.when(
        F.size(w) >= size,
        let(
            w,
            lambda a: F.transform(
                F.sequence(F.lit(0), F.size(a) - size), lambda i: F.xxhash64(*(F.get(a, i + k) for k in range(size)))
            ),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def shingles(w: Column, size: int) -> Column:
    """Hashes of the word shingles of a text, not yet distinct; a shorter text is one shingle, no words none."""
    return (
        F.when(F.size(w) == 0, F.array().cast("array<bigint>"))
        .when(F.size(w) < size, F.array(F.xxhash64(F.concat_ws(" ", w), F.size(w))))
        .otherwise(word_windows(w, size))
    )


def words_in_repeats(windows: Column, size: int) -> Column:
    """How many words stand in windows whose hash occurs twice or more, the first occurrence included."""

    def covered(s: Column) -> Column:  # s: (hash, position) in order
        twice = F.filter(
            s, lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"])
        )
        places = F.sort_array(F.transform(twice, lambda x: x["i"]))
        return let(
            places,
            lambda p: F.aggregate(
                F.transform(p, lambda x, k: F.coalesce(F.least(F.get(p, k + 1) - x, F.lit(size)), F.lit(size))),
                F.lit(0).cast("bigint"),
                lambda a, x: a + x,
            ),
        )

    ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("bigint")).otherwise(
        let(ordered, covered)
    )
