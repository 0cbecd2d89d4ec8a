"""Language identification with a word-first backoff (operator 11).

Method: a word that was learned scores by its log frequency in each language. Only a word that wasn't falls back to its
characters: to its longest n-grams that were learned (5 letters, the word's ends counted as letters), and to shorter
ones, down to single letters, as long as none is known. A text's language has the greatest sum over its words and the
log share of the language among the labelled texts.

Learning reads every labelled text: words are counted by language with partial sums, n-grams from the counted words.
What is kept is bounded by construction: an entry stays if it makes up a fixed share of all words (or n-grams of its
length), so there are at most 1 / share of them; that is what comes to the driver and is broadcast.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latticeframe.llm.common import discard, map_rows, only, row_slices, stored

#: Letters, and some digits that aren't decimal, which `words_of` leaves out
_WORDS = re.compile(r"[^\W\d_]+")
GRAMS = (5, 4, 3, 2, 1)
#: Least share of all words (at most 262,144 words are known) and of all n-grams of one length (32,768 each)
WORD_SHARE, GRAM_SHARE = 1 / 262_144, 1 / 32_768
SMOOTHING = 0.5
#: Letters of unseen words whose scores a task remembers, letters of a word that are looked at at once
MEMO_LETTERS, PIECE = 2_000_000, 1 << 16
#: Text bytes, and letters of different words, whose counts are held before they are handed on
COUNT_BYTES, COUNT_LETTERS = 32 << 20, 400_000
UNKNOWN = "und"


def words_of(text: str | None) -> list[str]:
    """Runs of letters in lower case."""
    found = _WORDS.findall((text or "").lower())
    if all(map(str.isalpha, found)):
        return found
    return [x for w in found for x in "".join(c if c.isalpha() else " " for c in w).split()]


def grams_of(word: str, n: int) -> Iterator[str]:
    """The n-grams of a word with a blank at either end; for n = 1 its letters."""
    padded = word if n == 1 else f" {word} "
    return (padded[k : k + n] for k in range(len(padded) - n + 1))


class _Numbered(dict):
    """Words by row of a table; a word that isn't there gets the next row and is listed in `new`."""

    def __init__(self, known: dict[str, int], rows: int):
        super().__init__(known)
        self.new: list[str] = []
        self.rows = rows

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        self[word] = row = self.rows
        self.rows += 1
        return row


@dataclass(frozen=True)
class Model:
    """Log frequencies: `known[n][entry]` is a row of `table`; n = 0 stands for whole words."""

    langs: list[str]
    prior: np.ndarray
    known: dict[int, dict[str, int]]
    table: np.ndarray

    def backoff(self, words: list[str]) -> np.ndarray:
        """Scores of words that aren't known: the mean over the longest n-grams of a word that are."""
        out, left = np.zeros((len(words), len(self.langs))), range(len(words))
        for n in GRAMS:
            get, rest, rows, sizes, owner = self.known[n].get, [], [], [], []
            for k in left:
                found = 0
                grams = grams_of(words[k], n)
                while own := [get(g, -1) for g in islice(grams, PIECE)]:
                    own = [r for r in own if r >= 0]
                    if len(words[k]) > PIECE:  # a very long word is summed piece by piece
                        out[k] += self.table[own].sum(axis=0)
                    else:
                        rows += own
                    found += len(own)
                if not found:
                    rest.append(k)
                elif len(words[k]) > PIECE:
                    out[k] /= found
                else:
                    owner.append(k)
                    sizes.append(found)
            if owner:
                at = np.cumsum([0, *sizes[:-1]])
                out[owner] = np.add.reduceat(self.table[rows], at) / np.array(sizes)[:, None]
            left = rest
        return out

    def predictor(self) -> Callable[[list[str | None]], list[tuple[str, float]]]:
        """A function from texts to (language, its posterior probability); (`und`, 0) without a letter or a language.

        It remembers the scores of unseen words.
        """
        ids = _Numbered(self.known[0], len(self.table))
        table, letters = self.table, 0

        def predict(texts: list[str | None]) -> list[tuple[str, float]]:
            nonlocal ids, table, letters
            if letters > MEMO_LETTERS:
                ids, table, letters = _Numbered(self.known[0], len(self.table)), self.table, 0
            rows = [np.fromiter(map(ids.__getitem__, words_of(t) if self.langs else ()), np.int64) for t in texts]
            if ids.new:
                table = np.concatenate([table, self.backoff(ids.new)])
                letters += sum(map(len, ids.new))
                ids.new = []
            out = []
            for own in rows:
                if not len(own):
                    out.append((UNKNOWN, 0.0))
                    continue
                total = self.prior + table[own].sum(axis=0)
                best = int(np.argmax(total))
                out.append((self.langs[best], float(1 / np.exp(total - total[best]).sum())))
            return out

        return predict


def _rows(counts: dict[tuple, Counter], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Counts as rows of (*key, entry, n); a batch for each key."""
    for key, own in counts.items():
        same = [pa.array([x] * len(own), t) for x, t in zip(key, schema.types, strict=False)]
        yield pa.RecordBatch.from_arrays([*same, pa.array(own.keys(), pa.string()), pa.array(own.values(), pa.int64())], schema=schema)


def _counted(texts: DataFrame) -> DataFrame:
    """`lang, entry, n` of `lang, text`: words."""
    schema = pa.schema([("lang", pa.string()), ("entry", pa.string()), ("n", pa.int64())])

    def run(batches):
        counts, held = defaultdict(Counter), 0
        for batch in batches:
            for part in row_slices(batch):
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    counts[(lang,)].update(words_of(text))
                held += part.nbytes
                if held > COUNT_BYTES:
                    yield from _rows(counts, schema)
                    counts, held = defaultdict(Counter), 0
        yield from _rows(counts, schema)

    parts = texts.select("lang", "text").mapInArrow(run, "lang string, entry string, n long")
    return parts.groupBy("lang", "entry").agg(F.sum("n").alias("n"))


def _gram_counts(words: DataFrame) -> DataFrame:
    """`size, lang, entry, n` of the n-grams of counted words."""
    schema = pa.schema([("size", pa.int32()), ("lang", pa.string()), ("entry", pa.string()), ("n", pa.int64())])

    def run(batches):
        counts, held = defaultdict(Counter), 0
        for batch in batches:
            for lang, word, times in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for size in GRAMS:
                    own, grams = counts[size, lang], grams_of(word, size)
                    while piece := list(islice(grams, PIECE)):
                        for g, n in Counter(piece).items() if len(piece) > 64 else zip(piece, repeat(1)):
                            own[g] += n * times
                        held += len(piece)
                        if held > len(GRAMS) * COUNT_LETTERS:
                            yield from _rows(counts, schema)
                            counts, held = defaultdict(Counter), 0
                            own = counts[size, lang]
        yield from _rows(counts, schema)

    parts = words.select("lang", "entry", "n").mapInArrow(run, "size int, lang string, entry string, n long")
    return parts.groupBy("size", "lang", "entry").agg(F.sum("n").alias("n"))


def _frequent(counts: DataFrame, totals: DataFrame, share: dict[int, float]) -> DataFrame:
    """`size, entry, by_lang` of `size, lang, entry, n`: entries with at least this share of their size's total."""
    least = F.when(F.col("size") == 0, share[0]).otherwise(share[1])
    by_entry = counts.groupBy("size", "entry").agg(F.sum("n").alias("total"), F.collect_list(F.struct("lang", "n")).alias("by_lang"))
    all_n = totals.groupBy("size").agg(F.sum("n").alias("all_n"))
    return by_entry.join(F.broadcast(all_n), "size").filter(F.col("total") >= least * F.col("all_n")).select("size", "entry", "by_lang")


def learn(texts: DataFrame, word_share: float = WORD_SHARE, gram_share: float = GRAM_SHARE) -> Model:
    """A model of `text, lang`: every row with a language counts, with its whole text.

    At most 1 / word_share words, 5 / gram_share n-grams and a row for each language are collected.
    """
    texts = texts.filter("lang is not null")
    words = stored(_counted(texts), "words")
    counts = stored(words.withColumn("size", F.lit(0)).unionByName(_gram_counts(words)), "counts")
    totals = counts.groupBy("size", "lang").agg(F.sum("n").alias("n"))
    of_lang = {r.lang: r.n for r in texts.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(of_lang)
    all_of = {(r["size"], r.lang): r.n for r in totals.collect()}  # a row for each size and language
    kept = sorted(_frequent(counts, totals, {0: word_share, 1: gram_share}).collect(), key=lambda r: (r["size"], r.entry))
    discard(words, counts)
    at = {lang: k for k, lang in enumerate(langs)}
    table, known = np.zeros((len(kept), len(langs))), {n: {} for n in (0, *GRAMS)}
    for k, r in enumerate(kept):
        known[r["size"]][r.entry] = k
        for own in r.by_lang:
            table[k, at[own.lang]] = own.n
    for n, entries in known.items():
        rows = list(entries.values())
        total = np.array([all_of.get((n, lang), 0) for lang in langs], float)
        table[rows] = np.log(table[rows] + SMOOTHING) - np.log(total + SMOOTHING * (len(rows) + 1))
    n = sum(of_lang.values())
    return Model(langs, np.array([math.log(of_lang[x] / n) for x in langs]), known, table)


def is_held_out(doc_id: Column) -> Column:
    """One document in three by its id; a null id counts as an empty one."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """`doc_id, held_out, lang_pred, score` per row of `doc_id, held_out, text`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        guess = shared.value.predictor()
        return lambda ids, held, texts: [(i, h, *p) for i, h, p in zip(ids, held, guess(texts), strict=True)]

    return map_rows(docs.select("doc_id", "held_out", "text"), "doc_id long, held_out boolean, lang_pred string, score double", make)


def identify(docs: DataFrame) -> DataFrame:
    """`doc_id, held_out, lang_pred, score` per row, learned from the rows with a language that aren't held out.

    A null text, or one without a letter, is `und` with score 0, as is every text if there is nothing to learn from; a
    text of unknown words and letters goes to the most frequent language. Null and repeated ids and repeated rows are
    rows of their own; ties go to the first language by name; texts are taken whole, however long; other columns are
    ignored; an empty table gives an empty one.
    """
    rows = only(docs, doc_id="long", text="string", lang="string").withColumn("held_out", is_held_out(F.col("doc_id")))
    return predict(rows, learn(rows.filter(~F.col("held_out"))))
