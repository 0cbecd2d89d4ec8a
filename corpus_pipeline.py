"""The corpus pipeline: five operators of the training-data part in a row, from documents to packed sequences.

All stages take a table with `doc_id, text` (and `lang, source` for the first); null and repeated ids and repeated rows
stay rows of their own unless a stage says otherwise, texts are taken whole however long, other columns are kept under
any name, and an empty table gives an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from latticeframe.llm import line_dedup, near_dedup, packing, quality_rules, secret_scan
from latticeframe.llm.common import discard, read_table, stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the adaptive fences of their language and source.

    Null and empty texts have no words and go; a null language or source is a group of its own; equal rows get equal
    verdicts; a value at a fence passes.
    """
    return quality_rules.keep_good(docs)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are deleted; a document of nothing else goes.

    Null and empty texts stay; of equal ids the text with the smaller hash counts as earlier; rows with equal ids and
    texts are edited alike.
    """
    return line_dedup.delete_repeats(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (five-word shingles, similarity 0.8): the one of the smallest id.

    Null and empty texts are linked with nothing and stay; rows with equal ids and texts stay or go together; null ids
    come after all others, and of a group without any id the text of the smallest hash stays.
    """
    return near_dedup.keep_one(docs, shingle=5, percent=80)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; overlapping ones by one. Texts without any, null included, stay as they are."""
    return secret_scan.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 2048 tokens.

    A null or empty text is a piece of the separator alone; longer documents than a sequence are several pieces.
    """
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), packing.all_capacities(2048))


STAGES = [
    ("quality rules", quality),
    ("line dedup", repeated_lines),
    ("near dedup", near_duplicates),
    ("secret scans", secrets),
    ("best-fit packing", packed),
]

#: Near-duplicate components, tokens and packing are beyond SQL; the tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, written = read_table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        discard(*written)
        written = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
