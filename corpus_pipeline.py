"""Documents to packed training sequences, one operator per stage.

Every stage works on all rows the one before kept. Its result is written as Parquet and
read back as the next one's documents, so no later stage or lost executor computes it
again. All stages but the last return the columns of documents, whatever these are.

Defined results: a document that is null, empty or without a letter has no language and
goes at the first stage. Stages see rows that repeat an id as documents of their own;
rows that repeat id and text are one document, and one row of them passes the second
stage. An empty table gives empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadcast.llm import decontaminate, exact_dedup, language, near_dedup, packing
from roadcast.llm.queries import TOKENIZER
from roadcast.llm.tables import read, settle


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that could be told."""
    return language.keep_known(docs, language.learn(docs))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the longest, then the smallest id."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 or more in runs of five
    words: the one with the smallest id."""
    return near_dedup.keep_one(docs, size=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words less than one in twenty stems from the benchmark."""
    return decontaminate.keep_clean(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 2048 tokens."""
    return packing.pack(packing.pieces(docs, TOKENIZER))


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("best_fit_packing", pack),
]

# The language stage learns a model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
