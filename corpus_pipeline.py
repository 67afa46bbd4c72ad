"""From raw documents to packed training sequences, over the operators of
``obslake.llm``.

Each stage is a function of ``(spark, docs, sf_dir)``; its result is written
as Parquet and read again as the next stage's ``docs``, so a stage starts
from files that outlive executors.  All but the last return the columns of
``documents``; the last returns the pieces of the packed sequences.

Nulls, empty texts, repeated rows, empty tables and further columns have the
results that the operators' docstrings state: no stage fails on them, and
columns that a stage does not work on are handed through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from obslake.llm import language_id, line_dedup, mixing, packing, simhash_pivots
from obslake.llm.common import table, written
from obslake.llm.queries import tokenizer_path


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are in one of the languages of their labels."""
    return language_id.spoken_documents(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without lines that an earlier one has."""
    return line_dedup.dedup_lines(docs, min_chars=10)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash_pivots.one_of_each(docs, shingle=3, max_bits=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs, weights=(5, 2, 1), max_repeats=3)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, piece, start, length, ids, sequence_id, offset``."""
    return packing.pack_documents(docs, tokenizer_path(), capacity=4096, end_id=1)


STAGES = [
    ("language_id", identify_languages),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

# No SQL: languages, fingerprints and tokens are beyond it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
