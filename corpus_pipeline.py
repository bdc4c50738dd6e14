"""Training-corpus pipeline: five stages, each one operator of ``tripmart.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and reread as the next stage's ``docs``; all but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm import decontaminate, language, line_spread, packing, simhash
from tripmart.llm.common import documents, stored
from tripmart.sources.tables import table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in which no language is found go."""
    return language.keep_identified(docs)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many sources share, and long ones that two share, stay in one document only."""
    return line_spread.clean(docs, long_words=line_spread.LONG_WORDS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays (3-word shingles, 3 bits)."""
    return simhash.deduplicate(docs, shingle=3, radius=3)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document lies in the training sequences."""
    return packing.pack_documents(docs, packing.word_length()).select(
        F.col("id").alias("doc_id"), "piece", "n_tokens", "bin_id", "bin_capacity", "bin_offset")


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_boilerplate),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("best_fit_packing", pack_sequences),
]

#: Language models and packing have no SQL form; tests/llm checks the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each result is stored before the next reads it."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
