"""The corpus pipeline: five stages over ``documents``, each one operator of the library.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes each stage's rows as Parquet in the shared scratch folder and rereads
them for the next, so a lost executor repeats part of one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from regspark.llm.common import stored, table
from regspark.llm.decontaminate import leaked_dropped
from regspark.llm.langid import unknown_dropped
from regspark.llm.minhash import near_duplicates_dropped
from regspark.llm.packing import pack_documents
from regspark.llm.pii import masked


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a clear language go; the others stay as they are."""
    return unknown_dropped(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, similarity of 0.8 or more."""
    return near_duplicates_dropped(docs, width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return leaked_dropped(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts gives way to its kind in brackets; every document stays."""
    return masked(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of 2048."""
    return pack_documents(docs, window=2048)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]

# Trained classifiers, edit distances and token ids are beyond SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
