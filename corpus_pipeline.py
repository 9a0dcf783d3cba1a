"""Corpus pipeline: raw documents to packed training sequences, a stage at a time.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor
kept, and returns a DataFrame that is written as Parquet to the shared folder
and read again as the next stage's documents.  All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from webfold.llm.common import shared_folder, table
from webfold.llm.decontaminate import drop_leaks
from webfold.llm.exact_dedup import drop_copies
from webfold.llm.packing import pack
from webfold.llm.queries import TOKENIZER
from webfold.llm.set_join import drop_near_copies
from webfold.llm.toxicity import drop_toxic


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id stays."""
    return drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles (similarity 0.8 or more), the smallest id stays."""
    return drop_near_copies(docs)


def leak_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item go."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as pieces placed in sequences of 1024 tokens."""
    return pack(docs, TOKENIZER)


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("decontamination", leak_stage),
    ("packing", packing_stage),
]

#: Training a model and tokenising can't be said in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
