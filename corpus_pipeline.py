"""Documents to packed training sequences: five stages, each one of the operators of ``payerscope.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from payerscope.llm.common import importable, read_table
from payerscope.llm.decontaminate import without_leaks
from payerscope.llm.near_text import without_near_copies
from payerscope.llm.packing import pack
from payerscope.llm.private_data import without_private_data
from payerscope.llm.toxicity import without_toxic
from payerscope.session import write_shared


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score rejects go."""
    return without_toxic(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    importable(spark)
    return without_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return without_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked in the texts."""
    importable(spark)
    return without_private_data(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left is packed into sequences."""
    importable(spark)
    return pack(docs)


STAGES = [
    ("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("private_data", private_data),
    ("packing", packing),
]
# Stages that learn, sketch and tokenize have no SQL form; the tests hold run() against its operators one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each result is a written table before the next stage reads it."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_shared(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
