"""The operators of this package over the given tables, with production settings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    chat_format, decontaminate, license_scan, near_text, packing, private_data, repeated_bytes, token_count, token_files, toxicity,
    turn_repair, vector_graph, word_runs,
)
from .common import read_table


def near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_text.near_texts(read_table(spark, folder, "documents")).drop("row")


def token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_count.count_tokens(read_table(spark, folder, "documents"))


def pii(spark: SparkSession, folder: str) -> DataFrame:
    return private_data.private_data(read_table(spark, folder, "documents"))


def licenses(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.license_notices(read_table(spark, folder, "documents"))


def packed(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read_table(spark, folder, "documents"))


def repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_bytes.remove_repeats(read_table(spark, folder, "documents"))


def toxic(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    return vector_graph.near_vectors(read_table(spark, folder, "embeddings"))


def token_output(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.encode_to_files(spark, read_table(spark, folder, "documents"))


def leaks(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leaks(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


def repaired(spark: SparkSession, folder: str) -> DataFrame:
    return turn_repair.repair_report(read_table(spark, folder, "conversations"))


def formatted(spark: SparkSession, folder: str) -> DataFrame:
    return chat_format.chat_report(read_table(spark, folder, "conversations"))


def runs(spark: SparkSession, folder: str) -> DataFrame:
    return word_runs.run_report(read_table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bagminhash_dedup": near_dedup,
    "op2_transducer_token_counts": token_counts,
    "op3_skip_chain_pii": pii,
    "op4_license_scan": licenses,
    "op5_cost_balanced_packing": packed,
    "op6_suffix_array_dedup": repeats,
    "op7_string_kernel_toxicity": toxic,
    "op8_small_world_dedup": vectors,
    "op9_elias_fano_token_files": token_output,
    "op10_pigeonhole_decontamination": leaks,
    "op11_turn_repair": repaired,
    "op12_chat_parts": formatted,
    "op13_periodic_runs": runs,
}
# No entry has a DuckDB text: each needs a learned model, a tokenizer, a sketch or a graph search. The tests hold
# them against brute force, exact round trips or held-out labels.
ORACLE: dict[str, str] = {}
