"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.joins import MAP_WORDS, marked
from ..session import write_shared

ROWS_AT_ONCE = 200
# Spark sends 10,000 rows to Python at once unless told otherwise; of long texts both sides then hold many MB a task.
SENT_AT_ONCE = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000")}
SALTS = 16


def importable(spark: SparkSession) -> None:
    """Lets Python workers that start from now on import this package from where the driver has it.

    Clusters ship the package with ``--py-files``; for them the added path is one more that does not exist.
    """
    small_batches(spark)
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{known}:{root}".strip(":")


def small_batches(spark: SparkSession) -> None:
    """Have rows sent to Python in batches that are small for texts too, unless the session says otherwise."""
    for key, (default, rows) in SENT_AT_ONCE.items():
        if spark.conf.get(key, default) == default:
            spark.conf.set(key, rows)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def small_slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """A batch in slices of few rows, so that Python never holds many texts at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def mix(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers (the finaliser of a common public hash)."""
    with np.errstate(over="ignore"):
        values = values ^ (values >> np.uint64(30))
        values = values * np.uint64(0xBF58476D1CE4E5B9)
        values = values ^ (values >> np.uint64(27))
        values = values * np.uint64(0x94D049BB133111EB)
        return values ^ (values >> np.uint64(31))


def only_met(table: DataFrame, keys: DataFrame, by: str) -> DataFrame:
    """Rows of ``table`` whose ``by`` is among ``keys``; rows that the bit map rules out are not shuffled."""
    return marked(table, keys, by, words=MAP_WORDS).where("met").drop("met").join(keys.select(by).distinct(), by, "left_semi").select(*table.columns)


def with_groups(table: DataFrame, groups: DataFrame, by: str, spread: tuple[str, ...] = ("row",)) -> DataFrame:
    """Left join of ``table`` to ``groups``, a written table with one row a value of ``by``.

    Rows without a group stay where they are. The others meet their group in one of 16 tasks by a hash of ``spread``,
    so a group that holds a third of all rows is not gathered in one.
    """
    flagged = marked(table, groups, by, words=MAP_WORDS)
    added = [f for f in groups.schema.fields if f.name != by]
    alone = flagged.where("NOT met").drop("met").select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in added])
    salted = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    own = [F.col(c) for c in table.columns]
    met = flagged.where("met").drop("met").withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int"))
    return alone.unionByName(met.join(salted, [by, "_salt"], "left").select(*own, *[f.name for f in added]))


def connected_components(edges: DataFrame, name: str, max_rounds: int = 60) -> DataFrame:
    """(node, component) for undirected ``edges`` (a, b); component is the smallest node that can be reached.

    A node that is the smallest of its component, or has no edge, is not listed.

    Rounds of large-star and small-star: each round points every node at the smallest node seen, so the
    number of rounds grows with the logarithm of a component's width. A hub is never gathered in one task:
    its minimum is a map-side combined aggregate and its edges are joined, where runtime planning splits
    skewed sides. Every round is a written table, so lost executors never re-run earlier rounds.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    edges = write_shared(edges, f"{name}-edges")
    before = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        down = large.where("a <> b").distinct()
        low = down.groupBy("a").agg(F.min("b").alias("low"))
        small = down.join(low, "a").select(
            F.explode(F.array(F.struct(F.col("a"), F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e")
        ).select("e.a", "e.b").where("a <> b").distinct()
        edges = write_shared(small, f"{name}-edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return edges.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("node"), "component")
