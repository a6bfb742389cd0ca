"""Joins that leave the rows which meet nothing where they are, and join sides that are too long to broadcast."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAP_WORDS = 1 << 20
# Rows of a dimension that Spark may broadcast if its files are small enough: some 100 MB as a hash table of ten columns.
BROADCAST_ROWS = 500_000


def bounded(table: DataFrame, rows: int | None = None) -> DataFrame:
    """A table whose rows are quickly counted, as a join side that is broadcast only if it has at most ``rows`` rows.

    Spark tells by the bytes of the files, which hold numbers and repeated texts in a small part of what they take as a
    hash table on the driver; a longer table is merged, whichever of its columns a join reads.
    """
    return table if table.count() <= (BROADCAST_ROWS if rows is None else rows) else table.hint("merge")


def marked(table: DataFrame, keys: DataFrame, by: str, flag: str = "met", words: int = MAP_WORDS) -> DataFrame:
    """``table`` with a boolean ``flag`` that is false only where the value of ``by`` is surely not among ``keys``.

    The keys set bits of a map of 2^26 bits, kept as at most 2^20 rows of 64, so what is broadcast has a fixed bound
    whatever the data. Rows that are not marked need not be shuffled to find out that nothing joins them; a map that
    fills up marks more rows than it must, and the join that follows decides. Nulls are not marked.
    """
    def place(column: Column) -> tuple[Column, Column]:
        bit = F.pmod(F.xxhash64(column), F.lit(64 * words))
        return F.shiftright(bit, 6).cast("int"), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit.bitwiseAND(F.lit(63)).cast("int"))

    word, mask = place(F.col(by))
    bits = keys.where(F.col(by).isNotNull()).select(word.alias("_word"), mask.alias("_mask")).groupBy("_word").agg(F.bit_or("_mask").alias("_bits"))
    met = F.col(by).isNotNull() & (F.col("_bits").bitwiseAND(mask) != 0)
    joined = table.withColumn("_word", word).join(F.broadcast(bits), "_word", "left")
    return joined.withColumn(flag, F.coalesce(met, F.lit(False))).drop("_word", "_bits")


def left_join_rare(table: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of ``table`` to ``groups``, a written table with few of the values of ``keys``, one row each.

    A row that the bit map rules out gets nulls and is not shuffled; what is left joins by the keys themselves.
    A missing key meets nothing.
    """
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    key_print = F.when(known, F.xxhash64(*keys)).alias("_print")
    flagged = marked(table.select("*", key_print), groups.select(key_print), "_print").drop("_print")
    added = [f for f in groups.schema.fields if f.name not in keys]
    alone = flagged.where("NOT met").drop("met").select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in added])
    met = flagged.where("met").drop("met").join(groups, list(keys), "left")
    return alone.unionByName(met.select(*alone.columns))
