"""What the two operators over conversations share: rows in order, streamed conversation by conversation."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_AT_ONCE = 2000


def rows_of(batches: Iterator[pa.RecordBatch], rows: int = ROWS_AT_ONCE) -> Iterator[dict]:
    """The rows of Arrow batches, few of them in Python at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield from batch.slice(at, rows).to_pylist()


def conversations_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[dict]]]:
    """(conv_id, its rows) of sorted batches. The rows are a stream: a conversation of any length takes no memory."""
    return groupby(rows_of(batches), key=itemgetter("conv_id"))


def in_batches(rows: Iterator[dict], schema: pa.Schema, size: int = 500) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    yield pa.RecordBatch.from_pylist(held, schema)


def together(rows: DataFrame, order: list[str]) -> DataFrame:
    """The rows of one conversation in one partition and in order, to be streamed; Spark's sort spills."""
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *order)


class Digest:
    """SHA-256 and length in code points of texts that come one after another."""

    def __init__(self):
        self._sha, self.chars = hashlib.sha256(), 0

    def add(self, text: str) -> None:
        self._sha.update(text.encode())
        self.chars += len(text)

    def hex(self) -> str:
        return self._sha.hexdigest()


def fold_pieces(
    pieces: DataFrame, whole: str, order: list[str], fold: Callable[[object, Iterator[dict]], dict], schema: T.StructType
) -> DataFrame:
    """One row per conversation folded from its pieces in order.

    A piece that is marked as a whole conversation is folded where it lies; only the pieces of conversations that
    were cut are moved. A digest of a conversation is one pass over its text, so a cut one is streamed by one task.
    """
    arrow = pa.schema([(f.name, {"bigint": pa.int64(), "string": pa.string()}[f.dataType.simpleString()]) for f in schema])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return in_batches((fold(row["conv_id"], iter([row])) for row in rows_of(batches, 200)), arrow)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return in_batches((fold(key, rows) for key, rows in groupby(rows_of(batches, 20), key=itemgetter("conv_id"))), arrow)

    alone, parts = pieces.where(F.col(whole)), pieces.where(~F.col(whole))
    return alone.mapInArrow(each, schema).unionByName(together(parts, order).mapInArrow(cut, schema))
