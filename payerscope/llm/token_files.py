"""Token-id files with Elias-Fano document boundaries.

A shard file holds the documents of one range of doc_id in ascending order: a header, the ids of all
documents one after the other, the boundaries as an Elias-Fano sequence, and the doc_ids. The boundary
sequence spends two bits a document plus the logarithm of the mean document length instead of 64 bits;
a sampled select directory finds any boundary with a look into one short stretch of its upper bits.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder, write_shared
from . import vocab
from .common import small_slices, text_or_empty

END_ID = 1
BYTES_PER_SHARD = 32 << 20
BYTES_PER_MARK = 2048
SAMPLE_EVERY = 256
MAGIC = b"EFTOKEN1"
HEADER = struct.Struct("<8sQQQQQQ")


class EliasFano:
    """A never-falling sequence of non-negative integers in near-minimal space, with random access."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def build(cls, values: np.ndarray) -> "EliasFano":
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        upper = (values >> np.uint64(low_bits)).astype(np.int64)
        ones = upper + np.arange(n)
        bits = np.zeros((int(ones[-1]) + 1) if n else 0, np.uint8)
        bits[ones] = 1
        parts = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1) if low_bits else np.zeros((n, 0))
        low = np.packbits(parts.astype(np.uint8).ravel(), bitorder="little")
        return cls(n, low_bits, low, np.packbits(bits, bitorder="little"), ones[::SAMPLE_EVERY].astype("<u8"))

    def _low(self, first: int, count: int) -> np.ndarray:
        """Low parts of ``count`` values from ``first`` on."""
        if not self.low_bits:
            return np.zeros(count, np.int64)
        a, b = first * self.low_bits, (first + count) * self.low_bits
        bits = np.unpackbits(self.low[a // 8 : (b + 7) // 8], bitorder="little")[a % 8 : a % 8 + b - a]
        return bits.reshape(count, self.low_bits).astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64))

    def select(self, i: int) -> int:
        """The i-th value: the place of the i-th one bit gives its upper part."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left = int(self.samples[i // SAMPLE_EVERY]), i % SAMPLE_EVERY
        byte, width = at // 8, 64
        skip = at - 8 * byte
        while True:
            ones = np.flatnonzero(np.unpackbits(self.high[byte : byte + width], bitorder="little")[skip:])
            if len(ones) > left:
                return (at + int(ones[left]) - i << self.low_bits) | int(self._low(i, 1)[0])
            width *= 4

    def block(self, first: int, count: int) -> np.ndarray:
        """Values ``first`` to ``first + count``, decoded together."""
        if count <= 0:
            return np.zeros(0, np.int64)
        k = first // SAMPLE_EVERY
        at = int(self.samples[k])
        last = (first + count - 1) // SAMPLE_EVERY + 1
        end = int(self.samples[last]) if last < len(self.samples) else 8 * len(self.high)
        byte = at // 8
        bits = np.unpackbits(self.high[byte : (end + 8) // 8], bitorder="little")
        bits[: at - 8 * byte] = 0
        ones = np.flatnonzero(bits)[first - k * SAMPLE_EVERY :][:count] + 8 * byte
        return (ones - np.arange(first, first + count) << self.low_bits) | self._low(first, count)

    def to_bytes(self) -> bytes:
        head = struct.pack("<QQQQQ", self.n, self.low_bits, len(self.low), len(self.high), len(self.samples))
        return head + self.low.tobytes() + self.high.tobytes() + self.samples.tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> "EliasFano":
        n, low_bits, a, b, c = struct.unpack_from("<QQQQQ", raw)
        low = np.frombuffer(raw, np.uint8, a, 40)
        high = np.frombuffer(raw, np.uint8, b, 40 + a)
        return cls(n, low_bits, low, high, np.frombuffer(raw, "<u8", c, 40 + a + b))


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a path: local, or any that pyarrow reaches by its scheme."""
    return fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))


class ShardWriter:
    """Writes one shard under a name of its own attempt; ``close`` gives it its final name at once."""

    def __init__(self, path: str, attempt: str):
        self.store, self.path = opened(path)
        self.draft = f"{self.path}.{attempt}"
        self.file = self.store.open_output_stream(self.draft)
        self.file.write(b"\0" * HEADER.size)
        self.lengths, self.ids, self.docs, self.nulls = [], 0, [], 0

    def add(self, doc_id: int | None, raw: bytes) -> None:
        self.file.write(raw)
        self.lengths.append(len(raw) // 2)
        self.ids += len(raw) // 2
        self.nulls += doc_id is None
        self.docs.append(0 if doc_id is None else doc_id)

    def close(self) -> None:
        bounds = EliasFano.build(np.append(0, np.cumsum(np.array(self.lengths, np.int64)))).to_bytes()
        self.file.write(bounds)
        self.file.write(np.array(self.docs, "<i8").tobytes())
        self.file.write(HEADER.pack(MAGIC, len(self.docs), self.ids, self.nulls, len(bounds), END_ID, 2))
        self.file.close()
        self.store.move(self.draft, self.path)


class ShardReader:
    """Random access to one shard: ``start(i)``, ``ids(i)`` and blocks of documents."""

    def __init__(self, path: str):
        store, where = opened(path)
        self.file = store.open_input_file(where)
        size = self.file.size()
        magic, self.docs, self.total, self.nulls, bounds, _, _ = HEADER.unpack(self._at(size - HEADER.size, HEADER.size))
        if magic != MAGIC:
            raise ValueError(f"{path} is no token-id file")
        self.first = HEADER.size
        after = self.first + 2 * self.total
        self.bounds = EliasFano.from_bytes(self._at(after, bounds))
        self._ids_of_docs = after + bounds

    def _at(self, offset: int, size: int) -> bytes:
        return self.file.read_at(size, offset)

    def doc_ids(self, first: int, count: int) -> np.ndarray:
        return np.frombuffer(self._at(self._ids_of_docs + 8 * first, 8 * count), "<i8")

    def start(self, i: int) -> int:
        return self.bounds.select(i)

    def ids(self, i: int) -> np.ndarray:
        a, b = self.bounds.select(i), self.bounds.select(i + 1)
        return np.frombuffer(self._at(self.first + 2 * a, 2 * (b - a)), vocab.ID_TYPE)


def order_key() -> list[Column]:
    """Order of rows in the files: doc_id (none first), then a hash of the text, then one of the row's place.

    So neither the rows without a doc_id nor copies of one row have to lie in one shard.
    """
    return [
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text_or_empty()).alias("print"),
        F.xxhash64(F.monotonically_increasing_id()).alias("place"),
    ]


def as_tuple(doc_id: int | None, print_: int, place: int) -> tuple:
    return (doc_id is not None, doc_id or 0, print_, place)


def shard_starts(docs: DataFrame, bytes_per_shard: int) -> list[tuple]:
    """The smallest key of every shard but the first: one key a shard comes to the driver.

    Each document stands in the range partitioning once and once more for every 2,048 bytes of its text, so
    shards get about as many bytes whatever the lengths. A document lies in one shard, so one that is longer than
    a shard makes a longer one.
    """
    weight = F.octet_length(text_or_empty()) + F.lit(8)
    marks = docs.select(*order_key(), weight.alias("weight"))
    total = docs.agg(F.sum(weight.cast("bigint"))).first()[0] or 0
    shards = max(1, -(-total // bytes_per_shard))
    if shards == 1:
        return []
    step = max(1, min(BYTES_PER_MARK, bytes_per_shard // 8))
    ranged = marks.withColumn("n", F.explode(F.expr(f"sequence(0, int(weight div {step}))"))).repartitionByRange(
        shards, F.col("doc_id").asc_nulls_first(), "print", "place"
    )
    key = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "print", "place")
    lows = ranged.groupBy(F.spark_partition_id().alias("p")).agg(F.min(key).alias("low")).select("low.*").collect()
    return sorted({as_tuple(row["doc_id"], row["print"], row["place"]) for row in lows})[1:]


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str | None = None, bytes_per_shard: int = BYTES_PER_SHARD) -> DataFrame:
    """Encode all texts and write them to ``folder`` in ascending doc_id; returns (shard, path, n_docs, n_ids, base).

    ``folder`` must be in a store that every executor reaches. Ids are encoded before they move, two bytes
    each, and move once, straight to their shard. A repeated task writes a draft of its own and renames it,
    so a lost executor leaves no half shard. Shards hold about ``bytes_per_shard`` of text. Rows with the same
    doc_id lie beside each other in the order of their texts' hashes, and may fall in several shards; rows without a
    doc_id come first. Give the function a written table: its splits must read the same twice. An empty table writes
    one empty shard at most.
    """
    path = tokenizer_path or vocab.path_of("word_bpe_49k.json")
    starts = shard_starts(docs, bytes_per_shard)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = vocab.word_bpe(path).encode
        end = np.array([END_ID], vocab.ID_TYPE).tobytes()
        for batch in small_slices(batches):
            keys = map(as_tuple, *(column.to_pylist() for column in batch.columns[:3]))
            shard = pa.array([bisect_right(starts, key) for key in keys], pa.int32())
            ids = pa.array([raw + end for raw in coder(batch.column(3).to_pylist())], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], shard, ids], names=["doc_id", "print", "place", "shard", "ids"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, name, shard = None, "", 0
        attempt = f"draft-{TaskContext.get().taskAttemptId()}"
        for batch in batches:
            for key, number, raw in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "shard", "ids"))):
                if writer is None:
                    shard, name = number, f"{folder}/shard-{number:08d}.tok"
                    writer = ShardWriter(name, attempt)
                writer.add(key, raw)
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pylist(
                [{"shard": shard, "path": name, "n_docs": len(writer.docs), "n_ids": writer.ids}],
                pa.schema([("shard", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]),
            )

    store, where = opened(folder)
    store.create_dir(where, recursive=True)
    moved = (
        docs.select(*order_key(), text_or_empty().alias("text"))
        .mapInArrow(encode, "doc_id bigint, print bigint, place bigint, shard int, ids binary")
        .repartitionById(len(starts) + 1, F.col("shard"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "print", "place")
    )
    manifest = write_shared(moved.mapInArrow(write, "shard int, path string, n_docs bigint, n_ids bigint"), "token-shards")
    rows, base, out = manifest.orderBy("shard").collect(), 0, []
    for row in rows:
        out.append((row["shard"], row["path"], row["n_docs"], row["n_ids"], base))
        base += row["n_ids"]
    return docs.sparkSession.createDataFrame(out, "shard int, path string, n_docs bigint, n_ids bigint, base bigint")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32, shard."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, name, base in zip(*(batch.column(c).to_pylist() for c in ("shard", "path", "base"))):
                file = ShardReader(name)
                for first in range(0, file.docs, 1024):
                    count = min(1024, file.docs - first)
                    bounds = file.bounds.block(first, count + 1)
                    ids = np.frombuffer(file._at(file.first + 2 * int(bounds[0]), 2 * int(bounds[-1] - bounds[0])), vocab.ID_TYPE)
                    wide = ids.astype("<u4")
                    at = (bounds - bounds[0]).tolist()
                    crc = [zlib.crc32(wide[a:b]) for a, b in zip(at[:-1], at[1:])]
                    keys = pa.array(file.doc_ids(first, count), mask=np.arange(first, first + count) < file.nulls)
                    yield pa.RecordBatch.from_arrays(
                        [keys, pa.array(bounds[:-1] + base), pa.array(np.diff(bounds)), pa.array(crc, pa.int64()),
                         pa.array(np.full(count, shard, np.int32))],
                        names=["doc_id", "start", "n_tokens", "ids_crc32", "shard"],
                    )

    n = max(1, manifest.count())
    return manifest.repartitionById(n, F.col("shard")).mapInArrow(
        read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, shard int"
    )


def encode_to_files(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Write all texts to a new folder of the shared store and read every document's digest back."""
    folder = f"{shared_folder(spark)}/token-ids-{uuid.uuid4().hex}"
    return read_token_files(write_token_files(docs, folder))
