"""Cost-balanced packing of token sequences."""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vocab
from .common import small_slices, text_or_empty

CAPACITY = 1024
END_ID = 0
BLOCK_PIECES = 16_384
LINEAR, QUADRATIC = 1.0, 1.0 / 512

SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
    "offset bigint, cost double"
)


def crc_of(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def piece_cost(length: int) -> float:
    """Tokens pay a linear share, and attention within the piece a quadratic one."""
    return LINEAR * length + QUADRATIC * length * length


def capacities(total: int) -> list[int]:
    """Sequence sizes that hold ``total`` tokens without padding: full ones and distinct powers of two."""
    full, rest = divmod(total, CAPACITY)
    return [CAPACITY] * full + [1 << bit for bit in range(rest.bit_length() - 1, -1, -1) if rest >> bit & 1]


def assign(lengths: list[int]) -> list[list[tuple[int, int, int]]]:
    """For each piece its parts as (sequence, offset in the piece, length).

    Pieces go in descending length to the sequence of lowest cost that still has room for them. One heap
    per number of free places keeps that search at a look over at most 1,024 heap tops. A piece that no
    sequence can take whole is cut over those with most room; the sizes add up, so every place is filled.
    """
    sizes = capacities(sum(lengths))
    heaps: list[list[tuple[float, int]]] = [[] for _ in range(CAPACITY + 1)]
    lowest = np.full(CAPACITY + 1, np.inf)

    def put(free: int, cost: float, sequence: int) -> None:
        heapq.heappush(heaps[free], (cost, sequence))
        lowest[free] = heaps[free][0][0]

    def take(free: int) -> tuple[float, int]:
        found = heapq.heappop(heaps[free])
        lowest[free] = heaps[free][0][0] if heaps[free] else np.inf
        return found

    for sequence, size in enumerate(sizes):
        put(size, 0.0, sequence)
    parts: list[list[tuple[int, int, int]]] = [[] for _ in lengths]
    later = []
    for piece in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        length = lengths[piece]
        free = length + int(lowest[length:].argmin())
        if lowest[free] == np.inf:
            later.append(piece)
            continue
        cost, sequence = take(free)
        parts[piece].append((sequence, 0, length))
        put(free - length, cost + piece_cost(length), sequence)
    free = CAPACITY
    for piece in later:
        done = 0
        while done < lengths[piece]:
            while not heaps[free]:
                free -= 1
            cost, sequence = take(free)
            length = min(free, lengths[piece] - done)
            parts[piece].append((sequence, done, length))
            if free > length:
                put(free - length, cost + piece_cost(length), sequence)
            done += length
    return parts


def pack(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """Pack every row's text (null: empty) with its end id into sequences of at most 1,024 tokens.

    Each task packs the rows of its own split in blocks, so nothing is shuffled and a block's memory is
    bounded; full pieces of long documents become sequences at once, only the ends wait for a block.
    In a block all sequences are filled to their size, 1,024 or distinct powers of two, so nothing is padded.
    A lost task is repeated on the same split and gives the same rows; give the function a written table.

    Repeated rows and repeated or null ids are packed each on its own; an empty text is its one end id; an
    empty table gives no row; columns other than doc_id and text are not read.
    """
    path = tokenizer_path or vocab.path_of("byte_bpe_50k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = vocab.byte_bpe(path).encode
        next_id = TaskContext.get().partitionId() << 40
        waiting: list[tuple] = []

        def rows_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [[]] * 8
            types = [pa.int64()] * 7 + [pa.float64()]
            names = [part.split()[0] for part in SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        def flush() -> pa.RecordBatch:
            nonlocal next_id, waiting
            used: dict[int, int] = {}
            rows = []
            parts = assign([len(w[2]) for w in waiting])
            costs: dict[int, float] = {}
            for own in parts:
                for sequence, _, length in own:
                    costs[sequence] = costs.get(sequence, 0.0) + piece_cost(length)
            for (doc, start, ids, total), own in zip(waiting, parts):
                for sequence, at, length in own:
                    offset = used.get(sequence, 0)
                    used[sequence] = offset + length
                    rows.append((doc, start + at, length, crc_of(ids[at : at + length]), total, next_id + sequence, offset, costs[sequence]))
            next_id += len(used)
            waiting = []
            return rows_of(rows)

        for batch in small_slices(batches):
            docs_in = batch.column(0).to_pylist()
            rows = []
            for doc, raw in zip(docs_in, encode(batch.column(1).to_pylist())):
                ids = np.append(np.frombuffer(raw, vocab.ID_TYPE), np.array(END_ID, vocab.ID_TYPE))
                total = len(ids)
                whole = total - total % CAPACITY
                for start in range(0, whole, CAPACITY):
                    rows.append((doc, start, CAPACITY, crc_of(ids[start : start + CAPACITY]), total, next_id, 0, piece_cost(CAPACITY)))
                    next_id += 1
                if total > whole:
                    waiting.append((doc, whole, ids[whole:].copy(), total))
            yield rows_of(rows)
            if len(waiting) >= BLOCK_PIECES:
                yield flush()
        if waiting:
            yield flush()

    return docs.select(F.col("doc_id").cast("bigint"), text_or_empty().alias("text")).mapInArrow(run, SCHEMA)
