"""Benchmark passages in documents, with edits: exact pieces first, then bit-parallel edit distance."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_slices, text_or_empty

ERROR_RATE = 0.1
MIN_ITEM_CHARS = 20
ITEMS_PER_BLOCK = 20_000
CHARS_PER_BLOCK = 8_000_000

SCHEMA = "doc_id bigint, item_id bigint, distance bigint, item_chars bigint, end bigint"


def plain(text: str) -> str:
    """Lower case with single spaces."""
    return " ".join(text.lower().split())


def pieces(text: str, budget: int) -> list[tuple[int, str]]:
    """``budget`` + 1 pieces with their places: so many edits always leave one piece untouched."""
    bounds = [len(text) * i // (budget + 1) for i in range(budget + 2)]
    return [(a, text[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]


def beside(text: str, end: int, size: int, right: int, other: str | None) -> bool:
    """Whether the neighbour of a piece that was found (``text[end - size : end]``) can be there with one edit.

    Pieces form pairs. If every pair had two edits and a last single piece one, the item would have more than
    its budget, so a match has a pair with one edit at most: one piece is whole, and of its neighbour the near
    half is in place or the far half is off by at most one letter.
    """
    if other is None:
        return True
    half = len(other) // 2
    if right:  # the neighbour stands before the piece
        start = end - size - len(other)
        if start + half >= 0 and text.startswith(other[half:], start + half):
            return True
        return any(at >= 0 and text.startswith(other[:half], at) for at in (start - 1, start, start + 1))
    if text.startswith(other[:half], end):
        return True
    return any(text.startswith(other[half:], at) for at in (end + half - 1, end + half, end + half + 1))


def at_words(text: str, start: int, end: int) -> bool:
    """Whether a stretch neither begins nor ends inside a word."""
    left = start > 0 and text[start - 1].isalnum() and text[start].isalnum()
    right = end < len(text) and text[end].isalnum() and text[end - 1].isalnum()
    return not left and not right


class EditPattern:
    """Myers' bit-parallel search: smallest edit distance of a pattern to any stretch of a text."""

    def __init__(self, pattern: str):
        self.size = len(pattern)
        self.places: dict[str, int] = {}
        for i, letter in enumerate(pattern):
            self.places[letter] = self.places.get(letter, 0) | 1 << i

    def search(self, text: str) -> tuple[int, int]:
        """(distance, end) of the best stretch of ``text``."""
        mask, top = (1 << self.size) - 1, 1 << (self.size - 1)
        plus, minus, score = mask, 0, self.size
        best, end = score, 0
        get = self.places.get
        for at, letter in enumerate(text):
            equal = get(letter, 0)
            across = ((((equal & plus) + plus) ^ plus) | equal) & mask
            up = minus | ~(across | plus) & mask
            down = plus & across
            if up & top:
                score += 1
            elif down & top:
                score -= 1
            up = up << 1 & mask
            down = down << 1 & mask
            vertical = equal | minus
            plus = (down | ~(vertical | up)) & mask
            minus = up & vertical
            if score < best:
                best, end = score, at + 1
        return best, end


class Block:
    """A bounded block of benchmark items with one automaton over all their pieces; short items are one piece."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        import ahocorasick

        self.items: dict[int, tuple[int, str, int, EditPattern | None]] = {}
        places: dict[str, list[tuple]] = {}
        for n, (item, text) in enumerate(items):
            if len(text) < MIN_ITEM_CHARS:
                self.items[n] = (item, text, 0, None)
                places.setdefault(text, []).append((n, len(text), len(text), 0, None))
                continue
            budget = int(rate * len(text))
            self.items[n] = (item, text, budget, EditPattern(text))
            cut = pieces(text, budget)
            for i, (start, piece) in enumerate(cut):
                other = cut[i ^ 1][1] if i ^ 1 < len(cut) else None
                places.setdefault(piece, []).append((n, start + len(piece), len(piece), i & 1, other))
        self.automaton = ahocorasick.Automaton()
        for piece, found in places.items():
            self.automaton.add_word(piece, found)
        if places:
            self.automaton.make_automaton()
        self.empty = not places

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item_id, distance, item length, end) of every item within its budget, once per document."""
        found = []
        if self.empty:
            return found
        starts: dict[int, list[int]] = {}
        exact: dict[int, int] = {}
        for last, places in self.automaton.iter(text):
            for n, ahead, size, right, other in places:
                if self.items[n][3] is None:
                    if n not in exact and at_words(text, last + 1 - size, last + 1):
                        exact[n] = last + 1
                elif beside(text, last + 1, size, right, other):
                    starts.setdefault(n, []).append(last + 1 - ahead)
        found.extend((self.items[n][0], 0, len(self.items[n][1]), end) for n, end in exact.items())
        for n, near in starts.items():
            item, own, budget, pattern = self.items[n]
            near.sort()
            best, end, at = budget + 1, 0, 0
            while at < len(near) and best:
                first = last = near[at]
                while at < len(near) and near[at] - last <= budget:
                    last = near[at]
                    at += 1
                low = max(0, first - budget)
                stretch = text[low : last + len(own) + budget]
                if len(stretch) < len(own) - budget:
                    continue
                distance, stop = (0, stretch.find(own) + len(own)) if own in stretch else pattern.search(stretch)
                if distance < best:
                    best, end = distance, low + stop
            if best <= budget:
                found.append((item, best, len(own), end))
        return found


def item_blocks(benchmark: DataFrame, rate: float, per_block: int) -> Iterator[list[tuple[int, str]]]:
    """Distinct items in blocks that are bounded in items and in characters (but for one longer item alone)."""
    rows = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), text_or_empty().alias("text")).distinct()
    block: list[tuple[int, str]] = []
    chars = 0
    for row in rows.toLocalIterator():
        text = plain(row["text"])
        if not text:
            continue
        if block and (len(block) == per_block or chars + len(text) > CHARS_PER_BLOCK):
            yield block
            block, chars = [], 0
        block.append((row["item_id"], text))
        chars += len(text)
    if block:
        yield block


def leaks(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, per_block: int = ITEMS_PER_BLOCK) -> DataFrame:
    """doc_id, item_id, distance, item_chars, end: each item that a document holds with at most rate x length edits.

    Texts and items are compared in lower case with single spaces. A document may have an item anywhere; edits
    are letters put in, left out or changed. An item of ``budget`` allowed edits is cut into budget + 1 pieces,
    one of which any match holds untouched; all pieces of a block of items are found in one pass, and the
    stretch around each hit is verified. The benchmark is read in blocks of ``per_block`` items; each block is
    shared with all tasks and held against all documents, so its size is bounded whatever the benchmark's.

    Null texts are empty and match nothing; items of under 20 characters are found without edits and only between
    word boundaries; repeated documents give repeated rows; several places of one item in a document give the best one.
    """
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    spark = docs.sparkSession
    found = None
    for items in item_blocks(benchmark, rate, per_block):
        shared = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block = Block(shared.value, rate)
            for batch in small_slices(batches):
                rows = []
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    rows.extend((doc, *hit) for hit in block.find(plain(text)))
                names = [part.split()[0] for part in SCHEMA.split(", ")]
                columns = list(zip(*rows)) or [[]] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

        part = source.mapInArrow(run, SCHEMA)
        found = part if found is None else found.unionByName(part)
    return found if found is not None else spark.createDataFrame([], SCHEMA)


def without_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, per_block: int = ITEMS_PER_BLOCK) -> DataFrame:
    """The rows that hold no benchmark item, each judged by its own text, all columns kept.

    A doc_id decides nothing: rows without one go if their text is contaminated, and of several rows with one id
    only those whose text is.
    """
    def holds_none(shared: Broadcast):
        @F.pandas_udf("boolean")
        def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            block = Block(shared.value, rate)
            for texts in batches:
                yield pd.Series([not block.find(plain(text)) for text in texts], dtype=bool)

        return clean(text_or_empty())

    kept = docs.withColumn("doc_id", F.col("doc_id").cast("bigint")) if "doc_id" in docs.columns else docs
    for items in item_blocks(benchmark, rate, per_block):
        kept = kept.where(holds_none(docs.sparkSession.sparkContext.broadcast(items)))
    return kept
