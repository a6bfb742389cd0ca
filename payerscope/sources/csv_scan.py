"""Header CSV files as numbered rows, read by many tasks even where quoted cells hold line ends.

A file is cut at physical line ends wherever its splits end, so a task cannot know whether its first line starts
a record or lies inside a quoted cell. Each split is therefore read for both possible states: it yields the state
it ends in and the number of records that start in it, once for either. Composing these maps over the splits of a
file, in order, gives every split its true state and the number of its first record. A second pass then builds the
records; only those that cross the end of a split are put together from pieces, by their number. No row is sorted
and no file is read by one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROW = "_row"  # the number of a record over all files, from 1
LONGEST_RECORD = 64_000_000


def left_open(line: str, inside: bool) -> bool:
    """Whether the end of a physical line lies inside a quoted cell, given whether its start does.

    A quote opens a cell only as its first letter; two quotes inside a cell are one; after the closing quote the
    cell goes on to the next comma, as in the reader that takes the records apart.
    """
    at = 0
    while True:
        if not inside:
            if line.startswith('"', at):
                inside, at = True, at + 1
            else:
                at = line.find(",", at) + 1
                if at == 0:
                    return False
                continue
        at = line.find('"', at)
        if at < 0:
            return True
        if line.startswith('"', at + 1):
            at += 2
            continue
        inside, at = False, line.find(",", at + 1) + 1
        if at == 0:
            return False


class Split(NamedTuple):
    """What a split holds, and for a start outside (0) or inside (1) a cell: its end and the records that start."""

    file: str
    block: int
    ends: tuple[bool, bool]
    starts: tuple[int, int]


class Start(NamedTuple):
    """Where a split begins: inside a cell or not, the number of its first record, whether that is the header,
    and whether the record that is open there is the header."""

    inside: bool
    number: int
    header: bool
    open_header: bool


def physical_lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def splits_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.Array]]:
    """(file, block, lines) in the order of the task; one split may come in several parts that follow each other."""
    for batch in batches:
        file, block = batch.column("file"), batch.column("block")
        at = 0
        while at < batch.num_rows:
            here = (file[at].as_py(), block[at].as_py())
            same = pc.and_(pc.equal(file[at:], pa.scalar(here[0])), pc.equal(block[at:], pa.scalar(here[1])))
            stop = at + (pc.index(same, pa.scalar(False)).as_py() if not pc.all(same).as_py() else len(same))
            yield *here, batch.column("value")[at:stop]
            at = stop


def has_words(lines: pa.Array) -> pa.Array:
    """Lines that are not blank; between records blank lines are nothing, as for the plain reader."""
    return pc.greater(pc.utf8_length(pc.utf8_trim_whitespace(lines)), 0)


def summarize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per split: both ends and both numbers of starting records."""
    schema = pa.schema([
        ("file", pa.string()), ("block", pa.int64()), ("end_0", pa.bool_()), ("end_1", pa.bool_()), ("starts_0", pa.int64()),
        ("starts_1", pa.int64()),
    ])
    for (file, block), parts in groupby(splits_of(batches), key=lambda part: part[:2]):
        states, starts = [False, True], [0, 0]
        for _, _, lines in parts:
            quoted = pc.match_substring(lines, '"')
            if not pc.any(quoted).as_py():
                words = pc.sum(has_words(lines)).as_py()
                starts = [n + (0 if inside else words) for n, inside in zip(starts, states)]
                continue
            # lines without a quote leave the state as it is, so they are counted together up to the next line with one
            until = np.concatenate([[0], np.cumsum(has_words(lines).to_numpy(zero_copy_only=False))])
            at, marked = 0, np.flatnonzero(quoted.to_numpy(zero_copy_only=False)).tolist()
            for place, line in zip(marked, lines.take(pa.array(marked, pa.int64())).to_pylist()):
                for way in (0, 1):
                    starts[way] += 0 if states[way] else int(until[place + 1] - until[at])
                    states[way] = left_open(line, states[way])
                at = place + 1
            starts = [n + (0 if inside else int(until[-1] - until[at])) for n, inside in zip(starts, states)]
        yield pa.RecordBatch.from_pylist([{
            "file": file, "block": block, "end_0": states[0], "end_1": states[1], "starts_0": starts[0], "starts_1": starts[1],
        }], schema)


SUMMARY = "file string, block bigint, end_0 boolean, end_1 boolean, starts_0 bigint, starts_1 bigint"


def compose(splits: list[Split]) -> dict[tuple[str, int], Start]:
    """The state and first record number of each split; files follow each other by path, headers have no number."""
    found, number = {}, 1
    for _, blocks in groupby(sorted(splits), key=lambda s: s.file):
        inside, header_is_due, open_header = False, True, False
        for split in blocks:
            starts = split.starts[inside]
            header = header_is_due and starts > 0
            found[split.file, split.block] = Start(inside, number, header, open_header)
            number += starts - header
            header_is_due, inside = header_is_due and not header, split.ends[inside]
            open_header = inside and (header and starts == 1 if starts else open_header)
    return found


def records_of(batches: Iterator[pa.RecordBatch], starts: dict[tuple[str, int], Start]) -> Iterator[pa.RecordBatch]:
    """(number, block, record, cut): whole records, and marked as cut the pieces of those that cross a split's end."""
    schema = pa.schema([("number", pa.int64()), ("block", pa.int64()), ("record", pa.string()), ("cut", pa.bool_())])

    def batch_of(rows: list[tuple[int, int, str, bool]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)] if rows else [[]] * 4, schema=schema)

    for (file, block), parts in groupby(splits_of(batches), key=lambda part: part[:2]):
        if (file, block) not in starts:
            raise RuntimeError(f"{file} changed while it was read")
        inside, number, header, open_header = starts[file, block]
        cut, held, size, done = inside, [], 0, []  # a record that is open, and whether its head is elsewhere
        number -= 1  # of the open or last record
        for _, _, lines in parts:
            quoted = pc.match_substring(lines, '"')
            if not inside and not header and not pc.any(quoted).as_py():
                whole = pc.utf8_rtrim(lines.filter(has_words(lines)), "\r")
                numbers = pa.array(range(number + 1, number + 1 + len(whole)), pa.int64())
                number += len(whole)
                yield pa.RecordBatch.from_arrays(
                    [numbers, pa.array([block] * len(whole), pa.int64()), whole, pa.array([False] * len(whole))], schema=schema)
                continue
            for line, words, quotes in zip(lines.to_pylist(), has_words(lines).to_pylist(), quoted.to_pylist()):
                if not inside and not words:
                    continue
                if not inside:
                    number += 1
                held.append(line)
                size += len(line) + 1
                if size > LONGEST_RECORD:
                    raise ValueError(f"{file}: a record of over {LONGEST_RECORD} letters; a quote is not closed in or before record {number}")
                inside = left_open(line, inside) if quotes else inside
                if inside:
                    continue
                if header:
                    header, number = False, number - 1
                elif not (cut and open_header):
                    done.append((number, block, "\n".join(held).removesuffix("\r"), cut))
                cut, held, size = False, [], 0
            yield batch_of(done)
            done = []
        if held:
            yield batch_of([] if header or (cut and open_header) else [(number, block, "\n".join(held), True)])


def raw_records(spark: SparkSession, path: str) -> DataFrame:
    """(``ROW``, record): the text of each record without the headers, numbered in the order of files and lines.

    The summaries, one row per split, meet on the driver and go back as a broadcast value: some tens of bytes for
    each split of the size of ``spark.sql.files.maxPartitionBytes``.
    """
    lines = physical_lines(spark, path)
    found = lines.mapInArrow(summarize, SUMMARY).collect()
    starts = spark.sparkContext.broadcast(compose([
        Split(r.file, r.block, (r.end_0, r.end_1), (r.starts_0, r.starts_1)) for r in found
    ]))
    records = lines.mapInArrow(lambda batches: records_of(batches, starts.value), "number bigint, block bigint, record string, cut boolean")
    pieces = records.where("cut").groupBy("number").agg(F.sort_array(F.collect_list(F.struct("block", "record"))).alias("pieces"))
    joined = pieces.select("number", F.regexp_replace(F.array_join("pieces.record", "\n"), "\r$", "").alias("record"))
    return records.where("not cut").select("number", "record").unionByName(joined).withColumnRenamed("number", ROW)


def header_of(spark: SparkSession, path: str) -> list[str]:
    """The header of the first file; only its start is read."""
    return spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path).columns


def scan_records(spark: SparkSession, path: str) -> DataFrame:
    """A header CSV, all text, with the number of each record in ``ROW``. Quoted cells may hold line ends."""
    names = header_of(spark, path)
    if not names:
        raise ValueError(f"{path} has no header")
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    cells = F.from_csv("record", schema, {"escape": '"', "multiLine": "true", "maxCharsPerColumn": "-1"})
    parsed = raw_records(spark, path).select(ROW, cells.alias("cells"))
    return parsed.select(*[F.col(f"cells.c{i}").alias(name) for i, name in enumerate(names)], ROW)
