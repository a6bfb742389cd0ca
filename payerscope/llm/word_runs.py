"""Periodic runs of words by string synchronising sets.

A run is a stretch of words with smallest period q and at least max(6, 4 * q) words that neither neighbour
extends. Runs with periods in [t, 2t) are looked for at the dyadic scale t:

* a window of t words is *highly periodic* if its period is at most t / 4; such windows lie inside runs that
  smaller scales have found, and they are left out;
* a position is *chosen* if, among the other windows that start within the next t words, the window at the
  position or the one t words on has the least hash. The choice depends on the next 2t words alone, so equal
  contexts are chosen alike;
* the windows of a run with period in [t, 2t) are not all highly periodic, so one of its first t positions is
  chosen, and so is the position one period on. Nothing between them has the same context of 2t words (it would
  give the run a smaller period), so neighbours in the list of equal contexts propose exactly the period.

A proposal is then extended word by word, so hashes never decide that two words are equal. Periods under the first
scale are compared directly. Work: O(n log n) hashes per scale, all on arrays, and O(n) words of extension.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import importable, mix, text_or_empty

FIRST_SCALE = 8
LEAST_WORDS = 6
LEAST_POWER = 4
WORDS_AT_ONCE = 200_000
NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)
RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])


def stretches(equal: np.ndarray, least: int) -> Iterator[tuple[int, int]]:
    """Maximal stretches of true values with at least ``least`` of them."""
    edges = np.flatnonzero(np.diff(equal.astype(np.int8), prepend=0, append=0))
    starts, stops = edges[0::2], edges[1::2]
    long = stops - starts >= least
    return zip(starts[long].tolist(), stops[long].tolist())


def smaller_period(words: np.ndarray, start: int, stop: int, period: int) -> bool:
    """Whether a stretch of at least two periods also has a proper divisor of its period."""
    rest, factor = period, 2
    while rest > 1:
        if rest % factor:
            factor += 1
            continue
        while rest % factor == 0:
            rest //= factor
        shorter = period // factor
        if np.array_equal(words[start:stop - shorter], words[start + shorter:stop]):
            return True
    return False


def extended(words: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """The maximal stretch around ``at`` in which words ``period`` apart are equal."""
    stop, end = at, len(words) - period
    while stop < end:
        upto = min(end, stop + 4 * period)
        differs = words[stop:upto] != words[stop + period:upto + period]
        if differs.any():
            stop += int(differs.argmax())
            break
        stop = upto
    start = at
    while start > 0:
        least = max(0, start - 4 * period)
        differs = (words[least:start] != words[least + period:start + period])[::-1]
        if differs.any():
            start -= int(differs.argmax())
            break
        start = least
    return start, stop + period


def least_of_next(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` + 1 values that follow one another; ``width`` is a power of two."""
    size = 1
    while size < width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[:-1], values[1:])


def chosen_positions(prints: np.ndarray, scale: int, regions: list[tuple[int, int, int]]) -> np.ndarray:
    """The synchronising set at a scale; ``prints`` are hashes of the windows of that many words."""
    ids = mix(prints + np.uint64(scale))
    ids[ids == NEVER] = 0
    for start, stop, period in regions:
        if 4 * period <= scale <= stop - start:
            ids[start:stop - scale + 1] = NEVER
    least = least_of_next(ids, scale)
    here, ahead = ids[:len(least)], ids[scale:scale + len(least)]
    return np.flatnonzero((least != NEVER) & ((least == here) | (least == ahead)))


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of windows from those of their two halves."""
    with np.errstate(over="ignore"):
        return mix(left * np.uint64(0x9E3779B97F4A7C15) + right + np.uint64(1))


def proposed(prints: np.ndarray, scale: int, regions: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """(period, position) of neighbours with one context whose distance lies in [scale, 2 * scale)."""
    places = chosen_positions(prints, scale, regions)
    context = joined(prints[places], prints[places + scale])
    order = np.argsort(context, kind="stable")
    places, context = places[order], context[order]
    apart = np.diff(places)
    hit = (context[1:] == context[:-1]) & (apart >= scale) & (apart < 2 * scale)
    return sorted(zip(apart[hit].tolist(), places[:-1][hit].tolist()))


def runs_of(words: np.ndarray, longest: int | None = None) -> list[tuple[int, int, int]]:
    """All runs (start, stop, period) of an array of word numbers. No run is longer than ``longest`` words."""
    longest = len(words) if longest is None else longest
    found: list[tuple[int, int, int]] = []
    for period in range(1, FIRST_SCALE):
        least = max(LEAST_WORDS, LEAST_POWER * period)
        if longest < least:
            return found
        for start, stop in stretches(words[:-period] == words[period:], least - period):
            if not smaller_period(words, start, stop + period, period):
                found.append((start, stop + period, period))
    prints, size, scale = mix(words.astype(np.uint64) + np.uint64(1)), 1, FIRST_SCALE
    while LEAST_POWER * scale <= longest:
        while size < scale:
            prints, size = joined(prints[:-size], prints[size:]), size * 2
        known = (0, 0, 0)
        for period, at in proposed(prints, scale, found):
            if known[2] == period and known[0] <= at and at + period < known[1]:
                continue
            start, stop = extended(words, at, period)
            known = (start, stop, period)
            if stop - start >= LEAST_POWER * period and not smaller_period(words, start, stop, period):
                found.append(known)
        scale *= 2
    return found


def runs_of_texts(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of several texts, each a list of words, by start, then period."""
    number: dict[bytes, int] = {}
    pieces, offsets, at = [], [], 0
    for place, words in enumerate(texts):
        offsets.append(at)
        pieces += [number.setdefault(w, len(number)) for w in words]
        pieces.append(-1 - place)  # a word of its own, so that no run leaves its text
        at += len(words) + 1
    result: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, stop, period in runs_of(np.array(pieces, dtype=np.int64), max(map(len, texts), default=0)):
        text = int(np.searchsorted(offsets, start, side="right")) - 1
        result[text].append((start - offsets[text], stop - start, period))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in result]


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), dtype=bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()]


def groups_of_texts(texts: list[list[bytes]]) -> Iterator[list[int]]:
    """Numbers of texts to treat together: long ones alone, so that only they pay for large scales."""
    small, held = [], 0
    for place, words in enumerate(texts):
        if len(words) * 20 > WORDS_AT_ONCE:
            yield [place]
            continue
        small.append(place)
        held += len(words)
        if held > WORDS_AT_ONCE:
            yield small
            small, held = [], 0
    yield small


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for every row: its runs of words and its text without their repeats.

    Words are what ASCII white space separates, compared byte by byte; ``collapsed`` joins the kept words with one
    space. Each row stands for itself, so copies and repeated or missing ids need no care. A missing or empty text
    has no words, no runs and an empty ``collapsed``. Columns other than doc_id and text are neither read nor kept.
    """
    importable(docs.sparkSession)
    key = docs.schema["doc_id"].dataType
    schema = T.StructType([
        T.StructField("doc_id", key), T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)),
        T.StructField("collapsed", T.StringType()),
    ])
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts = [text.encode().split() for text in part.column("text").to_pylist()]
                runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
                for group in groups_of_texts(texts):
                    for place, found in zip(group, runs_of_texts([texts[i] for i in group])):
                        runs[place] = found
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array(map(len, texts), pa.int64()),
                    pa.array([[dict(zip(("start", "length", "period"), r)) for r in found] for found in runs], run_type),
                    pa.array([b" ".join(kept_words(w, r)).decode() for w, r in zip(texts, runs)], pa.string()),
                ], names=["doc_id", "n_words", "runs", "collapsed"])

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(find, schema)


def with_planted_tails(docs: DataFrame) -> DataFrame:
    """Documents in which one id in ten has its last words replaced by repeats of a stretch of them.

    The id alone says which document and where; a document without an id or without words stays as it is.
    """
    words = F.filter(F.split(text_or_empty(), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    prepared = docs.select("doc_id", text_or_empty().alias("text"), F.crc32(F.col("doc_id").cast("string")).alias("_h"))
    planted = prepared.withColumn("_words", F.when(F.col("_h") % 10 == 0, words))
    n, g = F.nullif(F.size("_words"), F.lit(0)), F.floor(F.col("_h") / 10)
    repeated = F.expr("transform(sequence(0, n - 1), i -> _words[cast(if(i < a, i, a + (i - a) % p) as int)])")
    planted = planted.withColumn("n", n).withColumn("a", g % F.col("n")).withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + g % 8)))
    return planted.select("doc_id", F.when(F.col("n").isNotNull(), F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


def run_report(docs: DataFrame) -> DataFrame:
    """One row per document: count, greatest run and digests of its runs and of its collapsed text."""
    found = periodic_runs(with_planted_tails(docs))
    best = F.expr("array_max(transform(runs, r -> struct(r.length, -r.start as start, -r.period as period)))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    return found.withColumn("_best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("_best.start")).alias("start"), F.col("_best.length").alias("length"), (-F.col("_best.period")).alias("period"),
        F.expr("1000 * _best.length div -_best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words",
    )
