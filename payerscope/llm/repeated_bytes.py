"""Long repeated byte strings by a logarithmic family of sparse suffix arrays."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import write_shared
from .common import marked, mix, only_met, small_slices, text_or_empty, with_groups
from .near_text import powers

MATCH = 400
ANCHOR = 32
REACH = MATCH - ANCHOR + 1
LOOK = 1 << 20
SHARED_BY = 4_000
BATCHES = 8
ROWS_PER_PART = 20_000
BASE = np.uint64(0x9E3779B97F4A7C15)
SECOND = np.uint64(0xD1342543DE82EF95)


class RollingHash:
    """Hashes of all stretches of one length, from running sums modulo 2^64."""

    def __init__(self):
        self.up, self.down = powers(1 << 16)

    def sums(self, raw: np.ndarray) -> np.ndarray:
        if len(raw) >= len(self.up):
            self.up, self.down = powers(2 * len(raw))
        values = mix(raw.astype(np.uint64) + SECOND)
        out = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(values * self.up[: len(raw)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, starts: np.ndarray, length) -> np.ndarray:
        return mix((sums[starts + length] - sums[starts]) * self.down[starts])


def segments(raw: np.ndarray, rolling: RollingHash) -> tuple[np.ndarray, ...]:
    """(anchor, first, last, key, mark): every 400-byte window of a text belongs to one anchor in it.

    A window's anchor is its 32-byte stretch of smallest hash, the leftmost of equals, so equal windows have
    equal anchors at equal places. Windows ``first`` to ``last`` have the same anchor; ``mark`` is a print of
    the bytes that they cover. About one place in 185
    is an anchor, so the suffixes that start at anchors stand for all suffixes of the text.
    """
    n = len(raw) - MATCH + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    anchors, firsts, lasts, keys, marks = [], [], [], [], []
    for at in range(0, n, LOOK - MATCH):
        to = min(n, at + LOOK - MATCH)
        piece = raw[at : to + MATCH - 1]
        sums = rolling.sums(piece)
        hashes = rolling.of(sums, np.arange(len(piece) - ANCHOR + 1), ANCHOR)
        ranked = (hashes & ~np.uint64(LOOK - 1)) | np.arange(len(hashes), dtype=np.uint64)
        low = (sliding_minimum(ranked, REACH) & np.uint64(LOOK - 1)).astype(np.int64)
        cut = np.flatnonzero(np.diff(low)) + 1
        first = np.concatenate(([0], cut))
        anchors.append(low[first] + at)
        firsts.append(first + at)
        last = np.concatenate((cut, [len(low)])) - 1
        lasts.append(last + at)
        keys.append(hashes[low[first]])
        marks.append(mix(rolling.of(sums, first, last - first + MATCH) + (low[first] - first).astype(np.uint64)))
    return tuple(np.concatenate(x) for x in (anchors, firsts, lasts, keys, marks))


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours: the better of a running minimum from each side of a block edge."""
    n = len(values)
    full = -(-n // width) * width
    padded = np.full(full, np.iinfo(np.uint64).max)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


class SuffixArrays:
    """A family of sorted arrays of suffixes whose sizes are powers of the batch size.

    A suffix is ordered by a 128-bit print of its first 400 bytes: matches shorter than that are of no
    use, so suffixes that share them stand together and others in any fixed order. A new batch is sorted,
    merge-scanned against each level for suffixes that both hold, and becomes a level; two levels of equal
    rank are merged into one of the next.
    """

    def __init__(self):
        self.levels: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.repeated: list[np.ndarray] = []

    def add(self, suffixes: np.ndarray, owners: np.ndarray) -> None:
        """``suffixes``: prints (two numbers each); ``owners``: numbers of the windows they start."""
        order = np.argsort(suffixes, order=("a", "b"))
        batch = suffixes[order], owners[order]
        same = batch[0][1:] == batch[0][:-1]
        self.repeated += [batch[1][1:][same], batch[1][:-1][same]]
        for level in self.levels.values():
            left = np.searchsorted(level[0]["a"], batch[0]["a"], side="left")
            right = np.searchsorted(level[0]["a"], batch[0]["a"], side="right")
            met = right > left
            spread = right[met] - left[met]
            place = np.repeat(left[met], spread) + np.arange(spread.sum()) - np.repeat(np.cumsum(spread) - spread, spread)
            own = np.repeat(np.flatnonzero(met), spread)
            equal = level[0]["b"][place] == batch[0]["b"][own]
            self.repeated += [batch[1][own[equal]], level[1][place[equal]]]
        once = np.concatenate(([True], ~same)) if len(same) or len(order) else np.zeros(0, bool)
        batch = batch[0][once], batch[1][once]  # one of equal suffixes is enough to meet later ones
        rank = 0
        while rank in self.levels:
            other = self.levels.pop(rank)
            merged = np.concatenate((other[0], batch[0]))
            order = np.argsort(merged, order=("a", "b"), kind="stable")
            batch = merged[order], np.concatenate((other[1], batch[1]))[order]
            same = np.concatenate(([False], batch[0][1:] == batch[0][:-1]))
            batch = batch[0][~same], batch[1][~same]
            rank += 1
        self.levels[rank] = batch


PRINT = np.dtype([("a", np.uint64), ("b", np.uint64)])


def window_prints(raw: np.ndarray, starts: np.ndarray, rolling: RollingHash) -> np.ndarray:
    sums = rolling.sums(raw)
    out = np.empty(len(starts), PRINT)
    out["a"] = rolling.of(sums, starts, MATCH)
    half = MATCH // 2
    out["b"] = mix(rolling.of(sums, starts, half) * BASE + rolling.of(sums, starts + half, half))
    return out


def stretches_of(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """key, mark and the stretch of text that each wanted segment's windows cover."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches, 50):
            keys, marks, found = [], [], []
            for text, parts in zip(batch.column("text").to_pylist(), batch.column("parts").to_pylist()):
                raw = text.encode("utf-8", "surrogatepass")
                for part in parts:
                    keys.append(part["key"]), marks.append(part["mark"])
                    found.append(raw[part["first"] : part["last"] + MATCH])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(marks, pa.int64()), pa.array(found, pa.binary())], names=["key", "mark", "stretch"]
            )

    return with_parts(texts, wanted, ("first", "last", "key", "mark")).mapInArrow(run, "key bigint, mark bigint, stretch binary")


def with_parts(texts: DataFrame, wanted: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """print, text and parts, the wanted segments of it, for the texts that have some; no other text is moved."""
    parts = write_shared(wanted.groupBy("print").agg(F.collect_list(F.struct(*columns)).alias("parts")), "repeat-parts")
    return marked(texts.select("print", "text"), parts, "print").where("met").drop("met").join(parts, "print")


def text_segments(texts: DataFrame) -> DataFrame:
    """print, first, last, anchor (its distance from first), key and mark of every segment of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = RollingHash()
        for batch in small_slices(batches, 50):
            names, found = [], []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                parts = segments(np.frombuffer(text, np.uint8), rolling)
                names.extend([name] * len(parts[0]))
                found.append(parts)
            anchor, first, last, key, mark = (np.concatenate(x) for x in zip(*found))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.binary()), pa.array(first), pa.array(last), pa.array(anchor - first),
                 pa.array(key.view(np.int64)), pa.array(mark.view(np.int64))],
                names=["print", "first", "last", "anchor", "key", "mark"],
            )

    return texts.where(F.octet_length("text") >= MATCH).select("print", "text").mapInArrow(
        run, "print binary, first bigint, last bigint, anchor bigint, key bigint, mark bigint"
    )


def halved(stretches: DataFrame, texts: DataFrame, span: int) -> DataFrame:
    """Segments cut in two by their windows' distance from the anchor, with keys and marks of their own.

    The new key is the print of the bytes that all windows of that range of distances share, so equal windows
    keep equal keys. In the end a segment is one window and its key the window itself. ``home_key`` and ``home_mark``
    name the stretch of a text that a piece was cut from, ``shift`` says how far from its start.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["print", "first", "last", "anchor", "key", "mark", "home_key", "home_mark", "shift"]
        for batch in small_slices(batches, 50):
            rows: list[tuple] = []
            for name, text, parts in zip(*(batch.column(c).to_pylist() for c in ("print", "text", "parts"))):
                raw = text.encode("utf-8", "surrogatepass")
                for part in parts:
                    place = part["first"] + part["anchor"]
                    for far in range((place - part["last"]) // span, (place - part["first"]) // span + 1):
                        first = max(part["first"], place - far * span - span + 1)
                        last = min(part["last"], place - far * span)
                        core = raw[max(0, place - far * span) : place - far * span - span + 1 + MATCH]
                        key = hashlib.blake2b(core + b"%d.%d" % (span, far), digest_size=8).digest()
                        mark = hashlib.blake2b(raw[first : last + MATCH] + b"%d" % (place - first), digest_size=8).digest()
                        key, mark = (int.from_bytes(x, "little", signed=True) for x in (key, mark))
                        shift = part["shift"] + first - part["first"]
                        rows.append((name, first, last, place - first, key, mark, part["home_key"], part["home_mark"], shift))
            values = list(zip(*rows)) or [()] * len(names)
            types = (pa.binary(), *[pa.int64()] * 8)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], names=names)

    return with_parts(texts, stretches, ("first", "last", "anchor", "home_key", "home_mark", "shift")).mapInArrow(
        run, "print binary, first bigint, last bigint, anchor bigint, key bigint, mark bigint, home_key bigint, home_mark bigint, shift bigint"
    )


def distinct_stretches(parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The distinct stretches of all keys that come up twice, and those keys that have several stretches.

    Stretches: key, mark, places (how often it comes up) and where it first does. Keys: key and n, their stretches.
    Keys are counted on their own first, so segments whose key comes up once, most of all, are not shuffled.
    """
    twice = write_shared(parts.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "repeat-keys")
    again = marked(parts, twice, "key").where("met").drop("met")
    where = F.struct(*[c for c in parts.columns if c not in ("key", "mark")])
    stretches = again.groupBy("key", "mark").agg(F.count("*").alias("places"), F.min(where).alias("at"))
    stretches = write_shared(stretches.select("key", "mark", "places", "at.*"), "repeat-stretches")
    keys = stretches.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    return stretches, write_shared(keys, "repeat-several")


def repeated_windows(stretches: DataFrame) -> DataFrame:
    """key, mark, low, high: runs of windows of each distinct stretch that another stretch of its key holds too.

    ``stretches`` has (bucket, batch, key, mark, stretch) with a bucket's batches in order. A task keeps the suffix
    arrays of one bucket; all stretches of a key are in one bucket, so equal windows always meet.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = RollingHash()

        def index(family: SuffixArrays, pieces: list[bytes], base: int) -> int:
            raw = np.frombuffer(b"".join(pieces), np.uint8)
            sizes = np.array([len(p) for p in pieces], np.int64)
            windows = sizes - MATCH + 1
            offset = np.repeat(np.cumsum(sizes) - sizes, windows)
            starts = offset + np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
            family.add(window_prints(raw, starts, rolling), base + np.arange(len(starts)))
            return base + len(starts)

        def close(family: SuffixArrays, names: list[tuple[int, int]], windows: list[int]) -> pa.RecordBatch:
            total = sum(windows)
            hit = np.zeros(total + 1, bool)
            for numbers in family.repeated:
                hit[numbers] = True
            keys, marks, lows, highs = [], [], [], []
            bounds = np.cumsum([0, *windows])
            edge = np.flatnonzero(np.diff(np.concatenate(([False], hit)).astype(np.int8)))
            owner = np.searchsorted(bounds, edge[::2], side="right") - 1
            for i, a, b in zip(owner.tolist(), edge[::2].tolist(), edge[1::2].tolist()):
                while a < b:  # a run may go on into the next stretch
                    to = min(b, int(bounds[i + 1]))
                    if to > a:
                        keys.append(names[i][0]), marks.append(names[i][1]), lows.append(a - int(bounds[i])), highs.append(to - 1 - int(bounds[i]))
                    a, i = to, i + 1
            return pa.RecordBatch.from_arrays(
                [pa.array(v, pa.int64()) for v in (keys, marks, lows, highs)], names=["key", "mark", "low", "high"]
            )

        bucket, family, names, windows, pieces, held, base = None, SuffixArrays(), [], [], [], None, 0
        for batch in batches:
            for number, part, key, mark, stretch in zip(*(batch.column(c).to_pylist() for c in ("bucket", "batch", "key", "mark", "stretch"))):
                if (number, part) != (bucket, held) and pieces:
                    base = index(family, pieces, base)
                    pieces = []
                if number != bucket:
                    if names:
                        yield close(family, names, windows)
                    bucket, family, names, windows, base = number, SuffixArrays(), [], [], 0
                held = part
                pieces.append(stretch), names.append((key, mark)), windows.append(len(stretch) - MATCH + 1)
        if pieces:
            index(family, pieces, base)
        if names:
            yield close(family, names, windows)

    return stretches.mapInArrow(run, "key bigint, mark bigint, low bigint, high bigint")


def cut_texts(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """print, n_removed, n_spans, kept_sha256 of each text that has repeated windows (low, high)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches, 50):
            removed, spans_, shas = [], [], []
            for text, parts in zip(*(batch.column(c).to_pylist() for c in ("text", "parts"))):
                raw = text.encode("utf-8", "surrogatepass")
                cover = sorted((p["low"], p["high"] + MATCH) for p in parts)
                digest, gone, count, kept_to, end = hashlib.sha256(), 0, 0, 0, -1
                for low, high in cover:
                    if low > end:
                        digest.update(raw[kept_to:low])
                        count += 1
                        gone += high - low
                        end = high
                    elif high > end:
                        gone += high - end
                        end = high
                    kept_to = max(kept_to, end)
                digest.update(raw[kept_to:])
                removed.append(gone), spans_.append(count), shas.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("print"), pa.array(removed, pa.int64()), pa.array(spans_, pa.int64()), pa.array(shas, pa.string())],
                names=["print", "n_removed", "n_spans", "kept_sha256"],
            )

    return with_parts(texts, spans, ("low", "high")).mapInArrow(run, "print binary, n_removed bigint, n_spans bigint, kept_sha256 string")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for each row, repeated 400-byte strings taken out.

    1. Equal texts become one with a number of copies; a text of 400 bytes or more with copies goes whole.
    2. Each window's anchor names the segment it lies in; only segments whose anchor's key comes up in two
       places can hold repeated windows. Keys are counted with map-side combining.
    3. Equal stretches of a key are one row. One that comes up twice is repeated as a whole; a key with a single
       stretch needs no search. Stretches of keys with over 4,000 are halved, with longer keys, until no key has
       more, so no task gets a hot passage.
    4. The stretches of the other keys are read from one text each and searched, in buckets of keys, by a logarithmic
       family of suffix arrays, batch by batch.
    5. Repeated windows go back to their texts, which are cut and hashed. Texts without any are hashed where they are.

    Null texts are empty, texts under 400 bytes stay as they are, repeated rows are copies of each other
    whatever their ids, and an empty table gives no row.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    rows = rows.withColumn("print", F.unhex(F.md5(F.col("text").cast("binary"))))
    copied = write_shared(rows.groupBy("print").agg(F.count("*").alias("copies")).where("copies > 1"), "repeat-copied")
    long = marked(rows.where(F.octet_length("text") >= MATCH), copied, "print")
    several = long.where("met").groupBy("print").agg(F.any_value("text").alias("text"), F.count("*").alias("copies"))
    texts = long.where("NOT met").select("print", "text", F.lit(1).cast("bigint").alias("copies")).unionByName(several)
    texts = write_shared(texts, "repeat-texts")
    found = write_shared(text_segments(texts), "repeat-segments")

    def whole(stretches: DataFrame) -> DataFrame:
        return stretches.where("places > 1").select("key", "mark", F.lit(0).cast("bigint").alias("low"), (F.col("last") - F.col("first")).alias("high"))

    stretches, keys = distinct_stretches(found)
    stretches = stretches.select("*", F.col("key").alias("home_key"), F.col("mark").alias("home_mark"), F.lit(0).cast("bigint").alias("shift"))
    known = whole(stretches)
    wanted = only_met(stretches, keys.where(f"n <= {SHARED_BY}"), "key")
    hot, span = keys.where(f"n > {SHARED_BY}"), 256
    pieces, waiting = None, not hot.isEmpty()
    while waiting:
        parts = write_shared(halved(only_met(stretches, hot, "key"), texts, span), "repeat-halves")
        stretches, keys = distinct_stretches(parts)
        small = F.lit(True) if span == 1 else F.col("n") <= SHARED_BY
        homes = parts.select("key", "mark", "home_key", "home_mark", "shift")
        pieces = homes if pieces is None else pieces.unionByName(homes)
        known = known.unionByName(whole(stretches))
        wanted = wanted.unionByName(only_met(stretches, keys.where(small), "key"))
        hot, span = keys.where(~small), span // 2
        waiting = span >= 1 and not hot.isEmpty()
    distinct = write_shared(stretches_of(texts, wanted), "repeat-distinct")
    parts = max(8, -(-distinct.count() // ROWS_PER_PART))
    dealt = distinct.select(
        F.pmod(F.xxhash64("key"), F.lit(4 * parts)).cast("int").alias("bucket"), F.pmod(F.xxhash64("mark"), F.lit(BATCHES)).cast("int").alias("batch"), "key", "mark", "stretch"
    ).repartition(parts, "bucket").sortWithinPartitions("bucket", "batch", "key", "mark")
    runs = write_shared(repeated_windows(dealt).unionByName(known), "repeat-runs")
    if pieces is not None:
        at_home = marked(pieces, runs, "key").where("met").join(runs, ["key", "mark"]).select(
            F.col("home_key").alias("key"), F.col("home_mark").alias("mark"), (F.col("low") + F.col("shift")).alias("low"), (F.col("high") + F.col("shift")).alias("high")
        )
        runs = runs.unionByName(at_home)
    name = F.struct("key", "mark").alias("stretch")
    runs = write_shared(runs.groupBy(name).agg(F.collect_set(F.struct("low", "high")).alias("runs")), "repeat-runs-by-stretch")
    placed = with_groups(found.select("print", "first", name), runs, "stretch", ("print", "first")).where("runs IS NOT NULL")
    spans = placed.select("print", "first", F.explode("runs").alias("run")).select(
        "print", (F.col("first") + F.col("run.low")).alias("low"), (F.col("first") + F.col("run.high")).alias("high")
    )
    gone = texts.where("copies > 1").select(
        "print", F.octet_length("text").cast("bigint").alias("n_removed"), F.lit(1).cast("bigint").alias("n_spans"), F.sha2(F.lit(""), 256).alias("kept_sha256")
    )
    cut = write_shared(cut_texts(texts.where("copies = 1"), spans).unionByName(gone), "repeat-cut")
    untouched = rows.select("doc_id", "print", F.octet_length("text").cast("bigint").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("whole_sha256"))
    return with_groups(untouched, cut, "print", ("doc_id",)).select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"),
    )
