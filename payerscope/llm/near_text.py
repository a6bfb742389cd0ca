"""Near-duplicate texts by BagMinHash signatures, bands and verified multiset overlap."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import write_shared
from .common import connected_components, marked, mix, only_met, small_slices, text_or_empty, with_groups

WORDS = 5
THRESHOLD = 0.8
SLOTS = 128
BANDS, BAND_SLOTS = 32, 4
WIDE_SLOTS = 1024
BLOCK_NODES = 2048
SLACK = 5.5
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2^64."""
    base, inverse = int(BASE), pow(int(BASE), -1, 1 << 64)
    out = []
    for step in (base, inverse):
        table = np.full(n, np.uint64(step))
        table[0] = 1
        with np.errstate(over="ignore"):
            out.append(np.multiply.accumulate(table))
    return out[0], out[1]


class WordHashes:
    """Hashes of the words of many texts at once, from running sums over their bytes."""

    def __init__(self):
        self.up, self.down = powers(1 << 16)

    def of(self, text: bytes) -> np.ndarray:
        raw = LOWER[np.frombuffer(text, np.uint8)]
        if len(raw) > len(self.up):
            self.up, self.down = powers(2 * len(raw))
        gap = SPACE[raw]
        edges = np.flatnonzero(np.diff(np.concatenate(([True], gap, [True])).view(np.int8)))
        start, end = edges[::2], edges[1::2]
        if not len(start):
            return np.zeros(0, np.uint64)
        with np.errstate(over="ignore"):
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self.up[: len(raw)])))
            return mix((sums[end] - sums[start]) * self.down[start])


def shingles(words: np.ndarray) -> np.ndarray:
    """Hashes of all runs of five words; a shorter text is one shingle; none for no words."""
    size = min(WORDS, len(words))
    if not size:
        return words
    with np.errstate(over="ignore"):
        total = np.zeros(len(words) - size + 1, np.uint64)
        for k in range(size):
            total = mix(total * np.uint64(0xD6E8FEB86659FD93) + words[k : len(words) - size + 1 + k])
    return total


def bag(text: bytes, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles in order and their counts."""
    return np.unique(shingles(hashes.of(text)), return_counts=True)


def uniform(keys: np.ndarray) -> np.ndarray:
    return ((keys >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], slots: int = SLOTS) -> np.ndarray:
    """BagMinHash signatures of multisets, one row each: equal slots are an unbiased estimate of weighted Jaccard.

    The weight axis of an element is cut in the levels [0, 1), [1, 2), [2, 4), [4, 8) ... Each level that its
    count reaches has a Poisson process in time whose rate is its width; points come in rising time, each with
    a slot and a place on the level. A level that the count only partly covers keeps the points below the count;
    the same points are drawn whatever the count, so larger counts only add points. Each slot keeps the element
    and level of its earliest point. A process stops once it passes the latest slot of its multiset. All
    multisets of a batch go through the rounds together.
    """
    owner = np.zeros(len(bags) * slots, np.uint64)
    if not any(len(e) for e, _ in bags):
        return owner.reshape(-1, slots)
    elements = np.concatenate([e for e, _ in bags])
    counts = np.concatenate([c for _, c in bags])
    of = np.repeat(np.arange(len(bags)), [len(e) for e, _ in bags])
    keys, width, cover, home = [mix(elements)], [np.ones(len(elements))], [np.ones(len(elements))], [of]
    low, level = 1, 1
    while True:
        more = np.flatnonzero(counts > low)
        if not len(more):
            break
        salt = np.array(level, np.uint64) * np.array([0xA0761D6478BD642F], np.uint64)
        keys.append(mix(elements[more] + salt))
        width.append(np.full(len(more), float(low)))
        cover.append(np.minimum(counts[more] - low, low) / low)
        home.append(of[more])
        low, level = 2 * low, level + 1
    keys, width, cover, home = (np.concatenate(x) for x in (keys, width, cover, home))
    time, draw = np.zeros(len(keys)), keys.copy()
    best = np.full(len(bags) * slots, np.inf)
    while len(keys):
        draw = mix(draw + BASE)
        time = time - np.log(uniform(draw)) / width
        place = mix(draw ^ np.uint64(0xE7037ED1A0B428DB))
        slot = home * slots + (place & np.uint64(slots - 1)).astype(np.int64)
        new = time < best[slot]
        if len(width) and cover.min() < 1:
            new &= uniform(mix(place + BASE)) < cover
        s, t, k = slot[new], time[new], keys[new]
        np.minimum.at(best, s, t)
        first = t == best[s]
        owner[s[first]] = k[first]
        going = time < best.reshape(-1, slots).max(axis=1)[home]
        keys, width, cover, home, time, draw = (x[going] for x in (keys, width, cover, home, time, draw))
    return mix(owner).reshape(-1, slots)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard of two multisets."""
    total = int(a[1].sum() + b[1].sum())
    if not total:
        return 1.0
    _, at, to = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = int(np.minimum(a[1][at], b[1][to]).sum())
    return shared / (total - shared)


def signed(texts: DataFrame) -> DataFrame:
    """Per row: doc_id, print (a digest of the multiset), weight, sig (short slot hashes) and one key per band."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in small_slices(batches):
            bags = [bag(text, hashes) for text in batch.column(2).cast(pa.binary()).to_pylist()]
            slots = signatures(bags)
            short = (slots >> np.uint64(48)).astype("<u2")
            band = np.zeros((len(bags), BANDS), np.uint64)
            for column in short.astype(np.uint64).reshape(-1, BANDS, BAND_SLOTS).transpose(2, 0, 1):
                band = mix(band * BASE + column)
            keys = mix(band + np.arange(BANDS, dtype=np.uint64)).view(np.int64).tolist()
            sigs = [row.tobytes() for row in short]
            prints, weights = [], []
            for elements, counts in bags:
                whole = mix(elements) * (counts.astype(np.uint64) * np.uint64(2) + np.uint64(1))
                weights.append(int(counts.sum()))
                prints.append(f"{int(whole.sum()):016x}{int(mix(whole + np.uint64(29)).sum()):016x}{weights[-1]:x}")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(prints), pa.array(weights, pa.int64()), pa.array(sigs, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64()))],
                names=["row", "doc_id", "print", "weight", "sig", "keys"],
            )

    return texts.mapInArrow(run, "row bigint, doc_id bigint, print string, weight bigint, sig binary, keys array<bigint>")


def lowest_share(threshold: float, slots: int, by_chance: float = 0.0) -> float:
    """Share of equal slots that a pair at the threshold falls short of only by over ``SLACK`` standard deviations."""
    share = threshold + (1 - threshold) * by_chance
    return share - SLACK * (share * (1 - share) / slots) ** 0.5


def agreeing(pairs: DataFrame, threshold: float) -> DataFrame:
    """Pairs whose signatures agree often enough to be worth a full comparison."""
    least = lowest_share(threshold, SLOTS) * SLOTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, SLOTS) for c in ("sig_a", "sig_b"))
                keep = pa.array((a == b).sum(axis=1) >= least)
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(keep)

    return pairs.mapInArrow(run, "a bigint, b bigint")


def wide_sketches(texts: DataFrame) -> DataFrame:
    """node and wide, 1,024 slots of four bits, two to a byte."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in small_slices(batches):
            slots = signatures([bag(text, hashes) for text in batch.column(1).cast(pa.binary()).to_pylist()], WIDE_SLOTS)
            four = (slots >> np.uint64(60)).astype(np.uint8)
            wide = pa.array([row.tobytes() for row in four[:, ::2] << 4 | four[:, 1::2]], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), wide], names=["node", "wide"])

    return texts.mapInArrow(run, "node bigint, wide binary")


def close_in_buckets(members: DataFrame, threshold: float, best_only: bool) -> DataFrame:
    """Pairs (a, b) of a bucket's nodes in different components whose signatures and wide sketches both agree enough.

    With ``best_only`` a node gives just the pair whose wide sketches agree most, in each group that it is in.

    ``members`` has band, key, n (nodes of the bucket), node, own, weight, sig and wide. A bucket is dealt in blocks
    of about ``BLOCK_NODES`` by node, and each two blocks meet in one small group, so that no bucket is gathered and
    only pairs that passed leave the task. A pair is looked at only in the first band that it shares.
    """
    least = lowest_share(threshold, SLOTS) * SLOTS
    least_wide = lowest_share(threshold, WIDE_SLOTS, 1 / 16) * WIDE_SLOTS

    def run(table: pa.Table) -> pa.Table:
        node, own, weight, block = (table.column(c).to_numpy() for c in ("node", "own", "weight", "block"))
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), "<u2").reshape(-1, SLOTS)
        wide = np.frombuffer(b"".join(table.column("wide").to_pylist()), np.uint8).reshape(-1, WIDE_SLOTS // 2)
        band, low, high = (table.column(c)[0].as_py() for c in ("band", "low", "high"))
        left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
        found_a, found_b = [], []
        for i in left:
            near = right[(own[right] != own[i]) & (np.minimum(weight[right], weight[i]) >= threshold * np.maximum(weight[right], weight[i]))]
            if low == high:
                near = near[node[near] > node[i]]
            if not len(near):
                continue
            equal = sig[near] == sig[i]
            good = equal.sum(axis=1) >= least
            good[good] = equal[good].reshape(-1, BANDS, BAND_SLOTS).all(axis=2).argmax(axis=1) == band
            near = near[good]
            differ = wide[near] ^ wide[i]
            alike = ((differ & 15) == 0).sum(axis=1) + ((differ >> 4) == 0).sum(axis=1)
            near = near[alike >= least_wide]
            if best_only and len(near):
                near = near[[alike[alike >= least_wide].argmax()]]
            found_a.append(np.minimum(node[near], node[i]))
            found_b.append(np.maximum(node[near], node[i]))
        both = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (found_a, found_b)]
        return pa.table({"a": both[0], "b": both[1]})

    blocks = F.ceil(F.col("n") / BLOCK_NODES).cast("int")
    dealt = members.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "band", "key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node", "own", "weight", "sig", "wide"
    )
    return met.groupBy("band", "key", "low", "high").applyInArrow(run, "a bigint, b bigint")


def verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of rows whose multisets overlap enough; both texts are joined in by their row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        last, left = None, None
        for batch in small_slices(batches):
            keep = []
            columns = (batch.column(c).cast(pa.binary()).to_pylist() if c[0] == "t" else batch.column(c).to_pylist() for c in ("a", "text_a", "text_b"))
            for a, text_a, text_b in zip(*columns):
                if a != last:
                    last, left = a, bag(text_a, hashes)
                keep.append(overlap(left, bag(text_b, hashes)) >= threshold)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = texts.select(F.col("row").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("row").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(two, "b").join(one, "a").select("a", "b", "text_a", "text_b").mapInArrow(run, "a bigint, b bigint")


def near_texts(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """row, doc_id, class_id, component, kept for every row of ``docs``; ``row`` counts the input's rows in place.

    ``class_id`` is the smallest doc_id of the rows with the same multiset of shingles, ``component_id`` the
    smallest doc_id that verified links of at least ``threshold`` lead to. ``kept`` marks one row of each component.

    Equal multisets are one node. Nodes that share a band key are candidates. In each bucket all nodes are first
    held against its smallest one, and the links found are joined to components. In every bucket that still holds
    several components, each node is then held against the nodes of the other components by their sketches inside
    small blocks: first only its best match is compared by text and the links found are joined, then every pair
    that is still apart and whose sketches agree enough. A pair in a bucket is left out only if its nodes are joined
    already: no link between components is lost, and a group of copies costs a few comparisons a copy, not all pairs.

    Words are split at ASCII white space, ASCII letters count in lower case. Texts without words (null, empty)
    form one class. Rows with a null doc_id take part and get the group's smallest id. Empty in, empty out.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    prints = write_shared(signed(rows.select("row", "doc_id", "text")), "text-prints")
    copies = prints.groupBy("print").agg(F.min("row").alias("node"), F.min("doc_id").alias("class_id"), F.count("*").alias("n"))
    copies = write_shared(copies.where("n > 1").drop("n"), "text-copies")
    firsts = write_shared(with_groups(prints, copies, "print").where("coalesce(node, row) = row").select(F.col("row").alias("node"), "weight", "sig", "keys"), "text-nodes")
    placed = firsts.select("node", F.posexplode("keys").alias("band", "key"))
    counted = placed.groupBy("band", "key").agg(F.count("*").alias("n"), F.min("node").alias("head")).where("n > 1")
    counted = write_shared(counted.select("band", "key", "head"), "text-shared-keys")
    maybe = marked(placed, counted, "key").where("met").drop("met")
    buckets = write_shared(maybe.join(counted, ["band", "key"]).select("band", "key", "node", "head"), "text-buckets")
    texts = rows.select("row", "text")
    slots = firsts.select("node", "weight", "sig")

    def links(worth: DataFrame, name: str) -> DataFrame:
        """Those of the pairs whose texts overlap enough."""
        needed = write_shared(worth.select(F.explode(F.array("a", "b")).alias("row")).distinct(), f"{name}-rows")
        return write_shared(verified(worth, only_met(texts, needed, "row"), threshold), f"{name}-links")

    star = buckets.where("node <> head").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()
    with_sigs = (
        star.join(slots.select(F.col("node").alias("a"), F.col("sig").alias("sig_a"), F.col("weight").alias("weight_a")), "a")
        .join(slots.select(F.col("node").alias("b"), F.col("sig").alias("sig_b"), F.col("weight").alias("weight_b")), "b")
        .where(F.least("weight_a", "weight_b") >= threshold * F.greatest("weight_a", "weight_b"))
    )
    found = links(write_shared(agreeing(with_sigs.select("a", "b", "sig_a", "sig_b"), threshold), "text-star-pairs"), "text-star")
    groups = connected_components(found, "text-star")

    def grouped(table: DataFrame, groups: DataFrame) -> DataFrame:
        return table.join(groups.withColumnRenamed("component", "own"), "node", "left").withColumn("own", F.coalesce("own", "node"))

    sketches, seen = None, None
    for best_only in (True, False):
        apart = grouped(buckets.select("band", "key", "node"), groups)
        mixed = apart.groupBy("band", "key").agg(F.count("*").alias("n"), F.min("own").alias("low"), F.max("own").alias("high")).where("low <> high")
        mixed = write_shared(apart.join(mixed.select("band", "key", "n"), ["band", "key"]), "text-mixed")
        if sketches is None:
            open_nodes = write_shared(mixed.select(F.col("node").alias("row")).distinct(), "text-open")
            sketches = write_shared(wide_sketches(only_met(texts, open_nodes, "row")), "text-wide")
        rest = close_in_buckets(mixed.join(slots.join(sketches, "node"), "node"), threshold, best_only).distinct()
        rest = write_shared(rest if seen is None else rest.join(seen, ["a", "b"], "left_anti"), "text-rest-pairs")
        seen = rest
        found = found.unionByName(links(rest, "text-rest"))
        groups = connected_components(found, "text-groups")
    nodes = with_groups(prints.select("row", "doc_id", "print"), copies, "print").select(
        "row", "doc_id", F.coalesce("node", "row").alias("node"), F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id")
    )
    groups = write_shared(groups.withColumnRenamed("component", "own"), "text-own")
    all_rows = with_groups(write_shared(nodes, "text-rows"), groups, "node").withColumn("own", F.coalesce("own", "node"))
    all_rows = write_shared(all_rows.select("row", "doc_id", "class_id", "own"), "text-owned")
    several = all_rows.groupBy("own").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("component_id"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first")
    )
    several = write_shared(several.where("n > 1").select("own", "component_id", F.col("first.row").alias("first")), "text-components")
    alone = F.col("first").isNull()
    return with_groups(all_rows, several, "own").select(
        "row", "doc_id", "class_id", F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        (alone | (F.col("row") == F.col("first"))).alias("kept"),
    )


def without_near_copies(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of every component, all columns kept: the one with the smallest doc_id."""
    gone = write_shared(near_texts(docs, threshold).where("NOT kept").select("row"), "text-gone")
    whole = docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row"))
    flagged = marked(whole, gone, "row")
    unsure = flagged.where("met").join(gone, "row", "left_anti")
    return flagged.where("NOT met").select("doc").unionByName(unsure.select("doc")).select("doc.*")
