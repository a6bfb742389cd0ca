"""Random forest for two classes, grown level by level from exact counts.

Each row draws its Poisson(1) weight for a tree from a hash of its key, and each node its features from a hash of its
place, so nothing depends on how rows are dealt to tasks. A level is one pass over the rows: every task counts
(tree, node, feature, bin, class) for the nodes that are open and the features that each may cut by, tasks are added up as whole numbers, and the best cut
of each node comes back, one small row a node. Same rows, same forest, on 16 partitions or on 200.

What one task or the driver holds is bounded by the model: trees x open nodes x picked features x bins counts.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import value_distribution

# The functions below travel to the executors with their code, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PLACES = 6
NODES_AT_ONCE = 500


class Settings(NamedTuple):
    trees: int = 140
    depth: int = 7
    leaf_rows: int = 8
    bins: int = 32
    seed: int = 42


class Forest(NamedTuple):
    """Nodes by (tree, place): children of place p are 2p and 2p + 1; a leaf has feature -1.

    A row goes right where its feature is at least ``cut``. ``share`` is the weighted share of class 1 in the node.
    """

    feature: np.ndarray
    cut: np.ndarray
    share: np.ndarray

    def places(self, tree: int, values: np.ndarray, rows: np.ndarray, levels: int) -> np.ndarray:
        """Places of ``rows`` after so many levels; ``values`` is in column order. A leaf passes its rows on to the left and right."""
        count, flat = len(values), values.reshape(-1, order="F")
        start, cut = np.maximum(self.feature[tree], 0) * count, self.cut[tree]
        place = np.ones(len(rows), dtype=np.int64)
        for _ in range(levels):
            cell = start.take(place)
            cell += rows
            right = flat.take(cell) >= cut.take(place)
            place += place
            place += right
        return place

    def scores(self, values: np.ndarray) -> np.ndarray:
        """Mean share over the trees' leaves."""
        levels = int(np.log2(self.feature.shape[1])) - 1
        values, rows, share = np.asfortranarray(values), np.arange(len(values)), self.share.copy()
        for place in range(1, 2**levels):  # what lies below a leaf has the leaf's share
            leaf = self.feature[:, place] < 0
            share[leaf, 2 * place] = share[leaf, 2 * place + 1] = share[leaf, place]
        total = np.zeros(len(values))
        for tree in range(len(self.feature)):
            total += share[tree].take(self.places(tree, values, rows, levels))
        return total / len(self.feature)


def empty_forest(trees: int, depth: int) -> Forest:
    shape = (trees, 2 ** (depth + 1))
    return Forest(np.full(shape, -1, dtype=np.int64), np.zeros(shape), np.zeros(shape))


def mix(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers (the finaliser of a common public generator)."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return values ^ (values >> np.uint64(31))


_POISSON = np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 12)]))
# The draw by the first 16 bits of the share, -1 where they leave it open.
_STEPS = np.arange(1 << 16) / 2.0**16
_BY_BITS = np.searchsorted(_POISSON, _STEPS, side="right")
_BY_BITS[_BY_BITS != np.searchsorted(_POISSON, _STEPS + 2.0**-16, side="right")] = -1


def draws(prints: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row counts in a tree: Poisson with mean one."""
    salt = mix(np.array([tree + 1 + (seed << 20)], dtype=np.uint64))[0]
    mixed = mix(prints ^ salt)
    times = _BY_BITS.take((mixed >> np.uint64(48)).view(np.int64))
    unsure = np.flatnonzero(times < 0)
    times[unsure] = np.searchsorted(_POISSON, mixed[unsure] / 2.0**64, side="right")
    return times


def picked_features(features: int) -> int:
    return max(1, int(features**0.5))


def chosen_features(tree: int, place: int, features: int, seed: int) -> np.ndarray:
    """The features that a node may cut by: as many as the root of all, by hash."""
    order = mix(np.arange(features, dtype=np.uint64) + mix(np.array([place + (tree << 20) + (seed << 44)], dtype=np.uint64))[0])
    picked = np.zeros(features, dtype=bool)
    picked[np.argsort(order)[:picked_features(features)]] = True
    return picked


def bin_edges(rows: DataFrame, features: Sequence[str], bins: int) -> list[np.ndarray]:
    """Lower edges of the bins of each feature but the first: values that start a new share of the rows. Exact."""
    melted = rows.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("feature"), F.round(F.col(name).cast("double"), PLACES).alias("value")) for i, name in enumerate(features)
    ])))
    dist = value_distribution(melted, "value", ["feature"], decimals=PLACES)
    number = F.floor(F.col("before") * bins / F.col("total"))
    found = dist.groupBy("feature", number.alias("bin")).agg(F.min("value").alias("edge")).collect()
    return [np.array(sorted(r["edge"] for r in found if r["feature"] == i)[1:]) for i in range(len(features))]


def counts_of_level(
    forest: Forest, places: list[list[int]], edges: list[np.ndarray], settings: Settings, level: int
) -> Callable:
    """Task: counts of (picked feature, bin, class) for each open node of each tree, as one packed row a node.

    Of a node only the features that it may cut by are counted; each of them counts all rows of the node.
    """
    n_features, bins, picks = len(edges), settings.bins, picked_features(len(edges))
    open_nodes = max(map(len, places))
    slots = np.full(forest.feature.shape, -1, dtype=np.int64)
    picked = np.zeros((settings.trees, open_nodes, picks), dtype=np.int64)
    for tree, found in enumerate(places):
        slots[tree, found] = np.arange(len(found))
        for slot, place in enumerate(found):
            picked[tree, slot] = np.flatnonzero(chosen_features(tree, place, n_features, settings.seed))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((settings.trees, open_nodes, picks, bins, 2), dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            n = batch.num_rows
            values = np.asfortranarray(np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(n_features)]))
            label = batch.column(n_features).to_numpy(zero_copy_only=False).astype(np.int64)
            # of each feature in turn: the place of a row's bin and class among the counts of a feature
            at = np.concatenate([np.searchsorted(e, values[:, i], side="right") * 2 + label for i, e in enumerate(edges)])
            prints = batch.column(n_features + 1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for tree in range(settings.trees):
                if not places[tree]:
                    continue
                times = draws(prints, tree, settings.seed)
                rows = np.flatnonzero(times)
                slot = slots[tree].take(forest.places(tree, values, rows, level))
                if level:
                    still = np.flatnonzero(slot >= 0)
                    rows, slot = rows.take(still), slot.take(still)
                times = times.take(rows)
                for i in range(picks):
                    key = slot * (bins * 2) + at.take(picked[tree, :, i].take(slot) * n + rows)
                    total[tree, :, i] += np.bincount(key, times, open_nodes * bins * 2).astype(np.int64).reshape(open_nodes, bins, 2)
        trees, nodes = np.nonzero(total[:, :, 0].sum(axis=(2, 3)))
        yield pa.RecordBatch.from_arrays([
            pa.array(trees, pa.int32()), pa.array(nodes, pa.int32()), pa.array([total[t, s].tobytes() for t, s in zip(trees, nodes)], pa.binary()),
        ], names=["tree", "slot", "counts"])

    return count


def best_cuts(places: list[list[int]], n_features: int, settings: Settings, balance: tuple[float, float]) -> Callable:
    """Task: adds up the counts of its nodes and gives the cut of each with the largest drop of Gini impurity."""
    shape = (picked_features(n_features), settings.bins, 2)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summed: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for tree, slot, counts in zip(*(c.to_pylist() for c in batch.columns)):
                held = np.frombuffer(counts, dtype=np.int64).reshape(shape)
                summed[tree, slot] = summed[tree, slot] + held if (tree, slot) in summed else held
        nodes = sorted(summed)
        for at in range(0, len(nodes), NODES_AT_ONCE):
            yield cuts_of(nodes[at:at + NODES_AT_ONCE], summed)

    def cuts_of(nodes: list[tuple[int, int]], summed: dict[tuple[int, int], np.ndarray]) -> pa.RecordBatch:
        counts = np.stack([summed[node] for node in nodes])
        at = [places[tree][slot] for tree, slot in nodes]
        left = counts.cumsum(axis=2)[:, :, :-1]
        whole = counts[:, 0].sum(axis=1)
        right = whole[:, None, None] - left
        impure = lambda part: (p := part * np.array(balance)).sum(axis=-1) - (p**2).sum(axis=-1) / np.maximum(p.sum(axis=-1), 1e-300)
        gain = impure(whole)[:, None, None] - impure(left) - impure(right)
        enough = (left.sum(axis=-1) >= settings.leaf_rows) & (right.sum(axis=-1) >= settings.leaf_rows)
        picked = np.stack([np.flatnonzero(chosen_features(tree, place, n_features, settings.seed)) for (tree, _), place in zip(nodes, at)])
        gain = np.where(enough, np.round(gain, 9), -1.0).reshape(len(nodes), -1)
        best = gain.argmax(axis=1)
        pick, cut = np.divmod(best, settings.bins - 1)
        every = np.arange(len(nodes))
        split = gain[every, best] > 0
        columns = [
            [tree for tree, _ in nodes], at, np.where(split, picked[every, pick], -1), cut + 1, whole[:, 0], whole[:, 1],
            left[every, pick, cut, 0], left[every, pick, cut, 1],
        ]
        names = ["tree", "place", "feature", "bin", "n0", "n1", "left0", "left1"]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return choose


def grow(rows: DataFrame, key: str, features: Sequence[str], label: str, balance: tuple[float, float], settings: Settings = Settings()) -> Forest:
    """A forest from (key, features, label); labels are 0 and 1, ``balance`` weighs them. Rows are read once a level.

    ``rows`` should be a written table with unique keys; rows with one key draw the same weights.
    """
    edges = bin_edges(rows, features, settings.bins)
    table = rows.select(*[F.col(f).cast("double") for f in features], F.col(label).cast("long"), F.xxhash64(F.col(key).cast("string")))
    forest = empty_forest(settings.trees, settings.depth)
    places = [[1] for _ in range(settings.trees)]
    parallel = rows.sparkSession.sparkContext.defaultParallelism
    share = lambda n0, n1: n1 * balance[1] / max(n0 * balance[0] + n1 * balance[1], 1e-300)
    for level in range(settings.depth):
        if not any(places):
            break
        counted = table.mapInArrow(counts_of_level(forest, places, edges, settings, level), "tree int, slot int, counts binary")
        cuts = counted.repartition(parallel, "tree", "slot").mapInArrow(
            best_cuts(places, len(features), settings, balance),
            "tree bigint, place bigint, feature bigint, bin bigint, n0 bigint, n1 bigint, left0 bigint, left1 bigint",
        ).collect()
        places = [[] for _ in range(settings.trees)]
        for tree, place, feature, number, n0, n1, left0, left1 in sorted(map(tuple, cuts)):
            forest.share[tree, place] = share(n0, n1)
            if feature < 0 or number > len(edges[feature]):
                continue
            forest.feature[tree, place], forest.cut[tree, place] = feature, edges[feature][number - 1]
            for child, (c0, c1) in ((2 * place, (left0, left1)), (2 * place + 1, (n0 - left0, n1 - left1))):
                forest.share[tree, child] = share(c0, c1)
                if c0 and c1 and c0 + c1 >= 2 * settings.leaf_rows:
                    places[tree].append(child)
    return forest


def forest_of(nodes: Sequence[tuple[int, int, int, float, float]], trees: int, depth: int) -> Forest:
    """A forest from rows (tree, place, feature, cut, share)."""
    forest = empty_forest(trees, depth)
    for tree, place, feature, cut, share in nodes:
        forest.feature[tree, place], forest.cut[tree, place], forest.share[tree, place] = feature, cut, share
    return forest


def score_column(forest: Forest, features: Sequence[str]) -> Column:
    """The score of a row, at six places. The forest is as large as its settings say and travels with the function."""

    @F.pandas_udf("double")
    def score(*columns: pd.Series) -> pd.Series:
        values = np.column_stack([c.to_numpy(dtype=float) for c in columns])
        return pd.Series(np.round(forest.scores(values), PLACES))

    return score(*[F.col(f).cast("double") for f in features])
