"""Near-duplicate vectors by navigable small-world graphs, one hierarchy of graphs per shard."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import write_shared
from .common import connected_components, mix

THRESHOLD = 0.93
SHARD_ROWS = 8192
SHARDS_PER_TASK = 8
LINKS, BASE_LINKS = 16, 32
BUILD_BEAM, FIRST_BEAM, EXPAND = 48, 32, 4
INSERT_ROWS, QUERY_ROWS = 512, 256
AUDIT_ROWS, AUDIT_RECALL = 32, 0.995
SLACK = 1e-4


class SmallWorld:
    """A hierarchy of proximity graphs over unit vectors; searches and inserts run for many rows at once."""

    def __init__(self, vectors: np.ndarray, seed: int = 7):
        self.x = np.ascontiguousarray(vectors, np.float32)
        n = len(self.x)
        draw = (mix(np.arange(n, dtype=np.uint64) + np.uint64(seed * 1_000_003)) >> np.uint64(11)) / 2.0**53
        self.level = np.minimum((-np.log(np.maximum(draw, 1e-12)) / np.log(LINKS)).astype(int), 4)
        order = np.argsort(-self.level, kind="stable")
        self.graphs: list[np.ndarray] = []
        self.entry: list[np.ndarray] = []
        for level in range(int(self.level.max(initial=0)), -1, -1):
            rows = order[self.level[order] >= level]
            width = BASE_LINKS if level == 0 else LINKS
            self.graphs.append(np.full((n, width), -1, np.int32))
            self._build(rows, width)

    def _build(self, rows: np.ndarray, width: int) -> None:
        """Insert the level's rows in blocks; a block sees the graph before it and its own rows."""
        graph = self.graphs[-1]
        upper = len(self.graphs) > 1
        at = 0
        while at < len(rows):
            block = rows[at : at + INSERT_ROWS]
            x = self.x[block]
            own = x @ x.T
            np.fill_diagonal(own, -np.inf)
            take = min(BUILD_BEAM, len(block) - 1)
            near = np.argpartition(-own, take - 1, axis=1)[:, :take] if take > 0 else np.zeros((len(block), 0), int)
            ids, sims = block[near], np.take_along_axis(own, near, 1)
            if at:
                start = self._descend(x) if upper else np.repeat(rows[:1], len(block))[:, None]
                found, found_sims = self._beam(x, graph, start, BUILD_BEAM)
                ids, sims = np.hstack([ids, found]), np.hstack([sims, found_sims])
            chosen = self._spread_out(ids, sims, width // 2)
            graph[block, : chosen.shape[1]] = chosen
            self._link_back(graph, block, chosen, width)
            at += len(block)
        self.entry.append(rows[:1])

    def _spread_out(self, ids: np.ndarray, sims: np.ndarray, width: int) -> np.ndarray:
        """Per row, up to ``width`` candidates, nearest first, each nearer to the row than to those chosen before."""
        order = np.argsort(-sims, axis=1, kind="stable")[:, : 2 * BUILD_BEAM]
        ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        repeated = np.zeros(ids.shape, bool)
        by_id = np.argsort(ids, axis=1, kind="stable")
        sorted_ids = np.take_along_axis(ids, by_id, 1)
        same = np.zeros(ids.shape, bool)
        same[:, 1:] = sorted_ids[:, 1:] == sorted_ids[:, :-1]
        np.put_along_axis(repeated, by_id, same, 1)
        usable = (ids >= 0) & np.isfinite(sims) & ~repeated
        between = np.einsum("bcd,bed->bce", self.x[np.maximum(ids, 0)], self.x[np.maximum(ids, 0)])
        kept = np.zeros(ids.shape, bool)
        count = np.zeros(len(ids), int)
        for c in range(ids.shape[1]):
            shaded = ((between[:, c] >= sims[:, c, None]) & kept).any(axis=1)
            good = usable[:, c] & ~shaded & (count < width)
            kept[:, c] = good
            count += good
        for c in range(ids.shape[1]):  # fill what is left with the nearest others
            good = usable[:, c] & ~kept[:, c] & (count < width)
            kept[:, c] |= good
            count += good
        rank = np.argsort(~kept, axis=1, kind="stable")[:, :width]
        return np.where(np.take_along_axis(kept, rank, 1), np.take_along_axis(ids, rank, 1), -1).astype(np.int32)

    def _link_back(self, graph: np.ndarray, block: np.ndarray, chosen: np.ndarray, width: int) -> None:
        source = np.repeat(block, chosen.shape[1])
        target = chosen.ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        nodes, first, counts = np.unique(target, return_index=True, return_counts=True)
        for at in range(0, len(nodes), INSERT_ROWS):
            part, n = nodes[at : at + INSERT_ROWS], counts[at : at + INSERT_ROWS]
            new = np.full((len(part), int(n.max())), -1, np.int64)
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            new[np.repeat(np.arange(len(part)), n), place] = source[first[at] : first[at] + n.sum()]
            ids = np.hstack([graph[part], new])
            sims = np.einsum("bd,bcd->bc", self.x[part], self.x[np.maximum(ids, 0)])
            sims[ids < 0] = -np.inf
            graph[part] = self._spread_out(ids, sims, width)

    def _descend(self, x: np.ndarray) -> np.ndarray:
        """Entry points into the lowest finished level: a narrow beam through the levels above."""
        start = np.repeat(self.entry[0], len(x))[:, None]
        for graph in self.graphs[: len(self.entry)]:
            start = self._beam(x, graph, start, 4)[0]
        return start

    def _beam(self, x: np.ndarray, graph: np.ndarray, start: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(x)
        seen = np.zeros((n, len(self.x)), bool)
        all_rows = np.arange(n)
        ids = np.full((n, width), -1, np.int64)
        sims = np.full((n, width), -np.inf, np.float32)
        start = start[:, :width]
        ids[:, : start.shape[1]] = start
        sims[:, : start.shape[1]] = np.where(start >= 0, np.einsum("bd,bcd->bc", x, self.x[np.maximum(start, 0)]), -np.inf)
        seen[all_rows[:, None], np.maximum(start, 0)] = True
        done = ids < 0
        active = all_rows
        while len(active):
            score = np.where(done[active], -np.inf, sims[active])
            k = min(EXPAND, width)
            pick = np.argpartition(-score, k - 1, axis=1)[:, :k]
            live = np.isfinite(np.take_along_axis(score, pick, 1))
            going = live.any(axis=1)
            active, pick, live = active[going], pick[going], live[going]
            if not len(active):
                break
            done[active[:, None], pick] = True
            nodes = np.where(live, ids[active[:, None], pick], -1)
            near = np.where(nodes[:, :, None] >= 0, graph[np.maximum(nodes, 0)], -1).reshape(len(active), -1)
            near.sort(axis=1)
            fresh = near >= 0
            fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
            fresh &= ~seen[active[:, None], np.maximum(near, 0)]
            row, col = np.nonzero(fresh)
            seen[active[row], near[row, col]] = True
            near_sims = np.full(near.shape, -np.inf, np.float32)
            near_sims[row, col] = np.einsum("pd,pd->p", x[active[row]], self.x[near[row, col]])
            both = np.hstack([sims[active], near_sims])
            best = np.argpartition(-both, width - 1, axis=1)[:, :width]
            sims[active] = np.take_along_axis(both, best, 1)
            ids[active] = np.take_along_axis(np.hstack([ids[active], np.where(fresh, near, -1)]), best, 1)
            done[active] = np.take_along_axis(np.hstack([done[active], ~fresh]), best, 1)
        return ids, sims

    def near(self, x: np.ndarray, floor: float, audit: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """(query, row) pairs of similarity of about ``floor`` or more.

        A row whose beam holds only hits gets one twice as wide, up to the whole shard. Then some queries are
        held against all rows; while their recall is too low, all queries run again with a wider beam.
        """
        n, width = len(self.x), FIRST_BEAM
        x = np.ascontiguousarray(x, np.float32)
        step = max(1, len(x) // AUDIT_ROWS)
        truth = x[::step] @ self.x.T >= floor if audit else None
        while True:
            found = []
            rows = np.arange(len(x))
            beam = width
            while len(rows):
                if beam * 8 >= n:
                    for at in range(0, len(rows), QUERY_ROWS):
                        part = rows[at : at + QUERY_ROWS]
                        q, r = np.nonzero(x[part] @ self.x.T >= floor)
                        found.append((part[q], r))
                    break
                ids, sims = self._beam(x[rows], self.graphs[-1], self._descend(x[rows]), beam)
                full = (sims >= floor).all(axis=1)
                q, c = np.nonzero((sims >= floor) & ~full[:, None])
                found.append((rows[q], ids[q, c]))
                rows, beam = rows[full], beam * 2
            query = np.concatenate([f[0] for f in found]) if found else np.zeros(0, int)
            row = np.concatenate([f[1] for f in found]) if found else np.zeros(0, int)
            if truth is None or width * 8 >= n:
                return query, row
            hit = np.count_nonzero(query % step == 0)
            if hit >= AUDIT_RECALL * np.count_nonzero(truth):
                return query, row
            width *= 2


class Groups:
    """Sets of rows that links join; links come in as arrays."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def root(self, rows: np.ndarray) -> np.ndarray:
        up = self.parent[rows]
        while True:
            higher = self.parent[up]
            if np.array_equal(higher, up):
                return up
            up = higher

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.root(a), self.root(b)
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Scaled by the largest part first, so squares neither overflow nor vanish."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def shard_links(rows: DataFrame, threshold: float) -> DataFrame:
    """Search every shard: ``rows`` has (part, role, row, copies, vector), a shard's own rows (role 0) first.

    Returns kind "count" (a: row, n: copies that it is linked with) and kind "edge" (a, b): a spanning set of
    the links, never all pairs.
    """
    out = pa.schema([("kind", pa.string()), ("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])

    def emit(kind: str, a, b, n) -> pa.RecordBatch:
        a = np.asarray(a, np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array([kind] * len(a), pa.string()), pa.array(a), pa.array(np.asarray(b, np.int64)), pa.array(np.asarray(n, np.int64))], schema=out
        )

    class Shard:
        def __init__(self, first: bool):
            self.first = first  # of the tasks that load this shard, one finds the links inside it
            self.rows, self.copies, self.vectors, self.graph = [], [], [], None

        def add(self, rows, copies, vectors):
            self.rows.append(rows), self.copies.append(copies), self.vectors.append(vectors)

        def ready(self) -> Iterator[pa.RecordBatch]:
            if self.graph is None:
                self.rows, self.copies = np.concatenate(self.rows), np.concatenate(self.copies)
                self.exact = np.concatenate(self.vectors)
                self.graph = SmallWorld(self.exact)
                self.groups = Groups(len(self.rows))
                self.seen = np.zeros(len(self.rows), np.int64)
                if not self.first:
                    return
                own = np.zeros(len(self.rows), np.int64)
                for at in range(0, len(self.rows), QUERY_ROWS):
                    part = np.arange(at, min(at + QUERY_ROWS, len(self.rows)))
                    q, r = self.links(self.exact[part], part)
                    own[part] += np.bincount(q, self.copies[r], len(part)).astype(np.int64)
                    self.groups.join(part[q], r)
                yield emit("count", self.rows, self.rows, own)

        def links(self, vectors, own=None):
            q, r = self.graph.near(vectors, threshold - SLACK)
            if own is not None:
                apart = own[q] != r
                q, r = q[apart], r[apart]
            good = np.concatenate([
                np.einsum("pd,pd->p", vectors[q[i : i + 65536]], self.exact[r[i : i + 65536]]) >= threshold
                for i in range(0, len(q), 65536)
            ] or [np.zeros(0, bool)])
            return q[good], r[good]

        def ask(self, rows, copies, vectors) -> Iterator[pa.RecordBatch]:
            yield from self.ready()
            q, r = self.links(vectors)
            if len(q):
                yield emit("count", rows, rows, np.bincount(q, self.copies[r], len(rows)))
                self.seen += np.bincount(r, copies[q], len(self.rows)).astype(np.int64)
                first = np.unique(q, return_index=True)[1]
                anchor = np.zeros(len(rows), np.int64)
                anchor[q[first]] = r[first]
                self.groups.join(anchor[q], r)
                yield emit("edge", rows[q[first]], self.rows[r[first]], np.ones(len(first)))

        def close(self) -> Iterator[pa.RecordBatch]:
            yield from self.ready()
            root = self.groups.root(np.arange(len(self.rows)))
            other = root != np.arange(len(self.rows))
            yield emit("edge", self.rows[other], self.rows[root[other]], np.ones(other.sum()))
            yield emit("count", self.rows, self.rows, self.seen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard = None, None
        for batch in batches:
            parts = np.array(batch.column("part").to_pylist(), object)
            roles = batch.column("role").to_numpy(zero_copy_only=False)
            ids, copies = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("row", "copies"))
            column = batch.column("vector")
            cuts = [0, *(i for i in range(1, len(parts)) if parts[i] != parts[i - 1] or roles[i] != roles[i - 1]), len(parts)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if parts[a] != part:
                    if shard is not None:
                        yield from shard.close()
                    part, shard = parts[a], Shard(parts[a].startswith("0:"))
                # the vectors of a part have one width, those of a batch need not
                flat = column.slice(a, b - a).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                vectors = unit(flat.reshape(b - a, -1))
                if roles[a] == 0:
                    shard.add(ids[a:b], copies[a:b], vectors)
                else:
                    for at in range(a, b, QUERY_ROWS):
                        to = min(b, at + QUERY_ROWS)
                        yield from shard.ask(ids[at:to], copies[at:to], vectors[at - a : to - a])
        if shard is not None:
            yield from shard.close()

    return rows.mapInArrow(run, "kind string, a bigint, b bigint, n bigint")


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row, comparing rows of equal, non-null label.

    Equal vectors of a label are one node with a number of copies. A label's nodes are dealt to shards of
    about ``shard_rows``; a graph is built in each. Shards lie on a ring: a shard's nodes are sent to itself and to
    the next half of the ring, so every pair of shards meets once and every shard is asked by as many. The queries
    of a shard are dealt to tasks of ``SHARDS_PER_TASK`` asking shards each, which load it anew, so no task's work grows
    with its label. Queries stream through a task; a task holds one shard.

    Vectors that are null, empty, zero, or hold null or non-finite parts, and rows without a label, link with
    nothing. Repeated rows count as different vectors. A null vec_id takes part and is null in the result; its
    component is the smallest other id, if any. Vectors of different width never link. Empty in, empty out.
    """
    rows = write_shared(
        vectors.select(
            F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("bigint").alias("vec_id"),
            F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("vector"),
        ).withColumn(
            "sound",
            F.expr("coalesce(label is not null and size(vector) > 0 and forall(vector, x -> x is not null and not isnan(x) "
                   "and abs(x) < double('infinity')) and exists(vector, x -> x <> 0), false)"),
        ).withColumn("same", F.when(F.col("sound"), F.concat(F.xxhash64("label", "vector"), F.lit("."), F.hash("vector", "label")))),
        "vectors",
    )
    sound = rows.where("sound").withColumn("family", F.concat_ws(":", F.size("vector"), "label"))
    nodes = sound.groupBy("same").agg(
        F.min("row").alias("row"), F.count("*").alias("copies"), F.min("family").alias("family"), F.any_value("vector").alias("vector")
    )
    nodes = write_shared(nodes, "vector-nodes")
    sizes = nodes.groupBy("family").agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("shards"))
    dealt = nodes.join(sizes, "family").withColumn("shard", F.pmod(F.xxhash64("row"), F.col("shards")).cast("int"))
    # steps 1 .. (S - 1) / 2 along the ring, and S / 2 for the first half of an even ring
    reach = F.expr("int((shards - 1) div 2) + int(shards % 2 = 0 and shard < shards div 2)")
    tasks = F.greatest(F.lit(1), F.ceil(F.expr("shards div 2") / F.lit(SHARDS_PER_TASK))).cast("int")
    loaded = dealt.withColumn("salt", F.explode(F.sequence(F.lit(0), tasks - 1))).select(
        F.concat_ws(":", "salt", "shard", "family").alias("part"), F.lit(0).alias("role"), "row", "copies", "vector"
    )
    sent = (
        dealt.withColumn("reach", reach).where("reach > 0").withColumn("step", F.explode(F.expr("sequence(1, reach)")))
        .withColumn("salt", F.expr(f"(step - 1) div {SHARDS_PER_TASK}"))
        .withColumn("to", F.expr("(shard + step) % shards"))
        .select(F.concat_ws(":", "salt", "to", "family").alias("part"), F.lit(1).alias("role"), "row", "copies", "vector")
    )
    asked = loaded.unionByName(sent)
    found = write_shared(
        shard_links(asked.repartition("part").sortWithinPartitions("part", "role", "row"), threshold), "vector-links"
    )
    counts = found.where("kind = 'count'").groupBy(F.col("a").alias("row")).agg(F.sum("n").alias("linked"))
    groups = connected_components(found.where("kind = 'edge'").select("a", "b"), "vector-groups")
    placed = (
        nodes.select("same", "row", "copies").join(counts, "row", "left")
        .join(groups.withColumnRenamed("node", "row"), "row", "left")
        .select("same", F.coalesce("component", "row").alias("group"), (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    joined = write_shared(
        rows.select("row", "vec_id", F.coalesce("same", F.concat(F.lit("row "), "row")).alias("same"))
        .join(placed, "same", "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce(F.col("group"), -1 - F.col("row")).alias("group")),
        "vector-rows",
    )
    smallest = joined.groupBy("group").agg(F.min("vec_id").alias("component_id"))
    return joined.join(smallest, "group").select(
        "vec_id", F.col("n_links").cast("bigint").alias("n_links"), "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept")
    )
