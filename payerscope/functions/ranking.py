"""Ranks, quantiles and dense keys that never gather all rows in one task.

A window without ``partitionBy`` sorts the whole table in one task, and a window
over a hot key sorts that key's rows in one task. Everything here works on the
*distinct values* instead: rows are counted per value first (map-side combine
flattens hot values), values are split into fixed-width ranges, running counts
are formed inside a range, and range totals give the offset of each range. The
split is plain arithmetic on the value, so a recomputed task always agrees with
the tasks that ran before it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import SMALL_FILES, write_shared

# Values per range at the stated number of decimals, so what one window partition
# holds at most. The ranges themselves stay few: B different ranges of non-negative
# values need a value sum of about B * B / 2 range widths, so amounts that add up to
# ten trillion lie in under 200,000 ranges.
RANGE_WIDTH = 1 << 16
_MAX_POSITION_BITS = 33


def value_distribution(
    df: DataFrame,
    value: str,
    partition: Sequence[str] = (),
    decimals: int | None = None,
    measures: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per distinct non-null value with the counts below it.

    Output: partition columns, ``value``, ``k`` (rows with it), ``before`` (rows
    below it), ``total`` (non-null rows of the partition), the same two for distinct
    values (``distinct_before``, ``distinct_total``), and for each measure ``m`` its sum ``m``, the sum below ``m_before`` and ``m_total``.

    ``decimals`` states at how many decimals the values live; then a range holds at
    most ``RANGE_WIDTH`` of them. ``None`` is for columns whose whole domain is
    small by nature (flags, counts per entity, days, scores cut to six places).
    """
    keys = list(partition)
    sums = {"k": F.count(F.lit(1))}
    sums.update({name: F.sum(col) for name, col in (measures or {}).items()})
    values = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(*[col.alias(name) for name, col in sums.items()])
    )
    before_name = {name: "before" if name == "k" else f"{name}_before" for name in sums}
    total_name = {name: "total" if name == "k" else f"{name}_total" for name in sums}

    def running(frame: DataFrame, by: Sequence[str], order: str, parts: dict[str, tuple[str, str]]) -> DataFrame:
        ordered = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        cols = [F.coalesce(F.sum(src).over(ordered), F.lit(0)).alias(dst) for dst, (src, _) in parts.items()]
        cols += [F.sum(src).over(Window.partitionBy(*by)).alias(tot) for _, (src, tot) in parts.items() if tot]
        return frame.select("*", *cols)

    counted = values.withColumn("_one", F.lit(1).cast("bigint"))
    plan = {before_name[n]: (n, total_name[n]) for n in sums}
    plan["distinct_before"] = ("_one", "distinct_total")
    if decimals is None:
        return running(counted, keys, value, plan).drop("_one")

    step = float(RANGE_WIDTH) / (10.0**decimals)
    # Never null, so no filter is added to one branch only and both share one shuffle.
    ranged = counted.withColumn("_range", F.coalesce(F.floor(F.col(value).cast("double") / F.lit(step)), F.lit(0)))
    totals = ranged.groupBy(*keys, "_range").agg(*[F.sum(n).alias(f"_t_{n}") for n in [*sums, "_one"]])
    offset_plan = {f"_o_{n}": (f"_t_{n}", total_name[n]) for n in sums}
    offset_plan["_o__one"] = ("_t__one", "distinct_total")
    offsets = running(totals, keys, "_range", offset_plan).drop(*[f"_t_{n}" for n in [*sums, "_one"]])
    inside = running(
        ranged, [*keys, "_range"], value,
        {**{f"_i_{n}": (n, "") for n in sums}, "_i__one": ("_one", "")},
    )
    joined = null_safe_join(inside, offsets, [*keys, "_range"])
    return joined.select(
        *keys, value, *sums,
        *[(F.col(f"_o_{n}") + F.col(f"_i_{n}")).alias(before_name[n]) for n in sums],
        (F.col("_o__one") + F.col("_i__one")).alias("distinct_before"),
        "distinct_total", *total_name.values(),
    )


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """An equi-join on which a missing key meets a missing key, so groups without a name stay."""
    renamed = right.select(*[F.col(k).alias(f"_right_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    return left.join(renamed, same, how).drop(*[f"_right_{k}" for k in keys])


def average_rank_share(before: Column, k: Column, count: Column) -> Column:
    """Average rank of ties divided by the number of ranked rows."""
    return (before.cast("double") + (k.cast("double") + F.lit(1.0)) / F.lit(2.0)) / count.cast("double")


def percent_rank_of(before: Column, count: Column) -> Column:
    """SQL ``percent_rank``: rows below over rows minus one, zero for a lone row."""
    return F.when(count > 1, before.cast("double") / (count - 1).cast("double")).otherwise(F.lit(0.0))


class Rank(NamedTuple):
    """A percentile rank to add: of ``value``, named ``out``, within ``partition``.

    ``measure`` writes the rank table first and counts it: the way to keep a large ``df`` in place.
    """

    value: str
    out: str
    decimals: int | None = None
    partition: tuple[str, ...] = ()
    measure: bool = False


# Rank rows (a value and a double) that are broadcast after they were counted: some 100 MB as a hash table.
BROADCAST_ROWS = 2_000_000


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A written table of a key and a number as a join side: it is counted, and broadcast up to ``rows`` rows."""
    return F.broadcast(df) if df.count() <= rows else df


def with_pct_ranks(df: DataFrame, ranks: Sequence[Rank]) -> DataFrame:
    """Add tie-averaged percentile ranks; null stays null.

    ``df`` is read once per rank plus once, so it should be a written table, of
    which each rank reads one column. A rank table has one row per distinct value:
    a value held by a third of all rows meets a single row there, and the join can
    split it over tasks. Small domains (``decimals`` of None) are broadcast: counts
    per entity that add up to N take at most sqrt(2 N) distinct values, six-place
    scores a million, days the length of the calendar. Other rank tables grow with
    the data: measured ones are broadcast up to ``BROADCAST_ROWS``, the rest is left to
    the run-time size check.
    """
    result = df
    for rank in ranks:
        keys = [*rank.partition, rank.value]
        table = value_distribution(df, rank.value, rank.partition, rank.decimals).select(
            *keys, average_rank_share(F.col("before"), F.col("k"), F.col("total")).alias(rank.out)
        )
        small = rank.decimals is None and not rank.partition
        if rank.measure and not rank.partition:
            table = write_shared(table, "rank_table")
            small = small or table.count() <= BROADCAST_ROWS
        if rank.partition:
            result = null_safe_join(result, table.where(F.col(rank.value).isNotNull()), keys, "left")
        else:
            result = result.join(F.broadcast(table) if small else table, keys, "left")
    return result


def exact_quantiles(
    df: DataFrame,
    value: str,
    cuts: Mapping[str, float],
    partition: Sequence[str] = (),
    decimals: int | None = None,
) -> DataFrame:
    """Linear-interpolated quantiles, one row per partition, read off the running counts."""
    keys = list(partition)
    dist = value_distribution(df, value, keys, decimals)
    number, through = F.col(value).cast("double"), F.col("before") + F.col("k")
    picks, results = [], []
    for i, (name, q) in enumerate(cuts.items()):
        position = F.lit(float(q)) * (F.col("total") - 1).cast("double")
        picks += [
            F.min(F.when(through > F.floor(position), number)).alias(f"_low{i}"),
            F.min(F.when(through > F.ceil(position), number)).alias(f"_high{i}"),
            F.max(position - F.floor(position)).alias(f"_part{i}"),
        ]
        low, high = F.col(f"_low{i}"), F.col(f"_high{i}")
        results.append((low + (high - low) * F.col(f"_part{i}")).alias(name))
    grouped = dist.groupBy(*keys).agg(*picks) if keys else dist.agg(*picks)
    return grouped.select(*keys, *results)


def exact_quantile(df: DataFrame, value: str, q: float, out: str, decimals: int | None = None) -> DataFrame:
    return exact_quantiles(df, value, {out: q}, (), decimals)


def dense_key(
    df: DataFrame,
    order: Sequence[str | Column],
    out: str,
    name: str,
    finish: Callable[[DataFrame], DataFrame] = lambda sorted_rows: sorted_rows,
) -> DataFrame:
    """Number the rows 1..n in sort order without a one-task window.

    ``finish`` is a projection applied after the sort, because a range sort reads
    its input twice (once to sample the bounds): costly columns belong there.

    The range-sorted rows are written once with (task, position in task); the
    row count of each task, one number per sort partition, gives the offsets. The
    written table fixes the numbering, so later reads and retries cannot change it.
    """
    tagged = write_shared(finish(df.orderBy(*order)).withColumn("_at", F.monotonically_increasing_id()), name, SMALL_FILES)
    task = F.shiftright(F.col("_at"), _MAX_POSITION_BITS)
    sizes = {r["t"]: r["n"] for r in tagged.groupBy(task.alias("t")).agg(F.count(F.lit(1)).alias("n")).collect()}
    starts, seen = [], 0
    for t in range(max(sizes, default=0) + 1):
        starts.append(seen)
        seen += sizes.get(t, 0)
    offsets = F.split(F.lit(",".join(map(str, starts))), ",").cast("array<bigint>")  # folded to one constant
    inside = F.col("_at").bitwiseAND(F.lit((1 << _MAX_POSITION_BITS) - 1))
    key = F.element_at(offsets, (task + 1).cast("int")) + inside + 1
    return tagged.withColumn(out, key.cast("bigint")).drop("_at")


def with_next(df: DataFrame, group: str, order: Sequence[str], columns: Mapping[str, str], name: str) -> DataFrame:
    """Add columns of the next row of the same group, without a window over the group.

    Rows are numbered densely by (group, order), then joined to their successor by
    number: both sides of the join are unique, however many rows a group has.
    """
    placed = dense_key(df, [group, *order], "_place", name)
    after = placed.select(
        (F.col("_place") - 1).alias("_place"), F.col(group).alias("_next_group"),
        *[F.col(source).alias(f"_next_{out}") for out, source in columns.items()],
    )
    same = F.col(group) == F.col("_next_group")
    return placed.join(after, "_place", "left").select(
        *df.columns, *[F.when(same, F.col(f"_next_{out}")).alias(out) for out in columns]
    )
