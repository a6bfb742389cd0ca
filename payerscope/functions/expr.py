"""Column expressions shared by every operator.

They spell out the rules that Spark's own functions do not follow by default:
right-closed bands, denominators floored at one, and bad text turning into a
default instead of an error (ANSI mode would raise).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def band(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bands ``(a, b]``; the first also holds its left edge.

    Values outside every band, and nulls, give null. One label more than the
    inner edges means that the last band is open-ended.
    """
    uppers = list(edges[1:])
    result = F.when(value < F.lit(edges[0]), F.lit(None).cast("string"))
    for upper, label in zip(uppers, labels):
        result = result.when(value <= F.lit(upper), F.lit(label))
    if len(labels) > len(uppers):
        result = result.when(value > F.lit(uppers[-1]), F.lit(labels[-1]))
    return result


def per(numerator: Column, denominator: Column) -> Column:
    """Ratio as double with the denominator floored at one (zero counts as one)."""
    return numerator.cast("double") / F.greatest(denominator.cast("double"), F.lit(1.0))


def total(column: str | Column, kind: str = "bigint") -> Column:
    """Sum in which an all-null group counts as zero."""
    col = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.sum(col), F.lit(0)).cast(kind)


def money_total(column: str | Column) -> Column:
    """Exact decimal sum, so the result does not depend on the order of rows."""
    return total(column, "decimal(28,2)")


def number_of(text: Column) -> Column:
    """Text to a finite double; null for missing, bad and endless numbers."""
    parsed = F.trim(text.cast("string")).try_cast("double")
    return F.when(F.abs(parsed) < float("inf"), parsed)  # nan is above infinity


def number_or(text: Column, default: float) -> Column:
    """Text to a double, bad or missing to the default, never below zero."""
    return F.greatest(F.coalesce(number_of(text), F.lit(float(default))), F.lit(0.0))


def flag_number(text: Column) -> Column:
    """Text of a flag to a double: true and false count; null for missing and bad texts."""
    trimmed = F.lower(F.trim(text.cast("string")))
    return F.when(trimmed == "true", F.lit(1.0)).when(trimmed == "false", F.lit(0.0)).otherwise(number_of(trimmed))


def flag_of(text: Column) -> Column:
    """Text to 0 or 1: true and false count, bad or missing is 0, fractions are cut off, then clamped."""
    bounded = F.least(F.greatest(F.coalesce(flag_number(text), F.lit(0.0)), F.lit(-1.0)), F.lit(2.0))
    return F.least(F.greatest(bounded.cast("int"), F.lit(0)), F.lit(1))


def date_key(day: Column) -> Column:
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def month_key(day: Column) -> Column:
    return (F.year(day) * 100 + F.month(day)).cast("int")


def key_to_date(key: Column) -> Column:
    return F.make_date(F.floor(key / 10000).cast("int"), F.floor(key / 100).cast("int") % 100, key % 100)


def matches(text: Column, pattern: str) -> Column:
    """Case-insensitive search as a 0/1 flag; null text does not match."""
    return F.coalesce(text.rlike(f"(?i){pattern}"), F.lit(False)).cast("int")


def hash_share(key: Column, salt: str = "") -> Column:
    """A repeatable number in [0, 1) from a key: the stand-in for a random draw."""
    text = F.concat(F.lit(salt), key.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 6), 16, 10).cast("double") / F.lit(16777216.0)


def pick(index: Column, values: Sequence[str]) -> Column:
    """The value at a zero-based position of a short fixed list."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))
