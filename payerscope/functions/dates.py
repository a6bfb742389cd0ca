"""Dates as people write them, and which order of day and month a column uses."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_REST = r"(?:[T ].*)?$"
# Shape of a text, and how its parts make year-month-day; the second of a pair is for columns with the day first.
YEAR_FIRST = (r"^(\d{4})[/.](\d{1,2})[/.](\d{1,2})" + _REST, "$1-$2-$3")
COMPACT = (r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
YEAR_LAST = (r"^(\d{1,2})[/.-](\d{1,2})[/.-](\d{4})" + _REST, "$3-$1-$2", "$3-$2-$1")
MONTH_NAMED = (r"^([A-Za-z]{3,9})\.? +(\d{1,2}),? +(\d{4})$", "$3 $1 $2")
DAY_NAMED = (r"^(\d{1,2})[ -]([A-Za-z]{3,9})\.?[ -](\d{4})$", "$3 $2 $1")
ISO = r"^\d{4}-\d{1,2}-\d{1,2}" + _REST
MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec"


def clean(text: Column) -> Column:
    return F.trim(text.cast("string"))


def named_month(text: Column) -> Column:
    """``year name day`` with the month as a number; no month of that name gives null."""
    parts = F.split(text, " ")
    at = F.position(F.lower(F.substring(parts[1], 1, 3)), F.lit(MONTHS))
    return F.when((at > 0) & (at % 4 == 1), F.concat_ws("-", parts[0], F.floor((at + 3) / 4).cast("string"), parts[2]))


def date_of(text: Column, day_first: bool = False) -> Column:
    """Text to a date; null for what no shape fits and for days that do not exist.

    Known are year-month-day (also with a time of day, which is cut off, and as eight digits), month and day in front of
    the year with ``/``, ``.`` or ``-``, and months by name. Each shape is tested before anything is converted.
    """
    raw = clean(text)
    order = 2 if day_first else 1
    written = (
        F.when(raw.rlike(ISO), raw)
        .when(raw.rlike(COMPACT[0]), F.regexp_replace(raw, *COMPACT))
        .when(raw.rlike(YEAR_LAST[0]), F.regexp_replace(raw, YEAR_LAST[0], YEAR_LAST[order]))
        .when(raw.rlike(YEAR_FIRST[0]), F.regexp_replace(raw, *YEAR_FIRST))
        .when(raw.rlike(MONTH_NAMED[0]), named_month(F.regexp_replace(raw, *MONTH_NAMED)))
        .when(raw.rlike(DAY_NAMED[0]), named_month(F.regexp_replace(raw, *DAY_NAMED)))
    )
    return written.try_cast("date")


def day_first_columns(data: DataFrame, columns: Sequence[str]) -> Mapping[str, bool]:
    """Whether a column writes the day before the month, by one pass over all its cells.

    Only texts with the year last can differ. A first number over 12 can only be a day, a second one over 12 speaks
    for the month in front; the larger count wins, and the month in front if both are equal. Cells of the other
    order are then unreadable: ``date_of`` gives null for them and they are counted like any bad cell.
    """
    if not columns:
        return {}
    cells = data.select(F.inline(F.array(*[F.struct(F.lit(name).alias("column"), clean(F.col(name)).alias("raw")) for name in columns])))
    parts = F.split(F.col("raw"), "[/.-]")
    doubtful = cells.where(F.col("raw").rlike(YEAR_LAST[0])).select(
        "column", parts[0].try_cast("int").alias("first"), parts[1].try_cast("int").alias("second"))
    seen = doubtful.groupBy("column").agg(
        F.count_if((F.col("first") > 12) & (F.col("second") <= 12)).alias("day"),
        F.count_if((F.col("second") > 12) & (F.col("first") <= 12)).alias("month"),
    ).collect()
    first = {r["column"]: r["day"] > r["month"] for r in seen}
    return {name: first.get(name, False) for name in columns}
