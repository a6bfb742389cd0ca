"""Loosely named claims files: header aliases, defaults, coercion, and the star from them.

Only the header is resolved on the driver. ``claim_key`` is the number of the row in its file (or in a stated order,
for other sources); it also gives the default ids.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed_values import (
    AGE_BANDS, COLUMN_ALIASES, DATE_COLUMNS, FLAG_COLUMNS, MISSING_TEXTS, NUMBER_DEFAULTS, RISK_SEGMENTS, TEXT_DEFAULTS,
)
from ..functions.dates import date_of, day_first_columns
from ..functions.expr import MONEY, band, date_key, flag_number, flag_of, matches, month_key, number_of, number_or
from ..functions.ranking import dense_key, small_side
from ..operators.star import CLAIM_COLUMNS
from ..session import SMALL_FILES, write_shared
from .csv_scan import ROW, scan_records
from .tables import diagnoses, services

MONEY_COLUMNS = ["allowed_amount", "paid_amount", "member_responsibility_amount"]
def is_missing(text: Column) -> Column:
    return text.isNull() | F.trim(text).isin(MISSING_TEXTS)


def scan_csv(spark: SparkSession, path: str) -> DataFrame:
    """A header CSV, all text, with the number of each row. Texts such as N/A are missing cells."""
    rows = scan_records(spark, path)
    return rows.select(*[F.when(~is_missing(quoted(c)), quoted(c)).alias(c) for c in rows.columns if c != ROW], ROW)


def resolve_headers(columns: Sequence[str]) -> dict[str, str]:
    """Canonical name to actual column: the first alias present wins; of two
    columns that read alike once trimmed and lowered, the later one counts."""
    readable = {name.strip().lower().replace(" ", "_"): name for name in columns}
    found = {}
    for canonical, aliases in COLUMN_ALIASES.items():
        hit = next((alias for alias in aliases if alias in readable), None)
        if hit is not None:
            found[canonical] = readable[hit]
    return found


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def canonicalize(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Canonical columns only (and ``keep``); everything else is dropped."""
    found = resolve_headers([c for c in raw.columns if c not in keep])
    return raw.select(*[quoted(actual).alias(name) for name, actual in found.items()], *keep)


def date_forms(data: DataFrame) -> Mapping[str, bool]:
    """For each date column that the source has: whether it writes the day before the month."""
    return day_first_columns(data, [name for name in DATE_COLUMNS if name in data.columns])


def coerce(data: DataFrame, plan_year: int, forms: Mapping[str, bool], keep: Sequence[str] = ()) -> DataFrame:
    """Typed columns: an absent column, a bad cell and a bad date get their default.

    Missing cells of text columns stay missing. Ids are left to ``default_ids``. ``forms`` comes from ``date_forms``.
    ``data`` should be a table or a scan: each cell is read several times here.
    """
    have = set(data.columns)
    source = lambda name: F.col(name) if name in have else F.lit(None).cast("string")
    cols = [F.col(name) for name in ("claim_id", "member_id", "provider_id") if name in have]
    cols += [(F.col(n) if n in have else F.lit(d)).alias(n) for n, d in TEXT_DEFAULTS.items()]
    for name, default in NUMBER_DEFAULTS.items():
        number = number_or(source(name), default)
        cols.append((number.cast(MONEY) if name in MONEY_COLUMNS else number).alias(name))
    cols += [flag_of(source(name)).alias(name) for name in FLAG_COLUMNS]
    start, end = (date_of(source(name), forms.get(name, False)) for name in DATE_COLUMNS)
    first = F.coalesce(start, F.make_date(F.lit(plan_year), F.lit(1), F.lit(1)))
    typed = data.select(*cols, first.alias(DATE_COLUMNS[0]), end.alias(DATE_COLUMNS[1]), *keep)
    return typed.withColumn(DATE_COLUMNS[1], F.greatest(*DATE_COLUMNS))  # a missing end gives the start


def defaulted_cells(data: DataFrame, forms: Mapping[str, bool]) -> DataFrame:
    """One row per typed column: cells in all, missing, unreadable, below zero, and how many took a default.

    An absent column has no cells and takes the default in every row. Dates of the order of day and month that
    their column does not use are unreadable. Nothing takes a default without being counted here.
    """
    names = [*NUMBER_DEFAULTS, *FLAG_COLUMNS, *DATE_COLUMNS]
    read = {n: number_of for n in NUMBER_DEFAULTS} | {n: flag_number for n in FLAG_COLUMNS}
    read |= {n: lambda text, n=n: date_of(text, forms.get(n, False)) for n in DATE_COLUMNS}
    counts = [F.count(F.lit(1)).alias("rows")]
    for name in names:
        if name in data.columns:
            missing, found = is_missing(F.col(name)), read[name](F.col(name))
            low = found < 0 if name not in DATE_COLUMNS else F.lit(False)
            counts.append(F.struct(
                F.count_if(missing).alias("missing"), F.count_if(~missing & found.isNull()).alias("unreadable"), F.count_if(low).alias("low"),
            ).alias(name))
    seen = data.agg(*counts)
    rows = []
    for name in names:
        part = lambda field: F.col(f"{name}.{field}") if name in data.columns else F.lit(0).cast("bigint")
        cells = F.col("rows") if name in data.columns else F.lit(0).cast("bigint")
        rows.append(F.struct(
            F.lit(name).alias("column_name"), cells.alias("cells"), part("missing").alias("missing_cells"),
            part("unreadable").alias("unreadable_cells"), part("low").alias("raised_to_zero"),
            (F.col("rows") - cells + part("missing") + part("unreadable")).alias("defaulted_cells"),
        ))
    return seen.select(F.inline(F.array(*rows)))


def default_ids(rows: DataFrame, row_count: int) -> DataFrame:
    """Ids for absent id columns from the row number (``claim_key`` counts from one)."""
    position = F.col("claim_key") - 1
    made = {
        "claim_id": F.concat(F.lit("CUSTOM"), pad(F.col("claim_key"), 6)),
        "member_id": F.concat(F.lit("MEM"), pad(position % max(1, row_count // 3) + 1, 5)),
        "provider_id": F.concat(F.lit("PRV"), pad(position % max(1, row_count // 5) + 1, 5)),
    }
    for name, value in made.items():
        if name not in rows.columns:
            rows = rows.withColumn(name, value)
    return rows


def pad(number: Column, width: int) -> Column:
    """Zero-padded text that never cuts a longer number."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def load_cells(raw: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """The canonical cells of a source as a written table, so that the source is read once.

    Rows of ``scan_csv`` bring their number as ``claim_key``; other sources keep the columns of the stated order.
    """
    if not order:
        return write_shared(canonicalize(raw, [ROW]).withColumnRenamed(ROW, "claim_key"), "claims_cells", SMALL_FILES)
    ordered = raw.select("*", *[quoted(name).alias(place) for name, place in zip(order, order_columns(order))])
    return write_shared(canonicalize(ordered, order_columns(order)), "claims_cells", SMALL_FILES)


def order_columns(order: Sequence[str]) -> list[str]:
    return [f"_order_{i}" for i in range(len(order))]


def load_rows(cells: DataFrame, plan_year: int, order: Sequence[str] = ()) -> tuple[DataFrame, bool]:
    """Typed rows with ``claim_key``, and whether the source brought a readmission flag; no rows are an error.

    The rows of a file are numbered already: they are read from the written cells, each column where it is used. Those
    of another source are sorted once by the stated order.
    """
    forms = date_forms(cells)
    if order:
        rows = dense_key(cells, order_columns(order), "claim_key", "claims_file", lambda found: coerce(found, plan_year, forms))
    else:
        rows = coerce(cells, plan_year, forms, ["claim_key"])
    row_count = cells.count()
    if row_count == 0:
        raise ValueError("the claims file has no rows")
    return default_ids(rows, row_count), "readmission_flag" in cells.columns


def first_seen(column: str) -> Column:
    """First non-null value in row order."""
    return F.min_by(column, F.when(F.col(column).isNotNull(), F.col("claim_key"))).alias(column)


def member_dim(rows: DataFrame) -> DataFrame:
    grouped = rows.where(F.col("member_id").isNotNull()).groupBy("member_id").agg(
        first_seen("state_code"), first_seen("plan_type"),
        F.max("chronic_condition_count").alias("chronic_condition_count"),
        F.max("raf_like_score").alias("raf_like_score"),
    )
    chronic = F.col("chronic_condition_count")
    age = F.least(F.greatest(F.lit(64.0) + chronic * 5, F.lit(18.0)), F.lit(92.0)).cast("int")
    several = (chronic > 1).cast("int")
    return dense_key(grouped, ["member_id"], "member_key", "dim_member").withColumn("age", age).select(
        "member_key", "member_id", "age", band(F.col("age"), *AGE_BANDS).alias("age_band"),
        F.lit("Unknown").alias("gender"), "state_code", F.lit("Custom").alias("county_name"), "plan_type",
        matches(F.col("plan_type"), "dual").alias("dual_eligible_flag"), "chronic_condition_count",
        *[several.alias(f"{c}_flag") for c in ("diabetes", "copd", "chf", "ckd", "behavioral_health")],
        F.ceil(chronic * F.lit(0.9)).cast("int").alias("hcc_count"), "raf_like_score",
        band(F.col("raf_like_score"), *RISK_SEGMENTS).alias("risk_segment"),
        F.lit(12).alias("eligibility_months"),
    )


def provider_dim(rows: DataFrame) -> DataFrame:
    grouped = rows.where(F.col("provider_id").isNotNull()).groupBy("provider_id").agg(
        first_seen("provider_name"), first_seen("specialty_group"), first_seen("state_code")
    )
    facility = matches(F.col("specialty_group"), "(facility|hospital)") == 1
    return dense_key(grouped, ["provider_id"], "provider_key", "dim_provider").select(
        "provider_key", "provider_id", "provider_name", "specialty_group",
        F.when(facility, "Facility").otherwise("Professional").alias("provider_type"), "state_code",
        F.lit("Custom").alias("market"), F.lit("Standard").alias("network_tier"),
        F.lit(78.0).alias("quality_score"), F.lit(1.0).alias("readmission_index"),
    )


def service_dim(rows: DataFrame) -> DataFrame:
    """Distinct (type, line) in first-seen order; seeds are ten rows, so broadcast."""
    pairs = rows.groupBy("claim_type", "service_line").agg(F.min("claim_key").alias("seen"))
    known = F.broadcast(services(rows.sparkSession).drop("service_key"))
    keyed = dense_key(pairs, ["seen"], "service_key", "dim_service")
    return keyed.join(known, ["claim_type", "service_line"], "left").select(
        "service_key", "claim_type", "service_line",
        F.coalesce("place_of_service", "claim_type").alias("place_of_service"),
        F.coalesce("inpatient_default_flag", matches(F.col("claim_type"), "inpatient")).alias("inpatient_default_flag"),
        F.coalesce("ed_default_flag", matches(F.col("service_line"), "(emergency|ed)")).alias("ed_default_flag"),
        F.coalesce("base_allowed_amount", F.lit(250.0)).alias("base_allowed_amount"),
    )


def diagnosis_dim(rows: DataFrame) -> DataFrame:
    groups = rows.groupBy("diagnosis_group").agg(F.min("claim_key").alias("seen"))
    known = F.broadcast(diagnoses(rows.sparkSession).drop("diagnosis_key"))
    return dense_key(groups, ["seen"], "diagnosis_key", "dim_diagnosis").join(known, "diagnosis_group", "left").select(
        "diagnosis_key", F.coalesce("diagnosis_code", F.lit("CUSTOM")).alias("diagnosis_code"), "diagnosis_group",
        F.coalesce("hcc_category", F.lit("HCC0")).alias("hcc_category"),
    )


def claim_fact(rows: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Natural keys to surrogate keys by left joins, with the derived claim columns.

    Providers and members are counted, so a claim moves only where they are too many to broadcast. Members are joined
    last: a claim then moves as numbers and two ids, without its texts.
    """
    service = dims["dim_service"].select(
        "service_key", F.col("claim_type").alias("_type"), F.col("service_line").alias("_line")
    )
    diagnosis = dims["dim_diagnosis"].select(
        F.col("diagnosis_key").alias("primary_diagnosis_key"), F.col("diagnosis_group").alias("_group")
    )
    joined = (
        rows.join(service, rows["claim_type"].eqNullSafe(F.col("_type"))
                  & rows["service_line"].eqNullSafe(F.col("_line")), "left")
        .join(diagnosis, rows["diagnosis_group"].eqNullSafe(F.col("_group")), "left")
    )
    start, end = F.col("claim_from_date"), F.col("claim_thru_date")
    inpatient, paid = F.col("inpatient_flag"), F.col("paid_amount")
    derived = joined.select(
        "claim_key", "claim_id", "member_id", "provider_id", "service_key", "primary_diagnosis_key",
        date_key(start).alias("claim_from_date_key"), date_key(end).alias("claim_thru_date_key"),
        month_key(start).alias("paid_month_key"), *MONEY_COLUMNS,
        F.greatest(F.datediff(end, start), F.lit(0)).alias("length_of_stay"), "inpatient_flag", "ed_flag",
        ((F.col("ed_flag") == 1) & (paid < 1800)).cast("int").alias("avoidable_ed_flag"),
        matches(F.col("claim_type"), "pharmacy").alias("pharmacy_flag"),
        ((inpatient == 1) | (F.col("allowed_amount") > 3500)).cast("int").alias("prior_auth_flag"),
        (paid <= 0).cast("int").alias("denied_flag"),
    )
    return (
        derived.join(small_side(dims["dim_provider"].select("provider_id", "provider_key")), "provider_id", "left").drop("provider_id")
        .join(small_side(dims["dim_member"].select("member_id", "member_key")), "member_id", "left").select(*CLAIM_COLUMNS)
    )
