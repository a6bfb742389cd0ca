"""A loosely named claims extract of the Parquet tables: what a source file looks like, for queries and tests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import DIAGNOSES, SERVICES
from ..functions.expr import MONEY, pick
from ..sources.tables import SOURCE_POSITION, claim_id

EXTRACT_SERVICES = [row[:2] for row in SERVICES] + [("Inpatient rehab", "Rehab unit"), ("Clinic", "Biomedical lab")]
EXTRACT_CONDITIONS = [row[1] for row in DIAGNOSES] + ["Dental", "Vision"]
EXTRACT_SPECIALTIES = [
    "Primary care", "Cardiology", "Regional HOSPITAL", "Radiology", "Surgical facility", "Oncology", "Pharmacy",
]
EXTRACT_PLANS = ["Medicare Advantage", "MA-PD", "Dual Eligible SNP", "dual plus"]
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
NUMBER = "_number"  # the claim number of lines that were sorted by it: then the line moves without the parts of it
EXTRACT_ORDER = ["Claim Number", *SOURCE_POSITION]


def loose_extract(lines: DataFrame, with_readmission: bool = False) -> DataFrame:
    """All claim lines as a source file would hold them: text only, free header
    names, and bad cells of every kind that coercion has to deal with."""
    line, part, member = F.col("l_linenumber"), F.col("l_partkey") % 12, F.col("o_custkey")
    price, tax = F.col("l_extendedprice").cast(MONEY), F.col("l_tax").cast("decimal(4,2)")
    share = F.lit(1).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)")
    iso = lambda date: date.cast("string")
    year, month, dom = (F.substring(iso(F.col("from_date")), at, n) for at, n in ((1, 4), (6, 2), (9, 2)))
    short = lambda digits: F.regexp_replace(digits, "^0", "")
    text = lambda col: col.cast("string")
    none = F.lit(None).cast("string")
    number = F.col(NUMBER) if NUMBER in lines.columns else claim_id()
    cols = [
        number.alias("Claim Number"),
        F.concat(F.lit("B"), text(member)).alias(" Bene ID "),
        F.concat(F.lit("N"), text(F.col("l_suppkey"))).alias("NPI"),
        F.when(line == 2, none).when(line == 3, F.concat(F.lit('Supplier "'), text(F.col("l_suppkey")), F.lit('",\nsecond site')))
        .otherwise(F.concat(F.lit("Supplier "), text(F.col("l_suppkey")))).alias("Facility"),
        pick(F.col("l_suppkey") % 7, EXTRACT_SPECIALTIES).alias("Specialty"),
        pick(part, [t for t, _ in EXTRACT_SERVICES]).alias("Setting"),
        pick(part, [s for _, s in EXTRACT_SERVICES]).alias("Department"),
        pick(F.col("p_size") % 12, EXTRACT_CONDITIONS).alias("Condition"),
        F.when(tax == F.lit("0.08").cast("decimal(4,2)"), "n/a").when(tax == F.lit("0.07").cast("decimal(4,2)"), "-5")
        .when(tax == F.lit("0.06").cast("decimal(4,2)"), "Infinity")
        .otherwise(text(price)).alias("Allowed"),
        F.when(F.col("l_discount") == 0.1, none).when(F.col("denied"), "0")
        .otherwise(text(F.round(price * share, 2).cast(MONEY))).alias("Paid"),
        text(F.round(price * tax, 2).cast(MONEY)).alias("Copay"),
        F.when(line == 1, "not a date").when(line == 2, F.concat_ws("/", month, dom, year)).when(line == 3, F.concat(year, month, dom))
        .when(line == 4, F.concat(iso(F.col("from_date")), F.lit("T00:00:00"))).when(line == 5, F.concat_ws("/", year, month, dom))
        .when(line == 6, F.concat(pick(month.cast("int") - 1, MONTHS), F.lit(" "), short(dom), F.lit(", "), year))
        .otherwise(iso(F.col("from_date"))).alias("Service Date"),
        F.when(line == 7, none).when(line == 6, F.concat_ws(".", short(dom), short(month), year)).when(line == 5, F.concat_ws("/", month, dom, year))
        .otherwise(iso(F.date_add(F.col("from_date"), line - 3))).alias("Through Date"),
        F.when(part == 5, "1").when(part == 6, "3").when(part == 7, "yes").when(part == 8, "True").when(part == 9, "false")
        .otherwise("0").alias("Is Inpatient"),
        F.when(part == 2, "1").when(part == 3, "0.9").otherwise(none).alias("Is ED"),
        F.when(line == 1, none).otherwise(F.concat(F.lit("S"), text(member % 25))).alias("State"),
        pick(member % 4, EXTRACT_PLANS).alias("Plan"),
        text((member % 6).cast("decimal(4,1)") + F.when(line == 4, F.lit("0.5").cast("decimal(4,1)"))
             .otherwise(F.lit("0").cast("decimal(4,1)"))).alias("Chronic Count"),
        text((F.lit("0.41").cast("decimal(6,3)") + (member % 6).cast("decimal(3,0)") * F.lit("0.19").cast("decimal(6,3)"))
             .cast("decimal(6,3)")).alias("Risk Score"),
        F.lit("free text").alias("Notes"),
        *[F.col(c) for c in SOURCE_POSITION],
    ]
    if with_readmission:
        cols.append(F.when(line.isin(1, 3), "1").otherwise("0").alias("Readmission Flag"))
    return lines.select(*cols)
