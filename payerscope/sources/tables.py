"""Claims star read from order-entry Parquet tables.

The tables at hand describe orders, not claims, so fixed rules present them as
claims: a customer is a member, a supplier a provider, a line item a claim. Every
line item becomes a claim; nothing is filtered out. The rules only derive columns,
so Spark can prune what a query does not use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed_values import (
    AGE_BANDS, COUNTIES, DIAGNOSES, MARKETS, NETWORK_TIERS, RISK_SEGMENTS, SERVICES, SPECIALTIES,
)
from ..functions.expr import MONEY, band, date_key, month_key, pick
from ..functions.joins import bounded
from ..session import inline_table

# How a market segment reads as a plan.
PLAN_BY_SEGMENT = {
    "BUILDING": "MA-PD",
    "FURNITURE": "Dual Eligible SNP",
    "HOUSEHOLD": "Employer Group Waiver",
}
OTHER_PLAN = "Medicare Advantage"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def plan_of(segment: Column) -> Column:
    result = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, plan in PLAN_BY_SEGMENT.items():
        result = result.when(segment == name, F.lit(plan))
    return result.otherwise(F.lit(OTHER_PLAN))


def members(spark: SparkSession, folder: str) -> DataFrame:
    """Member dimension. ``nation`` has 25 rows by definition, so it is broadcast."""
    nation = F.broadcast(table(spark, folder, "nation").select("n_nationkey", "n_name"))
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    key = F.col("c_custkey")
    base = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        key.alias("member_key"),
        F.concat(F.lit("MBR-"), key.cast("string")).alias("member_id"),
        (18 + (key * 7) % 75).cast("int").alias("age"),
        F.when(key % 2 == 0, "Female").otherwise("Male").alias("gender"),
        F.col("n_name").alias("state_code"),
        pick(key % 6, COUNTIES).alias("county_name"),
        plan_of(F.col("c_mktsegment")).alias("plan_type"),
        (key % 6).cast("int").alias("chronic_condition_count"),
        (8 + key % 5).cast("int").alias("eligibility_months"),
    )
    dual = (F.col("plan_type") == "Dual Eligible SNP").cast("int")
    chronic = F.col("chronic_condition_count")
    # a score of our own: it rises with age, conditions and dual eligibility and reaches all four segments
    points = lambda text: F.lit(text).cast("decimal(6,3)")
    raf = (
        points("0.290") + F.col("age").cast("decimal(3,0)") * points("0.005") + chronic.cast("decimal(3,0)") * points("0.210")
        + dual.cast("decimal(3,0)") * points("0.170")
    ).cast("decimal(6,3)")
    scored = base.withColumn("dual_eligible_flag", dual).withColumn("raf_like_score", raf)
    return scored.select(
        "member_key", "member_id", "age", band(F.col("age"), *AGE_BANDS).alias("age_band"), "gender", "state_code",
        "county_name", "plan_type", "dual_eligible_flag", "chronic_condition_count",
        (chronic >= 1).cast("int").alias("diabetes_flag"),
        (chronic >= 2).cast("int").alias("copd_flag"),
        (chronic >= 3).cast("int").alias("chf_flag"),
        (chronic >= 4).cast("int").alias("ckd_flag"),
        (chronic >= 5).cast("int").alias("behavioral_health_flag"),
        F.ceil(chronic * F.lit(0.9)).cast("int").alias("hcc_count"),
        F.col("raf_like_score").cast("double").alias("raf_like_score"),
        band(F.col("raf_like_score"), *RISK_SEGMENTS).alias("risk_segment"),
        "eligibility_months",
    )


def providers(spark: SparkSession, folder: str) -> DataFrame:
    nation = F.broadcast(table(spark, folder, "nation").select("n_nationkey", "n_name"))
    supplier = table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    key = F.col("s_suppkey")
    quality = F.round(
        F.lit("35").cast("decimal(4,0)")
        + (F.col("s_acctbal").cast(MONEY) + F.lit("1000").cast("decimal(6,0)"))
        * F.lit("64").cast("decimal(4,0)") / F.lit("11000").cast("decimal(6,0)"), 2)
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left").select(
        key.alias("provider_key"),
        F.concat(F.lit("SUP-"), key.cast("string")).alias("provider_id"),
        F.col("s_name").alias("provider_name"),
        pick(key % 9, [name for name, _ in SPECIALTIES]).alias("specialty_group"),
        pick(key % 9, [kind for _, kind in SPECIALTIES]).alias("provider_type"),
        F.col("n_name").alias("state_code"),
        pick(key % 4, MARKETS).alias("market"),
        pick(key % 3, NETWORK_TIERS).alias("network_tier"),
        F.greatest(F.least(quality.cast("double"), F.lit(99.0)), F.lit(35.0)).alias("quality_score"),
        ((F.lit(55) + (key * 37) % 121).cast("double") / F.lit(100.0)).alias("readmission_index"),
    )


def services(spark: SparkSession) -> DataFrame:
    rows = [(i, *row) for i, row in enumerate(SERVICES, start=1)]
    return inline_table(
        spark, rows,
        "service_key bigint, claim_type string, service_line string, place_of_service string, "
        "inpatient_default_flag int, ed_default_flag int, base_allowed_amount double",
    )


def diagnoses(spark: SparkSession) -> DataFrame:
    rows = [(i, *row) for i, row in enumerate(DIAGNOSES, start=1)]
    return inline_table(
        spark, rows, "diagnosis_key bigint, diagnosis_code string, diagnosis_group string, hcc_category string"
    )


def submissions(quantity: Column, line: Column) -> Column:
    """How often a line was submitted: full lots repeat, so same-day repeats exist."""
    return F.when((quantity == 50) & (line == 1), F.lit(5)).when(quantity == 50, F.lit(2)).otherwise(F.lit(1))


# The source position ends the order: exact copies of a line still sort apart, so a
# range sort can spread them, and the position is the same on every retry.
SOURCE_POSITION = ["_file", "_row"]
LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "copy"]
CLAIM_ORDER = ["o_custkey", "from_date", *LINE_KEY, *SOURCE_POSITION]


def claim_id() -> Column:
    whole = [F.col(c).cast("int") if c == "l_quantity" else F.col(c) for c in LINE_KEY]
    return F.concat_ws("-", *whole).alias("claim_id")


# Rows of two numbers that may be broadcast: some 100 MB as a hash table.
TWO_COLUMN_ROWS = 2_000_000


def claim_dates(spark: SparkSession, folder: str) -> DataFrame:
    """The dates that claims have, once for each line item: a scan without joins."""
    return table(spark, folder, "lineitem").select(F.col("l_shipdate").cast("date").alias("from_date"))


def claim_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with their order and part. Join sides grow with the data: no hints, but long parts are not broadcast.

    A line moves to its order, its part and its place in a sort, so what is short is made of it before: its day, not
    its time, and whether it was denied, not the texts.
    """
    line = table(spark, folder, "lineitem").select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"),
        F.col("l_shipdate").cast("date").alias("from_date"),
        ((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1)).alias("denied"),
    )
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    part = bounded(table(spark, folder, "part").select("p_partkey", "p_size"), TWO_COLUMN_ROWS)
    repeat = F.explode(F.sequence(F.lit(1), submissions(F.col("l_quantity"), F.col("l_linenumber"))))
    return (
        line.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
        .withColumn("copy", repeat)
        .select(
            "from_date", "o_custkey", *LINE_KEY, "p_size", "l_extendedprice", "l_discount", "l_tax", "denied", *SOURCE_POSITION,
        )
    )


def as_claims(lines: DataFrame) -> DataFrame:
    """The claim columns, all but the surrogate key."""
    service = F.col("service_key")
    shaped = lines.select(
        claim_id(),
        F.col("o_custkey").alias("member_key"),
        F.col("l_suppkey").alias("provider_key"),
        (F.col("l_partkey") % 10 + 1).cast("bigint").alias("service_key"),
        (F.col("p_size") % 10 + 1).cast("bigint").alias("primary_diagnosis_key"),
        "from_date",
        F.col("l_extendedprice").cast(MONEY).alias("allowed_amount"),
        (F.lit(1).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)")).alias("share"),
        F.col("l_tax").cast("decimal(4,2)").alias("tax"),
        "l_linenumber",
        "l_quantity",
        F.col("denied").cast("int").alias("denied_flag"),
    ).withColumn("inpatient_flag", service.isin(6, 7).cast("int")).withColumn("ed_flag", (service == 3).cast("int"))
    stay = F.when(F.col("inpatient_flag") == 1, F.col("l_linenumber") + 2).otherwise(F.lit(0)).cast("int")
    allowed = F.col("allowed_amount")
    return shaped.withColumn("length_of_stay", stay).select(
        "claim_id", "member_key", "provider_key", "service_key", "primary_diagnosis_key",
        date_key(F.col("from_date")).alias("claim_from_date_key"),
        date_key(F.date_add("from_date", F.col("length_of_stay"))).alias("claim_thru_date_key"),
        month_key(F.col("from_date")).alias("paid_month_key"),
        allowed,
        F.when(F.col("denied_flag") == 1, F.lit(0)).otherwise(F.round(allowed * F.col("share"), 2))
        .cast(MONEY).alias("paid_amount"),
        F.round(allowed * F.col("tax"), 2).cast(MONEY).alias("member_responsibility_amount"),
        "length_of_stay", "inpatient_flag", "ed_flag",
        ((F.col("ed_flag") == 1) & (F.col("l_quantity") < 15)).cast("int").alias("avoidable_ed_flag"),
        (service == 8).cast("int").alias("pharmacy_flag"),
        ((F.col("inpatient_flag") == 1) | (allowed > 50000)).cast("int").alias("prior_auth_flag"),
        "denied_flag",
    )


DIAGNOSIS_CODE_COLUMNS = ["icd_dgns_cd1", "icd_dgns_cd2", "icd_dgns_cd3"]
PROCEDURE_CODE_COLUMNS = ["hcpcs_cd1", "hcpcs_cd2"]


def wide_codes(lines: DataFrame) -> DataFrame:
    """Claims as a source holds codes: one column per position, some of them blank."""
    codes = [code for code, _, _ in DIAGNOSES]
    text = lambda col: col.cast("string")
    return lines.select(
        claim_id(), F.col("o_custkey").alias("member_key"), F.col("l_suppkey").alias("provider_key"), F.year("from_date").alias("risk_year"),
        pick(F.col("p_size") % 10, codes).alias(DIAGNOSIS_CODE_COLUMNS[0]),
        F.when(F.col("l_linenumber") % 2 == 0, "  ").otherwise(F.lower(pick(F.col("l_suppkey") % 10, codes)))
        .alias(DIAGNOSIS_CODE_COLUMNS[1]),
        F.when(F.col("l_quantity") >= 25, pick(F.col("l_partkey") % 10, codes)).alias(DIAGNOSIS_CODE_COLUMNS[2]),
        F.concat(F.lit("H"), F.lpad(text(F.col("l_partkey") % 1000), 4, "0")).alias(PROCEDURE_CODE_COLUMNS[0]),
        F.when(F.col("l_tax") < 0.04, F.concat(F.lit("G"), F.lpad(text(F.col("l_suppkey") % 1000), 4, "0")))
        .otherwise("").alias(PROCEDURE_CODE_COLUMNS[1]),
    )
