"""Source feeds cut from the Parquet tables: differently shaped claim inputs and yearly denial counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import plan_of, table

FEED_KINDS = ("Inpatient", "Outpatient", "Professional", "Pharmacy")


def claim_feeds(lines: DataFrame) -> dict[str, DataFrame]:
    """Four inputs with the claims of one type each, as different systems hold them: other names, types and columns.

    ``lines`` are claims with the columns of the claim table and ``claim_type``. Each feed is its own projection of the
    source rows; claims of no known type are in none.
    """
    of = lambda kind: lines.where(F.col("claim_type") == kind)
    day = lambda column, form: F.date_format(F.to_date(F.col(column).cast("string"), "yyyyMMdd"), form)
    return {
        "Inpatient": of("Inpatient").select(
            F.col("claim_id").alias("CLM_ID"), F.col("member_key").alias("BENE_KEY"), F.col("provider_key").alias("PRVDR_KEY"),
            F.to_date(F.col("claim_from_date_key").cast("string"), "yyyyMMdd").alias("CLM_FROM_DT"),
            F.to_date(F.col("claim_thru_date_key").cast("string"), "yyyyMMdd").alias("CLM_THRU_DT"),
            F.col("paid_amount").alias("CLM_PMT_AMT"), F.col("length_of_stay").alias("UTLZTN_DAYS"),
        ),
        "Outpatient": of("Outpatient").select(
            F.col("claim_id").alias("claim id"), F.col("member_key").cast("string").alias("member key"),
            F.col("provider_key").cast("string").alias("provider key"), F.col("claim_from_date_key").cast("string").alias("from date"),
            F.col("claim_thru_date_key").cast("string").alias("thru date"), F.col("paid_amount").cast("string").alias("paid"),
        ),
        "Professional": of("Professional").select(
            F.col("claim_id").alias("ClaimNumber"), F.col("member_key").cast("decimal(18,0)").alias("MemberKey"),
            F.col("provider_key").cast("decimal(18,0)").alias("ProviderKey"), day("claim_from_date_key", "MM/dd/yyyy").alias("ServiceDate"),
            F.concat(F.lit("$"), F.col("paid_amount").cast("string")).alias("PaidAmount"),
        ),
        "Pharmacy": of("Pharmacy").select(
            F.col("claim_id").alias("rx_claim_id"), F.col("member_key").alias("patient_key"),
            F.col("claim_from_date_key").alias("fill_date"), (F.col("paid_amount") * 100).cast("bigint").alias("paid_cents"),
        ),
    }


def denial_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Yearly counts by issuer (the region), state and plan: received, denied, appealed, upheld."""
    line = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_shipdate", "l_returnflag", "l_linenumber", "l_linestatus", "l_tax"
    )
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = F.broadcast(table(spark, folder, "nation").select("n_nationkey", "n_name", "n_regionkey"))
    region = F.broadcast(table(spark, folder, "region").select("r_regionkey", "r_name"))
    denied = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") <= 3)
    appealed = denied & (F.col("l_linestatus") == "F")
    flag = lambda condition: F.sum(condition.cast("bigint"))
    by_member = (
        line.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .groupBy("o_custkey", F.year(F.col("l_shipdate").cast("date")).alias("plan_year"))
        .agg(
            F.count(F.lit(1)).alias("claims_received"), flag(denied).alias("claims_denied"),
            flag(appealed).alias("appeals_filed"), flag(appealed & (F.col("l_tax") > 0.04)).alias("appeals_upheld"),
        )
    )
    return (
        by_member.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            F.col("r_name").alias("issuer"), F.col("n_name").alias("state_code"),
            plan_of(F.col("c_mktsegment")).alias("plan_type"), "plan_year",
            "claims_received", "claims_denied", "appeals_filed", "appeals_upheld",
        )
    )
