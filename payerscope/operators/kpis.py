"""Headline figures and the row sets behind the charts and queues."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import money_total, per, total


def kpi_summary(tables: Mapping[str, DataFrame], quality: DataFrame) -> DataFrame:
    """One row of figures; each comes from a one-row aggregate as a scalar subquery."""
    spark = tables["fact_claim"].sparkSession
    one = lambda df, col: df.agg(col.alias("v")).scalar()
    count_where = lambda df, condition: one(df, F.count_if(condition))
    claim, pmpm = tables["fact_claim"], tables["mart_member_month_pmpm"]
    weighted = per(F.sum(F.col("paid_amount").cast("decimal(28,2)")), F.sum("member_months"))
    rate = F.coalesce(F.avg(F.col("readmission_within_30_days").cast("double")), F.lit(0.0))
    return spark.range(1).select(
        one(claim, F.count(F.lit(1))).alias("claims"),
        one(tables["dim_member"], F.count(F.lit(1))).alias("members"),
        one(claim, money_total("paid_amount").cast("double")).alias("paid"),
        one(pmpm, weighted).alias("pmpm"),
        one(tables["fact_inpatient_episode"], rate).alias("readmission_rate"),
        count_where(tables["mart_high_cost_member"], F.col("priority_tier") == "Complex care").alias("complex_members"),
        count_where(tables["mart_provider_performance"], F.col("performance_tier") == "Intervention")
        .alias("provider_interventions"),
        one(tables["mart_fwa_queue"], F.count(F.lit(1))).alias("fwa_cases"),
        count_where(quality, F.col("status") == "FAIL").alias("quality_failures"),
    )


def pmpm_trend(pmpm: DataFrame) -> DataFrame:
    """Per month: the plain mean of the segment figures, and the month's sums.

    The mean is taken over values cut to six places, as exact decimals, so it does
    not depend on the order in which tasks finish.
    """
    return pmpm.groupBy("month_key").agg(
        per(F.sum(F.col("pmpm").cast("decimal(28,6)")), F.count("pmpm")).alias("pmpm"),
        money_total(F.col("paid_amount").cast("decimal(28,2)")).cast("double").alias("paid_amount"),
        total("member_months").alias("member_months"),
    )


def risk_cost(high_cost: DataFrame) -> DataFrame:
    return high_cost.where(F.col("risk_segment").isNotNull()).groupBy("risk_segment").agg(
        money_total(F.col("paid_12m").cast("decimal(28,2)")).cast("double").alias("paid_12m"),
        # one row per member in this mart
        F.count("member_key").alias("members"),
    )


# queue name: (mart, entity key, score, rows shown)
QUEUES = {
    "provider_chart": ("mart_provider_performance", "provider_key", "provider_outlier_score", 150),
    "providers": ("mart_provider_performance", "provider_key", "provider_outlier_score", 250),
    "high_cost": ("mart_high_cost_member", "member_key", "risk_priority_score", 400),
    "readmissions": ("mart_readmission_queue", "episode_key", "readmission_priority_score", 350),
    "fwa": ("mart_fwa_queue", "claim_id", "fwa_score", 350),
    "hcc": ("mart_hcc_risk", "member_key", "hcc_gap_priority", 350),
}


def top_rows(tables: Mapping[str, DataFrame], queue: str) -> DataFrame:
    """The first rows of one queue with all its columns (a per-task top-k, then a merge)."""
    mart, key, score, size = QUEUES[queue]
    return tables[mart].orderBy(F.desc(score), key).limit(size)


def top_n_queues(tables: Mapping[str, DataFrame]) -> DataFrame:
    parts = [
        top_rows(tables, queue).select(
            F.lit(queue).alias("queue"), F.col(key).cast("string").alias("entity"), F.col(score).alias("score")
        )
        for queue, (_, key, score, _) in QUEUES.items()
    ]
    return reduce(DataFrame.unionByName, parts)
