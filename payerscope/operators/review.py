"""Provider review: peer ranking, audit flags, features, monthly facts, denial rates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import money_total, per, total
from ..functions.ranking import average_rank_share, null_safe_join, percent_rank_of, value_distribution
from ..session import write_shared
from .care import readmission_30day, year_of
from .marts import SCORE_PLACES, first_match


def peer_percent_rank(df: DataFrame, value: str, out: str, peers: list[str], dense: str | None = None) -> DataFrame:
    """Percent rank of ``value`` among peers, and on request its dense rank from the top."""
    dist = value_distribution(df, value, peers, decimals=6)
    columns = [percent_rank_of(F.col("before"), F.col("total")).alias(out)]
    if dense:
        columns.append((F.col("distinct_total") - F.col("distinct_before")).cast("int").alias(dense))
    return dist.select(*peers, value, *columns)


def provider_year_base(star: Mapping[str, DataFrame]) -> DataFrame:
    service = star["dim_service"].select("service_key", "claim_type")
    pairs = (
        star["fact_claim"].join(service, "service_key", "left")
        .groupBy("provider_key", year_of("claim_from_date_key").alias("measurement_year"), "member_key")
        .agg(
            F.count("claim_key").alias("claims"), money_total("paid_amount").alias("paid"),
            F.count_if(F.col("claim_type") == "Inpatient").alias("admissions"),
        )
    )
    peers = star["dim_provider"].select("provider_key", F.col("specialty_group").alias("provider_peer_group"))
    return pairs.groupBy("provider_key", "measurement_year").agg(
        total("claims").alias("claim_count"), F.count("member_key").alias("unique_member_count"),
        money_total("paid").alias("paid"), total("admissions").alias("admissions"),
    ).join(peers, "provider_key", "left")


def provider_peer_rank(star: Mapping[str, DataFrame]) -> DataFrame:
    """A provider-year among its peers; no index stay ranks below every rate."""
    returns = readmission_30day(star).groupBy(
        F.col("facility_provider_key").alias("provider_key"), F.year("discharge_date").alias("measurement_year")
    ).agg(total("readmission_30day_flag").alias("returns"), F.count(F.lit(1)).alias("stays"))
    base = (
        provider_year_base(star).join(returns, ["provider_key", "measurement_year"], "left")
        .withColumn("readmissions_30day", F.coalesce("returns", F.lit(0)).cast("bigint"))
        .withColumn("readmission_rate", F.col("readmissions_30day").cast("double") / F.col("stays").cast("double"))
        .withColumn("paid_per_member", per(F.col("paid"), F.col("unique_member_count")))
        .withColumn("paid_per_claim", per(F.col("paid"), F.col("claim_count")))
        .withColumn("rate_order", F.coalesce("readmission_rate", F.lit(-1.0)))
    )
    base = write_shared(base.drop("returns", "stays"), "provider_year")
    peers = ["provider_peer_group", "measurement_year"]
    cost = peer_percent_rank(base, "paid_per_member", "provider_cost_percentile", peers, "provider_rank")
    rate = peer_percent_rank(base, "rate_order", "readmission_percentile", peers)
    ranked = null_safe_join(null_safe_join(base, cost, [*peers, "paid_per_member"]), rate, [*peers, "rate_order"])
    return ranked.select(
        "provider_key", *peers, "claim_count", "unique_member_count",
        F.col("paid").cast("double").alias("total_paid_amount"), "paid_per_member", "paid_per_claim", "admissions",
        "readmissions_30day", "readmission_rate", "provider_cost_percentile", "readmission_percentile",
        F.round(F.lit(0.60) * F.col("provider_cost_percentile") + F.lit(0.40) * F.col("readmission_percentile"),
                SCORE_PLACES).alias("composite_outlier_score"),
        "provider_rank",
    )


def fwa_provider_flags(star: Mapping[str, DataFrame]) -> DataFrame:
    """Providers in the top five percent of their peers by paid or claims per member."""
    pairs = star["fact_claim"].groupBy("provider_key", "member_key").agg(
        F.count("claim_key").alias("claims"), money_total("paid_amount").alias("paid")
    )
    peers = star["dim_provider"].select("provider_key", F.col("specialty_group").alias("provider_peer_group"))
    base = pairs.groupBy("provider_key").agg(
        total("claims").alias("claim_count"), F.count("member_key").alias("member_count"), money_total("paid").alias("paid")
    ).join(peers, "provider_key", "left").withColumn(
        "claims_per_member", per(F.col("claim_count"), F.col("member_count"))
    ).withColumn("paid_per_member", per(F.col("paid"), F.col("member_count")))
    base = write_shared(base, "provider_audit")
    group = ["provider_peer_group"]
    paid = peer_percent_rank(base, "paid_per_member", "paid_per_member_pct", group)
    claims = peer_percent_rank(base, "claims_per_member", "claims_per_member_pct", group)
    high_paid, high_claims = F.col("paid_per_member_pct") >= 0.95, F.col("claims_per_member_pct") >= 0.95
    ranked = null_safe_join(null_safe_join(base, paid, [*group, "paid_per_member"]), claims, [*group, "claims_per_member"])
    return ranked.select(
        "provider_key", *group, "claim_count", "member_count",
        F.col("paid").cast("double").alias("total_paid_amount"), "claims_per_member", "paid_per_member",
        "paid_per_member_pct", "claims_per_member_pct",
        high_paid.cast("int").alias("high_paid_per_member_flag"),
        high_claims.cast("int").alias("high_claims_per_member_flag"),
        first_match(
            [
                (high_paid & high_claims, "High priority SIU review"),
                (high_paid, "Payment outlier review"),
                (high_claims, "Utilization pattern review"),
            ],
            "Monitor",
        ).alias("audit_recommendation"),
    )


def provider_month(star: Mapping[str, DataFrame]) -> DataFrame:
    pairs = star["fact_claim"].groupBy("provider_key", F.col("paid_month_key").alias("month_key"), "member_key").agg(
        F.count("claim_key").alias("claims"), money_total("paid_amount").alias("paid"),
        money_total("allowed_amount").alias("allowed"),
        *[total(f).alias(f) for f in ("inpatient_flag", "ed_flag", "denied_flag")],
    )
    return pairs.groupBy("provider_key", "month_key").agg(
        total("claims").alias("claim_count"), F.count("member_key").alias("member_count"),
        money_total("paid").cast("double").alias("paid_amount"),
        money_total("allowed").cast("double").alias("allowed_amount"),
        total("inpatient_flag").alias("admissions"), total("ed_flag").alias("ed_visits"),
        total("denied_flag").alias("denied_claims"),
    )


def provider_place_mix(star: Mapping[str, DataFrame]) -> DataFrame:
    """The share of each place of service among a provider's claims of a year: one row a place, whatever its name."""
    keys = ["provider_key", "feature_year"]
    service = star["dim_service"].select("service_key", "place_of_service")
    counted = star["fact_claim"].groupBy("provider_key", year_of("claim_from_date_key").alias("feature_year"), "service_key").agg(
        F.count(F.lit(1)).alias("k")
    ).join(service, "service_key", "left").groupBy(*keys, "place_of_service").agg(F.sum("k").alias("claims"))
    all_claims = F.sum("claims").over(Window.partitionBy(*keys))  # as many rows as there are places
    return counted.select(*keys, "place_of_service", "claims", (F.col("claims").cast("double") / all_claims.cast("double")).alias("claim_share"))


def provider_year_features(star: Mapping[str, DataFrame], procedures: DataFrame) -> DataFrame:
    """Provider-year features: volume, repeats, concentration and diversity of services, diagnoses and procedures.

    ``procedures`` has a row (provider_key, feature_year, procedure_code) for each code of a claim.
    """
    keys = ["provider_key", "feature_year"]
    claim = star["fact_claim"].withColumn("feature_year", year_of("claim_from_date_key"))
    volume = claim.groupBy(*keys, "member_key").agg(
        F.count("claim_key").alias("claims"), money_total("paid_amount").alias("paid")
    ).groupBy(*keys).agg(
        total("claims").alias("total_claims"), F.count("member_key").alias("unique_members"), money_total("paid").alias("paid")
    )
    repeats = claim.groupBy(*keys, "member_key", "service_key", "claim_from_date_key").agg(
        F.count("claim_key").alias("k")
    ).groupBy(*keys).agg(total(F.col("k") - 1).alias("same_day_duplicates"))
    services = claim.groupBy(*keys, "service_key").agg(F.count("claim_key").alias("k")).groupBy(*keys).agg(
        per(F.max("k"), F.sum("k")).alias("top_service_share"), F.count("service_key").alias("service_diversity"),
    )
    codes = procedures.groupBy(*keys, "procedure_code").agg(F.count(F.lit(1)).alias("k")).groupBy(*keys).agg(
        per(F.max("k"), F.sum("k")).alias("top_procedure_share"), F.count("procedure_code").alias("procedure_diversity"),
    )
    diagnoses = claim.groupBy(*keys, "primary_diagnosis_key").agg(F.count("claim_key").alias("k")).groupBy(*keys).agg(
        F.count("primary_diagnosis_key").alias("diagnosis_diversity")
    )
    stays = star["fact_inpatient_episode"].groupBy(
        "provider_key", year_of("discharge_date_key").alias("feature_year")
    ).agg(total("readmission_within_30_days").alias("back"), F.count("episode_key").alias("stays"))
    peers = star["dim_provider"].select("provider_key", "specialty_group")
    base = (
        volume.join(repeats, keys).join(services, keys).join(diagnoses, keys).join(codes, keys, "left")
        .join(stays, keys, "left").join(peers, "provider_key", "left")
        .withColumn("paid_per_member", per(F.col("paid"), F.col("unique_members")))
        .withColumn("readmission_rate", per(F.coalesce("back", F.lit(0)), F.coalesce("stays", F.lit(0))))
    )
    base = write_shared(base.drop("back", "stays"), "provider_year_features")
    group = ["specialty_group", "feature_year"]
    ranks = value_distribution(base, "paid_per_member", group, decimals=6).select(
        *group, "paid_per_member",
        average_rank_share(F.col("before"), F.col("k"), F.col("total")).alias("peer_paid_percentile"),
    )
    return null_safe_join(base, ranks, [*group, "paid_per_member"], "left").select(
        *keys, "specialty_group", "total_claims", "unique_members", "paid_per_member",
        per(F.col("paid"), F.col("total_claims")).alias("paid_per_claim"),
        per(F.col("total_claims"), F.col("unique_members")).alias("claims_per_member"), "same_day_duplicates",
        "top_service_share", "service_diversity", "diagnosis_diversity",
        F.coalesce("top_procedure_share", F.lit(0.0)).alias("top_procedure_share"),
        F.coalesce("procedure_diversity", F.lit(0)).cast("bigint").alias("procedure_diversity"), "readmission_rate", "peer_paid_percentile",
    )


def denial_benchmark(counts: DataFrame) -> DataFrame:
    """Denial, appeal and upheld rates from (issuer, state, plan, year, four counts)."""
    group = ["issuer", "state_code", "plan_type", "plan_year"]
    n = lambda c: F.col(c)
    summed = counts.groupBy(*group).agg(*[
        total(c).alias(c) for c in ("claims_received", "claims_denied", "appeals_filed", "appeals_upheld")
    ])
    return summed.select(
        "*", per(n("claims_denied"), n("claims_received")).alias("denial_rate"),
        per(n("appeals_filed"), n("claims_denied")).alias("appeal_rate"),
        per(n("appeals_upheld"), n("appeals_filed")).alias("upheld_rate"),
    )
