"""The eight marts and the provider SQL mart.

Shared shape: facts are summed to the entity first and only then joined to the
dimensions, so joins see one row per entity. That entity table is written once,
because every percentile reads one of its columns again. Percentiles come from
``functions.ranking`` (no one-task windows); sums of money are exact decimals.
Where a claim count is a distinct count in the definition, it is a plain count
here: ``claim_key`` is the key of the claim table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..fixed_values import HCC_TIERS, MEMBER_TIERS, PROVIDER_TIERS, READMISSION_TIERS
from ..functions.expr import band, money_total, per, total
from ..functions.joins import left_join_rare
from ..functions.ranking import Rank, exact_quantile, with_pct_ranks
from ..session import write_shared
from .star import claims_of_year, enrich_episodes, risk_of_year

SCORE_PLACES = 6


def weighted(parts: list[tuple[float, Column]]) -> Column:
    """Weighted sum in the written order, cut to six places."""
    terms = [F.lit(weight) * col for weight, col in parts]
    return F.round(reduce(lambda a, b: a + b, terms), SCORE_PLACES)


def first_match(rules: list[tuple[Column, str]], otherwise: str) -> Column:
    """The label of the first rule that is true; null conditions count as false."""
    result = F.when(rules[0][0], F.lit(rules[0][1]))
    for condition, label in rules[1:]:
        result = result.when(condition, F.lit(label))
    return result.otherwise(F.lit(otherwise))


def numbered_copies(dimension: DataFrame, columns: list[str], out: str) -> DataFrame:
    """``columns`` of a dimension with equal rows numbered from 1: a fact row that meets a key twice counts twice."""
    counted = dimension.groupBy(*columns).agg(F.count(F.lit(1)).cast("int").alias("_n"))
    return counted.select(*columns, F.explode(F.sequence(F.lit(1), F.col("_n"))).alias(out))


def claims_financials(star: dict[str, DataFrame]) -> DataFrame:
    """Sums per month and label. Claims are summed per member, month and kind of service, a key that stands for the labels.

    So a member has one row in each group of the mart, and members are counted without a distinct count.
    """
    measures = {
        "denied_claims": "denied_flag", "inpatient_claims": "inpatient_flag",
        "ed_claims": "ed_flag", "avoidable_ed_claims": "avoidable_ed_flag",
    }
    money = ["allowed_amount", "paid_amount", "member_responsibility_amount"]
    labels = ["claim_type", "service_line"]
    service = numbered_copies(star["dim_service"].where(F.col("service_key").isNotNull()), ["service_key", *labels], "service_copy")
    # a kind is the first (key, place among the key's labels) of its labels; without any label it is null, as for a
    # service that is not in the dimension
    service = service.withColumn("place", F.dense_rank().over(Window.partitionBy("service_key").orderBy(*labels)))
    first = F.min(F.struct("service_key", "place")).over(Window.partitionBy(*labels))
    service = service.withColumn("first", F.when(F.coalesce(*labels).isNotNull(), first)).select(
        "service_key", "service_copy", F.col("first.service_key").alias("kind"), F.col("first.place").alias("place"), *labels)
    typed = star["fact_claim"].join(service.drop(*labels), "service_key", "left").withColumn("service_copy", F.coalesce("service_copy", F.lit(1)))
    monthly = typed.groupBy("paid_month_key", "member_key", "kind", "place", "service_copy").agg(
        F.count("claim_key").alias("claims"),
        *[money_total(c).alias(c) for c in money],
        *[total(flag).alias(name) for name, flag in measures.items()],
    )
    group = ["paid_month_key", "state_code_member", "plan_type", "claim_type", "service_line", "risk_segment"]
    of_member = ["state_code_member", "plan_type", "risk_segment"]
    member = numbered_copies(star["dim_member"].withColumnRenamed("state_code", "state_code_member"), ["member_key", *of_member], "member_copy")
    once = (F.col("service_copy") == 1) & (F.coalesce("member_copy", F.lit(1)) == 1)
    return (
        monthly.join(member, "member_key", "left")
        .groupBy("paid_month_key", "kind", "place", *of_member)
        .agg(
            total("claims").alias("claims"),
            F.count(F.when(once, F.col("member_key"))).alias("members"),
            *[money_total(c).alias(c) for c in money],
            *[total(name).alias(name) for name in measures],
        )
        .join(service.where("kind IS NOT NULL").select("kind", "place", *labels).distinct(), ["kind", "place"], "left")
        .select(
            *group, "claims", "members",
            *[F.col(c).cast("double").alias(c) for c in money],
            *measures,
            per(F.col("paid_amount"), F.col("claims")).alias("paid_per_claim"),
            per(F.col("denied_claims"), F.col("claims")).alias("denial_rate"),
        )
    )


def member_month_pmpm(star: dict[str, DataFrame]) -> DataFrame:
    group = ["month_key", "state_code", "plan_type", "risk_segment"]
    return (
        star["fact_member_month"].groupBy(*group)
        .agg(
            total("eligible_flag").alias("member_months"),
            # the key of this table is (member, month) and the month is in the group
            F.count("member_key").alias("eligible_members"),
            money_total("paid_amount").alias("paid"),
        )
        .select(
            *group, "member_months", "eligible_members", F.col("paid").cast("double").alias("paid_amount"),
            per(F.col("paid"), F.col("member_months")).alias("pmpm"),
        )
    )


def top_claim_per_member(claim: DataFrame) -> DataFrame:
    """Service and diagnosis key of the dearest claim; ties go to the lowest key."""
    dearest = F.struct("paid_amount", (-F.col("claim_key")).alias("older"))
    return claim.where(F.col("member_key").isNotNull()).groupBy("member_key").agg(
        F.max(F.struct(dearest.alias("by"), "service_key", "primary_diagnosis_key")).alias("top")
    ).select("member_key", "top.service_key", F.col("top.primary_diagnosis_key").alias("diagnosis_key"))


def top_claim_labels(star: dict[str, DataFrame], claim: DataFrame | None = None) -> DataFrame:
    return (
        top_claim_per_member(star["fact_claim"] if claim is None else claim)
        .join(star["dim_service"].select("service_key", "service_line"), "service_key", "left")
        .join(star["dim_diagnosis"].select("diagnosis_key", "diagnosis_group"), "diagnosis_key", "left")
        .select("member_key", "diagnosis_group", "service_line")
    )


def high_cost_member(star: dict[str, DataFrame]) -> DataFrame:
    """Members with claims in the plan year, by the claims of that year."""
    claim = claims_of_year(star).where(F.col("member_key").isNotNull())
    cost = claim.groupBy("member_key").agg(
        money_total("paid_amount").alias("paid"),
        money_total("allowed_amount").alias("allowed"),
        F.count("claim_key").alias("claim_count"),
        total("inpatient_flag").alias("admissions"),
        total("ed_flag").alias("ed_visits"),
        total("avoidable_ed_flag").alias("avoidable_ed_visits"),
        total("denied_flag").alias("denied_claims"),
    )
    risk = risk_of_year(star).select("member_key", "readmission_count", "suspected_hcc_gap_count")
    base = (
        cost.join(star["dim_member"], "member_key", "left")
        .join(top_claim_labels(star, claim), "member_key", "left")
        .join(risk, "member_key", "left")
        .withColumn("gaps", F.coalesce("suspected_hcc_gap_count", F.lit(0)))
    )
    ranked = with_pct_ranks(write_shared(base, "high_cost_base"), [
        Rank("paid", "paid_percentile", decimals=2), Rank("raf_like_score", "raf_pct", decimals=9),
        Rank("admissions", "admissions_pct"), Rank("ed_visits", "ed_visits_pct"), Rank("gaps", "gaps_pct"),
    ])
    score = weighted([
        (0.40, F.col("paid_percentile")), (0.20, F.col("raf_pct")), (0.15, F.col("admissions_pct")),
        (0.15, F.col("ed_visits_pct")), (0.10, F.col("gaps_pct")),
    ])
    action = first_match(
        [
            (F.col("admissions") > 1, "Post-discharge care management"),
            (F.col("avoidable_ed_visits") > 0, "ED diversion and PCP access outreach"),
            (F.col("gaps") > 0, "Risk adjustment chart review"),
            (F.col("paid_percentile") >= 0.90, "Complex care management review"),
        ],
        "Monitor utilization trend",
    )
    member_columns = [c for c in star["dim_member"].columns if c != "member_key"]
    return ranked.withColumn("risk_priority_score", score).select(
        "member_key",
        F.col("paid").cast("double").alias("paid_12m"),
        F.col("allowed").cast("double").alias("allowed_12m"),
        "claim_count", "admissions", "ed_visits", "avoidable_ed_visits", "denied_claims",
        *member_columns, "diagnosis_group", "service_line", "readmission_count", "suspected_hcc_gap_count",
        "paid_percentile", "risk_priority_score",
        band(F.col("risk_priority_score"), *MEMBER_TIERS).alias("priority_tier"),
        action.alias("recommended_intervention"),
    )


def provider_base(star: dict[str, DataFrame]) -> DataFrame:
    """Seven sums per provider with a claim, joined to the provider dimension.

    Sums are formed by provider where the claims lie; only the keys of its distinct members move.
    """
    claim = star["fact_claim"].where(F.col("provider_key").isNotNull())
    pairs = claim.where(F.col("member_key").isNotNull()).select("provider_key", "member_key").distinct()
    members = pairs.groupBy("provider_key").agg(F.count("member_key").alias("members"))
    sums = claim.groupBy("provider_key").agg(
        F.count("claim_key").alias("claims"),
        money_total("paid_amount").alias("paid"),
        money_total("allowed_amount").alias("allowed"),
        total("inpatient_flag").alias("inpatient_claims"),
        total("ed_flag").alias("ed_claims"),
        total("denied_flag").alias("denied_claims"),
    )
    sums = sums.join(members, "provider_key", "left").select(
        "provider_key", "claims", F.coalesce("members", F.lit(0)).cast("bigint").alias("members"), "paid", "allowed",
        "inpatient_claims", "ed_claims", "denied_claims",
    )
    return (
        sums.join(star["dim_provider"], "provider_key", "left")
        .withColumn("payment_per_member", per(F.col("paid"), F.col("members")))
        .withColumn("services_per_member", per(F.col("claims"), F.col("members")))
    )


def provider_performance(star: dict[str, DataFrame]) -> DataFrame:
    returns = star["fact_inpatient_episode"].groupBy("provider_key").agg(
        total("readmission_within_30_days").alias("readmissions"),
        F.count("episode_key").alias("episodes"),
    )
    base = (
        provider_base(star).join(returns, "provider_key", "left")
        .withColumn("readmissions", F.coalesce("readmissions", F.lit(0)))
        .withColumn("episodes", F.coalesce("episodes", F.lit(0)))
        .withColumn("readmission_rate", per(F.col("readmissions"), F.col("episodes")))
    )
    peers = ("specialty_group",)
    ranked = with_pct_ranks(write_shared(base, "provider_base"), [
        Rank("payment_per_member", "peer_cost_percentile", 6, peers),
        Rank("services_per_member", "peer_utilization_percentile", 9, peers),
        Rank("readmission_rate", "readmission_pct", 9), Rank("quality_score", "quality_pct", 9),
    ])
    score = weighted([
        (0.38, F.col("peer_cost_percentile")), (0.25, F.col("peer_utilization_percentile")),
        (0.20, F.col("readmission_pct")), (0.17, F.lit(1.0) - F.col("quality_pct")),
    ])
    ranked = ranked.withColumn("provider_outlier_score", score)
    action = first_match(
        [
            (F.col("provider_outlier_score") >= 0.88, "Provider relations review and payment integrity audit"),
            (F.col("peer_cost_percentile") >= 0.90, "Peer cost benchmark discussion"),
            (F.col("readmission_rate") >= 0.12, "Readmission reduction workflow"),
        ],
        "Monitor peer trend",
    )
    provider_columns = [c for c in star["dim_provider"].columns if c != "provider_key"]
    return ranked.select(
        "provider_key", "claims", "members",
        F.col("paid").cast("double").alias("paid_amount"),
        F.col("allowed").cast("double").alias("allowed_amount"),
        "inpatient_claims", "ed_claims", "denied_claims", *provider_columns, "readmissions", "episodes",
        "payment_per_member", "services_per_member", "readmission_rate", "peer_cost_percentile",
        "peer_utilization_percentile", "provider_outlier_score",
        band(F.col("provider_outlier_score"), *PROVIDER_TIERS).alias("performance_tier"),
        action.alias("recommended_action"),
    )


def readmission_queue(star: dict[str, DataFrame]) -> DataFrame:
    queue = enrich_episodes(star)
    ranked = with_pct_ranks(write_shared(queue, "readmission_base"), [
        Rank("raf_like_score", "raf_pct", 9), Rank("length_of_stay", "stay_pct"),
        Rank("readmission_index", "index_pct", 9), Rank("chronic_condition_count", "chronic_pct", 6),
    ])
    flag = F.col("readmission_within_30_days")
    score = weighted([
        (0.30, F.col("raf_pct")), (0.25, F.col("stay_pct")), (0.20, F.col("index_pct")),
        (0.15, F.col("chronic_pct")), (0.10, flag.cast("double")),
    ])
    return ranked.select(*queue.columns, score.alias("readmission_priority_score")).select(
        "*",
        band(F.col("readmission_priority_score"), *READMISSION_TIERS).alias("priority_tier"),
        F.when(flag == 1, "Review discharge transition and avoidable readmission drivers")
        .otherwise("7-day follow-up, medication reconciliation, PCP access check")
        .alias("recommended_action"),
    )


def fwa_scored(star: dict[str, DataFrame]) -> DataFrame:
    """Every claim with its payment-integrity score and its reasons."""
    claim = star["fact_claim"]
    same = ["member_key", "provider_key", "service_key", "claim_from_date_key"]
    # A claim with a missing key belongs to no group and gets no score.
    known = reduce(lambda a, b: a & b, [F.col(key).isNotNull() for key in same])
    # Both small sides are written first, so their size is known when the join is planned.
    # Of the same-day groups only repeats are kept; every other claim counts one and is not
    # shuffled to learn it, however many repeats there are.
    repeats = write_shared(
        claim.groupBy(*same).agg(F.count("claim_key").alias("similar")).where(F.col("similar") > 1), "repeats"
    )
    paid_by_provider = claim.where(F.col("provider_key").isNotNull()).groupBy("provider_key").agg(
        money_total("paid_amount").alias("provider_paid")
    )
    provider_rank = write_shared(
        with_pct_ranks(
            write_shared(paid_by_provider, "paid_by_provider"),
            [Rank("provider_paid", "provider_paid_percentile", decimals=2)],
        ).select("provider_key", "provider_paid_percentile"),
        "provider_rank",
    )
    ranked = (
        left_join_rare(with_pct_ranks(claim, [Rank("paid_amount", "claim_paid_percentile", decimals=2, measure=True)]), repeats, same)
        .join(provider_rank, "provider_key", "left")
        .withColumn("similar_claim_count", F.when(known, F.coalesce("similar", F.lit(1)).cast("bigint")))
    )
    clipped = F.least(F.greatest(F.col("similar_claim_count"), F.lit(1)), F.lit(4)).cast("double") / F.lit(4.0)
    score = weighted([
        (0.36, F.col("claim_paid_percentile")), (0.26, F.coalesce("provider_paid_percentile", F.lit(0.0))),
        (0.18, clipped), (0.12, F.col("denied_flag").cast("double")), (0.08, F.col("prior_auth_flag").cast("double")),
    ])
    reason = first_match(
        [
            (F.col("similar_claim_count") > 1, "Duplicate-like same-day pattern"),
            (F.col("claim_paid_percentile") >= 0.98, "High paid claim outlier"),
            (F.col("provider_paid_percentile") >= 0.95, "High-volume provider payment pattern"),
            (F.col("denied_flag") == 1, "Denied or adjusted claim"),
        ],
        "Composite anomaly score",
    )
    return ranked.withColumn("fwa_score", F.when(known, score)).withColumn("review_reason", reason).withColumn(
        "recommended_action",
        F.when(F.col("fwa_score") >= 0.82, "SIU/payment integrity review").otherwise("Analyst validation"),
    )


def fwa_queue(star: dict[str, DataFrame]) -> DataFrame:
    """Claims at or above the 82nd percentile of their own score.

    All that a score needs beside the claim lies in small written tables, so scoring is a scan: it runs once to count
    the scores (six places, so at most about a million values, which give the threshold) and once more to keep the
    claims above it. No scored copy is written and no claim moves before the filter. Labels are joined after it.
    """
    scored = fwa_scored(star).select(
        "claim_id", "member_key", "provider_key", "service_key", "primary_diagnosis_key", "paid_amount",
        "similar_claim_count", "fwa_score", "review_reason", "recommended_action",
    )
    cut = exact_quantile(scored.select("fwa_score"), "fwa_score", 0.82, "cut").select(F.round("cut", SCORE_PLACES)).first()[0]
    kept = scored.where(F.col("fwa_score") >= F.lit(cut))
    diagnosis = star["dim_diagnosis"].withColumnRenamed("diagnosis_key", "primary_diagnosis_key")
    return (
        kept.join(star["dim_member"].select("member_key", "member_id"), "member_key", "left")
        .join(star["dim_provider"].select("provider_key", "provider_name", "specialty_group"), "provider_key", "left")
        .join(star["dim_service"].select("service_key", "service_line"), "service_key", "left")
        .join(diagnosis.select("primary_diagnosis_key", "diagnosis_group"), "primary_diagnosis_key", "left")
        .select(
            "claim_id", "member_id", "provider_name", "specialty_group", "service_line", "diagnosis_group",
            F.col("paid_amount").cast("double").alias("paid_amount"), "similar_claim_count", "fwa_score",
            "review_reason", "recommended_action",
        )
    )


def hcc_risk(star: dict[str, DataFrame]) -> DataFrame:
    member = star["dim_member"].select("member_key", "member_id", "state_code", "plan_type")
    risk = risk_of_year(star).join(member, "member_key", "left")
    ranked = with_pct_ranks(risk, [
        Rank("raf_like_score", "raf_percentile", 9), Rank("suspected_hcc_gap_count", "gap_pct"),
        Rank("paid_12m", "paid_pct", 2),
    ])
    score = weighted([
        (0.45, F.col("gap_pct")), (0.35, F.col("raf_percentile")), (0.20, F.col("paid_pct")),
    ])
    return ranked.withColumn("hcc_gap_priority", score).select(
        *[F.col(c).cast("double").alias(c) if c == "paid_12m" else c for c in risk.columns],
        "raf_percentile", "hcc_gap_priority",
        band(F.col("hcc_gap_priority"), *HCC_TIERS).alias("priority_tier"),
    )


def utilization(star: dict[str, DataFrame]) -> DataFrame:
    counts = {
        "admissions": "inpatient_flag", "ed_visits": "ed_flag",
        "avoidable_ed_visits": "avoidable_ed_flag", "pharmacy_claims": "pharmacy_flag",
    }
    used = star["fact_claim"].groupBy(F.col("paid_month_key").alias("month_key")).agg(
        *[total(flag).alias(name) for name, flag in counts.items()]
    )
    months = star["fact_member_month"].groupBy("month_key").agg(
        total("eligible_flag").alias("member_months"), money_total("paid_amount").alias("paid")
    )
    joined = months.join(used, "month_key", "left").select(
        "month_key", "member_months", "paid",
        *[F.coalesce(name, F.lit(0)).cast("bigint").alias(name) for name in counts],
    )
    rate = lambda name: per(F.col(name), F.col("member_months")) * F.lit(1000.0)
    return joined.select(
        "month_key", "member_months", F.col("paid").cast("double").alias("paid_amount"), *counts,
        rate("admissions").alias("admissions_per_1000"),
        rate("ed_visits").alias("ed_visits_per_1000"),
        rate("avoidable_ed_visits").alias("avoidable_ed_per_1000"),
        per(F.col("paid"), F.col("member_months")).alias("pmpm"),
    )


MARTS = {
    "mart_claims_financials": claims_financials,
    "mart_member_month_pmpm": member_month_pmpm,
    "mart_high_cost_member": high_cost_member,
    "mart_provider_performance": provider_performance,
    "mart_readmission_queue": readmission_queue,
    "mart_fwa_queue": fwa_queue,
    "mart_hcc_risk": hcc_risk,
    "mart_utilization": utilization,
}


def build_marts(star: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: build(star) for name, build in MARTS.items()}
