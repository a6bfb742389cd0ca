"""Derived facts of the star and the enriched views over it."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import MONEY, hash_share, key_to_date, money_total, total
from ..functions.ranking import dense_key

CLAIM_COLUMNS = [
    "claim_key", "claim_id", "member_key", "provider_key", "service_key", "primary_diagnosis_key",
    "claim_from_date_key", "claim_thru_date_key", "paid_month_key", "allowed_amount", "paid_amount",
    "member_responsibility_amount", "length_of_stay", "inpatient_flag", "ed_flag", "avoidable_ed_flag",
    "pharmacy_flag", "prior_auth_flag", "denied_flag",
]
EPISODE_COLUMNS = [
    "episode_key", "claim_key", "member_key", "provider_key", "admission_date_key", "discharge_date_key",
    "length_of_stay", "principal_diagnosis_key", "readmission_within_30_days", "days_to_readmission",
]
NO_READMISSION_DAYS = 9999


def keyed_claims(
    lines: DataFrame, order: Sequence[str], finish: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> DataFrame:
    """Claims with a dense key in the stated order (member, date, id), written once.

    The sort that gives the key also clusters the table by member, so row-group
    statistics prune later reads of a member or a period.
    """
    return dense_key(lines, order, "claim_key", "fact_claim", finish).select(*CLAIM_COLUMNS)


def member_months(member: DataFrame, claim: DataFrame, plan_years: Iterable[int]) -> DataFrame:
    """Member x eligible month; claims outside those months do not count.

    A member's months are made after its sums have met it: what moves is one row per member and one per member and
    month with claims, not the grid. Each member holds one sum a calendar month at most.
    """
    monthly = claim.where(F.col("paid_month_key").isNotNull()).groupBy("member_key", "paid_month_key").agg(F.sum("paid_amount").alias("paid"))
    paid = monthly.groupBy("member_key").agg(F.map_from_entries(F.collect_list(F.struct("paid_month_key", "paid"))).alias("paid"))
    years = F.array(*[F.lit(int(y)) for y in plan_years]).cast("array<int>")
    months = F.flatten(F.transform(years, lambda y: F.transform(
        F.sequence(F.lit(1), F.col("eligibility_months").cast("int")), lambda month: y * 100 + month)))
    member = member.select("member_key", "eligibility_months", "plan_type", "state_code", "risk_segment").where(F.col("eligibility_months") >= 1)
    return member.join(paid, "member_key", "left").withColumn("month_key", F.explode(months)).select(
        "member_key", "month_key", F.lit(1).alias("eligible_flag"), "plan_type", "state_code", "risk_segment",
        F.coalesce(F.element_at("paid", F.col("month_key")), F.lit(0)).cast(MONEY).alias("paid_amount"),
    )


def inpatient_gaps(claim: DataFrame) -> DataFrame:
    """Inpatient claims with the next admission of the same member.

    In (date, claim) order the next admission falls on the same day unless the row
    is the last of its day; then it is the member's next admission day. So the
    window runs over distinct (member, day) pairs, of which a member has no more
    than the calendar has days, and a member holding very many claims never lands
    in one task.
    """
    stays = claim.where(F.col("inpatient_flag") == 1)
    days = stays.groupBy("member_key", "claim_from_date_key").agg(F.max("claim_key").alias("last_of_day"))
    by_member = Window.partitionBy("member_key").orderBy("claim_from_date_key")
    days = days.withColumn("later_day", F.lead("claim_from_date_key").over(by_member))
    next_key = F.when(F.col("claim_key") < F.col("last_of_day"), F.col("claim_from_date_key")).otherwise(
        F.col("later_day")
    )
    gap = F.datediff(key_to_date(F.col("next_admission_key")), key_to_date(F.col("claim_thru_date_key")))
    return (
        stays.join(days, ["member_key", "claim_from_date_key"], "left")  # a stay without a member stays
        .withColumn("next_admission_key", next_key)
        .withColumn("gap_days", gap)
    )


def readmission_columns(gap):
    """(flag, days): within 0..30 days; missing reads 9999 and overlaps read 0."""
    flag = F.coalesce(gap.between(0, 30), F.lit(False)).cast("int")
    days = F.greatest(F.coalesce(gap, F.lit(NO_READMISSION_DAYS)), F.lit(0)).cast("int")
    return flag, days


def episodes(claim: DataFrame) -> DataFrame:
    """One row per inpatient claim, numbered in (member, admission) order."""
    flag, days = readmission_columns(F.col("gap_days"))
    rows = inpatient_gaps(claim).select(
        "claim_key", "member_key", "provider_key",
        F.col("claim_from_date_key").alias("admission_date_key"),
        F.col("claim_thru_date_key").alias("discharge_date_key"),
        "length_of_stay",
        F.col("primary_diagnosis_key").alias("principal_diagnosis_key"),
        flag.alias("readmission_within_30_days"),
        days.alias("days_to_readmission"),
    )
    order = ["member_key", "admission_date_key", "claim_key"]
    return dense_key(rows, order, "episode_key", "fact_inpatient_episode").select(*EPISODE_COLUMNS)


def override_readmissions(episode: DataFrame, source: DataFrame) -> DataFrame:
    """Take the readmission flag from the source rows (``claim_key``, ``readmission_flag``)."""
    given = source.select("claim_key", F.coalesce("readmission_flag", F.lit(0)).cast("int").alias("given"))
    flag = F.coalesce("given", F.lit(0))
    days = F.col("days_to_readmission")
    return (
        episode.join(given, "claim_key", "left")
        .withColumn("readmission_within_30_days", flag)
        .withColumn("days_to_readmission", F.when(flag == 1, F.least(days, F.lit(30))).otherwise(days).cast("int"))
        .select(*EPISODE_COLUMNS)
    )


WIDEST_GAP = 5


def years_with_claims(claim: DataFrame) -> dict[int, int]:
    """Dated claims by year: at most one row a calendar year comes to the driver."""
    year = F.floor(F.col("claim_from_date_key") / 10000).cast("int")
    found = claim.where(F.col("claim_from_date_key").isNotNull()).groupBy(year.alias("year")).agg(F.count(F.lit(1)).alias("k"))
    return {r["year"]: r["k"] for r in found.collect()}


def claim_years(claim: DataFrame, widest_gap: int = WIDEST_GAP) -> list[int]:
    """The plan years, first to last, of the claims; none without dated claims.

    Years more than ``widest_gap`` apart from their neighbours are another period: the one with most claims counts
    (of equals the later), so a date typed wrong adds no years to every member. ``claims_outside`` counts the rest.
    """
    counts = years_with_claims(claim)
    periods: list[list[int]] = []
    for year in sorted(counts):
        if periods and year - periods[-1][-1] <= widest_gap:
            periods[-1].append(year)
        else:
            periods.append([year])
    if not periods:
        return []
    best = max(periods, key=lambda years: (sum(counts[y] for y in years), years))
    return list(range(best[0], best[-1] + 1))


def claims_outside(claim: DataFrame, years: Sequence[int]) -> DataFrame:
    """One row: claims without a date in the plan years."""
    year = F.floor(F.col("claim_from_date_key") / 10000)
    inside = year.between(min(years), max(years)) if years else F.lit(False)
    return claim.agg(F.count_if(~F.coalesce(inside, F.lit(False))).alias("v"))


# Key of a star whose claims are one plan year by definition, whatever their dates (a claims file).
ONE_PLAN = "_one_plan"


def risk_of_year(star: Mapping[str, DataFrame], year: int | None = None) -> DataFrame:
    """The member risk rows of one plan year, by default the last one: the year comes along as a one-row join."""
    risk = star["fact_member_risk"]
    if year is not None:
        return risk.where(F.col("plan_year") == year)
    return risk.join(F.broadcast(risk.agg(F.max("plan_year").alias("plan_year"))), "plan_year").select(*risk.columns)


def claims_of_year(star: Mapping[str, DataFrame], year: int | None = None) -> DataFrame:
    """The claims that the member risk rows of that plan year, by default the last one, sum up."""
    claim = star["fact_claim"]
    if star.get(ONE_PLAN):
        return claim
    dated = F.floor(F.col("claim_from_date_key") / 10000)
    if year is not None:
        return claim.where(dated == year)
    last = star["fact_member_risk"].agg(F.max("plan_year").alias("_last"))
    return claim.join(F.broadcast(last), dated == F.col("_last"), "left_semi")


def member_risk(
    member: DataFrame, claim: DataFrame, episode: DataFrame, plan_years: Iterable[int], one_plan: bool = False
) -> DataFrame:
    """One row per member and plan year with that year's claims; the random part of the gap is a hash of both.

    With ``one_plan`` there is one plan year and all claims belong to it, whatever their dates.
    """
    plan_years = [int(y) for y in plan_years]
    keys = ["member_key", "plan_year"]
    dated = lambda column: F.floor(F.col(column) / 10000).cast("int")
    year = lambda column: (F.lit(plan_years[0]) if one_plan else dated(column)).alias("plan_year")
    cost = claim.groupBy("member_key", year("claim_from_date_key")).agg(
        money_total("paid_amount").alias("paid_12m"),
        F.count("claim_key").alias("claim_count"),
        total("ed_flag").alias("ed_visits"),
        total("inpatient_flag").alias("admissions"),
    )
    returns = episode.groupBy("member_key", year("admission_date_key")).agg(total("readmission_within_30_days").alias("readmission_count"))
    draw = (hash_share(F.concat_ws("-", "member_key", "plan_year"), "gap-") < 0.18).cast("int")
    gap = F.greatest(
        (F.col("chronic_condition_count") - F.col("hcc_count") + draw).cast("int"), F.lit(0)
    )
    zero = lambda name: F.coalesce(name, F.lit(0)).cast("bigint").alias(name)
    return (
        member.select(
            "member_key", "hcc_count", "raf_like_score", "risk_segment", "chronic_condition_count",
            "dual_eligible_flag", F.explode(F.array(*[F.lit(y) for y in plan_years]).cast("array<int>")).alias("plan_year"),
        )
        .join(cost, keys, "left")
        .join(returns, keys, "left")
        .select(
            *keys, "hcc_count", "raf_like_score", "risk_segment",
            "chronic_condition_count", "dual_eligible_flag",
            F.coalesce("paid_12m", F.lit(0)).cast("decimal(28,2)").alias("paid_12m"),
            zero("claim_count"), zero("ed_visits"), zero("admissions"), zero("readmission_count"),
            gap.alias("suspected_hcc_gap_count"),
        )
        .withColumn(
            "risk_adjustment_action",
            F.when(F.col("suspected_hcc_gap_count") > 0, "Chart review and provider documentation outreach")
            .otherwise("Monitor annual wellness and chronic recapture"),
        )
    )


def with_suffix(df: DataFrame, column: str, suffix: str) -> DataFrame:
    return df.withColumnRenamed(column, f"{column}_{suffix}")


def enrich_claims(star: dict[str, DataFrame]) -> DataFrame:
    """Claims with the columns of all four dimensions; unmatched claims stay."""
    diagnosis = star["dim_diagnosis"].withColumnRenamed("diagnosis_key", "primary_diagnosis_key")
    return (
        star["fact_claim"]
        .join(with_suffix(star["dim_member"], "state_code", "member"), "member_key", "left")
        .join(with_suffix(star["dim_provider"], "state_code", "provider"), "provider_key", "left")
        .join(star["dim_service"], "service_key", "left")
        .join(diagnosis, "primary_diagnosis_key", "left")
    )


def enrich_episodes(star: dict[str, DataFrame]) -> DataFrame:
    diagnosis = star["dim_diagnosis"].withColumnRenamed("diagnosis_key", "principal_diagnosis_key")
    return (
        star["fact_inpatient_episode"]
        .join(with_suffix(star["dim_member"], "state_code", "member"), "member_key", "left")
        .join(with_suffix(star["dim_provider"], "state_code", "provider"), "provider_key", "left")
        .join(diagnosis, "principal_diagnosis_key", "left")
    )
