"""Cost over time: monthly paid by type, segment PMPM, rolling PMPM, KPI formulas."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import key_to_date, money_total, per, total
from ..functions.ranking import exact_quantiles, null_safe_join, value_distribution
from .star import risk_of_year

PAID_BY_TYPE = {
    "medical_paid_amount": "claim_type <> 'Pharmacy'",
    "pharmacy_paid_amount": "claim_type = 'Pharmacy'",
    "inpatient_paid_amount": "claim_type = 'Inpatient'",
    "outpatient_paid_amount": "claim_type = 'Outpatient'",
    "professional_paid_amount": "claim_type = 'Professional'",
}


def _monthly_exact(star: Mapping[str, DataFrame]) -> DataFrame:
    service = star["dim_service"].select("service_key", "claim_type")
    by_type = {n: F.sum(F.when(F.expr(rule), F.col("paid_amount")).otherwise(0)) for n, rule in PAID_BY_TYPE.items()}
    return (
        star["fact_claim"].join(service, "service_key", "left")
        .groupBy("member_key", F.col("paid_month_key").alias("year_month"))
        .agg(
            *[F.coalesce(col, F.lit(0)).cast("decimal(28,2)").alias(name) for name, col in by_type.items()],
            money_total("paid_amount").alias("total_paid_amount"),
        )
        .join(star["dim_member"].select("member_key"), "member_key", "left_semi")
    )


def monthly_paid_by_type(star: Mapping[str, DataFrame]) -> DataFrame:
    exact = _monthly_exact(star)
    return exact.select(
        "member_key", "year_month",
        *[F.col(c).cast("double").alias(c) for c in [*PAID_BY_TYPE, "total_paid_amount"]],
    )


SEGMENT = ["year_month", "state_code", "age_band", "risk_segment"]


def segment_pmpm(star: Mapping[str, DataFrame]) -> DataFrame:
    """Per segment and month; members without a risk row of that year are 'Unassigned'."""
    amounts = ["total_paid_amount", *PAID_BY_TYPE]
    risk = star["fact_member_risk"].select(
        "member_key", F.col("plan_year").alias("year"), F.col("risk_segment").alias("assigned")
    )
    eligible = star["fact_member_month"].where(F.col("eligible_flag") == 1).select(
        "member_key", F.col("month_key").alias("year_month"), F.floor(F.col("month_key") / 100).cast("int").alias("year")
    )
    return (
        eligible.join(star["dim_member"].select("member_key", "state_code", "age_band"), "member_key")
        .join(_monthly_exact(star), ["member_key", "year_month"], "left")
        .join(risk, ["member_key", "year"], "left")
        .withColumn("risk_segment", F.coalesce("assigned", F.lit("Unassigned")))
        .groupBy(*SEGMENT)
        .agg(F.count(F.lit(1)).alias("eligible_member_months"), *[money_total(a).alias(a) for a in amounts])
        .withColumn("pmpm", per(F.col("total_paid_amount"), F.col("eligible_member_months")))
        .select(
            *SEGMENT, "eligible_member_months", *[F.col(a).cast("double").alias(a) for a in amounts], "pmpm"
        )
    )


def rolling_pmpm(star: Mapping[str, DataFrame]) -> DataFrame:
    """Mean of the last 3 and 12 monthly figures; a segment has one row per month.

    Figures enter the mean as exact six-place decimals, so it is repeatable.
    """
    by_month = Window.partitionBy("state_code", "age_band", "risk_segment").orderBy("year_month")
    figure = F.col("pmpm").cast("decimal(28,6)")

    def mean_of(last: int) -> Column:
        frame = by_month.rowsBetween(1 - last, 0)
        return F.sum(figure).over(frame).cast("double") / F.count(figure).over(frame).cast("double")

    return segment_pmpm(star).select(
        *SEGMENT, "eligible_member_months", "pmpm",
        mean_of(3).alias("rolling_3m_pmpm"), mean_of(12).alias("rolling_12m_pmpm"),
    )


def dim_date(star: Mapping[str, DataFrame]) -> DataFrame:
    """Every day from the first to the last claim date."""
    ends = star["fact_claim"].agg(
        F.min("claim_from_date_key").alias("a"), F.max("claim_thru_date_key").alias("z")
    )
    day = F.col("calendar_date")
    return ends.select(
        F.explode(F.sequence(key_to_date(F.col("a")), key_to_date(F.col("z")))).alias("calendar_date")
    ).select(
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"), day, F.year(day).alias("calendar_year"),
        F.quarter(day).alias("calendar_quarter"), F.month(day).alias("calendar_month"),
        F.date_format(day, "yyyyMM").cast("int").alias("year_month"),
        F.dayofmonth(day).alias("day_of_month"), (F.weekday(day) + 1).alias("iso_weekday"),
    )


def cost_concentration(paid: DataFrame, share: float) -> DataFrame:
    """Share of paid that the top ``share`` of members hold; the edge value counts in part."""
    dist = value_distribution(paid, "paid_12m", decimals=2)
    size = F.ceil(F.col("total") * F.lit(share))
    above = F.col("total") - F.col("before") - F.col("k")
    taken = F.least(F.greatest(size - above, F.lit(0)), F.col("k"))
    amount = F.col("paid_12m").cast("decimal(18,2)")
    return dist.agg(
        per(F.sum(amount * taken.cast("decimal(18,0)")), F.sum(amount * F.col("k").cast("decimal(18,0)"))).alias("v")
    )


def kpi_dictionary(star: Mapping[str, DataFrame]) -> DataFrame:
    """One row per KPI formula."""
    claim = star["fact_claim"].agg(
        F.count(F.lit(1)).alias("n"), money_total("paid_amount").alias("paid"), money_total("allowed_amount").alias("allowed"),
        total("inpatient_flag").alias("adm"), total("ed_flag").alias("ed"), total("denied_flag").alias("denied"),
        total(F.col("inpatient_flag") * F.col("length_of_stay")).alias("days"),
    )
    months = star["fact_member_month"].agg(total("eligible_flag").alias("mm"), money_total("paid_amount").alias("mm_paid"))
    stays = star["fact_inpatient_episode"].agg(
        F.count(F.lit(1)).alias("stays"), total("readmission_within_30_days").alias("back")
    )
    repeats = star["fact_claim"].groupBy("member_key", "provider_key", "service_key", "claim_from_date_key").agg(
        F.count(F.lit(1)).alias("k")
    ).agg(total(F.col("k") - 1).alias("extra"))
    spark = star["fact_claim"].sparkSession
    base = spark.range(1).select(*[
        frame.select(column).scalar().alias(column)
        for frame in (claim, months, stays, repeats) for column in frame.columns
    ])
    c = F.col
    formulas = {
        "total_paid_amount": c("paid").cast("double"),
        "allowed_amount": c("allowed").cast("double"),
        "paid_per_claim": per(c("paid"), c("n")),
        "eligible_member_months": c("mm").cast("double"),
        "pmpm": per(c("mm_paid"), c("mm")),
        "admissions_per_1000": per(c("adm"), c("mm")) * F.lit(12000.0),
        "ed_visits_per_1000": per(c("ed"), c("mm")) * F.lit(12000.0),
        "inpatient_days_per_1000": per(c("days"), c("mm")) * F.lit(12000.0),
        "average_length_of_stay": per(c("days"), c("adm")),
        "readmission_rate_30day": per(c("back"), c("stays")),
        "duplicate_claim_rate": per(c("extra"), c("n")),
        "denial_rate": per(c("denied"), c("n")),
    }
    rows = F.array(*[
        F.struct(F.lit(name).alias("kpi"), F.round(value, 6).alias("value")) for name, value in formulas.items()
    ])
    parts = [base.select(F.inline(rows))]
    for percent in (1, 5, 10):
        parts.append(cost_concentration(risk_of_year(star), percent / 100.0).select(
            F.lit(f"cost_concentration_top_{percent}_pct").alias("kpi"), F.round("v", 6).alias("value")
        ))
    return reduce(DataFrame.unionByName, parts)


def risk_kpis(rollup: DataFrame) -> DataFrame:
    """Per year: mean risk score of member-years and the share of last year's HCCs that came back."""
    score = F.col("raf_score_estimate").cast("decimal(18,3)")
    return rollup.groupBy("risk_year").agg(
        F.round(per(F.sum(score), F.count(score)), 6).alias("raf_average"),
        F.round(
            per(F.sum("recaptured_hcc_count"), F.sum(F.col("recaptured_hcc_count") + F.col("suspected_gap_count"))), 6
        ).alias("hcc_recapture_rate"),
    )


def high_cost_member_rate(flags: DataFrame) -> DataFrame:
    """Per year: high-cost members over all members with claims."""
    return flags.groupBy("measurement_year").agg(
        F.count(F.lit(1)).alias("members"), total("high_cost_flag").alias("high_cost_members"),
        F.round(per(F.sum("high_cost_flag"), F.count(F.lit(1))), 6).alias("high_cost_member_rate"),
    )


def reconciliation(star: Mapping[str, DataFrame], source: DataFrame) -> DataFrame:
    """Row counts and paid totals by layer; ``source`` has one row per raw claim."""
    def layer(name: str, df: DataFrame, rows: Column, paid: Column) -> DataFrame:
        return df.agg(rows.alias("row_count"), paid.cast("double").alias("paid_amount")).select(
            F.lit(name).alias("layer"), "row_count", "paid_amount"
        )

    every = F.count(F.lit(1))
    return reduce(DataFrame.unionByName, [
        layer("raw", source, every, money_total("paid_amount")),
        layer("gold_claim", star["fact_claim"], every, money_total("paid_amount")),
        layer("gold_member_month", star["fact_member_month"], every, money_total("paid_amount")),
        layer("gold_member_risk", star["fact_member_risk"], total("claim_count"), money_total("paid_12m")),
        layer("mart_claims_financials", star["mart_claims_financials"], total("claims"),
              money_total(F.col("paid_amount").cast("decimal(28,2)"))),
    ])


def profile_claims(star: Mapping[str, DataFrame]) -> DataFrame:
    """Per claim type: rows, missing share, paid quantiles and mean stay."""
    service = star["dim_service"].select("service_key", "claim_type")
    claim = star["fact_claim"].join(service, "service_key", "left").select(
        "claim_type", "paid_amount", "length_of_stay", "primary_diagnosis_key"
    )
    counts = claim.groupBy("claim_type").agg(
        F.count(F.lit(1)).alias("row_count"),
        per(F.count_if(F.col("primary_diagnosis_key").isNull()), F.count(F.lit(1))).alias("missing_diagnosis_share"),
        F.min("paid_amount").cast("double").alias("paid_min"),
        F.max("paid_amount").cast("double").alias("paid_max"),
        per(F.sum("paid_amount"), F.count("paid_amount")).alias("paid_mean"),
        per(F.sum("length_of_stay"), F.count("length_of_stay")).alias("mean_length_of_stay"),
    )
    cuts = {"paid_p25": 0.25, "paid_p50": 0.50, "paid_p75": 0.75, "paid_p99": 0.99}
    quantiles = exact_quantiles(claim, "paid_amount", cuts, ["claim_type"], decimals=2)
    return null_safe_join(counts, quantiles.select("claim_type", *[F.round(n, 6).alias(n) for n in cuts]), ["claim_type"])


def profile_diagnosis_groups(star: Mapping[str, DataFrame], top: int = 10) -> DataFrame:
    """The diagnosis groups with the highest paid amounts; claims are summed per diagnosis before they meet the names."""
    per_code = star["fact_claim"].groupBy(F.col("primary_diagnosis_key").alias("diagnosis_key")).agg(
        F.count(F.lit(1)).alias("k"), F.sum("paid_amount").alias("p")
    )
    groups = star["dim_diagnosis"].select("diagnosis_key", "diagnosis_group")
    return per_code.join(groups, "diagnosis_key", "left").groupBy("diagnosis_group").agg(
        total("k").alias("claims"), F.sum("p").cast("double").alias("paid_amount")
    ).orderBy(F.desc("paid_amount"), "diagnosis_group").limit(top)


def profile_monthly_volume(star: Mapping[str, DataFrame]) -> DataFrame:
    """Claims and paid amount by month and claim type."""
    per_service = star["fact_claim"].groupBy("paid_month_key", "service_key").agg(
        F.count(F.lit(1)).alias("k"), F.sum("paid_amount").alias("p")
    )
    types = star["dim_service"].select("service_key", "claim_type")
    return per_service.join(types, "service_key", "left").groupBy(F.col("paid_month_key").alias("month_key"), "claim_type").agg(
        total("k").alias("claims"), F.sum("p").cast("double").alias("paid_amount")
    )


def profile_stays(star: Mapping[str, DataFrame]) -> DataFrame:
    """Distribution of the length of stay over episodes."""
    return star["fact_inpatient_episode"].groupBy("length_of_stay").agg(F.count(F.lit(1)).alias("episodes"))


def profile_age_bands(star: Mapping[str, DataFrame]) -> DataFrame:
    """Per age band: members, the share with a chronic condition, episodes and the readmission rate."""
    stays = star["fact_inpatient_episode"].groupBy("member_key").agg(
        F.count(F.lit(1)).alias("stays"), F.sum("readmission_within_30_days").alias("back")
    )
    members = star["dim_member"].select("member_key", "age_band", "chronic_condition_count")
    return members.join(stays, "member_key", "left").groupBy("age_band").agg(
        F.count(F.lit(1)).alias("members"),
        F.round(per(F.count_if(F.col("chronic_condition_count") > 0), F.count(F.lit(1))), 6).alias("chronic_prevalence"),
        total("stays").alias("episodes"),
        F.round(per(total("back"), total("stays")), 6).alias("readmission_rate"),
    )


def winsorize(claim: DataFrame, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Paid amount clipped at two quantiles, for model inputs only."""
    cuts = exact_quantiles(claim, "paid_amount", {"low": low, "high": high}, decimals=2)
    floor, ceiling = (cuts.select(F.round(name, 6)).scalar() for name in ("low", "high"))
    paid = F.col("paid_amount").cast("double")
    return claim.select(
        "claim_key", paid.alias("paid_amount"), F.least(F.greatest(paid, floor), ceiling).alias("paid_winsorized")
    )


def risk_band_alt(member: DataFrame) -> DataFrame:
    raf = F.col("raf_like_score")
    label = (
        F.when(raf < 0.7, "Low risk").when(raf <= 1.2, "Moderate risk").when(raf <= 2.5, "High risk")
        .when(raf > 2.5, "Very high risk")
    )
    return member.select("member_key", "raf_like_score", label.alias("risk_band"))
