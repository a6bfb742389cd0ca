"""Data-quality checks as (check_name, status, value, threshold); value is text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .marts import MARTS
from .star import claims_outside

Check = tuple[str, Column, Column, str]


def report(measured: DataFrame, checks: list[Check]) -> DataFrame:
    """Turn a one-row frame of measures into one row per check."""
    rows = F.array(*[
        F.struct(
            F.lit(name).alias("check_name"),
            F.when(F.coalesce(passed, F.lit(False)), "PASS").otherwise("FAIL").alias("status"),
            value.cast("string").alias("value"),
            F.lit(threshold).alias("threshold"),
        )
        for name, passed, value, threshold in checks
    ])
    return measured.select(F.inline(rows))


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def orphans(claim: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Claims whose key is missing or not in the dimension, per-key counts first."""
    used = claim.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    lost = used.join(dim.select(key), key, "left_anti")
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("v"))


def base_checks(tables: Mapping[str, DataFrame]) -> DataFrame:
    v = F.col("v")
    claim = tables["fact_claim"]
    measured = claim.agg(
        F.count(F.lit(1)).alias("n"),
        F.min("paid_amount").alias("min_paid"),
        F.min("allowed_amount").alias("min_allowed"),
        F.count_if(F.col("claim_from_date_key") > F.col("claim_thru_date_key")).alias("late"),
    )
    ids = claim.groupBy("claim_id").agg(F.count(F.lit(1)).alias("k")).agg(
        F.count("claim_id").alias("ids"), F.sum("k").alias("rows")
    )
    months = tables["fact_member_month"].groupBy("member_key", "month_key").agg(
        F.count(F.lit(1)).alias("k"), F.sum("eligible_flag").alias("eligible")
    ).agg(
        F.coalesce(F.sum(F.col("k") - 1), F.lit(0)).cast("bigint").alias("extra"),
        F.coalesce(F.sum("eligible"), F.lit(0)).cast("bigint").alias("eligible"),
    )
    gaps = tables["fact_inpatient_episode"].agg(F.min("days_to_readmission").alias("v"), F.count(F.lit(1)).alias("n"))
    return union([
        report(measured, [
            ("claim_rows_positive", F.col("n") > 0, F.col("n"), "> 0"),
            ("paid_amount_non_negative", F.col("min_paid") >= 0, F.col("min_paid"), ">= 0"),
            ("allowed_amount_non_negative", F.col("min_allowed") >= 0, F.col("min_allowed"), ">= 0"),
            ("claim_date_order", F.col("late") == 0, F.col("late"), "from <= thru"),
        ]),
        report(ids, [("claim_id_unique", F.col("ids") == F.col("rows"), F.col("ids"), "unique")]),
        report(orphans(claim, tables["dim_member"], "member_key"),
               [("member_key_integrity", v == 0, v, "all claims map to members")]),
        report(orphans(claim, tables["dim_provider"], "provider_key"),
               [("provider_key_integrity", v == 0, v, "all claims map to providers")]),
        report(months, [
            ("member_month_unique", F.col("extra") == 0, F.col("extra"), "0 duplicates"),
            ("member_months_positive", F.col("eligible") > 0, F.col("eligible"), "> 0"),
        ]),
        # without episodes there is nothing to check, which counts as passed and is said so
        report(gaps, [(
            "readmission_days_non_negative", F.coalesce(v, F.lit(0)) >= 0, F.coalesce(v, F.lit(0)),
            F.when(F.col("n") == 0, "skipped no episodes").otherwise(">= 0"),
        )]),
    ])


def quality_status(report_rows: DataFrame) -> DataFrame:
    """One row: PASS only if no check failed, the number of checks and of failures."""
    failed = F.count_if(F.col("status") == "FAIL")
    return report_rows.agg(
        F.when(failed == 0, "PASS").otherwise("FAIL").alias("status"), F.count(F.lit(1)).alias("checks"), failed.alias("failures")
    )


def mart_checks(tables: Mapping[str, DataFrame]) -> DataFrame:
    v = F.col("v")
    return union([
        report(tables[name].agg(F.count(F.lit(1)).alias("v")), [(f"{name}_not_empty", v > 0, v, "> 0 rows")])
        for name in MARTS
    ])


def model_checks(metrics: DataFrame) -> DataFrame:
    """From the model metrics (model, metric, value): each model scored some rows or says why not."""
    rows_of = lambda model: F.max(
        F.when((F.col("model") == model) & (F.col("metric") == "rows"), F.col("value").cast("double").cast("bigint"))
    )
    measured = metrics.agg(
        F.coalesce(rows_of("high_cost_member_model"), F.lit(0)).alias("high"),
        F.coalesce(rows_of("provider_anomaly_model"), F.lit(0)).alias("anomaly"),
        F.max(F.when((F.col("model") == "readmission_model") & (F.col("metric") == "status"), F.col("value")))
        .alias("status"),
    )
    return report(measured, [
        ("high_cost_model_ready", F.col("high") > 0, F.col("high"), "> 0 rows"),
        ("readmission_model_ready", F.col("status").isNotNull(), F.coalesce("status", F.lit("missing")), "present"),
        ("provider_anomaly_model_ready", F.col("anomaly") > 0, F.col("anomaly"), "> 0 rows"),
    ])


def quality_report(tables: Mapping[str, DataFrame], metrics: DataFrame | None = None) -> DataFrame:
    parts = [base_checks(tables), mart_checks(tables)]
    if metrics is not None:
        parts.append(model_checks(metrics))
    return union(parts)


LOWEST_PAID = -1_000_000


def late_sources(features: Mapping[str, tuple[DataFrame, Column]]) -> DataFrame:
    """One row: prior-window feature rows whose latest source date is not before their cut-off.

    The date is the latest that went into the row's sums, carried through their aggregation, so a window that
    reaches too far shows here whatever the reason. ``features`` maps a name to the rows and their cut-off date.
    """
    counts = [
        rows.agg(F.count_if(F.col("latest_source_date") >= cutoff).alias("v")) for rows, cutoff in features.values()
    ]
    return union(counts).agg(F.sum("v").cast("bigint").alias("v"))


def extended_checks(
    tables: Mapping[str, DataFrame], diagnoses: DataFrame, procedures: DataFrame, transfers: DataFrame, targets: DataFrame,
    features: Mapping[str, tuple[DataFrame, Column]], member_years: DataFrame, years: Sequence[int],
) -> DataFrame:
    """Further tests: claims, members, code bridges, stays, PMPM denominator, targets and features.

    ``diagnoses`` and ``procedures`` are bridges, ``transfers`` the stays with readmission and transfer flags,
    ``targets`` (member_key, target_high_cost), ``features`` as in ``late_sources``, ``member_years`` rows that must
    be one per member and plan year.
    """
    v = F.col("v")
    counted = lambda df, condition: df.agg(F.count_if(condition).alias("v"))
    none = lambda name, df, condition, threshold: report(counted(df, condition), [(name, v == 0, v, threshold)])

    def none_of(df: DataFrame, checks: list[tuple[str, Column, str]]) -> DataFrame:
        """Several such checks by one pass over rows that are not a written table."""
        measured = df.agg(*[F.count_if(condition).alias(name) for name, condition, _ in checks])
        return report(measured, [(name, F.col(name) == 0, F.col(name), threshold) for name, _, threshold in checks])

    claim, member = tables["fact_claim"], tables["dim_member"]
    typed = claim.join(tables["dim_service"].select("service_key", "claim_type"), "service_key", "left")
    repeated = typed.groupBy("claim_type", "claim_id").agg(F.count(F.lit(1)).alias("k"))
    repeated_members = member.groupBy("member_id").agg(F.count(F.lit(1)).alias("k"))
    rows_per_member = member_years.groupBy("member_key").agg(F.count(F.lit(1)).alias("k"))
    # the age is that of the last plan year, so it tells the year of birth
    earliest = claim.groupBy("member_key").agg(F.min("claim_from_date_key").alias("first"))
    born = F.lit(max(years, default=0)) - F.col("age")
    unborn = earliest.join(member.select("member_key", "age"), "member_key").where(F.floor(F.col("first") / 10000) < born)
    age, months = F.col("age"), F.col("eligibility_months")
    blank = lambda code: F.coalesce(F.trim(code), F.lit("")) == ""
    both = (F.col("readmission_30day_flag") == 1) & (F.col("same_day_transfer_flag") == 1)
    return union([
        none("claim_id_not_null", claim, F.col("claim_id").isNull(), "0 missing"),
        none("claim_id_unique_in_type", repeated, F.col("k") > 1, "0 repeated"),
        none("paid_amount_not_null", claim, F.col("paid_amount").isNull(), "0 missing"),
        none("paid_amount_not_extremely_negative", claim, F.col("paid_amount") < LOWEST_PAID, f">= {LOWEST_PAID}"),
        report(claims_outside(claim, years), [("claims_in_plan_years", v == 0, v, "0 outside")]),
        none("member_id_unique", repeated_members, F.col("k") > 1, "0 repeated"),
        none("age_in_range", member, ~F.coalesce(age.between(0, 110), F.lit(False)), "0..110"),
        none("birth_before_claims", unborn, F.lit(True), "0 earlier"),
        none("eligibility_months_in_range", member, ~F.coalesce(months.between(0, 12), F.lit(False)), "0..12"),
        none_of(diagnoses, [
            ("diagnosis_code_not_blank", blank("diagnosis_code"), "0 blank"),
            ("diagnosis_position_valid", F.col("diagnosis_position") < 1, ">= 1"),
            ("principal_is_first", (F.col("principal_flag") == 1) != (F.col("diagnosis_position") == 1), "position 1"),
        ]),
        none("procedure_code_not_blank", procedures, blank("procedure_code"), "0 blank"),
        none("discharge_date_present", tables["fact_inpatient_episode"], F.col("discharge_date_key").isNull(), "0 missing"),
        none("transfers_are_no_readmissions", transfers, both, "0 both"),
        none("pmpm_excludes_ineligible", tables["fact_member_month"], F.col("eligible_flag") != 1, "0 ineligible"),
        none("feature_rows_match_grain", rows_per_member, F.col("k") != len(years), "one row per member-year"),
        none("target_not_null", targets, F.col("target_high_cost").isNull(), "0 missing"),
        report(late_sources(features), [("no_future_dates", v == 0, v, "0 at or after the cut-off")]),
    ])
