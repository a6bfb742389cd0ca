"""Small hand-made stars."""

from __future__ import annotations

from decimal import Decimal

CLAIM_SCHEMA = (
    "claim_key bigint, claim_id string, member_key bigint, provider_key bigint, service_key bigint, "
    "primary_diagnosis_key bigint, claim_from_date_key int, claim_thru_date_key int, paid_month_key int, "
    "allowed_amount decimal(18,2), paid_amount decimal(18,2), member_responsibility_amount decimal(18,2), "
    "length_of_stay int, inpatient_flag int, ed_flag int, avoidable_ed_flag int, pharmacy_flag int, "
    "prior_auth_flag int, denied_flag int"
)
MEMBER_SCHEMA = (
    "member_key bigint, member_id string, age int, age_band string, gender string, state_code string, "
    "county_name string, plan_type string, dual_eligible_flag int, chronic_condition_count int, diabetes_flag int, "
    "copd_flag int, chf_flag int, ckd_flag int, behavioral_health_flag int, hcc_count int, raf_like_score double, "
    "risk_segment string, eligibility_months int"
)
PROVIDER_SCHEMA = (
    "provider_key bigint, provider_id string, provider_name string, specialty_group string, provider_type string, "
    "state_code string, market string, network_tier string, quality_score double, readmission_index double"
)


def claim(key, member=1, provider=1, service=1, diagnosis=1, start=20250105, end=None, paid="100", allowed=None, **flags):
    end = end or start
    money = Decimal(paid)
    return (
        key, f"C{key}", member, provider, service, diagnosis, start, end, start // 100,
        Decimal(allowed) if allowed else money + 20, money, Decimal("5"), flags.get("los", 0), flags.get("inpatient", 0),
        flags.get("ed", 0), flags.get("avoidable", 0), flags.get("pharmacy", 0), flags.get("prior_auth", 0),
        flags.get("denied", 0),
    )


def member(key, raf=1.0, chronic=1, hcc=1, months=12, segment="Moderate", state="TX", plan="MA-PD", age=70):
    return (key, f"M{key}", age, "65-74", "Female", state, "Metro", plan, 0, chronic, 0, 0, 0, 0, 0, hcc, raf, segment, months)


def provider(key, specialty="Cardiology", quality=80.0, index=1.0):
    return (key, f"P{key}", f"Provider {key}", specialty, "Professional", "TX", "Rural", "Standard", quality, index)


def make_star(spark, claims, members, providers, years=(2025,)):
    from payerscope.operators import star as ops
    from payerscope.sources import tables as src

    star = {
        "dim_member": spark.createDataFrame(members, MEMBER_SCHEMA),
        "dim_provider": spark.createDataFrame(providers, PROVIDER_SCHEMA),
        "dim_service": src.services(spark),
        "dim_diagnosis": src.diagnoses(spark),
        "fact_claim": spark.createDataFrame(claims, CLAIM_SCHEMA),
    }
    star["fact_member_month"] = ops.member_months(star["dim_member"], star["fact_claim"], years)
    star["fact_inpatient_episode"] = ops.episodes(star["fact_claim"])
    star["fact_member_risk"] = ops.member_risk(
        star["dim_member"], star["fact_claim"], star["fact_inpatient_episode"], years
    )
    return star
