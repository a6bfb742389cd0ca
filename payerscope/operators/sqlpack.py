"""Named SQL over the written marts: name to text, run by ``spark.sql``.

``{mart}`` placeholders are filled with DataFrames. Every LIMIT sorts down to a
unique key, so the same rows come back each time. Figures are rounded as decimals:
a half cent goes up, whatever the binary form of the double.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame



def decimal_round(column: str, places: int) -> str:
    name = column.split(".")[-1]
    return f"CAST(round(CAST({column} AS DECIMAL(28,10)), {places}) AS DOUBLE) AS {name}"


QUERY_PACK = {
    "high_cost_member_interventions": f"""
        SELECT member_id, state_code, plan_type, risk_segment, {decimal_round("m.paid_12m", 2)}, admissions, ed_visits,
               {decimal_round("m.risk_priority_score", 4)}, priority_tier, recommended_intervention
        FROM {{mart_high_cost_member}} AS m
        ORDER BY m.risk_priority_score DESC, member_key
        LIMIT 30""",
    "readmission_outreach_queue": f"""
        SELECT episode_key, member_id, provider_name, diagnosis_group, length_of_stay, readmission_within_30_days,
               {decimal_round("m.readmission_priority_score", 4)}, recommended_action
        FROM {{mart_readmission_queue}} AS m
        ORDER BY m.readmission_priority_score DESC, episode_key
        LIMIT 30""",
    "fwa_payment_integrity_queue": f"""
        SELECT claim_id, member_id, provider_name, specialty_group, service_line, {decimal_round("m.paid_amount", 2)},
               {decimal_round("m.fwa_score", 4)}, review_reason, recommended_action
        FROM {{mart_fwa_queue}} AS m
        ORDER BY m.fwa_score DESC, m.paid_amount DESC, claim_id
        LIMIT 30""",
    "pmpm_market_trends": f"""
        SELECT month_key, state_code, plan_type, risk_segment, member_months, {decimal_round("m.paid_amount", 2)},
               {decimal_round("m.pmpm", 2)}
        FROM {{mart_member_month_pmpm}} AS m
        ORDER BY month_key, state_code, risk_segment, plan_type
        LIMIT 60""",
}

PROVIDER_SCORED = """
    SELECT provider_name, specialty_group, n AS claims, people AS members, total AS paid_amount,
           total / people AS payment_per_member, CAST(n AS DOUBLE) / people AS services_per_member, quality_score
    FROM (SELECT provider_key, sum(k) AS n, nullif(count(member_key), 0) AS people, CAST(sum(p) AS DOUBLE) AS total
          FROM (SELECT provider_key, member_key, count(claim_key) AS k, sum(paid_amount) AS p
                FROM {fact_claim} GROUP BY provider_key, member_key)
          GROUP BY provider_key)
    JOIN {dim_provider} USING (provider_key)
    ORDER BY payment_per_member DESC, provider_key"""


def run_sql(text: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    used = {name: tables[name] for name in placeholders(text)}
    spark = next(iter(used.values())).sparkSession
    return spark.sql(text, **used)


def placeholders(text: str) -> list[str]:
    return [piece.split("}")[0] for piece in text.split("{")[1:]]


def run_pack(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: run_sql(text, tables) for name, text in QUERY_PACK.items()}
