"""DuckDB text for the loosely named extract and the star built from it."""

from __future__ import annotations

from ..fixed_values import DIAGNOSES, MISSING_TEXTS, SERVICES
from .extract import EXTRACT_CONDITIONS, EXTRACT_PLANS, EXTRACT_SERVICES, EXTRACT_SPECIALTIES
from .oracle_star import AGE, SEGMENT, case_band, sql_list, values

CUSTOM: dict[str, tuple[list[str], str]] = {}

CUSTOM["extract"] = (["claim_lines"], f"""
  SELECT claim_id AS "Claim Number", 'B' || member_key AS " Bene ID ", 'N' || l_suppkey AS "NPI",
    CASE l_linenumber WHEN 2 THEN NULL WHEN 3 THEN 'Supplier "' || l_suppkey || '",' || chr(10) || 'second site'
      ELSE 'Supplier ' || l_suppkey END AS "Facility",
    {sql_list(EXTRACT_SPECIALTIES)}[l_suppkey % 7 + 1] AS "Specialty",
    {sql_list(t for t, _ in EXTRACT_SERVICES)}[l_partkey % 12 + 1] AS "Setting",
    {sql_list(s for _, s in EXTRACT_SERVICES)}[l_partkey % 12 + 1] AS "Department",
    {sql_list(EXTRACT_CONDITIONS)}[p_size % 12 + 1] AS "Condition",
    CASE WHEN tax = 0.08 THEN 'n/a' WHEN tax = 0.07 THEN '-5' WHEN tax = 0.06 THEN 'Infinity' ELSE allowed_amount::VARCHAR END AS "Allowed",
    CASE WHEN discount = 0.10 THEN NULL WHEN denied_flag = 1 THEN '0'
      ELSE round(allowed_amount * (1 - discount), 2)::DECIMAL(18,2)::VARCHAR END AS "Paid",
    round(allowed_amount * tax, 2)::DECIMAL(18,2)::VARCHAR AS "Copay",
    CASE l_linenumber WHEN 1 THEN 'not a date' WHEN 2 THEN strftime(from_date, '%m/%d/%Y')
      WHEN 3 THEN strftime(from_date, '%Y%m%d') WHEN 4 THEN strftime(from_date, '%Y-%m-%dT00:00:00')
      WHEN 5 THEN strftime(from_date, '%Y/%m/%d') WHEN 6 THEN strftime(from_date, '%b %-d, %Y')
      ELSE strftime(from_date, '%Y-%m-%d') END AS "Service Date",
    CASE l_linenumber WHEN 7 THEN NULL WHEN 6 THEN day(from_date) || '.' || month(from_date) || '.' || year(from_date)
      WHEN 5 THEN strftime(from_date, '%m/%d/%Y') ELSE strftime(from_date + (l_linenumber - 3)::INT, '%Y-%m-%d') END AS "Through Date",
    CASE l_partkey % 12 WHEN 5 THEN '1' WHEN 6 THEN '3' WHEN 7 THEN 'yes' WHEN 8 THEN 'True' WHEN 9 THEN 'false' ELSE '0' END
      AS "Is Inpatient",
    CASE l_partkey % 12 WHEN 2 THEN '1' WHEN 3 THEN '0.9' ELSE NULL END AS "Is ED",
    CASE WHEN l_linenumber = 1 THEN NULL ELSE 'S' || member_key % 25 END AS "State",
    {sql_list(EXTRACT_PLANS)}[member_key % 4 + 1] AS "Plan",
    ((member_key % 6)::DECIMAL(4,1) + CASE WHEN l_linenumber = 4 THEN 0.5 ELSE 0.0 END)::DECIMAL(4,1)::VARCHAR AS "Chronic Count",
    (0.41 + 0.19 * (member_key % 6))::DECIMAL(6,3)::VARCHAR AS "Risk Score",
    CASE WHEN l_linenumber IN (1, 3) THEN '1' ELSE '0' END AS "Readmission Flag"
  FROM claim_lines""")

CUSTOM["canonical"] = (["extract"], """
  SELECT "Claim Number" AS claim_id, " Bene ID " AS member_id, "NPI" AS provider_id, "Facility" AS provider_name,
    "Specialty" AS specialty_group, "Setting" AS claim_type, "Department" AS service_line, "Condition" AS diagnosis_group,
    "Allowed" AS allowed_amount, "Paid" AS paid_amount, "Copay" AS member_responsibility_amount,
    "Service Date" AS claim_from_date, "Through Date" AS claim_thru_date, "Is Inpatient" AS inpatient_flag,
    "Is ED" AS ed_flag, "State" AS state_code, "Plan" AS plan_type, "Chronic Count" AS chronic_condition_count,
    "Risk Score" AS raf_like_score FROM extract""")


def finite(column: str) -> str:
    return f"CASE WHEN isfinite(try_cast({column} AS DOUBLE)) THEN try_cast({column} AS DOUBLE) END"


def number(column: str, default: float) -> str:
    return f"greatest(coalesce({finite(column)}, {default}::DOUBLE), 0.0::DOUBLE)"


def flag_value(column: str) -> str:
    return f"CASE lower(trim({column})) WHEN 'true' THEN 1 WHEN 'false' THEN 0 ELSE {finite(column)} END"


def flag(column: str) -> str:
    return f"least(greatest(trunc(coalesce({flag_value(column)}, 0))::INT, 0), 1)"


def day(column: str) -> str:
    """Any order that is not in doubt, then the order that more cells of the column show."""
    plain = ", ".join(f"try_strptime({column}, '{f}')" for f in ("%Y-%m-%d", "%Y%m%d", "%Y-%m-%dT%H:%M:%S", "%Y/%m/%d", "%b %d, %Y"))
    either = lambda *forms: "coalesce(" + ", ".join(f"try_strptime({column}, '{f}')" for f in forms) + ")"
    return (f"coalesce({plain}, CASE WHEN (SELECT {column} FROM day_first) THEN {either('%d/%m/%Y', '%d.%m.%Y')} "
            f"ELSE {either('%m/%d/%Y', '%m.%d.%Y')} END)::DATE")


def shows(column: str, part: int) -> str:
    """Cells in which only the first (1) or the second (2) number can be the day."""
    a, b = (f"try_cast(regexp_extract({column}, '^([0-9]{{1,2}})[/.]([0-9]{{1,2}})[/.][0-9]{{4}}$', {i}) AS INT)" for i in (part, 3 - part))
    return f"count(*) FILTER ({a} > 12 AND {b} <= 12)"


CUSTOM["day_first"] = (["canonical"], "SELECT " + ", ".join(
    f"{shows(c, 1)} > {shows(c, 2)} AS {c}" for c in ("claim_from_date", "claim_thru_date")) + " FROM canonical")

READ = {c: finite(c) for c in (
    "allowed_amount", "paid_amount", "member_responsibility_amount", "chronic_condition_count", "raf_like_score")}
READ |= {c: flag_value(c) for c in ("inpatient_flag", "ed_flag")} | {c: day(c) for c in ("claim_from_date", "claim_thru_date")}
TYPED_COLUMNS = [*READ, "readmission_flag"]
_missing = ", ".join(f"'{t}'" for t in MISSING_TEXTS)
CUSTOM["bad_cells"] = (["canonical", "day_first"], " UNION ALL ".join(f"""
  SELECT '{c}' AS c, count(*) AS n, count(*) AS cells, count(*) FILTER ({c} IS NULL OR trim({c}) IN ({_missing})) AS missing,
    count(*) FILTER ({c} IS NOT NULL AND trim({c}) NOT IN ({_missing}) AND ({read}) IS NULL) AS unreadable,
    {'0::BIGINT' if c.endswith('date') else f'count(*) FILTER (({read}) < 0)'} AS low FROM canonical""" for c, read in READ.items()) + """
  UNION ALL SELECT 'readmission_flag', count(*), 0, 0, 0, 0 FROM canonical""")

CUSTOM["rows"] = (["canonical", "day_first"], f"""
  SELECT * REPLACE (greatest(claim_from_date, coalesce(claim_thru_date, claim_from_date)) AS claim_thru_date)
  FROM (SELECT row_number() OVER (ORDER BY claim_id) AS claim_key, claim_id, member_id, provider_id, provider_name,
      specialty_group, claim_type, service_line, diagnosis_group,
      {number('allowed_amount', 250)}::DECIMAL(18,2) AS allowed_amount,
      {number('paid_amount', 180)}::DECIMAL(18,2) AS paid_amount,
      {number('member_responsibility_amount', 25)}::DECIMAL(18,2) AS member_responsibility_amount,
      {number('chronic_condition_count', 1)} AS chronic_condition_count, {number('raf_like_score', 0.85)} AS raf_like_score,
      {flag('inpatient_flag')} AS inpatient_flag, {flag('ed_flag')} AS ed_flag, state_code, plan_type,
      coalesce({day('claim_from_date')}, DATE '1998-01-01') AS claim_from_date, {day('claim_thru_date')} AS claim_thru_date
    FROM canonical)""")

FLAGS = ", ".join(
    f"(chronic_condition_count > 1)::INT AS {c}_flag" for c in ("diabetes", "copd", "chf", "ckd", "behavioral_health")
)

CUSTOM["c_member"] = (["rows"], f"""
  SELECT member_key, member_id, age, {case_band('age', *AGE)} AS age_band, 'Unknown' AS gender, state_code,
    'Custom' AS county_name, plan_type, regexp_matches(plan_type, 'dual', 'i')::INT AS dual_eligible_flag,
    chronic_condition_count, {FLAGS}, ceil(chronic_condition_count * 0.9::DOUBLE)::INT AS hcc_count, raf_like_score,
    {case_band('raf_like_score', *SEGMENT)} AS risk_segment, 12 AS eligibility_months
  FROM (SELECT *, row_number() OVER (ORDER BY member_id) AS member_key,
      trunc(least(greatest(64 + 5 * chronic_condition_count, 18), 92))::INT AS age
    FROM (SELECT member_id, arg_min(state_code, claim_key) FILTER (state_code IS NOT NULL) AS state_code,
        arg_min(plan_type, claim_key) FILTER (plan_type IS NOT NULL) AS plan_type,
        max(chronic_condition_count) AS chronic_condition_count, max(raf_like_score) AS raf_like_score
      FROM rows GROUP BY 1))""")

CUSTOM["c_provider"] = (["rows"], """
  SELECT row_number() OVER (ORDER BY provider_id) AS provider_key, provider_id, provider_name, specialty_group,
    CASE WHEN regexp_matches(specialty_group, 'facility|hospital', 'i') THEN 'Facility' ELSE 'Professional' END
      AS provider_type, state_code, 'Custom' AS market, 'Standard' AS network_tier, 78.0::DOUBLE AS quality_score,
    1.0::DOUBLE AS readmission_index
  FROM (SELECT provider_id, arg_min(provider_name, claim_key) FILTER (provider_name IS NOT NULL) AS provider_name,
      arg_min(specialty_group, claim_key) FILTER (specialty_group IS NOT NULL) AS specialty_group,
      arg_min(state_code, claim_key) FILTER (state_code IS NOT NULL) AS state_code FROM rows GROUP BY 1)""")

CUSTOM["c_service"] = (["rows"], f"""
  SELECT row_number() OVER (ORDER BY seen) AS service_key, r.claim_type, r.service_line,
    coalesce(place, r.claim_type) AS place_of_service,
    coalesce(inp, regexp_matches(r.claim_type, 'inpatient', 'i')::INT)::INT AS inpatient_default_flag,
    coalesce(ed, regexp_matches(r.service_line, 'emergency|ed', 'i')::INT)::INT AS ed_default_flag,
    coalesce(base, 250.0)::DOUBLE AS base_allowed_amount
  FROM (SELECT claim_type, service_line, min(claim_key) AS seen FROM rows GROUP BY 1, 2) r
  LEFT JOIN (VALUES {values(SERVICES)}) AS s(ct, sl, place, inp, ed, base) ON ct = r.claim_type AND sl = r.service_line""")

CUSTOM["c_diagnosis"] = (["rows"], f"""
  SELECT row_number() OVER (ORDER BY seen) AS diagnosis_key, coalesce(code, 'CUSTOM') AS diagnosis_code, r.diagnosis_group,
    coalesce(hcc, 'HCC0') AS hcc_category
  FROM (SELECT diagnosis_group, min(claim_key) AS seen FROM rows GROUP BY 1) r
  LEFT JOIN (VALUES {values(DIAGNOSES)}) AS d(code, grp, hcc) ON grp = r.diagnosis_group""")

CUSTOM["c_claim"] = (["rows", "c_member", "c_provider", "c_service", "c_diagnosis"], """
  SELECT claim_key, claim_id, m.member_key, p.provider_key, s.service_key, d.diagnosis_key AS primary_diagnosis_key,
    strftime(claim_from_date, '%Y%m%d')::INT AS claim_from_date_key,
    strftime(claim_thru_date, '%Y%m%d')::INT AS claim_thru_date_key, strftime(claim_from_date, '%Y%m')::INT AS paid_month_key,
    allowed_amount, paid_amount, member_responsibility_amount,
    greatest(claim_thru_date - claim_from_date, 0)::INT AS length_of_stay, inpatient_flag, ed_flag,
    (ed_flag = 1 AND paid_amount < 1800)::INT AS avoidable_ed_flag,
    regexp_matches(r.claim_type, 'pharmacy', 'i')::INT AS pharmacy_flag,
    (inpatient_flag = 1 OR allowed_amount > 3500)::INT AS prior_auth_flag, (paid_amount <= 0)::INT AS denied_flag
  FROM rows r LEFT JOIN c_member m ON r.member_id = m.member_id LEFT JOIN c_provider p ON r.provider_id = p.provider_id
  LEFT JOIN c_service s ON r.claim_type = s.claim_type AND r.service_line = s.service_line
  LEFT JOIN c_diagnosis d ON r.diagnosis_group = d.diagnosis_group""")

CUSTOM["c_episode"] = (["c_claim", "extract"], """
  SELECT row_number() OVER (ORDER BY member_key, admission_date_key, claim_key) AS episode_key, claim_key, member_key,
    provider_key, admission_date_key, discharge_date_key, length_of_stay, principal_diagnosis_key,
    given AS readmission_within_30_days,
    (CASE WHEN given = 1 THEN least(days, 30) ELSE days END)::INT AS days_to_readmission
  FROM (SELECT c.claim_key, member_key, provider_key, claim_from_date_key AS admission_date_key,
      claim_thru_date_key AS discharge_date_key, length_of_stay, primary_diagnosis_key AS principal_diagnosis_key,
      "Readmission Flag"::INT AS given,
      greatest(coalesce(strptime((lead(claim_from_date_key) OVER (PARTITION BY member_key
          ORDER BY claim_from_date_key, claim_key))::VARCHAR, '%Y%m%d')::DATE
        - strptime(claim_thru_date_key::VARCHAR, '%Y%m%d')::DATE, 9999), 0) AS days
    FROM c_claim c JOIN extract e ON c.claim_id = e."Claim Number" WHERE inpatient_flag = 1)""")
