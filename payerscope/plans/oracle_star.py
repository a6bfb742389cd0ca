"""DuckDB text for the star and the marts: the independent check of every query.

``CTES`` maps a name to (names it reads, SQL text); ``with_ctes`` puts the needed
ones in front of a final SELECT. Nothing here is used by the Spark side.
"""

from __future__ import annotations

from ..fixed_values import COUNTIES, DIAGNOSES, MARKETS, NETWORK_TIERS, SERVICES, SPECIALTIES


def values(rows) -> str:
    def lit(v):
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else repr(v)

    return ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)


def sql_list(items) -> str:
    return "[" + ", ".join(f"'{i}'" for i in items) + "]"


def case_band(x: str, edges, labels) -> str:
    arms = [f"WHEN {x} < {edges[0]} THEN NULL"]
    arms += [f"WHEN {x} <= {upper} THEN '{label}'" for upper, label in zip(edges[1:], labels)]
    return "CASE " + " ".join(arms) + " END"


def pct(x: str, part: str = "") -> str:
    """Tie-averaged percentile rank by plain windows."""
    by = f"PARTITION BY {part} " if part else ""
    ties = f"PARTITION BY {part}, {x}" if part else f"PARTITION BY {x}"
    return (
        f"CASE WHEN {x} IS NOT NULL THEN ((rank() OVER ({by}ORDER BY {x} NULLS LAST) - 1)::DOUBLE "
        f"+ ((count(*) OVER ({ties}))::DOUBLE + 1.0::DOUBLE) / 2.0::DOUBLE) / (count({x}) OVER ({by}))::DOUBLE END"
    )


def ratio(a: str, b: str) -> str:
    return f"(({a})::DOUBLE / greatest(({b})::DOUBLE, 1.0::DOUBLE))"


def score(parts) -> str:
    return "round(" + " + ".join(f"{w}::DOUBLE * ({x})" for w, x in parts) + ", 6)"


AGE = ([0, 34, 49, 64, 74, 84, 120], ["18-34", "35-49", "50-64", "65-74", "75-84", "85+"])
SEGMENT = ([0, 0.7, 1.15, 1.75, 9], ["Low", "Moderate", "High", "Complex"])

MEMBER_COLS = (
    "member_id, age, age_band, gender, state_code, county_name, plan_type, dual_eligible_flag, "
    "chronic_condition_count, diabetes_flag, copd_flag, chf_flag, ckd_flag, behavioral_health_flag, hcc_count, "
    "raf_like_score, risk_segment, eligibility_months"
)
PROVIDER_COLS = (
    "provider_id, provider_name, specialty_group, provider_type, state_code, market, network_tier, "
    "quality_score, readmission_index"
)

CTES: dict[str, tuple[list[str], str]] = {}

CTES["dim_member"] = ([], f"""
  SELECT member_key, 'MBR-' || member_key AS member_id, age,
    {case_band('age', *AGE)} AS age_band,
    CASE WHEN member_key % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender, state_code,
    {sql_list(COUNTIES)}[member_key % 6 + 1] AS county_name, plan_type, dual AS dual_eligible_flag,
    cc AS chronic_condition_count, (cc >= 1)::INT AS diabetes_flag, (cc >= 2)::INT AS copd_flag,
    (cc >= 3)::INT AS chf_flag, (cc >= 4)::INT AS ckd_flag, (cc >= 5)::INT AS behavioral_health_flag,
    ceil(cc * 0.9)::INT AS hcc_count, raf::DOUBLE AS raf_like_score, {case_band('raf', *SEGMENT)} AS risk_segment,
    (8 + member_key % 5)::INT AS eligibility_months
  FROM (SELECT *, (0.29 + 0.005 * age + 0.21 * cc + 0.17 * dual)::DECIMAL(6,3) AS raf
    FROM (SELECT *, (plan_type = 'Dual Eligible SNP')::INT AS dual
      FROM (SELECT c_custkey AS member_key, n_name AS state_code, (18 + (c_custkey * 7) % 75)::INT AS age,
              (c_custkey % 6)::INT AS cc,
              CASE c_mktsegment WHEN 'BUILDING' THEN 'MA-PD' WHEN 'FURNITURE' THEN 'Dual Eligible SNP'
                WHEN 'HOUSEHOLD' THEN 'Employer Group Waiver' ELSE 'Medicare Advantage' END AS plan_type
            FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)))""")

CTES["dim_provider"] = ([], f"""
  SELECT s_suppkey AS provider_key, 'SUP-' || s_suppkey AS provider_id, s_name AS provider_name,
    {sql_list(n for n, _ in SPECIALTIES)}[s_suppkey % 9 + 1] AS specialty_group,
    {sql_list(t for _, t in SPECIALTIES)}[s_suppkey % 9 + 1] AS provider_type, n_name AS state_code,
    {sql_list(MARKETS)}[s_suppkey % 4 + 1] AS market, {sql_list(NETWORK_TIERS)}[s_suppkey % 3 + 1] AS network_tier,
    greatest(least(round(35 + (s_acctbal::DECIMAL(18,2) + 1000) * 64 / 11000, 2)::DOUBLE, 99.0::DOUBLE),
      35.0::DOUBLE) AS quality_score,
    (55 + (s_suppkey * 37) % 121)::DOUBLE / 100.0::DOUBLE AS readmission_index
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""")

CTES["dim_service"] = ([], f"""
  SELECT service_key::BIGINT AS service_key, claim_type, service_line, place_of_service,
    inpatient_default_flag::INT AS inpatient_default_flag, ed_default_flag::INT AS ed_default_flag,
    base_allowed_amount::DOUBLE AS base_allowed_amount
  FROM (VALUES {values((i, *r) for i, r in enumerate(SERVICES, 1))}) AS t(service_key, claim_type, service_line,
    place_of_service, inpatient_default_flag, ed_default_flag, base_allowed_amount)""")

CTES["dim_diagnosis"] = ([], f"""
  SELECT diagnosis_key::BIGINT AS diagnosis_key, diagnosis_code, diagnosis_group, hcc_category
  FROM (VALUES {values((i, *r) for i, r in enumerate(DIAGNOSES, 1))}) AS t(diagnosis_key, diagnosis_code,
    diagnosis_group, hcc_category)""")

CTES["claim_lines"] = ([], """
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || l_quantity::INT || '-' || copy
      AS claim_id, o_custkey AS member_key, l_suppkey AS provider_key, l_partkey % 10 + 1 AS service_key,
    (p_size % 10 + 1)::BIGINT AS primary_diagnosis_key, l_shipdate::DATE AS from_date,
    l_extendedprice::DECIMAL(18,2) AS allowed_amount, l_discount::DECIMAL(4,2) AS discount, l_tax::DECIMAL(4,2) AS tax,
    l_linenumber, l_quantity, (l_returnflag = 'R' AND l_linenumber = 1)::INT AS denied_flag,
    l_linestatus, p_size, l_suppkey, l_partkey, l_orderkey, copy
  FROM (SELECT *, unnest(generate_series(1, CASE WHEN l_quantity = 50 AND l_linenumber = 1 THEN 5
      WHEN l_quantity = 50 THEN 2 ELSE 1 END)) AS copy FROM lineitem)
  LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey""")

CTES["fact_claim"] = (["claim_lines"], """
  SELECT row_number() OVER (ORDER BY member_key, from_date, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
      copy) AS claim_key, claim_id, member_key, provider_key,
    service_key, primary_diagnosis_key, strftime(from_date, '%Y%m%d')::INT AS claim_from_date_key,
    strftime(from_date + length_of_stay, '%Y%m%d')::INT AS claim_thru_date_key,
    strftime(from_date, '%Y%m')::INT AS paid_month_key, allowed_amount,
    (CASE WHEN denied_flag = 1 THEN 0 ELSE round(allowed_amount * (1 - discount), 2) END)::DECIMAL(18,2) AS paid_amount,
    round(allowed_amount * tax, 2)::DECIMAL(18,2) AS member_responsibility_amount, length_of_stay, inpatient_flag,
    (service_key = 3)::INT AS ed_flag, (service_key = 3 AND l_quantity < 15)::INT AS avoidable_ed_flag,
    (service_key = 8)::INT AS pharmacy_flag, (inpatient_flag = 1 OR allowed_amount > 50000)::INT AS prior_auth_flag,
    denied_flag
  FROM (SELECT *, (service_key IN (6, 7))::INT AS inpatient_flag,
      (CASE WHEN service_key IN (6, 7) THEN 2 + l_linenumber ELSE 0 END)::INT AS length_of_stay FROM claim_lines)""")

CTES["fact_member_month"] = (["dim_member", "fact_claim"], """
  SELECT g.member_key, g.month_key, 1 AS eligible_flag, g.plan_type, g.state_code, g.risk_segment,
    coalesce(p.paid, 0)::DECIMAL(18,2) AS paid_amount
  FROM (SELECT member_key, plan_type, state_code, risk_segment, (y * 100 + m)::INT AS month_key
        FROM dim_member, (SELECT unnest(generate_series(year(min(l_shipdate)), year(max(l_shipdate)))) AS y FROM lineitem) ys, generate_series(1, 12) AS ms(m)
        WHERE m <= eligibility_months) g
  LEFT JOIN (SELECT member_key, paid_month_key, sum(paid_amount) AS paid FROM fact_claim GROUP BY ALL) p
    ON p.member_key = g.member_key AND p.paid_month_key = g.month_key""")

CTES["fact_inpatient_episode"] = (["fact_claim"], """
  SELECT row_number() OVER (ORDER BY member_key, admission_date_key, claim_key) AS episode_key, claim_key, member_key,
    provider_key, admission_date_key, discharge_date_key, length_of_stay, principal_diagnosis_key,
    coalesce(gap BETWEEN 0 AND 30, false)::INT AS readmission_within_30_days,
    greatest(coalesce(gap, 9999), 0)::INT AS days_to_readmission
  FROM (SELECT claim_key, member_key, provider_key, claim_from_date_key AS admission_date_key,
      claim_thru_date_key AS discharge_date_key, length_of_stay, primary_diagnosis_key AS principal_diagnosis_key,
      strptime((lead(claim_from_date_key) OVER (PARTITION BY member_key ORDER BY claim_from_date_key, claim_key))::VARCHAR,
        '%Y%m%d')::DATE - strptime(claim_thru_date_key::VARCHAR, '%Y%m%d')::DATE AS gap
    FROM fact_claim WHERE inpatient_flag = 1)""")

CTES["fact_member_risk"] = (["dim_member", "fact_claim", "fact_inpatient_episode"], """
  SELECT *, CASE WHEN suspected_hcc_gap_count > 0 THEN 'Chart review and provider documentation outreach'
      ELSE 'Monitor annual wellness and chronic recapture' END AS risk_adjustment_action
  FROM (SELECT m.member_key, y::INT AS plan_year, hcc_count, raf_like_score, risk_segment, chronic_condition_count,
      dual_eligible_flag, coalesce(paid, 0)::DECIMAL(28,2) AS paid_12m, coalesce(claims, 0)::BIGINT AS claim_count,
      coalesce(ed, 0)::BIGINT AS ed_visits, coalesce(adm, 0)::BIGINT AS admissions,
      coalesce(readm, 0)::BIGINT AS readmission_count,
      greatest(chronic_condition_count - hcc_count +
        (('0x' || substr(md5('gap-' || m.member_key || '-' || y), 1, 6))::BIGINT / 16777216.0::DOUBLE < 0.18)::INT, 0)::INT
        AS suspected_hcc_gap_count
    FROM dim_member m
    CROSS JOIN (SELECT unnest(generate_series(year(min(l_shipdate)), year(max(l_shipdate)))) AS y FROM lineitem) ys
    LEFT JOIN (SELECT member_key, claim_from_date_key // 10000 AS cy, sum(paid_amount) AS paid, count(DISTINCT claim_key) AS claims,
        sum(ed_flag) AS ed, sum(inpatient_flag) AS adm FROM fact_claim GROUP BY 1, 2) c ON c.member_key = m.member_key AND cy = y
    LEFT JOIN (SELECT member_key, admission_date_key // 10000 AS ey, sum(readmission_within_30_days) AS readm
        FROM fact_inpatient_episode GROUP BY 1, 2) e ON e.member_key = m.member_key AND ey = y)""")

CTES["risk_of_year"] = (["fact_member_risk"], """
  SELECT * FROM fact_member_risk WHERE plan_year = (SELECT max(plan_year) FROM fact_member_risk)""")

CTES["claims_enriched"] = (["fact_claim", "dim_member", "dim_provider", "dim_service", "dim_diagnosis"], """
  SELECT c.*, m.* EXCLUDE (member_key, state_code), m.state_code AS state_code_member,
    p.* EXCLUDE (provider_key, state_code), p.state_code AS state_code_provider,
    s.* EXCLUDE (service_key), d.* EXCLUDE (diagnosis_key)
  FROM fact_claim c LEFT JOIN dim_member m ON c.member_key = m.member_key
  LEFT JOIN dim_provider p ON c.provider_key = p.provider_key
  LEFT JOIN dim_service s ON c.service_key = s.service_key
  LEFT JOIN dim_diagnosis d ON c.primary_diagnosis_key = d.diagnosis_key""")

CTES["episodes_enriched"] = (["fact_inpatient_episode", "dim_member", "dim_provider", "dim_diagnosis"], """
  SELECT e.*, m.* EXCLUDE (member_key, state_code), m.state_code AS state_code_member,
    p.* EXCLUDE (provider_key, state_code), p.state_code AS state_code_provider, d.* EXCLUDE (diagnosis_key)
  FROM fact_inpatient_episode e LEFT JOIN dim_member m ON e.member_key = m.member_key
  LEFT JOIN dim_provider p ON e.provider_key = p.provider_key
  LEFT JOIN dim_diagnosis d ON e.principal_diagnosis_key = d.diagnosis_key""")

CTES["mart_claims_financials"] = (["claims_enriched"], f"""
  SELECT paid_month_key, state_code_member, plan_type, claim_type, service_line, risk_segment,
    count(DISTINCT claim_key) AS claims, count(DISTINCT member_key) AS members,
    sum(allowed_amount)::DOUBLE AS allowed_amount, sum(paid_amount)::DOUBLE AS paid_amount,
    sum(member_responsibility_amount)::DOUBLE AS member_responsibility_amount,
    sum(denied_flag)::BIGINT AS denied_claims, sum(inpatient_flag)::BIGINT AS inpatient_claims,
    sum(ed_flag)::BIGINT AS ed_claims, sum(avoidable_ed_flag)::BIGINT AS avoidable_ed_claims,
    {ratio('sum(paid_amount)', 'count(DISTINCT claim_key)')} AS paid_per_claim,
    {ratio('sum(denied_flag)', 'count(DISTINCT claim_key)')} AS denial_rate
  FROM claims_enriched GROUP BY 1, 2, 3, 4, 5, 6""")

CTES["mart_member_month_pmpm"] = (["fact_member_month"], f"""
  SELECT month_key, state_code, plan_type, risk_segment, sum(eligible_flag)::BIGINT AS member_months,
    count(DISTINCT member_key) AS eligible_members, sum(paid_amount)::DOUBLE AS paid_amount,
    {ratio('sum(paid_amount)', 'sum(eligible_flag)')} AS pmpm
  FROM fact_member_month GROUP BY 1, 2, 3, 4""")

CTES["top_claim_per_member"] = (["claims_enriched"], """
  SELECT member_key, diagnosis_group, service_line FROM claims_enriched
  QUALIFY row_number() OVER (PARTITION BY member_key ORDER BY paid_amount DESC, claim_key) = 1""")

CTES["claims_of_year"] = (["claims_enriched", "fact_member_risk"], """
  SELECT * FROM claims_enriched WHERE claim_from_date_key // 10000 = (SELECT max(plan_year) FROM fact_member_risk)""")

CTES["mart_high_cost_member"] = (["claims_of_year", "dim_member", "risk_of_year"], f"""
  SELECT member_key, paid::DOUBLE AS paid_12m, allowed::DOUBLE AS allowed_12m, claim_count, admissions, ed_visits,
    avoidable_ed_visits, denied_claims, {MEMBER_COLS}, diagnosis_group, service_line, readmission_count,
    suspected_hcc_gap_count, paid_percentile, risk_priority_score,
    {case_band('risk_priority_score', [0, 0.55, 0.75, 0.90, 1.01], ["Monitor", "Rising risk", "High risk", "Complex care"])}
      AS priority_tier,
    CASE WHEN admissions > 1 THEN 'Post-discharge care management'
      WHEN avoidable_ed_visits > 0 THEN 'ED diversion and PCP access outreach'
      WHEN suspected_hcc_gap_count > 0 THEN 'Risk adjustment chart review'
      WHEN paid_percentile >= 0.90 THEN 'Complex care management review'
      ELSE 'Monitor utilization trend' END AS recommended_intervention
  FROM (SELECT *, {score([(0.40, 'paid_percentile'), (0.20, 'raf_p'), (0.15, 'adm_p'), (0.15, 'ed_p'), (0.10, 'gap_p')])}
      AS risk_priority_score
    FROM (SELECT *, {pct('paid')} AS paid_percentile, {pct('raf_like_score')} AS raf_p, {pct('admissions')} AS adm_p,
        {pct('ed_visits')} AS ed_p, {pct('gaps')} AS gap_p
      FROM (SELECT a.*, m.* EXCLUDE (member_key), t.diagnosis_group, t.service_line, r.readmission_count,
          r.suspected_hcc_gap_count, coalesce(r.suspected_hcc_gap_count, 0) AS gaps
        FROM (SELECT member_key, sum(paid_amount) AS paid, sum(allowed_amount) AS allowed,
            count(DISTINCT claim_key) AS claim_count, sum(inpatient_flag)::BIGINT AS admissions,
            sum(ed_flag)::BIGINT AS ed_visits, sum(avoidable_ed_flag)::BIGINT AS avoidable_ed_visits,
            sum(denied_flag)::BIGINT AS denied_claims FROM claims_of_year GROUP BY 1) a
        LEFT JOIN dim_member m ON a.member_key = m.member_key
        LEFT JOIN (SELECT member_key, diagnosis_group, service_line FROM claims_of_year
          QUALIFY row_number() OVER (PARTITION BY member_key ORDER BY paid_amount DESC, claim_key) = 1) t ON a.member_key = t.member_key
        LEFT JOIN risk_of_year r ON a.member_key = r.member_key)))""")

CTES["provider_base"] = (["fact_claim", "dim_provider"], f"""
  SELECT a.*, {ratio('paid', 'members')} AS payment_per_member, {ratio('claims', 'members')} AS services_per_member,
    p.* EXCLUDE (provider_key)
  FROM (SELECT provider_key, count(DISTINCT claim_key) AS claims, count(DISTINCT member_key) AS members,
      sum(paid_amount) AS paid, sum(allowed_amount) AS allowed, sum(inpatient_flag)::BIGINT AS inpatient_claims,
      sum(ed_flag)::BIGINT AS ed_claims, sum(denied_flag)::BIGINT AS denied_claims
    FROM fact_claim WHERE provider_key IS NOT NULL GROUP BY 1) a
  LEFT JOIN dim_provider p ON a.provider_key = p.provider_key""")

CTES["mart_provider_performance"] = (["provider_base", "fact_inpatient_episode"], f"""
  SELECT provider_key, claims, members, paid::DOUBLE AS paid_amount, allowed::DOUBLE AS allowed_amount, inpatient_claims,
    ed_claims, denied_claims, {PROVIDER_COLS}, readmissions, episodes, payment_per_member, services_per_member,
    readmission_rate, peer_cost_percentile, peer_utilization_percentile, provider_outlier_score,
    {case_band('provider_outlier_score', [0, 0.45, 0.70, 0.88, 1.01], ["Efficient", "Standard", "Watchlist", "Intervention"])}
      AS performance_tier,
    CASE WHEN provider_outlier_score >= 0.88 THEN 'Provider relations review and payment integrity audit'
      WHEN peer_cost_percentile >= 0.90 THEN 'Peer cost benchmark discussion'
      WHEN readmission_rate >= 0.12 THEN 'Readmission reduction workflow' ELSE 'Monitor peer trend' END AS recommended_action
  FROM (SELECT *, {score([(0.38, 'peer_cost_percentile'), (0.25, 'peer_utilization_percentile'), (0.20, 'rr_p'),
        (0.17, '1.0::DOUBLE - q_p')])} AS provider_outlier_score
    FROM (SELECT *, {pct('payment_per_member', 'specialty_group')} AS peer_cost_percentile,
        {pct('services_per_member', 'specialty_group')} AS peer_utilization_percentile,
        {pct('readmission_rate')} AS rr_p, {pct('quality_score')} AS q_p
      FROM (SELECT b.*, coalesce(r.readm, 0)::BIGINT AS readmissions, coalesce(r.n, 0)::BIGINT AS episodes,
          {ratio('coalesce(r.readm, 0)', 'coalesce(r.n, 0)')} AS readmission_rate
        FROM provider_base b LEFT JOIN (SELECT provider_key, sum(readmission_within_30_days) AS readm,
            count(DISTINCT episode_key) AS n FROM fact_inpatient_episode GROUP BY 1) r
          ON b.provider_key = r.provider_key)))""")

CTES["mart_readmission_queue"] = (["episodes_enriched"], f"""
  SELECT * EXCLUDE (raf_p, los_p, idx_p, cc_p),
    {case_band('readmission_priority_score', [0, 0.55, 0.75, 0.90, 1.01], ["Monitor", "Follow-up", "High risk", "Immediate outreach"])}
      AS priority_tier,
    CASE WHEN readmission_within_30_days = 1 THEN 'Review discharge transition and avoidable readmission drivers'
      ELSE '7-day follow-up, medication reconciliation, PCP access check' END AS recommended_action
  FROM (SELECT *, {score([(0.30, 'raf_p'), (0.25, 'los_p'), (0.20, 'idx_p'), (0.15, 'cc_p'),
        (0.10, 'readmission_within_30_days::DOUBLE')])} AS readmission_priority_score
    FROM (SELECT *, {pct('raf_like_score')} AS raf_p, {pct('length_of_stay')} AS los_p,
        {pct('readmission_index')} AS idx_p, {pct('chronic_condition_count')} AS cc_p FROM episodes_enriched))""")

CTES["fwa_scored"] = (["fact_claim"], f"""
  SELECT *, {score([(0.36, 'claim_paid_percentile'), (0.26, 'coalesce(provider_paid_percentile, 0)'),
      (0.18, 'least(greatest(similar_claim_count, 1), 4)::DOUBLE / 4.0::DOUBLE'), (0.12, 'denied_flag::DOUBLE'),
      (0.08, 'prior_auth_flag::DOUBLE')])} AS fwa_score
  FROM (SELECT c.*, {pct('c.paid_amount')} AS claim_paid_percentile, p.provider_paid_percentile,
      count(*) OVER (PARTITION BY c.member_key, c.provider_key, c.service_key, c.claim_from_date_key)
        AS similar_claim_count
    FROM fact_claim c LEFT JOIN (SELECT provider_key, {pct('paid')} AS provider_paid_percentile
      FROM (SELECT provider_key, sum(paid_amount) AS paid FROM fact_claim GROUP BY 1)) p
      ON c.provider_key = p.provider_key)""")

CTES["mart_fwa_queue"] = (["fwa_scored", "dim_member", "dim_provider", "dim_service", "dim_diagnosis"], """
  SELECT claim_id, member_id, provider_name, specialty_group, service_line, diagnosis_group,
    paid_amount::DOUBLE AS paid_amount, similar_claim_count, fwa_score,
    CASE WHEN similar_claim_count > 1 THEN 'Duplicate-like same-day pattern'
      WHEN claim_paid_percentile >= 0.98 THEN 'High paid claim outlier'
      WHEN provider_paid_percentile >= 0.95 THEN 'High-volume provider payment pattern'
      WHEN denied_flag = 1 THEN 'Denied or adjusted claim' ELSE 'Composite anomaly score' END AS review_reason,
    CASE WHEN fwa_score >= 0.82 THEN 'SIU/payment integrity review' ELSE 'Analyst validation' END AS recommended_action
  FROM fwa_scored f LEFT JOIN dim_member m ON f.member_key = m.member_key
  LEFT JOIN dim_provider p ON f.provider_key = p.provider_key LEFT JOIN dim_service s ON f.service_key = s.service_key
  LEFT JOIN dim_diagnosis d ON f.primary_diagnosis_key = d.diagnosis_key
  WHERE fwa_score >= (SELECT round(quantile_cont(fwa_score, 0.82), 6) FROM fwa_scored)""")

CTES["mart_hcc_risk"] = (["risk_of_year", "dim_member"], f"""
  SELECT * EXCLUDE (gap_p, paid_p, paid_12m), paid_12m::DOUBLE AS paid_12m,
    {case_band('hcc_gap_priority', [0, 0.55, 0.75, 0.90, 1.01], ["Monitor", "Review", "High priority", "Immediate chart review"])}
      AS priority_tier
  FROM (SELECT *, {score([(0.45, 'gap_p'), (0.35, 'raf_percentile'), (0.20, 'paid_p')])} AS hcc_gap_priority
    FROM (SELECT r.*, m.member_id, m.state_code, m.plan_type, {pct('r.raf_like_score')} AS raf_percentile,
        {pct('r.suspected_hcc_gap_count')} AS gap_p, {pct('r.paid_12m')} AS paid_p
      FROM risk_of_year r LEFT JOIN dim_member m ON r.member_key = m.member_key))""")

CTES["mart_utilization"] = (["fact_member_month", "fact_claim"], f"""
  SELECT month_key, member_months, paid::DOUBLE AS paid_amount, coalesce(admissions, 0)::BIGINT AS admissions,
    coalesce(ed_visits, 0)::BIGINT AS ed_visits, coalesce(avoidable_ed_visits, 0)::BIGINT AS avoidable_ed_visits,
    coalesce(pharmacy_claims, 0)::BIGINT AS pharmacy_claims,
    {ratio('coalesce(admissions, 0)', 'member_months')} * 1000.0::DOUBLE AS admissions_per_1000,
    {ratio('coalesce(ed_visits, 0)', 'member_months')} * 1000.0::DOUBLE AS ed_visits_per_1000,
    {ratio('coalesce(avoidable_ed_visits, 0)', 'member_months')} * 1000.0::DOUBLE AS avoidable_ed_per_1000,
    {ratio('paid', 'member_months')} AS pmpm
  FROM (SELECT month_key, sum(eligible_flag)::BIGINT AS member_months, sum(paid_amount) AS paid
        FROM fact_member_month GROUP BY 1) m
  LEFT JOIN (SELECT paid_month_key, sum(inpatient_flag) AS admissions, sum(ed_flag) AS ed_visits,
      sum(avoidable_ed_flag) AS avoidable_ed_visits, sum(pharmacy_flag) AS pharmacy_claims
      FROM fact_claim GROUP BY 1) u ON m.month_key = u.paid_month_key""")


def with_ctes(body: str, *names: str, extra: dict[str, tuple[list[str], str]] | None = None) -> str:
    """``body`` with the CTEs it names, and those they read, in front of it."""
    known = {**CTES, **(extra or {})}
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for needed in known[name][0]:
            visit(needed)
        ordered.append(name)

    for name in names:
        visit(name)
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({known[n][1]})" for n in ordered) + "\n" + body


def everything(name: str, columns: str = "*") -> str:
    return with_ctes(f"SELECT {columns} FROM {name}", name)
