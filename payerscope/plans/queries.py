"""Every registered query: name, Spark callable, and DuckDB text where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed_values import MISSING_TEXTS
from ..functions.expr import date_key, key_to_date, matches
from ..operators import care, coding, cost, kpis, marts, quality, review, scoring, sqlpack
from ..operators import star as star_ops
from ..session import shared_folder, write_shared
from ..sources import claims_file as custom
from ..sources import sinks
from ..sources import tables as src
from . import feeds, score_checks
from .build import BASE_TABLES, CUSTOM_PLAN_YEAR, extract, extract_star, sorted_lines, star
from .extract import loose_extract
from .oracle_custom import CUSTOM, TYPED_COLUMNS
from .oracle_design import AMOUNTS, DESIGN
from .oracle_star import PROVIDER_COLS, everything, ratio, with_ctes
from .run import run_all

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, query: Query, sql: str | None = None) -> None:
    QUERIES[name] = query
    if sql is not None:
        ORACLE[name] = sql


def over_star(build: Callable[[dict[str, DataFrame]], DataFrame]) -> Query:
    return lambda spark, folder: build(star(spark, folder))


def base_table(name: str) -> Query:
    return lambda spark, folder: star(spark, folder)[name]


for _name in ("fact_member_month", "fact_inpatient_episode", "fact_member_risk"):
    register(_name, base_table(_name), everything(_name))
register("claims_enriched", over_star(star_ops.enrich_claims), everything("claims_enriched"))
register("episodes_enriched", over_star(star_ops.enrich_episodes), everything("episodes_enriched"))
for _name, _build in marts.MARTS.items():
    register(_name, over_star(_build), everything(_name))
register("top_claim_per_member", over_star(marts.top_claim_labels), everything("top_claim_per_member"))


# --- claims file: scan, coercion, dimensions and facts ------------------------------

def custom_sql(body: str, *names: str) -> str:
    return with_ctes(body, *names, extra=CUSTOM)


# Claims in a file of the extract: a compressed file is read by one task.
EXTRACT_FILE = 100_000


def written_extract(spark: SparkSession, folder: str) -> str:
    """The extract as compressed CSV files in the shared folder, in the order of claim numbers.

    The files of a task follow each other by name up to its thousandth; its sorted part is far below 10^8 claims.
    """
    path = f"{shared_folder(spark)}/extract-{uuid.uuid4().hex}"
    claims = loose_extract(sorted_lines(spark, folder)).drop(*src.SOURCE_POSITION)
    sinks.write_csv({"claims": claims}, path, compression="gzip", maxRecordsPerFile=EXTRACT_FILE)
    return f"{path}/claims"


def custom_scan(spark: SparkSession, folder: str) -> DataFrame:
    return custom.canonicalize(custom.scan_csv(spark, written_extract(spark, folder)))


def custom_row_keys(spark: SparkSession, folder: str) -> DataFrame:
    """The typed rows of a scanned file with the numbers that the scan gave them."""
    rows, _ = custom.load_rows(custom.load_cells(custom.scan_csv(spark, written_extract(spark, folder))), CUSTOM_PLAN_YEAR)
    return rows


def custom_defaults(spark: SparkSession, folder: str) -> DataFrame:
    """A source with amounts and dates only: everything else takes its default."""
    bare = extract(spark, folder).select(
        F.col("Claim Number").alias("row_order"), "Allowed", "Service Date", *src.SOURCE_POSITION
    )
    order = ["row_order", *src.SOURCE_POSITION]
    rows, _ = custom.load_rows(custom.load_cells(bare, order), CUSTOM_PLAN_YEAR, order)
    return rows


def coerced(*columns: str) -> Query:
    """Typed columns of the extract, straight from the coercion step."""
    def query(spark: SparkSession, folder: str) -> DataFrame:
        cells = extract_star(spark, folder)["_cells"]
        return custom.coerce(cells, CUSTOM_PLAN_YEAR, custom.date_forms(cells)).select("claim_id", *columns)
    return query


def custom_defaulted_cells(spark: SparkSession, folder: str) -> DataFrame:
    cells = extract_star(spark, folder)["_cells"]
    return custom.defaulted_cells(cells, custom.date_forms(cells))


def custom_table(name: str, columns: list[str] | None = None, with_readmission: bool = False) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        df = extract_star(spark, folder, with_readmission)[name]
        return df.select(*columns) if columns else df
    return query


def regex_flags(spark: SparkSession, folder: str) -> DataFrame:
    data = custom.canonicalize(extract(spark, folder))
    return data.select(
        "claim_id",
        matches(F.col("plan_type"), "dual").alias("dual_eligible"),
        matches(F.col("specialty_group"), "(facility|hospital)").alias("facility"),
        matches(F.col("claim_type"), "inpatient").alias("inpatient"),
        matches(F.col("service_line"), "(emergency|ed)").alias("ed"),
    )


_as_read = "CASE WHEN trim(COLUMNS(*)::VARCHAR) NOT IN (" + ", ".join(f"'{t}'" for t in MISSING_TEXTS) + ") THEN COLUMNS(*) END"
register("custom_scan", custom_scan, custom_sql(f"SELECT {_as_read} FROM canonical", "canonical"))
register("custom_row_keys", custom_row_keys, custom_sql("SELECT *, 0 AS readmission_flag FROM rows", "rows"))
register("custom_defaulted_cells", custom_defaulted_cells, custom_sql(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, cells, missing AS missing_cells, unreadable AS unreadable_cells, low AS raised_to_zero, "
    f"n - cells + missing + unreadable AS defaulted_cells FROM bad_cells WHERE c = '{c}'" for c in TYPED_COLUMNS), "bad_cells"))
register("custom_canonicalize", lambda spark, folder: custom.canonicalize(extract(spark, folder)),
         custom_sql("SELECT * FROM canonical", "canonical"))
register("custom_defaults", custom_defaults, custom_sql("""
  SELECT row_number() OVER (ORDER BY claim_id) AS claim_key,
    'CUSTOM' || lpad((row_number() OVER (ORDER BY claim_id))::VARCHAR, 6, '0') AS claim_id,
    'MEM' || lpad(((row_number() OVER (ORDER BY claim_id) - 1) % greatest(1, count(*) OVER () // 3) + 1)::VARCHAR, 5, '0') AS member_id,
    'PRV' || lpad(((row_number() OVER (ORDER BY claim_id) - 1) % greatest(1, count(*) OVER () // 5) + 1)::VARCHAR, 5, '0') AS provider_id,
    'Custom Provider' AS provider_name, 'Primary care' AS specialty_group, 'Professional' AS claim_type,
    'Office visit' AS service_line, 'Preventive/other' AS diagnosis_group, allowed_amount, 180::DECIMAL(18,2) AS paid_amount,
    25::DECIMAL(18,2) AS member_responsibility_amount, 1.0::DOUBLE AS chronic_condition_count, 0.85::DOUBLE AS raf_like_score,
    0 AS inpatient_flag, 0 AS ed_flag, 0 AS readmission_flag, 'US' AS state_code, 'Medicare Advantage' AS plan_type,
    claim_from_date, claim_from_date AS claim_thru_date FROM rows""", "rows"))
_numbers = ["allowed_amount", "paid_amount", "member_responsibility_amount", "chronic_condition_count", "raf_like_score"]
for _name, _columns in {
    "coerce_numeric": _numbers,
    "coerce_flags": ["inpatient_flag", "ed_flag"],
    "coerce_dates": ["claim_from_date", "claim_thru_date"],
}.items():
    register(_name, coerced(*_columns), custom_sql(f"SELECT claim_id, {', '.join(_columns)} FROM rows", "rows"))
for _name, _columns in {
    "date_keys": ["claim_id", "claim_from_date_key", "claim_thru_date_key", "paid_month_key"],
    "length_of_stay": ["claim_id", "length_of_stay"],
    "claim_flags": ["claim_id", "avoidable_ed_flag", "pharmacy_flag", "prior_auth_flag", "denied_flag"],
}.items():
    register(_name, custom_table("fact_claim", _columns), custom_sql(f"SELECT {', '.join(_columns)} FROM c_claim", "c_claim"))
for _name, _columns in {
    "age_band": ["member_id", "age", "age_band"],
    "risk_segment": ["member_id", "raf_like_score", "risk_segment"],
    "member_derivations": [
        "member_id", "age", "hcc_count", "diabetes_flag", "copd_flag", "chf_flag", "ckd_flag", "behavioral_health_flag",
    ],
}.items():
    register(_name, custom_table("dim_member", _columns), custom_sql(f"SELECT {', '.join(_columns)} FROM c_member", "c_member"))
register("regex_flags", regex_flags, custom_sql("""
  SELECT claim_id, regexp_matches(plan_type, 'dual', 'i')::INT AS dual_eligible,
    regexp_matches(specialty_group, 'facility|hospital', 'i')::INT AS facility,
    regexp_matches(claim_type, 'inpatient', 'i')::INT AS inpatient,
    regexp_matches(service_line, 'emergency|ed', 'i')::INT AS ed FROM canonical""", "canonical"))
for _name, _cte in {
    "dim_member": "c_member", "dim_provider": "c_provider", "dim_service": "c_service", "dim_diagnosis": "c_diagnosis",
    "fact_claim": "c_claim",
}.items():
    register(_name, custom_table(_name), custom_sql(f"SELECT * FROM {_cte}", _cte))
register("readmission_override", custom_table("fact_inpatient_episode", with_readmission=True),
         custom_sql("SELECT * FROM c_episode", "c_episode"))


# --- SQL pack, headline figures, quality, counts -------------------------------------

register("provider_scored_sql", over_star(lambda s: sqlpack.run_sql(sqlpack.PROVIDER_SCORED, s)), with_ctes("""
  SELECT provider_name, specialty_group, claims, members, paid::DOUBLE AS paid_amount,
    paid::DOUBLE / nullif(members, 0)::DOUBLE AS payment_per_member,
    claims::DOUBLE / nullif(members, 0)::DOUBLE AS services_per_member, quality_score FROM provider_base""", "provider_base"))
for _name, _text in sqlpack.QUERY_PACK.items():
    _mart = sqlpack.placeholders(_text)[0]
    register(_name, over_star(lambda s, text=_text: sqlpack.run_sql(text, s)),
             with_ctes(_text.replace("{" + _mart + "}", _mart), _mart))
PACK_COLUMNS = {
    "high_cost_member_interventions": "member_id,state_code,plan_type,risk_segment,paid_12m,admissions,ed_visits,"
                                      "risk_priority_score,priority_tier,recommended_intervention",
    "readmission_outreach_queue": "episode_key,member_id,provider_name,diagnosis_group,length_of_stay,"
                                  "readmission_within_30_days,readmission_priority_score,recommended_action",
    "fwa_payment_integrity_queue": "claim_id,member_id,provider_name,specialty_group,service_line,paid_amount,fwa_score,"
                                   "review_reason,recommended_action",
    "pmpm_market_trends": "month_key,state_code,plan_type,risk_segment,member_months,paid_amount,pmpm",
}
register("query_pack_summary", over_star(lambda s: sinks.run_summary(sqlpack.run_pack(s))), with_ctes(
    " UNION ALL ".join(
        f"SELECT '{name}' AS name, (SELECT least(count(*), {60 if name == 'pmpm_market_trends' else 30}) FROM "
        f"{sqlpack.placeholders(text)[0]}) AS rows, '{PACK_COLUMNS[name]}' AS columns"
        for name, text in sqlpack.QUERY_PACK.items()
    ), *[sqlpack.placeholders(text)[0] for text in sqlpack.QUERY_PACK.values()]))

CHECKED = "fact_claim dim_member dim_provider fact_member_month fact_inpatient_episode".split()
_checks_sql = """
  SELECT check_name, CASE WHEN passed THEN 'PASS' ELSE 'FAIL' END AS status, value::VARCHAR AS value, threshold FROM (
  SELECT 'claim_rows_positive' AS check_name, count(*) > 0 AS passed, count(*)::VARCHAR AS value, '> 0' AS threshold FROM fact_claim
  UNION ALL SELECT 'claim_id_unique', count(*) = count(DISTINCT claim_id), count(DISTINCT claim_id)::VARCHAR, 'unique' FROM fact_claim
  UNION ALL SELECT 'member_key_integrity', count(*) = 0, count(*)::VARCHAR, 'all claims map to members' FROM fact_claim c
    WHERE NOT EXISTS (SELECT 1 FROM dim_member m WHERE m.member_key = c.member_key)
  UNION ALL SELECT 'provider_key_integrity', count(*) = 0, count(*)::VARCHAR, 'all claims map to providers' FROM fact_claim c
    WHERE NOT EXISTS (SELECT 1 FROM dim_provider m WHERE m.provider_key = c.provider_key)
  UNION ALL SELECT 'paid_amount_non_negative', min(paid_amount) >= 0, min(paid_amount)::VARCHAR, '>= 0' FROM fact_claim
  UNION ALL SELECT 'allowed_amount_non_negative', min(allowed_amount) >= 0, min(allowed_amount)::VARCHAR, '>= 0' FROM fact_claim
  UNION ALL SELECT 'claim_date_order', count(*) = 0, count(*)::VARCHAR, 'from <= thru' FROM fact_claim
    WHERE claim_from_date_key > claim_thru_date_key
  UNION ALL SELECT 'member_month_unique', count(*) = count(DISTINCT (member_key, month_key)),
    (count(*) - count(DISTINCT (member_key, month_key)))::VARCHAR, '0 duplicates' FROM fact_member_month
  UNION ALL SELECT 'member_months_positive', sum(eligible_flag) > 0, sum(eligible_flag)::VARCHAR, '> 0' FROM fact_member_month
  UNION ALL SELECT 'readmission_days_non_negative', min(days_to_readmission) >= 0, min(days_to_readmission)::VARCHAR, '>= 0'
    FROM fact_inpatient_episode""" + "".join(
    f"\n  UNION ALL SELECT '{m}_not_empty', count(*) > 0, count(*)::VARCHAR, '> 0 rows' FROM {m}" for m in marts.MARTS
) + ")"
register("quality_report", over_star(quality.quality_report), with_ctes(_checks_sql, *CHECKED, *marts.MARTS))

register("quality_status", over_star(lambda s: quality.quality_status(quality.quality_report(s))), with_ctes(f"""
  SELECT CASE WHEN bool_and(status = 'PASS') THEN 'PASS' ELSE 'FAIL' END AS status, count(*) AS checks,
    count(*) FILTER (status = 'FAIL') AS failures FROM ({_checks_sql})""", *CHECKED, *marts.MARTS))

_complex = "(SELECT count(*) FROM mart_high_cost_member WHERE priority_tier = 'Complex care')"
register("kpi_summary", over_star(lambda s: kpis.kpi_summary(s, quality.quality_report(s))), with_ctes(f"""
  SELECT (SELECT count(*) FROM fact_claim) AS claims, (SELECT count(*) FROM dim_member) AS members,
    (SELECT sum(paid_amount)::DOUBLE FROM fact_claim) AS paid,
    (SELECT sum(paid_amount::DECIMAL(28,2))::DOUBLE / greatest(sum(member_months)::DOUBLE, 1.0::DOUBLE) FROM mart_member_month_pmpm) AS pmpm,
    (SELECT sum(readmission_within_30_days)::DOUBLE / count(*)::DOUBLE FROM fact_inpatient_episode) AS readmission_rate,
    {_complex} AS complex_members,
    (SELECT count(*) FROM mart_provider_performance WHERE performance_tier = 'Intervention') AS provider_interventions,
    (SELECT count(*) FROM mart_fwa_queue) AS fwa_cases,
    (SELECT count(*) FROM ({_checks_sql}) WHERE status = 'FAIL') AS quality_failures""", *CHECKED, *marts.MARTS))
register("pmpm_trend", over_star(lambda s: kpis.pmpm_trend(s["mart_member_month_pmpm"])), with_ctes("""
  SELECT month_key, sum(pmpm::DECIMAL(28,6))::DOUBLE / count(*)::DOUBLE AS pmpm,
    sum(paid_amount::DECIMAL(28,2))::DOUBLE AS paid_amount, sum(member_months)::BIGINT AS member_months
  FROM mart_member_month_pmpm GROUP BY 1""", "mart_member_month_pmpm"))
register("risk_cost", over_star(lambda s: kpis.risk_cost(s["mart_high_cost_member"])), with_ctes("""
  SELECT risk_segment, sum(paid_12m::DECIMAL(28,2))::DOUBLE AS paid_12m, count(DISTINCT member_key) AS members
  FROM mart_high_cost_member WHERE risk_segment IS NOT NULL GROUP BY 1""", "mart_high_cost_member"))
register("top_n_queues", over_star(kpis.top_n_queues), with_ctes(" UNION ALL ".join(
    f"(SELECT '{queue}' AS queue, {key}::VARCHAR AS entity, {score} AS score FROM {mart} ORDER BY {score} DESC, {key} LIMIT {n})"
    for queue, (mart, key, score, n) in kpis.QUEUES.items()), *{q[0] for q in kpis.QUEUES.values()}))
for _queue, (_mart, _key, _score, _size) in kpis.QUEUES.items():
    register(f"queue_{_queue}", over_star(lambda s, q=_queue: kpis.top_rows(s, q)), with_ctes(
        f"SELECT * FROM {_mart} ORDER BY {_score} DESC, {_key} LIMIT {_size}", _mart))
_counted = [*BASE_TABLES, *marts.MARTS]
register("record_counts", over_star(lambda s: sinks.record_counts({n: s[n] for n in _counted})), with_ctes(
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS records FROM {t}" for t in _counted), *_counted))


def whole_run(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of each base table and mart as a whole run wrote them."""
    done = run_all(spark, folder, f"{shared_folder(spark)}/run-all-{uuid.uuid4().hex}")
    rows = [(name, done.records[name]) for name in _counted]
    return spark.createDataFrame(rows, "table_name string, records bigint")


register("run_all", whole_run, ORACLE["record_counts"])


# --- scores --------------------------------------------------------------------------

register("target_high_cost",
         over_star(lambda s: scoring.high_cost_target(star_ops.risk_of_year(s)).select("member_key", "target_high_cost")),
         with_ctes("""
  SELECT member_key, (round(paid_12m::DOUBLE, 6) >= (SELECT round(quantile_cont(paid_12m::DOUBLE, 0.9), 6) FROM risk_of_year))::INT
    AS target_high_cost FROM risk_of_year""", "risk_of_year"))
register("score_high_cost", over_star(lambda s: scoring.score_high_cost(s).scores))
register("score_readmission", over_star(lambda s: scoring.score_readmission(s).scores))
register("provider_features", over_star(scoring.provider_features), with_ctes(f"""
  SELECT provider_key, claims, members, paid::DOUBLE AS paid_amount, allowed::DOUBLE AS allowed_amount, inpatient_claims,
    ed_claims, denied_claims, {PROVIDER_COLS}, payment_per_member, services_per_member,
    {ratio('denied_claims', 'claims')} AS denial_rate FROM provider_base""", "provider_base"))
register("score_provider_anomaly", over_star(lambda s: scoring.score_provider_anomaly(s).scores))
register("score_high_cost_bounds", over_star(lambda s: scoring.score_bounds(
    scoring.score_high_cost(s).scores, "predicted_high_cost_probability", "member_key", "target_high_cost")), with_ctes("""
  SELECT member_key, (round(paid_12m::DOUBLE, 6) >= (SELECT round(quantile_cont(paid_12m::DOUBLE, 0.9), 6) FROM risk_of_year))::INT
    AS target_high_cost, true AS score_in_range FROM risk_of_year""", "risk_of_year"))
register("score_readmission_bounds", over_star(lambda s: scoring.score_bounds(
    scoring.score_readmission(s).scores, "predicted_readmission_probability", "episode_key", "readmission_within_30_days")), with_ctes(
    "SELECT episode_key, readmission_within_30_days, true AS score_in_range FROM fact_inpatient_episode", "fact_inpatient_episode"))
register("score_provider_bounds", over_star(lambda s: scoring.score_bounds(
    scoring.score_provider_anomaly(s).scores, "provider_anomaly_score", "provider_key")), with_ctes(
    "SELECT provider_key, true AS score_in_range FROM provider_base", "provider_base"))
register("model_metrics", over_star(lambda s: scoring.model_metrics(s["_models"])))
register("model_metrics_counted", over_star(score_checks.counted_metrics),
         with_ctes(score_checks.METRICS_SQL, "risk_of_year", "fact_inpatient_episode", "provider_base"))
register("quality_report_models",
         over_star(lambda s: quality.quality_report(s, scoring.model_metrics(s["_models"]))),
         with_ctes(f"{_checks_sql} UNION ALL {score_checks.MODEL_CHECKS_SQL}", *CHECKED, *marts.MARTS, "provider_base"))
register("score_fixed_forest", over_star(score_checks.fixed_forest_scores), with_ctes(score_checks.FOREST_SQL, "risk_of_year"))
register("score_fixed_isolation", over_star(score_checks.fixed_isolation_scores), with_ctes(score_checks.ISOLATION_SQL, "provider_base"))
register("score_one_class", over_star(score_checks.one_class_scores), with_ctes(
    "SELECT member_key, 1.0::DOUBLE AS score FROM risk_of_year", "risk_of_year"))
register("score_coerced_features", score_checks.coerced_features, custom_sql(score_checks.FEATURES_SQL, "canonical"))
register("lineage_hashes", score_checks.lineage_hashes, score_checks.LINEAGE_SQL)
register("baseline_models", over_star(scoring.baseline_metrics))


def lift_rows(s) -> DataFrame:
    target = scoring.high_cost_target(star_ops.risk_of_year(s)).select("member_key", "target_high_cost")
    return s["mart_high_cost_member"].select("member_key", "risk_priority_score").join(target, "member_key")


LIFT = {"lift_rows": (["mart_high_cost_member", "risk_of_year"], """
  SELECT risk_priority_score AS score, (round(paid_12m::DOUBLE, 6) >= (SELECT round(quantile_cont(paid_12m::DOUBLE, 0.9), 6)
    FROM risk_of_year))::INT AS target
  FROM (SELECT member_key, risk_priority_score FROM mart_high_cost_member) m
  JOIN (SELECT member_key, paid_12m FROM risk_of_year) r USING (member_key)""")}
register("score_lift", over_star(lambda s: scoring.score_lift(lift_rows(s), "risk_priority_score", "target_high_cost")),
         with_ctes("""
  SELECT risk_decile, rows, positives, score_sum / rows::DOUBLE AS mean_score, positives / rows::DOUBLE AS observed_rate,
    (sum(positives) OVER w)::DOUBLE / (sum(rows) OVER w)::DOUBLE AS precision_at_k,
    (sum(positives) OVER w)::DOUBLE / (sum(positives) OVER ())::DOUBLE AS recall_at_k,
    positives / rows::DOUBLE / ((sum(positives) OVER ())::DOUBLE / (sum(rows) OVER ())::DOUBLE) AS lift,
    (sum(rows) OVER w)::BIGINT AS workload
  FROM (SELECT risk_decile, count(*) AS rows, sum(target)::BIGINT AS positives, sum(score::DECIMAL(18,6))::DOUBLE AS score_sum
    FROM (SELECT *, (floor((rank() OVER (ORDER BY score DESC) - 1) * 10 / (count(*) OVER ())) + 1)::INT AS risk_decile FROM lift_rows)
    GROUP BY 1) WINDOW w AS (ORDER BY risk_decile)""", "lift_rows", extra=LIFT))
register("score_rank_metrics", over_star(lambda s: scoring.evaluation(lift_rows(s), "risk_priority_score", "target_high_cost")),
         with_ctes("""
  SELECT rows, positives, round((rank_sum - positives * (positives + 1.0::DOUBLE) / 2.0::DOUBLE)
      / (positives::DOUBLE * (rows - positives)::DOUBLE), 9) AS roc_auc, round(pr_auc, 9) AS pr_auc, round(capture, 9) AS capture
  FROM (SELECT count(*) AS rows, sum(target)::BIGINT AS positives, sum(target * avg_rank) AS rank_sum FROM (
      SELECT target, (rank() OVER (ORDER BY score) - 1)::DOUBLE + (count(*) OVER (PARTITION BY score) + 1)::DOUBLE / 2.0::DOUBLE AS avg_rank
      FROM lift_rows)),
    (SELECT sum(pos::DOUBLE / total * (seen / reached)) AS pr_auc FROM (
      SELECT pos, (sum(pos) OVER ())::DOUBLE AS total, (sum(pos) OVER w)::DOUBLE AS seen, (sum(k) OVER w)::DOUBLE AS reached
      FROM (SELECT score, count(*) AS k, sum(target) AS pos FROM lift_rows GROUP BY 1) WINDOW w AS (ORDER BY score DESC))),
    (SELECT sum(taken * pos::DOUBLE / k::DOUBLE) / sum(taken) AS capture FROM (
      SELECT k, pos, least(greatest(greatest((sum(k) OVER ()) // 10, 1) - (sum(k) OVER w - k), 0), k)::DOUBLE AS taken
      FROM (SELECT score, count(*) AS k, sum(target) AS pos FROM lift_rows GROUP BY 1) WINDOW w AS (ORDER BY score DESC)))""",
    "lift_rows", extra=LIFT))
register("stratified_split", over_star(lambda s: scoring.stratified_split(
    scoring.high_cost_target(star_ops.risk_of_year(s)), "member_key", "target_high_cost"
).select("member_key", "target_high_cost", "is_test")), with_ctes("""
  SELECT member_key, target_high_cost, rank() OVER (PARTITION BY target_high_cost ORDER BY draw) - 1
      >= ceil(count(*) OVER (PARTITION BY target_high_cost) * 0.7::DOUBLE) AS is_test
  FROM (SELECT member_key, ('0x' || substr(md5('split-' || member_key), 1, 6))::BIGINT AS draw,
      (round(paid_12m::DOUBLE, 6) >= (SELECT round(quantile_cont(paid_12m::DOUBLE, 0.9), 6) FROM risk_of_year))::INT
        AS target_high_cost FROM risk_of_year)""", "risk_of_year"))
register("confusion_counts",
         over_star(lambda s: scoring.confusion_counts(lift_rows(s), "risk_priority_score", "target_high_cost", 0.75)),
         with_ctes("""
  SELECT count(*) FILTER (score >= 0.75 AND target = 1) AS true_positive, count(*) FILTER (score >= 0.75 AND target = 0) AS false_positive,
    count(*) FILTER (score < 0.75 AND target = 1) AS false_negative, count(*) FILTER (score < 0.75 AND target = 0) AS true_negative
  FROM lift_rows""", "lift_rows", extra=LIFT))


# --- yearly, provider, episode and coding operators ---------------------------------------

def design_sql(body: str, *names: str) -> str:
    return with_ctes(body, *names, extra=DESIGN)


def design_all(name: str) -> str:
    return design_sql(f"SELECT * FROM {name}", name)


def wide_codes(spark: SparkSession, folder: str) -> DataFrame:
    return src.wide_codes(src.claim_lines(spark, folder))


BRIDGE_KEYS = ["claim_id", "member_key", "risk_year"]


def diagnosis_bridge(spark: SparkSession, folder: str) -> DataFrame:
    return coding.code_bridge(wide_codes(spark, folder), BRIDGE_KEYS, src.DIAGNOSIS_CODE_COLUMNS, "diagnosis_code")


def hcc_sets(spark: SparkSession, folder: str) -> DataFrame:
    return coding.hcc_sets(diagnosis_bridge(spark, folder), src.diagnoses(spark))


def last_year(spark: SparkSession, folder: str) -> int:
    """The last plan year. The years of the line items tell it, unless they are several periods, of which claims decide."""
    dates = src.claim_dates(spark, folder).select(date_key(F.col("from_date")).alias("claim_from_date_key"))
    years = sorted(star_ops.years_with_claims(dates))
    if all(later - year <= star_ops.WIDEST_GAP for year, later in zip(years, years[1:])):
        return years[-1]
    return star_ops.claim_years(star(spark, folder)["fact_claim"])[-1]


def hcc_gaps(spark: SparkSession, folder: str) -> DataFrame:
    return coding.hcc_gaps(hcc_sets(spark, folder), last_year(spark, folder))


def hcc_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return coding.hcc_rollup(hcc_sets(spark, folder), src.members(spark, folder), last_year(spark, folder))


def claim_feeds(s) -> dict[str, DataFrame]:
    service = s["dim_service"].select("service_key", "claim_type")
    return feeds.claim_feeds(s["fact_claim"].join(service, "service_key", "left"))


def lineage(spark: SparkSession, folder: str) -> DataFrame:
    return coding.with_lineage(src.table(spark, folder, "lineitem"))


def reconciliation(spark: SparkSession, folder: str) -> DataFrame:
    return cost.reconciliation(star(spark, folder), src.as_claims(src.claim_lines(spark, folder)))


def procedure_bridge(spark: SparkSession, folder: str) -> DataFrame:
    return coding.code_bridge(wide_codes(spark, folder), BRIDGE_KEYS, src.PROCEDURE_CODE_COLUMNS, "procedure_code")


def provider_year_features(spark: SparkSession, folder: str) -> DataFrame:
    procedures = coding.code_bridge(
        wide_codes(spark, folder), ["provider_key", F.col("risk_year").alias("feature_year")], src.PROCEDURE_CODE_COLUMNS, "procedure_code",
    )
    return review.provider_year_features(star(spark, folder), procedures)


def quality_report_ext(spark: SparkSession, folder: str) -> DataFrame:
    s = star(spark, folder)
    years = star_ops.claim_years(s["fact_claim"])
    by_year = care.member_year_features(s, years)
    stays = care.episode_features(s).join(s["fact_inpatient_episode"].select("episode_key", "admission_date_key"), "episode_key")
    features = {
        "feature_member_year": (by_year, F.make_date("feature_year", F.lit(1), F.lit(1))),
        "feature_member_month": (care.member_month_features(s), F.col("cutoff_date")),
        "feature_episode": (stays, key_to_date(F.col("admission_date_key"))),
    }
    targets = scoring.high_cost_target(star_ops.risk_of_year(s))
    return quality.extended_checks(
        s, diagnosis_bridge(spark, folder), procedure_bridge(spark, folder), care.readmission_30day(s), targets, features, by_year, years
    )


def score_opportunity(s) -> DataFrame:
    """The paid year before each month with claims as the score, the year from it on as the outcome."""
    scored = care.sums_of_windows(s, care.month_start, {
        "prior_": (-care.PRIOR_DAYS, -1, ["paid"]), "next_": (0, care.PRIOR_DAYS - 1, ["paid", "readmissions"])})
    return scoring.opportunity_of(scored, "prior_paid")


register("monthly_paid_by_type", over_star(cost.monthly_paid_by_type), design_sql(
    f"SELECT member_key, month_key AS year_month, {', '.join(f'{a}::DOUBLE AS {a}' for a in AMOUNTS)} FROM monthly", "monthly"))
register("segment_pmpm", over_star(cost.segment_pmpm), design_all("segment_pmpm"))
register("rolling_pmpm", over_star(cost.rolling_pmpm), design_sql("""
  SELECT year_month, state_code, age_band, risk_segment, eligible_member_months, pmpm,
    (sum(pmpm::DECIMAL(28,6)) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))::DOUBLE
      / (count(*) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))::DOUBLE AS rolling_3m_pmpm,
    (sum(pmpm::DECIMAL(28,6)) OVER (w ROWS BETWEEN 11 PRECEDING AND CURRENT ROW))::DOUBLE
      / (count(*) OVER (w ROWS BETWEEN 11 PRECEDING AND CURRENT ROW))::DOUBLE AS rolling_12m_pmpm
  FROM segment_pmpm WINDOW w AS (PARTITION BY state_code, age_band, risk_segment ORDER BY year_month)""", "segment_pmpm"))
register("readmission_30day", over_star(care.readmission_30day), design_all("readmission_30day"))
register("high_cost_flag", over_star(care.high_cost_flag), design_all("high_cost_flag"))
register("provider_peer_rank", over_star(review.provider_peer_rank), design_all("provider_peer_rank"))
register("fwa_provider_flags", over_star(review.fwa_provider_flags), design_all("fwa_provider_flags"))
register("provider_month", over_star(review.provider_month), design_all("provider_month"))
register("dim_date", over_star(cost.dim_date), design_all("dim_date"))
register("feature_member_year", over_star(lambda s: care.member_year_features(s, star_ops.claim_years(s["fact_claim"]))),
         design_all("feature_member_year"))
register("feature_member_month", over_star(care.member_month_features), design_all("feature_member_month"))
register("feature_provider_year", provider_year_features, design_all("feature_provider_year"))
register("provider_place_mix", over_star(review.provider_place_mix), design_all("provider_place_mix"))
register("score_opportunity", over_star(score_opportunity), design_sql("""
  SELECT cutoff_date, count(*) AS members, count(*) FILTER (flagged) AS workload, sum(next_paid)::DOUBLE AS next_paid,
    coalesce(sum(next_paid) FILTER (flagged), 0)::DOUBLE AS flagged_next_paid,
    round(coalesce(sum(next_paid) FILTER (flagged), 0)::DOUBLE / nullif(sum(next_paid), 0)::DOUBLE, 6) AS captured_share,
    coalesce(sum(next_back) FILTER (flagged), 0)::BIGINT AS flagged_next_readmissions,
    round(coalesce(sum(next_back) FILTER (flagged), 0)::BIGINT * (coalesce(sum(next_paid) FILTER (flagged), 0)::DOUBLE
      / (count(*) FILTER (flagged))::DOUBLE) * 0.25::DOUBLE, 2) AS estimated_opportunity
  FROM (SELECT *, round(prior_paid, 6) >= round(quantile_cont(round(prior_paid, 6), 0.9) OVER (PARTITION BY cutoff_date), 6) AS flagged
    FROM opportunity_rows) GROUP BY 1""", "opportunity_rows"))
register("threshold_metrics", over_star(lambda s: scoring.threshold_metrics(lift_rows(s), "risk_priority_score", "target_high_cost", 0.75)),
         with_ctes("""
  SELECT round(tp / nullif(tp + fp, 0), 6) AS precision, round(tp / nullif(tp + fn, 0), 6) AS recall,
    round(2 * tp / nullif(2 * tp + fp + fn, 0), 6) AS f1, round((tp + fp) / n, 6) AS flagged_share
  FROM (SELECT (count(*) FILTER (score >= 0.75 AND target = 1))::DOUBLE AS tp, (count(*) FILTER (score >= 0.75 AND target = 0))::DOUBLE AS fp,
    (count(*) FILTER (score < 0.75 AND target = 1))::DOUBLE AS fn, count(*)::DOUBLE AS n FROM lift_rows)""", "lift_rows", extra=LIFT))
register("score_calibration", over_star(lambda s: scoring.score_calibration(lift_rows(s), "risk_priority_score", "target_high_cost")),
         with_ctes("""
  SELECT bin, count(*) AS rows, sum(target)::BIGINT AS positives, round(sum(score::DECIMAL(18,6))::DOUBLE / count(*), 6) AS mean_score,
    round(sum(target)::DOUBLE / count(*), 6) AS observed_rate
  FROM (SELECT *, least(floor(score * 10)::INT, 9) + 1 AS bin FROM lift_rows) GROUP BY 1""", "lift_rows", extra=LIFT))
register("feature_episode", over_star(care.episode_features), design_all("feature_episode"))
register("diagnosis_bridge", diagnosis_bridge, design_all("diagnosis_bridge"))
register("procedure_bridge", procedure_bridge, design_all("procedure_bridge"))
register("hcc_gaps", hcc_gaps, design_all("hcc_gaps"))
register("hcc_rollup", hcc_rollup, design_all("hcc_rollup"))
register("claim_header_union", over_star(lambda s: coding.claim_header(claim_feeds(s))), design_sql("""
  SELECT claim_id, member_key, CASE WHEN claim_type <> 'Pharmacy' THEN provider_key END AS provider_key,
    strptime(claim_from_date_key::VARCHAR, '%Y%m%d')::DATE AS claim_from_date,
    strptime((CASE WHEN claim_type IN ('Inpatient', 'Outpatient') THEN claim_thru_date_key ELSE claim_from_date_key END)::VARCHAR,
      '%Y%m%d')::DATE AS claim_thru_date, paid_amount, claim_type
  FROM typed_claim WHERE claim_type IN ('Inpatient', 'Outpatient', 'Professional', 'Pharmacy')""", "typed_claim"))
_conflicts = {
    "Inpatient": [],
    "Outpatient": [("member_key", "member key", "string"), ("provider_key", "provider key", "string"), ("claim_from_date", "from date", "string"),
                   ("claim_thru_date", "thru date", "string"), ("paid_amount", "paid", "string")],
    "Professional": [("member_key", "MemberKey", "decimal(18,0)"), ("provider_key", "ProviderKey", "decimal(18,0)"),
                     ("claim_from_date", "ServiceDate", "string"), ("claim_thru_date", None, None), ("paid_amount", "PaidAmount", "string")],
    "Pharmacy": [("provider_key", None, None), ("claim_from_date", "fill_date", "int"), ("claim_thru_date", None, None),
                 ("paid_amount", "paid_cents", "bigint")],
}
_quoted = lambda text: "NULL" if text is None else f"'{text}'"
register("claim_header_conflicts", over_star(lambda s: coding.header_conflicts(claim_feeds(s))), design_sql(" UNION ALL ".join(
    f"SELECT '{kind}' AS claim_type, '{target}' AS column_name, {_quoted(column)}::VARCHAR AS source_column, {_quoted(own)}::VARCHAR AS source_type, "
    f"'{'cast' if column else 'absent'}' AS issue, 0::BIGINT AS unreadable_cells"
    for kind, rows in _conflicts.items() for target, column, own in rows)))
register("lineage", lineage)
register("record_hash", lambda spark, folder: coding.with_lineage(
    src.table(spark, folder, "customer")).select("c_custkey", "source_file", "record_hash"), """
  SELECT c_custkey, 'customer.parquet' AS source_file, sha256(array_to_string(list_transform(
    [c_custkey::VARCHAR, c_name, c_nationkey::VARCHAR, c_acctbal::VARCHAR, c_mktsegment],
    lambda v: ifnull(length(v) || ':' || v, '-')), '|')) AS record_hash FROM customer""")
register("kpi_dictionary", over_star(cost.kpi_dictionary), design_sql("""
  SELECT kpi, round(value, 6) AS value FROM (
    WITH c AS (SELECT count(*)::DOUBLE AS n, sum(paid_amount)::DOUBLE AS paid, sum(allowed_amount)::DOUBLE AS allowed,
        sum(inpatient_flag)::DOUBLE AS adm, sum(ed_flag)::DOUBLE AS ed, sum(denied_flag)::DOUBLE AS denied,
        sum(inpatient_flag * length_of_stay)::DOUBLE AS days FROM fact_claim),
      m AS (SELECT sum(eligible_flag)::DOUBLE AS mm, sum(paid_amount)::DOUBLE AS mm_paid FROM fact_member_month),
      e AS (SELECT count(*)::DOUBLE AS stays, sum(readmission_within_30_days)::DOUBLE AS back FROM fact_inpatient_episode),
      d AS (SELECT (count(*) - count(DISTINCT (member_key, provider_key, service_key, claim_from_date_key)))::DOUBLE AS extra FROM fact_claim),
      r AS (SELECT paid_12m, row_number() OVER (ORDER BY paid_12m DESC) AS i, count(*) OVER () AS n FROM risk_of_year)
    SELECT 'total_paid_amount' AS kpi, paid AS value FROM c UNION ALL SELECT 'allowed_amount', allowed FROM c
    UNION ALL SELECT 'paid_per_claim', paid / n FROM c UNION ALL SELECT 'eligible_member_months', mm FROM m
    UNION ALL SELECT 'pmpm', mm_paid / mm FROM m UNION ALL SELECT 'admissions_per_1000', adm / mm * 12000.0::DOUBLE FROM c, m
    UNION ALL SELECT 'ed_visits_per_1000', ed / mm * 12000.0::DOUBLE FROM c, m
    UNION ALL SELECT 'inpatient_days_per_1000', days / mm * 12000.0::DOUBLE FROM c, m
    UNION ALL SELECT 'average_length_of_stay', days / adm FROM c UNION ALL SELECT 'readmission_rate_30day', back / stays FROM e
    UNION ALL SELECT 'duplicate_claim_rate', extra / n FROM c, d UNION ALL SELECT 'denial_rate', denied / n FROM c
    UNION ALL SELECT 'cost_concentration_top_1_pct', sum(paid_12m) FILTER (i <= ceil(n * 0.01))::DOUBLE / sum(paid_12m)::DOUBLE FROM r
    UNION ALL SELECT 'cost_concentration_top_5_pct', sum(paid_12m) FILTER (i <= ceil(n * 0.05))::DOUBLE / sum(paid_12m)::DOUBLE FROM r
    UNION ALL SELECT 'cost_concentration_top_10_pct', sum(paid_12m) FILTER (i <= ceil(n * 0.10))::DOUBLE / sum(paid_12m)::DOUBLE FROM r)""",
    "fact_claim", "fact_member_month", "fact_inpatient_episode", "risk_of_year"))
register("kpi_risk_year", lambda spark, folder: cost.risk_kpis(hcc_rollup(spark, folder)), design_sql(f"""
  SELECT risk_year, round({ratio('total', 'k')}, 6) AS raf_average, round({ratio('back', 'expected')}, 6) AS hcc_recapture_rate
  FROM (SELECT risk_year, sum(raf_score_estimate::DECIMAL(18,3)) AS total, count(*) AS k, sum(recaptured_hcc_count) AS back,
      sum(recaptured_hcc_count + suspected_gap_count) AS expected FROM hcc_rollup GROUP BY 1)""", "hcc_rollup"))
register("kpi_high_cost_rate", over_star(lambda s: cost.high_cost_member_rate(care.high_cost_flag(s))), design_sql(f"""
  SELECT measurement_year, members, flagged::BIGINT AS high_cost_members, round({ratio('flagged', 'members')}, 6) AS high_cost_member_rate
  FROM (SELECT measurement_year, count(*) AS members, sum(high_cost_flag) AS flagged FROM high_cost_flag GROUP BY 1)""", "high_cost_flag"))
register("profile_diagnosis_groups", over_star(cost.profile_diagnosis_groups), with_ctes("""
  SELECT diagnosis_group, count(*) AS claims, sum(paid_amount)::DOUBLE AS paid_amount
  FROM fact_claim LEFT JOIN dim_diagnosis ON diagnosis_key = primary_diagnosis_key
  GROUP BY 1 ORDER BY 3 DESC, 1 LIMIT 10""", "fact_claim", "dim_diagnosis"))
register("profile_monthly_volume", over_star(cost.profile_monthly_volume), design_sql("""
  SELECT paid_month_key AS month_key, claim_type, count(*) AS claims, sum(paid_amount)::DOUBLE AS paid_amount
  FROM typed_claim GROUP BY ALL""", "typed_claim"))
register("profile_stays", over_star(cost.profile_stays), with_ctes(
    "SELECT length_of_stay, count(*) AS episodes FROM fact_inpatient_episode GROUP BY 1", "fact_inpatient_episode"))
register("profile_age_bands", over_star(cost.profile_age_bands), with_ctes(f"""
  SELECT age_band, members, round({ratio('chronic', 'members')}, 6) AS chronic_prevalence, episodes::BIGINT AS episodes,
    round({ratio('back', 'episodes')}, 6) AS readmission_rate
  FROM (SELECT age_band, count(*) AS members, count(*) FILTER (chronic_condition_count > 0) AS chronic,
      coalesce(sum(k), 0) AS episodes, coalesce(sum(b), 0) AS back
    FROM dim_member m LEFT JOIN (SELECT member_key, count(*) AS k, sum(readmission_within_30_days) AS b
      FROM fact_inpatient_episode GROUP BY 1) e ON e.member_key = m.member_key GROUP BY 1)""", "dim_member", "fact_inpatient_episode"))
register("denial_benchmark", lambda spark, folder: review.denial_benchmark(feeds.denial_counts(spark, folder)), f"""
  SELECT *, {ratio('claims_denied', 'claims_received')} AS denial_rate, {ratio('appeals_filed', 'claims_denied')} AS appeal_rate,
    {ratio('appeals_upheld', 'appeals_filed')} AS upheld_rate FROM (
    SELECT r_name AS issuer, n_name AS state_code, CASE c_mktsegment WHEN 'BUILDING' THEN 'MA-PD'
        WHEN 'FURNITURE' THEN 'Dual Eligible SNP' WHEN 'HOUSEHOLD' THEN 'Employer Group Waiver' ELSE 'Medicare Advantage' END AS plan_type,
      year(l_shipdate)::INT AS plan_year, count(*) AS claims_received,
      count(*) FILTER (l_returnflag = 'R' AND l_linenumber <= 3) AS claims_denied,
      count(*) FILTER (l_returnflag = 'R' AND l_linenumber <= 3 AND l_linestatus = 'F') AS appeals_filed,
      count(*) FILTER (l_returnflag = 'R' AND l_linenumber <= 3 AND l_linestatus = 'F' AND l_tax > 0.04) AS appeals_upheld
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2, 3, 4)""")
_years = "(SELECT DISTINCT claim_year AS y FROM typed_claim)"
_zero_checks = {
    "claim_id_not_null": ("0 missing", "fact_claim", "claim_id IS NULL"),
    "claim_id_unique_in_type": ("0 repeated", "(SELECT claim_type, claim_id, count(*) AS k FROM typed_claim GROUP BY 1, 2)", "k > 1"),
    "paid_amount_not_null": ("0 missing", "fact_claim", "paid_amount IS NULL"),
    "paid_amount_not_extremely_negative": (f">= {quality.LOWEST_PAID}", "fact_claim", f"paid_amount < {quality.LOWEST_PAID}"),
    "claims_in_plan_years": ("0 outside", "typed_claim", """coalesce(claim_year NOT IN (SELECT y FROM (
        SELECT y, k, sum(fresh) OVER (ORDER BY y) AS period FROM (
          SELECT y, k, (y - coalesce(lag(y) OVER (ORDER BY y), -9) > 5)::INT AS fresh
          FROM (SELECT claim_year AS y, count(*) AS k FROM typed_claim GROUP BY 1)))
      QUALIFY dense_rank() OVER (ORDER BY period) = 1), true)"""),
    "member_id_unique": ("0 repeated", "(SELECT member_id, count(*) AS k FROM dim_member GROUP BY 1)", "k > 1"),
    "age_in_range": ("0..110", "dim_member", "age NOT BETWEEN 0 AND 110"),
    "birth_before_claims": ("0 earlier", f"""(SELECT age, min(claim_year) AS first FROM typed_claim c
        JOIN dim_member m ON m.member_key = c.member_key GROUP BY m.member_key, age)""", f"first < (SELECT max(y) FROM {_years}) - age"),
    "eligibility_months_in_range": ("0..12", "dim_member", "eligibility_months NOT BETWEEN 0 AND 12"),
    "diagnosis_code_not_blank": ("0 blank", "diagnosis_bridge", "trim(diagnosis_code) = ''"),
    "diagnosis_position_valid": (">= 1", "diagnosis_bridge", "diagnosis_position < 1"),
    "principal_is_first": ("position 1", "diagnosis_bridge", "(principal_flag = 1) <> (diagnosis_position = 1)"),
    "procedure_code_not_blank": ("0 blank", "procedure_bridge", "trim(procedure_code) = ''"),
    "discharge_date_present": ("0 missing", "fact_inpatient_episode", "discharge_date_key IS NULL"),
    "transfers_are_no_readmissions": ("0 both", "readmission_30day", "readmission_30day_flag = 1 AND same_day_transfer_flag = 1"),
    "pmpm_excludes_ineligible": ("0 ineligible", "fact_member_month", "eligible_flag <> 1"),
    "feature_rows_match_grain": ("one row per member-year",
                                 "(SELECT member_key, count(*) AS k FROM feature_member_year GROUP BY 1)", f"k <> (SELECT count(*) FROM {_years})"),
    "target_not_null": ("0 missing", "risk_of_year", "paid_12m IS NULL"),
    "no_future_dates": ("0 at or after the cut-off", """(SELECT latest_source_date AS d, make_date(feature_year, 1, 1) AS c FROM feature_member_year
        UNION ALL SELECT latest_source_date, cutoff_date FROM feature_member_month
        UNION ALL SELECT latest_source_date, strptime(admission_date_key::VARCHAR, '%Y%m%d')::DATE
          FROM feature_episode f JOIN fact_inpatient_episode e ON e.episode_key = f.episode_key)""", "d >= c"),
}
register("quality_report_ext", quality_report_ext, design_sql(" UNION ALL ".join(
    f"SELECT '{name}' AS check_name, CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status, "
    f"count(*)::VARCHAR AS value, '{threshold}' AS threshold FROM {table} WHERE {rule}"
    for name, (threshold, table, rule) in _zero_checks.items()
), "fact_claim", "typed_claim", "dim_member", "diagnosis_bridge", "procedure_bridge", "fact_inpatient_episode", "fact_member_month",
    "feature_member_year", "feature_member_month", "feature_episode", "readmission_30day", "risk_of_year"))
_cuts = {"paid_p25": 0.25, "paid_p50": 0.50, "paid_p75": 0.75, "paid_p99": 0.99}
register("profile_claims", over_star(cost.profile_claims), design_sql(f"""
  SELECT claim_type, count(*) AS row_count, count(*) FILTER (primary_diagnosis_key IS NULL)::DOUBLE / count(*)::DOUBLE
      AS missing_diagnosis_share, min(paid_amount)::DOUBLE AS paid_min, max(paid_amount)::DOUBLE AS paid_max,
    sum(paid_amount)::DOUBLE / count(*)::DOUBLE AS paid_mean,
    sum(length_of_stay)::DOUBLE / count(*)::DOUBLE AS mean_length_of_stay,
    {', '.join(f'round(quantile_cont(paid_amount::DOUBLE, {q}), 6) AS {n}' for n, q in _cuts.items())}
  FROM typed_claim GROUP BY 1""", "typed_claim"))
register("winsorize", over_star(lambda s: cost.winsorize(s["fact_claim"])), with_ctes("""
  SELECT claim_key, paid_amount::DOUBLE AS paid_amount, least(greatest(paid_amount::DOUBLE, lo), hi) AS paid_winsorized
  FROM fact_claim, (SELECT round(quantile_cont(paid_amount::DOUBLE, 0.01), 6) AS lo,
    round(quantile_cont(paid_amount::DOUBLE, 0.99), 6) AS hi FROM fact_claim)""", "fact_claim"))
register("reconciliation", reconciliation, with_ctes("""
  SELECT 'raw' AS layer, count(*) AS row_count, sum(CASE WHEN denied_flag = 1 THEN 0 ELSE
      round(allowed_amount * (1 - discount), 2) END)::DOUBLE AS paid_amount FROM claim_lines
  UNION ALL SELECT 'gold_claim', count(*), sum(paid_amount)::DOUBLE FROM fact_claim
  UNION ALL SELECT 'gold_member_month', count(*), sum(paid_amount)::DOUBLE FROM fact_member_month
  UNION ALL SELECT 'gold_member_risk', sum(claim_count)::BIGINT, sum(paid_12m)::DOUBLE FROM fact_member_risk
  UNION ALL SELECT 'mart_claims_financials', sum(claims)::BIGINT, sum(paid_amount::DECIMAL(28,2))::DOUBLE FROM mart_claims_financials""",
    "claim_lines", "fact_claim", "fact_member_month", "fact_member_risk", "mart_claims_financials"))
register("risk_band_alt", over_star(lambda s: cost.risk_band_alt(s["dim_member"])), with_ctes("""
  SELECT member_key, raf_like_score, CASE WHEN raf_like_score < 0.7 THEN 'Low risk' WHEN raf_like_score <= 1.2 THEN 'Moderate risk'
    WHEN raf_like_score <= 2.5 THEN 'High risk' WHEN raf_like_score > 2.5 THEN 'Very high risk' END AS risk_band
  FROM dim_member""", "dim_member"))
