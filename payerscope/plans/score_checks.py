"""Queries that hold the score code to SQL: fixed small forests, tiers, fallbacks, metrics that follow from counts."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed_values import ANOMALY_FEATURES, ANOMALY_TIERS, HIGH_COST_FEATURES, HIGH_COST_MODEL_TIERS
from ..functions.expr import band
from ..operators import coding, forest, scoring
from ..operators import star as star_ops
from ..sources import tables as src
from .build import extract_star
from .oracle_star import case_band

# (tree, place, feature or "" for a leaf, cut, share): two levels; children of p are 2p and 2p + 1
SMALL_FOREST = [
    (0, 1, "claim_count", 6.0, 0.1), (0, 2, "admissions", 1.0, 0.05), (0, 3, "raf_like_score", 1.0, 0.4),
    (0, 4, "", 0.0, 0.01), (0, 5, "", 0.0, 0.13), (0, 6, "", 0.0, 0.37), (0, 7, "", 0.0, 0.82),
    (1, 1, "ed_visits", 1.0, 0.1), (1, 2, "", 0.0, 0.08), (1, 3, "hcc_count", 3.0, 0.3), (1, 6, "", 0.0, 0.22), (1, 7, "", 0.0, 0.93),
    (2, 1, "readmission_count", 1.0, 0.2), (2, 2, "dual_eligible_flag", 1.0, 0.15), (2, 3, "", 0.0, 0.71), (2, 4, "", 0.0, 0.11),
    (2, 5, "", 0.0, 0.33),
]
# tree, node, feature or -1, cut, left, right, path; a row goes left where its feature is at most the cut
SMALL_ISOLATION = [
    (0, 0, 0, 90000.0, 1, 2, 0.0), (0, 1, -1, 0.0, -1, -1, 7.5), (0, 2, 5, 60.0, 3, 4, 0.0), (0, 3, -1, 0.0, -1, -1, 2.0),
    (0, 4, -1, 0.0, -1, -1, 4.25), (1, 0, 4, 0.05, 1, 2, 0.0), (1, 1, -1, 0.0, -1, -1, 6.0), (1, 2, 2, 20.0, 3, 4, 0.0),
    (1, 3, -1, 0.0, -1, -1, 3.5), (1, 4, -1, 0.0, -1, -1, 1.0),
]
SAMPLE = 256


def fixed_forest_scores(s) -> DataFrame:
    """Members of the last plan year scored and tiered by the small forest."""
    nodes = [(t, p, HIGH_COST_FEATURES.index(f) if f else -1, cut, share) for t, p, f, cut, share in SMALL_FOREST]
    risk = scoring.numeric(star_ops.risk_of_year(s).select("member_key", *HIGH_COST_FEATURES), HIGH_COST_FEATURES)
    scored = risk.withColumn("score", forest.score_column(forest.forest_of(nodes, 3, 2), HIGH_COST_FEATURES))
    return scored.select("member_key", "score", band(F.col("score"), *HIGH_COST_MODEL_TIERS).alias("tier"))


def tree_sql(tree: int, place: int = 1) -> str:
    """A tree as nested CASE expressions."""
    feature, cut, share = next(n[2:] for n in SMALL_FOREST if n[:2] == (tree, place))
    if not feature:
        return f"{share}::DOUBLE"
    return f"CASE WHEN {feature} >= {cut} THEN {tree_sql(tree, 2 * place + 1)} ELSE {tree_sql(tree, 2 * place)} END"


def fixed_isolation_scores(s) -> DataFrame:
    features = [f"x{i}" for i in range(len(ANOMALY_FEATURES))]
    points = scoring.provider_features(s).select("provider_key", *[
        F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(x) for f, x in zip(ANOMALY_FEATURES, features)])
    nodes = pd.DataFrame(SMALL_ISOLATION, columns=[c.split()[0] for c in scoring.NODE_SCHEMA.split(", ")])
    raw = F.round(scoring.isolation_scorer(nodes, SAMPLE)(*features), 9)
    scored = points.select("provider_key", raw.alias("raw_score"))
    return scored.select("provider_key", "raw_score", band(F.col("raw_score"), *ANOMALY_TIERS).alias("tier"))


def isolation_sql(tree: int, node: int = 0) -> str:
    feature, cut, left, right, path = next(n[2:] for n in SMALL_ISOLATION if n[:2] == (tree, node))
    if feature < 0:
        return f"{path}::DOUBLE"
    return f"CASE WHEN {ANOMALY_FEATURES[feature]} <= {cut} THEN {isolation_sql(tree, left)} ELSE {isolation_sql(tree, right)} END"


def one_class_scores(s) -> DataFrame:
    """A target with one class: every row scores its mean."""
    risk = star_ops.risk_of_year(s).withColumn("target", F.lit(1))
    return scoring.fit_and_score(risk, "member_key", HIGH_COST_FEATURES, "target", "score", "one_class").scores.select("member_key", "score")


def coerced_features(spark: SparkSession, folder: str) -> DataFrame:
    """Texts of a claims file as model inputs: bad and missing cells are zero."""
    names = ["allowed_amount", "paid_amount", "ed_flag", "inpatient_flag"]
    return scoring.numeric(extract_star(spark, folder)["_cells"].select("claim_id", *names), names)


COUNTED = ["rows", "positive_rate", "status", "score_name"]


def counted_metrics(s) -> DataFrame:
    """The metrics that follow from counts alone; rates at six places."""
    found = scoring.model_metrics(s["_models"]).where(F.col("metric").isin(COUNTED))
    rate = F.round(F.col("value").try_cast("double"), 6).cast("string")
    return found.withColumn("value", F.when(F.col("metric") == "positive_rate", rate).otherwise(F.col("value")))


def lineage_hashes(spark: SparkSession, folder: str) -> DataFrame:
    return coding.with_lineage(src.table(spark, folder, "lineitem")).drop("ingested_at")


EXPECTED = float(scoring.average_path(SAMPLE))
TARGET_SQL = """(round(paid_12m::DOUBLE, 6) >= (SELECT round(quantile_cont(paid_12m::DOUBLE, 0.9), 6) FROM risk_of_year))::INT"""
LINEITEM = ("l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus "
            "l_shipdate").split()
FOREST_SQL = f"""
  SELECT member_key, score, {case_band('score', *HIGH_COST_MODEL_TIERS)} AS tier
  FROM (SELECT member_key, round(({' + '.join(tree_sql(t) for t in range(3))}) / 3, 6) AS score FROM risk_of_year)"""
ISOLATION_SQL = f"""
  SELECT provider_key, raw_score, {case_band('raw_score', *ANOMALY_TIERS)} AS tier
  FROM (SELECT provider_key, round(pow(2.0::DOUBLE, -(({' + '.join(isolation_sql(t) for t in range(2))}) / 2) / {EXPECTED!r}::DOUBLE), 9)
      AS raw_score
    FROM (SELECT *, denied_claims::DOUBLE / greatest(claims, 1)::DOUBLE AS denial_rate FROM provider_base))"""
METRICS_SQL = f"""
  SELECT 'high_cost_member_model' AS model, unnest(['status', 'rows', 'positive_rate', 'score_name']) AS metric,
    unnest(['trained_random_forest', count(*)::VARCHAR, round(avg({TARGET_SQL}), 6)::VARCHAR, 'predicted_high_cost_probability']) AS value
  FROM risk_of_year
  UNION ALL SELECT 'readmission_model', unnest(['status', 'rows', 'positive_rate', 'score_name']),
    unnest(['trained_random_forest', count(*)::VARCHAR, round(avg(readmission_within_30_days), 6)::VARCHAR, 'predicted_readmission_probability'])
  FROM fact_inpatient_episode
  UNION ALL SELECT 'provider_anomaly_model', unnest(['status', 'rows']), unnest(['trained_isolation_forest', count(*)::VARCHAR])
  FROM provider_base"""
FEATURES_SQL = "SELECT claim_id, " + ", ".join(
    f"coalesce(try_cast({c} AS DOUBLE), 0.0::DOUBLE) AS {c}" for c in ("allowed_amount", "paid_amount", "ed_flag", "inpatient_flag")
) + " FROM canonical"
LINEAGE_SQL = f"""
  SELECT *, 'lineitem.parquet' AS source_file, sha256(array_to_string(list_transform([{', '.join(c + '::VARCHAR' for c in LINEITEM)}],
    lambda v: ifnull(length(v) || ':' || v, '-')), '|')) AS record_hash FROM lineitem"""
# what the models add to the quality report
MODEL_CHECKS_SQL = """
  SELECT 'high_cost_model_ready' AS check_name, 'PASS' AS status, count(*)::VARCHAR AS value, '> 0 rows' AS threshold FROM risk_of_year
  UNION ALL SELECT 'readmission_model_ready', 'PASS', 'trained_random_forest', 'present'
  UNION ALL SELECT 'provider_anomaly_model_ready', 'PASS', count(*)::VARCHAR, '> 0 rows' FROM provider_base"""
