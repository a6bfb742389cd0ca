import pandas as pd
import pytest
from helpers import claim, make_star, member, provider
from pyspark.sql import functions as F

from payerscope.operators import kpis, marts, quality, review, sqlpack


@pytest.fixture(scope="module")
def star(spark):
    claims, key = [], 0
    for i in range(300):
        key += 1
        kind = i % 10 + 1
        claims.append(claim(
            key, member=1 if i % 3 == 0 else 2 + i % 20, provider=1 + i % 7, service=kind, diagnosis=1 + i % 9,
            start=20250101 + (i % 12) * 100 + i % 27, paid=f"{(i * 37) % 211}.{i % 90 + 10}",
            inpatient=int(kind in (6, 7)), los=3 if kind in (6, 7) else 0, ed=int(kind == 3), avoidable=int(i % 20 == 2),
        ))
    members = [member(k, raf=round(0.4 + 0.1 * (k % 9), 3), chronic=k % 5, hcc=k % 4) for k in range(1, 24)]
    providers = [provider(k, "Alone" if k == 7 else f"S{k % 2}", 60.0 + k, 0.8 + k / 10) for k in range(1, 8)]
    return make_star(spark, claims, members, providers)


def test_high_cost_scores_match_pandas(star):
    mart = marts.high_cost_member(star).toPandas().set_index("member_key").sort_index()
    risk = star["fact_member_risk"].toPandas().set_index("member_key").loc[mart.index]
    rank = lambda s: s.rank(pct=True)
    want = (0.40 * rank(mart["paid_12m"]) + 0.20 * rank(mart["raf_like_score"]) + 0.15 * rank(mart["admissions"])
            + 0.15 * rank(mart["ed_visits"]) + 0.10 * rank(risk["suspected_hcc_gap_count"]))
    assert (mart["risk_priority_score"] - want).abs().max() < 1e-6
    assert 23 not in mart.index  # no claim, no row


def test_peer_percentiles_stay_inside_the_specialty(star):
    mart = marts.provider_performance(star).toPandas().set_index("provider_key")
    want = mart.groupby("specialty_group")["payment_per_member"].rank(pct=True)
    assert (mart["peer_cost_percentile"] - want).abs().max() < 1e-12
    assert mart.loc[7, "peer_cost_percentile"] == 1.0


def test_top_claim_breaks_ties_by_key(spark):
    claims = [claim(2, paid="50", service=2), claim(1, paid="50", service=1), claim(3, paid="9", service=3)]
    star = make_star(spark, claims, [member(1)], [provider(1)])
    assert marts.top_claim_labels(star).first()["service_line"] == "Office visit"


def test_repeated_claims_are_counted_and_reach_the_investigators(spark):
    claims, key = [], 0
    for copies, paid in ((1, "10"), (2, "20"), (4, "900"), (5, "1000")):
        for _ in range(copies):
            key += 1
            claims.append(claim(key, member=copies, paid=paid, prior_auth=1, inpatient=0))
    claims.append(claim(99, member=7, provider=2, paid="0", denied=1))
    star = make_star(spark, claims, [member(k) for k in range(1, 8)], [provider(1), provider(2)])
    scored = {r["claim_key"]: r for r in marts.fwa_scored(star).collect()}
    assert [scored[k]["similar_claim_count"] for k in (1, 2, 4, 8)] == [1, 2, 4, 5]
    assert scored[12]["recommended_action"] == "SIU/payment integrity review" and scored[12]["fwa_score"] >= 0.82
    assert scored[1]["recommended_action"] == "Analyst validation"
    assert scored[99]["review_reason"] == "Denied or adjusted claim"
    assert scored[2]["review_reason"] == "Duplicate-like same-day pattern"
    queue = marts.fwa_queue(star).toPandas()
    scores = pd.Series([r["fwa_score"] for r in scored.values()])
    assert len(queue) == (scores >= round(scores.quantile(0.82), 6)).sum()


def test_all_marts_keep_their_schema_without_inpatient_claims(spark):
    star = make_star(spark, [claim(1), claim(2, member=2)], [member(1), member(2)], [provider(1)])
    built = marts.build_marts(star)
    assert built["mart_readmission_queue"].count() == 0
    assert "readmission_priority_score" in built["mart_readmission_queue"].columns
    performance = built["mart_provider_performance"].first()
    assert performance["readmissions"] == 0 and performance["episodes"] == 0
    report = {r["check_name"]: r for r in quality.quality_report({**star, **built}).collect()}
    assert report["readmission_days_non_negative"]["status"] == "PASS"
    assert report["mart_readmission_queue_not_empty"]["status"] == "FAIL"


def test_quality_counts_orphans_and_reversed_dates(spark):
    claims = [claim(1), claim(1, member=9, start=20250110, end=20250101), claim(3, provider=5)]
    star = make_star(spark, claims, [member(1)], [provider(1)])
    report = {r["check_name"]: (r["status"], r["value"]) for r in quality.base_checks(star).collect()}
    assert report["member_key_integrity"] == ("FAIL", "1")
    assert report["provider_key_integrity"] == ("FAIL", "1")
    assert report["claim_date_order"] == ("FAIL", "1")
    assert report["claim_id_unique"] == ("FAIL", "2")
    assert report["claim_rows_positive"] == ("PASS", "3")


def test_kpis_and_queues(star):
    tables = {**star, **marts.build_marts(star)}
    row = kpis.kpi_summary(tables, quality.quality_report(tables)).first()
    assert row["claims"] == 300 and row["members"] == 23 and row["quality_failures"] == 0
    months = star["fact_member_month"].toPandas()
    assert row["pmpm"] == pytest.approx(float(months["paid_amount"].sum()) / len(months))
    top = kpis.top_rows(tables, "high_cost").collect()
    assert [r["risk_priority_score"] for r in top] == sorted((r["risk_priority_score"] for r in top), reverse=True)
    results = sqlpack.run_pack(tables)
    assert set(results) == set(sqlpack.QUERY_PACK) and results["pmpm_market_trends"].count() <= 60


def test_claims_with_missing_keys_make_no_member_row_and_no_score(spark):
    claims = [claim(1, paid="10"), claim(2, member=None, paid="900"), claim(3, provider=None, paid="950")]
    star = make_star(spark, claims, [member(1)], [provider(1)])
    assert [r["member_key"] for r in marts.high_cost_member(star).collect()] == [1]
    assert {r["claim_key"]: r["fwa_score"] is None for r in marts.fwa_scored(star).collect()} == {1: False, 2: True, 3: True}
    assert [r["claim_id"] for r in marts.fwa_queue(star).collect()] == ["C1"]


def test_denial_rates_guard_empty_denominators(spark):
    rows = [("I", "TX", "P", 2025, 10, 0, 0, 0), ("I", "TX", "P", 2025, 10, 5, 2, 1)]
    schema = ("issuer string, state_code string, plan_type string, plan_year int, claims_received bigint, "
              "claims_denied bigint, appeals_filed bigint, appeals_upheld bigint")
    row = review.denial_benchmark(spark.createDataFrame(rows, schema)).first()
    assert (row["denial_rate"], row["appeal_rate"], row["upheld_rate"]) == (0.25, 0.4, 0.5)


def test_financials_count_a_member_once_over_services(spark):
    claims = [claim(1, service=1), claim(2, service=1), claim(3, service=1, member=2)]
    star = make_star(spark, claims, [member(1), member(2)], [provider(1)])
    row = marts.claims_financials(star).first()
    assert (row["claims"], row["members"], row["paid_amount"]) == (3, 2, 300.0)


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_financials_equal_a_plain_distinct_count_on_odd_dimensions(spark):
    """Keys that repeat with the same and with other labels, labels of two keys, no labels, no dimension row, null keys."""
    claims = [
        claim(i, member=[1, 2, 3, None][i % 4], service=[1, 2, 3, 4, 9, None][i % 6], start=20250105 + 100 * (i % 2), paid=str(i), denied=i % 2)
        for i in range(1, 61)
    ]
    star = make_star(spark, claims, [member(1), member(1), member(2, state="FL"), member(2), member(3)], [provider(1)])
    star["dim_service"] = spark.createDataFrame(
        [(1, "A", "x"), (1, "A", "x"), (1, "B", "y"), (2, "B", "y"), (3, None, None), (4, "A", None), (4, "A", "x"), (None, "A", "x")],
        "service_key bigint, claim_type string, service_line string",
    )
    label = star["dim_member"].selectExpr("member_key", "state_code AS state_code_member", "plan_type", "risk_segment")
    group = ["paid_month_key", "state_code_member", "plan_type", "claim_type", "service_line", "risk_segment"]
    plain = star["fact_claim"].join(label, "member_key", "left").join(star["dim_service"], "service_key", "left").groupBy(*group).agg(
        F.count("claim_key").alias("claims"), F.countDistinct("member_key").alias("members"),
        F.sum("paid_amount").cast("double").alias("paid_amount"), F.sum("denied_flag").alias("denied_claims"),
    )
    found = marts.claims_financials(star)
    assert sorted(map(str, found.select(*plain.columns).collect())) == sorted(map(str, plain.collect())) and plain.count() > 10
    assert "count(distinct" not in plan_of(found)


def test_provider_sums_are_formed_before_members_are_told_apart(spark):
    claims = [claim(i, member=[1, 2, None][i % 3], provider=[1, 2, 3, None][i % 4], paid=str(i), ed=i % 2) for i in range(1, 41)]
    star = make_star(spark, claims + [claim(99, member=None, provider=7)], [member(1), member(2)], [provider(i) for i in (1, 2, 3)])
    base = marts.provider_base(star)
    plain = star["fact_claim"].where("provider_key IS NOT NULL").groupBy("provider_key").agg(
        F.count("claim_key"), F.countDistinct("member_key"), F.sum("paid_amount"), F.sum("ed_flag"))
    held = base.select("provider_key", "claims", "members", "paid", "ed_claims")
    assert sorted(map(tuple, held.collect())) == sorted(map(tuple, plain.collect()))
    # what moves by provider and member holds the two keys and nothing else
    by_both = [line for line in plan_of(base).splitlines() if "Aggregate(keys=[provider_key" in line and "member_key" in line.split("functions=")[0]]
    assert by_both and all("functions=[]" in line for line in by_both)
