from decimal import Decimal

from helpers import claim, make_star, member, provider

from payerscope.operators import care
from payerscope.operators import star as ops


def stay(key, start, end, who=1, where=1, **kw):
    return claim(key, member=who, provider=where, service=6, start=start, end=end, inpatient=1, **kw)


def test_readmission_gaps(spark):
    # gaps after each stay: 0, 30, 31, overlap (-2), 1, and the last one has none
    stays = [
        stay(1, 20250101, 20250104), stay(2, 20250104, 20250106), stay(3, 20250205, 20250207),
        stay(4, 20250310, 20250314), stay(5, 20250312, 20250316), stay(6, 20250317, 20250318),
    ]
    star = make_star(spark, stays, [member(1)], [provider(1)])
    got = [(r["claim_key"], r["days_to_readmission"], r["readmission_within_30_days"])
           for r in star["fact_inpatient_episode"].orderBy("episode_key").collect()]
    assert got == [(1, 0, 1), (2, 30, 1), (3, 31, 0), (4, 0, 0), (5, 1, 1), (6, 9999, 0)]


def test_stays_of_one_day_follow_each_other_by_claim_key(spark):
    stays = [stay(1, 20250101, 20250101), stay(2, 20250101, 20250103), stay(3, 20250101, 20250101), stay(4, 20250120, 20250121)]
    star = make_star(spark, stays, [member(1)], [provider(1)])
    got = [(r["claim_key"], r["days_to_readmission"], r["readmission_within_30_days"])
           for r in star["fact_inpatient_episode"].orderBy("episode_key").collect()]
    assert got == [(1, 0, 1), (2, 0, 0), (3, 19, 1), (4, 9999, 0)]


def test_a_stay_without_a_member_is_kept_and_has_no_next_admission(spark):
    star = make_star(spark, [stay(1, 20250101, 20250102, who=None), stay(2, 20250105, 20250106, who=None)], [member(1)], [provider(1)])
    rows = star["fact_inpatient_episode"].collect()
    assert [(r["days_to_readmission"], r["readmission_within_30_days"]) for r in rows] == [(9999, 0)] * 2


def test_episode_keys_follow_member_and_admission(spark):
    stays = [stay(1, 20250301, 20250302, who=2), stay(2, 20250101, 20250102, who=2), stay(3, 20250601, 20250602, who=1)]
    star = make_star(spark, stays, [member(1), member(2)], [provider(1)])
    rows = star["fact_inpatient_episode"].orderBy("episode_key").collect()
    assert [(r["episode_key"], r["claim_key"]) for r in rows] == [(1, 3), (2, 2), (3, 1)]


def test_member_months_leave_out_claims_after_eligibility_or_of_other_years(spark):
    claims = [claim(1, start=20250115, paid="10"), claim(2, start=20250120, paid="5"), claim(3, start=20250401, paid="99"),
              claim(4, start=20240110, paid="77")]
    star = make_star(spark, claims, [member(1, months=3), member(2, months=0)], [provider(1)])
    got = {r["month_key"]: r["paid_amount"] for r in star["fact_member_month"].collect()}
    assert got == {202501: Decimal("15.00"), 202502: Decimal("0.00"), 202503: Decimal("0.00")}


def test_override_takes_the_source_flag_and_caps_the_days(spark):
    stays = [stay(1, 20250101, 20250102), stay(2, 20250401, 20250402), stay(3, 20250410, 20250411)]
    star = make_star(spark, stays, [member(1)], [provider(1)])
    source = spark.createDataFrame([(1, 1), (2, 0)], "claim_key bigint, readmission_flag int")
    rows = ops.override_readmissions(star["fact_inpatient_episode"], source).orderBy("claim_key").collect()
    assert [(r["readmission_within_30_days"], r["days_to_readmission"]) for r in rows] == [(1, 30), (0, 8), (0, 9999)]


def test_member_risk_keeps_members_without_claims(spark):
    star = make_star(spark, [claim(1)], [member(1), member(2, chronic=3, hcc=1)], [provider(1)])
    rows = {r["member_key"]: r for r in star["fact_member_risk"].collect()}
    assert rows[2]["claim_count"] == 0 and rows[2]["paid_12m"] == 0
    assert rows[2]["suspected_hcc_gap_count"] in (2, 3)
    assert rows[2]["risk_adjustment_action"].startswith("Chart review")


def test_unmatched_claims_stay_in_the_enriched_view(spark):
    star = make_star(spark, [claim(1, member=9, provider=9)], [member(1)], [provider(1)])
    row = ops.enrich_claims(star).first()
    assert row["claim_key"] == 1 and row["member_id"] is None and row["state_code_provider"] is None


def test_same_day_transfer_is_not_a_readmission(spark):
    stays = [stay(1, 20250101, 20250104, where=1), stay(2, 20250104, 20250106, where=2), stay(3, 20250106, 20250108, where=2),
             stay(4, 20250207, 20250208, where=1)]
    star = make_star(spark, stays, [member(1)], [provider(1), provider(2)])
    rows = care.readmission_30day(star).orderBy("index_claim_key").collect()
    assert [(r["days_to_readmission"], r["readmission_30day_flag"], r["same_day_transfer_flag"], r["length_of_stay"])
            for r in rows] == [(0, 0, 1, 4), (0, 0, 0, 3), (30, 1, 0, 3), (None, 0, 0, 2)]


def test_features_end_before_the_admission(spark):
    rows = [
        stay(1, 20250101, 20250103), claim(2, start=20250301, ed=1, paid="40"), stay(3, 20250401, 20250402, paid="500"),
        claim(4, start=20250401, ed=1, paid="70"), stay(5, 20251201, 20251202),
    ]
    star = make_star(spark, rows, [member(1)], [provider(1)])
    got = {r["episode_key"]: r for r in care.episode_features(star).collect()}
    assert (got[2]["prior_6m_admissions"], got[2]["prior_6m_ed_visits"], got[2]["prior_12m_paid"]) == (1, 1, 140.0)
    assert (got[3]["prior_6m_admissions"], got[3]["prior_6m_ed_visits"], got[3]["prior_12m_paid"]) == (0, 0, 710.0)
    assert got[1]["prior_12m_paid"] == 0.0 and got[2]["provider_past_readmission_rate"] == 0.0


def test_hot_member_with_a_third_of_the_stays(spark):
    import pandas as pd

    rows, key = [], 0
    for i in range(900):
        key += 1
        who = 1 if i % 3 == 0 else 2 + i % 50
        day = 1 + (i * 7) % 28
        start = 20250000 + (1 + (i * 5) % 12) * 100 + day
        rows.append(stay(key, start, start, who=who))
    star = make_star(spark, rows, [member(k) for k in range(1, 53)], [provider(1)])
    got = star["fact_inpatient_episode"].select("claim_key", "days_to_readmission").toPandas().set_index("claim_key")
    frame = pd.DataFrame([(r[0], r[2], pd.Timestamp(str(r[6]))) for r in rows], columns=["claim_key", "m", "d"])
    frame = frame.sort_values(["m", "d", "claim_key"])
    gap = (frame.groupby("m")["d"].shift(-1) - frame["d"]).dt.days.fillna(9999).astype(int)
    want = pd.Series(gap.to_numpy(), index=frame["claim_key"])
    assert (got["days_to_readmission"].sort_index() == want.sort_index()).all()


def test_no_window_in_the_episode_plan_runs_over_claims(spark):
    star = make_star(spark, [stay(1, 20250101, 20250102)], [member(1)], [provider(1)])
    plan = ops.inpatient_gaps(star["fact_claim"])._jdf.queryExecution().optimizedPlan().toString()
    window_at = plan.index("Window [lead(")
    assert "Aggregate [member_key" in plan[window_at:window_at + 400]


def test_years_come_from_the_claims_and_risk_has_a_row_for_each(spark):
    from payerscope.operators import star as ops

    star = make_star(spark, [claim(1, start=20230510), claim(2, start=20250105, paid="40")], [member(1)], [provider(1)], (2023, 2024, 2025))
    assert ops.claim_years(star["fact_claim"]) == [2023, 2024, 2025]
    assert ops.claim_years(star["fact_claim"].limit(0)) == []
    paid = {r["plan_year"]: float(r["paid_12m"]) for r in star["fact_member_risk"].collect()}
    assert paid == {2023: 100.0, 2024: 0.0, 2025: 40.0}
    assert [r["plan_year"] for r in ops.risk_of_year(star).collect()] == [2025]


def test_groups_without_a_name_stay(spark):
    from payerscope.operators import cost, review

    claims = [claim(1), claim(2, provider=2, service=None), claim(3, provider=3)]
    star = make_star(spark, claims, [member(1)], [provider(1), provider(2, specialty=None), provider(3)])
    assert {r["provider_key"] for r in review.fwa_provider_flags(star).collect()} == {1, 2, 3}
    assert {r["provider_key"] for r in review.provider_peer_rank(star).collect()} == {1, 2, 3}
    assert None in {r["claim_type"] for r in cost.profile_claims(star).collect()}


def test_a_stray_date_adds_no_years(spark):
    claims = [claim(1, start=20230510), claim(2, start=20250105, paid="40"), claim(3, start=99990101, paid="7"), claim(4, start=19000101)]
    star = make_star(spark, claims, [member(1), member(2)], [provider(1)], (2023, 2024, 2025))
    assert ops.claim_years(star["fact_claim"]) == [2023, 2024, 2025]
    assert ops.claims_outside(star["fact_claim"], [2023, 2024, 2025]).first()["v"] == 2
    features = care.member_month_features(star).orderBy("cutoff_date").collect()
    assert len(features) == 4 and [f["prior_paid"] for f in features] == [0.0] * 4
    assert str(features[-1]["cutoff_date"]) == "9999-01-01" and str(features[-1]["latest_source_date"]) == "2025-01-05"


def test_high_cost_mart_reads_the_plan_year(spark):
    from payerscope.operators import marts

    claims = [claim(1, start=20240510, paid="900"), claim(2, start=20250105, paid="40"), claim(3, start=20240105, paid="70", member=2)]
    star = make_star(spark, claims, [member(1), member(2)], [provider(1)], (2024, 2025))
    rows = marts.high_cost_member(star).collect()
    assert [(r["member_key"], r["paid_12m"], r["claim_count"]) for r in rows] == [(1, 40.0, 1)]
    star[ops.ONE_PLAN] = True
    assert sum(r["paid_12m"] for r in marts.high_cost_member(star).collect()) == 1010.0


def test_prior_windows_at_any_cutoff_equal_a_range_join(spark):
    import datetime as dt
    import random

    pick = random.Random(2)
    day = lambda n: int((dt.date(2024, 1, 1) + dt.timedelta(n)).strftime("%Y%m%d"))
    rows = [claim(i, member=pick.randint(1, 4), provider=pick.randint(1, 5), start=day(pick.randint(0, 500)), paid=str(pick.randint(1, 99)), ed=i % 2)
            for i in range(1, 200)]
    star = make_star(spark, rows, [member(i) for i in range(1, 5)], [provider(i) for i in range(1, 6)])
    asked = [(m, dt.date(2024, 1, 1) + dt.timedelta(n)) for m in range(1, 7) for n in range(-30, 900, 37)]
    cutoffs = spark.createDataFrame(asked, "member_key bigint, cutoff_date date")
    for first, last in ((-365, -1), (0, 364), (-30, -10)):
        got = {(r["member_key"], r["cutoff_date"]): r for r in care.window_sums(star, cutoffs, first, last).collect()}
        assert len(got) == len(asked)
        for who, at in asked:
            inside = [r for r in rows if r[2] == who and first <= (dt.datetime.strptime(str(r[6]), "%Y%m%d").date() - at).days <= last]
            found = got[who, at]
            assert (found["paid"], found["ed_visits"], found["unique_providers"]) == (
                sum(r[10] for r in inside), sum(r[14] for r in inside), len({r[3] for r in inside}))


def test_a_planted_leak_shows_as_a_late_source_date(spark):
    from payerscope.operators import quality

    star = make_star(spark, [claim(1, start=20250110), claim(2, start=20250203)], [member(1)], [provider(1)])
    from pyspark.sql import functions as F

    cutoffs = care.claim_months(star)
    right, leaky = care.window_sums(star, cutoffs, -365, -1), care.window_sums(star, cutoffs, -365, 5)
    late = lambda rows: quality.late_sources({"x": (rows, F.col("cutoff_date"))}).first()["v"]
    assert late(right) == 0 and late(leaky) == 1


def test_windows_of_one_call_equal_those_of_their_own_and_share_one_move(spark):
    rows = [claim(i, member=1 + i % 3, provider=1 + i % 4, start=20240101 + i % 12 * 100 + i % 25, ed=i % 2) for i in range(1, 80)]
    star = make_star(spark, rows, [member(i) for i in range(1, 4)], [provider(i) for i in range(1, 5)], (2024,))
    cutoffs = care.claim_months(star)
    names = ["paid", "ed_visits", "unique_providers"]
    both = care.sums_of_windows(star, cutoffs.unionByName(cutoffs), {"a_": (-90, -1, names), "b_": (0, 89, ["paid"])})
    moves = both._jdf.queryExecution().analyzed().toString().count("RepartitionByExpression")
    assert moves == 1
    key = ["member_key", "cutoff_date"]
    own = {}
    for prefix, first, last, wanted in (("a_", -90, -1, names), ("b_", 0, 89, ["paid"])):
        shown = [*wanted, "latest_source_date"]
        own[prefix] = {tuple(r[k] for k in key): tuple(r[c] for c in shown) for r in care.window_sums(star, cutoffs, first, last, wanted).collect()}
        assert {tuple(r[k] for k in key): tuple(r[prefix + c] for c in shown) for r in both.collect()} == own[prefix]
    assert both.count() == len(own["a_"]) == cutoffs.count() == 12


def test_months_by_rule_and_crowded_members_give_the_sums_of_asked_months(spark, monkeypatch):
    rows = [claim(i, member=1 + i % 3, provider=1 + i % 4, start=20240101 + i % 12 * 100 + i % 25, ed=i % 2, inpatient=i % 3 % 2) for i in range(1, 80)]
    rows += [claim(90, member=None), (*claim(91, member=7)[:6], None, None, None, *claim(91)[9:])]  # no member, no date
    star = make_star(spark, rows, [member(i) for i in range(1, 4)], [provider(i) for i in range(1, 5)], (2024,))
    windows = {"a_": (-90, -1, list(care.WINDOW_MEASURES)), "b_": (0, 89, ["paid", "readmissions"])}
    shown = lambda cutoffs: sorted(map(tuple, care.sums_of_windows(star, cutoffs, windows).collect()))
    asked = shown(care.claim_months(star))
    assert asked and not care.crowded(star) and shown(care.month_start) == asked
    monkeypatch.setattr(care, "CROWDED", 3)
    assert care.crowded(star) and shown(care.month_start) == asked and shown(care.claim_months(star)) == asked
