import datetime as dt
from decimal import Decimal

import pytest

from payerscope.operators import marts, quality, scoring
from payerscope.plans.build import from_claims_file, load_claims_csv
from payerscope.sources import claims_file as C

COLUMNS = (
    "claim_id member_id provider_id provider_name specialty_group claim_type service_line diagnosis_group allowed_amount "
    "paid_amount member_responsibility_amount claim_from_date claim_thru_date inpatient_flag ed_flag readmission_flag "
    "state_code plan_type chronic_condition_count raf_like_score"
).split()
STAY = "Inpatient,Inpatient stay,CHF,9400,8800,310,2025-04-11,2025-04-18,1,0,1"
VISIT = "Professional,Office visit,Diabetes,130,95.5,15,2025-05-02,2025-05-02,0,0,0"
EMERGENCY = "Outpatient,Emergency department,COPD,720,640,60,2025-06-19,2025-06-19,0,1,0"
SCAN = "Outpatient,Imaging,Musculoskeletal,410,333,44,2025-07-07,2025-07-07,0,0,0"
FOUR_ROWS = "\n".join([
    ",".join(COLUMNS),
    f"A-1,north,H7,River Clinic,Facility,{STAY},WA,MA-PD,3,1.4",
    f"A-2,north,D2,Hill Doctors,Primary care,{VISIT},WA,MA-PD,3,1.4",
    f"A-3,south,E9,Lake Emergency,Emergency medicine,{EMERGENCY},OR,Employer Group Waiver,2,1.2",
    f"A-4,west,R4,Bay Radiology,Radiology,{SCAN},ID,Employer Group Waiver,1,0.6",
]) + "\n"


@pytest.fixture()
def four(spark, tmp_path):
    path = tmp_path / "claims.csv"
    path.write_text(FOUR_ROWS)
    return load_claims_csv(spark, str(path), 2025)


def test_four_row_file_passes_every_check(four):
    assert four["fact_claim"].count() == 4 and four["dim_member"].count() == 3
    built = {name: four[name] for name in marts.MARTS}
    models = scoring.model_metrics(scoring.all_models(four))
    report = quality.quality_report({**four.complete(), **built}, models).collect()
    assert len(report) == 21 and [r for r in report if r["status"] == "FAIL"] == []


def test_four_row_file_values(four):
    claims = {r["claim_id"]: r for r in four["fact_claim"].collect()}
    assert (claims["A-1"]["claim_key"], claims["A-1"]["length_of_stay"], claims["A-1"]["prior_auth_flag"]) == (1, 7, 1)
    assert claims["A-3"]["avoidable_ed_flag"] == 1 and claims["A-2"]["paid_amount"] == Decimal("95.50")
    episode = four["fact_inpatient_episode"].first()
    assert (episode["readmission_within_30_days"], episode["days_to_readmission"]) == (1, 30)
    members = {r["member_id"]: r for r in four["dim_member"].collect()}
    assert (members["north"]["age"], members["north"]["age_band"], members["north"]["hcc_count"]) == (79, "75-84", 3)
    assert members["west"]["risk_segment"] == "Low" and members["north"]["member_key"] == 1
    services = four["dim_service"].orderBy("service_key").collect()
    assert [r["service_line"] for r in services] == ["Inpatient stay", "Office visit", "Emergency department", "Imaging"]


def test_headers_are_trimmed_lowered_and_the_first_alias_wins():
    found = C.resolve_headers([" Bene ID ", "Patient ID", "NPI", "Service Date", "PAID", "paid ", "Colour"])
    assert found == {"member_id": " Bene ID ", "provider_id": "NPI", "claim_from_date": "Service Date", "paid_amount": "paid "}


def test_missing_columns_take_defaults_and_ids_follow_the_row_number(spark, tmp_path):
    path = tmp_path / "few.csv"
    path.write_text("Paid,Service Date\n" + "".join(f"{i},2025-0{i}-03\n" for i in range(1, 8)))
    star = load_claims_csv(spark, str(path), 2025)
    rows = star["_rows"].orderBy("claim_key").collect()
    assert [r["claim_id"] for r in rows][:2] == ["CUSTOM000001", "CUSTOM000002"]
    assert [r["member_id"] for r in rows] == ["MEM00001", "MEM00002"] * 3 + ["MEM00001"]
    assert {r["provider_id"] for r in rows} == {"PRV00001"}
    assert [float(r["paid_amount"]) for r in rows] == [1, 2, 3, 4, 5, 6, 7]
    assert rows[0]["allowed_amount"] == Decimal("250.00") and rows[0]["raf_like_score"] == 0.85
    assert rows[3]["claim_thru_date"] == dt.date(2025, 4, 3) and rows[0]["state_code"] == "US"


def test_without_a_flag_column_computed_readmissions_stay(spark):
    rows = [("C1", "M1", "2025-01-01", "2025-01-03", "1"), ("C2", "M1", "2025-01-10", "2025-01-12", "1")]
    raw = spark.createDataFrame(rows, "claim_id string, member_id string, from_date string, thru_date string, is_inpatient string")
    star = from_claims_file(raw, 2025, ["claim_id"])
    got = [r["readmission_within_30_days"] for r in star["fact_inpatient_episode"].orderBy("episode_key").collect()]
    assert got == [1, 0]


def test_bad_cells(spark):
    rows = [("C1", None, "x", "n/a", "bad", "2024-01-01"), ("C2", "M2", None, "-4", "2025-06-05", "2025-06-01")]
    raw = spark.createDataFrame(rows, "claim_id string, member_id string, state string, paid string, from_date string, thru_date string")
    star = from_claims_file(raw, 2025, ["claim_id"])
    got = {r["claim_id"]: r for r in star["_rows"].collect()}
    assert got["C1"]["claim_from_date"] == dt.date(2025, 1, 1) == got["C1"]["claim_thru_date"]
    assert got["C2"]["claim_thru_date"] == dt.date(2025, 6, 5)
    assert got["C1"]["paid_amount"] == Decimal("180.00") and got["C2"]["paid_amount"] == Decimal("0.00")
    assert got["C2"]["state_code"] is None  # an empty text cell is not filled
    assert star["dim_member"].count() == 1
    claims = {r["claim_id"]: r for r in star["fact_claim"].collect()}
    assert claims["C1"]["member_key"] is None and claims["C2"]["denied_flag"] == 1


def test_no_rows_is_an_error(spark, tmp_path):
    path = tmp_path / "none.csv"
    path.write_text("claim_id,paid\n")
    with pytest.raises(ValueError):
        load_claims_csv(spark, str(path), 2025)["fact_claim"]


def test_first_value_that_is_present_names_the_provider(spark):
    rows = [("C1", "P1", None, "2025-01-01"), ("C2", "P1", "Second", "2025-01-01"), ("C3", "P1", "Third", "2025-01-01")]
    raw = spark.createDataFrame(rows, "claim_id string, npi string, facility string, service_date string")
    assert from_claims_file(raw, 2025, ["claim_id"])["dim_provider"].first()["provider_name"] == "Second"


def test_cells_as_people_write_them(spark, tmp_path):
    path = tmp_path / "people.csv"
    path.write_text(
        'claim_id,member_id,plan_type,service_date,is_inpatient,facility,paid\n'
        'a,m,N/A,1/5/2025,True,"two\nlines",12\n' "b,m,NULL,01-06-2025,false,x,13\n" "c,m,HMO,2025-02-05T00:00:00,TRUE,x,NA\n" "d,m,HMO,2025-02-06T10:00:00Z,0,x,15\n"
    )
    rows = {r["claim_id"]: r for r in load_claims_csv(spark, str(path), 2025)["_rows"].collect()}
    assert [rows[c]["claim_from_date"] for c in "abcd"] == [dt.date(2025, 1, 5), dt.date(2025, 1, 6), dt.date(2025, 2, 5), dt.date(2025, 2, 6)]
    assert [rows[c]["inpatient_flag"] for c in "abcd"] == [1, 0, 1, 0]
    assert [rows[c]["plan_type"] for c in "abcd"] == [None, None, "HMO", "HMO"]
    assert len(rows) == 4 and rows["c"]["paid_amount"] == Decimal("180.00")


def test_a_claims_file_is_one_plan_year_whatever_its_dates(spark):
    rows = [("C1", "M1", "2023-03-01", "100"), ("C2", "M1", "2025-04-01", "200"), ("C3", "M2", "9999-01-01", "7")]
    raw = spark.createDataFrame(rows, "claim_id string, member_id string, from_date string, paid string")
    star = from_claims_file(raw, 2025, ["claim_id"])
    risk = {r["member_key"]: (r["plan_year"], float(r["paid_12m"]), r["claim_count"]) for r in star["fact_member_risk"].collect()}
    assert risk == {1: (2025, 300.0, 2), 2: (2025, 7.0, 1)}
    mart = {r["member_id"]: r["paid_12m"] for r in star["mart_high_cost_member"].collect()}
    assert mart == {"M1": 300.0, "M2": 7.0}


def test_every_defaulted_cell_is_counted(spark):
    rows = [("1", "Infinity", "13/02/2025", "true"), ("2", "-4", "02/13/2025", "maybe"), ("3", "N/A", "14/02/2025", None)]
    data = spark.createDataFrame(rows, "claim_id string, paid_amount string, claim_from_date string, ed_flag string")
    forms = C.date_forms(data)
    assert forms == {"claim_from_date": True}
    found = {r["column_name"]: tuple(r)[1:] for r in C.defaulted_cells(data, forms).collect()}
    assert found["paid_amount"] == (3, 1, 1, 1, 2) and found["claim_from_date"] == (3, 0, 1, 0, 1)
    assert found["ed_flag"] == (3, 1, 1, 0, 2) and found["allowed_amount"] == (0, 0, 0, 0, 3)
    typed = C.coerce(data, 2025, forms).orderBy("claim_id").collect()
    assert [str(r["claim_from_date"]) for r in typed] == ["2025-02-13", "2025-01-01", "2025-02-14"]
    assert [float(r["paid_amount"]) for r in typed] == [180.0, 0.0, 180.0]
