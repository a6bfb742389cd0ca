"""Names, codes, cut-offs and weights that results depend on."""

# --- Fixed values: service seed rows --------------------------------------
# claim_type, service_line, place_of_service, inpatient, ed, base allowed amount
SERVICES = [
    ("Professional", "Office visit", "Office", 0, 0, 210.0),
    ("Professional", "Specialist visit", "Office", 0, 0, 480.0),
    ("Outpatient", "Emergency department", "Emergency", 0, 1, 1450.0),
    ("Outpatient", "Imaging", "Outpatient", 0, 0, 820.0),
    ("Outpatient", "Outpatient surgery", "Outpatient", 0, 0, 5200.0),
    ("Inpatient", "Inpatient stay", "Facility", 1, 0, 18500.0),
    ("Inpatient", "SNF/post-acute", "Post acute", 1, 0, 9300.0),
    ("Pharmacy", "Part D drug", "Pharmacy", 0, 0, 165.0),
    ("Professional", "Behavioral health", "Office", 0, 0, 260.0),
    ("Outpatient", "Lab/pathology", "Outpatient", 0, 0, 130.0),
]

# --- Fixed values: diagnosis seed rows ------------------------------------
# diagnosis_code, diagnosis_group, hcc_category
DIAGNOSES = [
    ("E11", "Diabetes", "HCC18"),
    ("I50", "CHF", "HCC85"),
    ("J44", "COPD", "HCC111"),
    ("N18", "CKD", "HCC138"),
    ("F32", "Behavioral health", "HCC59"),
    ("C34", "Oncology", "HCC8"),
    ("M17", "Musculoskeletal", "HCC0"),
    ("I10", "Hypertension", "HCC0"),
    ("S72", "Fracture/trauma", "HCC170"),
    ("Z00", "Preventive/other", "HCC0"),
]

# --- Fixed values: specialties, (group, provider type) ---------------------
SPECIALTIES = [
    ("Primary care", "Professional"),
    ("Cardiology", "Professional"),
    ("Orthopedics", "Professional"),
    ("Emergency medicine", "Professional"),
    ("Radiology", "Professional"),
    ("Oncology", "Professional"),
    ("Behavioral health", "Professional"),
    ("Facility", "Facility"),
    ("Pharmacy", "Pharmacy"),
]
# Labels of our own for the Parquet tables, which have no county, market or network.
COUNTIES = [f"County {n}" for n in range(1, 7)]
MARKETS = [f"Market {n}" for n in range(1, 5)]
NETWORK_TIERS = [f"Tier {n}" for n in range(1, 4)]

# --- Fixed values: header names accepted for each canonical column ---------
COLUMN_ALIASES = {
    "claim_id": ["claim_id", "claim_number", "claim", "claim_no"],
    "member_id": ["member_id", "bene_id", "beneficiary_id", "patient_id", "subscriber_id"],
    "provider_id": ["provider_id", "npi", "billing_provider_id", "rendering_provider_id"],
    "provider_name": ["provider_name", "provider", "facility", "billing_provider"],
    "specialty_group": ["specialty_group", "specialty", "provider_specialty", "taxonomy_group"],
    "claim_type": ["claim_type", "claim_category", "setting", "place_category"],
    "service_line": ["service_line", "service", "department", "procedure_group"],
    "diagnosis_group": ["diagnosis_group", "diagnosis", "condition", "primary_diagnosis"],
    "allowed_amount": ["allowed_amount", "allowed", "contracted_amount", "approved_amount"],
    "paid_amount": ["paid_amount", "paid", "payment_amount", "medicare_payment_amount", "reimbursed_amount"],
    "member_responsibility_amount": ["member_responsibility_amount", "member_cost_share", "coinsurance", "copay"],
    "claim_from_date": ["claim_from_date", "from_date", "service_date", "claim_date"],
    "claim_thru_date": ["claim_thru_date", "through_date", "thru_date", "paid_date"],
    "inpatient_flag": ["inpatient_flag", "is_inpatient", "admission_flag"],
    "ed_flag": ["ed_flag", "emergency_flag", "is_ed"],
    "readmission_flag": ["readmission_flag", "readmission_within_30_days"],
    "state_code": ["state_code", "state", "member_state"],
    "plan_type": ["plan_type", "plan", "product", "line_of_business"],
    "chronic_condition_count": ["chronic_condition_count", "chronic_count", "condition_count"],
    "raf_like_score": ["raf_like_score", "risk_score", "raf", "risk_adjustment_score"],
}

# --- Fixed values: what an absent column is filled with --------------------
TEXT_DEFAULTS = {
    "provider_name": "Custom Provider",
    "specialty_group": "Primary care",
    "claim_type": "Professional",
    "service_line": "Office visit",
    "diagnosis_group": "Preventive/other",
    "state_code": "US",
    "plan_type": "Medicare Advantage",
}
NUMBER_DEFAULTS = {
    "allowed_amount": 250.0,
    "paid_amount": 180.0,
    "member_responsibility_amount": 25.0,
    "chronic_condition_count": 1.0,
    "raf_like_score": 0.85,
}
# texts of a claims file that stand for a missing cell
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN",
    "None", "n/a", "nan", "null",
]
FLAG_COLUMNS = ["inpatient_flag", "ed_flag", "readmission_flag"]
DATE_COLUMNS = ["claim_from_date", "claim_thru_date"]

# --- Fixed values: bands, as (right-closed edges, labels) -------------------
AGE_BANDS = ([0, 34, 49, 64, 74, 84, 120], ["18-34", "35-49", "50-64", "65-74", "75-84", "85+"])
RISK_SEGMENTS = ([0, 0.7, 1.15, 1.75, 9], ["Low", "Moderate", "High", "Complex"])
MEMBER_TIERS = ([0, 0.55, 0.75, 0.90, 1.01], ["Monitor", "Rising risk", "High risk", "Complex care"])
PROVIDER_TIERS = ([0, 0.45, 0.70, 0.88, 1.01], ["Efficient", "Standard", "Watchlist", "Intervention"])
READMISSION_TIERS = ([0, 0.55, 0.75, 0.90, 1.01], ["Monitor", "Follow-up", "High risk", "Immediate outreach"])
HCC_TIERS = ([0, 0.55, 0.75, 0.90, 1.01], ["Monitor", "Review", "High priority", "Immediate chart review"])
HIGH_COST_MODEL_TIERS = ([0, 0.30, 0.55, 0.75, 1.01], ["Low", "Rising", "High", "Complex"])
READMISSION_MODEL_TIERS = ([0, 0.20, 0.40, 0.65, 1.01], ["Low", "Moderate", "High", "Immediate outreach"])
ANOMALY_TIERS = ([0, 0.45, 0.70, 0.88, 1.01], ["Normal", "Monitor", "Watchlist", "Audit candidate"])

# --- Fixed values: model inputs and settings --------------------------------
HIGH_COST_FEATURES = [
    "hcc_count", "raf_like_score", "chronic_condition_count", "dual_eligible_flag", "claim_count",
    "ed_visits", "admissions", "readmission_count", "suspected_hcc_gap_count",
]
READMISSION_FEATURES = [
    "length_of_stay", "age", "chronic_condition_count", "hcc_count", "raf_like_score",
    "readmission_index", "quality_score",
]
ANOMALY_FEATURES = [
    "payment_per_member", "services_per_member", "inpatient_claims", "ed_claims", "denial_rate",
    "quality_score", "readmission_index",
]

# --- Fixed values: HCC mapping used where the input brings none --------------
# hcc_code, hierarchy group, rank inside the group (1 drops the others), factor
HCC_FACTORS = [
    ("HCC8", "Neoplasm", 1, 0.970),
    ("HCC18", "Diabetes", 1, 0.302),
    ("HCC59", "Psychiatric", 1, 0.309),
    ("HCC85", "Heart-lung", 1, 0.331),
    ("HCC111", "Heart-lung", 2, 0.335),
    ("HCC138", "Kidney", 1, 0.069),
    ("HCC170", "Injury", 1, 0.350),
]
