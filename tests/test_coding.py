"""HCC sets as bits against plain sets, with more HCCs than one word holds."""

import random

from payerscope.operators.coding import Hccs, hcc_gaps, hcc_rollup, hcc_sets

FACTORS = [(f"H{i:03d}", f"g{i % 9}", i // 9 + 1, round(0.1 + i / 1000, 3)) for i in range(150)]


def test_sets_of_many_hccs_equal_plain_sets(spark):
    pick = random.Random(6)
    rows = [(pick.randint(1, 6), pick.randint(2020, 2026), f"D{pick.randint(0, 170):03d}") for _ in range(260)]
    bridge = spark.createDataFrame(rows, "member_key bigint, risk_year int, diagnosis_code string")
    mapping = spark.createDataFrame([(f"D{i:03d}", f"H{i:03d}") for i in range(160)], "diagnosis_code string, hcc_category string")
    member = spark.createDataFrame([(i, 60 + i) for i in range(1, 7)], "member_key bigint, age int")
    hccs = Hccs(FACTORS)
    assert hccs.words == 3
    sets = hcc_sets(bridge, mapping, hccs)
    got = {(r["member_key"], r["risk_year"]): r for r in hcc_rollup(sets, member, 2025, hccs).collect()}
    gaps = {(r["member_key"], r["risk_year"], r["hcc_code"]) for r in hcc_gaps(sets, 2025, hccs).collect()}

    known = {f[0]: f for f in FACTORS}
    codes, captured = {}, {}
    for who, year, code in rows:
        codes.setdefault((who, year), set()).add(code)
    for key, found in codes.items():
        own = [known["H" + c[1:]] for c in found if "H" + c[1:] in known]
        captured[key] = {f[0] for f in own if not any(o[1] == f[1] and o[2] < f[2] for o in own)}
    missed = {(w, y + 1): s - captured.get((w, y + 1), set()) for (w, y), s in captured.items() if y + 1 <= 2025}
    assert gaps == {(*key, h) for key, found in missed.items() for h in found}
    due = set(codes) | {(w, y + 1) for (w, y), s in captured.items() if s and y + 1 <= 2025}
    assert set(got) == due
    for key in due:
        row, own = got[key], captured.get(key, set())
        before = captured.get((key[0], key[1] - 1), set())
        assert row["hcc_list"] == ",".join(sorted(own)) and row["hcc_count"] == len(own)
        assert row["diagnosis_count"] == len(codes.get(key, ()))
        assert row["recaptured_hcc_count"] == len(own & before) and row["suspected_gap_count"] == len(missed.get(key, ()))
        assert abs(row["disease_factor"] - sum(known[h][3] for h in own)) < 1e-9
        assert row["top_hcc_category"] == (max(own, key=lambda h: (known[h][3], h)) if own else None)


def test_headers_of_different_shape_are_reconciled_and_conflicts_told(spark):
    import datetime as dt

    from payerscope.operators.coding import claim_header, header_conflicts

    a = spark.createDataFrame([("c1", 1, 2, dt.date(2025, 1, 2), dt.date(2025, 1, 5), "1,200.50")],
                              "CLM_ID string, BENE_KEY bigint, PRVDR_KEY bigint, CLM_FROM_DT date, CLM_THRU_DT date, CLM_PMT_AMT string")
    b = spark.createDataFrame([("c2", "x", "2025-02-03", 1999, "zz"), ("c3", "7", "soon", None, "z")],
                              "`claim id` string, `member key` string, servicedate string, paid_cents bigint, `Service Date` string")
    rows = {r["claim_id"]: tuple(r)[1:] for r in claim_header({"A": a, "B": b}).collect()}
    from decimal import Decimal

    assert rows["c1"] == (1, 2, dt.date(2025, 1, 2), dt.date(2025, 1, 5), Decimal("1200.50"), "A")
    assert rows["c2"] == (None, None, dt.date(2025, 2, 3), dt.date(2025, 2, 3), Decimal("19.99"), "B")
    assert rows["c3"] == (7, None, None, None, None, "B")
    told = {(r["claim_type"], r["column_name"], r["issue"]): r["unreadable_cells"] for r in header_conflicts({"A": a, "B": b}).collect()}
    assert told == {
        ("A", "paid_amount", "cast"): 0, ("B", "member_key", "cast"): 1, ("B", "provider_key", "absent"): 0, ("B", "claim_thru_date", "absent"): 0,
        ("B", "claim_from_date", "ambiguous"): 0, ("B", "claim_from_date", "cast"): 1, ("B", "paid_amount", "cast"): 0,
    }
