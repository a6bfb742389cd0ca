"""What queries must not do at size: plans and counts of small tables show it."""

import time

import pandas as pd
import pytest
from helpers import claim, make_star, member, provider
from pyspark.sql import functions as F

from payerscope import session
from payerscope.functions import joins
from payerscope.operators import star as ops
from payerscope.plans import build, queries
from payerscope.sources import tables as src


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture()
def tables(tmp_path):
    """Order-entry tables of a few rows."""
    days = pd.to_datetime(["1998-01-05", "1998-03-09", "1999-02-01", "1999-02-01", "1999-07-08"])
    line = pd.DataFrame({
        "l_orderkey": [1, 1, 2, 3, 3], "l_partkey": [1, 2, 1, 2, 2], "l_suppkey": [1, 2, 2, 1, 1], "l_linenumber": [1, 2, 1, 1, 2],
        "l_quantity": [50.0, 3.0, 50.0, 7.0, 9.0], "l_extendedprice": [10.5, 20.0, 30.25, 40.0, 50.0], "l_discount": [0.0, 0.1, 0.05, 0.0, 0.0],
        "l_tax": [0.01, 0.02, 0.03, 0.08, 0.06], "l_returnflag": list("RNNRA"), "l_linestatus": list("OFOFO"), "l_shipdate": days,
    }).astype({"l_linenumber": "int32"})
    found = {
        "lineitem": line, "orders": pd.DataFrame({"o_orderkey": [1, 2, 3], "o_custkey": [1, 2, 1]}),
        "part": pd.DataFrame({"p_partkey": [1, 2], "p_size": [3, 14]}),
        "customer": pd.DataFrame({"c_custkey": [1, 2], "c_nationkey": [0, 1], "c_mktsegment": ["BUILDING", "MACHINERY"]}),
        "supplier": pd.DataFrame({"s_suppkey": [1, 2], "s_name": ["A", "B"], "s_nationkey": [0, 1], "s_acctbal": [10.0, 20.0]}),
        "nation": pd.DataFrame({"n_nationkey": [0, 1], "n_name": ["PERU", "CHINA"]}), "region": pd.DataFrame({"r_regionkey": [0], "r_name": ["X"]}),
    }
    for name, rows in found.items():
        rows.to_parquet(tmp_path / f"{name}.parquet", coerce_timestamps="us")
    return str(tmp_path)


def test_member_months_are_made_after_the_join(spark):
    star = make_star(spark, [claim(1), claim(2, start=20250301, paid="7")], [member(1), member(2, months=2)], [provider(1)])
    months = ops.member_months(star["dim_member"], star["fact_claim"], (2025,))
    plan = plan_of(months)
    assert plan.index("Generate explode") < plan.index("Join")  # the grid is above the join, so it is never shuffled
    assert months.count() == 14 and sum(r["paid_amount"] for r in months.collect()) == 107


def test_the_last_year_of_the_roll_up_needs_no_numbered_claims(spark, tables, monkeypatch):
    monkeypatch.setattr(queries, "star", lambda *_: pytest.fail("the star was built"))
    assert queries.last_year(spark, tables) == 1999
    assert queries.hcc_rollup(spark, tables).count() > 0


def test_wide_projections_run_compiled(spark, tables):
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    build.extract(spark, tables)
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "12345")
    build.extract(spark, tables)
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "12345"
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")


def test_the_extract_is_sorted_as_lines_and_not_as_texts(spark, tables):
    star = build.extract_star(spark, tables)
    assert "Sort" not in plan_of(build.loose_extract(build.sorted_lines(spark, tables))).splitlines()[0]
    sort = plan_of(build.loose_extract(build.sorted_lines(spark, tables))).split("Sort [", 1)
    assert "free text" in sort[0] and "free text" not in sort[1]  # texts are made above the sort
    numbers = [(r["claim_key"], r["claim_id"]) for r in star["_numbered"].orderBy("claim_key").collect()]
    assert [k for k, _ in numbers] == list(range(1, 14)) and [c for _, c in numbers] == sorted(c for _, c in numbers)
    assert star["fact_claim"].count() == 13 and star["fact_claim"].where("member_key is null or provider_key is null").count() == 0
    assert "Sort [" not in plan_of(star["_cells"]) and "_rows" in star and "Sort [" not in plan_of(star["_rows"])


def test_claims_move_without_texts_to_their_members(spark, tables):
    from payerscope.sources import claims_file

    star = build.extract_star(spark, tables)
    plan = plan_of(claims_file.claim_fact(star["_rows"], star))
    joins = [line for line in plan.splitlines() if "Join LeftOuter" in line]
    assert "member_id" in joins[0] and "diagnosis_group" not in plan[:plan.index(joins[1])].split("Project")[-1]


def test_ids_are_joined_by_their_counted_size(spark):
    from payerscope.functions.ranking import small_side

    rows = spark.range(3)
    assert "broadcast" in plan_of(rows.join(small_side(rows), "id")) and "broadcast" not in plan_of(rows.join(small_side(rows, 2), "id"))


def test_a_split_is_summed_up_line_by_line_only_where_quotes_are(monkeypatch):
    import pyarrow as pa

    from payerscope.sources import csv_scan

    lines = ['a,b', '', 'x,"open', 'inside', ' ', 'end",y', 'z,1', '"q""",2', 'last,"un']
    seen, real = [], csv_scan.left_open
    monkeypatch.setattr(csv_scan, "left_open", lambda line, inside: seen.append(line) or real(line, inside))
    batch = pa.RecordBatch.from_pydict({"file": ["f"] * len(lines), "block": [0] * len(lines), "value": lines})
    got = next(csv_scan.summarize(iter([batch.slice(0, 4), batch.slice(4)]))).to_pylist()[0]
    want = []
    for inside in (False, True):
        starts = 0
        for line in lines:
            starts += not inside and bool(line.strip())
            inside = real(line, inside)
        want.append((inside, starts))
    assert [(got["end_0"], got["starts_0"]), (got["end_1"], got["starts_1"])] == want
    assert set(seen) == {line for line in lines if '"' in line}
    few = pa.RecordBatch.from_pydict({"file": ["f"] * 3, "block": [0] * 3, "value": ['"a', "b", 'c"']})
    assert next(csv_scan.summarize(iter([few]))).to_pylist()[0]["starts_0"] == 1


def test_window_sums_move_their_changes_once(spark):
    from payerscope.operators import care

    star = make_star(spark, [claim(1, start=20250110), claim(2, start=20250203, paid="9")], [member(1)], [provider(1)])
    cutoffs = care.claim_months(star)
    found = care.window_sums(star, cutoffs, -365, -1, ["paid"])
    rows = {str(r["cutoff_date"]): (r["paid"], str(r["latest_source_date"])) for r in found.collect()}
    assert rows == {"2025-01-01": (0, "None"), "2025-02-01": (100, "2025-01-10")}
    assert "unique_providers" not in found.columns and "unique_providers" not in plan_of(found)
    moves = found._jdf.queryExecution().executedPlan().toString().split("RepartitionByExpression")[0].split("REPARTITION_BY_COL")[0]
    assert moves.count("Exchange") == 1  # above the move by member nothing moves again


def test_the_checks_of_the_diagnosis_bridge_read_it_once(spark):
    from payerscope.operators import quality

    rows = spark.createDataFrame([("A", 1, 1), (" ", 0, 1), ("B", 2, 0)], "diagnosis_code string, diagnosis_position int, principal_flag int")
    rows = rows.where("diagnosis_position < 99")
    star = make_star(spark, [claim(1)], [member(1)], [provider(1)])
    procedures = spark.createDataFrame([("P",)], "procedure_code string")
    transfers = spark.createDataFrame([(0, 0)], "readmission_30day_flag int, same_day_transfer_flag int")
    targets = spark.createDataFrame([(1, 0)], "member_key bigint, target_high_cost int")
    features = {"x": (transfers.selectExpr("date'2025-01-01' AS latest_source_date", "date'2025-02-01' AS at"), F.col("at"))}
    report = quality.extended_checks(star, rows, procedures, transfers, targets, features, targets, [2025])
    found = {r["check_name"]: r["value"] for r in report.collect()}
    assert (found["diagnosis_code_not_blank"], found["diagnosis_position_valid"], found["principal_is_first"]) == ("1", "1", "1")
    assert plan_of(report).count("diagnosis_position#") and plan_of(report).count("< 99") == 1


def test_lines_move_with_their_day_and_whether_they_were_denied(spark, tables):
    from payerscope.sources import tables as src

    for plan in (plan_of(src.as_claims(src.claim_lines(spark, tables))), plan_of(build.loose_extract(src.claim_lines(spark, tables)))):
        above = plan[:plan.rindex("Join LeftOuter")]
        assert "l_shipdate" not in above and "l_returnflag" not in above and "denied" in above
    claims = src.as_claims(src.claim_lines(spark, tables))
    assert {(r["claim_id"][:3], r["denied_flag"], r["claim_from_date_key"]) for r in claims.collect()} == {
        ("1-1", 1, 19980105), ("1-2", 0, 19980309), ("2-1", 0, 19990201), ("3-1", 1, 19990201), ("3-2", 0, 19990708)}


def test_events_and_months_move_by_member_and_not_before(spark):
    from payerscope.operators import care

    rows = [claim(i, member=1 + i % 2, start=20250105 + i % 3 * 100, inpatient=i % 2) for i in range(1, 9)]
    star = make_star(spark, rows, [member(1), member(2)], [provider(1)])
    found = care.sums_of_windows(star, care.month_start, {"prior_": (-365, -1, ["paid"]), "next_": (0, 364, ["paid", "readmissions"])})
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_opportunity_rows_stay_in_place_and_are_counted_once(spark, monkeypatch):
    from payerscope.operators import scoring

    written = {}
    real = scoring.write_shared
    def keep(df, name, *more):
        written[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return real(df, name, *more)
    monkeypatch.setattr(scoring, "write_shared", keep)
    rows = spark.createDataFrame([("2025-01-01", float(i), i, i % 3) for i in range(40)], "day string, s double, next_paid int, next_readmissions int")
    found = scoring.opportunity_of(rows.select(F.to_date("day").alias("cutoff_date"), "s", F.col("next_paid").cast("decimal(28,2)"), "next_readmissions"), "s")
    assert "cutoff_date" not in "".join(line for line in written["opportunity_cuts"].splitlines() if "isnotnull(cutoff_date" in line)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and plan.count("Exchange hashpartitioning") == 1  # the one of the sums by date
    got = found.first()
    assert (got["members"], got["workload"], got["next_paid"], got["flagged_next_paid"]) == (40, 4, 780, 36 + 37 + 38 + 39)


def test_tables_as_long_as_the_claims_are_written_compactly(spark):
    from payerscope.functions.ranking import dense_key

    placed = dense_key(spark.range(9), ["id"], "place", "numbered")
    assert all(".zstd." in f for f in placed.inputFiles()) and [r["place"] for r in placed.orderBy("id").collect()] == list(range(1, 10))


@pytest.mark.parametrize("most", [1, 500_000])
def test_dimensions_are_broadcast_by_their_rows(spark, tables, monkeypatch, most):
    """The files of a few columns of a long dimension are below Spark's size for a broadcast; its hash table is not."""
    monkeypatch.setattr(joins, "BROADCAST_ROWS", most)
    star = build.star_of(spark, tables)
    rows = ops.enrich_episodes(star).select("episode_key", "age", "raf_like_score", "quality_score")
    joined = rows._jdf.queryExecution().sparkPlan().toString()
    for key in ("member_key", "provider_key"):
        assert (f"BroadcastHashJoin [{key}" in joined) == (most > 1) and (f"SortMergeJoin [{key}" in joined) == (most == 1)
    assert rows.count() == star["fact_inpatient_episode"].count()


def test_long_parts_are_not_broadcast(spark, tables, monkeypatch):
    monkeypatch.setattr(src, "TWO_COLUMN_ROWS", 1)
    joined = src.claim_lines(spark, tables)._jdf.queryExecution().sparkPlan().toString()
    assert any("SortMergeJoin [l_partkey" in line for line in joined.splitlines())


def test_a_compressed_extract_of_several_files_keeps_its_order(spark, tables, monkeypatch):
    monkeypatch.setattr(queries, "EXTRACT_FILE", 3)
    path = queries.written_extract(spark, tables)
    files = [name for name in session.list_names(spark, path) if name.startswith("part-")]
    assert len(files) > 2 and all(name.endswith(".csv.gz") for name in files)
    rows = queries.custom_row_keys(spark, tables).orderBy("claim_key").collect()
    assert [r["claim_key"] for r in rows] == list(range(1, len(rows) + 1)) and len(rows) == src.claim_lines(spark, tables).count()
    assert [r["claim_id"] for r in rows] == sorted(r["claim_id"] for r in rows)


def shuffled(spark) -> set[str]:
    """The shuffles whose files lie on the disk now."""
    env = spark._jvm.org.apache.spark.SparkEnv.get()
    names = env.blockManager().diskBlockManager().getAllFiles().mkString(",").split(",")
    return {name.rsplit("/", 1)[1].split("_")[1] for name in names if "/shuffle_" in name}


def test_a_long_write_lets_its_shuffles_go(spark, monkeypatch):
    monkeypatch.setattr(session, "LONG_WRITE", 0.0)
    before = shuffled(spark)
    written = session.write_shared(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "sevenths")
    until = time.monotonic() + 20
    while shuffled(spark) - before and time.monotonic() < until:
        time.sleep(0.2)
    assert not shuffled(spark) - before
    assert sorted(r["count"] for r in written.collect()) == [142] + [143] * 6
