from pathlib import Path

import pytest

from payerscope import session
from payerscope.operators import coding, quality
from payerscope.sources import sinks


def test_tables_are_replaced_and_csv_has_a_header(spark, tmp_path):
    first, second = spark.range(5).toDF("a"), spark.range(2).toDF("a")
    sinks.write_tables({"t": first}, str(tmp_path))
    sinks.write_tables({"t": second}, str(tmp_path))
    assert sinks.read_tables(spark, str(tmp_path))["t"].count() == 2
    sinks.write_csv({"t": first}, f"{tmp_path}/csv")
    back = spark.read.option("header", True).csv(f"{tmp_path}/csv/t")
    assert back.columns == ["a"] and back.count() == 5


def test_claims_are_laid_out_by_month(spark, tmp_path):
    df = spark.createDataFrame([(1, 202501), (2, 202502), (3, 202502)], "claim_key bigint, paid_month_key int")
    sinks.write_tables({"fact_claim": df}, str(tmp_path))
    assert sorted(p.name for p in Path(sinks.table_path(spark, str(tmp_path), "fact_claim")).glob("paid*")) == ["paid_month_key=202501", "paid_month_key=202502"]
    back = sinks.read_tables(spark, str(tmp_path))["fact_claim"]
    assert back.columns == df.columns and back.where("paid_month_key = 202502").count() == 2


def test_many_tasks_do_not_write_many_files_a_month(spark, tmp_path):
    df = spark.range(0, 400, 1, 20).selectExpr("id AS claim_key", "cast(202501 + id % 4 AS int) AS paid_month_key")
    sinks.write_tables({"fact_claim": df}, str(tmp_path))
    files = list(Path(sinks.table_path(spark, str(tmp_path), "fact_claim")).glob("paid*/*.parquet"))
    assert len(files) == 4 and sinks.read_tables(spark, str(tmp_path))["fact_claim"].count() == 400


def test_record_hash_tells_nulls_empty_texts_and_separators_apart(spark, tmp_path):
    rows = [(1, None, ""), (2, "", None), (3, "", ""), (4, "a|1:b", "c"), (5, "a", "1:b|c"), (6, None, None)]
    spark.createDataFrame(rows, "k int, a string, b string").write.parquet(f"{tmp_path}/t")
    hashed = coding.with_lineage(spark.read.schema("a string, b string").parquet(f"{tmp_path}/t"))
    assert hashed.select("record_hash").distinct().count() == len(rows)


def test_quality_status(spark):
    rows = spark.createDataFrame([("a", "PASS"), ("b", "FAIL")], "check_name string, status string")
    assert [tuple(r) for r in quality.quality_status(rows).collect()] == [("FAIL", 2, 1)]
    assert [tuple(r) for r in quality.quality_status(rows.where("status = 'PASS'")).collect()] == [("PASS", 1, 0)]


def test_summary_and_counts(spark, tmp_path):
    tables = {"b": spark.range(3).toDF("x"), "a": spark.range(4).selectExpr("id AS x", "id AS y")}
    summary = {r["name"]: (r["rows"], r["columns"]) for r in sinks.run_summary(tables, f"{tmp_path}/out").collect()}
    assert summary == {"a": (4, "x,y"), "b": (3, "x")}
    assert [tuple(r) for r in sinks.record_counts(tables).collect()] == [("a", 4), ("b", 3)]


def test_written_tables_live_in_the_checkpoint_folder(spark):
    folder = session.shared_folder(spark)
    assert folder == (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir())
    assert folder.removeprefix("file:") in session.write_shared(spark.range(3), "t").inputFiles()[0]


def test_inline_tables_have_a_known_size(spark):
    df = session.inline_table(spark, [(1, "it's"), (2, "b")], "k bigint, t string")
    assert [tuple(r) for r in df.collect()] == [(1, "it's"), (2, "b")]
    assert "LocalRelation" in df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("text", ["", "x"])
def test_placeholders(text):
    from payerscope.operators.sqlpack import placeholders

    assert placeholders("a {b} c {d}" + text) == ["b", "d"]


def test_a_killed_run_leaves_the_tables_of_the_run_before(spark, tmp_path):
    from pyspark.sql import functions as F

    folder = str(tmp_path)
    good = {"a": spark.range(3).toDF("x"), "b": spark.range(2).toDF("y")}
    sinks.write_tables(good, folder)
    broken = {"a": spark.range(9).toDF("x"), "b": spark.range(2).select(F.raise_error(F.lit("lost")).cast("bigint").alias("y"))}
    with pytest.raises(Exception, match="lost"):
        sinks.write_tables(broken, folder)
    assert {n: df.count() for n, df in sinks.read_tables(spark, folder).items()} == {"a": 3, "b": 2}
    assert len(session.list_names(spark, f"{folder}/versions")) == 2
    assert len(sinks.remove_abandoned(spark, folder)) == 1
    for n in range(4):
        sinks.write_tables({"a": spark.range(n).toDF("x")}, folder)
    assert sinks.read_tables(spark, folder)["a"].count() == 3 and len(session.list_names(spark, f"{folder}/versions")) == 2
    assert [n for n in session.list_names(spark, folder) if n.startswith("_manifest")] == ["_manifest.json"]


def test_nothing_remains_of_a_run(spark):
    before = session.list_names(spark, session.shared_folder(spark))
    with session.run_folder(spark) as folder:
        assert session.write_shared(spark.range(5), "t").count() == 5 and session.path_exists(spark, folder)
    with pytest.raises(KeyError), session.run_folder(spark):
        session.write_shared(spark.range(5), "t")
        raise KeyError
    assert session.list_names(spark, session.shared_folder(spark)) == before
