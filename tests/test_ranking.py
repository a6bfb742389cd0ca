import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from payerscope.functions import ranking as R


def frame(spark, values, group=None):
    rows = [(i, (group[i] if group else "g"), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "id int, g string, x double")


def pct(df, **kw):
    return {r["id"]: r["p"] for r in R.with_pct_ranks(df, [R.Rank("x", "p", **kw)]).collect()}


@pytest.mark.parametrize("decimals", [None, 2, 9])
def test_rank_share_averages_ties_and_skips_nulls(spark, decimals):
    values = [3.0, 1.0, 3.0, None, 2.0, 3.0, 1.0]
    want = pd.Series(values).rank(pct=True)
    got = pct(frame(spark, values), decimals=decimals)
    assert all((got[i] is None) if np.isnan(w) else abs(got[i] - w) < 1e-12 for i, w in want.items())


def test_rank_share_across_many_ranges(spark):
    rng = np.random.default_rng(1)
    values = [float(v) for v in np.round(rng.lognormal(12, 3, 3000), 2)] + [0.0] * 1500
    want = pd.Series(values).rank(pct=True)
    df = frame(spark, values)
    ranges = df.select(F.floor(F.col("x") * 100 / R.RANGE_WIDTH)).distinct().count()
    assert ranges > 50
    got = pct(df, decimals=2)
    assert max(abs(got[i] - w) for i, w in want.items()) < 1e-12


def test_rank_share_within_partitions(spark):
    rng = np.random.default_rng(2)
    values = [float(v) for v in rng.integers(0, 50, 400)]
    group = [f"s{i % 3}" for i in range(399)] + ["alone"]
    want = pd.DataFrame({"g": group, "x": values}).groupby("g")["x"].rank(pct=True)
    got = pct(frame(spark, values, group), decimals=6, partition=("g",))
    assert max(abs(got[i] - w) for i, w in want.items()) < 1e-12
    assert got[399] == 1.0


def test_distribution_matches_plain_windows(spark):
    rng = np.random.default_rng(3)
    df = frame(spark, [float(v) for v in np.round(rng.normal(0, 1e7, 800), 2)] + [5.0] * 400, None).withColumn(
        "hit", (F.col("id") % 3 == 0).cast("bigint"))
    w = Window.orderBy("x")
    plain = df.select("x", (F.rank().over(w) - 1).alias("before"), F.percent_rank().over(w).alias("pr"),
                      F.dense_rank().over(Window.orderBy(F.desc("x"))).alias("dense")).distinct().collect()
    dist = R.value_distribution(df, "x", decimals=2, measures={"hit": F.col("hit")})
    got = {r["x"]: r for r in dist.select("*", R.percent_rank_of(F.col("before"), F.col("total")).alias("pr")).collect()}
    for r in plain:
        assert got[r["x"]]["before"] == r["before"]
        assert got[r["x"]]["pr"] == pytest.approx(r["pr"], abs=1e-15)
        assert got[r["x"]]["distinct_total"] - got[r["x"]]["distinct_before"] == r["dense"]
    hits = df.where("x < 5").agg(F.sum("hit")).first()[0]
    assert got[5.0]["hit_before"] == hits


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(st.none(), st.integers(-10**6, 10**7)), min_size=2, max_size=40), q=st.floats(0, 1))
def test_quantiles_match_linear_interpolation(spark, values, q):
    cents = [None if v is None else v / 100 for v in values]
    present = [v for v in cents if v is not None]
    got = R.exact_quantile(frame(spark, cents), "x", q, "cut", decimals=2).first()["cut"]
    if not present:
        assert got is None
    else:
        assert got == pytest.approx(float(np.quantile(present, q)), rel=1e-9, abs=1e-9)


def test_quantiles_by_partition(spark):
    values = [float(v) for v in range(100)]
    group = ["a" if i < 60 else "b" for i in range(100)]
    rows = R.exact_quantiles(frame(spark, values, group), "x", {"m": 0.5, "t": 0.9}, ["g"], decimals=2).collect()
    got = {r["g"]: (r["m"], r["t"]) for r in rows}
    assert got["a"] == pytest.approx((np.quantile(values[:60], 0.5), np.quantile(values[:60], 0.9)))
    assert got["b"] == pytest.approx((np.quantile(values[60:], 0.5), np.quantile(values[60:], 0.9)))


def test_dense_key_numbers_in_order_over_many_tasks(spark):
    df = spark.range(0, 5000, 1, 16).select((F.col("id") * 7919 % 5000).alias("v"), "id")
    keyed = R.dense_key(df, ["v"], "key", "test_key")
    assert [(r["v"], r["key"]) for r in keyed.orderBy("key").collect()] == [(i, i + 1) for i in range(5000)]


def test_dense_key_of_no_rows(spark):
    assert R.dense_key(spark.range(0).toDF("v"), ["v"], "key", "test_none").count() == 0


def test_dense_key_splits_a_hot_value_over_tasks(spark):
    df = spark.range(0, 60000, 1, 8).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("v"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        keyed = R.dense_key(df, ["v", "id"], "key", "test_hot")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert keyed.agg(F.count_distinct("key"), F.max("key")).first()[:] == (60000, 60000)
    tasks = keyed.where("v = 7").select(F.input_file_name()).distinct().count()
    assert tasks >= 2


def test_next_row_of_the_group(spark):
    rows = [(1, 10, "a"), (1, 20, "b"), (2, 5, "c"), (2, 5, "d"), (3, 1, "e")]
    df = spark.createDataFrame(rows, "g int, at int, id string")
    got = {r["id"]: (r["next_at"], r["next_id"]) for r in R.with_next(
        df, "g", ["at", "id"], {"next_at": "at", "next_id": "id"}, "test_next").collect()}
    assert got == {"a": (20, "b"), "b": (None, None), "c": (5, "d"), "d": (None, None), "e": (None, None)}
