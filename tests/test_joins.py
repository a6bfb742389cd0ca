from pyspark.sql import functions as F

from payerscope.functions.joins import left_join_rare
from payerscope.operators import marts
from payerscope.session import write_shared


def test_rows_that_meet_no_group_stay_in_place(spark):
    rows = spark.range(4000, numPartitions=4).select(
        F.when(F.col("id") % 50 != 7, F.col("id")).alias("a"), (F.col("id") % 3).alias("b"), "id", F.spark_partition_id().alias("at"))
    groups = write_shared(rows.where("a % 400 = 8").select("a", "b", F.lit(9).alias("n")).unionByName(
        spark.createDataFrame([(None, 1, 5)], "a bigint, b bigint, n int")), "groups")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = left_join_rare(rows, groups, ["a", "b"]).withColumn("now", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert sorted(r["id"] for r in found) == list(range(4000))
    assert {r["id"] for r in found if r["n"] == 9} == {i for i in range(4000) if i % 400 == 8}
    assert {r["n"] for r in found} == {9, None}  # a missing key meets nothing
    assert all(r["at"] == r["now"] for r in found if r["n"] is None)


def test_claim_scores_shuffle_only_claims_of_repeats(spark):
    """Without broadcasts, the join to the same-day repeats is on one side of a union."""
    from helpers import claim, make_star, member, provider

    star = make_star(spark, [claim(i, member=i % 9, provider=1 + i % 3, start=20250101 + i // 20) for i in range(1, 200)],
                     [member(i) for i in range(9)], [provider(i) for i in range(1, 4)])
    scored = marts.fwa_scored(star)
    assert "Union" in scored._jdf.queryExecution().optimizedPlan().toString()
    counts = {r["claim_key"]: r["similar_claim_count"] for r in scored.collect()}
    groups = {}
    for i in range(1, 200):
        groups.setdefault((i % 9, 1 + i % 3, i // 20), []).append(i)
    assert counts == {i: len(held) for held in groups.values() for i in held}
