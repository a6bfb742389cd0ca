from __future__ import annotations

import pyarrow as pa

import corpus_pipeline
from payerscope.llm import packing, queries


def test_stages_apply_one_after_the_other(spark, sf_dir, odd, tables):
    docs, sizes = tables("documents"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != "packing":
            assert docs.columns == tables("documents").columns
            sizes.append(docs.count())
            docs = spark.createDataFrame(docs.collect(), docs.schema)
    assert tables("documents").count() >= sizes[0] > sizes[1] >= sizes[2] == sizes[3] > 0
    assert docs.columns == [part.split()[0] for part in packing.SCHEMA.split(", ")]


def test_run_gives_packed_pieces(spark, sf_dir, odd):
    assert corpus_pipeline.run(spark, sf_dir).count() > 0


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_texts_go_to_python_in_small_batches(spark):
    from payerscope.llm import common

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "10000")
        common.importable(spark)
        sizes = lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"]) for b in batches)
        rows = spark.range(5000, numPartitions=1).mapInArrow(sizes, "n bigint").collect()
        assert sum(r["n"] for r in rows) == 5000 and max(r["n"] for r in rows) <= 1000
        spark.conf.set(key, "77")  # what a session sets itself stays
        common.importable(spark)
        assert spark.conf.get(key) == "77"
    finally:
        spark.conf.set(key, before)
