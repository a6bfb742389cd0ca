"""Every query that SQL can state gives the same rows as its DuckDB text."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry  # noqa: E402
from compare import compare, connect  # noqa: E402

ROWS_ONLY = sorted(set(entry.queries()) - set(entry.oracle_sql()))


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_same_rows_as_sql(spark, sf_dir, duck, name):
    assert compare(entry.queries()[name](spark, sf_dir), duck.sql(entry.oracle_sql()[name])) == []


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_queries_give_rows(spark, sf_dir, name):
    assert entry.queries()[name](spark, sf_dir).count() > 0


def test_entry_runs(spark, sf_dir):
    df = entry.entry(spark)
    assert df.count() > 0 and "pmpm" in df.columns
