from __future__ import annotations

import pytest

ROWS = [
    (0, "one two three four five six seven eight nine ten", "en", "s", 48, 7),
    (1, "One two three four five six seven eight nine ten", "en", "s", 48, 7),
    (2, None, None, None, None, None),
    (3, "", "en", None, 0, 1),
    (3, "", "en", None, 0, 1),
    (None, "mail a.b@c.example.com or +1 (386) 555-3733 now", "en", "s", 3, 2),
    (5, "word " * 9000, "en", "hot", 45000, 2),
    (6, "x" * 70000, "en", "hot", 70000, 2),
    (7, "   \n\n \t ", "en", "hot", 7, 2),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row int"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and a column whose name the operators use themselves."""
    from payerscope.llm.common import importable

    importable(spark)
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark, odd):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def tables(spark, sf_dir, odd):
    return lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
