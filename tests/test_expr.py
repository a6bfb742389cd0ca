import datetime as dt

import pytest
from pyspark.sql import functions as F

from payerscope.fixed_values import AGE_BANDS, RISK_SEGMENTS
from payerscope.functions import dates as D
from payerscope.functions import expr as E


def one(spark, rows, schema, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


@pytest.mark.parametrize("bands, value, label", [
    (AGE_BANDS, -1.0, None), (AGE_BANDS, 0.0, "18-34"), (AGE_BANDS, 34.0, "18-34"), (AGE_BANDS, 34.5, "35-49"),
    (AGE_BANDS, 64.0, "50-64"), (AGE_BANDS, 65.0, "65-74"), (AGE_BANDS, 120.0, "85+"), (AGE_BANDS, 121.0, None),
    (AGE_BANDS, None, None), (RISK_SEGMENTS, 0.7, "Low"), (RISK_SEGMENTS, 0.701, "Moderate"),
    (RISK_SEGMENTS, 1.15, "Moderate"), (RISK_SEGMENTS, 1.75, "High"), (RISK_SEGMENTS, 9.0, "Complex"),
    (RISK_SEGMENTS, 9.1, None),
])
def test_bands_are_right_closed(spark, bands, value, label):
    assert one(spark, [(value,)], "x double", E.band(F.col("x"), *bands)) == [(label,)]


def test_ratio_floors_the_denominator_at_one(spark):
    rows = [(6.0, 3), (6.0, 0), (0.0, 0)]
    assert one(spark, rows, "a double, b int", E.per(F.col("a"), F.col("b"))) == [(2.0,), (6.0,), (0.0,)]


def test_numbers_take_defaults_and_floor(spark):
    rows = [("12.5",), (" 7 ",), ("n/a",), (None,), ("-3",), ("NaN",), ("1e3",), ("Infinity",), ("-inf",)]
    assert [r[0] for r in one(spark, rows, "t string", E.number_or(F.col("t"), 250))] == [
        12.5, 7.0, 250.0, 250.0, 0.0, 250.0, 1000.0, 250.0, 250.0]


def test_flags_are_cut_and_clamped(spark):
    rows = [("1",), ("0.9",), ("3",), ("-2",), ("yes",), (None,), ("1e12",)]
    assert [r[0] for r in one(spark, rows, "t string", E.flag_of(F.col("t")))] == [1, 0, 1, 0, 0, 0, 1]


def test_dates_of_every_shape(spark):
    same = ["2025-01-31", "01/31/2025", "1-31-2025", "20250131", " 2025-01-31 23:59:59 ", "2025-01-31T10:00:00Z", "2025/1/31",
            "1/31/2025 9:30", "Jan 31 2025", "January 31, 2025", "31 Jan 2025", "31-JAN-2025"]
    bad = ["2025-02-30", "soon", None, "", "31/01/2025", "Foo 1 2025", "an 31 2025", "2025"]
    found = [r[0] for r in one(spark, [(t,) for t in same + bad], "t string", D.date_of(F.col("t")))]
    assert found == [dt.date(2025, 1, 31)] * len(same) + [None] * len(bad)
    assert one(spark, [("31/01/2025",), ("02.01.2025",)], "t string", D.date_of(F.col("t"), True)) == [
        (dt.date(2025, 1, 31),), (dt.date(2025, 1, 2),)]


def test_the_larger_count_decides_the_order_of_day_and_month(spark):
    rows = [("13/01/2025", "01/13/2025", "03/04/2025"), ("14/01/2025", "02/02/2025", "x"), ("01/15/2025", None, None)]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    assert D.day_first_columns(df, ["a", "b", "c"]) == {"a": True, "b": False, "c": False}
    assert D.day_first_columns(df, []) == {}


def test_date_keys(spark):
    rows = [(dt.date(2025, 3, 9),), (dt.date(1999, 12, 31),)]
    cols = (E.date_key(F.col("d")), E.month_key(F.col("d")), E.key_to_date(E.date_key(F.col("d"))))
    assert one(spark, rows, "d date", *cols) == [
        (20250309, 202503, dt.date(2025, 3, 9)), (19991231, 199912, dt.date(1999, 12, 31))]


def test_pattern_search_ignores_case_and_finds_parts_of_words(spark):
    rows = [("Emergency department",), ("Biomedical lab",), ("Imaging",), (None,)]
    assert [r[0] for r in one(spark, rows, "t string", E.matches(F.col("t"), "(emergency|ed)"))] == [1, 1, 0, 0]


def test_sums_of_only_nulls_are_zero(spark):
    df = spark.createDataFrame([(None,), (None,)], "x int")
    assert df.agg(E.total("x"), E.money_total("x")).first()[0] == 0
