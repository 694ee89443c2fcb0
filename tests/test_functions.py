"""Scalar functions and the calendar spine."""
import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from martlake.functions import scalar as S
from martlake.functions.calendar import date_spine


def test_safe_divide(spark):
    df = spark.createDataFrame([(10.0, 2.0), (1.0, 0.0), (1.0, None), (None, 2.0)], "n double, d double")
    got = [r[0] for r in df.select(S.safe_divide("n", "d")).collect()]
    assert got == [5.0, 0.0, 0.0, None]


def test_to_number_tokens(spark):
    # text forms and the value the coercion must give (null where not numeric)
    cases = [("x", None), ("", None), (" 2 ", 2.0), ("1d", None), ("NaN", None), ("1_000", None),
             ("1,5", None), ("1e3", 1000.0), (".5", 0.5), ("+3", 3.0), ("inf", math.inf)]
    df = spark.createDataFrame(cases, "t string, want double")
    for t, got, want in df.select("t", S.to_number("t"), "want").collect():
        assert got == want, t


def test_parse_timestamp_offsets(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00",), ("2024-01-01T10:00:00+02:00",),
                                ("2024-01-01T10:00:00Z",), (None,)], "s string")
    got = [r[0] for r in df.select(S.parse_timestamp("s")).collect()]
    assert got == [dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 8), dt.datetime(2024, 1, 1, 10), None]
    bad = spark.createDataFrame([("not a time",)], "s string")
    assert bad.select(S.try_parse_timestamp("s")).first()[0] is None


def test_cents_to_dollars_half_up(spark):
    df = spark.createDataFrame([("12345.5",), ("100",)], "c string").select(F.col("c").cast("decimal(18,4)").alias("c"))
    got = [float(r[0]) for r in df.select(S.cents_to_dollars("c")).collect()]
    assert got == [123.46, 1.0]


def test_date_spine_inclusive_and_reversed(spark):
    days = [r[0] for r in date_spine(spark, "2024-01-30", "2024-02-02").collect()]
    assert days == [dt.date(2024, 1, 30), dt.date(2024, 1, 31), dt.date(2024, 2, 1), dt.date(2024, 2, 2)]
    assert date_spine(spark, "2024-02-02", "2024-01-30").count() == 0


def test_date_parts_zero_padded(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 5, 1, 2, 3),)], "ts timestamp_ntz")
    row = df.select(*S.date_parts("ts"), S.batch_stamp("ts").alias("b")).first()
    assert (row["year"], row["month"], row["day"], row["b"]) == ("2024", "03", "05", "20240305_010203")


def test_age_hours(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 30, 22, 30),)], "ts timestamp_ntz")
    assert df.select(S.age_hours("ts", "2024-01-31 00:00:00")).first()[0] == 1.5


def test_sql_macros(spark):
    from martlake.functions.sql import register_sql_functions
    register_sql_functions(spark)
    row = spark.sql("SELECT cents_to_dollars(12345.5) AS a, safe_divide(1, 0) AS b, "
                    "safe_divide(1, 0, -1) AS c, safe_divide(6, 3) AS d").first()
    assert (float(row["a"]), row["b"], row["c"], row["d"]) == (123.46, 0.0, -1.0, 2.0)
    assert spark.sql("SELECT * FROM date_spine(DATE'2024-01-01', DATE'2024-01-03')").count() == 3
    assert spark.sql("SELECT * FROM date_spine(DATE'2024-01-03', DATE'2024-01-01')").count() == 0


def test_units_match_decimal_cast(spark):
    vals = [0.285, 1.005, 2.675, 68423.46, -0.125, -2.675, 0.0, 123456.785, 1e-7, None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = df.select(S.units("x", 2).alias("u"),
                    (F.col("x").cast("decimal(18,2)") * 100).cast("bigint").alias("want")).collect()
    assert all(r["u"] == r["want"] for r in got)
    for bad in (float("nan"), float("inf"), 2e13, -2e13):
        with pytest.raises(Exception, match="amount out of range"):
            spark.createDataFrame([(bad,)], "x double").select(S.units("x", 2)).collect()



def test_checked_units_check_a_row_once(spark):
    df = spark.createDataFrame([(1.25, 0.1, None), (None, -2.5, 3.0)], "a double, b double, c double")
    cols = {"x": "a", "y": "b", "z": "c"}
    assert [tuple(r) for r in df.select(*S.checked_units(cols, 2)).collect()] == [(125, 10, None), (None, -250, 300)]
    for row in ((1.0, float("nan"), 1.0), (1.0, 1.0, 1e300), (float("inf"), None, None)):
        with pytest.raises(Exception, match="amount out of range"):
            spark.createDataFrame([row], df.schema).select(*S.checked_units(cols, 2)).collect()
