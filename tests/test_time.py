import datetime as dt

import pytest
from pyspark.sql import functions as F

from waybatch.functions.timefn import normalize_nulls, parse_timestamp, shift_year


def _ts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "s string").select(parse_timestamp("s").alias("ts"))


def test_parse_bad_is_null(spark):
    got = [r.ts for r in _ts(spark, ["2025-02-20 10:00:00", "not a date", None, "2024-02-29 01:02:03"]).collect()]
    assert got == [dt.datetime(2025, 2, 20, 10), None, None, dt.datetime(2024, 2, 29, 1, 2, 3)]


def test_null_tokens(spark):
    df = spark.createDataFrame([("NA",), ("nan",), ("",), ("x",)], "s string")
    assert [r.v for r in df.select(normalize_nulls("s").alias("v")).collect()] == [None, None, None, "x"]


@pytest.mark.parametrize("policy,expected", [
    ("clamp", dt.datetime(2025, 2, 28, 12, 30, 0, 250000)),
    ("null", None),
])
def test_shift_year_feb29(spark, policy, expected):
    df = _ts(spark, ["2024-02-29 12:30:00.25", "2024-01-01 12:00:00", None])
    got = [r.v for r in df.select(shift_year("ts", policy).alias("v")).collect()]
    assert got == [expected, dt.datetime(2025, 1, 1, 12), None]


def test_shift_year_error_policy(spark):
    df = _ts(spark, ["2024-02-29 12:30:00"])
    with pytest.raises(Exception, match="day is out of range"):
        df.select(shift_year("ts", "error").alias("v")).collect()
    ok = _ts(spark, ["2024-03-01 00:00:00"]).select(shift_year("ts", "error").alias("v")).first().v
    assert ok == dt.datetime(2025, 3, 1)


def test_shift_year_bad_policy():
    with pytest.raises(ValueError):
        shift_year(F.lit(None), "later")
