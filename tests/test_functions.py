"""Scalar helpers (functions/scalar.py)."""

import datetime as dt

from pyspark.sql import functions as F

from rebuy.functions import days_between, first_argmax, parse_date, parse_quantity, safe_divide, weekday_monday0


def test_parse_date(spark):
    vals = ["2024-05-01", "2024-05-01 13:00", "2024-05-01T13:00:00", "garbage", "2024-13-01", None, ""]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(parse_date("s")).collect()]
    may1 = dt.date(2024, 5, 1)
    assert got == [may1, may1, may1, None, None, None, None]


def test_parse_quantity(spark):
    vals = ["1", "2.9", "-2.9", "NaN", "inf", "-inf", "1e30", "x", "", None, " 7 "]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(parse_quantity("s")).collect()]
    assert got == [1, 2, -2, 0, 0, 0, 0, 0, 0, 0, 7]


def test_days_between_and_safe_divide(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 2, 2), 3, 0)], "a date, b date, n int, z int")
    r = df.select(days_between("a", "b").alias("d"), days_between(F.lit(None).cast("date"), "b").alias("dn"),
                  safe_divide("n", F.lit(2)).alias("h"), safe_divide("n", "z").alias("q")).first()
    assert (r.d, r.dn, r.h, r.q) == (32.0, None, 1.5, None)


def test_weekday_and_argmax(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), 1, 3, 3), (dt.date(2024, 1, 7), 5, 0, 5)], "d date, x int, y int, z int")
    rows = df.select(weekday_monday0("d").alias("w"), first_argmax([F.col("x"), F.col("y"), F.col("z")]).alias("m")).collect()
    assert [(r.w, r.m) for r in rows] == [(0, 1), (6, 0)]


def test_common_date_formats_are_read_whole(spark):
    cases = {
        "2024-05-01": "2024-05-01",
        " 2024-5-1 ": "2024-05-01",
        "2024-05-01 13:00": "2024-05-01",
        "2024-05-01T23:59:59.5Z": "2024-05-01",
        "2024-05-01 13:00:00 +02:00": "2024-05-01",
        "2024/05/01": "2024-05-01",
        "20240501": "2024-05-01",
        "05/01/2024": "2024-05-01",
        "5/1/2024 07:30": "2024-05-01",
        "May 1, 2024": "2024-05-01",
        "1 may 2024": "2024-05-01",
        "September 30, 2024": "2024-09-30",
        "2024-05-01 garbage": None,
        "2024-05-01Tzzz": None,
        "2024-05-01 25:00": None,
        "2024-13-01": None,
        "13/32/2024": None,
        "Foo 1, 2024": None,
        "May 32, 2024": None,
        "2024": None,
        "": None,
        None: None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    got = [None if r[0] is None else r[0].isoformat() for r in df.select(parse_date("s")).collect()]
    assert got == list(cases.values())


def test_type_suffixes_are_no_quantity(spark):
    df = spark.createDataFrame([(x,) for x in ("5d", "5f", "5D", "5F", "5", "5.9", "-5.9", "1e3", "inf", "Infinity")], "s string")
    assert [r[0] for r in df.select(parse_quantity("s")).collect()] == [0, 0, 0, 0, 5, 5, -5, 1000, 0, 0]
