"""Fiscal calendar cases, as tables."""
from datetime import date

import pytest
from pyspark.sql import functions as F

from statement_spark.functions import fiscal


def rows(spark, data, schema):
    return spark.createDataFrame(data, schema)


def d(s):
    return date.fromisoformat(s) if s else None


PERIODS = [
    ("", "2026-03-31", 6, 2026, 3),
    ("", "2026-06-30", 6, 2026, 4),
    ("", "2025-09-30", 6, 2026, 1),
    ("", "2025-11-01", 1, 2026, 4),
    ("Thirteen Weeks Ended May 2, 2026", "2026-05-02", 1, 2027, 2),
    ("Thirty-Nine Weeks Ended November 1, 2025", "2025-11-01", 1, 2026, 3),
    ("Nine Months Ended March 31, 2026", "2026-03-31", 6, 2026, 3),
    ("Three Months Ended November 30, 2025", "2025-11-30", 8, 2026, 1),
    ("Three Months Ended May 30, 2026", "2026-06-15", 8, 2026, 3),
    ("Second Quarter Fiscal 2026", "2026-03-31", 12, 2026, 2),
    ("Q3 2026", "2026-03-31", 12, 2026, 3),
]


def test_fiscal_period(spark):
    df = rows(spark, [(t, d(e), m, y, q) for t, e, m, y, q in PERIODS], "t string, e date, m int, y int, q int")
    fy, q = fiscal.fiscal_period(F.col("e"), F.col("m"), F.col("t"))
    bad = df.withColumns({"gy": fy, "gq": q}).filter("not (gy <=> y and gq <=> q)").collect()
    assert bad == []


STARTS = [
    ("Thirteen Weeks Ended May 2, 2026", "2026-05-02", "2026-02-01"),
    ("Six Months Ended June 30, 2026", "2026-06-30", "2026-01-01"),
    ("Three Months Ended January 31, 2026", "2026-01-31", "2025-11-01"),
    ("Q2 2026", "2026-06-30", None),
]


def test_period_start(spark):
    df = rows(spark, [(t, d(e), d(s)) for t, e, s in STARTS], "t string, e date, s date")
    assert df.filter(~fiscal.period_start(F.col("t"), F.col("e")).eqNullSafe(F.col("s"))).collect() == []


TYPES = [
    ("2026-01-31", 1, "0131", "annual"), ("2026-02-03", 1, "0131", "annual"), ("2026-02-08", 1, "0131", "quarterly"),
    ("2025-12-28", 1, "0101", "annual"), ("2026-03-31", 12, "1231", "quarterly"), ("2025-12-31", 12, None, "annual"),
    ("2027-03-01", 2, "0229", "annual"), (None, 12, "1231", "quarterly"),
]


def test_annual_by_date(spark):
    df = rows(spark, [(d(e), m, c, t) for e, m, c, t in TYPES], "e date, m int, c string, t string")
    got = fiscal.date_period_type(F.col("e"), F.col("m"), F.col("c"))
    assert df.filter(got != F.col("t")).collect() == []


@pytest.mark.parametrize("text,end", [
    ("Three Months Ended March 31, 2026", "2026-03-31"), ("ended FEBRUARY 28 2026", "2026-02-28"),
    ("ended February 30, 2026", None), ("no date", None), (None, None),
])
def test_period_end_date(spark, text, end):
    got = rows(spark, [(text,)], "t string").select(fiscal.period_end_date(F.col("t")).alias("e")).first().e
    assert got == d(end)


CADENCE = [
    ("quarterly", 3, "2025-09-30", "2025-12-31", "annual"), ("quarterly", 1, "2025-03-31", "2025-06-30", "quarterly"),
    ("quarterly", 4, "2025-12-31", "2026-03-31", "quarterly"), ("annual", None, "2025-12-31", "2026-03-31", "quarterly"),
    ("quarterly", 3, "2025-09-30", "2025-09-30", "quarterly"), (None, None, None, "2025-09-30", None),
]


def test_cadence(spark):
    df = rows(spark, [(t, q, d(e), d(c), x) for t, q, e, c, x in CADENCE], "t string, q int, e date, c date, x string")
    got = fiscal.next_period_type(F.col("t"), F.col("q"), F.col("e"), F.col("c"))
    assert df.filter(~got.eqNullSafe(F.col("x"))).collect() == []


def test_fye_month(spark):
    df = rows(spark, [("0630", 6), ("1331", 12), ("xx", 12), (None, 12), ("0131", 1)], "c string, m int")
    assert df.filter(fiscal.fye_month(F.col("c")) != F.col("m")).collect() == []
