"""Captions, labels, numbers and roles."""
import pytest
from pyspark.sql import functions as F

from statement_spark.functions import numbers, roles, text as T


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(fn(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize("text,scale", [
    ("Statement (In millions, except per share data)", "millions"),
    ("(in thousands)", "thousands"),
    ("(in thousands) a (in thousands) b (in millions)", "thousands"),
    ("(in millions) then (in thousands)", "millions"),
    ("Intro\n$ in billions\nrows", "billions"),
    ("Dollars in thousands, unaudited", "thousands"),
    ("Revenue was $132.4 million in the quarter, net new ARR of $256 million", None),
    ("(Amounts in millions)\nIn thousands", "millions"),
    ("", None),
])
def test_dominant_scale(spark, text, scale):
    assert one(spark, text, T.dominant_scale) == scale


@pytest.mark.parametrize("raw,head,member,tag", [
    ("Net sales", "Net sales", "", ""),
    ("Net sales\n\n\nus-gaap:ProductMember", "Net sales", "Product", "us-gaap:ProductMember"),
    ("Net  sales\nus-gaap:ServiceOtherMember", "Net sales", "Service Other", "us-gaap:ServiceOtherMember"),
    ("us-gaap:Revenues", None, "Revenues", ""),
])
def test_labels(spark, raw, head, member, tag):
    row = spark.createDataFrame([(raw,)], "x string").select(
        T.label_head(F.col("x")).alias("h"), T.label_member(F.col("x")).alias("m"), T.member_tag(F.col("x")).alias("t")).first()
    assert (row.h, row.m, row.t) == (head, member, tag)


@pytest.mark.parametrize("cell,value", [
    ("82,886", 82886.0), ("(1,234)", -1234.0), ("$ 4.27", 4.27), ("$(12.5)", -12.5), ("1.5B", 1.5e9), ("500M", 5e8),
    ("150K", 1.5e5), ("(1,234", -1234.0), ("-3", -3.0), ("n/a", None), ("", None), ("Q1 2025", None), ("12%", None),
    ("December 31, 2025", None), ("—", None), ("1,2,3", 123.0),
])
def test_parse_number(spark, cell, value):
    assert one(spark, cell, numbers.parse_number) == value


@pytest.mark.parametrize("label,role", [
    ("Total cost of revenue", "cost_of_revenue"), ("Gross profit margin %", "gross_margin_pct"), ("Net sales", "revenue"),
    ("Diluted net income per share", "eps_diluted"), ("Selling, general and administrative", "ga_expense"),
    ("Pre-tax restructuring charges", None), ("Other comprehensive income", None), ("Total net interest income", "interest_income"),
    ("Noninterest expense", "interest_expense"), ("Weighted-average diluted shares", "shares_diluted"),
])
def test_role_of_label(spark, label, role):
    assert one(spark, label, roles.role_of_label) == role


def test_boilerplate_only_in_second_half(spark):
    head = "x" * 50
    assert one(spark, f"{head}\nAbout Acme\nwe", T.strip_boilerplate) == head
    early = "\nAbout Acme\n" + "y" * 80
    assert one(spark, early, T.strip_boilerplate) == early


def test_compact_value(spark):
    cases = [(82_900_000_000.0, "82.9B"), (315e6, "315M"), (24_300.0, "24.3K"), (4.27, "4.27"), (-2129.0, "-2.13K"),
             (999_600.0, "1e+03K"), (1e9, "1B")]
    for v, want in cases:
        assert one(spark, v, T.compact_value, "double") == want


def test_period_phrase_and_quarters(spark):
    assert one(spark, "For Three  Months Ended March 31, 2026 we", T.period_phrase) == "Three Months Ended March 31, 2026"
    q = one(spark, "2Q25 3Q25 4Q25 1Q26 | Q2 2026", T.latest_quarter)
    assert (q.n, q.latest) == (5, "Q22026")
