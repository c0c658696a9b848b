"""Concepts looked for in prose: word index, phrases, children behind parents, guards, and the run."""
from datetime import date

import pytest
from pyspark.sql import functions as F

from statement_spark.operators import label_search as LS
from statement_spark.plans import extraction as X


def find(spark, label, text):
    missing = spark.createDataFrame([("f", "c", label, False)], "filing_id string, concept_id string, label string, is_segment boolean")
    texts = spark.createDataFrame([("f", text), ("g", "Gross profit 5,000"), ("h", None)], "filing_id string, raw_text string")
    r = LS.search(missing, texts).first()
    return r and (r.value, r.n_values, r.how)


@pytest.mark.parametrize("label,text,found", [
    ("Gross profit", "Our gross  PROFIT rose to $1,234.5 from 1,100", (1234.5, 1, 0)),
    ("Gross profit", "Gross profit\n$ 1,100 | 1,234\n", (1234.0, 2, 0)),
    ("Gross profit", "the gross profit was 1,100\nGross profit 2,200", (2200.0, 1, 0)),
    ("Gross profit", "Gross profit 999", None),
    ("Gross profit", "Gross profit 2024 | 2023", (2023.0, 2, 0)),
    ("Gross profit", "Gross profits 5,000", None),
    ("Gross profit", None, None),
    ("Gross profit", "", None),
    ("R&D expense", "<b>R&D</b> expense 5,000; R&D expense 6,000", (5000.0, 1, 0)),
    ("Interest Expense, Deposits", "Interest expense, deposits 8,000", (8000.0, 1, 0)),
    ("Interest Expense, Deposits", "Deposits 9,000\nInterest expense\nLoans 7,000\nDeposits 8,000", (8000.0, 1, 1)),
    ("Interest Expense, Deposits", "Interest expense 1,000\n" + "x " * 400 + "Interest expense\nDeposits 8,000", (8000.0, 1, 1)),
    ("Interest Expense, Long term debt notes", "Interest expense\nShort debt 1,000\nLong dated debt 3,000", (3000.0, 1, 2)),
    ("Interest Expense, Senior debt notes bonds", "Interest expense\nOther debt 1,000", None),
    ("Deposits", "Statement of financial position\nDeposits 5,000", None),
    ("Deposits", "Statement of financial position" + " x" * 150 + "\nDeposits 5,000", (5000.0, 1, 0)),
    ("Interest income", "Interest income 5,000\nTotal assets 9,000", (5000.0, 1, 0)),
    ("Deposits", "Deposits 5,000\nTotal assets 9,000", None),
    ("cash", "Cash 5,000", (5000.0, 1, 0)),
    ("cash", "cash 5,000.75", (5000.0, 1, 0)),  # at the start of a line a run of whole numbers
    ("abc", "abc 5,000", None),  # short codes are not looked for
])
def test_search(spark, label, text, found):
    assert find(spark, label, text) == found


def test_a_long_text_and_a_frequent_word(spark):
    text = "net " * 100_000 + "\nnet interest income 7,000\n" + "income " * 100_000
    assert find(spark, "Net interest income", text) == (7000.0, 1, 0)


def test_the_run_looks_in_rows_and_then_in_prose(spark):
    page = ("<body><p>Fees of the year came to 7,000,000.</p><div><p>Consolidated Statements of Income (in thousands)</p>"
            "<table><tr><td></td><td>2026</td></tr><tr><td>Revenue</td><td>90,000</td></tr><tr><td>Interest expense</td><td></td></tr>"
            "<tr><td>Deposits</td><td>4,000</td></tr></table></div></body>")
    pages = spark.createDataFrame([("f", "x", date(2026, 12, 31), True, page)], "filing_id string, cik string, period_end date, annual boolean, html string")
    own = spark.createDataFrame([("x", f"c{i}", f"k:{i}", label, str(i), f"k:{i}") for i, label in enumerate(("Revenue", "Interest Expense, Deposits", "Fees of the year", "Nowhere"))],
                                "cik string, concept_id string, concept string, label string, path string, taxonomy_key string")
    own = own.withColumn("concept_ord", F.struct("path", "concept_id"))
    out = X.extract(pages, own, scan=X.scanned_rows(X.read_tables(pages)), texts=X.exhibit_texts(pages))
    assert {(r.concept_id, r.value) for r in out.values.filter("value is not null").collect()} == {("c0", 90e6), ("c1", 4e6), ("c2", 7e6)}
