"""Whole runs on one or two filings."""
import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from statement_spark.operators import concepts as C, retry as RT
from statement_spark.plans import extraction as X

CONCEPTS = [
    ("c1", "us-gaap:Revenues", "Revenue"), ("c2", "us-gaap:CostOfRevenue", "Cost of revenue"), ("c3", "us-gaap:GrossProfit", "Gross profit"),
    ("c4", "x:Deposits", "Interest Expense, Deposits"), ("c5", "us-gaap:NetIncomeLoss", "Net income"), ("c6", "x:Mystery", "Mystery line"),
    ("c7", "us-gaap:EarningsPerShareDiluted", "Diluted earnings per share"),
]


def concepts(spark):
    rows = [("k", c, t, lb, f"00{i}", t, f"00{i}") for i, (c, t, lb) in enumerate(CONCEPTS)]
    return spark.createDataFrame(rows, "cik string, concept_id string, concept string, label string, path string, taxonomy_key string, concept_ord string")


def replies(spark, texts, prescan="millions"):
    rows = [("f", "k", i, s, t, prescan, None, date(2026, 3, 31)) for i, (s, t) in enumerate(texts)]
    return spark.createDataFrame(rows, "filing_id string, cik string, chunk_idx int, section string, text string, prescan string, shares string, report_date date")


def test_responses_to_values(spark):
    texts = [
        ("income_statement", json.dumps({"__scale__": "millions", "__period__": "Three Months Ended March 31, 2026",
                                         "[us-gaap:Revenues]": 94000, "cost of  REVENUE": 52000, "Diluted earnings per share": 2.40})),
        ("other", json.dumps({"__scale__": "millions", "__period__": "Three Months Ended March 31, 2025", "Net income": 1})),
        ("other", json.dumps({"__scale__": "billions", "__period__": "Q1 2026", "Net income": 20000, "Deposit costs": 300, "Adjusted EBITDA": 9}))]
    answers = spark.createDataFrame([("f", 0, "c4", "Deposit costs")], "filing_id string, resp_ord int, concept_id string, key string")
    roles = spark.createDataFrame([("k", "Mystery line", "gross_margin_pct")], "cik string, label string, role string")
    out = X.extract_from_responses(replies(spark, texts), concepts(spark), semantic=answers, role_answers=roles)
    got = {r.concept_id: (r.value, r.derived) for r in out.values.collect()}
    assert got["c2"] == (52_000e6, False) and got["c5"] == (20_000e6, False) and got["c7"] == (2.40, False)
    assert got["c4"] == (300e6, False)
    assert got["c1"] == (94_000e6, False) and got["c3"] == (42_000e6, True)
    assert got["c6"] == (pytest.approx(42 / 94 * 100), True)
    keys = {r["key"]: r.str_value for r in out.metrics.collect()}
    assert "Adjusted EBITDA" not in keys and keys["__period__"] == "Three Months Ended March 31, 2026"
    assert "gaap_nongaap_leakage" in {r.type for r in out.findings.collect()}


def test_row_scan_fills_missing_concepts(spark):
    texts = [("income_statement", '{"Revenue": 5}')]
    rows = spark.createDataFrame([("f", 0, 0, "Interest expense", None, 0), ("f", 0, 1, "Deposits", 4200.0, 2), ("f", 0, 2, "Net income", 2026.0, 1),
                                  ("f", 0, 3, "Mystery line", 8e5, 2)],
                                 "filing_id string, table_idx int, row_idx int, key string, value double, n_values int")
    out = X.extract_from_responses(replies(spark, texts), concepts(spark), scan=rows)
    got = {r.concept_id: r.value for r in out.values.collect()}
    assert got == {"c1": 5e6, "c4": 4200.0, "c6": 8e5}


def test_statement_run(spark):
    page = """<p>Consolidated Statements of Operations</p><p>(In millions)</p><table>
    <tr><td></td><td>Three Months Ended</td></tr><tr><td></td><td>March 31, 2026</td><td>March 31, 2025</td></tr>
    <tr><td>Revenue</td><td>50,000</td><td>45,000</td></tr><tr><td>Cost of revenue</td><td>20,000</td><td>19,000</td></tr>
    <tr><td>Net income</td><td>10,000</td><td>9,000</td></tr><tr><td>Diluted earnings per share</td><td>4.25</td><td>4.00</td></tr></table>"""
    pages = spark.createDataFrame([("f", "k", date(2026, 3, 31), False, page)], "filing_id string, cik string, period_end date, annual boolean, html string")
    got = {r.concept_id: r.value for r in X.extract(pages, concepts(spark)).values.collect()}
    assert got == {"c1": 50e9, "c2": 20e9, "c3": 30e9, "c5": 10e9, "c7": 4.25}


@pytest.mark.parametrize("before,around,label,hit", [
    ("CONSOLIDATED BALANCE SHEETS", "", "Deposits", True), ("", "total deposits 5", "Deposits", True),
    ("", "total deposits 5", "Interest income", False), ("Statement of income", "", "Deposits", False)])
def test_balance_sheet_context(spark, before, around, label, hit):
    df = spark.createDataFrame([(before, around, label)], "b string, a string, l string")
    assert df.select(C.balance_sheet_context(F.col("b"), F.col("a"), F.col("l")).alias("x")).first().x is hit


def test_notes_carry_history(spark):
    found = spark.createDataFrame([("f", "identity_violation", "high", "off", "look", {"revenue": "100", "gross_profit": "40"}, 3)],
                                  "filing_id string, type string, severity string, message string, suggested_action string, evidence map<string,string>, detector_ord int")
    missing = spark.createDataFrame([("f", f"L{i}", False, i) for i in range(12)], "filing_id string, label string, is_segment boolean, concept_ord int")
    old = spark.createDataFrame([("f", 1, "before ")], "filing_id string, attempt int, notes string")
    text = RT.extraction_notes(found, missing, previous=old).first().notes
    assert text.startswith("After pass 1: before\n\nNeeded") and "Revenue less gross profit is 60" in text
    assert "L9" in text and "L10" not in text


def test_resolve_gives_what_roll_up_and_rules_give_apart(spark):
    import random

    from statement_spark.operators import derive as D

    rng = random.Random(3)
    roles = ["revenue", "cost_of_revenue", "gross_profit", "total_opex", "operating_income", "rd_expense", "tax_expense", "net_income",
             "eps_basic", "shares_basic", None, None]
    concepts = []
    for cik in ("a", "b"):
        for i, role in enumerate(roles):
            path = f"00{i + 1}"
            concepts.append((cik, f"{cik}{i}", path, path, role))
            for k in range(rng.randint(0, 2)):
                concepts.append((cik, f"{cik}{i}.{k}", f"{path}.{k}", f"{path}.{k}", rng.choice([None, "rd_expense", "cost_of_revenue"])))
    values = []
    for f in range(40):
        cik = "ab"[f % 2]
        for n, c in enumerate(c for c in concepts if c[0] == cik):
            if rng.random() < 0.5:
                values.append((f"f{f}", cik, c[1], float(rng.randint(1, 900)), rng.randint(0, 50)))
    lists = spark.createDataFrame(concepts, "cik string, concept_id string, concept_ord string, path string, role string")
    v = spark.createDataFrame(values, "filing_id string, cik string, concept_id string, value double, key_ord long")
    per_filing = v.select("filing_id", "cik").distinct().join(lists, "cik")
    rolled = D.roll_up(v.drop("cik"), per_filing)
    derived = D.derive(rolled, per_filing)
    apart = rolled.selectExpr("filing_id", "concept_id", "value", "rolled_up AS derived").unionByName(
        derived.selectExpr("filing_id", "concept_id", "value", "true AS derived"))
    rows = lambda df: sorted((r["filing_id"], r["concept_id"], round(r["value"], 6), r["derived"]) for r in df.collect())
    together = rows(D.resolve(v, D.company_trees(lists)))
    assert together == rows(apart) and any(r[3] for r in together)


def test_keep_flags_over_exhibits(spark):
    """An undecided table that an answer drops is not read, unless the filing would be left without any."""
    cells = "<table><tr><td></td><td>2026</td></tr><tr><td>{0}</td><td>1,500</td></tr></table>"
    income, other = "<p>Consolidated Statements of Income</p>" + cells.format("Revenue"), "<p>Key data</p>" + cells.format("Sales of tools")
    rows = [("a", 1, income + other), ("a", 2, other), ("b", 1, other), ("b", 2, "<p>Segment</p>" + cells.format("Stores")),
            ("c", 1, other + "<p>More data</p>" + cells.format("Boats")), ("d", 1, other), ("d", 2, income)]
    pages = spark.createDataFrame([(f, e, "x", date(2026, 12, 31), True, h) for f, e, h in rows],
                                  "filing_id string, exhibit_no int, cik string, period_end date, annual boolean, html string")
    tables = X.read_tables(pages)
    keys = lambda keep: {(r.filing_id, r.key) for r in X.statement_metrics(tables, keep=keep).collect()}
    assert keys(None) == {("a", "Revenue"), ("a", "Sales of tools"), ("b", "Sales of tools"), ("c", "Sales of tools"), ("c", "Boats"),
                          ("d", "Sales of tools"), ("d", "Revenue")}
    keep = spark.createDataFrame([("a", 1, 1, False), ("b", 1, 0, False), ("c", 1, 0, False), ("d", 1, 0, False)],
                                 "filing_id string, exhibit_no int, table_idx int, keep boolean")
    assert keys(keep) == {("a", "Revenue"), ("b", "Sales of tools"), ("c", "Boats"), ("d", "Revenue")}


def test_removals_of_answers_in_the_run(spark):
    page = ("<p>Consolidated Statements of Income (in thousands)</p><table><tr><td></td><td>2026</td></tr><tr><td>Revenue</td><td>90,000</td></tr>"
            "<tr><td>Extra line</td><td>7</td></tr><tr><td>Net income</td><td>900</td></tr></table>")
    pages = spark.createDataFrame([("f", "x", date(2026, 12, 31), True, page)], "filing_id string, cik string, period_end date, annual boolean, html string")
    own = spark.createDataFrame([("x", "c1", "k:R", "Revenue", "1", "k:R")], "cik string, concept_id string, concept string, label string, path string, taxonomy_key string")
    own = own.withColumn("concept_ord", F.struct("path", "concept_id"))
    removals = spark.createDataFrame([("f", "Extra line", "rule A"), ("f", "Revenue", "rule A")], "filing_id string, key string, reason string")
    assert {r["key"] for r in X.extract(pages, own, removals=removals).metrics.collect()} == {"Revenue", "Net income"}
