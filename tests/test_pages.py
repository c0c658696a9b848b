"""Page scan, table classes and the statement reader on small pages."""
from datetime import date

from pyspark.sql import functions as F

from statement_spark.operators import tables as TB
from statement_spark.plans import extraction as X
from statement_spark.sources import html

STATEMENT = """<html><body><nav>Menu 1</nav><p>Intro<p><b>Forward-Looking Statements</b> may differ
<div><div>(in thousands)</div></div><div><p>Consolidated Statements of Income</p></div>
<div><table><tr><th></th><th colspan=2>Three Months Ended March 31,</th><th colspan=2>Nine Months Ended March 31,</th></tr>
<tr><td></td><td>2026</td><td>2025</td><td>2026</td><td>2025</td></tr>
<tr><td>Revenue</td><td>$</td><td>1,500</td><td>$</td><td>1,400</td><td>4,500</td><td>4,100</td></tr>
<tr><td>Operating loss</td><td>(25</td><td>)</td><td>—</td><td>(75</td><td>)</td><td>(60)</td></tr>
<tr><td>Diluted earnings per share</td><td>0.10</td><td>0.09</td><td>0.30</td><td>0.28</td></tr>
<tr><td>Short row</td><td>7</td></tr></table></div><script>var a = "<table>";</script>tail"""


def test_scan_keeps_reading_order_and_drops_noise():
    seg = html.scan(STATEMENT)
    assert len(seg) == 2 and seg[1]["nodes"] == ["tail"]
    assert seg[0]["nodes"][-2:] == ["(in thousands)", "Consolidated Statements of Income"]
    assert not any("Menu" in n for n in seg[0]["nodes"])
    assert seg[0]["rows"][2] == ["Revenue", "$", "1,500", "$", "1,400", "4,500", "4,100"]


def test_scan_is_robust():
    assert html.scan(None) == [] and html.scan("") == []
    assert html.scan("a < b <br> c")[0]["nodes"] == ["a < b", "c"]
    open_table = html.scan("<table><tr><td>x<td>y&amp;z")
    assert open_table[0]["rows"] == [["x", "y&z"]]
    nested = html.scan("<table><tr><td>o</td><td><table><tr><td>i</td></tr></table></td></tr></table>after")
    assert [s["rows"] is not None for s in nested] == [True, False]
    assert ["i"] in nested[0]["rows"]
    assert html.scan('<p title="a>b">t</p><!-- <table> -->u')[0]["nodes"] == ["t", "u"]


def _pages(spark, page, end, annual):
    return spark.createDataFrame([("f1", "c1", end, annual, page)], "filing_id string, cik string, period_end date, annual boolean, html string")


def test_reader_takes_period_scale_and_sign(spark):
    for annual, revenue in ((False, 1_500_000.0), (True, 4_500_000.0)):
        rows = X.statement_metrics(X.read_tables(_pages(spark, STATEMENT, date(2026, 3, 31), annual)))
        got = {r["key"]: r.num_value for r in rows.collect()}
        assert got["Revenue"] == revenue
        assert got["Operating loss"] == (-75_000.0 if annual else -25_000.0)
        assert got["Diluted earnings per share"] == (0.30 if annual else 0.10)
        assert "Short row" not in got


def test_reader_falls_back_to_latest_column(spark):
    rows = X.statement_metrics(X.read_tables(_pages(spark, STATEMENT, date(2020, 1, 1), False)))
    assert {r["key"]: r.num_value for r in rows.collect()}["Revenue"] == 1_500_000.0


def test_caption_injected_before_table(spark):
    tables = X.read_tables(_pages(spark, STATEMENT, date(2026, 3, 31), False))
    row = tables.select("table_type", "near_scale").first()
    assert row.table_type == "income_statement" and row.near_scale == "thousands"


def test_footnote_table_is_dropped(spark):
    page = "<p>Notes</p><table><tr><td>(a) one</td></tr><tr><td>(b) two</td></tr><tr><td>three</td></tr></table>"
    got = X.read_tables(_pages(spark, page, date(2026, 3, 31), False)).first().table_type
    assert got == "drop"


def test_assembled_and_fallback_text(spark):
    tables = X.read_tables(_pages(spark, STATEMENT, date(2026, 3, 31), False))
    story = spark.createDataFrame([("f1", "We grew.")], "filing_id string, prose string")
    text = TB.assembled_text(TB.selected_entries(tables, "filing_id"), story, "filing_id").first().raw_text
    assert text.startswith("=== GAAP INCOME STATEMENT ===\n") and text.endswith("=== NARRATIVE ===\nWe grew.")
    plain = TB.fallback_text(tables, story, "filing_id").first().raw_text
    assert plain.startswith("We grew.\n| ") and "| Revenue | $ | 1,500 |" in plain


def test_supplement_selection(spark):
    base = [("f", 0, 1, None, None, "Key data", [["", "2025"], ["Stores", "5"]]),
            ("f", 0, 2, None, None, "Operating segments", [["", "2025"], ["Interest expense", "5"]]),
            ("f", 1, 2, None, None, "Operating segments", [["", "2025"], ["Stores", "5"]]),
            ("f", 2, 2, None, None, "Balance sheet", [["", "2025"], ["Total assets", "5"]])]
    t = spark.createDataFrame(base, "filing_id string, table_idx int, exhibit_no int, doc_scale string, near_scale string, context string, rows array<array<string>>")
    got = TB.selected_entries(TB.classify(t), "filing_id").select("exhibit_no", "table_idx", "entry").collect()
    assert {(r.exhibit_no, r.table_idx) for r in got} == {(1, 0), (2, 0)}
    assert [r.entry for r in got if r.exhibit_no == 2][0].startswith("[SUPPLEMENTAL EXHIBIT (2)] ")


def test_unclosed_noise_tags_are_scanned_in_one_pass():
    import time

    began = time.perf_counter()
    assert html.scan("<p>x</p>" + "<svg a=1>" * 8000)[0]["nodes"] == ["x"]
    assert html.scan("<svg " * 50_000) and time.perf_counter() - began < 1


def test_noise_ends_at_its_own_close_tag_and_cells_know_their_columns():
    found = html.scan("<svg><svg>a</svg>b</svg>c<table><tr><th colspan=2>2024</th><td>1</table><style>d")
    assert found[0]["nodes"] == ["c"] and found[0]["cols"] == [[0, 2, 3]] and found[1]["nodes"] == ["d"]


def test_heading_keeps_whole_nodes(spark):
    title = "CONSOLIDATED STATEMENTS OF OPERATIONS " + "and so on " * 60
    page = f"<p>far {'away ' * 100}</p><p>{title}</p><table><tr><td>Sundry</td><td>1</td></tr></table>"
    pages = spark.createDataFrame([("f", page)], "filing_id string, html string")
    table = X.read_tables(pages).first()
    assert table["context"].startswith("CONSOLIDATED") and table["table_type"] == "income_statement"


FAR = "<p>This release refers to non-GAAP measures such as Adjusted EBITDA. See the reconciliation.</p>"
CELLS = "<table><tr><td></td><td>2026</td></tr><tr><td>Line</td><td>5</td></tr></table>"


def _classes(spark, page):
    rows = X.read_tables(_pages(spark, page, date(2026, 3, 31), False)).select("table_idx", "table_type", "context").collect()
    return [(r.table_type, r.context) for r in sorted(rows, key=lambda r: r.table_idx)]


def test_headings_come_from_siblings_then_from_the_parents(spark):
    own = f"<body>{FAR}<div><p>Consolidated Statements of Income</p>{CELLS}</div></body>"
    assert _classes(spark, own) == [("income_statement", "Consolidated Statements of Income")]
    parents = f"<body>{FAR}<p>Consolidated Balance Sheets</p><div>{CELLS}</div></body>"
    assert _classes(spark, parents) == [("balance_sheet", "Consolidated Balance Sheets")]
    deep = f"<body>{FAR}<p>Consolidated Balance Sheets</p><div><div>{CELLS}</div></div></body>"
    assert _classes(spark, deep) == [("other", "")]
    split = f"<body>{FAR}<p>Statements of <b>cash</b> flows</p><center>{CELLS}</center></body>"
    assert _classes(spark, split) == [("cash_flow", "Statements of cash flows")]


def test_headings_beside_the_parent_are_short_and_no_disclaimers(spark):
    long = "<p>Income " + "and more words " * 20 + "</p>"
    page = f"<body><p>Consolidated Statements of Income</p>{long}<p>Note: unaudited</p><p>small print</p><div>{CELLS}</div></body>"
    assert _classes(spark, page) == [("income_statement", "Consolidated Statements of Income")]
    again = f"<body><p>Consolidated Statements of Income</p><div>{CELLS}</div><div>{CELLS}</div></body>"
    assert [t for t, _ in _classes(spark, again)] == ["income_statement", "other"]


def test_headings_in_unbalanced_pages():
    heads = lambda page: [s["heading"] for s in html.scan(page) if s["rows"] is not None]
    assert heads("<div><p>One<p>Two<table><tr><td>x</table></b></i>Three<table><tr><td>y</table>") == [["One", "Two"], ["Three"]]
    assert heads("</div></p><br/><hr>Alone<table></table>") == [["Alone"]]
    assert heads("<p>" + "a" * 390 + "</p><p>" + "b" * 15 + "</p><table></table>") == [["a" * 390, "b" * 15]]
    assert heads("<p>Far</p><p>" + "a" * 400 + "</p><table></table>") == [["a" * 400]]


def test_deep_and_unclosed_pages_take_time_in_proportion():
    import time

    def seconds(n):
        page = "<div>" * n + ("</p></span>text<table><tr><td>1</td></tr></table>" * (n // 10)) + "</div>" * n
        start = time.perf_counter()
        html.scan(page)
        return time.perf_counter() - start

    seconds(2000)
    assert seconds(40_000) < 40 * max(seconds(4000), 0.01)
