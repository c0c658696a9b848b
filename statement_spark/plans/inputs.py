"""Filings, statements, concepts and histories that Spark derives from the given tables."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(c: Column) -> Column:
    return F.floor(c).cast("bigint")


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Income-statement figures per supplier and year of shipment, in whole dollars."""
    price = F.col("l_extendedprice")
    return spread(table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_suppkey").alias("suppkey"), F.year("l_shipdate").alias("fy")
    ).agg(
        F.sum(whole(price)).alias("revenue"),
        F.sum(whole(price * (1 - F.col("l_discount")) * 0.6)).alias("cost"),
        F.sum(whole(price * F.col("l_tax"))).alias("rd"),
        F.sum(whole(price * F.col("l_discount"))).alias("sm"),
        F.sum(whole(F.col("l_quantity") * 100)).alias("ga"),
        F.sum(whole(price * F.col("l_tax") * F.col("l_discount"))).alias("tax"),
        F.sum(whole(F.col("l_quantity"))).alias("qty"),
        F.sum(F.when(F.col("l_returnflag") == "R", whole(price)).otherwise(0)).alias("returned"),
        F.count(F.lit(1)).alias("n_lines"),
    ))


FACTS_SQL = """facts AS (
  SELECT l_suppkey AS suppkey, CAST(year(l_shipdate) AS INTEGER) AS fy,
    CAST(sum(CAST(floor(l_extendedprice) AS BIGINT)) AS BIGINT) AS revenue,
    CAST(sum(CAST(floor(l_extendedprice * (1 - l_discount) * CAST(0.6 AS DOUBLE)) AS BIGINT)) AS BIGINT) AS cost,
    CAST(sum(CAST(floor(l_extendedprice * l_tax) AS BIGINT)) AS BIGINT) AS rd,
    CAST(sum(CAST(floor(l_extendedprice * l_discount) AS BIGINT)) AS BIGINT) AS sm,
    CAST(sum(CAST(floor(l_quantity * 100) AS BIGINT)) AS BIGINT) AS ga,
    CAST(sum(CAST(floor(l_extendedprice * l_tax * l_discount) AS BIGINT)) AS BIGINT) AS tax,
    CAST(sum(CAST(floor(l_quantity) AS BIGINT)) AS BIGINT) AS qty,
    CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(floor(l_extendedprice) AS BIGINT) ELSE 0 END) AS BIGINT) AS returned,
    count(*) AS n_lines
  FROM lineitem GROUP BY 1, 2)"""

# (label printed, figure) of a rendered income statement; the other concepts are derived.
PRINTED = [
    ("Revenue", "revenue"), ("Cost of  Revenue", "cost"), ("Research and development", "rd"),
    ("Sales and marketing", "sm"), ("General and administrative", "ga"),
    ("Income tax expense", "tax"), ("Weighted average shares outstanding, basic", "qty"),
]
CONCEPTS = [
    ("c01", "us-gaap:Revenues", "Revenue", "001"),
    ("c02", "us-gaap:CostOfRevenue", "Cost of revenue", "002"),
    ("c03", "us-gaap:GrossProfit", "Gross profit", "003"),
    ("c04", "us-gaap:ResearchAndDevelopmentExpense", "Research and development", "004"),
    ("c05", "us-gaap:SellingAndMarketingExpense", "Sales and marketing", "005"),
    ("c06", "us-gaap:GeneralAndAdministrativeExpense", "General and administrative", "006"),
    ("c07", "us-gaap:OperatingExpenses", "Total operating expenses", "007"),
    ("c08", "us-gaap:OperatingIncomeLoss", "Operating income", "008"),
    ("c09", "system:IncomeBeforeTax", "Income before tax", "009"),
    ("c10", "us-gaap:IncomeTaxExpenseBenefit", "Income tax expense", "010"),
    ("c11", "us-gaap:NetIncomeLoss", "Net income", "011"),
    ("c12", "us-gaap:WeightedAverageNumberOfSharesOutstandingBasic",
     "Weighted average shares outstanding, basic", "012"),
    ("c13", "us-gaap:EarningsPerShareBasic", "Basic earnings per share", "013"),
    ("c14", "system:GrossMargin", "Gross margin %", "014"),
]


def shaped_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annual statements in eight table shapes, by supplier: (filing_id, cik, period_end, annual, html).

    0 a change column (and in even years a row that fits no header), 1 a percentage row, 2 negatives in brackets,
    3 three- and twelve-month columns, 4 three dated columns, 5 no scale, 6 years before the filing's, 7 a long heading.
    """
    f = facts(spark, sf_dir)
    k, y = F.pmod("suppkey", F.lit(8)), F.col("fy")
    unit = F.when(k == 5, 1).otherwise(1000)
    td = lambda x: F.concat(F.lit("<td>"), x, F.lit("</td>"))
    number = lambda x: F.format_number(F.floor(x / unit), 0)
    text = lambda *xs: F.concat(*[x if isinstance(x, Column) else F.lit(x) for x in xs])

    def row(label: str, x: Column) -> Column:
        now, half = number(x), number(x / 2)
        cells = (
            F.when(k == 0, text(td(now), td(half), "<td>100%</td>"))
            .when((k == 2) & F.lit(label != "Revenue"), text("<td>$</td>", td(text("(", now, ")")), "<td>$</td>", td(text("(", half, ")"))))
            .when(k == 3, text(td(number(x / 4)), td(number(x / 8)), td(now), td(half)))
            .when(k == 4, text(td(now), td(number(x / 3)), td(half)))
            .otherwise(text("<td>$</td>", td(now), "<td>$</td>", td(half)))
        )
        return text(f"<tr><td>{label}</td>", cells, "</tr>")

    th = lambda x, n=1: text(f'<th colspan="{n}">', x, "</th>")
    year = lambda back: (y - back).cast("string")
    dated = lambda day, back: text(day, ", ", year(back))
    head = (
        F.when(k == 0, text(th(year(0)), th(year(1)), th("Change")))
        .when(k == 3, text(th("Three Months Ended December 31,", 2), th("Year Ended December 31,", 2), "</tr><tr><td></td>",
                           th(year(0)), th(year(1)), th(year(0)), th(year(1))))
        .when(k == 4, text(th(dated("December 31", 0)), th(dated("September 30", 0)), th(dated("December 31", 1))))
        .when(k == 6, text(th(year(3), 2), th(year(4), 2))).otherwise(text(th(year(0), 2), th(year(1), 2)))
    )
    title = F.when(k == 7, text("<p>CONSOLIDATED STATEMENTS OF OPERATIONS", F.repeat(F.lit(" of the company and its holdings"), 20), "</p>")).otherwise(
        F.lit("<p><b>CONSOLIDATED STATEMENTS OF OPERATIONS</b></p>"))
    page = text(
        "<html><body>", title, F.when(k == 5, "").otherwise("<p>(in thousands)</p>"), "<table><tr><td></td>", head, "</tr>",
        row("Revenue", F.col("revenue")), row("Income tax expense", F.col("tax") + 5000),
        F.when(k == 1, "<tr><td>Effective tax rate</td><td></td><td>21%</td><td></td><td>20%</td></tr>").otherwise(""),
        F.when((k == 0) & (y % 2 == 0), "<tr><td>Store count</td><td>5</td><td>6</td><td>7</td><td>8</td></tr>").otherwise(""),
        "</table></body></html>")
    return f.select(
        F.concat_ws("-", "suppkey", "fy").alias("filing_id"), F.col("suppkey").cast("string").alias("cik"),
        F.make_date("fy", F.lit(12), F.lit(31)).alias("period_end"), F.lit(True).alias("annual"), page.alias("html"))


def statement_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annual statements of suppliers as HTML: (filing_id, cik, period_end, annual, html).

    Large suppliers print thousands, small ones whole dollars; the columns run from the larger
    year to the smaller one; noise tags, a reconciliation table and a balance sheet are around.
    """
    f = facts(spark, sf_dir)
    names = [c for _, c in PRINTED]
    before = f.select("suppkey", (F.col("fy") + 1).alias("fy"), *[F.col(c).alias(f"p_{c}") for c in names])
    # pages are few bytes to render from but dear to read, so they are spread before they grow
    both = f.join(before, ["suppkey", "fy"], "left").repartition(
        int(spark.conf.get("spark.sql.shuffle.partitions")))
    big = F.col("revenue") >= 1_000_000
    first = F.coalesce(F.col("p_revenue") <= F.col("revenue"), F.lit(True))

    def cell(c: str) -> Column:
        shown = F.when(big & F.lit(c != "qty"), F.floor(F.col(c) / 1000)).otherwise(F.col(c))
        return F.coalesce(F.concat(F.lit("<td>$</td><td>"), F.format_number(shown, 0), F.lit("</td>")),
                          F.lit("<td></td><td>—</td>"))

    def pair(a: Column, b: Column) -> Column:
        return F.when(first, F.concat(a, b)).otherwise(F.concat(b, a))

    rows = [
        F.concat(F.lit(f"<tr><td>{label}</td>"), pair(cell(c), cell(f"p_{c}")), F.lit("</tr>"))
        for label, c in PRINTED
    ]
    year = lambda y: F.concat(F.lit('<th colspan="2">'), y.cast("string"), F.lit("</th>"))
    caption = F.when(big, "<p>(in&nbsp;thousands)</p>").otherwise("<p>(unaudited)</p>")
    page = F.concat(
        F.lit("<html><head><style>td{color:red}</style></head><body><nav>Home | 9,999</nav><p>Supplier "),
        F.col("suppkey").cast("string"),
        F.lit(" reports results<p><b>CONSOLIDATED STATEMENTS OF OPERATIONS</b>"), caption,
        F.lit('<table><tr><td></td><td colspan="4">Year Ended December 31,</td></tr><tr><td></td>'),
        pair(year(F.col("fy")), year(F.col("fy") - 1)), F.lit("</tr>"), *rows,
        F.lit("</table><p>Reconciliation of GAAP to Adjusted EBITDA</p><table><tr><td></td><td>"),
        F.col("fy").cast("string"),
        F.lit("</td></tr><tr><td>Revenue</td><td>1</td></tr></table><h2>CONSOLIDATED BALANCE SHEETS"
              "</h2><table><tr><td></td><td>"), F.col("fy").cast("string"),
        F.lit("</td></tr><tr><td>Total assets</td><td>"), F.format_number(F.col("returned"), 0),
        F.lit("</td></tr></table><script>var x = '<table><tr><td>Revenue</td><td>5</td></tr>';</script></body></html>"),
    )
    return both.select(
        F.concat_ws("-", "suppkey", "fy").alias("filing_id"), F.col("suppkey").cast("string").alias("cik"),
        F.make_date("fy", F.lit(12), F.lit(31)).alias("period_end"), F.lit(True).alias("annual"),
        page.alias("html"),
    )


def exhibit_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statement pages as main exhibits, and two supplements each: one with a segment table that matters, one that
    does not and a balance sheet, one with a balance sheet alone. (…, exhibit_no)."""
    main = statement_pages(spark, sf_dir).withColumn("exhibit_no", F.lit(1))
    f = facts(spark, sf_dir)
    text = lambda *xs: F.concat(*[x if isinstance(x, Column) else F.lit(x) for x in xs])
    head = text("<tr><td></td><th>", F.col("fy").cast("string"), "</th><th>", (F.col("fy") - 1).cast("string"), "</th></tr>")
    row = lambda label, x: text(f"<tr><td>{label}</td><td>", F.format_number(F.floor(x / 1000), 0), "</td><td>1</td></tr>")
    balance = text("<h2>CONSOLIDATED BALANCE SHEETS</h2><table>", head, row("Total assets", F.col("revenue")), "</table>")
    second = text(
        "<html><body><p>Segment results (in thousands)</p><div><table>", head, row("Service charges on accounts", F.col("returned") + 1000),
        row("Advisory fee revenue", F.col("sm") + 1000), "</table></div>", balance,
        "<p>Operating segments (in thousands)</p><table>", head, row("Stores of the east", F.col("ga")), "</table></body></html>")
    third = text("<html><body>", balance, "</body></html>")
    more = f.select(
        F.concat_ws("-", "suppkey", "fy").alias("filing_id"), F.col("suppkey").cast("string").alias("cik"),
        F.make_date("fy", F.lit(12), F.lit(31)).alias("period_end"), F.lit(True).alias("annual"),
        F.posexplode(F.array(second, third)).alias("pos", "html")).withColumn("exhibit_no", F.col("pos") + 2).drop("pos")
    return main.unionByName(more)


def supplier_concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier's concept list."""
    rows = F.array(*[
        F.struct(*[F.lit(v).alias(n) for v, n in zip(c, ("concept_id", "concept", "label", "path"))])
        for c in CONCEPTS
    ])
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("cik"), F.inline(rows)
    ).withColumn("taxonomy_key", F.col("concept")).withColumn(
        "concept_ord", F.struct("path", "concept_id"))


def orders_of_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the month their customer's fiscal year ends in."""
    o = table(spark, sf_dir, "orders").withColumn("d", F.col("o_orderdate").cast("date"))
    c = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), (F.col("c_nationkey") % 12 + 1).alias("fye"))
    return o.join(c, "o_custkey")


CUSTOMER_ORDERS_SQL = """customer_orders AS (
  SELECT o.*, CAST(o_orderdate AS DATE) AS d, c_nationkey % 12 + 1 AS fye
  FROM orders o JOIN customer c ON o_custkey = c_custkey)"""


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as filings of their customers: status gives the form, priority the 8-K items.

    ``pos`` counts from the newest filing of a company, as a filing list does.
    """
    form = F.when(F.col("o_orderstatus") == "F", "10-Q").when(
        F.col("o_orderstatus") == "P", "10-K").otherwise("8-K")
    filed = F.date_add("d", 35)
    lag = (F.floor("o_totalprice") % 45).cast("int")
    o = orders_of_customers(spark, sf_dir)
    return o.select(
        F.col("o_custkey").alias("cik"), F.col("o_orderkey").alias("accession"),
        (-(F.datediff("d", F.lit("1990-01-01").cast("date")).cast("bigint") * 100_000_000_000
           + F.col("o_orderkey"))).alias("pos"),
        form.alias("form"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "2.02,9.01").otherwise("8.01").alias("items"),
        F.concat(F.lit("doc"), F.col("o_orderkey").cast("string"), F.lit(".htm")).alias("primary_doc"),
        F.when(form == "8-K", F.date_sub(filed, lag)).otherwise(F.col("d")).alias("report_date"),
        filed.alias("filing_date"), F.col("fye").alias("fye_month"),
    )


SUBMISSIONS_SQL = CUSTOMER_ORDERS_SQL + """, subs AS (
  SELECT o_custkey AS cik, o_orderkey AS accession,
    -(CAST(date_diff('day', DATE '1990-01-01', d) AS BIGINT) * 100000000000 + o_orderkey) AS pos,
    CASE o_orderstatus WHEN 'F' THEN '10-Q' WHEN 'P' THEN '10-K' ELSE '8-K' END AS form,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN '2.02,9.01' ELSE '8.01' END AS items,
    'doc' || o_orderkey || '.htm' AS primary_doc,
    CAST(CASE WHEN o_orderstatus IN ('F', 'P') THEN d
      ELSE d + 35 - CAST(CAST(floor(o_totalprice) AS BIGINT) % 45 AS INTEGER) END AS DATE) AS report_date,
    CAST(d + 35 AS DATE) AS filing_date, fye AS fye_month
  FROM customer_orders)"""


def stored_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values on file per customer: order volume and count by quarter and by year."""
    o = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("cik"), F.col("o_orderdate").cast("date").alias("d"),
        whole(F.col("o_totalprice")).alias("v"), "o_orderpriority")
    concept = F.inline(F.array(
        F.struct(F.lit("revenue").alias("concept_id"), F.col("s").cast("double").alias("value")),
        F.struct(F.lit("net interest").alias("concept_id"), F.col("u").cast("double").alias("value")),
    ))
    urgent = F.sum(F.when(F.col("o_orderpriority") == "1-URGENT", F.col("v")))
    quarterly = o.groupBy("cik", F.year("d").alias("fiscal_year"), F.quarter("d").alias("quarter")).agg(
        F.sum("v").alias("s"), urgent.alias("u")
    ).select("cik", F.lit("quarterly").alias("period_type"), "fiscal_year", "quarter",
             F.last_day(F.make_date("fiscal_year", F.col("quarter") * 3, F.lit(1))).alias("end_date"), concept)
    annual = o.groupBy("cik", F.year("d").alias("fiscal_year")).agg(
        F.sum("v").alias("s"), urgent.alias("u")
    ).select("cik", F.lit("annual").alias("period_type"), "fiscal_year", F.lit(None).cast("int").alias("quarter"),
             F.make_date("fiscal_year", F.lit(12), F.lit(31)).alias("end_date"), concept)
    return quarterly.unionByName(annual).filter("value is not null")


STORED_SQL = """stored AS (
  SELECT cik, period_type, fiscal_year, quarter, end_date, concept_id, CAST(value AS DOUBLE) AS value FROM (
    SELECT cik, period_type, fiscal_year, quarter, end_date, unnest(['revenue', 'net interest']) AS concept_id,
      unnest([s, u]) AS value
    FROM (
      SELECT o_custkey AS cik, 'quarterly' AS period_type, CAST(year(o_orderdate) AS INTEGER) AS fiscal_year,
        CAST(quarter(o_orderdate) AS INTEGER) AS quarter, last_day(max(CAST(date_trunc('quarter', o_orderdate) AS DATE)) + INTERVAL 2 MONTH) AS end_date,
        sum(CAST(floor(o_totalprice) AS BIGINT)) AS s,
        sum(CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(floor(o_totalprice) AS BIGINT) END) AS u
      FROM orders GROUP BY 1, 2, 3, 4
      UNION ALL
      SELECT o_custkey, 'annual', CAST(year(o_orderdate) AS INTEGER), NULL, make_date(CAST(year(max(o_orderdate)) AS INTEGER), 12, 31),
        sum(CAST(floor(o_totalprice) AS BIGINT)),
        sum(CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(floor(o_totalprice) AS BIGINT) END)
      FROM orders GROUP BY 1, 2, 3))
  WHERE value IS NOT NULL)"""


# Figures a supplier reports, as expressions over ``facts`` that read the same in both dialects.
WIDE = [
    ("gp", "revenue - cost - CAST(floor(returned / 20) AS BIGINT)"),
    ("oi", "revenue - cost - tax * 5"),
    ("opsub", "rd + sm + ga"),
    ("opex", "CASE WHEN n_lines % 2 = 0 THEN revenue - cost - tax * 5 ELSE cost + rd + sm + ga END"),
    ("ni", "revenue - cost - tax * 6"),
    ("sh_d", "qty + n_lines"),
    ("eps_b", "CAST(floor(CAST((revenue - cost - tax * 6) * 100 AS DOUBLE) / qty) AS DOUBLE) / CAST(100 AS DOUBLE)"),
    ("eps_d", "CAST(floor(CAST((revenue - cost - tax * 6) * 100 AS DOUBLE) / greatest(1, qty + CASE WHEN returned * 3 > revenue "
              "THEN 0 - n_lines ELSE n_lines END)) AS DOUBLE) / CAST(100 AS DOUBLE)"),
    ("int_inc", "n_lines * 500"),
    ("int_exp", "CASE WHEN qty % 2 = 0 THEN n_lines * 1000 END"),
    ("pretax", "revenue - cost - tax * 5 + CASE WHEN tax % 2 = 0 THEN n_lines * 500 - CASE WHEN qty % 2 = 0 "
               "THEN n_lines * 1000 ELSE 0 END ELSE 0 END"),
    ("dup", "CASE WHEN n_lines % 3 = 0 THEN revenue - cost - tax * 6 WHEN n_lines % 3 = 1 THEN revenue END"),
    ("leak", "CASE WHEN sm > rd THEN revenue END"),
    ("comp", "CASE WHEN rd > sm THEN n_lines END"),
    ("debt", "CASE WHEN tax % 2 = 0 THEN (CAST(floor(revenue / 100000000) AS BIGINT) + 1) * 100000000 END"),
    ("opcf", "CAST(floor(revenue / 3) AS BIGINT)"),
]
METRICS = [
    ("Revenue", "revenue"), ("Cost of revenue", "cost"), ("Gross profit", "gp"), ("Operating income", "oi"),
    ("Operating expenses", "opsub"), ("Total operating expenses", "opex"), ("Net income", "ni"),
    ("Basic earnings per share", "eps_b"), ("Diluted earnings per share", "eps_d"),
    ("Weighted average shares outstanding: diluted", "sh_d"), ("net  income", "dup"),
    ("Adjusted operating income", "leak"), ("Diluted EPS and more / Diluted net income", "comp"),
    ("Long-term debt", "debt"), ("Income before taxes", "pretax"), ("Provision for income taxes", "tax"),
    ("Research and development", "rd"), ("Sales and marketing", "sm"), ("General and administrative", "ga"),
    ("Interest expense", "int_exp"), ("Free cash flow", "returned"),
    ("Net cash provided by operating activities", "opcf"), ("Purchases of property and equipment", "rd"),
    ("Less: purchases of property", "sm"), ("Interest income", "int_inc"),
]


def wide_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts(spark, sf_dir).select(
        F.concat_ws("-", "suppkey", "fy").alias("filing_id"), "*", *[F.expr(e).alias(n) for n, e in WIDE])


def metric_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of supplier filings, one row per key, with the flaws that the checks look for."""
    rows = F.array(*[
        F.struct(F.lit(k).alias("key"), F.lit(i).cast("bigint").alias("key_ord"),
                 F.col(c).cast("double").alias("num_value"))
        for i, (k, c) in enumerate(METRICS)
    ])
    return wide_metrics(spark, sf_dir).select(
        "filing_id", F.col("suppkey").cast("string").alias("cik"), F.inline(rows)
    ).filter("num_value is not null").withColumn("str_value", F.lit(None).cast("string"))


METRICS_SQL = FACTS_SQL + """, m AS (
  SELECT suppkey || '-' || fy AS filing_id, *, """ + ", ".join(f"{e} AS {n}" for n, e in WIDE) + """ FROM facts),
 ml AS (""" + " UNION ALL ".join(
    f"SELECT filing_id, '{k}' AS key, {i} AS key_ord, CAST({c} AS DOUBLE) AS v FROM m WHERE {c} IS NOT NULL"
    for i, (k, c) in enumerate(METRICS)) + ")"
