"""Pages, tables, chunks and captions; ``render_extract`` is the flagship."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import chunks as CH, concepts as C, merge as M, quality as Q, tables as TB
from ..session import spread, work_dir
from ..sources import html, responses as RS
from . import extraction as X, inputs as I
from .catalogue import query


@query("render_extract", f"""
WITH {I.FACTS_SQL},
 s AS (SELECT suppkey, fy, CASE WHEN revenue >= 1000000 THEN 1000 ELSE 1 END AS u, * EXCLUDE (suppkey, fy) FROM facts),
 p AS (SELECT suppkey, fy, CAST(revenue // u * u AS DOUBLE) AS c01, CAST(cost // u * u AS DOUBLE) AS c02, CAST(rd // u * u AS DOUBLE) AS c04,
   CAST(sm // u * u AS DOUBLE) AS c05, CAST(ga // u * u AS DOUBLE) AS c06, CAST(tax // u * u AS DOUBLE) AS c10,
   CAST(CASE WHEN qty < 100000000 THEN qty * u ELSE qty END AS DOUBLE) AS c12 FROM s),
 d AS (SELECT *, c01 - c02 AS c03, c01 - c02 - (c04 + c05 + c06) AS c08 FROM p),
 e AS (SELECT *, c03 - c08 AS c07, c08 AS c09, c08 - c10 AS c11, (c08 - c10) / c12 AS c13, c03 / c01 * 100 AS c14 FROM d),
 v AS (UNPIVOT e ON c01, c02, c03, c04, c05, c06, c07, c08, c09, c10, c11, c12, c13, c14 INTO NAME concept_id VALUE value)
SELECT CAST(suppkey AS VARCHAR) || '-' || fy AS filing_id, concept_id, floor(value * 10000) / 10000 AS value,
  concept_id IN ('c03', 'c07', 'c08', 'c09', 'c11', 'c13', 'c14') AS derived
FROM v WHERE NOT (concept_id = 'c13' AND abs(value) > 1000) AND NOT (concept_id = 'c14' AND abs(value) > 200)""")
def render_extract(spark, sf_dir):
    out = X.extract(I.statement_pages(spark, sf_dir), I.supplier_concepts(spark, sf_dir))
    return out.values.select(
        "filing_id", "concept_id", (F.floor(F.col("value") * 10000) / 10000).alias("value"), "derived")


@query("two_exhibits", f"""
WITH {I.FACTS_SQL}, x(k, c, e, t, r) AS (VALUES ('Revenue', 1, 1, 0, 0), ('Cost of Revenue', 2, 1, 0, 1), ('Research and development', 3, 1, 0, 2),
  ('Sales and marketing', 4, 1, 0, 3), ('General and administrative', 5, 1, 0, 4), ('Income tax expense', 6, 1, 0, 5),
  ('Weighted average shares outstanding, basic', 7, 1, 0, 6), ('Service charges on accounts', 8, 2, 0, 0), ('Advisory fee revenue', 9, 2, 0, 1)),
 s AS (SELECT *, CASE WHEN revenue >= 1000000 THEN 1000 ELSE 1 END AS u FROM facts)
SELECT suppkey || '-' || fy AS filing_id, k AS key, e AS exhibit_no, t AS table_idx, r AS row_idx, CAST(CASE c WHEN 1 THEN revenue // u * u
  WHEN 2 THEN cost // u * u WHEN 3 THEN rd // u * u WHEN 4 THEN sm // u * u WHEN 5 THEN ga // u * u WHEN 6 THEN tax // u * u
  WHEN 7 THEN CASE WHEN qty < 100000000 THEN qty * u ELSE qty END WHEN 8 THEN (returned + 1000) // 1000 * 1000
  ELSE (sm + 1000) // 1000 * 1000 END AS DOUBLE) AS value FROM s, x""")
def two_exhibits(spark, sf_dir):
    """Merged metrics of all exhibits, and where in the filing each stood."""
    merged = M.merge(X.statement_metrics(X.read_tables(I.exhibit_pages(spark, sf_dir))))
    at = lambda bits, width: F.shiftright("key_ord", bits).bitwiseAND(2**width - 1)
    return merged.select(
        "filing_id", "key", (at(52, 10) + 1).alias("exhibit_no"), at(32, 20).alias("table_idx"), at(0, 32).alias("row_idx"),
        F.col("num_value").alias("value"))


@query("exhibit_counts", f"""
WITH {I.FACTS_SQL} SELECT suppkey || '-' || fy AS filing_id, e AS exhibit_no, t AS table_type, CAST(n AS BIGINT) AS n_tables
FROM facts, (VALUES (1, 'income_statement', 1), (1, 'non_gaap', 1), (1, 'balance_sheet', 1), (2, 'segment', 2), (2, 'balance_sheet', 1),
  (3, 'balance_sheet', 1)) x(e, t, n)""")
def exhibit_counts(spark, sf_dir):
    return TB.section_counts(X.read_tables(I.exhibit_pages(spark, sf_dir)), "filing_id", "exhibit_no")


@query("run_end_to_end", f"""
WITH {I.FACTS_SQL},
 s AS (SELECT suppkey, fy, CASE WHEN revenue >= 1000000 THEN 1000 ELSE 1 END AS u, * EXCLUDE (suppkey, fy) FROM facts),
 p AS (SELECT suppkey, fy, CAST(revenue // u * u AS DOUBLE) AS c01, CAST(cost // u * u AS DOUBLE) AS c02, CAST(rd // u * u AS DOUBLE) AS c04,
   CAST(sm // u * u AS DOUBLE) AS c05, CAST(ga // u * u AS DOUBLE) AS c06, CAST(tax // u * u AS DOUBLE) AS c10,
   CAST(CASE WHEN qty < 100000000 THEN qty * u ELSE qty END AS DOUBLE) AS c12, CAST((sm + 1000) // 1000 * 1000 AS DOUBLE) AS c15 FROM s),
 d AS (SELECT *, c01 - c02 AS c03, c01 - c02 - (c04 + c05 + c06) AS c08 FROM p),
 e AS (SELECT *, c03 - c08 AS c07, c08 AS c09, c08 - c10 AS c11, (c08 - c10) / c12 AS c13, c03 / c01 * 100 AS c14 FROM d),
 v AS (UNPIVOT (SELECT * FROM e WHERE c01 >= 100000)
  ON c01, c02, c03, c04, c05, c06, c07, c08, c09, c10, c11, c12, c13, c14, c15 INTO NAME c VALUE value)
SELECT suppkey || '-' || c AS concept_id, CAST(fy AS INTEGER) AS fiscal_year, floor(value * 10000) / 10000 AS value,
  c IN ('c03', 'c07', 'c08', 'c09', 'c11', 'c13', 'c14') AS calculated FROM v
WHERE NOT (c = 'c13' AND abs(value) > 1000) AND NOT (c = 'c14' AND abs(value) > 200)
UNION ALL SELECT CAST(suppkey AS VARCHAR), CAST(fy AS INTEGER), -1, false FROM e WHERE NOT c01 >= 100000""")
def run_end_to_end(spark, sf_dir):
    """Stored values of saved filings of three exhibits, and a row with -1 for each filing that the gate refused."""
    pages = I.exhibit_pages(spark, sf_dir)
    own = I.supplier_concepts(spark, sf_dir)
    fees = own.filter("concept_id = 'c01'").select(
        "cik", F.lit("c15").alias("concept_id"), F.lit("x:AdvisoryFees").alias("concept"), F.lit("Advisory fee revenue").alias("label"),
        F.lit("015").alias("path"), F.lit("x:AdvisoryFees").alias("taxonomy_key"), F.struct(F.lit("015").alias("path"), F.lit("c15").alias("concept_id")).alias("concept_ord"))
    concepts = own.unionByName(fees).withColumn("concept_id", F.concat_ws("-", "cik", "concept_id")).withColumn(
        "concept_ord", F.struct("path", "concept_id"))
    filings = pages.filter("exhibit_no = 1").select(
        "filing_id", "cik", F.lit("Co").alias("company_name"), F.lit(12).alias("fye_month"), F.lit("1231").alias("fye_code"),
        F.lit("").alias("period_text"), F.col("period_end").alias("report_date"), F.lit("annual").alias("period_override"),
        F.lit("2024-01-01").cast("timestamp").alias("loaded_at"))
    path = work_dir(spark, "values")
    gated = X.save(spark, X.extract(pages, concepts), filings, path)
    stored = spark.read.parquet(path).select(
        "concept_id", F.col("fiscal_year").cast("int").alias("fiscal_year"), (F.floor(F.col("value") * 10000) / 10000).alias("value"), "calculated")
    refused = gated.filter("not saved").select(
        F.col("cik").alias("concept_id"), F.year("report_date").alias("fiscal_year"), F.lit(-1.0).alias("value"), F.lit(False).alias("calculated"))
    return stored.unionByName(refused)


@query("statement_rows", f"""
WITH {I.FACTS_SQL}, x(k, c, i) AS (VALUES ('Revenue', 1, 0), ('Cost of Revenue', 2, 1), ('Research and development', 3, 2),
  ('Sales and marketing', 4, 3), ('General and administrative', 5, 4), ('Income tax expense', 6, 5), ('Weighted average shares outstanding, basic', 7, 6)),
 s AS (SELECT *, CASE WHEN revenue >= 1000000 THEN 1000 ELSE 1 END AS u FROM facts)
SELECT suppkey || '-' || fy AS filing_id, k AS key, CAST(CASE c WHEN 1 THEN revenue // u * u WHEN 2 THEN cost // u * u
  WHEN 3 THEN rd // u * u WHEN 4 THEN sm // u * u WHEN 5 THEN ga // u * u WHEN 6 THEN tax // u * u
  ELSE CASE WHEN qty < 100000000 THEN qty * u ELSE qty END END AS DOUBLE) AS value FROM s, x""")
def statement_rows(spark, sf_dir):
    return X.statement_metrics(X.read_tables(I.statement_pages(spark, sf_dir))).select(
        "filing_id", "key", F.col("num_value").alias("value"))


@query("statement_shapes", f"""
WITH {I.FACTS_SQL}, s AS (SELECT *, suppkey % 8 AS k, CASE WHEN suppkey % 8 = 5 THEN 1 ELSE 1000 END AS u FROM facts)
SELECT suppkey || '-' || fy AS filing_id, 'Revenue' AS key, CAST(revenue // u * u AS DOUBLE) AS value, k = 6 AS is_stale FROM s
UNION ALL SELECT suppkey || '-' || fy, 'Income tax expense', CAST((tax + 5000) // u * u * CASE WHEN k = 2 THEN -1 ELSE 1 END AS DOUBLE), k = 6 FROM s
UNION ALL SELECT suppkey || '-' || fy, 'Effective tax rate', 21.0, false FROM s WHERE k = 1""")
def statement_shapes(spark, sf_dir):
    return X.statement_metrics(X.read_tables(I.shaped_pages(spark, sf_dir))).select(
        "filing_id", "key", F.col("num_value").alias("value"), "is_stale")


@query("statement_rejects", f"""
WITH {I.FACTS_SQL} SELECT suppkey || '-' || fy AS filing_id, 'Store count' AS key, CAST(4 AS INTEGER) AS n_cells
FROM facts WHERE suppkey % 8 = 0 AND fy % 2 = 0""")
def statement_rejects(spark, sf_dir):
    return X.statement_rejects(X.read_tables(I.shaped_pages(spark, sf_dir))).select("filing_id", "key", "n_cells")


@query("section_counts", f"""
WITH {I.FACTS_SQL} SELECT suppkey || '-' || fy AS filing_id, t AS table_type, CAST(1 AS BIGINT) AS n_tables
FROM facts, (VALUES ('income_statement'), ('non_gaap'), ('balance_sheet')) x(t)""")
def section_counts(spark, sf_dir):
    return TB.section_counts(X.read_tables(I.statement_pages(spark, sf_dir)), "filing_id")


# heading, body cell, class
_HEADS = [
    ("Revenue by Segment", "constant currency is a non-GAAP measure", "segment"),
    ("Supplemental table 3", "Interest income on loans held for sale; total assets", "segment"),
    ("Reconciliation of GAAP to adjusted", "Adjusted EBITDA", "non_gaap"),
    ("Consolidated Statements of Operations", "Adjusted net income", "income_statement"),
    ("Selected figures", "Total revenues and other", "income_statement"),
    ("Condensed statement", "Net cash provided by operating activities", "cash_flow"),
    ("Consolidated Balance Sheets", "Total assets", "balance_sheet"),
    ("Highlights", "Operating segments of the group", "segment"),
    ("Contacts", "Jane Roe, ir@example.com", "drop"),
    ("Full-year outlook", "we expect growth of 5", "drop"),
    ("Notes", "(1) See the notes", "drop"),
    ("Compensation", "Stock-based compensation included in cost", "drop"),
    ("Key data", "Stores opened", "other"),
]


def _headed_tables(spark, sf_dir):
    n = (F.col("o_orderkey") % len(_HEADS) + 1).cast("int")
    pick = lambda i: F.element_at(F.array(*[F.lit(h[i]) for h in _HEADS]), n)
    return spread(I.table(spark, sf_dir, "orders")).select(
        F.col("o_orderkey").alias("filing_id"), F.lit(0).alias("table_idx"), F.lit(1).alias("exhibit_no"),
        F.when(F.col("o_orderstatus") == "F", "millions").alias("doc_scale"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "thousands").alias("near_scale"), pick(0).alias("context"),
        F.array(F.array(F.lit(""), F.year("o_orderdate").cast("string")),
                F.array(pick(1), F.format_number(F.floor("o_totalprice"), 0))).alias("rows"))


_TYPE_SQL = f"list_extract({[h[2] for h in _HEADS]}, CAST(o_orderkey % {len(_HEADS)} + 1 AS INTEGER))"


@query("classify_tables", f"SELECT o_orderkey AS filing_id, {_TYPE_SQL} AS table_type FROM orders")
def classify_tables(spark, sf_dir):
    return TB.classify(_headed_tables(spark, sf_dir)).select("filing_id", "table_type")


@query("caption_injection", f"""
SELECT o_orderkey AS filing_id, CASE WHEN {_TYPE_SQL} NOT IN ('income_statement', 'cash_flow', 'balance_sheet', 'segment') THEN ''
  WHEN o_orderpriority = '1-URGENT' THEN '(in thousands)' WHEN o_orderstatus = 'F' THEN '(in millions)' ELSE '' END AS caption FROM orders""")
def caption_injection(spark, sf_dir):
    return TB.entries(TB.classify(_headed_tables(spark, sf_dir))).select(
        "filing_id", F.regexp_extract("entry", r"^(\(in [a-z]+\))\n", 1).alias("caption"))


@query("selected_tables", f"""
WITH t AS (SELECT o_custkey AS filing_id, o_orderkey AS table_idx, {_TYPE_SQL} AS tt, o_orderstatus = 'F' AS drop FROM orders),
 g AS (SELECT filing_id, bool_or(tt IN ('income_statement', 'cash_flow', 'balance_sheet', 'segment')) AS gaap, bool_or(tt = 'other' AND NOT drop) AS kept
  FROM t WHERE tt NOT IN ('drop', 'non_gaap') GROUP BY 1)
SELECT filing_id, table_idx FROM t JOIN g USING (filing_id) WHERE tt IN ('income_statement', 'segment')
  OR (tt = 'other' AND (NOT drop OR (NOT kept AND NOT gaap)))""")
def selected_tables(spark, sf_dir):
    o = I.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("table_idx"), F.col("o_custkey").alias("cust"), "o_orderstatus")
    tables = TB.classify(_headed_tables(spark, sf_dir)).drop("table_idx").withColumnRenamed("filing_id", "table_idx").join(
        o.select("table_idx", F.col("cust").alias("filing_id")), "table_idx")
    keep = o.filter("o_orderstatus = 'F'").select(F.col("cust").alias("filing_id"), "table_idx", F.lit(False).alias("keep"))
    return TB.selected_entries(tables, "filing_id", keep).select("filing_id", "table_idx")


@query("keep_flags", """
SELECT o_orderkey AS filing_id, i AS cand_idx, CASE WHEN o_orderstatus = 'P' THEN true ELSE NOT (i = 1 OR (i = 0 AND o_orderpriority = '1-URGENT')) END AS keep
FROM orders, (VALUES (0), (1), (2)) x(i)""")
def keep_flags(spark, sf_dir):
    o = I.table(spark, sf_dir, "orders")
    body = F.concat(F.lit('{"0": '), (F.col("o_orderpriority") != "1-URGENT").cast("string"), F.lit(', "1": false}'))
    answers = o.select(F.col("o_orderkey").alias("filing_id"),
                       F.when(F.col("o_orderstatus") == "P", "no json").otherwise(body).alias("text"))
    cand = o.select(F.col("o_orderkey").alias("filing_id"), F.explode(F.array(*[F.lit(i) for i in range(3)])).alias("cand_idx"))
    return RS.keep_flags(answers, cand, "filing_id")


@query("exhibit_index", """
SELECT o_orderkey AS page_id, i AS exhibit_no, u AS url FROM (
  SELECT o_orderkey, 1 AS i, 'https://www.sec.gov/a/' || o_orderkey || '.htm' AS u FROM orders
  UNION ALL SELECT o_orderkey, 2, 'https://x.example/' || o_orderkey FROM orders WHERE o_orderstatus = 'F')""")
def exhibit_index(spark, sf_dir):
    k = F.col("o_orderkey").cast("string")
    kind = F.when(F.col("o_orderstatus") == "F", "ex-99.2").otherwise("GRAPHIC")
    page = F.concat(
        F.lit('<table class="tableFile"><tr><th>Seq</th><th>Description</th><th>Document</th><th>Type</th></tr>'
              "<tr><td>1<td>8-K<td><a href='/m.htm'>m</a><td>8-K<td>9</tr><tr><td>2</td><td>Release</td><td><a href=\"/a/"), k,
        F.lit('.htm">r</a></td><td> EX-99.1 </td><td>5</td></tr><tr><td>3</td><td>Supplement</td><td><a href=https://x.example/'), k,
        F.lit(">s</a></td><td>"), kind, F.lit("</td></tr><tr><td>EX-99.3</td></tr></table>"))
    pages = I.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("page_id"), page.alias("html"))
    return html.exhibit_links(pages, "page_id")


@query("envelope_strip", "SELECT page_id, md5(trim(html)) AS h, CASE WHEN page_id % 5 = 0 THEN 'failed' ELSE 'html' END AS kind FROM pages")
def envelope_strip(spark, sf_dir):
    wrapped = F.concat(F.lit("<DOCUMENT>\n<TYPE>EX-99.1\n<text>\n"), F.col("html"))
    page = F.when(F.col("page_id") % 2 == 0, wrapped).otherwise(F.col("html"))
    url = F.when(F.col("page_id") % 5 == 0, "").otherwise(F.col("url"))
    return I.table(spark, sf_dir, "pages").select(
        "page_id", F.md5(F.trim(T.strip_envelope(page))).alias("h"), html.document_type(url).alias("kind"))


@query("page_text", r"""
WITH a AS (SELECT page_id, url, regexp_replace(regexp_replace(html,
    '(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>|<nav\b.*?</nav>|<footer\b.*?</footer>', chr(1), 'g'), '<[^>]*>', chr(1), 'g') AS t FROM pages),
 n AS (SELECT page_id, url, list_filter(list_transform(string_split(t, chr(1)), lambda x: trim(regexp_replace(
    replace(replace(replace(replace(x, '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&'), '\s+', ' ', 'g'))), lambda x: x <> '') AS nodes FROM a)
SELECT page_id, url, md5(array_to_string(nodes, chr(10))) AS h, CAST(len(nodes) AS INTEGER) AS n_nodes FROM n""")
def page_text(spark, sf_dir):
    """The whole text of every page outside menus, scripts and the like, a line a text node."""
    segments = html.page_segments(spread(I.table(spark, sf_dir, "pages")).select("page_id", "url", "html"))
    return segments.select("page_id", "url", F.md5(html.prose(F.col("segments"))).alias("h"),
                           F.size(F.flatten(F.transform("segments", lambda s: s["nodes"]))).alias("n_nodes"))


_SIZE, _OVER = 2000, 300


@query("chunk_documents", f"""
WITH RECURSIVE d AS (SELECT doc_id, text, length(text) AS n FROM documents),
 c AS (
  SELECT doc_id, text, n, 0 AS chunk_idx, 0 AS s, CASE WHEN n <= {_SIZE} THEN n ELSE CASE
    WHEN strpos(reverse(substr(text, {_SIZE - 200 + 1}, 200)), chr(10)) > 0 THEN {_SIZE} - strpos(reverse(substr(text, {_SIZE - 200 + 1}, 200)), chr(10)) + 1
    ELSE {_SIZE} END END AS e FROM d
  UNION ALL
  SELECT doc_id, text, n, i, s2, CASE WHEN s2 + {_SIZE} >= n THEN n
     WHEN strpos(reverse(substr(text, s2 + {_SIZE - 200 + 1}, 200)), chr(10)) > 0
       THEN s2 + {_SIZE} - strpos(reverse(substr(text, s2 + {_SIZE - 200 + 1}, 200)), chr(10)) + 1 ELSE s2 + {_SIZE} END
  FROM (SELECT doc_id, text, n, chunk_idx + 1 AS i, CASE
      WHEN strpos(substr(text, greatest(s + 1, e - {_OVER}) + 1, least(greatest(s + 1, e - {_OVER}) + 200, e - 1) - greatest(s + 1, e - {_OVER})), chr(10)) > 0
      THEN greatest(s + 1, e - {_OVER}) + strpos(substr(text, greatest(s + 1, e - {_OVER}) + 1, least(greatest(s + 1, e - {_OVER}) + 200, e - 1) - greatest(s + 1, e - {_OVER})), chr(10))
      ELSE greatest(s + 1, e - {_OVER}) END AS s2 FROM c WHERE e < n))
SELECT doc_id, CAST(chunk_idx AS INTEGER) AS chunk_idx, md5(substr(text, s + 1, e - s)) AS h FROM c""")
def chunk_documents(spark, sf_dir):
    docs = spread(I.table(spark, sf_dir, "documents")).select("doc_id", "text")
    return CH.chunk(docs, size=_SIZE, overlap=_OVER).select("doc_id", "chunk_idx", F.md5("chunk").alias("h"))


@query("boilerplate_cut", """
SELECT doc_id, md5(CASE WHEN length(text) > 100 THEN regexp_replace(text, '\\s+$', '') ELSE text END) AS h FROM documents""")
def boilerplate_cut(spark, sf_dir):
    tail = F.lit("\n\nForward-Looking Statements\nmay differ")
    t = F.when(F.length("text") > 100, F.concat("text", tail)).otherwise(F.col("text"))
    return I.table(spark, sf_dir, "documents").select("doc_id", F.md5(T.strip_boilerplate(t)).alias("h"))


@query("prescan_scale", """
SELECT doc_id, CASE WHEN n_chars % 4 = 0 AND doc_id % 3 = 0 THEN CASE WHEN doc_id % 2 = 0 THEN 'billions' ELSE '' END
   WHEN n_chars % 4 > doc_id % 3 THEN 'thousands' WHEN n_chars % 4 < doc_id % 3 THEN 'millions' ELSE 'thousands' END AS scale,
  doc_id % 2 = 0 AS shares_apart, 'Three Months Ended March 31, ' || (2000 + doc_id % 20) AS period
FROM documents""")
def prescan_scale(spark, sf_dir):
    i, n = F.col("doc_id"), F.col("n_chars")
    rep = lambda s, k: F.expr(f"repeat('{s}', CAST({k} AS INT))")
    t = F.concat(
        rep("\n(in\\u00a0thousands)", "n_chars % 4"), F.lit("\nThree Months Ended March 31, "), (2000 + i % 20).cast("string"),
        F.lit("\n"), F.col("text"), rep("\n(Amounts in millions, unaudited)", "doc_id % 3"),
        F.when(i % 2 == 0, "\nDollars in billions, number of shares in thousands\n").otherwise("\n"))
    return I.table(spark, sf_dir, "documents").withColumn("t", t).select(
        "doc_id", F.coalesce(T.dominant_scale(F.col("t")), F.lit("")).alias("scale"),
        T.shares_scale(F.col("t")).isNotNull().alias("shares_apart"), T.period_phrase(F.col("t")).alias("period"))


@query("grounding", """
WITH d AS (SELECT doc_id, replace(lower(text), ',', '') AS digits FROM documents)
SELECT doc_id AS filing_id, 'Invented' AS key FROM d WHERE NOT (contains(digits, '12345678') AND contains(digits, CAST(doc_id AS VARCHAR)))""")
def grounding(spark, sf_dir):
    docs = spread(I.table(spark, sf_dir, "documents")).select(F.col("doc_id").alias("filing_id"), F.col("text").alias("raw_text"))
    k = F.col("filing_id").cast("string")
    rows = F.array(
        F.struct(F.lit("Quoted").alias("key"), F.concat(F.lit("| "), F.upper(F.substring("raw_text", 5, 40))).alias("snippet")),
        F.struct(F.lit("Invented").alias("key"), F.concat(F.lit("Total made up 12,345,678 and $"), k).alias("snippet")),
        F.struct(F.lit("Wordless").alias("key"), F.lit("nothing numeric zzqq").alias("snippet")))
    snips = docs.select("filing_id", F.inline(rows))
    metrics = snips.select("filing_id", "key", F.lit(1.0).alias("num_value"), F.lit(None).cast("string").alias("str_value"))
    return Q.source_grounding(snips, metrics, docs).select("filing_id", F.col("keys")[0].alias("key"))


@query("multi_column_hint", """
WITH o AS (SELECT o_orderkey, quarter(o_orderdate) AS q, year(o_orderdate) + 10 AS y FROM orders)
SELECT o_orderkey, CAST(3 AS INTEGER) AS n, 'Q' || q || y AS latest FROM o""")
def multi_column_hint(spark, sf_dir):
    q, y = F.quarter("o_orderdate").cast("string"), F.year("o_orderdate") + 10
    yy = lambda k: F.lpad(((y - k) % 100).cast("string"), 2, "0")
    t = F.concat(F.lit("| "), q, F.lit("Q"), yy(2), F.lit(" | Q"), q, F.lit(" "), y.cast("string"),
                 F.lit(" | Q"), q, F.lit("'"), yy(1), F.lit(" | Q"), q, F.lit("-"), y.cast("string"), F.lit(" |"))
    return I.table(spark, sf_dir, "orders").withColumn("h", T.latest_quarter(t)).select(
        "o_orderkey", "h.n", "h.latest")


@query("clean_chunk", """
SELECT c_custkey, c_name || ' net & gross <b>' || chr(10) || '| a | b |' || chr(10) || 'end ' || c_mktsegment AS clean FROM customer""")
def clean_chunk(spark, sf_dir):
    t = F.concat(F.lit("  "), F.col("c_name"), F.lit("&nbsp;&#160;net  &amp; gross &lt;b&gt; \n\n| a | | | b |​\n  | |  \nend "),
                 F.col("c_mktsegment"))
    return I.table(spark, sf_dir, "customer").select("c_custkey", T.clean_chunk(t).alias("clean"))


@query("compact_values", """
WITH f AS (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS v FROM orders)
SELECT o_orderkey, CASE WHEN v < 1000 THEN CAST(v AS VARCHAR) ELSE regexp_replace(CAST(CAST(CASE WHEN v >= 100000 THEN round_even(v / 1000.0::DOUBLE, 0)
  WHEN v >= 10000 THEN round_even(v / 1000.0::DOUBLE, 1) ELSE round_even(v / 1000.0::DOUBLE, 2) END AS DECIMAL(20, 2)) AS VARCHAR), '\\.?0+$', '') || 'K' END AS c
FROM f""")
def compact_values(spark, sf_dir):
    v = I.whole(F.col("o_totalprice"))
    return I.table(spark, sf_dir, "orders").select(
        "o_orderkey", T.compact_value(v.cast("double")).alias("c"))


@query("row_scan", f"""
WITH {I.METRICS_SQL}
SELECT filing_id, 'd1' AS concept_id, CAST(opcf AS DOUBLE) AS value FROM m WHERE opcf >= 1000
UNION ALL SELECT filing_id, 'd2', cost FROM m WHERE cost >= 1000
UNION ALL SELECT filing_id, 'd3', ga FROM m WHERE ga >= 1000
UNION ALL SELECT filing_id, 'd4', rd FROM m WHERE rd >= 1000""")
def row_scan(spark, sf_dir):
    rows = F.array(*[
        F.struct(F.lit(0).alias("table_idx"), F.lit(i).alias("row_idx"), F.lit(k).alias("key"), F.expr(e).cast("double").alias("value"))
        for i, (k, e) in enumerate([
            ("Card fees", "opcf"), ("Interest expense", "null"), ("Deposits", "cost"), ("Trading account liabilities", "ga"),
            ("Revenue:", "null"), ("Service charges on accounts", "rd"), ("Deposits", "n_lines * 100000")])])
    w = I.wide_metrics(spark, sf_dir)
    table_rows = C.parent_rows(w.select("filing_id", F.inline(rows)))
    missing = w.select("filing_id", F.inline(F.array(*[
        F.struct(F.lit(i).alias("concept_id"), F.lit(lb).alias("label"), F.lit(False).alias("is_segment"))
        for i, lb in [("d1", "Card  Fees"), ("d2", "Interest Expense, Deposits"), ("d3", "Interest Expense, Trading Liabilities"),
                      ("d4", "Revenue:, Service Charges"), ("d5", "Other comprehensive income"), ("d6", "Fee")]])))
    return C.scan_rows(missing, table_rows)


@query("extraction_prompts")
def extraction_prompts(spark, sf_dir):
    docs = I.table(spark, sf_dir, "documents")
    suppliers = I.table(spark, sf_dir, "supplier").count()
    filings = docs.select(
        F.col("doc_id").alias("filing_id"), F.pmod(F.col("doc_id"), F.lit(suppliers)).cast("string").alias("cik"),
        F.col("source").alias("company_name"), F.upper("source").alias("ticker"),
        F.lit(None).cast("date").alias("report_date"), F.lit(True).alias("annual"))
    chunks = CH.describe(CH.chunk(docs.select(F.col("doc_id").alias("filing_id"), "text")),
                         F.lit(None).cast("string"), F.lit(None).cast("string"))
    lists = C.concept_list(C.prompt_lines(I.supplier_concepts(spark, sf_dir)))
    return CH.extraction_prompts(chunks, lists, filings)


@query("key_sections", f"""
WITH {I.METRICS_SQL}
SELECT filing_id, key, CASE WHEN key IN ('Free cash flow', 'Net cash provided by operating activities') THEN 'cash_flow'
  WHEN key IN ('Basic earnings per share', 'Diluted earnings per share', 'Weighted average shares outstanding: diluted', 'Diluted EPS and more / Diluted net income',
    'Long-term debt', 'Income before taxes', 'Sales and marketing', 'General and administrative',
    'Purchases of property and equipment', 'Less: purchases of property') THEN CASE WHEN key LIKE '%arnings per share' OR key LIKE '%net income' THEN 'income_statement' ELSE '' END
  WHEN key = 'Provision for income taxes' THEN 'income_statement' ELSE 'income_statement' END AS section FROM ml""")
def key_sections(spark, sf_dir):
    return I.metric_rows(spark, sf_dir).select(
        "filing_id", "key", F.coalesce(T.key_section(F.col("key")), F.lit("")).alias("section"))


_CELL = "coalesce('$ | ' || format('{{:,}}', CASE WHEN big AND {scaled} THEN {c} // 1000 ELSE {c} END), ' | —')"
_PAIR = "CASE WHEN up THEN {a} || ' | ' || {b} ELSE {b} || ' | ' || {a} END"


def _row_sql(label: str, c: str) -> str:
    now, before = (_CELL.format(c=name, scaled="false" if name == "qty" else "true") for name in (c, f"p_{c}"))
    return f"'| {' '.join(label.split())} | ' || {_PAIR.format(a=now, b=before)} || ' |'"


# the texts of the statement pages: their head, the statement as rows of cells, and the prose
_TEXT_SQL = f"""{I.FACTS_SQL},
 pair AS (SELECT f.*, {", ".join(f"p.{c} AS p_{c}" for _, c in I.PRINTED)}, f.revenue >= 1000000 AS big, coalesce(p.revenue <= f.revenue, true) AS up
  FROM facts f LEFT JOIN facts p ON p.suppkey = f.suppkey AND p.fy = f.fy - 1),
 t AS (SELECT suppkey || '-' || fy AS filing_id, fy, 'Supplier ' || suppkey || ' reports results' || chr(10) || 'CONSOLIDATED STATEMENTS OF OPERATIONS' || chr(10)
   || CASE WHEN big THEN '(in thousands)' ELSE '(unaudited)' END AS head,
  concat_ws(chr(10), '|  | Year Ended December 31, |', '|  | ' || {_PAIR.format(a="fy", b="(fy - 1)")} || ' |', {", ".join(_row_sql(label, c) for label, c in I.PRINTED)}) AS md
  FROM pair),
 x AS (SELECT *, head || chr(10) || 'Reconciliation of GAAP to Adjusted EBITDA' || chr(10) || 'CONSOLIDATED BALANCE SHEETS' AS prose FROM t)"""


@query("assembled_text", f"""WITH {_TEXT_SQL}
SELECT filing_id, md5('=== GAAP INCOME STATEMENT ===' || chr(10) || head || chr(10) || md || chr(10) || chr(10) || '=== NARRATIVE ===' || chr(10) || prose) AS h FROM x""")
def assembled_text(spark, sf_dir):
    """The whole text that a filing without a model's help goes on with."""
    pages = html.page_segments(spread(I.statement_pages(spark, sf_dir)))
    story = pages.select("filing_id", T.strip_boilerplate(html.prose(F.col("segments"))).alias("prose"))
    text = TB.assembled_text(TB.selected_entries(TB.classify(TB.page_tables(pages)), "filing_id"), story, "filing_id")
    return text.select("filing_id", F.md5("raw_text").alias("h"))


@query("fallback_text", f"""WITH {_TEXT_SQL}
SELECT filing_id, md5(concat_ws(chr(10), prose, md, '|  | ' || fy || ' |', '| Revenue | 1 |')) AS h FROM x""")
def fallback_text(spark, sf_dir):
    """The whole text of a page read without its classes, balance sheets left out."""
    pages = html.page_segments(spread(I.statement_pages(spark, sf_dir)))
    story = pages.select("filing_id", html.prose(F.col("segments")).alias("prose"))
    return TB.fallback_text(TB.classify(TB.page_tables(pages)), story, "filing_id").select("filing_id", F.md5("raw_text").alias("h"))
