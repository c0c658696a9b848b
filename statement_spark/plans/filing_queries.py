"""Fiscal calendar, filing lists and period inference over the given tables."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fiscal
from ..operators import history as H, periods as PR
from ..sources import filings as FL, sinks
from . import inputs as I
from .catalogue import query


def _s(c):
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


@query("fiscal_period", f"""
WITH {I.CUSTOMER_ORDERS_SQL}
SELECT o_orderkey, CAST(year(d) + CASE WHEN month(d) > fye THEN 1 ELSE 0 END AS INTEGER) AS fiscal_year,
  CAST(((month(d) - (fye % 12 + 1) + 12) % 12) // 3 + 1 AS INTEGER) AS quarter
FROM customer_orders""")
def fiscal_period(spark, sf_dir):
    fy, q = fiscal.fiscal_period(F.col("d"), F.col("fye"))
    return I.orders_of_customers(spark, sf_dir).select(
        "o_orderkey", fy.alias("fiscal_year"), q.alias("quarter"))


@query("period_type_52_53", f"""
WITH {I.CUSTOMER_ORDERS_SQL}
SELECT o_orderkey, CASE WHEN month(d) = fye OR list_bool_or(list_transform([-1, 0, 1], lambda k:
    abs(date_diff('day', least(CAST(make_date(CAST(year(d) AS INTEGER) + k, fye, 1) + 29 AS DATE),
      last_day(make_date(CAST(year(d) AS INTEGER) + k, fye, 1))), d)) <= 7))
  THEN 'annual' ELSE 'quarterly' END AS period_type
FROM customer_orders""")
def period_type_52_53(spark, sf_dir):
    code = F.concat(F.lpad(F.col("fye").cast("string"), 2, "0"), F.lit("30"))
    return I.orders_of_customers(spark, sf_dir).select(
        "o_orderkey", fiscal.date_period_type(F.col("d"), F.col("fye"), code).alias("period_type"))


_PHRASES = {
    "1-URGENT": "Three Months Ended ", "2-HIGH": "Twenty-Six Weeks Ended ",
    "3-MEDIUM": "Nine Months Ended ", "4-NOT SPECIFIED": "Fiscal Year Ended ",
    "5-LOW": "Second Quarter ending ",
}


def _period_texts(spark, sf_dir):
    o = I.orders_of_customers(spark, sf_dir)
    phrase = F.element_at(F.create_map(*[F.lit(x) for kv in _PHRASES.items() for x in kv]), F.col("o_orderpriority"))
    return o.withColumn("period_text", F.concat(phrase, F.date_format("d", "MMMM d, yyyy")))


@query("period_text_parse", f"""
WITH {I.CUSTOMER_ORDERS_SQL}
SELECT o_orderkey, CAST(d AS VARCHAR) AS end_date,
  CASE o_orderpriority WHEN '1-URGENT' THEN 3 WHEN '2-HIGH' THEN 26 WHEN '3-MEDIUM' THEN 9 ELSE 0 END AS dur_count,
  CASE o_orderpriority WHEN '2-HIGH' THEN 'weeks' WHEN '1-URGENT' THEN 'months' WHEN '3-MEDIUM' THEN 'months' ELSE '' END AS dur_unit,
  CAST(CASE o_orderpriority WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 WHEN '5-LOW' THEN 2
    ELSE ((month(d) - (fye % 12 + 1) + 12) % 12) // 3 + 1 END AS INTEGER) AS quarter,
  CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN 'annual' ELSE 'quarterly' END AS period_type
FROM customer_orders""")
def period_text_parse(spark, sf_dir):
    t = F.col("period_text")
    _, q = fiscal.fiscal_period(F.lit("1990-01-01").cast("date"), F.col("fye"), t)
    return _period_texts(spark, sf_dir).select(
        "o_orderkey", fiscal.period_end_date(t).cast("string").alias("end_date"),
        F.coalesce(fiscal.duration_count(t), F.lit(0)).alias("dur_count"),
        F.coalesce(fiscal.duration_unit(t), F.lit("")).alias("dur_unit"),
        q.alias("quarter"), fiscal.period_type_in_text(t).alias("period_type"))


@query("period_start", f"""
WITH {I.CUSTOMER_ORDERS_SQL}
SELECT o_orderkey, CASE o_orderpriority
  WHEN '2-HIGH' THEN CAST(CAST(d - 181 AS DATE) AS VARCHAR)
  WHEN '1-URGENT' THEN CAST(CAST(date_trunc('month', d) - INTERVAL 2 MONTH AS DATE) AS VARCHAR)
  WHEN '3-MEDIUM' THEN CAST(CAST(date_trunc('month', d) - INTERVAL 8 MONTH AS DATE) AS VARCHAR)
  ELSE '' END AS start_date
FROM customer_orders""")
def period_start(spark, sf_dir):
    return _period_texts(spark, sf_dir).withColumn(
        "start_date", fiscal.period_start(F.col("period_text"), F.col("d"))).select(
        "o_orderkey", _s("start_date").alias("start_date"))


@query("save_route", f"""
WITH {I.CUSTOMER_ORDERS_SQL}
SELECT o_orderkey, pt AS period_type, CASE pt WHEN 'annual' THEN '10-K' ELSE '10-Q' END AS form_type,
  CAST(year(d) + CASE WHEN month(d) > fye THEN 1 ELSE 0 END AS INTEGER) AS fiscal_year,
  CAST(CASE WHEN pt = 'annual' THEN 0 WHEN o_orderpriority IN ('2-HIGH', '5-LOW') THEN 2
    WHEN o_orderpriority = '3-MEDIUM' THEN 3
    ELSE ((month(d) - (fye % 12 + 1) + 12) % 12) // 3 + 1 END AS INTEGER) AS quarter
FROM (SELECT *, CASE WHEN o_orderstatus = 'F' THEN 'quarterly' WHEN month(d) = fye THEN 'annual'
  WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'annual' ELSE 'quarterly' END AS pt FROM customer_orders)""")
def save_route(spark, sf_dir):
    f = _period_texts(spark, sf_dir).select(
        "o_orderkey", F.col("o_custkey").alias("cik"), F.lit("").alias("company_name"),
        F.col("fye").alias("fye_month"), F.lit("").alias("fye_code"), "period_text",
        F.lit(None).cast("date").alias("report_date"), F.current_timestamp().alias("loaded_at"),
        F.when(F.col("o_orderstatus") == "F", "quarterly").alias("period_override"))
    v = f.select("o_orderkey", F.lit("c").alias("concept_id"), F.col("o_orderkey").alias("value"),
                 F.lit(False).alias("derived"))
    return sinks.value_rows(v, f, "o_orderkey").select(
        F.col("value").cast("bigint").alias("o_orderkey"), "period_type", "form_type", "fiscal_year",
        F.coalesce("quarter", F.lit(0)).alias("quarter"))


@query("company_registry", """
WITH e AS (
  SELECT c_custkey AS pos, c_custkey AS cik, ' ' || lower(substr(c_mktsegment, 1, 3)) || c_custkey % 977 AS t, c_name AS title FROM customer
  UNION ALL SELECT 1000000000 + s_suppkey, 5 * s_suppkey, 'hou' || s_suppkey, s_name FROM supplier),
 ok AS (SELECT pos, lpad(CAST(cik AS VARCHAR), 10, '0') AS cik, upper(trim(t)) AS ticker, title FROM e WHERE cik <> 0),
 bt AS (SELECT ticker, arg_max(cik, pos) AS cik FROM ok GROUP BY ticker),
 bc AS (SELECT cik, arg_max(title, pos) AS title, arg_max(ticker, pos) AS cik_ticker FROM ok GROUP BY cik)
SELECT ticker, cik, title, cik_ticker FROM bt JOIN bc USING (cik)""")
def company_registry(spark, sf_dir):
    c = I.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("pos"), F.col("c_custkey").alias("cik_str"),
        F.concat(F.lit(" "), F.lower(F.substring("c_mktsegment", 1, 3)),
                 (F.col("c_custkey") % 977).cast("string")).alias("ticker"),
        F.col("c_name").alias("title"))
    s = I.table(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") + 1_000_000_000).alias("pos"), (F.col("s_suppkey") * 5).alias("cik_str"),
        F.concat(F.lit("hou"), F.col("s_suppkey").cast("string")).alias("ticker"), F.col("s_name").alias("title"))
    return FL.registry(c.unionByName(s))


@query("company_lookup", """
SELECT o_orderkey, c_name AS title, c_name IS NOT NULL AS found
FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_custkey <> 0""".replace("c_name AS title", "coalesce(c_name, '') AS title"))
def company_lookup(spark, sf_dir):
    reg = FL.registry(I.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("pos"), F.col("c_custkey").alias("cik_str"),
        F.concat(F.lit("t"), F.col("c_custkey").cast("string")).alias("ticker"), F.col("c_name").alias("title")))
    wanted = I.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "F", "cik").otherwise("ticker").alias("id_kind"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_custkey").cast("string")).otherwise(
            F.concat(F.lit("t"), F.col("o_custkey").cast("string"))).alias("id"))
    return FL.resolve_companies(wanted, reg).select("o_orderkey", _s("title").alias("title"), "found")


@query("filing_list", """
SELECT o_orderkey, pos, form, items, report_date FROM (
  SELECT o_orderkey, 0 AS pos, '8-K' AS form, '2.02' AS items, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS report_date FROM orders
  UNION ALL SELECT o_orderkey, 1, '10-Q', '', CAST(CAST(o_orderdate AS DATE) - 90 AS VARCHAR) FROM orders
  UNION ALL SELECT o_orderkey, 2, '10-K', '', '' FROM orders)""".replace(
    "CAST(CAST(o_orderdate AS DATE) - 90 AS VARCHAR)", "CAST(CAST(CAST(o_orderdate AS DATE) - 90 AS DATE) AS VARCHAR)"))
def filing_list(spark, sf_dir):
    d = F.col("o_orderdate").cast("date")
    recent = F.struct(
        F.array(F.lit("8-K"), F.lit("10-Q"), F.lit("10-K")).alias("form"),
        F.array(F.lit("2.02")).alias("items"),
        F.array(F.col("o_orderkey").cast("string")).alias("accessionNumber"),
        F.array().cast("array<string>").alias("primaryDocument"),
        F.array(d.cast("string"), F.date_sub(d, 90).cast("string")).alias("reportDate"),
        F.array().cast("array<string>").alias("filingDate"))
    text = I.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_json(F.struct(F.struct(recent.alias("recent")).alias("filings"))).alias("j"))
    raw = text.select("o_orderkey", F.from_json("j", FL.SUBMISSION_SCHEMA).alias("x")).select(
        "o_orderkey", "x.filings")
    return FL.submissions(raw).select("o_orderkey", "pos", "form", "items", _s("report_date").alias("report_date"))


@query("latest_8k", f"""
WITH {I.SUBMISSIONS_SQL}
SELECT cik, arg_min(accession, CASE WHEN items LIKE '%2.02%' THEN pos ELSE pos + 5000000000000000 END) AS accession
FROM subs WHERE form = '8-K' GROUP BY cik""")
def latest_8k(spark, sf_dir):
    return FL.latest_8k(I.submissions(spark, sf_dir)).select("cik", "accession")


@query("primary_url", f"""
WITH {I.SUBMISSIONS_SQL}
SELECT cik, accession, CASE WHEN items LIKE '%2.02%' THEN '/ex' || accession
  ELSE 'https://www.sec.gov/Archives/edgar/data/' || cik || '/' || accession || '/' || primary_doc END AS url
FROM subs WHERE form = '8-K'""")
def primary_url(spark, sf_dir):
    s = I.submissions(spark, sf_dir).filter("form = '8-K'")
    exhibit = F.when(F.col("items").contains("2.02"), F.concat(F.lit("/ex"), F.col("accession").cast("string")))
    return s.select("cik", "accession", FL.primary_url(
        FL.normalize_cik(F.col("cik")), F.col("accession").cast("string"), F.col("primary_doc"), exhibit).alias("url"))


_SERIES = """series AS (
  SELECT cik, report_date, arg_min(form, pos) AS form, arg_min(filing_date, pos) AS filed
  FROM subs WHERE form IN ('10-Q', '10-K') GROUP BY 1, 2)"""


@query("asof_prior_filing", f"""
WITH {I.SUBMISSIONS_SQL}, {_SERIES}
SELECT f.cik, f.accession, coalesce(CAST(s.report_date AS VARCHAR), '') AS prior_end, coalesce(s.form, '') AS prior_form
FROM (SELECT * FROM subs WHERE form = '8-K') f
ASOF LEFT JOIN series s ON f.cik = s.cik AND f.filing_date > s.report_date""")
def asof_prior_filing(spark, sf_dir):
    s = I.submissions(spark, sf_dir)
    out = PR.asof_previous(
        s.filter("form = '8-K'"), s.filter("form in ('10-Q', '10-K')"), ["cik"], "filing_date", "report_date",
        F.struct("report_date", "form"), F.col("pos"), "prior")
    return out.select("cik", "accession", _s("prior.report_date").alias("prior_end"), _s("prior.form").alias("prior_form"))


_NEAR = """near AS (
  SELECT f.accession, arg_min(s.report_date, abs(date_diff('day', s.filing_date, CAST(f.filing_date - INTERVAL 1 YEAR AS DATE))) * 1000000000000000000::HUGEINT + (s.pos + 900000000000000000)) AS near_end
  FROM subs f JOIN subs s ON f.cik = s.cik AND s.form IN ('10-Q', '10-K')
    AND abs(date_diff('day', s.filing_date, CAST(f.filing_date - INTERVAL 1 YEAR AS DATE))) <= 90
  WHERE f.form = '8-K' GROUP BY 1)"""


@query("nearest_prior_year", f"""
WITH {I.SUBMISSIONS_SQL}, {_NEAR}
SELECT cik, accession, coalesce(CAST(near_end AS VARCHAR), '') AS near_end
FROM subs LEFT JOIN near USING (accession) WHERE form = '8-K'""")
def nearest_prior_year(spark, sf_dir):
    s = I.submissions(spark, sf_dir)
    left = s.filter("form = '8-K'").withColumn("year_ago", F.add_months("filing_date", -12))
    out = PR.nearest_by_day(
        left, s.filter("form in ('10-Q', '10-K')"), ["cik"], "year_ago", "filing_date",
        F.struct("report_date"), F.col("pos"), 90, "near")
    return out.select("cik", "accession", _s("near.report_date").alias("near_end"))


@query("period_end_inference", f"""
WITH {I.SUBMISSIONS_SQL}, {_SERIES}, {_NEAR},
 j AS (SELECT f.cik, f.accession, f.filing_date, f.report_date, s.report_date AS prior,
    CAST(near_end + INTERVAL 1 YEAR AS DATE) AS proj
  FROM (SELECT * FROM subs WHERE form = '8-K') f ASOF LEFT JOIN series s ON f.cik = s.cik AND f.filing_date > s.report_date
  LEFT JOIN near USING (accession)),
 m AS (SELECT *, CASE WHEN date_diff('day', proj, filing_date) BETWEEN 1 AND 100 THEN 'projected'
    WHEN prior < report_date AND report_date < filing_date THEN 'reported' WHEN prior IS NULL THEN 'unchecked'
    WHEN date_diff('day', prior, filing_date) <= 60 THEN 'last_period' ELSE 'estimated' END AS method FROM j)
SELECT cik, accession, method, CAST(CAST(CASE method WHEN 'projected' THEN proj WHEN 'last_period' THEN prior
  WHEN 'estimated' THEN CAST(filing_date - 30 AS DATE) ELSE report_date END AS DATE) AS VARCHAR) AS period_end FROM m""")
def period_end_inference(spark, sf_dir):
    s = I.submissions(spark, sf_dir)
    return PR.infer_period_end(s.filter("form = '8-K'"), s).select(
        "cik", "accession", "method", F.col("period_end").cast("string").alias("period_end"))


_FISCAL = """ref AS (
  SELECT f.cik, f.accession, f.pos, f.items, f.filing_date, f.fye_month, s.form AS rform, s.filed,
    CAST(year(s.report_date) + CASE WHEN month(s.report_date) > f.fye_month THEN 1 ELSE 0 END AS INTEGER) AS rfy,
    CAST(((month(s.report_date) - (f.fye_month % 12 + 1) + 12) % 12) // 3 + 1 AS INTEGER) AS rq
  FROM (SELECT * FROM subs WHERE form = '8-K') f ASOF LEFT JOIN series s ON f.cik = s.cik AND f.filing_date > s.report_date),
 fp AS (SELECT *, CASE WHEN abs(date_diff('day', filed, filing_date)) <= 60 OR rq < 4 THEN rfy ELSE rfy + 1 END AS fiscal_year,
    CASE WHEN abs(date_diff('day', filed, filing_date)) <= 60 THEN rq WHEN rq < 4 THEN rq + 1 WHEN rq = 4 THEN 1 END AS quarter,
    CASE WHEN rq IS NULL THEN NULL WHEN abs(date_diff('day', filed, filing_date)) <= 60 AND rform = '10-K' THEN 'annual' ELSE 'quarterly' END AS period_type
  FROM ref)"""


@query("filing_fiscal_period", f"""
WITH {I.SUBMISSIONS_SQL}, {_SERIES}, {_FISCAL}
SELECT cik, accession, coalesce(CAST(fiscal_year AS VARCHAR), '') AS fiscal_year,
  coalesce(CAST(quarter AS VARCHAR), '') AS quarter, coalesce(period_type, '') AS period_type FROM fp""")
def filing_fiscal_period(spark, sf_dir):
    s = I.submissions(spark, sf_dir)
    return PR.infer_fiscal_period(s.filter("form = '8-K'"), s).select(
        "cik", "accession", _s("fiscal_year").alias("fiscal_year"), _s("quarter").alias("quarter"),
        _s("period_type").alias("period_type"))


_LATEST = """latest AS (
  SELECT cik, arg_max({{'t': period_type, 'y': fiscal_year, 'q': quarter, 'e': end_date}},
    CAST(date_diff('day', DATE '1990-01-01', end_date) AS BIGINT) * 2 + CASE period_type WHEN 'quarterly' THEN 1 ELSE 0 END) AS p
  FROM stored GROUP BY cik)""".replace("{{", "{").replace("}}", "}")


@query("latest_period", f"""
WITH {I.STORED_SQL}, {_LATEST}
SELECT cik, p.t AS period_type, p.y AS fiscal_year, coalesce(p.q, 0) AS quarter, CAST(CAST(p.e AS DATE) AS VARCHAR) AS end_date FROM latest""")
def latest_period(spark, sf_dir):
    return H.latest_period(I.stored_values(spark, sf_dir)).select(
        "cik", "period_type", "fiscal_year", F.coalesce("quarter", F.lit(0)).alias("quarter"),
        F.col("end_date").cast("string").alias("end_date"))


@query("next_period_cadence", f"""
WITH {I.SUBMISSIONS_SQL}, {I.STORED_SQL}, {_LATEST},
 x AS (SELECT s.cik, accession, CASE WHEN p IS NULL THEN NULL WHEN report_date <= p.e THEN p.t
    WHEN p.t = 'quarterly' AND p.q = 3 THEN 'annual' ELSE 'quarterly' END AS cadence,
   CASE WHEN month(report_date) = fye_month THEN 'annual' ELSE 'quarterly' END AS by_date
  FROM subs s LEFT JOIN latest l ON s.cik = l.cik WHERE form = '8-K')
SELECT cik, accession, coalesce(cadence, '') AS cadence, by_date,
  CASE WHEN cadence IS NULL THEN by_date WHEN by_date = 'annual' THEN 'annual' ELSE cadence END AS period_type,
  coalesce(cadence <> by_date, false) AS diverged FROM x""")
def next_period_cadence(spark, sf_dir):
    f = I.submissions(spark, sf_dir).filter("form = '8-K'").select(
        "cik", "accession", F.col("report_date").alias("period_end"), "fye_month", F.lit("").alias("fye_code"))
    return H.cadence(f, I.stored_values(spark, sf_dir)).select(
        "cik", "accession", _s("cadence").alias("cadence"), "by_date", "period_type", "diverged")


_NEXT = """nx AS (
  SELECT cik, arg_min(report_date, pos) FILTER (WHERE items LIKE '%2.02%') AS e,
    arg_min(accession, pos) FILTER (WHERE items LIKE '%2.02%') AS a, arg_min(report_date, pos) AS any_date
  FROM subs WHERE form = '8-K' GROUP BY cik),
 probe AS (SELECT l.cik, p, coalesce(e >= CAST(p.e + INTERVAL 3 MONTH AS DATE) - 30, false) AS available, e, a, any_date
  FROM latest l LEFT JOIN nx USING (cik))"""


@query("next_filing_probe", f"""
WITH {I.SUBMISSIONS_SQL}, {I.STORED_SQL}, {_LATEST}, {_NEXT}
SELECT cik, available, CASE WHEN available THEN CAST(e AS VARCHAR) ELSE '' END AS sec_report_date,
  coalesce(CAST(coalesce(e, any_date) AS VARCHAR), '') AS latest_report_date FROM probe""")
def next_filing_probe(spark, sf_dir):
    last = H.latest_period(I.stored_values(spark, sf_dir)).select("cik", F.col("end_date").alias("last_end"))
    return PR.next_filing(last, I.submissions(spark, sf_dir)).select(
        "cik", "available", _s("sec_report_date").alias("sec_report_date"),
        _s("latest_report_date").alias("latest_report_date"))


@query("skip_replace_plan", f"""
WITH {I.SUBMISSIONS_SQL}, {_SERIES}, {_FISCAL}, {I.STORED_SQL}, {_LATEST},
 one AS (SELECT cik, arg_min(fp, pos) AS f FROM fp WHERE items LIKE '%2.02%' GROUP BY cik),
 k AS (SELECT one.cik, coalesce(f.fiscal_year, p.y) AS fy,
    CASE WHEN f.fiscal_year IS NULL THEN p.q ELSE f.quarter END AS q, coalesce(f.period_type, p.t) AS t
  FROM one LEFT JOIN latest l ON one.cik = l.cik),
 n AS (SELECT cik, period_type AS t, fiscal_year AS fy, coalesce(quarter, 0) AS qk, count(*) AS n FROM stored GROUP BY 1, 2, 3, 4)
SELECT k.cik, coalesce(k.t, '') AS period_type, coalesce(CAST(k.fy AS VARCHAR), '') AS fiscal_year, coalesce(n.n, 0) AS n_stored,
  CASE WHEN n.n IS NULL THEN 'new' ELSE 'replace' END AS action
FROM k LEFT JOIN n ON k.cik = n.cik AND k.t = n.t AND k.fy = n.fy AND CASE WHEN k.t = 'quarterly' THEN k.q ELSE 0 END = n.qk""")
def skip_replace_plan(spark, sf_dir):
    s = I.submissions(spark, sf_dir)
    newest = FL.latest_8k(s.filter("items like '%2.02%'")).select("cik", "filing_date", "fye_month")
    return H.skip_replace_plan(newest, s, I.stored_values(spark, sf_dir)).select(
        "cik", _s("period_type").alias("period_type"), _s("fiscal_year").alias("fiscal_year"), "n_stored", "action")


@query("coverage", f"""
WITH {I.SUBMISSIONS_SQL}, {I.STORED_SQL}, {_LATEST}, {_NEXT},
 n AS (SELECT cik, period_type AS t, fiscal_year AS fy, coalesce(quarter, 0) AS qk, count(*) AS n FROM stored GROUP BY 1, 2, 3, 4)
SELECT c_custkey AS cik, coalesce(n.n, 0) AS n_values,
  CASE WHEN pr.p IS NULL THEN '' WHEN p.t = 'annual' OR p.q >= 4 THEN 'FY' || (p.y + 1) || ' Q1 8-K'
    WHEN p.q = 3 THEN 'FY' || p.y || ' Annual 8-K' ELSE 'FY' || p.y || ' Q' || (p.q + 1) || ' 8-K' END AS next_due,
  CASE WHEN pr.p IS NULL THEN 'no data yet' WHEN available THEN 'filed' WHEN coalesce(e, any_date) IS NOT NULL
    THEN 'stored, nothing newer' ELSE 'not yet' END AS note
FROM customer LEFT JOIN probe pr ON c_custkey = pr.cik
LEFT JOIN n ON n.cik = pr.cik AND n.t = p.t AND n.fy = p.y AND n.qk = coalesce(p.q, 0)""")
def coverage(spark, sf_dir):
    v = I.stored_values(spark, sf_dir)
    last = H.latest_period(v).select("cik", F.col("end_date").alias("last_end"))
    nxt = PR.next_filing(last, I.submissions(spark, sf_dir))
    c = I.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("cik"))
    return H.coverage(c, v, nxt).select(
        "cik", F.coalesce("n_values", F.lit(0)).alias("n_values"), _s("next_due").alias("next_due"), "note")


@query("history_guards", f"""
WITH {I.STORED_SQL}
SELECT c_custkey AS cik FROM customer
WHERE c_custkey IN (SELECT cik FROM stored) AND c_custkey NOT IN (
  SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' AND year(o_orderdate) = 2000)
  AND c_custkey IN (SELECT cik FROM stored WHERE period_type = 'quarterly' AND fiscal_year = 1999 AND quarter = 2)""")
def history_guards(spark, sf_dir):
    v = I.stored_values(spark, sf_dir)
    c = I.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("cik"), F.concat(F.lit("T"), F.col("c_custkey").cast("string")).alias("ticker"),
        F.lit(1999).alias("fiscal_year"), F.lit(2).alias("quarter"))
    runs = I.table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select(F.concat_ws(
        "_", F.concat(F.lit("T"), F.col("o_custkey").cast("string")), F.year("o_orderdate").cast("string"),
        F.lit("latest")).alias("_id"))
    kept = H.not_yet_saved(H.with_history(c, v), runs, F.lit(2000))
    return H.existing_periods(kept, v).select("cik")
