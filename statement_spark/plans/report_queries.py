"""Dimensions, look-ups, answers and reports that other plans read one by one."""
from __future__ import annotations

from pyspark.sql import Window, functions as F

from ..functions import patterns as P
from ..operators import chunks as CH, concepts as C, derive as D, history as H, prompts as PR, quality as Q, reports as R, tables as TB
from ..session import spread, work_dir
from ..sources import filings as FL, html, responses as RS, sinks as S
from . import history_queries as HQ, inputs as I
from .catalogue import query
from .page_queries import _TEXT_SQL, _TYPE_SQL, _headed_tables


@query("company_dimension", """
SELECT CAST(c_custkey AS VARCHAR) AS cik, 'T' || c_custkey AS ticker, CASE WHEN c_custkey % 3 = 0 THEN 't' || c_custkey ELSE c_name END AS name,
  CASE WHEN c_nationkey = 0 THEN '1231' ELSE lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || '28' END AS fye_code,
  CASE WHEN c_nationkey BETWEEN 1 AND 12 THEN CAST(c_nationkey AS INTEGER) ELSE 12 END AS fye_month FROM customer""")
def company_dimension(spark, sf_dir):
    code = F.when(F.col("c_nationkey") == 0, "").otherwise(F.concat(F.lpad(F.col("c_nationkey").cast("string"), 2, "0"), F.lit("28")))
    raw = I.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("cik"), F.concat(F.lit("t"), F.col("c_custkey").cast("string")).alias("ticker_symbol"),
        F.when(F.col("c_custkey") % 3 != 0, F.col("c_name")).alias("name"), F.struct(code.alias("fiscal_year_end")).alias("corporate_info"))
    return FL.companies(raw)


@query("role_candidates", """
SELECT p_brand AS cik, p_partkey AS concept_id FROM part WHERE p_size % 4 IN (1, 3)""")
def role_candidates(spark, sf_dir):
    """Concepts without a role that a model may be asked for: no line with a known name or key, no segment."""
    kind = F.col("p_size") % 4
    concepts = I.table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("cik"), F.col("p_partkey").alias("concept_id"),
        F.when(kind == 0, "Gross profit").otherwise("Sundry things").alias("label"),
        F.when(kind == 2, "x:Sundry|us-gaap:EastMember").when(kind == 3, "x:Other").otherwise("").alias("taxonomy_key"))
    return C.role_candidates(C.with_roles(concepts)).select("cik", "concept_id")


_OPTIONAL = [name for tier, name, _ in P.PRESENCE if tier == 3]


@query("optional_present", f"""WITH {I.METRICS_SQL},
 hit AS (SELECT filing_id, CASE key WHEN 'Research and development' THEN 'R&D Expense' WHEN 'Sales and marketing' THEN 'Sales & Marketing' ELSE 'G&A' END AS name
  FROM ml WHERE key IN ('Research and development', 'Sales and marketing', 'General and administrative') AND NOT (key = 'General and administrative' AND v % 2 = 0))
SELECT m.filing_id, coalesce(string_agg(name, ', ' ORDER BY list_position({_OPTIONAL}, name)), '') AS names FROM m LEFT JOIN hit USING (filing_id) GROUP BY 1""")
def optional_present(spark, sf_dir):
    rows = I.metric_rows(spark, sf_dir).filter("not (key = 'General and administrative' and num_value % 2 = 0)")
    return Q.operands(rows).select("filing_id", F.array_join(Q.optional_present(), ", ").alias("names"))


_RUN_TYPES = " UNION ALL ".join(f"SELECT ticker, '{t}' AS type, '{s}' AS severity FROM r WHERE {c}" for t, s, _, _, c, _ in HQ._PASSES)


@query("affected_tickers", f"WITH {HQ._RUNS_SQL} SELECT DISTINCT type, ticker FROM ({_RUN_TYPES}) WHERE severity IN ('high', 'medium')")
def affected_tickers(spark, sf_dir):
    return R.affected_tickers(HQ.runs(spark, sf_dir))


@query("finding_counts", f"""WITH {HQ._PASSES_SQL}
SELECT attempt, type, count(*) AS n FROM p WHERE severity IN ('high', 'medium') GROUP BY 1, 2""")
def finding_counts(spark, sf_dir):
    return R.finding_counts(HQ._passes(spark, sf_dir), "attempt", worth_only=True)


@query("run_lookup", f"""WITH {HQ._RUNS_SQL}, d AS (SELECT 'T' || suppkey || '_' || fy || '_Q' || (n_lines % 4 + 1) AS _id, status FROM r)
SELECT _id, status FROM d WHERE _id LIKE '%_1996_Q2'""")
def run_lookup(spark, sf_dir):
    """Run documents found by ticker, fiscal year and quarter in the table of runs."""
    key = F.concat(F.lit("T"), F.col("suppkey").cast("string"))
    status = F.when(F.col("n_lines") % 3 == 0, "failed").when(F.col("n_lines") % 3 == 1, "degraded").otherwise("saved")
    docs = I.wide_metrics(spark, sf_dir).select(
        F.concat_ws("_", key, "fy", F.concat(F.lit("Q"), (F.col("n_lines") % 4 + 1).cast("string"))).alias("_id"), key.alias("ticker"), status.alias("status"))
    path = work_dir(spark, "runs")
    S.upsert_runs(spark, docs, path)
    return S.find_run(spark.read.parquet(path), F.col("ticker"), F.lit(1996), F.lit("Q2")).select("_id", "status")


@query("latest_status", """
SELECT user_id AS load_request_id, arg_max(event_type, ts) AS status, arg_max('FY' || day(ts), ts) AS period_label, CAST(max(ts) AS VARCHAR) AS updated_at FROM events GROUP BY 1""")
def latest_status(spark, sf_dir):
    updates = I.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("load_request_id"), F.col("event_type").alias("status"), F.concat(F.lit("FY"), F.dayofmonth("ts").cast("string")).alias("period_label"),
        F.col("ts").alias("event_time"))
    return S.latest_status(updates).withColumn("updated_at", F.regexp_replace(F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"), r"\.?0+$", ""))


@query("all_values", f"""WITH {I.STORED_SQL}
SELECT cik, concept_id, period_type, fiscal_year, coalesce(quarter, 0) AS quarter, CAST(end_date AS DATE)::VARCHAR AS end_date, value FROM stored""")
def all_values(spark, sf_dir):
    v = I.stored_values(spark, sf_dir)
    quarterly = v.filter("period_type = 'quarterly'").drop("period_type")
    annual = v.filter("period_type = 'annual'").drop("period_type", "quarter")
    return H.all_values(quarterly, annual).select(
        "cik", "concept_id", "period_type", "fiscal_year", F.coalesce("quarter", F.lit(0)).alias("quarter"), F.col("end_date").cast("string").alias("end_date"), "value")


@query("cleanup_answers", """
WITH o AS (SELECT o_orderkey AS filing_id, o_custkey AS c, o_orderstatus AS s FROM orders WHERE o_orderstatus <> 'P')
SELECT filing_id, 'Line ' || c AS key, CASE WHEN s = 'F' THEN 'rule ' || c END AS reason FROM o
UNION ALL SELECT filing_id, 'Other', 'rule "B"' FROM o""")
def cleanup_answers(spark, sf_dir):
    """Removals with their reasons out of answers with chatter around them; an answer that is no object asks for none."""
    c = F.col("o_custkey").cast("string")
    own = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit('"Line '), c, F.lit('": "rule '), c, F.lit('", '))).otherwise("")
    text = F.concat(F.lit('Sure!\n```json\n{"remove": ["Line '), c, F.lit('", "Other", "Other"], "reasons": {'), own, F.lit('"Other": "rule \\"B\\""}}\n```'))
    answers = I.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("filing_id"), F.when(F.col("o_orderstatus") == "P", "none to remove").otherwise(text).alias("text"))
    return RS.cleanup_answers(answers, "filing_id")


@query("mapping_answers", """
SELECT o_orderkey AS filing_id, 'c' || o_custkey AS concept_id, 'Revenue, net' AS key FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT o_orderkey, 'x', CASE WHEN o_orderstatus = 'F' THEN 'Tax' END FROM orders WHERE o_orderstatus <> 'P'""")
def mapping_answers(spark, sf_dir):
    """Entries of flat answers of strings: concepts and the keys a model gives them."""
    text = F.concat(F.lit('{"c'), F.col("o_custkey").cast("string"), F.lit('": "Revenue, net", "x": '), F.when(F.col("o_orderstatus") == "F", '"Tax"}').otherwise("null}"))
    answers = I.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("filing_id"), F.when(F.col("o_orderstatus") == "P", "{").otherwise(text).alias("text"))
    return answers.select("filing_id", F.explode(RS.string_map(F.col("text"))).alias("concept_id", "key"))


@query("section_text", f"""WITH {_TEXT_SQL}
SELECT filing_id, md5('=== GAAP INCOME STATEMENT ===' || chr(10) || head || chr(10) || md) AS h FROM x""")
def section_text(spark, sf_dir):
    """The text that is cut into chunks: the selected tables under their section titles."""
    pages = html.page_segments(spread(I.statement_pages(spark, sf_dir)))
    return CH.section_text(TB.selected_entries(TB.classify(TB.page_tables(pages)), "filing_id"), "filing_id").select("filing_id", F.md5("text").alias("h"))


@query("momentum_findings", f"""WITH {I.STORED_SQL}, {HQ._PRIOR},
 s AS (SELECT cik || ' ' || period_type || ' ' || CAST(end_date AS DATE) AS filing_id, value AS v, prior_value AS p FROM pv
  WHERE concept_id = 'net interest' AND value <> 0 AND prior_value <> 0 AND (value / prior_value < 0.5 OR value / prior_value > 1.5))
SELECT filing_id, 'momentum' AS detector, 'suspect_value' AS type, 'high' AS severity, 'Net interest' AS key,
  'Net interest income of ' || format('{{:,}}', CAST(v AS BIGINT)) || ' is far from the ' || format('{{:,}}', CAST(p AS BIGINT)) || ' of the period before.' AS message,
  CAST(round(v / p, 6) AS DOUBLE) AS ratio FROM s""")
def momentum_findings(spark, sf_dir):
    """Findings on net interest that leaves the band around the period before."""
    q = HQ._stored(spark, sf_dir)
    rows = H.momentum(H.prior_values(q, q).filter("concept_id = 'net interest'")).select(
        F.concat_ws(" ", "cik", "period_type", "end_date").alias("filing_id"), F.lit("Net interest").alias("key"), "value", "prior_value", "ratio")
    return Q.momentum_findings(rows).select(
        "filing_id", "detector", "type", "severity", F.col("keys")[0].alias("key"), "message",
        F.round(F.col("evidence")["ratio"].cast("double"), 6).alias("ratio"))


def _sql_text(template: str, **values: str) -> str:
    """A template as SQL: its text quoted, its marks replaced by expressions."""
    out = "'" + template.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"
    for name, value in values.items():
        out = out.replace("{%s}" % name, f"' || {value} || '")
    return out


@query("role_prompts", f"""
WITH l AS (SELECT p_brand AS cik, string_agg(DISTINCT '- Sundry ' || p_size, chr(10) ORDER BY '- Sundry ' || p_size) AS labels FROM part WHERE p_size % 4 <> 0 GROUP BY 1)
SELECT cik, md5({_sql_text(PR.ROLE_TEMPLATE, roles="'" + ", ".join(P.ROLES) + "'", labels="labels")}) AS h FROM l""")
def role_prompts(spark, sf_dir):
    concepts = I.table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("cik"), F.col("p_partkey").alias("concept_id"),
        F.when(F.col("p_size") % 4 == 0, "Gross profit").otherwise(F.concat(F.lit("Sundry "), F.col("p_size").cast("string"))).alias("label"),
        F.lit("").alias("taxonomy_key"))
    return PR.role_prompts(C.role_candidates(C.with_roles(concepts))).select("cik", F.md5("prompt").alias("h"))


@query("match_prompts", f"""WITH {I.METRICS_SQL},
 k AS (SELECT filing_id, string_agg('- ' || key, chr(10) ORDER BY key_ord) AS keys FROM ml GROUP BY 1),
 c AS (SELECT filing_id, '- c2: Second' || chr(10) || '- c1: First of ' || suppkey AS concepts FROM m WHERE n_lines % 3 <> 0)
SELECT filing_id, md5({_sql_text(PR.MATCH_TEMPLATE, concepts="concepts", keys="keys")}) AS h FROM k JOIN c USING (filing_id)""")
def match_prompts(spark, sf_dir):
    missing = I.wide_metrics(spark, sf_dir).filter("n_lines % 3 <> 0").select("filing_id", F.inline(F.array(
        F.struct(F.lit("c1").alias("concept_id"), F.concat(F.lit("First of "), F.col("suppkey").cast("string")).alias("label"), F.lit(2).alias("concept_ord")),
        F.struct(F.lit("c2").alias("concept_id"), F.lit("Second").alias("label"), F.lit(1).alias("concept_ord")))))
    return PR.match_prompts(missing, I.metric_rows(spark, sf_dir)).select("filing_id", F.md5("prompt").alias("h"))


@query("keep_prompts", f"""
WITH t AS (SELECT o_orderkey AS filing_id, '[0] Key data' || chr(10) || '|  | ' || year(o_orderdate) || ' |' || chr(10) || '| Stores opened | '
  || format('{{:,}}', CAST(floor(o_totalprice) AS BIGINT)) || ' |' AS tables FROM orders WHERE {_TYPE_SQL} = 'other')
SELECT filing_id, md5({_sql_text(PR.KEEP_TEMPLATE, tables="tables")}) AS h, 0 AS table_idx, 0 AS cand_idx FROM t""")
def keep_prompts(spark, sf_dir):
    asked, candidates = PR.keep_prompts(TB.classify(_headed_tables(spark, sf_dir)))
    return asked.select("filing_id", F.md5("prompt").alias("h")).join(candidates, "filing_id")


@query("cleanup_prompts", f"""WITH {I.METRICS_SQL},
 k AS (SELECT filing_id, string_agg(key, '|' ORDER BY key_ord) AS keys FROM ml GROUP BY 1)
SELECT filing_id, keys, md5({_sql_text(PR.CLEAN_TEMPLATE, payload="'{}'")}) AS h FROM k""")
def cleanup_prompts(spark, sf_dir):
    """The question about every filing's metrics (all have a pair to look at): its keys in order, and the words around them."""
    asked = PR.cleanup_prompts(I.metric_rows(spark, sf_dir).withColumn("protected", F.lit(False)))
    payload = F.regexp_extract("prompt", r"(\{.*?\})\n", 1)
    return asked.select(
        "filing_id", F.array_join(F.json_object_keys(payload), "|").alias("keys"), F.md5(F.replace("prompt", payload, F.lit("{}"))).alias("h"))


@query("severity_demotion", f"""WITH {I.METRICS_SQL},
 none AS (SELECT filing_id FROM ml WHERE key = 'Gross profit' AND v % 2 = 0)
SELECT filing_id, t AS targeted, CASE WHEN t THEN 'medium' ELSE 'high' END AS severity, 'Gross Profit' AS metric FROM none, (VALUES (true), (false)) x(t)""")
def severity_demotion(spark, sf_dir):
    """A missing line of the first tier weighs less in a pass that was aimed at some chunks only."""
    rows = I.metric_rows(spark, sf_dir).filter("not (key = 'Gross profit' and num_value % 2 = 0)")

    def missing(targeted: bool):
        found = Q.findings(rows, targeted=targeted).filter("type = 'missing_critical'")
        return found.select("filing_id", F.lit(targeted).alias("targeted"), "severity", F.col("evidence")["metric"].alias("metric"))

    return missing(True).unionByName(missing(False))


_RULES = [
    ("c1", "revenue"), ("c2", "cost_of_revenue"), ("c3", "gross_profit"), ("c4", "total_opex"), ("c5", "operating_income"), ("c6", "operating_margin_pct"),
    ("c7", "net_income"), ("c8", "shares_diluted"), ("c9", "eps_diluted"), ("ca", "net_margin_pct"),
]


@query("derive_from_totals", f"""WITH {I.METRICS_SQL},
 v AS (SELECT filing_id, CAST(revenue AS DOUBLE) AS r, CAST(revenue - cost AS DOUBLE) AS g, CAST(opsub AS DOUBLE) AS o, CAST(ni AS DOUBLE) AS n, CAST(sh_d AS DOUBLE) AS s, n_lines FROM m),
 d AS (SELECT filing_id, 'c3' AS concept_id, g AS value FROM v
  UNION ALL SELECT filing_id, 'c5', g - o FROM v WHERE n_lines % 3 <> 0
  UNION ALL SELECT filing_id, 'c6', (g - o) / r * 100 FROM v WHERE n_lines % 3 <> 0 AND abs((g - o) / r * 100) <= 200
  UNION ALL SELECT filing_id, 'c9', n / s FROM v WHERE s > 0 AND abs(n / s) <= 1000
  UNION ALL SELECT filing_id, 'ca', n / r * 100 FROM v WHERE abs(n / r * 100) <= 200)
SELECT filing_id, concept_id, floor(value * 10000) / 10000 AS value FROM d""")
def derive_from_totals(spark, sf_dir):
    """Operating income from a known sum of expenses, its margin, and the diluted result per share."""
    w = I.wide_metrics(spark, sf_dir)
    known = [("c1", "revenue"), ("c2", "cost"), ("c4", "opsub"), ("c7", "ni"), ("c8", "sh_d")]
    values = w.select("filing_id", "n_lines", F.inline(F.array(*[
        F.struct(F.lit(c).alias("concept_id"), F.col(x).cast("double").alias("value"), F.lit(i).alias("key_ord")) for i, (c, x) in enumerate(known)])))
    values = values.filter("not (concept_id = 'c4' and n_lines % 3 = 0)").drop("n_lines")
    concepts = w.select("filing_id", F.inline(F.array(*[
        F.struct(F.lit(c).alias("concept_id"), F.lit(r).alias("label"), F.lit(c).alias("concept_ord"), F.lit(r).alias("role")) for c, r in _RULES])))
    return D.derive(values, concepts).select("filing_id", "concept_id", (F.floor(F.col("value") * 10000) / 10000).alias("value"))


@query("finding_type_order", f"""WITH {HQ._RUNS_SQL}, t AS ({_RUN_TYPES}),
 s AS (SELECT type, count(*) AS occurrences, count(DISTINCT ticker) AS n_tickers FROM t WHERE severity IN ('high', 'medium') GROUP BY 1)
SELECT CAST(row_number() OVER (ORDER BY occurrences DESC, type) AS INTEGER) AS place, type, occurrences, n_tickers FROM s""")
def finding_type_order(spark, sf_dir):
    """Finding types by how often they occur, with their place in the report: a row for each kind of finding there is."""
    totals = R.type_totals(HQ.runs(spark, sf_dir))
    return totals.select(F.row_number().over(Window.orderBy(F.desc("occurrences"), "type")).alias("place"), "type", "occurrences", "n_tickers")
