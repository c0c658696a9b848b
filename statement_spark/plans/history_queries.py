"""Stored values, retries, reports and sinks."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import history as H, quality as Q, reports as R, retry as RT
from ..functions import text as T
from ..session import work_dir
from ..sources import sinks as S
from . import inputs as I
from .catalogue import query


@query("recent_concepts", f"""
WITH {I.STORED_SQL}, e AS (SELECT DISTINCT cik, period_type, end_date FROM stored QUALIFY dense_rank() OVER (PARTITION BY cik, period_type ORDER BY end_date DESC) <= 3)
SELECT DISTINCT s.cik, s.period_type, concept_id FROM stored s JOIN e ON s.cik = e.cik AND s.period_type = e.period_type AND s.end_date = e.end_date""")
def recent_concepts(spark, sf_dir):
    return H.recent_concepts(I.stored_values(spark, sf_dir))


@query("period_counts", f"""
WITH {I.STORED_SQL} SELECT cik, period_type, fiscal_year, coalesce(quarter, 0) AS quarter, count(*) AS n_values FROM stored GROUP BY 1, 2, 3, 4""")
def period_counts(spark, sf_dir):
    return H.period_counts(I.stored_values(spark, sf_dir)).withColumn("quarter", F.coalesce("quarter", F.lit(0)))


_PRIOR = """q AS (SELECT cik, period_type, concept_id, end_date, value FROM stored),
 ends AS (SELECT cik, period_type, end_date, lag(end_date) OVER (PARTITION BY cik, period_type ORDER BY end_date) AS prior_end
  FROM (SELECT DISTINCT cik, period_type, end_date FROM q)),
 pv AS (SELECT q.cik, q.period_type, q.concept_id, q.end_date, q.value, p.value AS prior_value
  FROM q JOIN ends e ON q.cik = e.cik AND q.period_type = e.period_type AND q.end_date = e.end_date
  LEFT JOIN q p ON p.cik = q.cik AND p.period_type = q.period_type AND p.concept_id = q.concept_id AND p.end_date = e.prior_end)"""


def _stored(spark, sf_dir):
    return I.stored_values(spark, sf_dir).select("cik", "period_type", "concept_id", "end_date", "value")


@query("prior_values", f"""WITH {I.STORED_SQL}, {_PRIOR}
SELECT cik, period_type, concept_id, CAST(end_date AS DATE)::VARCHAR AS end_date, coalesce(prior_value, -1) AS prior_value FROM pv""")
def prior_values(spark, sf_dir):
    q = _stored(spark, sf_dir)
    return H.prior_values(q, q).select(
        "cik", "period_type", "concept_id", F.col("end_date").cast("string").alias("end_date"),
        F.coalesce("prior_value", F.lit(-1.0)).alias("prior_value"))


@query("momentum", f"""WITH {I.STORED_SQL}, {_PRIOR}
SELECT cik, period_type, CAST(end_date AS DATE)::VARCHAR AS end_date, value, prior_value FROM pv
WHERE concept_id = 'net interest' AND value <> 0 AND prior_value <> 0 AND (value / prior_value < 0.5 OR value / prior_value > 1.5)""")
def momentum(spark, sf_dir):
    q = _stored(spark, sf_dir)
    keys = q.filter("concept_id = 'net interest'").select(
        F.col("cik"), F.lit("Net  interest income").alias("key")).distinct()
    labels = q.select("cik", "concept_id").distinct().withColumn("label", F.col("concept_id"))
    related = H.related_keys(keys, labels, "cik", r"net\s+interest").select("cik", "concept_id")
    return H.momentum(H.prior_values(q, q).join(related, ["cik", "concept_id"], "left_semi")).select(
        "cik", "period_type", F.col("end_date").cast("string").alias("end_date"), "value", "prior_value")


@query("top_prior_values", """
WITH v AS (SELECT l_suppkey AS filing_id, l_partkey AS concept_id, max(CAST(floor(l_extendedprice) AS DOUBLE)) AS prior_value FROM lineitem GROUP BY 1, 2)
SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY filing_id ORDER BY abs(prior_value) DESC, concept_id) <= 30""")
def top_prior_values(spark, sf_dir):
    v = I.table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_suppkey").alias("filing_id"), F.col("l_partkey").alias("concept_id")).agg(
        F.max(I.whole(F.col("l_extendedprice"))).cast("double").alias("prior_value"))
    return H.prior_reference(v, ["filing_id"]).select("filing_id", "concept_id", "prior_value")


# Findings of up to three passes per supplier filing: (type, message, passes it is seen in).
_PASSES = [
    ("identity_violation", "high", "'identity off by ' || CAST(n_lines AS STRING)", ["Revenue", "Cost of revenue"], "n_lines % 2 = 0", "attempt <= 2"),
    ("missing_critical", "high", "'Tier-1 metric not found: Net Income'", [], "qty % 3 = 0", "attempt = 1"),
    ("source_unverified", "high", "'unverified'", ["Total assets"], "tax % 5 = 0", "attempt >= 2"),
    ("suspect_value", "medium", "'odd value'", ["Free cash flow"], "true", "attempt <> 2"),
]


def _passes(spark, sf_dir):
    base = I.wide_metrics(spark, sf_dir).select("filing_id", "n_lines", "qty", "tax", F.explode(F.array(*[F.lit(i) for i in (1, 2, 3)])).alias("attempt"))
    rows = F.array(*[
        F.struct(F.lit(t).alias("type"), F.lit(s).alias("severity"), F.expr(m).alias("message"),
                 F.array(*[F.lit(k) for k in ks]).cast("array<string>").alias("keys"),
                 F.lit("look at the balance sheet" if t == "source_unverified" else None).cast("string").alias("suggested_action"),
                 F.create_map(F.lit("metric"), F.lit("Net Income")).alias("evidence"), F.lit(i).alias("detector_ord"),
                 F.expr(f"({c}) and ({a})").alias("on"))
        for i, (t, s, m, ks, c, a) in enumerate(_PASSES)])
    return base.select("filing_id", "attempt", F.inline(rows)).filter("on").drop("on")


_PASSES_SQL = f"""{I.METRICS_SQL}, att AS (SELECT filing_id, n_lines, qty, tax, a AS attempt FROM m, (VALUES (1), (2), (3)) x(a)),
 p AS ({" UNION ALL ".join(
    f"SELECT filing_id, attempt, '{t}' AS type, '{s}' AS severity, {msg.replace('STRING', 'VARCHAR')} AS message FROM att WHERE ({c}) AND ({a})"
    for t, s, msg, _, c, a in _PASSES)})"""


@query("reextract_decisions", f"""WITH {_PASSES_SQL},
 h AS (SELECT filing_id, attempt, string_agg(message, '|' ORDER BY message) AS msgs, count(*) AS n FROM p WHERE severity = 'high' GROUP BY 1, 2),
 w AS (SELECT att.filing_id, att.attempt, coalesce(n, 0) AS n, coalesce(msgs, '') AS msgs FROM att LEFT JOIN h USING (filing_id, attempt)),
 z AS (SELECT *, lag(msgs) OVER (PARTITION BY filing_id ORDER BY attempt) AS prev FROM w)
SELECT filing_id, attempt, CAST(n AS INTEGER) AS n_high, CASE WHEN n = 0 THEN 'clean' WHEN attempt >= 3 THEN 'attempts_used'
  WHEN msgs = prev THEN 'no_progress' ELSE 'retry' END AS reason FROM z""")
def reextract_decisions(spark, sf_dir):
    att = I.wide_metrics(spark, sf_dir).select("filing_id", F.explode(F.array(*[F.lit(i) for i in (1, 2, 3)])).alias("attempt"))
    return RT.decisions(_passes(spark, sf_dir), att).select("filing_id", "attempt", "n_high", "reason")


@query("effectiveness", f"""WITH {_PASSES_SQL}, s AS (SELECT DISTINCT filing_id, attempt, type, message FROM p),
 last AS (SELECT filing_id, max(attempt) AS last FROM s GROUP BY 1),
 prev AS (SELECT s.filing_id, attempt + 1 AS attempt, type, message FROM s JOIN last USING (filing_id) WHERE attempt < last),
 j AS (SELECT coalesce(c.filing_id, v.filing_id) AS filing_id, coalesce(c.attempt, v.attempt) AS attempt, coalesce(c.type, v.type) AS type,
   c.filing_id IS NOT NULL AS c, v.filing_id IS NOT NULL AS v FROM (SELECT * FROM s WHERE attempt > 1) c
  FULL JOIN prev v ON c.filing_id = v.filing_id AND c.attempt = v.attempt AND c.type = v.type AND c.message = v.message)
SELECT filing_id, attempt, type, count(*) FILTER (WHERE v AND NOT c) AS resolved, count(*) FILTER (WHERE v AND c) AS persisted,
  count(*) FILTER (WHERE c AND NOT v) AS new FROM j GROUP BY 1, 2, 3""")
def effectiveness(spark, sf_dir):
    return RT.effectiveness(_passes(spark, sf_dir))


@query("finding_signatures", f"""WITH {_PASSES_SQL}
SELECT filing_id, attempt, CASE type WHEN 'identity_violation' THEN 'identity_violation::Cost of revenue|Revenue'
  WHEN 'missing_critical' THEN 'missing_critical::Net Income' WHEN 'source_unverified' THEN 'source_unverified::Total assets'
  ELSE 'suspect_value::Free cash flow' END AS sig FROM p""")
def finding_signatures(spark, sf_dir):
    return _passes(spark, sf_dir).select("filing_id", "attempt", T.finding_signature(
        F.col("type"), F.col("keys"), F.element_at("evidence", "metric"), F.col("message")).alias("sig"))


@query("retry_scope", f"""WITH {I.METRICS_SQL},
 ch AS (SELECT filing_id, i AS chunk_idx, s AS section, n_lines, tax FROM m, (VALUES (0, 'income_statement'), (1, 'income_statement'), (2, 'balance_sheet'), (3, 'other'), (4, 'cash_flow')) x(i, s)),
 hit AS (SELECT *, (n_lines % 2 = 0 AND (section = 'income_statement' OR chunk_idx = 3)) OR (tax % 5 = 0 AND section = 'balance_sheet') AS h FROM ch)
SELECT filing_id, chunk_idx, section, bool_or(h) OVER w AS scoped FROM hit WINDOW w AS (PARTITION BY filing_id) QUALIFY h OR NOT bool_or(h) OVER w""")
def retry_scope(spark, sf_dir):
    w = I.wide_metrics(spark, sf_dir)
    chunks = w.select("filing_id", F.inline(F.array(*[
        F.struct(F.lit(i).alias("chunk_idx"), F.lit(s).alias("section"))
        for i, s in enumerate(["income_statement", "income_statement", "balance_sheet", "other", "cash_flow"])])))
    prov = w.select("filing_id", F.lit("Cost of revenue").alias("key"), F.array(F.lit(0), F.lit(3)).alias("chunks"))
    found = _passes(spark, sf_dir).filter("attempt = 2")
    return RT.retry_scope(chunks, found, prov).select("filing_id", "chunk_idx", "section", "scoped")


@query("retry_notes", f"""WITH {_PASSES_SQL},
 b AS (SELECT filing_id,
   string_agg('  - must: ' || message, chr(10) ORDER BY type) FILTER (WHERE severity = 'high') AS high,
   string_agg('  - ' || message, chr(10)) FILTER (WHERE severity = 'medium') AS medium FROM p WHERE attempt = 1 GROUP BY 1),
 c AS (SELECT string_agg('  • Concept ' || lpad(CAST(2 * i + 1 AS VARCHAR), 2, '0'), chr(10) ORDER BY i) FILTER (WHERE i < 10) AS top,
   string_agg('  • Concept ' || lpad(CAST(2 * i AS VARCHAR), 2, '0'), chr(10) ORDER BY i) AS seg FROM range(12) x(i))
SELECT filing_id, md5(concat_ws(chr(10), 'Needed from this pass:' || chr(10) || high, 'Worth a second look:' || chr(10) || medium,
  'Concepts still without a value:' || chr(10) || top, 'Segments still without a value:' || chr(10) || seg)) AS h FROM b, c""")
def retry_notes(spark, sf_dir):
    """The whole notes of the next pass: required lines, further ones, the first ten missing concepts, missing segments."""
    missing = I.wide_metrics(spark, sf_dir).select("filing_id", F.inline(F.array(*[
        F.struct(F.lit(f"Concept {i:02d}").alias("label"), F.lit(i % 2 == 0).alias("is_segment"), F.lit(i).alias("concept_ord"))
        for i in range(24)])))
    return RT.extraction_notes(_passes(spark, sf_dir).filter("attempt = 1"), missing).select("filing_id", F.md5("notes").alias("h"))


def runs(spark, sf_dir):
    """Run documents of supplier filings with their findings of the first pass."""
    items = F.array_compact(F.array(*[
        F.when(F.expr(c), F.struct(F.lit(t).alias("type"), F.lit(s).alias("severity"), F.expr(m).alias("message")))
        for t, s, m, _, c, _ in _PASSES]))
    status = F.when(F.col("n_lines") % 3 == 0, "failed").when(F.col("n_lines") % 3 == 1, "degraded").otherwise("saved")
    return I.wide_metrics(spark, sf_dir).select(
        F.col("filing_id").alias("_id"), F.concat(F.lit("T"), F.col("suppkey").cast("string")).alias("ticker"), status.alias("status"),
        F.make_timestamp(F.col("fy"), F.lit(6), F.lit(30), F.lit(0), F.lit(0), F.lit(0)).alias("scraped_at"),
        items.alias("findings"), F.array(F.lit("w1"), F.lit("w2"), F.lit("w3"), F.lit("w4")).alias("identity_warnings"))


_RUNS_SQL = f"""{I.METRICS_SQL}, r AS (SELECT *, 'T' || suppkey AS ticker,
  CASE n_lines % 3 WHEN 0 THEN 'failed' WHEN 1 THEN 'degraded' ELSE 'saved' END AS status FROM m)"""


@query("failure_report", f"""WITH {_RUNS_SQL}
SELECT filing_id AS _id, status, concat_ws('  ', CASE WHEN n_lines % 2 = 0 THEN 'identity_violation×1' END, CASE WHEN qty % 3 = 0 THEN 'missing_critical×1' END,
  CASE WHEN tax % 5 = 0 THEN 'source_unverified×1' END, 'suspect_value×1') AS findings_text, 'w1  w2  w3' AS warnings_text
FROM r WHERE status <> 'saved' AND fy >= 1998""")
def failure_report(spark, sf_dir):
    bad = R.failed_runs(runs(spark, sf_dir), since=F.lit("1998-01-01").cast("timestamp"))
    return R.failure_report(bad).select("_id", "status", "findings_text", "warnings_text")


@query("finding_type_totals", f"""WITH {_RUNS_SQL}, f AS (
  SELECT ticker, unnest(list_filter([CASE WHEN n_lines % 2 = 0 THEN 'identity_violation' END, CASE WHEN qty % 3 = 0 THEN 'missing_critical' END,
    CASE WHEN tax % 5 = 0 THEN 'source_unverified' END, 'suspect_value'], lambda x: x IS NOT NULL)) AS type FROM r WHERE status <> 'saved')
SELECT type, count(*) AS occurrences, count(DISTINCT ticker) AS n_tickers FROM f GROUP BY 1""")
def finding_type_totals(spark, sf_dir):
    return R.type_totals(R.failed_runs(runs(spark, sf_dir))).select(
        "type", F.col("occurrences").cast("bigint").alias("occurrences"), "n_tickers")


@query("status_totals", f"WITH {_RUNS_SQL} SELECT status, count(*) AS n_runs FROM r GROUP BY 1")
def status_totals(spark, sf_dir):
    return R.status_totals(runs(spark, sf_dir))


_GUIDES = [(i, d.id, d.remediation.replace("'", "''"), t) for i, d in enumerate(Q.REGISTRY) for t in d.types]


@query("remediation", f"""WITH {_RUNS_SQL},
 g(ord, id, line, type) AS (VALUES {", ".join(f"({i}, '{k}', '- ({k}) {text}', '{t}')" for i, k, text, t in _GUIDES)}),
 f AS (SELECT filing_id AS grp, type FROM ({" UNION ALL ".join(f"SELECT filing_id, '{t}' AS type FROM r WHERE {c}" for t, _, _, _, c, _ in _PASSES)})),
 d AS (SELECT DISTINCT grp, ord, line FROM f JOIN g USING (type))
SELECT grp, md5(string_agg(line, chr(10) ORDER BY ord)) AS h FROM d GROUP BY 1""")
def remediation(spark, sf_dir):
    """The whole guidance of a run, in the order of the checks."""
    types = runs(spark, sf_dir).select(F.col("_id").alias("grp"), F.explode("findings").alias("f")).select("grp", F.col("f.type").alias("type"))
    return R.remediation_block(types, spark).select("grp", F.md5("block").alias("h"))


@query("model_calls", "SELECT user_id AS load_request_id, count(*) FILTER (WHERE event_type = 'click') AS calls FROM events GROUP BY 1")
def model_calls(spark, sf_dir):
    e = I.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("load_request_id"), F.when(F.col("event_type") == "click", "call_llm").otherwise("call").alias("kind"))
    return R.model_calls(e)


def _loads(spark, sf_dir):
    """Two overlapping loads of yearly values; the second one restates what urgent orders hold."""
    v = I.stored_values(spark, sf_dir)
    filings = v.select(
        F.concat_ws("-", "cik", "period_type", "end_date", "concept_id").alias("filing_id"), F.col("cik").cast("string").alias("cik"),
        F.concat_ws(" ", "cik", "concept_id").alias("concept_id"),
        F.lit("Co").alias("company_name"), F.lit(12).alias("fye_month"), F.lit("1231").alias("fye_code"),
        F.lit("").alias("period_text"), F.col("end_date").alias("report_date"), F.col("period_type").alias("period_override"), "value")
    values = filings.select("filing_id", "concept_id", "value", F.lit(False).alias("derived"))
    filings = filings.drop("concept_id")
    first = S.value_rows(values, filings.drop("value").withColumn("loaded_at", F.lit("2024-01-01").cast("timestamp")))
    again = S.value_rows(values.filter("value % 2 = 0").withColumn("value", F.col("value") + 1),
                         filings.drop("value").withColumn("loaded_at", F.lit("2024-02-01").cast("timestamp")))
    return first, again


@query("upsert_values", f"""WITH {I.STORED_SQL}
SELECT cik || ' ' || concept_id AS concept_id, period_type, fiscal_year, coalesce(quarter, 0) AS quarter, CAST(cik AS VARCHAR) AS cik,
  CAST(end_date AS VARCHAR) AS end_date, CASE WHEN period_type = 'annual' THEN '10-K' ELSE '10-Q' END AS form_type,
  CASE WHEN CAST(value AS BIGINT) % 2 = 0 THEN value + 1 ELSE value END AS value,
  CASE WHEN CAST(value AS BIGINT) % 2 = 0 THEN 2 ELSE 1 END AS loaded FROM stored""")
def upsert_values(spark, sf_dir):
    first, again = _loads(spark, sf_dir)
    path = work_dir(spark, "values")
    S.upsert_values(spark, first, path)
    S.upsert_values(spark, again, path)
    return spark.read.schema(first.schema).parquet(path).select(
        "concept_id", "period_type", "fiscal_year", F.coalesce("quarter", F.lit(0)).alias("quarter"), "cik",
        F.col("end_date").cast("string").alias("end_date"), "form_type", "value", F.month("created_at").alias("loaded"))


@query("delete_period", f"""WITH {I.STORED_SQL}
SELECT cik || ' ' || concept_id AS concept_id, period_type, fiscal_year, coalesce(quarter, 0) AS quarter, value FROM stored
WHERE NOT (period_type = 'quarterly' AND quarter = 2) AND NOT (period_type = 'annual' AND fiscal_year = 1999)""")
def delete_period(spark, sf_dir):
    first, _ = _loads(spark, sf_dir)
    path = work_dir(spark, "values")
    S.upsert_values(spark, first, path)
    gone = first.filter("(period_type = 'quarterly' and quarter = 2) or (period_type = 'annual' and fiscal_year = 1999)").select(
        "cik", "period_type", "fiscal_year", "quarter")
    S.delete_periods(spark, gone, path, first.schema)
    return spark.read.schema(first.schema).parquet(path).select(
        "concept_id", "period_type", "fiscal_year", F.coalesce("quarter", F.lit(0)).alias("quarter"), "value")


@query("upsert_runs", f"""WITH {_RUNS_SQL}
SELECT filing_id AS _id, CASE WHEN n_lines % 2 = 0 THEN 'saved' ELSE status END AS status FROM r""")
def upsert_runs(spark, sf_dir):
    path = work_dir(spark, "runs")
    all_runs = runs(spark, sf_dir).select("_id", "ticker", "status", F.size("findings").alias("n"))
    odd = I.wide_metrics(spark, sf_dir).filter("n_lines % 2 = 0").select(F.col("filing_id").alias("_id"))
    S.upsert_runs(spark, all_runs, path)
    S.upsert_runs(spark, all_runs.join(odd, "_id", "left_semi").withColumn("status", F.lit("saved")), path)
    return spark.read.parquet(path).select("_id", "status")


@query("save_gate", f"""WITH {I.METRICS_SQL}
SELECT filing_id, CASE WHEN abs(ni / CAST(sh_d AS DOUBLE) - eps_d) > greatest(CAST(0.01 AS DOUBLE), abs(eps_d) * CAST(0.02 AS DOUBLE))
    OR NOT revenue BETWEEN 100000 AND 10000000000000 OR abs(ni) > 2 * revenue THEN 'identity checks failed'
  WHEN n_lines % 5 = 0 THEN 'no company, no period' WHEN n_lines % 7 = 0 THEN 'no period' ELSE '' END AS reason FROM m""")
def save_gate(spark, sf_dir):
    ops = Q.operands(I.metric_rows(spark, sf_dir)).select("filing_id", Q.blocking_warnings().alias("identity_warnings"))
    w = I.wide_metrics(spark, sf_dir).select(
        "filing_id", F.when(F.col("n_lines") % 5 != 0, F.col("suppkey")).alias("cik"), F.lit(12).alias("fye_month"),
        F.lit(None).cast("string").alias("period_text"), F.lit(1).alias("n_values"),
        F.when((F.col("n_lines") % 5 != 0) & (F.col("n_lines") % 7 != 0), F.current_date()).alias("report_date"))
    return S.save_gate(w.join(ops, "filing_id")).select("filing_id", F.coalesce("reason", F.lit("")).alias("reason"))


@query("load_gate", """
SELECT o_orderkey, CASE WHEN c_custkey IS NULL THEN 'no historical data for the company' WHEN o_orderstatus = 'P'
  THEN 'no income-statement concepts stored' ELSE '' END AS reason
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'MACHINERY') ON o_custkey = c_custkey""")
def load_gate(spark, sf_dir):
    c = I.table(spark, sf_dir, "customer").filter("c_mktsegment <> 'MACHINERY'").select(
        F.concat(F.lit("T"), F.col("c_custkey").cast("string")).alias("ticker"), F.col("c_custkey").alias("cik"),
        F.lit(12).alias("fye_month"), F.lit("1231").alias("fye_code"))
    concepts = I.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("cik"), F.lit("quarterly").alias("period_type"))
    f = I.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(F.lit("T"), F.col("o_custkey").cast("string")).alias("ticker"),
        F.when(F.col("o_orderstatus") == "P", "annual").otherwise("quarterly").alias("period_type"))
    return S.load_gate(f, c, concepts).select("o_orderkey", F.coalesce("reason", F.lit("")).alias("reason"))
