"""Checks, corrections and clean-up over supplier filings."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import patterns as P
from ..operators import cleanup as CL, quality as Q
from . import extraction as X, inputs as I, passes as PS
from .catalogue import query

_M = f"WITH {I.METRICS_SQL}\n"
_OFF = "abs(revenue - cost - gp) / CAST(revenue AS DOUBLE) > CAST(0.015 AS DOUBLE)"
_CLOSE = "abs({a} - {b}) <= CAST(0.001 AS DOUBLE) * greatest(abs({a}), abs({b}))"
_OI = _CLOSE.format(a="opex", b="oi")
_REV = _CLOSE.format(a="opex", b="revenue")


def _one(spark, sf_dir, check):
    ops = Q.operands(I.metric_rows(spark, sf_dir))
    return ops.select("filing_id", check.alias("f")).filter("f is not null").select(
        "filing_id", "f.severity", F.array_join("f.keys", "|").alias("keys"))


@query("gross_profit_identity", _M + f"""
SELECT filing_id, 'high' AS severity, CASE WHEN cost >= revenue THEN 'Revenue|Cost of revenue'
  ELSE 'Revenue|Cost of revenue|Gross profit' END AS keys FROM m WHERE revenue > 0 AND (cost >= revenue OR {_OFF})""")
def gross_profit_identity(spark, sf_dir):
    return _one(spark, sf_dir, Q.gross_profit_identity())


@query("operating_vs_gross", _M + """
SELECT filing_id, 'medium' AS severity, 'Operating income|Gross profit' AS keys FROM m
WHERE gp > 0 AND oi > 0 AND oi > gp * CAST(1.01 AS DOUBLE)""")
def operating_vs_gross(spark, sf_dir):
    return _one(spark, sf_dir, Q.operating_vs_gross())


@query("eps_ordering", _M + """
SELECT filing_id, 'medium' AS severity, 'Diluted earnings per share|Basic earnings per share' AS keys FROM m
WHERE eps_b > 0 AND eps_d > 0 AND eps_d > eps_b * CAST(1.01 AS DOUBLE)""")
def eps_ordering(spark, sf_dir):
    return _one(spark, sf_dir, Q.eps_dilution_ordering())


@query("opex_collision", _M + f"""
SELECT filing_id, 'medium' AS severity, 'Total operating expenses' || CASE WHEN {_OI} THEN '|Operating income' ELSE '' END
  || CASE WHEN {_REV} THEN '|Revenue' ELSE '' END AS keys FROM m WHERE {_OI} OR {_REV}""")
def opex_collision(spark, sf_dir):
    return _one(spark, sf_dir, Q.opex_label_collision())


@query("opex_correction", _M + f"""
SELECT filing_id, CAST(CASE WHEN {_OI} OR {_REV} THEN cost + opsub ELSE opex END AS DOUBLE) AS value FROM m""")
def opex_correction(spark, sf_dir):
    m = I.metric_rows(spark, sf_dir)
    fixed, _ = Q.correct_opex(m, Q.operands(m))
    return fixed.filter("key = 'Total operating expenses'").select("filing_id", F.col("num_value").alias("value"))


@query("opex_in_run", _M + f"""
SELECT filing_id, CAST(CASE WHEN {_OI} OR {_REV} THEN cost + opsub ELSE opex END AS DOUBLE) AS value, coalesce({_OI} OR {_REV}, false) AS noted FROM m""")
def opex_in_run(spark, sf_dir):
    rows = I.metric_rows(spark, sf_dir).withColumns({
        "chunk_idx": F.lit(0), "section": F.lit("income_statement"), "is_stale": F.lit(False)})
    metrics, found = X.check(rows)
    noted = found.filter("type = 'auto_corrected'").select("filing_id", F.lit(True).alias("noted"))
    return metrics.filter("key = 'Total operating expenses'").select("filing_id", F.col("num_value").alias("value")).join(
        noted, "filing_id", "left").withColumn("noted", F.coalesce("noted", F.lit(False)))


@query("suspect_round", _M + """
SELECT filing_id, key, v AS value FROM ml WHERE abs(v) >= 1e8 AND abs(v) < 1e11 AND v % 100000000 = 0
  AND NOT regexp_matches(key, '(?i)per share|eps|margin|ratio|rate|shares|weighted|%|percent')""")
def suspect_round(spark, sf_dir):
    return I.metric_rows(spark, sf_dir).filter(Q.is_suspect_round()).select(
        "filing_id", "key", F.col("num_value").alias("value"))


@query("presence_tiers", _M + """
, p(tier, name, rx) AS (VALUES """ + ", ".join(
    "({}, '{}', '{}')".format(t, n, p.replace("(?!.*%)", "").replace("'", "''")) for t, n, p in P.PRESENCE) + """)
SELECT filing_id, tier, name, bool_or(regexp_matches(key, '(?i)' || rx)) AS present FROM ml, p GROUP BY 1, 2, 3""")
def presence_tiers(spark, sf_dir):
    ops = Q.operands(I.metric_rows(spark, sf_dir))
    rows = F.array(*[
        F.struct(F.lit(t).alias("tier"), F.lit(n).alias("name"), F.col(f"p_{i}").alias("present"))
        for i, (t, n, _) in enumerate(P.PRESENCE)
    ])
    return ops.select("filing_id", F.inline(rows))


@query("case_duplicates", _M + f"""
SELECT filing_id, 'net income' AS normalized, 'Net income|net  income' AS keys FROM m
WHERE dup IS NOT NULL AND {_CLOSE.format(a="dup", b="ni")}""")
def case_duplicates(spark, sf_dir):
    return Q.duplicate_groups(I.metric_rows(spark, sf_dir), "filing_id").select(
        "filing_id", F.col("nk").alias("normalized"), F.array_join("ks", "|").alias("keys"))


@query("leakage_keys", _M + """
SELECT filing_id, key FROM ml WHERE regexp_matches(key, '(?i)^(GAAP|Non-GAAP)\\s+|non-gaap|\\badjusted\\b|\\breconciliation\\b|impact of\\b|\\btax impact\\b')""")
def leakage_keys(spark, sf_dir):
    return I.metric_rows(spark, sf_dir).filter(Q.is_leaked()).select("filing_id", "key")


@query("composite_keys", _M + "SELECT filing_id, key FROM ml WHERE key LIKE '% / %'")
def composite_keys(spark, sf_dir):
    return I.metric_rows(spark, sf_dir).filter(Q.is_composite()).select("filing_id", "key")


_BLOCK = """
SELECT filing_id, 'Result per share' AS warning FROM m
  WHERE abs(ni / CAST(sh_d AS DOUBLE) - eps_d) > greatest(CAST(0.01 AS DOUBLE), abs(eps_d) * CAST(0.02 AS DOUBLE))
UNION ALL SELECT filing_id, 'Revenue range' FROM m WHERE revenue > 0 AND NOT revenue BETWEEN 100000 AND 10000000000000
UNION ALL SELECT filing_id, 'Income size' FROM m WHERE revenue > 0 AND abs(ni) > 2 * revenue"""


@query("blocking_sanity", _M + _BLOCK)
def blocking_sanity(spark, sf_dir):
    ops = Q.operands(I.metric_rows(spark, sf_dir))
    return ops.select("filing_id", F.explode(Q.blocking_warnings()).alias("w")).select(
        "filing_id", F.split("w", ":")[0].alias("warning"))


@query("advisory_identities", _M + """
, t AS (
  SELECT filing_id, 'gross_margin' AS identity, CAST(gp AS DOUBLE) AS r, CAST(revenue - cost AS DOUBLE) AS c FROM m
  UNION ALL SELECT filing_id, 'operating_income', oi, gp - rd - sm - ga FROM m
  UNION ALL SELECT filing_id, 'income_before_taxes', pretax, oi + int_inc - coalesce(int_exp, 0) FROM m
  UNION ALL SELECT filing_id, 'net_income', ni, pretax - tax FROM m)
SELECT filing_id, identity, r AS reported, c AS computed FROM t
WHERE greatest(abs(r), abs(c)) > 0 AND abs(r - c) / greatest(abs(r), abs(c)) > CAST(0.005 AS DOUBLE)""")
def advisory_identities(spark, sf_dir):
    return Q.advisories(Q.operands(I.metric_rows(spark, sf_dir))).select(
        "filing_id", "identity", "reported", "computed")


@query("validator_corrections", _M + """
SELECT filing_id, 'Free cash flow' AS key FROM m WHERE returned > opcf
UNION ALL SELECT filing_id, 'Less: purchases of property' FROM m
WHERE rd > 0 AND NOT (abs(sm) / CAST(abs(rd) AS DOUBLE) BETWEEN 0.5 AND 2.0)""")
def validator_corrections(spark, sf_dir):
    m = I.metric_rows(spark, sf_dir)
    kept = Q.correct_values(m, Q.operands(m))
    return m.join(kept, ["filing_id", "key"], "left_anti").select("filing_id", "key")


@query("findings_by_type", _M + f"""
, f AS (
  SELECT filing_id, 'identity_violation' AS type, 'high' AS severity FROM m WHERE revenue > 0 AND (cost >= revenue OR {_OFF})
  UNION ALL SELECT filing_id, 'suspect_value', 'medium' FROM m WHERE gp > 0 AND oi > 0 AND oi > gp * CAST(1.01 AS DOUBLE)
  UNION ALL SELECT filing_id, 'suspect_value', 'medium' FROM m WHERE eps_b > 0 AND eps_d > 0 AND eps_d > eps_b * CAST(1.01 AS DOUBLE)
  UNION ALL SELECT filing_id, 'suspect_value', 'medium' FROM m WHERE {_OI} OR {_REV}
  UNION ALL SELECT filing_id, 'suspect_round', 'low' FROM m WHERE debt IS NOT NULL AND debt < 100000000000
  UNION ALL SELECT filing_id, 'gaap_nongaap_leakage', 'low' FROM m WHERE leak IS NOT NULL
  UNION ALL SELECT filing_id, 'composite_key', 'low' FROM m WHERE comp IS NOT NULL
  UNION ALL SELECT filing_id, 'case_duplicate', 'low' FROM m WHERE dup IS NOT NULL AND {_CLOSE.format(a="dup", b="ni")}
  UNION ALL SELECT filing_id, 'missing_expected', 'medium' FROM m
  UNION ALL SELECT filing_id, 'missing_expected', 'medium' FROM m WHERE int_exp IS NULL)
SELECT type, severity, count(*) AS n, count(DISTINCT filing_id) AS n_filings FROM f GROUP BY 1, 2""")
def findings_by_type(spark, sf_dir):
    found = Q.findings(I.metric_rows(spark, sf_dir))
    per = found.groupBy("type", "severity", "filing_id").agg(F.count(F.lit(1)).alias("k"))
    return per.groupBy("type", "severity").agg(F.sum("k").alias("n"), F.count(F.lit(1)).alias("n_filings"))


@query("near_equal_pairs", _M + f"""
, w AS (SELECT filing_id, key AS key_b, v AS b, lag(key) OVER o AS key_a, lag(v) OVER o AS a
  FROM ml WHERE v <> 0 WINDOW o AS (PARTITION BY filing_id ORDER BY v, key_ord))
SELECT filing_id, key_a, key_b FROM w WHERE {_CLOSE.format(a="a", b="b")}""")
def near_equal_pairs(spark, sf_dir):
    return CL.near_equal_pairs(I.metric_rows(spark, sf_dir)).select("filing_id", "key_a", "key_b")


@query("cleanup_candidates", _M + f"""
, w AS (SELECT filing_id, key, v, key LIKE '%e%x%' AS prot, key_ord FROM ml),
 l AS (SELECT filing_id, v AS b, prot AS pb, lag(v) OVER o AS a, lag(prot) OVER o AS pa FROM w WHERE v <> 0
  WINDOW o AS (PARTITION BY filing_id ORDER BY v, key_ord)),
 r AS (SELECT filing_id, 'near_equal' AS why FROM l WHERE {_CLOSE.format(a="a", b="b")} AND NOT (pa AND pb)
  UNION ALL SELECT filing_id, 'per_share' FROM w WHERE abs(v) > 10000 AND regexp_matches(key, '(?i)\\b(per\\s*share|eps)\\b') AND NOT prot)
SELECT filing_id, string_agg(DISTINCT why, ',' ORDER BY why) AS reasons FROM r GROUP BY 1""")
def cleanup_candidates(spark, sf_dir):
    m = I.metric_rows(spark, sf_dir).withColumn("protected", F.col("key").like("%e%x%"))
    return CL.needs_cleanup(m).select("filing_id", F.array_join("reasons", ",").alias("reasons"))


@query("cleanup_drops", _M + f"""
SELECT filing_id, key, key_ord, v AS value FROM ml JOIN (SELECT filing_id AS f, dup, ni FROM m) ON filing_id = f
WHERE key NOT IN ('Adjusted operating income', 'Diluted EPS and more / Diluted net income')
  AND NOT (key = 'net  income' AND {_CLOSE.format(a="dup", b="ni")})""")
def cleanup_drops(spark, sf_dir):
    m = I.metric_rows(spark, sf_dir)
    return CL.drop_flagged(m, Q.findings(m)).select("filing_id", "key", "key_ord", F.col("num_value").alias("value"))


@query("cleanup_guardrails", _M + """
, a AS (SELECT filing_id, CASE WHEN n_lines % 4 = 0 THEN 'No such key' ELSE 'Sales and marketing' END AS key, 'rule A' AS reason FROM m
  UNION ALL SELECT filing_id, 'Interest income', '' FROM m
  UNION ALL SELECT filing_id, 'Free cash flow', 'rule C' FROM m
  UNION ALL SELECT filing_id, 'Revenue', 'rule A' FROM m),
 ok AS (SELECT a.filing_id FROM a LEFT JOIN ml USING (filing_id, key) GROUP BY 1 HAVING bool_and(ml.v IS NOT NULL)),
 gone AS (SELECT filing_id, key FROM a WHERE filing_id IN (SELECT filing_id FROM ok) AND reason <> '' AND key <> 'Revenue')
SELECT filing_id, key, key_ord, v AS value FROM ml ANTI JOIN gone USING (filing_id, key)""")
def cleanup_guardrails(spark, sf_dir):
    m = I.metric_rows(spark, sf_dir).withColumn("protected", F.col("key") == "Revenue")
    first = F.when(F.col("n_lines") % 4 == 0, "No such key").otherwise("Sales and marketing")
    asked = F.array(
        F.struct(first.alias("key"), F.lit("rule A").alias("reason")),
        F.struct(F.lit("Interest income").alias("key"), F.lit("").alias("reason")),
        F.struct(F.lit("Free cash flow").alias("key"), F.lit("rule C").alias("reason")),
        F.struct(F.lit("Revenue").alias("key"), F.lit("rule A").alias("reason")))
    answers = I.wide_metrics(spark, sf_dir).select("filing_id", F.inline(asked))
    return CL.guarded_removal(m, answers).select("filing_id", "key", "key_ord", F.col("num_value").alias("value"))


@query("cleanup_payload", _M + """
SELECT filing_id, count(*) AS n_keys FROM ml GROUP BY 1""")
def cleanup_payload(spark, sf_dir):
    p = CL.prompt_payload(I.metric_rows(spark, sf_dir))
    return p.select("filing_id", F.size(F.json_object_keys("payload").cast("array<string>")).cast("bigint").alias("n_keys"))


@query("three_passes", f"""
WITH {I.FACTS_SQL}, k AS (SELECT *, suppkey % 4 AS kind FROM facts),
 a AS (SELECT suppkey || '-' || fy AS filing_id, CASE kind WHEN 0 THEN 1 WHEN 2 THEN 3 ELSE 2 END AS attempts,
  CASE kind WHEN 3 THEN 'no_progress' ELSE 'clean' END AS reason, CAST(CASE WHEN kind = 3 THEN revenue + 1 ELSE cost END AS DOUBLE) AS cost,
  CAST(rd AS DOUBLE) AS rd FROM k)
SELECT filing_id, CAST(attempts AS BIGINT) AS attempts, reason, CAST(2 + attempts AS BIGINT) AS n_chunks, cost, rd, attempts AS cost_from, 1 AS rd_from FROM a""")
def three_passes(spark, sf_dir):
    """Filings that end after one, two and three passes; later passes ask for the doubted chunk only."""
    f = I.facts(spark, sf_dir).withColumn("kind", F.col("suppkey") % 4).withColumn("filing_id", F.concat_ws("-", "suppkey", "fy"))
    section = F.array(*[F.struct(F.lit(i).alias("chunk_idx"), F.lit(s).alias("section")) for i, s in enumerate(("income_statement", "other", "balance_sheet"))])
    chunks = f.select("filing_id", F.inline(section))
    attempt = F.explode(F.array(*[F.lit(i) for i in (1, 2, 3)])).alias("attempt")
    right = (F.col("kind") == 0) | ((F.col("kind") == 1) & (F.col("attempt") > 1)) | (F.col("attempt") > 2)
    wrong = F.col("revenue") + F.when(F.col("kind") == 3, 1).otherwise(F.col("attempt"))
    cost = F.when(right & (F.col("kind") != 3), F.col("cost")).otherwise(wrong)
    line = lambda chunk, i, key, v: F.struct(
        F.lit(chunk).alias("chunk_idx"), F.lit(key).alias("key"), F.lit(chunk * 2**32 + i).alias("key_ord"), v.cast("double").alias("num_value"))
    answers = f.select("*", attempt).select(
        "filing_id", F.col("suppkey").cast("string").alias("cik"), "attempt", F.inline(F.array(
            line(0, 0, "Revenue", F.col("revenue")), line(0, 1, "Cost of revenue", cost), line(0, 2, "Gross profit", F.col("revenue") - F.col("cost")),
            line(1, 0, "Research and development", F.col("rd") * F.col("attempt")), line(2, 0, "Total assets", F.col("ga")))))

    def ask(scope):
        return scope.join(answers, ["filing_id", "chunk_idx", "attempt"]).select(
            "filing_id", "cik", "chunk_idx", "section", "key", "key_ord", "num_value", F.lit(None).cast("string").alias("str_value"), F.lit(False).alias("is_stale"))

    run = PS.run_passes(chunks, ask)
    value = lambda key, name: F.max(F.when(F.col("key") == key, F.col("num_value"))).alias(name)
    origin = lambda key, name: F.max(F.when(F.col("key") == key, F.col("attempt"))).alias(name)
    last = run.decisions.groupBy("filing_id").agg(
        F.count(F.lit(1)).alias("attempts"), F.max_by("reason", "attempt").alias("reason"), F.sum("n_chunks").alias("n_chunks"))
    values = run.metrics.groupBy("filing_id").agg(value("Cost of revenue", "cost"), value("Research and development", "rd"))
    sources = run.sources.groupBy("filing_id").agg(origin("Cost of revenue", "cost_from"), origin("Research and development", "rd_from"))
    return last.join(values, "filing_id").join(sources, "filing_id")
