"""Concept dictionaries, mapping and derivation over suppliers and parts."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import roles
from ..operators import concepts as C, label_search as LS, derive as D, history as H, reports as R
from . import inputs as I
from .catalogue import query

_RAW_SQL = """raw AS (
  SELECT p_brand AS cik, CASE WHEN p_size % 7 = 0 THEN 'annual' ELSE 'quarterly' END AS period_type,
    CASE WHEN p_retailprice > 1500 THEN 'SYSTEM:Part' ELSE 'us-gaap:Part' END || p_partkey AS concept,
    lpad(CAST(p_size AS VARCHAR), 3, '0') || CASE WHEN p_partkey % 3 = 0 THEN '' ELSE '.' || lpad(CAST(p_partkey % 97 AS VARCHAR), 3, '0') END AS path,
    p_partkey AS concept_id, p_name AS head, p_type,
    CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN '' ELSE upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) || 'Line' END AS mt,
    p_size % 11 = 0 AS hide, p_size % 13 = 0 AS inactive, p_retailprice > 1500 AS sys, p_partkey % 19 = 0 AS calc
  FROM part),
 vis AS (SELECT *, CASE WHEN mt = '' THEN '' ELSE substr(mt, 1, length(mt) - 4) || ' Line' END AS member,
    CASE WHEN mt = '' THEN concept ELSE concept || '|us-gaap:' || mt || 'Member' END AS taxonomy_key
  FROM raw WHERE NOT inactive AND (NOT hide OR sys OR calc)),
 lab AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY cik, period_type, lower(head)) > 1 AND member <> ''
    THEN head || ' (' || member || ')' ELSE head END AS label FROM vis),
 cl AS (SELECT * FROM lab QUALIFY row_number() OVER (PARTITION BY cik, period_type, lower(label) ORDER BY path, concept_id) = 1)"""


def raw_concepts(spark, sf_dir):
    size, key = F.col("p_size"), F.col("p_partkey")
    tag = F.concat(F.initcap(F.lower("p_type")), F.lit("LineMember"))
    plain = F.col("p_type").isin("ECONOMY", "PROMO")
    return I.table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("cik"), F.when(size % 7 == 0, "annual").otherwise("quarterly").alias("period_type"),
        F.lit("income_statement").alias("statement_type"), key.alias("concept_id"),
        F.concat(F.when(F.col("p_retailprice") > 1500, "SYSTEM:Part").otherwise("us-gaap:Part"), key.cast("string")).alias("concept"),
        F.concat(F.lpad(size.cast("string"), 3, "0"), F.when(key % 3 == 0, "").otherwise(
            F.concat(F.lit("."), F.lpad((key % 97).cast("string"), 3, "0")))).alias("path"),
        F.when(plain, F.col("p_name")).otherwise(
            F.concat(F.replace("p_name", F.lit(" "), F.lit("  ")), F.lit("\n\n\nus-gaap:"), tag)).alias("label"),
        F.lit(None).cast("boolean").alias("abstract"), F.when(size % 11 == 0, True).alias("hide"),
        F.when(size % 13 == 0, False).alias("active"), F.when(key % 19 == 0, "True").alias("calculated"))


@query("concept_labels", f"WITH {_RAW_SQL} SELECT cik, period_type, concept_id, label, path, taxonomy_key FROM cl")
def concept_labels(spark, sf_dir):
    return C.statement_concepts(raw_concepts(spark, sf_dir)).select(
        "cik", "period_type", "concept_id", "label", "path", "taxonomy_key")


@query("calculated_concepts", f"""WITH {_RAW_SQL}
SELECT cik, concept_id, head AS label FROM raw WHERE NOT inactive AND NOT hide AND (sys OR calc)""")
def calculated_concepts(spark, sf_dir):
    return C.calculated_concepts(raw_concepts(spark, sf_dir)).select("cik", "concept_id", "label")


@query("concept_children", f"""WITH {_RAW_SQL}
SELECT k.cik, p.concept_id AS parent_id, k.concept_id AS child_id FROM cl k JOIN cl p
  ON k.cik = p.cik AND k.path LIKE '%.%' AND p.path = substr(k.path, 1, length(k.path) - 4)""")
def concept_children(spark, sf_dir):
    return C.children(C.statement_concepts(raw_concepts(spark, sf_dir)))


@query("concept_prompt_list", f"""WITH {_RAW_SQL},
 par AS (SELECT cik, path AS up, arg_min(label, CASE WHEN taxonomy_key LIKE 'us-gaap:%' THEN '0' ELSE '1' END || lpad(CAST(concept_id AS VARCHAR), 12, '0')) AS parent FROM cl GROUP BY 1, 2)
SELECT cl.cik, concept_id, '  • "' || label || '"' || coalesce(' -- ' || parent, '') || '  [' || taxonomy_key || ']' AS line
FROM cl LEFT JOIN par ON cl.cik = par.cik AND cl.path LIKE '%.%' AND par.up = substr(cl.path, 1, length(cl.path) - 4)""")
def concept_prompt_list(spark, sf_dir):
    return C.prompt_lines(C.statement_concepts(raw_concepts(spark, sf_dir))).select("cik", "concept_id", "line")


@query("concept_pruning", f"""WITH {_RAW_SQL},
 v AS (SELECT p_brand AS cik, p_partkey AS concept_id, CAST(l_shipdate AS DATE) AS e FROM lineitem JOIN part ON l_partkey = p_partkey),
 ends AS (SELECT cik, e FROM (SELECT DISTINCT cik, e FROM v) QUALIFY row_number() OVER (PARTITION BY cik ORDER BY e DESC) <= 3),
 rec AS (SELECT DISTINCT cik, concept_id FROM v JOIN ends USING (cik, e)),
 mk AS (SELECT cl.cik, cl.concept_id, r.concept_id IS NOT NULL AS is_recent FROM cl LEFT JOIN rec r ON cl.cik = r.cik AND cl.concept_id = r.concept_id)
SELECT cik, concept_id FROM mk QUALIFY is_recent OR NOT max(is_recent) OVER (PARTITION BY cik)""")
def concept_pruning(spark, sf_dir):
    parts = I.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("concept_id"), F.col("p_brand").alias("cik"))
    v = I.table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("concept_id"), F.col("l_shipdate").cast("date").alias("end_date"),
        F.lit("quarterly").alias("period_type")).join(parts, "concept_id")
    recent = H.recent_concepts(v)
    return H.prune_concepts(C.statement_concepts(raw_concepts(spark, sf_dir)), recent).select("cik", "concept_id")


_KEYS = ["[us-gaap:Revenues]", "us-gaap:CostOfRevenue", "Gross profit", "operating  INCOME", "Revenue", "Unlisted", "Net income"]
_CONCEPT_OF = ["c01", "c02", "c03", "c08", "c01", None, "c11"]
_TIER_OF = [0, 0, 1, 2, 1, None, 1]


def _line_metrics(spark, sf_dir):
    n = F.col("l_linenumber")
    month = F.date_format("l_shipdate", "yyyyMM")
    key = F.element_at(F.array(*[F.lit(k) for k in _KEYS]), ((n - 1) % len(_KEYS) + 1).cast("int"))
    return I.table(spark, sf_dir, "lineitem").groupBy(
        F.concat_ws("-", "l_suppkey", month).alias("filing_id"), F.col("l_suppkey").cast("string").alias("cik"),
        key.alias("key"), n.cast("bigint").alias("key_ord"),
    ).agg(F.max(I.whole(F.col("l_extendedprice"))).cast("double").alias("num_value"))


_LINE_SQL = """lm AS (SELECT l_suppkey || '-' || strftime(l_shipdate, '%Y%m') AS filing_id, (l_linenumber - 1) % 7 AS k, l_linenumber AS o,
    CAST(max(CAST(floor(l_extendedprice) AS BIGINT)) AS DOUBLE) AS v FROM lineitem GROUP BY 1, 2, 3)"""


@query("tier_map", f"""WITH {_LINE_SQL},
 t AS (SELECT filing_id, list_extract({[c or '' for c in _CONCEPT_OF]}, CAST(k + 1 AS INTEGER)) AS concept_id,
   list_extract({[x if x is not None else 9 for x in _TIER_OF]}, CAST(k + 1 AS INTEGER)) AS tier, v, o FROM lm)
SELECT filing_id, concept_id, CAST(arg_max(tier, o) AS INTEGER) AS tier, arg_max(v, o) AS value FROM t WHERE concept_id <> '' GROUP BY 1, 2""")
def tier_map(spark, sf_dir):
    return C.map_metrics(_line_metrics(spark, sf_dir), I.supplier_concepts(spark, sf_dir)).select(
        "filing_id", "concept_id", "tier", "value")


@query("semantic_map", f"""WITH {_LINE_SQL},
 t AS (SELECT filing_id, list_extract({[c or '' for c in _CONCEPT_OF]}, CAST(k + 1 AS INTEGER)) AS concept_id, v, o, k FROM lm),
 base AS (SELECT filing_id, concept_id, arg_max(v, o) AS value FROM t WHERE concept_id <> '' GROUP BY 1, 2)
SELECT filing_id, concept_id, value FROM base UNION ALL
SELECT filing_id, 'c09', v FROM lm WHERE k = 5""")
def semantic_map(spark, sf_dir):
    metrics = _line_metrics(spark, sf_dir)
    concepts = I.supplier_concepts(spark, sf_dir)
    mapped = C.map_metrics(metrics, concepts).select("filing_id", "concept_id", "key", "value", "tier", "key_ord")
    filings = metrics.select("filing_id", "cik").distinct()
    asked = C.semantic_candidates(C.unmapped(filings.join(concepts, "cik"), mapped))
    answers = filings.select("filing_id", F.inline(F.array(*[
        F.struct(F.lit(i).alias("resp_ord"), F.lit(c).alias("concept_id"), F.lit(k).alias("key"))
        for i, (c, k) in enumerate([("c99", "Unlisted"), ("c09", "Unlisted"), ("c13", "Unlisted"), ("c10", "Invented")])])))
    return C.apply_semantic_map(mapped, answers, metrics, asked).select("filing_id", "concept_id", "value")


@query("unmapped_concepts", f"""WITH {_LINE_SQL},
 f AS (SELECT DISTINCT filing_id FROM lm), c AS (SELECT unnest({[c[0] for c in I.CONCEPTS]}) AS concept_id),
 t AS (SELECT DISTINCT filing_id, list_extract({[c or '' for c in _CONCEPT_OF]}, CAST(k + 1 AS INTEGER)) AS concept_id FROM lm)
SELECT filing_id, count(*) AS n_missing FROM (SELECT filing_id, concept_id FROM f, c EXCEPT SELECT * FROM t) GROUP BY 1""")
def unmapped_concepts(spark, sf_dir):
    metrics, concepts = _line_metrics(spark, sf_dir), I.supplier_concepts(spark, sf_dir)
    lists = metrics.select("filing_id", "cik").distinct().join(concepts, "cik")
    return C.unmapped(lists, C.map_metrics(metrics, concepts)).groupBy("filing_id").agg(
        F.count(F.lit(1)).alias("n_missing"))


_ROLE_OF = {
    "Revenue": "revenue", "Cost of revenue": "cost_of_revenue", "Gross profit": "gross_profit",
    "Operating income": "operating_income", "Operating expenses": "total_opex",
    "Total operating expenses": "total_opex", "Net income": "net_income",
    "Basic earnings per share": "eps_basic", "Diluted earnings per share": "eps_diluted",
    "Weighted average shares outstanding: diluted": "shares_diluted", "net  income": "net_income",
    "Adjusted operating income": "operating_income", "Diluted EPS and more / Diluted net income": "eps_diluted",
    "Income before taxes": "pretax_income", "Provision for income taxes": "tax_expense",
    "Research and development": "rd_expense", "Sales and marketing": "sm_expense",
    "General and administrative": "ga_expense", "Interest expense": "interest_expense",
    "Interest income": "interest_income",
}


@query("role_identify", f"""WITH {I.METRICS_SQL},
 r(key, role) AS (VALUES {", ".join(f"('{k}', '{v}')" for k, v in _ROLE_OF.items())})
SELECT filing_id, key, coalesce(CASE WHEN key = 'Long-term debt' THEN 'total_opex' ELSE role END, '') AS role FROM ml LEFT JOIN r USING (key)""")
def role_identify(spark, sf_dir):
    tax = F.when(F.col("key") == "Long-term debt", "us-gaap:CostsAndExpenses|x:Member")
    return I.metric_rows(spark, sf_dir).select(
        "filing_id", "key", F.coalesce(roles.role_of(F.col("key"), tax), F.lit("")).alias("role"))


@query("role_answers", """
SELECT CAST(s_suppkey AS VARCHAR) AS cik, x.concept_id, x.role FROM supplier,
  (VALUES ('n1', 'other_income_net'), ('n2', ''), ('n3', 'revenue'), ('n4', '')) x(concept_id, role)""")
def role_answers(spark, sf_dir):
    rows = F.array(*[
        F.struct(F.lit(i).alias("concept_id"), F.lit(lb).alias("label"), F.lit(t).alias("taxonomy_key"))
        for i, lb, t in [("n1", "Sundry", ""), ("n2", "Mystery", ""), ("n3", "Net sales", ""), ("n4", "Widgets", "x|y")]])
    s = I.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("cik"))
    answers = s.select("cik", F.inline(F.array(*[
        F.struct(F.lit(lb).alias("label"), F.lit(r).alias("role"))
        for lb, r in [("Sundry", "other_income_net"), ("Mystery", "made_up_role"), ("Net sales", "net_income")]])))
    return C.with_roles(s.select("cik", F.inline(rows)), answers).select(
        "cik", "concept_id", F.coalesce("role", F.lit("")).alias("role"))


_TREE = [
    ("p1", "Cost of revenue", "002", "cost_of_revenue"), ("p1a", "Product cost", "002.1", None),
    ("p1b", "Service cost", "002.2", None), ("p2", "Gross profit", "003", "gross_profit"),
    ("p2a", "Gross detail", "003.1", None), ("p3", "Total operating expenses", "007", "total_opex"),
    ("p3a", "Selling cost", "007.1", None), ("p3b", "Admin cost", "007.2", None),
    ("p4", "Revenue", "001", "revenue"), ("p5", "Operating income", "008", "operating_income"),
]
_TREE_VALUES = [
    ("p1", "CASE WHEN n_lines % 3 <> 0 THEN cost + 7 END"), ("p1a", "ga"),
    ("p1b", "CASE WHEN n_lines % 2 = 0 THEN sm END"), ("p2", "CASE WHEN n_lines % 5 = 0 THEN gp END"),
    ("p3", "CASE WHEN n_lines % 7 = 0 THEN opsub END"), ("p3a", "CASE WHEN qty % 2 = 0 THEN sm END"),
    ("p3b", "ga"), ("p4", "revenue"), ("p5", "oi"),
]


def _filing_concepts(spark, sf_dir, rows, keep=None):
    item = F.array(*[
        F.struct(F.lit(i).alias("concept_id"), F.lit(lb).alias("label"), F.lit(p).alias("path"),
                 F.lit(p).alias("concept_ord"), F.lit(r).cast("string").alias("role")) for i, lb, p, r in rows])
    w = I.wide_metrics(spark, sf_dir)
    out = w.select("filing_id", "n_lines", "qty", F.inline(item))
    return out.filter(keep) if keep else out


def _filing_values(spark, sf_dir, values):
    item = F.array(*[
        F.struct(F.lit(i).alias("concept_id"), F.expr(e).cast("double").alias("value"), F.lit(n).alias("key_ord"))
        for n, (i, e) in enumerate(values)])
    return I.wide_metrics(spark, sf_dir).select("filing_id", F.inline(item)).filter("value is not null")


@query("parent_child_rollup", f"""WITH {I.METRICS_SQL},
 c AS (SELECT *, CASE WHEN n_lines % 2 = 0 THEN ga + sm WHEN n_lines % 3 <> 0 THEN cost + 7 END AS x1 FROM m),
 g AS (SELECT *, CASE WHEN n_lines % 5 = 0 THEN gp ELSE revenue - x1 END AS x2 FROM c)
SELECT filing_id, 'p1' AS concept_id, CAST(x1 AS DOUBLE) AS value FROM g WHERE x1 IS NOT NULL
UNION ALL SELECT filing_id, 'p2', x2 FROM g WHERE x2 IS NOT NULL
UNION ALL SELECT filing_id, 'p3', CASE WHEN qty % 2 = 0 THEN sm + ga WHEN n_lines % 7 = 0 THEN opsub ELSE x2 - oi END FROM g
  WHERE qty % 2 = 0 OR n_lines % 7 = 0 OR x2 IS NOT NULL""")
def parent_child_rollup(spark, sf_dir):
    values = _filing_values(spark, sf_dir, _TREE_VALUES)
    concepts = _filing_concepts(spark, sf_dir, _TREE)
    return D.roll_up(values, concepts).filter("concept_id in ('p1', 'p2', 'p3')").select(
        "filing_id", "concept_id", "value")


_CHAIN = [(c[0], c[2], c[3], r) for c, r in zip(I.CONCEPTS, (
    "revenue", "cost_of_revenue", "gross_profit", "rd_expense", "sm_expense", "ga_expense", "total_opex",
    "operating_income", "pretax_income", "tax_expense", "net_income", "shares_basic", "eps_basic", "gross_margin_pct"))]
_CHAIN += [("c15", "Interest expense", "015", "interest_expense"), ("c16", "Net margin %", "016", "net_margin_pct")]
_CHAIN_VALUES = [("c01", "revenue"), ("c02", "cost"), ("c04", "rd"), ("c05", "sm"), ("c06", "ga"), ("c10", "tax"),
                 ("c12", "qty"), ("c15", "int_exp")]
_CHAIN_KEEP = "not (concept_id = 'c03' and n_lines % 4 = 0)"


@query("derive_chain", f"""WITH {I.METRICS_SQL},
 g AS (SELECT *, CASE WHEN n_lines % 4 <> 0 THEN revenue - cost END AS g FROM m),
 o AS (SELECT *, g - (rd + sm + ga) AS o FROM g),
 n AS (SELECT *, CASE WHEN int_exp IS NULL THEN o END AS p FROM o),
 e AS (SELECT *, p - tax AS ni2 FROM n),
 r AS (
  SELECT filing_id, 'c03' AS concept_id, CAST(g AS DOUBLE) AS value FROM e UNION ALL SELECT filing_id, 'c07', rd + sm + ga FROM e
  UNION ALL SELECT filing_id, 'c08', o FROM e UNION ALL SELECT filing_id, 'c09', p FROM e UNION ALL SELECT filing_id, 'c11', ni2 FROM e
  UNION ALL SELECT filing_id, 'c13', CASE WHEN abs(ni2 / CAST(qty AS DOUBLE)) <= 1000 THEN ni2 / CAST(qty AS DOUBLE) END FROM e
  UNION ALL SELECT filing_id, 'c14', g / CAST(revenue AS DOUBLE) * 100 FROM e UNION ALL SELECT filing_id, 'c16', ni2 / CAST(revenue AS DOUBLE) * 100 FROM e)
SELECT filing_id, concept_id, floor(value * 10000) / 10000 AS value FROM r WHERE value IS NOT NULL""")
def derive_chain(spark, sf_dir):
    return D.derive(_filing_values(spark, sf_dir, _CHAIN_VALUES),
                    _filing_concepts(spark, sf_dir, _CHAIN, _CHAIN_KEEP)).select(
        "filing_id", "concept_id", (F.floor(F.col("value") * 10000) / 10000).alias("value"))


@query("derivation_gaps", f"""WITH {I.METRICS_SQL},
 x AS (SELECT filing_id, n_lines % 4 = 0 AS nog, int_exp IS NOT NULL AS blocked,
    NOT (n_lines % 4 = 0) AND int_exp IS NULL AS full_chain FROM m)
SELECT filing_id, 'c08' AS concept_id, 'gross_profit' AS missing FROM x WHERE nog
UNION ALL SELECT filing_id, 'c09', 'operating_income' FROM x WHERE nog
UNION ALL SELECT filing_id, 'c11', 'pretax_income' FROM x WHERE nog OR blocked
UNION ALL SELECT filing_id, 'c13', 'net_income' FROM x WHERE nog OR blocked
UNION ALL SELECT filing_id, 'c14', 'gross_profit' FROM x WHERE nog
UNION ALL SELECT filing_id, 'c16', 'net_income' FROM x WHERE nog OR blocked""")
def derivation_gaps(spark, sf_dir):
    return D.gaps(_filing_values(spark, sf_dir, _CHAIN_VALUES),
                  _filing_concepts(spark, sf_dir, _CHAIN, _CHAIN_KEEP)).select(
        "filing_id", "concept_id", F.array_join("missing", ",").alias("missing"))


@query("fill_summary", f"""WITH {I.METRICS_SQL},
 g AS (SELECT filing_id, n_lines % 4 = 0 AS nog, int_exp IS NOT NULL AS ie,
    CASE WHEN n_lines % 4 <> 0 AND int_exp IS NULL AND abs((revenue - cost - rd - sm - ga - tax) / CAST(qty AS DOUBLE)) <= 1000 THEN 1 ELSE 0 END AS eps FROM m),
 k AS (SELECT filing_id, 7 + CAST(ie AS INTEGER) AS mapped, CASE WHEN nog THEN 1 WHEN ie THEN 4 ELSE 7 + eps END AS derived,
   CASE WHEN nog THEN 15 ELSE 16 END AS total FROM g)
SELECT filing_id, CAST(mapped AS BIGINT) AS mapped, CAST(derived AS BIGINT) AS derived,
  CAST(total - mapped - derived AS BIGINT) AS absent_toplevel, CAST(0 AS BIGINT) AS absent_segment, CAST(total AS BIGINT) AS total FROM k""")
def fill_summary(spark, sf_dir):
    values = _filing_values(spark, sf_dir, _CHAIN_VALUES)
    concepts = _filing_concepts(spark, sf_dir, _CHAIN, _CHAIN_KEEP).withColumn("taxonomy_key", F.lit("x"))
    derived = D.derive(values, concepts).select("filing_id", "concept_id", F.lit(True).alias("derived"))
    done = values.select("filing_id", "concept_id", F.lit(False).alias("derived")).unionByName(derived)
    return R.fill_summary(concepts, done)


@query("insertion_summary", f"""WITH {I.METRICS_SQL},
 k AS (SELECT filing_id, n_lines % 4 = 0 AS nog, int_exp IS NOT NULL AS ie FROM m)
SELECT filing_id, label, CASE WHEN label IN ('Revenue', 'Cost of revenue') THEN 0
  WHEN label = 'Gross profit' THEN 1 WHEN label = 'Operating income' THEN CASE WHEN nog THEN 2 ELSE 1 END
  ELSE CASE WHEN ie THEN 0 ELSE 2 END END AS grp
FROM k, (VALUES ('Revenue'), ('Cost of revenue'), ('Gross profit'), ('Operating income'), ('Interest expense')) x(label)
WHERE NOT (label = 'Gross profit' AND nog)""")
def insertion_summary(spark, sf_dir):
    values = _filing_values(spark, sf_dir, _CHAIN_VALUES)
    concepts = _filing_concepts(spark, sf_dir, _CHAIN, _CHAIN_KEEP)
    derived = D.derive(values, concepts).select("filing_id", "concept_id", "value", F.lit(True).alias("derived"))
    done = values.select("filing_id", "concept_id", "value", F.lit(False).alias("derived")).unionByName(derived)
    return R.insertion_lines(concepts, done).filter(
        "concept_id in ('c01', 'c02', 'c03', 'c08', 'c15')").select("filing_id", "label", "grp")


# label looked for, text around the figure N (and M, twice N), how it is found, and which number of it counts; null where none is to be found
_SAID = [
    ("Gross profit", "The year brought a Gross&nbsp;profit of $N, after M before.", 0, "N"),
    ("Gross profit", "<p>In short</p>\nGross profit | $ M | N\nOther 5,000", 0, "N"),
    ("Interest Expense, Deposits", "Deposits rose. Interest expense\nLoans 7,000\nDeposits N\n", 1, "N"),
    ("Interest Expense, Trading Liabilities", "Interest expense:\nTrading account liabilities M\nBorrowings 9,000", 2, "M"),
    ("Deposits held", "Consolidated Balance Sheets\nDeposits held N\n", 0, None),
    ("Deposits held", "Deposits held N\nTotal assets M", 0, None),
    ("Gross profit", "Gross profit grew since 2019 by much.", 0, None),
    ("Interest Expense, Deposits", "Interest expense " + "and so on " * 70 + "\nDeposits N", 1, None),
    ("Service fees", "Service feesN were N units; the Service fees came to M in all.", 0, "M"),
    ("Gross profit", "Gross profit 2019\nlater Gross profit N", 0, None),
    ("Gross profit", "Gross profitable N and profit, gross N", 0, None),
]


@query("label_search", f"""
WITH {I.FACTS_SQL}, x(i, how, twice) AS (VALUES {", ".join(f"({i}, {how}, {n == 'M'})" for i, (_, _, how, n) in enumerate(_SAID) if n)}),
 s AS (SELECT suppkey || '-' || fy AS filing_id, revenue AS n, suppkey % {len(_SAID)} AS i FROM facts)
SELECT filing_id, 'c' || s.i AS concept_id, CAST(CASE WHEN twice THEN 2 * n ELSE n END AS DOUBLE) AS value, how FROM s JOIN x USING (i)""")
def label_search(spark, sf_dir):
    """Concepts found in prose, by label, by child behind the parent, by most words; guards keep the rest out."""
    f = I.facts(spark, sf_dir).withColumn("i", (F.col("suppkey") % len(_SAID)).cast("int"))
    filing, figure = F.concat_ws("-", "suppkey", "fy").alias("filing_id"), lambda x: F.format_number(x, 0)
    pick = lambda k: F.element_at(F.array(*[F.lit(row[k]) for row in _SAID]), F.col("i") + 1)
    marked = F.regexp_replace(F.regexp_replace(F.replace(pick(1), F.lit("&nbsp;"), F.lit("\u00a0")), r"N(?![a-z])", "\u0001"), r"M(?![a-z])", "\u0002")
    text = F.replace(F.replace(marked, F.lit("\u0001"), figure(F.col("revenue"))), F.lit("\u0002"), figure(2 * F.col("revenue")))
    texts = f.select(filing, text.alias("raw_text"))
    missing = f.select(filing, F.concat(F.lit("c"), F.col("i").cast("string")).alias("concept_id"), pick(0).alias("label"), F.lit(False).alias("is_segment"))
    return LS.search(missing, texts).select("filing_id", "concept_id", "value", "how")
