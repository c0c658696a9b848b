"""Response parsing, scaling and merging, with order lines as chunks of a filing."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import merge as M
from ..session import spread, work_dir
from ..sources import responses as RS
from . import inputs as I
from .catalogue import query

_CHUNK = "CAST(l_linenumber * 1000000 + l_partkey % 1000000 AS BIGINT)"
_SECTION = {"A": "income_statement", "N": "other", "R": "balance_sheet"}
_SECTION_SQL = "CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 3 ELSE 1 END"


def _lines(spark, sf_dir):
    section = F.element_at(F.create_map(*[F.lit(x) for kv in _SECTION.items() for x in kv]), F.col("l_returnflag"))
    return spread(I.table(spark, sf_dir, "lineitem")).select(
        F.col("l_orderkey").alias("filing_id"), F.expr(_CHUNK).alias("chunk_idx"), section.alias("section"),
        I.whole(F.col("l_extendedprice")).alias("price"), I.whole(F.col("l_quantity")).alias("qty"),
        F.year("l_shipdate").alias("y"), "l_returnflag", "l_linestatus", "l_linenumber", "l_discount", "l_tax", "l_partkey")


def response_texts(spark, sf_dir):
    """One JSON answer per order line: fenced, with repeated keys, wrong types, or cut off."""
    s = lambda c: F.col(c).cast("string")
    body = F.concat(
        F.lit('{"__scale__": "thousands", "__period__": "Year Ended December 31, '), s("y"), F.lit('", "Revenue": 1, "Cost of revenue": '),
        s("qty"), F.lit('.5, "Units": "'), s("qty"), F.lit('", "Open": true, "Gone": null, "Revenue": '), s("price"),
        F.lit(', "__sources__": {"Revenue": "Total revenue '), s("price"), F.lit('", "Units": " "}}'))
    fenced = F.when(F.col("l_linestatus") == "F", F.concat(F.lit("Here it is:\n```json\n"), body, F.lit("\n```"))).otherwise(body)
    text = F.when(F.col("l_discount") > 0.08, F.substring(body, 1, 40)).otherwise(fenced)
    return _lines(spark, sf_dir).select("filing_id", "chunk_idx", "section", text.alias("text"))


@query("parse_responses", f"""
WITH l AS (SELECT l_orderkey AS filing_id, {_CHUNK} AS chunk_idx, CAST(floor(l_extendedprice) AS BIGINT) AS price,
  CAST(floor(l_quantity) AS BIGINT) AS qty, year(l_shipdate) AS y FROM lineitem WHERE l_discount <= 0.08)
SELECT filing_id, chunk_idx, 'Revenue' AS key, price + 0.0::DOUBLE AS num_value, '' AS str_value FROM l
UNION ALL SELECT filing_id, chunk_idx, 'Cost of revenue', qty + 0.5::DOUBLE, '' FROM l
UNION ALL SELECT filing_id, chunk_idx, 'Units', -1, CAST(qty AS VARCHAR) FROM l
UNION ALL SELECT filing_id, chunk_idx, '__period__', -1, 'Year Ended December 31, ' || y FROM l""")
def parse_responses(spark, sf_dir):
    rows, _ = RS.parse_responses(response_texts(spark, sf_dir))
    return RS.metric_rows(rows).select(
        "filing_id", "chunk_idx", "key", F.coalesce("num_value", F.lit(-1.0)).alias("num_value"),
        F.coalesce("str_value", F.lit("")).alias("str_value"))


@query("response_rejects", f"SELECT l_orderkey AS filing_id, {_CHUNK} AS chunk_idx FROM lineitem WHERE l_discount > 0.08")
def response_rejects(spark, sf_dir):
    return RS.parse_responses(response_texts(spark, sf_dir))[1].select("filing_id", "chunk_idx")


@query("snippet_merge", f"""
WITH l AS (SELECT l_orderkey AS filing_id, {_SECTION_SQL} * 10000000000000 + {_CHUNK} AS o, CAST(floor(l_extendedprice) AS BIGINT) AS price
  FROM lineitem WHERE l_discount <= 0.08)
SELECT filing_id, 'Revenue' AS key, 'Total revenue ' || arg_min(price, o::HUGEINT * 1000000 + price) AS snippet FROM l GROUP BY 1""")
def snippet_merge(spark, sf_dir):
    rows = RS.snippets(response_texts(spark, sf_dir)).withColumn("is_stale", F.lit(False))
    return M.merge_snippets(rows)


_SCALE_KEYS = [
    ("Revenue", "price"), ("Production of units", "qty"), ("Diluted EPS", "1.5"),
    ("Weighted average basic shares", "qty * 5000000"), ("Big total", "price * 200"), ("Gross margin", "qty"),
]


@query("scale_apply", """
WITH l AS (SELECT l_orderkey AS filing_id, CAST(floor(l_extendedprice) AS BIGINT) AS price, CAST(floor(l_quantity) AS BIGINT) AS qty,
    CASE l_returnflag WHEN 'A' THEN 1000 WHEN 'N' THEN 1000000 ELSE 1 END AS rep, CASE l_linestatus WHEN 'F' THEN 1000 ELSE 1 END AS pre FROM lineitem),
 s AS (SELECT *, CASE WHEN rep > 1 AND pre > 1 THEN least(rep, pre) WHEN pre > 1 THEN pre ELSE rep END AS mul FROM l),
 k AS (
  SELECT filing_id, 'Revenue' AS key, CASE WHEN mul > 1 AND price < 10000000000000 / mul THEN price * mul ELSE price END AS v FROM s
  UNION ALL SELECT filing_id, 'Production of units', qty FROM s
  UNION ALL SELECT filing_id, 'Diluted EPS', 1.5 FROM s
  UNION ALL SELECT filing_id, 'Weighted average basic shares', CASE WHEN pre > 1 AND qty * 5000000 < 100000000 THEN qty * 5000000 * pre ELSE qty * 5000000 END FROM s
  UNION ALL SELECT filing_id, 'Big total', CASE WHEN mul > 1 AND price * 200 < 10000000000000 / mul THEN price * 200 * mul ELSE price * 200 END FROM s
  UNION ALL SELECT filing_id, 'Gross margin', qty FROM s)
SELECT filing_id, key, CAST(sum(v) AS DOUBLE) AS total FROM k GROUP BY 1, 2""")
def scale_apply(spark, sf_dir):
    rows = F.array(*[F.struct(F.lit(k).alias("key"), F.expr(e).cast("double").alias("num_value")) for k, e in _SCALE_KEYS])
    scale = F.when(F.col("l_returnflag") == "A", "thousands").when(F.col("l_returnflag") == "N", "Millions").otherwise("as-is")
    long = _lines(spark, sf_dir).select("filing_id", scale.alias("scale"), "l_linestatus", F.inline(rows))
    pre = F.when(F.col("l_linestatus") == "F", 1000.0).otherwise(1.0)
    return RS.apply_scale(long, pre, pre).groupBy("filing_id", "key").agg(F.sum("num_value").alias("total"))


def _numeric(spark, sf_dir, key):
    return _lines(spark, sf_dir).select(
        "filing_id", key.alias("key"), (F.col("chunk_idx") * 100_000).alias("key_ord"), "section",
        F.col("price").cast("double").alias("num_value"), F.lit(None).cast("string").alias("str_value"),
        M.stale(F.lit(1998), F.concat(F.lit("Year Ended "), F.col("y").cast("string"))).alias("is_stale"))


_MERGE_SQL = """l AS (SELECT l_orderkey AS filing_id, {key} AS key, CAST(floor(l_extendedprice) AS DOUBLE) AS v,
    CASE WHEN year(l_shipdate) <> 1998 THEN 10 ELSE 0 END + {prio} AS a FROM lineitem),
 w AS (SELECT *, min(a) OVER (PARTITION BY filing_id, key) AS best FROM l),
 g AS (SELECT filing_id, key, best, median(v) AS mid, min(v) AS lo, max(v) AS hi, count(*) AS n FROM w WHERE a = best GROUP BY 1, 2, 3),
 mv AS (SELECT filing_id, key, CASE WHEN n > 1 AND lo <> 0 AND abs(hi) / abs(lo) >= 5 THEN hi ELSE mid END AS num_value, best < 10 AS on_target FROM g)"""


@query("merge_sections", "WITH " + _MERGE_SQL.format(key="'Item ' || l_linestatus", prio=_SECTION_SQL) + """
SELECT filing_id, key, num_value, on_target FROM mv""")
def merge_sections(spark, sf_dir):
    return M.merge_values(_numeric(spark, sf_dir, F.concat(F.lit("Item "), F.col("l_linestatus")))).select(
        "filing_id", "key", "num_value", "on_target")


@query("stale_year_filter", "WITH " + _MERGE_SQL.format(
    key="CASE l_linestatus WHEN 'F' THEN 'Cost of Goods' ELSE 'cost  of goods' END", prio=_SECTION_SQL) + """
SELECT filing_id, key, num_value FROM mv QUALIFY on_target OR NOT max(on_target) OVER (PARTITION BY filing_id)""")
def stale_year_filter(spark, sf_dir):
    key = F.when(F.col("l_linestatus") == "F", "Cost of Goods").otherwise("cost  of goods")
    return M.merge(_numeric(spark, sf_dir, key)).select("filing_id", "key", "num_value")


@query("string_merge", f"""
WITH l AS (SELECT l_orderkey AS filing_id, year(l_shipdate) AS y, l_linenumber AS n, year(l_shipdate) <> 1998 AS st FROM lineitem)
SELECT filing_id, '__period__' AS key, 'Year Ended ' || coalesce(max(y) FILTER (WHERE NOT st), max(y)) AS str_value FROM l GROUP BY 1
UNION ALL SELECT filing_id, 'Note', repeat('x', CAST(coalesce(max(n) FILTER (WHERE NOT st), max(n)) AS INTEGER)) FROM l GROUP BY 1
UNION ALL SELECT filing_id, 'Mixed', '7.0' FROM l GROUP BY 1""")
def string_merge(spark, sf_dir):
    year = F.concat(F.lit("Year Ended "), F.col("y").cast("string"))
    none = F.lit(None)
    rows = F.array(
        F.struct(F.lit("__period__").alias("key"), none.cast("double").alias("num_value"), year.alias("str_value")),
        F.struct(F.lit("Note").alias("key"), none.cast("double").alias("num_value"),
                 F.expr("repeat('x', CAST(l_linenumber AS INT))").alias("str_value")),
        F.struct(F.lit("Mixed").alias("key"), F.lit(7.0).alias("num_value"), none.cast("string").alias("str_value")),
        F.struct(F.lit("Mixed").alias("key"), none.cast("double").alias("num_value"), F.lit("seven").alias("str_value")))
    long = _lines(spark, sf_dir).select(
        "filing_id", "section", (F.col("chunk_idx") * 100_000).alias("key_ord"),
        M.stale(F.lit(1998), year).alias("is_stale"), F.inline(rows))
    return M.merge_values(long).select(
        "filing_id", "key", F.coalesce("str_value", F.col("num_value").cast("string")).alias("str_value"))


@query("major_metric_repair", f"""
WITH {I.FACTS_SQL}, x AS (
  SELECT suppkey || '-' || fy AS filing_id, 'Total revenue' AS key, CAST(revenue AS DOUBLE) AS v, revenue FROM facts
  UNION ALL SELECT suppkey || '-' || fy, 'Net income', CASE WHEN n_lines % 3 = 0 THEN CAST(cost * 1000 AS DOUBLE) / 1000000 ELSE cost END, revenue FROM facts
  UNION ALL SELECT suppkey || '-' || fy, 'Operating income', CASE WHEN n_lines % 2 = 0 THEN 1 ELSE cost END, revenue FROM facts
  UNION ALL SELECT suppkey || '-' || fy, 'Small item', 5, revenue FROM facts)
SELECT filing_id, key, CASE WHEN key IN ('Net income', 'Operating income') AND abs(v) < revenue * CAST(0.001 AS DOUBLE)
  THEN CASE WHEN abs(v * 1000) BETWEEN revenue * CAST(0.001 AS DOUBLE) AND revenue * 3.0 THEN v * 1000 ELSE -1 END ELSE v END AS value FROM x""")
def major_metric_repair(spark, sf_dir):
    c = lambda e: F.expr(e).cast("double")
    rows = F.array(*[F.struct(F.lit(k).alias("key"), v.alias("num_value")) for k, v in [
        ("Total revenue", c("revenue")),
        ("Net income", c("CASE WHEN n_lines % 3 = 0 THEN CAST(cost * 1000 AS DOUBLE) / 1000000 ELSE cost END")),
        ("Operating income", c("CASE WHEN n_lines % 2 = 0 THEN 1 ELSE cost END")), ("Small item", F.lit(5.0))]])
    m = I.facts(spark, sf_dir).select(F.concat_ws("-", "suppkey", "fy").alias("filing_id"), F.inline(rows))
    return M.repair_major_metrics(m).select("filing_id", "key", F.coalesce("num_value", F.lit(-1.0)).alias("value"))


@query("carry_over", """
WITH a AS (SELECT l_orderkey AS filing_id, l_returnflag AS key, l_linenumber AS attempt, max(CAST(floor(l_extendedprice) AS DOUBLE)) AS v FROM lineitem GROUP BY 1, 2, 3)
SELECT filing_id, key, arg_max(v, attempt) AS num_value, max(attempt) AS attempt FROM a GROUP BY 1, 2""")
def carry_over(spark, sf_dir):
    a = _lines(spark, sf_dir).groupBy("filing_id", F.col("l_returnflag").alias("key"), F.col("l_linenumber").alias("attempt")).agg(
        F.max("price").cast("double").alias("num_value"))
    a = a.withColumns({"str_value": F.lit(None).cast("string"), "key_ord": F.lit(0)})
    return M.carry_over(a).select("filing_id", "key", "num_value", "attempt")


@query("provenance", """
WITH a AS (SELECT l_orderkey AS filing_id, l_returnflag AS key, 1 + l_linenumber % 2 AS attempt, l_partkey % 50 AS c FROM lineitem),
 t AS (SELECT *, max(attempt) OVER (PARTITION BY filing_id, key) AS top FROM a)
SELECT filing_id, key, string_agg(DISTINCT lpad(CAST(c AS VARCHAR), 2, '0'), ',' ORDER BY lpad(CAST(c AS VARCHAR), 2, '0')) AS chunks FROM t WHERE attempt = top GROUP BY 1, 2""")
def provenance(spark, sf_dir):
    a = _lines(spark, sf_dir).select(
        "filing_id", F.col("l_returnflag").alias("key"), (1 + F.col("l_linenumber") % 2).alias("attempt"),
        F.lpad((F.col("l_partkey") % 50).cast("string"), 2, "0").alias("chunk_idx"))
    return M.provenance(a).select("filing_id", "key", F.array_join("chunks", ",").alias("chunks"))


@query("unanswered_prompts", """
SELECT doc_id, sha256('tag' || chr(10) || text) AS prompt_sha FROM documents
WHERE sha256('tag' || chr(10) || text) NOT IN (SELECT sha256('tag' || chr(10) || text) FROM documents WHERE n_chars < 2000)""")
def unanswered_prompts(spark, sf_dir):
    d = I.table(spark, sf_dir, "documents").select(
        "doc_id", "n_chars", RS.prompt_key(F.lit("tag"), F.col("text")).alias("prompt_sha"))
    return RS.unanswered(d, d.filter("n_chars < 2000").select("prompt_sha")).select("doc_id", "prompt_sha")


@query("model_answers", """
WITH p AS (SELECT DISTINCT o_custkey % 1000 AS k FROM orders),
 s AS (SELECT sha256('tag' || chr(10) || 'order ' || k) AS prompt_sha, k,
   CASE WHEN k % 7 = 0 THEN 'raises' WHEN k % 5 = 0 THEN 'never' WHEN k % 3 = 0 THEN 'late' WHEN k % 11 = 0 THEN 'flaky' ELSE 'good' END AS kind FROM p)
SELECT prompt_sha, CASE kind WHEN 'raises' THEN 'ok' WHEN 'never' THEN 'failed' WHEN 'late' THEN 'retried' WHEN 'flaky' THEN 'retried' ELSE 'ok' END AS status,
  CASE kind WHEN 'good' THEN 1 WHEN 'raises' THEN 1 ELSE 2 END AS tries,
  CASE kind WHEN 'never' THEN 'no JSON object' END AS error, CASE WHEN kind IN ('raises', 'never') THEN 2 ELSE 1 END AS run,
  CASE kind WHEN 'never' THEN 'sorry' ELSE '{"n": ' || k || '}' END AS text FROM s""")
def model_answers(spark, sf_dir):
    """Two runs: the first meets a model that raises on some prompts, the second sends what is still unanswered."""
    o = I.table(spark, sf_dir, "orders").select(F.concat(F.lit("order "), (F.col("o_custkey") % 1000).cast("string")).alias("prompt"))
    prompts = o.withColumn("prompt_sha", RS.prompt_key(F.lit("tag"), F.col("prompt")))

    def session(down: bool):
        def open_session():
            seen = set()

            def call(prompt):
                k = int(prompt.split("\n")[0].split()[1])
                first = k not in seen
                seen.add(k)
                if k % 7 == 0:
                    if down:
                        raise ConnectionError("the model is down")
                elif k % 5 == 0:
                    return "sorry"
                elif k % 3 == 0 and "ONLY" not in prompt:
                    return "here you are"
                elif k % 3 and k % 11 == 0 and first:
                    raise TimeoutError
                return f'{{"n": {k}}}'

            return call

        return open_session

    path = work_dir(spark, "answers")
    RS.answer_prompts(prompts, path, 1, open_session=session(True))
    return RS.answer_prompts(prompts, path, 2, open_session=session(False))


@query("valid_messages", "SELECT o_orderkey, 'T' || o_custkey AS ticker FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority <> '5-LOW'")
def valid_messages(spark, sf_dir):
    o = I.table(spark, sf_dir, "orders")
    form = F.when(F.col("o_orderpriority") == "5-LOW", "10-Q").otherwise("8-k")
    good = F.to_json(F.struct(
        F.concat(F.lit("T"), F.col("o_custkey").cast("string")).alias("ticker"),
        F.when(F.col("o_orderstatus") == "F", form).otherwise("").alias("filing_type"), F.upper(form).alias("form_type")))
    text = F.when(F.col("o_orderstatus") == "P", F.substring(good, 1, 9)).otherwise(good)
    m = o.select("o_orderkey", RS.parse_message(text).alias("m"))
    return m.filter(RS.valid_message(F.col("m"))).select("o_orderkey", "m.ticker")


