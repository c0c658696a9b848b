"""Responses, scaling, merging, checks, clean-up and derivation on small inputs."""
import json

import pytest
from pyspark.sql import functions as F

from statement_spark.operators import chunks as CH, cleanup as CL, concepts as C, derive as D, merge as M, quality as Q, retry as RT
from statement_spark.sources import responses as RS

LONG = "filing_id string, key string, key_ord bigint, section string, num_value double, str_value string, is_stale boolean"


def answers(spark, texts):
    return spark.createDataFrame([("f", i, "other", t) for i, t in enumerate(texts)],
                                 "filing_id string, chunk_idx int, section string, text string")


def merged(spark, texts, prescan=1.0, shares=1.0, target=None):
    rows, rejects = RS.parse_responses(answers(spark, texts))
    rows = RS.apply_scale(RS.metric_rows(rows), F.lit(prescan), F.lit(shares))
    rows = rows.withColumn("is_stale", M.stale(F.lit(target).cast("int"), F.col("period")))
    return {r["key"]: r.num_value if r.num_value is not None else r.str_value for r in M.merge(rows).collect()}, rejects


def test_millions_scale_leaves_eps(spark):
    got, _ = merged(spark, [json.dumps({
        "__scale__": "millions", "__period__": "Year Ended December 31, 2025", "Revenue": 82886, "Cost of goods sold": 42180,
        "Gross profit": 40706, "Net income": 31778, "Diluted earnings per share": 4.27,
        "Weighted-average shares outstanding - diluted": 7447})], 1e6, 1e6)
    assert got["Revenue"] == 82_886e6 and got["Diluted earnings per share"] == 4.27
    assert got["Weighted-average shares outstanding - diluted"] == 7_447e6
    assert got["Revenue"] - got["Cost of goods sold"] == got["Gross profit"]
    assert "__scale__" not in got


@pytest.mark.parametrize("scale,factor,rev,cost,gross", [
    ("thousands", 1e3, 17561101, 13240060, 4321041), ("millions", 1e6, 17561, 13240, 4321), ("billions", 1e9, 176, 132, 44)])
def test_identity_survives_scaling(spark, scale, factor, rev, cost, gross):
    got, _ = merged(spark, [json.dumps({"__scale__": scale, "Revenues": rev, "Cost of goods sold": cost, "Gross Profit": gross})])
    assert got["Revenues"] == rev * factor
    assert got["Revenues"] - got["Cost of goods sold"] == got["Gross Profit"]


def test_smaller_of_two_scales_and_full_values(spark):
    got, _ = merged(spark, ['{"__scale__": "billions", "Total revenue": 500, "Other item": 82900000000}'], 1e3)
    assert got == {"Total revenue": 500e3, "Other item": 82_900_000_000.0}


def test_isolation_duplicates_and_types(spark):
    got, rejects = merged(spark, [
        'Sure:\n```json\n{"a": 1, "b": true, "c": "12", "d": null, "a": 3, "e": NaN}\n```', "no json", '{"a": 5', "[1]"])
    assert got == {"a": 3.0, "c": "12"}
    assert rejects.count() == 3


def test_merge_rules(spark):
    def value(items):
        rows = [("f", k, i, s, v, None, st) for i, (k, s, v, st) in enumerate(items)]
        return {r["key"]: r.num_value for r in M.merge(spark.createDataFrame(rows, LONG)).collect()}

    # authority, median, artifact, stale fallback, stale variant eviction
    assert value([("x", "other", 9.0, False), ("x", "income_statement", 4.0, False)]) == {"x": 4.0}
    assert value([("x", "other", v, False) for v in (10.0, 12.0, 13.0, 11.0)]) == {"x": 11.5}
    assert value([("x", "other", 47.0, False), ("x", "other", 20458.0, False)]) == {"x": 20458.0}
    assert value([("x", "income_statement", 1.0, True), ("x", "unknown", 2.0, False)]) == {"x": 2.0}
    assert value([("x", "other", 1.0, True)]) == {"x": 1.0}
    assert value([("Cost of revenue", "other", 20.0, False), ("Cost of Revenue", "other", 48.0, True)]) == {"Cost of revenue": 20.0}


def test_merge_shuffles_rows_once(spark):
    """All that follows per filing finds its rows where the one shuffle by filing has put them."""
    rows = spark.createDataFrame([("f", "x", 0, "other", 1.0, None, False), ("f", "y", 1, "other", None, "long", True),
                                  ("f", "y", 2, "unknown", None, "longest", True), ("g", "x", 0, "other", None, None, False)], LONG)
    merged = M.merge_values(rows)
    assert merged._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    got = {(r.filing_id, r["key"], r.key_ord, r.num_value, r.str_value, r.on_target) for r in merged.collect()}
    assert got == {("f", "x", 0, 1.0, None, True), ("f", "y", 1, None, "longest", False), ("g", "x", 0, None, None, False)}


def test_major_metric_repair(spark):
    rows = [("f", "Revenue", 0, "other", 1e9, None, False), ("f", "Net income", 1, "other", 9e5, None, False),
            ("f", "Operating income", 2, "other", 2.0, None, False), ("f", "Tiny item", 3, "other", 5.0, None, False)]
    got = {r["key"]: r.num_value for r in M.merge(spark.createDataFrame(rows, LONG)).collect()}
    assert got == {"Revenue": 1e9, "Net income": 9e8, "Tiny item": 5.0}


def metrics(spark, pairs):
    return spark.createDataFrame([("f", k, i, float(v), None) for i, (k, v) in enumerate(pairs)],
                                 "filing_id string, key string, key_ord bigint, num_value double, str_value string")


def types(found):
    return sorted((r.type, r.severity) for r in found.collect())


def test_findings(spark):
    m = metrics(spark, [("Total revenue", 100e6), ("Cost of revenue", 60e6), ("Gross profit", 30e6), ("Operating income", 35e6),
                        ("Total operating expenses", 35e6), ("Net income", 20e6), ("Net  Income", 20e6), ("Diluted EPS / Diluted net income", 1),
                        ("Basic EPS", 1.0), ("Diluted EPS", 1.5), ("Adjusted EBITDA", 5), ("Debt", 1e9)])
    got = types(Q.findings(m).filter("type <> 'missing_expected'"))
    assert got == sorted([
        ("identity_violation", "high"), ("suspect_value", "medium"), ("suspect_value", "medium"), ("case_duplicate", "low"),
        ("gaap_nongaap_leakage", "low"), ("composite_key", "low"), ("suspect_round", "low"), ("suspect_round", "low")])
    assert types(Q.findings(metrics(spark, [("Debt", 1)]), targeted=True).filter("type = 'missing_critical'")) == [("missing_critical", "medium")] * 5


def test_composite_keys(spark):
    keys = ["Diluted earnings per share, Diluted EPS", "Cost of revenue and so / Cost of goods sold", "Earnings Per Share, Basic",
            "Income (Loss) from Continuing Operations, Net of Tax, Attributable to Parent"]
    got = {r["key"] for r in metrics(spark, [(k, 1) for k in keys]).filter(Q.is_composite()).collect()}
    assert got == set(keys[:2])


def test_blocking_and_corrections(spark):
    m = metrics(spark, [("Revenue", 50e3), ("Net income", 200e3), ("Diluted earnings per share", 4.0),
                        ("Weighted average shares outstanding: diluted", 10e3), ("Free cash flow", 9), ("Net cash provided by operating activities", 5)])
    ops = Q.operands(m)
    warned = {w.split(":")[0] for w in ops.select(Q.blocking_warnings().alias("w")).first().w}
    assert warned == {"Result per share", "Revenue range", "Income size"}
    assert "Free cash flow" not in {r["key"] for r in Q.correct_values(m, ops).collect()}


def test_opex_correction(spark):
    m = metrics(spark, [("Operating income", 10), ("Total operating expenses", 10), ("Cost of revenue", 5), ("Operating expenses", 7)])
    fixed, note = Q.correct_opex(m, Q.operands(m))
    assert {r["key"]: r.num_value for r in fixed.collect()}["Total operating expenses"] == 12.0
    assert note.first().type == "auto_corrected"


def test_guarded_removal(spark):
    m = metrics(spark, [("Revenue", 1e6), ("Net income", 2e5), ("Extra", 3), ("Kept", 4)]).withColumn("protected", F.col("key") == "Kept")

    def left(pairs):
        a = spark.createDataFrame([("f", k, r) for k, r in pairs], "filing_id string, key string, reason string")
        return {r["key"] for r in CL.guarded_removal(m, a).collect()}

    assert left([("Extra", "rule A"), ("Kept", "rule A"), ("Net income", "")]) == {"Revenue", "Net income", "Kept"}
    assert left([("Extra", "rule A"), ("Ghost", "rule A")]) == {"Revenue", "Net income", "Extra", "Kept"}
    assert left([]) == {"Revenue", "Net income", "Extra", "Kept"}


def test_removal_that_raises_a_warning_is_void(spark):
    """Without the first net income the second one counts, and that is more than twice the revenue."""
    m = metrics(spark, [("Revenue", 1e6), ("Net income", 2e5), ("NET INCOME", 9e6), ("Extra", 3)]).withColumn("protected", F.lit(False))
    a = spark.createDataFrame([("f", "Net income", "rule A"), ("f", "Extra", "rule A")], "filing_id string, key string, reason string")
    assert {r["key"] for r in CL.guarded_removal(m, a).collect()} == {"Revenue", "Net income", "NET INCOME", "Extra"}
    plan = CL.guarded_removal(m, a)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


CHAIN = [("c1", "Revenue", "revenue"), ("c2", "Cost of revenue", "cost_of_revenue"), ("c3", "Gross profit", "gross_profit"),
         ("c4", "R&D", "rd_expense"), ("c5", "Operating income", "operating_income"), ("c6", "Pre-tax income", "pretax_income"),
         ("c7", "Tax", "tax_expense"), ("c8", "Net income", "net_income"), ("c9", "Net margin %", "net_margin_pct"),
         ("ca", "Interest", "interest_expense")]


def derive(spark, known, drop=()):
    concepts = spark.createDataFrame([("f", c, lb, c, r) for c, lb, r in CHAIN if c not in drop],
                                     "filing_id string, concept_id string, label string, concept_ord string, role string")
    values = spark.createDataFrame([("f", c, float(v), i) for i, (c, v) in enumerate(known.items())],
                                   "filing_id string, concept_id string, value double, key_ord int")
    return {r.concept_id: r.value for r in D.derive(values, concepts).collect()}


def test_derivation_chain(spark):
    known = {"c1": 100, "c2": 40, "c4": 10, "c7": 5}
    assert derive(spark, known) == {"c3": 60.0, "c5": 50.0, "c6": 50.0, "c8": 45.0, "c9": 45.0}
    # nobody asks for gross profit, so nothing can build on it
    assert derive(spark, known, drop=("c3",)) == {}
    # a known item below the line stops the pre-tax rule
    assert derive(spark, {**known, "ca": 1}) == {"c3": 60.0, "c5": 50.0}
    assert derive(spark, {"c1": 0, "c8": 5}) == {}


def test_semantic_map_rules(spark):
    concepts = spark.createDataFrame([("f", "c1", "Deposits", "x", "1"), ("f", "c2", "Other comprehensive income", "y", "2"), ("f", "c3", "Americas", "z|m", "3")],
                                     "filing_id string, concept_id string, label string, taxonomy_key string, concept_ord string")
    mapped = spark.createDataFrame([], "filing_id string, concept_id string, key string, value double, tier int, key_ord bigint")
    asked = C.semantic_candidates(C.unmapped(concepts, mapped))
    assert [r.concept_id for r in asked.collect()] == ["c1"]
    reply = spark.createDataFrame([("f", 0, "c1", "Ghost"), ("f", 1, "c1", "Deposit costs"), ("f", 2, "c3", "Deposit costs")],
                                  "filing_id string, resp_ord int, concept_id string, key string")
    m = metrics(spark, [("Deposit costs", 7)])
    got = C.apply_semantic_map(mapped, reply, m, asked).collect()
    assert [(r.concept_id, r["key"], r.value) for r in got] == [("c1", "Deposit costs", 7.0)]


def test_long_texts_go_to_python_in_small_batches(spark):
    """An Arrow batch would hold ten thousand texts and their chunks."""
    df = CH.chunk(spark.createDataFrame([(1, "a b " * 400)], "id int, text string"), size=700, overlap=60)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan


def test_chunks_cover_whole_text(spark):
    text = "\n".join(f"row {i} " + "v" * (i % 37) for i in range(900))
    parts = CH.split_text(text, 700, 60)
    at = 0
    for p in parts:
        here = text.index(p, max(0, at - 300))
        assert here <= at and len(p) <= 700
        at = here + len(p)
    assert at == len(text) and CH.split_text("short", 700, 60) == ["short"]
    df = CH.chunk(spark.createDataFrame([(1, text), (2, "short")], "id int, text string"), size=700, overlap=60)
    got = {(r.id, r.chunk_idx): r.chunk for r in df.collect()}
    assert [got[(1, i)] for i in range(len(parts))] == parts and got[(2, 0)] == "short"


def test_call_model_retries_once(spark):
    prompts = spark.createDataFrame([("a", "good"), ("b", "bad"), ("c", "worse")], "prompt_sha string, prompt string")

    def call(prompt):
        if prompt == "good":
            return '{"x": 1}'
        return '{"x": 2}' if "bad" in prompt and "ONLY" in prompt else "nothing"

    got = {r.prompt_sha: r.status for r in RS.call_model(prompts, call).collect()}
    assert got == {"a": "ok", "b": "retried", "c": "failed"}


def test_a_raising_model_gives_rows_and_a_rerun_sends_the_rest(spark, tmp_path):
    prompts = spark.createDataFrame([("a", "one"), ("a", "one"), ("b", "two"), ("c", None)], "prompt_sha string, prompt string")

    def down():
        raise OSError("no route")

    path = str(tmp_path / "answers")
    first = {r.prompt_sha: (r.status, r.tries, r.error) for r in RS.answer_prompts(prompts, path, 1, tries=3, open_session=down).collect()}
    assert first == {k: ("failed", 3, "OSError: no route") for k in "abc"}
    second = {r.prompt_sha: (r.status, r.text) for r in RS.answer_prompts(prompts, path, 2, call=lambda p: f'{{"p": "{p.upper()}"}}').collect()}
    assert second == {"a": ("ok", '{"p": "ONE"}'), "b": ("ok", '{"p": "TWO"}'), "c": ("failed", None)}
    third = RS.answer_prompts(prompts, path, 3, call=lambda p: "{}", parse=lambda text: text).collect()
    assert {r.prompt_sha: r.run for r in third} == {"a": 2, "b": 2, "c": 3}
    again = RS.answer_prompts(prompts.filter("prompt_sha = 'c'"), path, 3, call=lambda p: "{}", parse=lambda text: text).collect()
    assert [r.run for r in again] == [3] and spark.read.parquet(path).filter("run = 3").count() == 1


def test_retry_decisions(spark):
    att = spark.createDataFrame([("f", i) for i in (1, 2, 3)] + [("g", 1)], "filing_id string, attempt int")
    found = spark.createDataFrame([("f", 1, "high", "m"), ("f", 2, "high", "m"), ("f", 3, "high", "n")],
                                  "filing_id string, attempt int, severity string, message string")
    got = {(r.filing_id, r.attempt): r.reason for r in RT.decisions(found, att).collect()}
    assert got == {("f", 1): "retry", ("f", 2): "no_progress", ("f", 3): "attempts_used", ("g", 1): "clean"}


def test_rows_of_filings_are_never_broadcast(spark):
    """However small a join's sides look, rows that grow with the filings are joined by sorting."""
    from statement_spark.operators import reports as R

    concepts = spark.createDataFrame(
        [("f", "k", "a", "Revenue", "001", "revenue", "us:A"), ("f", "k", "b", "Cost", "002", "cost_of_revenue", "us:B"), ("f", "k", "c", "Gross", "003", "gross_profit", "us:C")],
        "filing_id string, cik string, concept_id string, label string, path string, role string, taxonomy_key string").selectExpr("*", "path AS concept_ord", "taxonomy_key AS concept")
    values = spark.createDataFrame([("f", "a", 5.0, 0), ("f", "b", 2.0, 1)], "filing_id string, concept_id string, value double, key_ord int")
    metrics = spark.createDataFrame([("f", "k", "revenue", 0, 5.0), ("f", "k", "[us:B]", 1, 2.0)], "filing_id string, cik string, key string, key_ord int, num_value double")
    derived = D.derive(values, concepts)
    done = values.selectExpr("filing_id", "concept_id", "value", "false AS derived").unionByName(derived.selectExpr("filing_id", "concept_id", "value", "true AS derived"))
    mapped = C.map_metrics(metrics, concepts)
    frames = {
        "derive": derived, "gaps": D.gaps(values.filter("concept_id = 'a'"), concepts), "fill": R.fill_summary(concepts, done),
        "lines": R.insertion_lines(concepts, done), "mapped": mapped, "unmapped": C.unmapped(concepts, mapped)}
    for name, df in frames.items():
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString(), name
    assert [tuple(r) for r in derived.collect()] == [("f", "c", "gross_profit", 3.0)]
    assert [(r["concept_id"], r["missing"]) for r in frames["gaps"].collect()] == [("c", ["cost_of_revenue"])]
    assert tuple(frames["fill"].first()) == ("f", 2, 1, 0, 0, 3)
    assert {r["concept_id"]: r["grp"] for r in frames["lines"].collect()} == {"a": 0, "b": 0, "c": 1}
    assert {r["concept_id"]: r["tier"] for r in mapped.collect()} == {"a": 2, "b": 0}
    assert [r["concept_id"] for r in frames["unmapped"].collect()] == ["c"]
