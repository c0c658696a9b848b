"""Questions to a model as rows: roles, matches, undecided tables, clean-up. The answers come back through ``sources/responses.py``.

A question holds what one company or filing has: its labels, keys or tables, a document's worth.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import patterns as P
from . import chunks as CH, cleanup, tables as TB

ROLE_TEMPLATE = (
    "Which part does each label play in an income statement? Choose one of: {roles}. Leave out labels that play none.\n"
    "{labels}\nAnswer with one JSON object from label to role.")
MATCH_TEMPLATE = (
    "Find for each concept the key that means the same line of the statement. A key serves once; leave out concepts without one.\n"
    "Concepts:\n{concepts}\nKeys:\n{keys}\nAnswer with one JSON object from concept to key.")
KEEP_TEMPLATE = (
    "Which of these tables hold figures of the income statement or its parts?\n{tables}\n"
    "Answer with one JSON object from the table's number to true or false.")
CLEAN_TEMPLATE = (
    "These metrics were read from one filing: {payload}\nName the keys that repeat another key, belong to a reconciliation or "
    "can't be right. Change no value.\nAnswer with one JSON object: \"remove\", a list of keys, and \"reasons\", from key to reason.")
SAMPLE_ROWS = 6


def _lines(line: Column, *order: str) -> Column:
    """Aggregate: lines in order, one below the other."""
    item = F.struct(*order, line.alias("line"))
    return F.array_join(F.transform(F.array_sort(F.collect_set(item)), lambda x: x["line"]), "\n")


def role_prompts(candidates: DataFrame, by: str = "cik", model_tag: str = "default") -> DataFrame:
    """One question per company about its labels without a role (``concepts.role_candidates``)."""
    asked = candidates.filter("trim(label) <> ''").groupBy(by).agg(_lines(F.concat(F.lit("- "), "label"), "label").alias("labels"))
    return CH.prompts(asked.withColumn("roles", F.lit(", ".join(P.ROLES))), ROLE_TEMPLATE, "roles", model_tag).select(by, "call_kind", "prompt", "prompt_sha")


def match_prompts(missing: DataFrame, metrics: DataFrame, filing: str = "filing_id", model_tag: str = "default") -> DataFrame:
    """One question per filing about its unmapped concepts (``concepts.semantic_candidates``) and the keys that have a number;
    filings that lack either are not asked about."""
    wanted = missing.groupBy(filing).agg(_lines(F.concat(F.lit("- "), F.col("concept_id").cast("string"), F.lit(": "), "label"), "concept_ord").alias("concepts"))
    keys = metrics.filter("num_value is not null").groupBy(filing).agg(_lines(F.concat(F.lit("- "), "key"), "key_ord").alias("keys"))
    return CH.prompts(wanted.join(keys, filing), MATCH_TEMPLATE, "match", model_tag).select(filing, "call_kind", "prompt", "prompt_sha")


def keep_prompts(tables: DataFrame, filing: str = "filing_id", model_tag: str = "default") -> tuple[DataFrame, DataFrame]:
    """(prompts, candidates): one question per filing about its undecided tables, by number, with heading and first rows; and
    the tables the numbers stand for (filing, table_idx, cand_idx), numbered within the filing."""
    undecided = tables.filter("table_type = 'other'").select(
        filing, "table_idx", "context", TB.markdown(F.slice("rows", 1, SAMPLE_ROWS)).alias("sample"))
    per_filing = undecided.groupBy(filing).agg(F.array_sort(F.collect_list(F.struct("table_idx", "context", "sample"))).alias("found"))
    texts = F.transform("found", lambda t, i: F.concat(F.lit("["), i.cast("string"), F.lit("] "), t["context"], F.lit("\n"), t["sample"]))
    asked = per_filing.withColumn("tables", F.array_join(texts, "\n"))
    candidates = per_filing.select(filing, F.posexplode("found").alias("cand_idx", "t")).select(filing, "t.table_idx", "cand_idx")
    return CH.prompts(asked.drop("found"), KEEP_TEMPLATE, "keep", model_tag).select(filing, "call_kind", "prompt", "prompt_sha"), candidates


def cleanup_prompts(metrics: DataFrame, filing: str = "filing_id", model_tag: str = "default") -> DataFrame:
    """One question per filing that has a candidate for clean-up (``protected`` marks mapped keys)."""
    asked = cleanup.prompt_payload(metrics, filing).join(cleanup.needs_cleanup(metrics, filing).select(filing), filing, "left_semi")
    return CH.prompts(asked, CLEAN_TEMPLATE, "cleanup", model_tag).select(filing, "call_kind", "prompt", "prompt_sha")
