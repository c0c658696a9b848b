"""The batch run: pages in, concept values, findings and value-table rows out.

Shuffles: none from page to scaled metric rows; then by (filing, key) for the merge, by
(cik, key form) for the mapping, and by filing for derivation and checks. Page text never
takes part in one.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import numbers, text as T
from ..session import staged
from ..operators import cleanup, concepts as C, derive as D, label_search as LS, merge as M, quality as Q, tables as TB
from ..sources import html, responses as RS, sinks


def read_tables(pages: DataFrame) -> DataFrame:
    """Classified tables of pages (…, html)."""
    return TB.classify(TB.page_tables(html.page_segments(pages)))


def shaped_tables(tables: DataFrame, filing: str = "filing_id", keep: DataFrame | None = None) -> DataFrame:
    """Tables that go to extraction, with their scale and section.

    ``tables`` carry ``period_end`` and ``annual`` of their filing, and ``exhibit_no`` (from 1) if it has several
    exhibits. A table's own caption comes first, then the nearest one before it, then the page's.
    """
    if "exhibit_no" not in tables.columns:
        tables = tables.withColumn("exhibit_no", F.lit(1))
    wanted = TB.read_tables_of_exhibits(tables, filing, keep)
    own = T.dominant_scale(F.concat_ws("\n", "context", F.array_join(F.flatten("rows"), " ")))
    return wanted.withColumns({
        "scale": F.coalesce(own, F.col("near_scale"), F.col("doc_scale"), F.lit("")),
        "shares": T.shares_scale(F.col("context")),
        "section": F.when(F.col("table_type") == "segment", "other").otherwise(F.col("table_type")),
    }).drop("context", "near_scale", "doc_scale", "table_type")


def statement_metrics(tables: DataFrame, filing: str = "filing_id", keep: DataFrame | None = None) -> DataFrame:
    """Scaled metric rows read from the tables that go to extraction; those of another period are stale."""
    rows = TB.statement_rows(shaped_tables(tables, filing, keep), F.col("period_end"), F.col("annual"))
    dollars = T.scale_factor(F.col("scale"))
    value = numbers.scaled(F.col("key"), F.col("raw_value"), dollars,
                           F.when(F.col("shares").isNull(), dollars).otherwise(T.scale_factor(F.col("shares"))))
    return rows.select(
        filing, "cik", TB.table_key(F.col("exhibit_no"), F.col("table_idx")).alias("chunk_idx"), "section", "key",
        TB.order_key(F.col("exhibit_no"), F.col("table_idx"), F.col("row_idx")).alias("key_ord"),
        value.alias("num_value"), F.lit(None).cast("string").alias("str_value"),
        "is_stale",
    )


def statement_rejects(tables: DataFrame, filing: str = "filing_id") -> DataFrame:
    """Rows of the tables that go to extraction which hold numbers but gave no value."""
    rows = TB.statement_rejects(shaped_tables(tables, filing), F.col("period_end"), F.col("annual"))
    return rows.select(filing, "cik", "table_idx", "row_idx", "key", "n_cells", "current_end")


@dataclass
class Extraction:
    """Results of one pass."""

    metrics: DataFrame
    values: DataFrame
    findings: DataFrame


def check(rows: DataFrame, filing: str = "filing_id") -> tuple[DataFrame, DataFrame]:
    """(metrics, findings) from scaled rows: merged, corrected, checked, cleaned.

    Merged and cleaned metrics are written once each: several later steps read them, and the
    pages behind them must not be read again for each.
    """
    merged = staged(M.merge(rows, filing, ("cik",)), "merged")
    ops = Q.operands(merged, filing)
    fixed, notes = Q.correct_opex(Q.correct_values(merged, ops, filing), ops, filing)
    found = staged(Q.findings(fixed, filing, targeted=True).unionByName(notes), "findings")
    return staged(cleanup.drop_flagged(fixed, found, filing), "metrics"), found


def fill(metrics: DataFrame, concepts: DataFrame, filing: str = "filing_id",
         semantic: DataFrame | None = None, role_answers: DataFrame | None = None,
         scan: DataFrame | None = None, texts: DataFrame | None = None) -> DataFrame:
    """(filing, concept_id, value, derived): mapped metrics, roll-ups and derived values.

    Optional inputs fill more: ``semantic`` answers (filing, resp_ord, concept_id, key),
    ``role_answers`` (cik, label, role), ``scan``, the statement rows (filing, table_idx,
    row_idx, key, value) in which concepts without a metric are looked for, and ``texts`` (filing, raw_text), in which
    those are looked for that are still without a value.
    """
    owner = metrics.select(filing, "cik").distinct()
    known = C.with_roles(concepts, role_answers).select(
        "cik", "concept_id", "concept_ord", "path", "label", "taxonomy_key", "role")
    mapped = C.map_metrics(metrics, concepts, filing).select(filing, "concept_id", "key", "value", "tier", "key_ord")

    if semantic is not None:
        asked = C.semantic_candidates(C.unmapped(owner.join(known, "cik"), mapped, filing))
        mapped = staged(C.apply_semantic_map(mapped, semantic, metrics, asked, filing), "semantic")
    def missing() -> DataFrame:
        return C.unmapped(owner.join(known, "cik"), mapped, filing)

    def added(found: DataFrame, tier: int) -> DataFrame:
        return staged(mapped.unionByName(found.select(
            filing, "concept_id", F.lit(None).cast("string").alias("key"), "value", F.lit(tier).alias("tier"), F.lit(2**62).alias("key_ord"))), "added")

    if scan is not None:
        mapped = added(C.scan_rows(missing(), C.parent_rows(scan, filing), filing), 4)
    if texts is not None:
        mapped = added(LS.search(missing(), texts, filing), 5)
    values = mapped.select(filing, "concept_id", F.col("value").cast("double").alias("value"), "key_ord").join(owner, filing)
    return D.resolve(values, D.company_trees(known), filing)


def response_metrics(responses: DataFrame) -> DataFrame:
    """Scaled metric rows from model answers instead of table cells.

    ``responses``: filing_id, cik, chunk_idx, section, text, prescan (scale found in the chunk or
    its document), shares (scale of share counts where it is another one), report_date. The
    prescanned scale bounds the reported one; a chunk of another year than the report is stale.
    """
    rows, _ = RS.parse_responses(responses)
    dollars = T.scale_factor(F.coalesce("prescan", F.lit("")))
    shares = F.when(F.col("shares").isNull(), dollars).otherwise(T.scale_factor(F.col("shares")))
    scaled = RS.apply_scale(RS.metric_rows(rows), dollars, shares)
    return scaled.withColumn("is_stale", M.stale(F.year("report_date"), F.col("period"))).select(
        "filing_id", "cik", "chunk_idx", "section", "key", "key_ord", "num_value", "str_value", "is_stale")


def extract_from_responses(responses: DataFrame, concepts: DataFrame, **more: DataFrame) -> Extraction:
    """Model answers through merge, checks, mapping and derivation; ``more`` as in ``fill``."""
    metrics, found = check(response_metrics(responses))
    numeric = metrics.filter("key <> '__period__'")
    return Extraction(metrics, fill(numeric, concepts, **more), found)


def extract(pages: DataFrame, concepts: DataFrame, filing: str = "filing_id", keep: DataFrame | None = None,
            removals: DataFrame | None = None, **more: DataFrame) -> Extraction:
    """Pages (filing, cik, period_end, annual, html, and exhibit_no where a filing has several) through the whole pipeline.

    Correction and clean-up run before the mapping, so that what they change is what is saved. ``keep`` says which
    undecided tables are left out; ``removals`` (filing, key, reason) are answers on metrics to be taken out, of which
    the guards let pass those that harm nothing; a key that is mapped to a concept stays. ``more`` as in ``fill``.
    """
    metrics, found = check(statement_metrics(read_tables(pages), filing, keep), filing)
    if removals is not None:
        mapped = C.map_metrics(metrics, concepts, filing).select(filing, "key", F.lit(True).alias("protected"))
        guarded = metrics.join(mapped, [filing, "key"], "left").withColumn("protected", F.coalesce("protected", F.lit(False)))
        metrics = staged(cleanup.guarded_removal(guarded, removals, filing).drop("protected"), "cleaned")
    return Extraction(metrics, fill(metrics, concepts, filing, **more), found)


def scanned_rows(tables: DataFrame, filing: str = "filing_id") -> DataFrame:
    """All labelled rows of the tables that go to extraction, with or without a value: what ``fill`` scans. ``n_values``
    is a row's number of cells."""
    rows = TB.read_rows(shaped_tables(tables, filing), F.col("period_end"), F.col("annual"))
    return rows.select(
        filing, TB.table_key(F.col("exhibit_no"), F.col("table_idx")).alias("table_idx"), "row_idx", "key",
        (F.col("raw_value") * T.scale_factor(F.col("scale"))).alias("value"), F.col("n_cells").alias("n_values"))


def exhibit_texts(pages: DataFrame, filing: str = "filing_id") -> DataFrame:
    """(filing, raw_text): the prose of a filing's exhibits in order, one line per text node."""
    if "exhibit_no" not in pages.columns:
        pages = pages.withColumn("exhibit_no", F.lit(1))
    prose = html.page_segments(pages).select(filing, "exhibit_no", html.prose(F.col("segments")).alias("prose"))
    return prose.groupBy(filing).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("exhibit_no", "prose"))), lambda x: x["prose"]), "\n").alias("raw_text"))


def save(spark: SparkSession, out: Extraction, filings: DataFrame, path: str, strict: bool = True,
         filing: str = "filing_id") -> DataFrame:
    """Upsert the values of filings that pass the save gate into the value table at ``path``; returns the gate's rows.

    ``filings`` as in ``sinks.value_rows``. A filing without a metric or value meets the gate too, and is refused.
    """
    warned = Q.operands(out.metrics, filing).select(filing, Q.blocking_warnings().alias("identity_warnings"))
    valued = out.values.groupBy(filing).agg(F.count("value").alias("n_values"))
    gated = staged(sinks.save_gate(
        filings.join(warned, filing, "left").join(valued, filing, "left").withColumn(
            "identity_warnings", F.coalesce("identity_warnings", F.array().cast("array<string>"))), strict), "gate")
    passed = filings.join(gated.filter("saved").select(filing), filing, "left_semi")
    sinks.upsert_values(spark, sinks.value_rows(out.values, passed, filing), path)
    return gated
