"""Deciding on another extraction pass, and what it covers."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import patterns as P, text as T


def flagged_chunks(found: DataFrame, provenance: DataFrame, filing: str = "filing_id") -> DataFrame:
    """Chunks that produced the keys of high findings."""
    keys = found.filter("severity = 'high'").select(filing, F.explode("keys").alias("key")).distinct()
    return keys.join(provenance.select(filing, "key", "chunks"), [filing, "key"]).select(
        filing, F.explode("chunks").alias("chunk_idx")).distinct()


def retry_sections(found: DataFrame, notes: DataFrame | None = None, filing: str = "filing_id") -> DataFrame:
    """Statement sections that high findings (and notes) point to."""
    blob = F.lower(F.concat_ws(" ", "message", "suggested_action"))

    def named(text: Column) -> Column:
        return F.array_compact(F.array(
            F.when(text.contains("income statement"), F.lit("income_statement")),
            F.when(text.contains("balance sheet"), F.lit("balance_sheet")),
            F.when(text.contains("cash flow"), F.lit("cash_flow")),
        ))

    identity = F.when(F.col("type") == "identity_violation", F.when(
        blob.contains("balance"), F.array(F.lit("balance_sheet"))).otherwise(F.array(F.lit("income_statement"))))
    by_key = F.array_compact(F.transform("keys", lambda k: T.key_section(k)))
    sections = F.concat(F.coalesce(identity, F.array().cast("array<string>")), named(blob), by_key)
    out = found.filter("severity = 'high'").select(filing, F.explode(sections).alias("section"))
    if notes is not None:
        out = out.unionByName(notes.select(filing, F.explode(named(F.lower("notes"))).alias("section")))
    return out.distinct()


def retry_scope(chunks: DataFrame, found: DataFrame, provenance: DataFrame, filing: str = "filing_id",
                notes: DataFrame | None = None) -> DataFrame:
    """Chunks (filing, chunk_idx, section) of the next pass: flagged ones and those of the named
    sections; all of a filing's chunks when that is none or all of them. ``scoped`` tells which."""
    by_section = chunks.join(retry_sections(found, notes, filing), [filing, "section"]).select(filing, "chunk_idx")
    chosen = flagged_chunks(found, provenance, filing).unionByName(by_section).distinct().withColumn(
        "hit", F.lit(True))
    marked = chunks.join(chosen, [filing, "chunk_idx"], "left")
    counts = marked.groupBy(filing).agg(F.count("hit").alias("n_hit"), F.count(F.lit(1)).alias("n_all"))
    scoped = (F.col("n_hit") > 0) & (F.col("n_hit") < F.col("n_all"))
    return marked.join(counts, filing).withColumn("scoped", scoped).filter("not scoped or hit").drop(
        "hit", "n_hit", "n_all")


def decisions(found: DataFrame, attempts: DataFrame, filing: str = "filing_id") -> DataFrame:
    """Per (filing, attempt): re-extract or not, and why.

    A pass is repeated while high findings remain, attempts are left, and the high messages
    differ from the previous pass. A filing has at most three passes.
    """
    high = found.filter("severity = 'high'").groupBy(filing, "attempt").agg(
        F.array_sort(F.collect_list("message")).alias("high"))
    w = Window.partitionBy(filing).orderBy("attempt")
    empty = F.array().cast("array<string>")
    rows = attempts.join(high, [filing, "attempt"], "left").withColumn("high", F.coalesce("high", empty))
    rows = rows.withColumn("before", F.lag("high").over(w))
    reason = (
        F.when(F.size("high") == 0, "clean")
        .when(F.col("attempt") >= P.MAX_ATTEMPTS, "attempts_used")
        .when(F.col("high").eqNullSafe(F.col("before")), "no_progress")
        .otherwise("retry")
    )
    return rows.select(filing, "attempt", F.size("high").alias("n_high"), reason.alias("reason"),
                       (reason == "retry").alias("reextract"))


def effectiveness(found: DataFrame, filing: str = "filing_id") -> DataFrame:
    """Findings resolved, persisted and new from pass to pass, per (filing, attempt, type).

    A finding is matched by its signature; each attempt is compared with the one before by a
    full outer equi join.
    """
    sig = T.finding_signature(
        F.col("type"), F.col("keys"), F.try_element_at("evidence", F.lit("metric")), F.col("message"))
    seen = found.select(filing, "attempt", "type", sig.alias("sig")).distinct()
    last = seen.groupBy(filing).agg(F.max("attempt").alias("last"))
    curr = seen.withColumn("is_curr", F.lit(True))
    prev = seen.join(last, filing).filter("attempt < last").select(
        filing, (F.col("attempt") + 1).alias("attempt"), "type", "sig", F.lit(True).alias("is_prev"))
    both = curr.filter("attempt > 1").join(prev, [filing, "attempt", "type", "sig"], "full")
    p, c = F.col("is_prev").isNotNull(), F.col("is_curr").isNotNull()
    return both.groupBy(filing, "attempt", "type").agg(
        F.count_if(p & ~c).alias("resolved"), F.count_if(p & c).alias("persisted"),
        F.count_if(~p & c).alias("new"))


def extraction_notes(found: DataFrame, missing: DataFrame, filing: str = "filing_id",
                     previous: DataFrame | None = None, top_level: int = 10, segments: int = 20) -> DataFrame:
    """Hint text of the next pass: required, also wanted, and missing concepts. The text names the first ``top_level``
    and ``segments`` of these; ``missing`` itself is the uncut result.

    ``missing``: filing, label, is_segment, concept_ord; ``previous``: filing, attempt and notes
    of the pass before, which go in front.
    """
    ev = lambda k: F.try_element_at("evidence", F.lit(k)).try_cast("double")
    implied = F.when((F.col("type") == "identity_violation") & ev("gross_profit").isNotNull(), F.concat(
        F.lit("\n      Revenue less gross profit is "),
        F.format_number(ev("revenue") - ev("gross_profit"), 0),
        F.lit(", which cost of revenue should show.")))
    line = F.when(F.col("severity") == "high", F.concat(
        F.lit("  - must: "), "message",
        F.coalesce(F.concat(F.lit("\n      -> "), "suggested_action"), F.lit("")),
        F.coalesce(implied, F.lit("")))).otherwise(F.concat(F.lit("  - "), "message"))
    lines = found.filter("severity in ('high', 'medium')").select(
        filing, F.when(F.col("severity") == "high", 0).otherwise(1).alias("block"),
        F.col("detector_ord").alias("ord"), line.alias("line"))

    def top(segment: bool, block: int, n: int) -> DataFrame:
        per = missing.filter(F.col("is_segment") == segment).groupBy(filing).agg(
            F.slice(F.array_sort(F.collect_list(F.struct("concept_ord", "label"))), 1, n).alias("x"))
        return per.select(filing, F.lit(block).alias("block"), F.posexplode("x").alias("ord", "m")).select(
            filing, "block", "ord", F.concat(F.lit("  • "), "m.label").alias("line"))

    heads = {0: "Needed from this pass:", 1: "Worth a second look:",
             2: "Concepts still without a value:", 3: "Segments still without a value:"}
    every = lines.unionByName(top(False, 2, top_level)).unionByName(top(True, 3, segments))
    blocks = every.groupBy(filing, "block").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "line"))), lambda x: x["line"]), "\n")
        .alias("t"))
    title = F.element_at(F.create_map(*[F.lit(x) for kv in heads.items() for x in kv]), F.col("block"))
    notes = blocks.withColumn("t", F.concat(title, F.lit("\n"), "t")).groupBy(filing).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "t"))), lambda x: x["t"]), "\n")
        .alias("notes"))
    if previous is None:
        return notes
    before = previous.select(filing, F.concat(
        F.lit("After pass "), F.col("attempt").cast("string"), F.lit(": "), F.trim("notes"), F.lit("\n\n")).alias("old"))
    return notes.join(before, filing, "left").select(filing, F.concat(F.coalesce("old", F.lit("")), "notes").alias("notes"))
