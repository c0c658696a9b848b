"""The run over several passes: chunks whose values the checks doubt are asked again, at most ``MAX_ATTEMPTS`` times.

Every pass works on the filings that are still open and on the chunks that their findings point to. What a
pass gives replaces, key by key, what the passes before gave; a filing is done when no high finding is left, when the high
findings are those of the pass before, or when the attempts are used up. Each pass ends in written tables, so the next one
reads rows and not the plan that made them, and the loop has a fixed number of rounds.
"""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions import patterns as P
from ..operators import cleanup, merge as M, quality as Q, retry as RT
from ..session import small, staged


@dataclass
class Passes:
    """``metrics`` of each filing after its last pass; ``findings`` of every pass; ``decisions`` (filing, attempt, n_chunks,
    n_high, reason); ``sources``: the chunks that gave each key's value, and the pass it is from."""

    metrics: DataFrame
    findings: DataFrame
    decisions: DataFrame
    sources: DataFrame


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def run_passes(chunks: DataFrame, ask: Callable[[DataFrame], DataFrame], filing: str = "filing_id",
               most: int = P.MAX_ATTEMPTS) -> Passes:
    """``chunks``: filing, chunk_idx, section. ``ask`` gets such rows with ``attempt`` and ``scoped``, and returns the scaled
    metric rows of their answers (filing, cik, chunk_idx, section, key, key_ord, num_value, str_value, is_stale)."""
    scope = chunks.withColumn("scoped", F.lit(False))
    given, merged, done, findings, decided, before = [], [], [], [], [], None
    for attempt in range(1, most + 1):
        scope = staged(scope.withColumn("attempt", F.lit(attempt)), "scope")
        rows = staged(ask(scope).withColumn("attempt", F.lit(attempt)), "answers")
        given.append(rows)
        merged.append(staged(M.merge(rows, filing, ("cik",)).withColumn("attempt", F.lit(attempt)), "merged"))
        filings = scope.groupBy(filing).agg(F.count(F.lit(1)).alias("n_chunks"))
        so_far = _union(merged)
        if attempt > 1:
            so_far = so_far.join(small(filings.select(filing)), filing, "left_semi")
        ciks = so_far.groupBy(filing).agg(F.first("cik").alias("cik"))
        values = staged(M.carry_over(so_far, filing).drop("attempt").join(ciks, filing), "values")

        ops = Q.operands(values, filing)
        fixed, notes = Q.correct_opex(Q.correct_values(values, ops, filing), ops, filing)
        found = staged(Q.findings(fixed, filing, targeted=True).unionByName(notes), "findings")
        findings.append(found.withColumn("attempt", F.lit(attempt)))
        metrics = staged(cleanup.drop_flagged(fixed, found, filing), "metrics")

        high = found.filter("severity = 'high'").groupBy(filing).agg(F.array_sort(F.collect_list("message")).alias("high"))
        verdict = filings.join(high, filing, "left").withColumn("high", F.coalesce("high", F.array().cast("array<string>")))
        if before is None:
            verdict = verdict.withColumn("before", F.lit(None).cast("array<string>"))
        else:
            verdict = verdict.join(before.select(filing, F.col("high").alias("before")), filing, "left")
        reason = F.when(F.size("high") == 0, "clean").when(F.lit(attempt >= most), "attempts_used").when(
            F.col("high").eqNullSafe(F.col("before")), "no_progress").otherwise("retry")
        before = staged(verdict.select(filing, F.lit(attempt).alias("attempt"), "n_chunks", F.size("high").alias("n_high"), reason.alias("reason"), "high"), "verdict")
        decided.append(before.drop("high"))

        again = before.filter("reason = 'retry'").select(filing)
        done.append(metrics.join(small(again), filing, "left_anti"))
        if again.isEmpty():
            break
        only = lambda df: df.join(small(again), filing, "left_semi")
        sources = M.provenance(only(_union(given)), filing)
        scope = RT.retry_scope(only(chunks), only(found), sources, filing).select(*chunks.columns, "scoped")
    return Passes(_union(done), _union(findings), _union(decided), M.provenance(_union(given), filing))
