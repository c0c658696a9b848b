"""Reports over runs, findings and events."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import matched
from .quality import REGISTRY


def catalogue(spark: SparkSession) -> DataFrame:
    """The checks as a table: (ord, id, types, remediation)."""
    rows = [(i, d.id, list(d.types), d.remediation) for i, d in enumerate(REGISTRY)]
    return spark.createDataFrame(rows, "ord int, id string, types array<string>, remediation string")


def checks_for_types(types: DataFrame, spark: SparkSession) -> DataFrame:
    """(group, id, ord, remediation) of the checks that own any of a group's finding types."""
    owned = catalogue(spark).select("ord", "id", "remediation", F.explode("types").alias("type"))
    return types.join(F.broadcast(owned), "type").select("grp", "ord", "id", "remediation").distinct()


def remediation_block(types: DataFrame, spark: SparkSession) -> DataFrame:
    """Bullet list of guidance per group, in catalogue order."""
    line = F.concat(F.lit("- ("), "id", F.lit(") "), "remediation")
    return checks_for_types(types, spark).groupBy("grp").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("ord", line.alias("l")))), lambda x: x["l"]), "\n"
        ).alias("block"))


def failed_runs(runs: DataFrame, status: str | None = None, tickers: list[str] | None = None,
                since: Column | None = None) -> DataFrame:
    """Degraded and failed runs, by status, ticker and time."""
    out = runs.filter(F.col("status") == status) if status else runs.filter(
        F.col("status").isin("degraded", "failed"))
    if tickers:
        out = out.filter(F.col("ticker").isin([t.upper() for t in tickers]))
    return out.filter(F.col("scraped_at") >= since) if since is not None else out


def failure_report(runs: DataFrame, warnings: int = 3) -> DataFrame:
    """One row per run: ``type×n`` list of high and medium findings, and the first ``warnings`` warnings as text; the
    runs hold them all."""
    worth = F.filter("findings", lambda f: f["severity"].isin("high", "medium"))
    names = F.array_sort(F.transform(worth, lambda f: f["type"]))
    summary = F.transform(F.array_distinct(names), lambda t: F.concat(
        t, F.lit("×"), F.size(F.filter(names, lambda n: n == t)).cast("string")))
    return runs.select(
        "_id", "ticker", "status", "scraped_at",
        F.when(F.size(summary) > 0, F.array_join(summary, "  ")).otherwise("—").alias("findings_text"),
        F.array_join(F.slice("identity_warnings", 1, warnings), "  ").alias("warnings_text"),
        F.array_join(F.transform(worth, lambda f: F.concat(F.lit("  • "), f["message"])), "\n").alias("messages"),
    )


def type_totals(runs: DataFrame) -> DataFrame:
    """Occurrences per finding type with the tickers affected, most frequent first."""
    rows = runs.select("ticker", F.explode("findings").alias("f")).filter(
        "f.severity in ('high', 'medium')").select("ticker", F.col("f.type").alias("type"))
    per_ticker = rows.groupBy("type", "ticker").agg(F.count(F.lit(1)).alias("n"))
    return per_ticker.groupBy("type").agg(
        F.sum("n").alias("occurrences"), F.count(F.lit(1)).alias("n_tickers"),
    ).orderBy(F.desc("occurrences"), "type")


def affected_tickers(runs: DataFrame) -> DataFrame:
    """(type, ticker) pairs behind the totals; rows rather than one long text per type."""
    return runs.select("ticker", F.explode("findings").alias("f")).filter(
        "f.severity in ('high', 'medium')").select(F.col("f.type").alias("type"), "ticker").distinct()


def finding_counts(found: DataFrame, *by: str, worth_only: bool = False) -> DataFrame:
    src = found.filter("severity in ('high', 'medium')") if worth_only else found
    return src.groupBy(*by, "type").agg(F.count(F.lit(1)).alias("n"))


def status_totals(runs: DataFrame) -> DataFrame:
    return runs.groupBy("status").agg(F.count(F.lit(1)).alias("n_runs"))


def fill_summary(concepts: DataFrame, values: DataFrame, filing: str = "filing_id") -> DataFrame:
    """Concepts per filing: mapped, derived, absent at top level and in segments.

    ``values``: filing, concept_id, derived.
    """
    joined = concepts.select(filing, "concept_id", "taxonomy_key").join(
        matched(values.select(filing, "concept_id", "derived")), [filing, "concept_id"], "left")
    segment = F.coalesce(F.col("taxonomy_key").contains("|"), F.lit(False))
    none = F.col("derived").isNull()
    return joined.groupBy(filing).agg(
        F.count_if(~none & ~F.col("derived")).alias("mapped"),
        F.count_if(~none & F.col("derived")).alias("derived"),
        F.count_if(none & ~segment).alias("absent_toplevel"),
        F.count_if(none & segment).alias("absent_segment"),
        F.count(F.lit(1)).alias("total"))


def insertion_lines(concepts: DataFrame, values: DataFrame, filing: str = "filing_id") -> DataFrame:
    """Every concept with its group (extracted, derived, absent), in report order."""
    joined = concepts.select(filing, "concept_id", "label").join(
        matched(values.select(filing, "concept_id", "value", "derived")), [filing, "concept_id"], "left")
    group = F.when(F.col("derived").isNull(), 2).when(F.col("derived"), 1).otherwise(0)
    return joined.withColumn("grp", group).orderBy(filing, "grp", F.lower("label"))


def model_calls(events: DataFrame) -> DataFrame:
    return events.groupBy("load_request_id").agg(F.count_if(F.col("kind") == "call_llm").alias("calls"))
