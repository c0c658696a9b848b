"""Removing duplicate, leaked and malformed metrics, with guards."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import numbers, patterns as P, text as T
from . import quality


def drop_flagged(metrics: DataFrame, found: DataFrame, filing: str = "filing_id") -> DataFrame:
    """Drop the keys the findings condemn: leaked and composite keys, and of a duplicate group
    all but the earliest."""
    flagged = found.filter(
        F.col("type").isin("gaap_nongaap_leakage", "composite_key", "case_duplicate")
    ).select(filing, F.explode(
        F.when(F.col("type") == "case_duplicate", F.slice("keys", F.lit(2), F.size("keys"))).otherwise(F.col("keys"))
    ).alias("key")).distinct()
    return metrics.join(flagged, [filing, "key"], "left_anti")


def near_equal_pairs(metrics: DataFrame, filing: str = "filing_id") -> DataFrame:
    """Neighbours by value that agree within 0.1 %: (filing, key_a, key_b, a, b).

    The ordered pass is per filing: the distinct metric keys of one document.
    """
    w = Window.partitionBy(filing).orderBy("num_value", "key_ord")
    rows = metrics.filter("num_value is not null and num_value <> 0")
    cols = ["key", "num_value"] + [c for c in ("protected",) if c in metrics.columns]
    pairs = rows.withColumn("b", F.struct(*cols)).withColumn("a", F.lag("b").over(w)).filter(
        numbers.close(F.col("b.num_value"), F.col("a.num_value"))
    )
    extra = [(F.col("a.protected") & F.col("b.protected")).alias("both_protected")] if "protected" in cols else []
    return pairs.select(filing, F.col("a.key").alias("key_a"), F.col("b.key").alias("key_b"),
                        F.col("a.num_value").alias("a"), F.col("b.num_value").alias("b"), *extra)


def needs_cleanup(metrics: DataFrame, filing: str = "filing_id") -> DataFrame:
    """Filings with a cleanup candidate. ``metrics`` has ``protected``; protected keys alone
    never make one."""
    per_share = F.col("key").rlike(P.ci(P.PER_SHARE_KEY)) & (F.abs("num_value") > P.PER_SHARE_ALARM)
    alarm = metrics.filter(per_share & ~F.col("protected")).select(filing, F.lit("per_share").alias("why"))
    dupes = metrics.groupBy(filing, F.lower("key").alias("lk")).agg(
        F.count(F.lit(1)).alias("n"), F.bool_and("protected").alias("all_protected")
    ).filter("n > 1 and not all_protected").select(filing, F.lit("case_duplicate").alias("why"))
    near = near_equal_pairs(metrics, filing).filter("not both_protected").select(
        filing, F.lit("near_equal").alias("why"))
    return alarm.unionByName(dupes).unionByName(near).groupBy(filing).agg(
        F.array_sort(F.collect_set("why")).alias("reasons"))


def prompt_payload(metrics: DataFrame, filing: str = "filing_id") -> DataFrame:
    """Metrics of a filing as one JSON object with compact numbers, in key order."""
    item = F.struct("key_ord", F.concat(
        F.to_json(F.struct("key")).substr(F.lit(8), F.length(F.to_json(F.struct("key"))) - 8), F.lit(": "),
        F.when(F.abs("num_value") >= 1000, F.concat(F.lit('"'), T.compact_value(F.col("num_value")), F.lit('"')))
        .otherwise(T.compact_value(F.col("num_value"))),
    ).alias("t"))
    return metrics.filter("num_value is not null").groupBy(filing).agg(
        F.concat(F.lit("{"), F.array_join(
            F.transform(F.array_sort(F.collect_list(item)), lambda x: x["t"]), ", "), F.lit("}")).alias("payload"))


def guarded_removal(metrics: DataFrame, answers: DataFrame, filing: str = "filing_id") -> DataFrame:
    """Metrics after the removals that model answers (filing, key, reason) ask for.

    An answer that names an unknown key is void as a whole. A removal without a reason or of a
    mapped key (``protected``) is ignored. If what is left raises a blocking warning that was not there before,
    the answer is void too. Values are never changed.

    The metrics and the answer of a filing, one document's keys, meet on its row in one aggregate; the operands of the
    warnings are taken twice from that row, with and without the keys to be removed.
    """
    columns = metrics.columns
    names = [c for c in columns if c != filing]
    rows = metrics.select(filing, F.struct("key_ord", *[c for c in names if c != "key_ord"]).alias("m")).unionByName(
        answers.select(filing, F.struct("key", F.trim(F.coalesce("reason", F.lit(""))).alias("reason")).alias("a")), allowMissingColumns=True)
    filed = rows.groupBy(filing).agg(F.array_sort(F.collect_list("m")).alias("rows"), F.collect_list("a").alias("asked"))
    every = F.transform("rows", lambda m: m["key"])
    guarded = F.transform(F.filter("rows", lambda m: F.coalesce(m["protected"], F.lit(False))), lambda m: m["key"])
    reasoned = F.transform(F.filter("asked", lambda a: a["reason"] != ""), lambda a: a["key"])
    known = F.forall("asked", lambda a: F.array_contains(F.col("every"), a["key"]))
    legal = F.when(known, F.array_except(reasoned, guarded)).otherwise(F.array().cast("array<string>"))
    filed = filed.withColumn("every", every).withColumn("legal", legal)
    filed = filed.withColumn("left", F.filter("rows", lambda m: ~F.array_contains(F.col("legal"), m["key"])))

    def warnings(at: str) -> Column:
        def first(name: str) -> Column:
            return F.get(F.filter(at, lambda m: m["key"].rlike(P.ci(P.VALIDATOR_OPERANDS[name]))), F.lit(0))["num_value"]

        return quality.blocking_warnings(first)

    filed = filed.withColumn("before", warnings("rows")).withColumn("after", warnings("left"))
    worse = F.size(F.array_except("after", "before")) > 0
    kept = filed.select(filing, F.explode(F.when(worse, F.col("rows")).otherwise(F.col("left"))).alias("m"))
    return kept.select(filing, *[F.col("m")[c].alias(c) for c in names]).select(*columns)
