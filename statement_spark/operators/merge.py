"""Merging the values that the chunks of a filing report for a metric."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import fiscal, numbers, patterns as P, text as T


def section_priority(section: Column) -> Column:
    ranks = F.create_map(*[F.lit(x) for kv in P.SECTION_PRIORITY.items() for x in kv])
    return F.coalesce(F.try_element_at(ranks, section), F.lit(P.UNKNOWN_PRIORITY))


def stale(target_year: Column, period: Column) -> Column:
    """A chunk whose period names another year than the target; no year means on target."""
    year = fiscal.year_in_text(period)
    return F.coalesce(year != target_year, F.lit(False))


def merge_values(rows: DataFrame, filing: str = "filing_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """One value per (filing, key): (num_value, str_value, key_ord, on_target).

    Numbers come from the on-target chunks if any has the key, and there from the section of
    the highest authority; several values there give the median, or the largest when it is at
    least five times the smallest. Of strings the longest wins, of period labels the one with
    the highest year, and a string never replaces a number.

    Input columns: filing, key, key_ord, section, num_value, str_value, is_stale. Values of a key
    seldom agree, so combining them first saves little: the rows are shuffled once, by filing, as
    they are. Both aggregates and what follows per filing find them in place; what the median
    holds is one value per chunk of one page.
    """
    ranked = rows.select(
        filing, "key", "key_ord", "num_value", "str_value", "is_stale",
        section_priority(F.col("section")).alias("prio"), *carry,
    ).repartition(filing)
    year = F.coalesce(fiscal.year_in_text(F.col("str_value")), F.lit(0))
    weight = F.when(F.col("key") == "__period__", year).otherwise(F.length("str_value"))
    best_string = F.struct(weight.alias("w"), (-F.col("key_ord")).alias("o"))
    by_section = ranked.groupBy(filing, "key", "is_stale", "prio").agg(
        F.count("num_value").alias("n"),
        F.min("num_value").alias("lo"),
        F.max("num_value").alias("hi"),
        F.median("num_value").alias("mid"),
        F.min("key_ord").alias("ord"),
        F.max_by("str_value", F.when(F.col("str_value").isNotNull(), best_string)).alias("s"),
        F.max(F.when(F.col("str_value").isNotNull(), best_string)).alias("sw"),
        *[F.first(c).alias(c) for c in carry],
    )
    authority = F.struct("is_stale", "prio")
    numeric = F.when(F.col("n") > 0, authority)
    picked = by_section.groupBy(filing, "key").agg(
        F.min_by(F.struct("lo", "hi", "mid", "n"), numeric).alias("v"),
        F.max_by("s", F.when(F.col("s").isNotNull(), F.struct(~F.col("is_stale"), "sw"))).alias("s"),
        F.min("ord").alias("key_ord"),
        F.coalesce(F.bool_or((F.col("n") > 0) & ~F.col("is_stale")), F.lit(False)).alias("on_target"),
        *[F.first(c).alias(c) for c in carry],
    )
    artifact = (F.col("v.lo") != 0) & (
        F.abs("v.hi") / F.nullif(F.abs("v.lo"), F.lit(0.0)) >= P.ARTIFACT_RATIO
    )
    value = F.when((F.col("v.n") > 1) & artifact, F.col("v.hi")).otherwise(F.col("v.mid"))
    return picked.select(
        filing, "key", "key_ord", value.alias("num_value"),
        F.when(value.isNull(), F.col("s")).alias("str_value"), "on_target", *carry,
    )


def _revenue_like() -> Column:
    return F.lower("key").contains("revenue") & ~numbers.is_ratio(F.col("key"))


def revenue_reference(merged: DataFrame, filing: str = "filing_id") -> DataFrame:
    """Largest revenue-like value of each filing."""
    return merged.filter(_revenue_like()).groupBy(filing).agg(F.max("num_value").alias("revenue_ref"))


def repair_major_metrics(merged: DataFrame, filing: str = "filing_id") -> DataFrame:
    """Major metrics far below revenue: one scale step up when that is plausible, else dropped.

    Other small values stay as they are. The reference is a maximum over the merged keys of one
    filing, so the rows behind them are computed once.
    """
    ref = F.col("revenue_ref")
    floor = ref * P.MIN_REVENUE_FRACTION
    v = F.col("num_value")
    suspicious = (
        (ref != 0) & v.isNotNull() & ~numbers.is_ratio(F.col("key")) & (F.abs(v) < floor)
        & F.col("key").rlike(P.ci(P.MAJOR_KEY))
    )
    lifted = F.when(F.abs(v * 1000).between(floor, ref * P.RESCALE_UPPER), v * 1000)
    fixed = F.when(F.coalesce(suspicious, F.lit(False)), lifted).otherwise(v)
    reference = F.max(F.when(_revenue_like(), F.col("num_value"))).over(Window.partitionBy(filing))
    return merged.withColumn("revenue_ref", reference).withColumn("num_value", fixed).drop("revenue_ref")


def evict_stale_variants(merged: DataFrame, filing: str = "filing_id") -> DataFrame:
    """Of keys that differ in case or spaces, drop the stale-only ones when another is on target."""
    group = Window.partitionBy(filing, T.norm_label(F.col("key")))
    return merged.withColumn(
        "group_on_target", F.max("on_target").over(group)
    ).filter("num_value is null or on_target or not group_on_target").drop("group_on_target")


def merge(rows: DataFrame, filing: str = "filing_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """Merge, repair, evict, and drop what is left without a value."""
    out = evict_stale_variants(repair_major_metrics(merge_values(rows, filing, carry), filing), filing)
    return out.filter("num_value is not null or str_value is not null")


def merge_snippets(rows: DataFrame, filing: str = "filing_id") -> DataFrame:
    """Cited text per key: on-target and highest authority first."""
    order = F.struct(section_priority(F.col("section")), "is_stale", "chunk_idx")
    return rows.groupBy(filing, "key").agg(F.min_by("snippet", order).alias("snippet"))


def carry_over(attempts: DataFrame, filing: str = "filing_id") -> DataFrame:
    """Over the passes of a filing: new values replace old ones, untouched keys stay."""
    return attempts.groupBy(filing, "key").agg(
        F.max_by(F.struct("num_value", "str_value"), "attempt").alias("v"),
        F.min_by("key_ord", "attempt").alias("key_ord"),
        F.max("attempt").alias("attempt"),
    ).select(filing, "key", "key_ord", "v.num_value", "v.str_value", "attempt")


def provenance(rows: DataFrame, filing: str = "filing_id") -> DataFrame:
    """Chunks that gave a value for a key, from the newest pass that has the key."""
    per_pass = rows.filter(~F.col("key").startswith("__")).groupBy(filing, "key", "attempt").agg(
        F.array_sort(F.collect_set("chunk_idx")).alias("chunks")
    )
    return per_pass.groupBy(filing, "key").agg(
        F.max_by("chunks", "attempt").alias("chunks"), F.max("attempt").alias("attempt")
    )
