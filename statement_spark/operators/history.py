"""Stored concept values: latest periods, recent concepts, prior values, planning."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import fiscal, patterns as P, text as T
from .periods import asof_previous, infer_fiscal_period


def all_values(quarterly: DataFrame, annual: DataFrame) -> DataFrame:
    """Both stores as one table with ``period_type``."""
    return quarterly.withColumn("period_type", F.lit("quarterly")).unionByName(
        annual.withColumn("period_type", F.lit("annual")), allowMissingColumns=True
    )


def latest_period(values: DataFrame) -> DataFrame:
    """Newest stored period per company; a quarterly one wins over an annual one of that day."""
    order = F.struct("end_date", F.col("period_type") == "quarterly")
    return values.filter("end_date is not null").groupBy("cik").agg(
        F.max_by(F.struct("period_type", "fiscal_year", "quarter", "end_date"), order).alias("p")
    ).select("cik", "p.*")


def period_counts(values: DataFrame) -> DataFrame:
    return values.groupBy("cik", "period_type", "fiscal_year", "quarter").agg(
        F.count(F.lit(1)).alias("n_values")
    )


def existing_periods(wanted: DataFrame, values: DataFrame) -> DataFrame:
    """Wanted (cik, fiscal_year, quarter or null for annual) that have stored values."""
    stored = values.select(
        "cik", "fiscal_year",
        F.when(F.col("period_type") == "quarterly", F.col("quarter")).alias("quarter"),
        "period_type",
    )
    same = (
        (wanted["cik"] == stored["cik"]) & (wanted["fiscal_year"] == stored["fiscal_year"])
        & wanted["quarter"].eqNullSafe(stored["quarter"])
    )
    return wanted.join(stored, same, "left_semi")


def with_history(companies: DataFrame, values: DataFrame) -> DataFrame:
    """Companies that have any stored period."""
    return companies.join(values, "cik", "left_semi")


def recent_concepts(values: DataFrame, periods: int = P.HISTORY_PERIODS) -> DataFrame:
    """Concepts valued in the last ``periods`` distinct period ends of each company and type.

    The ranking runs over distinct period ends, which the calendar bounds.
    """
    ends = values.select("cik", "period_type", "end_date").distinct().filter("end_date is not null")
    w = Window.partitionBy("cik", "period_type").orderBy(F.desc("end_date"))
    recent = ends.withColumn("rk", F.dense_rank().over(w)).filter(F.col("rk") <= periods).drop("rk")
    return values.join(recent, ["cik", "period_type", "end_date"], "left_semi").select(
        "cik", "period_type", "concept_id"
    ).distinct()


def prune_concepts(concepts: DataFrame, recent: DataFrame) -> DataFrame:
    """Concepts with recent values; a company without any keeps its whole list."""
    marked = concepts.join(
        recent.select("cik", "concept_id").distinct().withColumn("is_recent", F.lit(True)),
        ["cik", "concept_id"], "left",
    )
    has_any = marked.filter("is_recent").select("cik").distinct().withColumn("has_any", F.lit(True))
    return marked.join(has_any, "cik", "left").filter("is_recent or has_any is null").drop(
        "is_recent", "has_any"
    )


def cadence(filings: DataFrame, values: DataFrame) -> DataFrame:
    """Period type of filings (cik, period_end, fye_month, fye_code): cadence, date, decision."""
    stored = latest_period(values).select(
        "cik", F.col("period_type").alias("s_type"), F.col("quarter").alias("s_q"),
        F.col("end_date").alias("s_end"),
    )
    by_date = fiscal.date_period_type(F.col("period_end"), F.col("fye_month"), F.col("fye_code"))
    step = fiscal.next_period_type(F.col("s_type"), F.col("s_q"), F.col("s_end"), F.col("period_end"))
    out = filings.join(stored, "cik", "left").withColumns({"cadence": step, "by_date": by_date})
    return out.withColumns({
        "period_type": fiscal.final_period_type(F.col("cadence"), F.col("by_date")),
        "diverged": F.coalesce(F.col("cadence") != F.col("by_date"), F.lit(False)),
    }).drop("s_type", "s_q", "s_end")


def prior_values(current: DataFrame, values: DataFrame) -> DataFrame:
    """Value of each (cik, period_type, concept_id) at the company's last period of that type strictly before ``end_date``.

    Quarters meet quarters and years meet years. The prior period is found once per company, type and day; of several
    values of a concept in it the largest by magnitude counts.
    """
    by = ["cik", "period_type"]
    ends = values.select(*by, F.col("end_date").alias("prior_end")).distinct()
    placed = asof_previous(
        current, ends, by, "end_date", "prior_end", F.struct("prior_end"),
        F.lit(0), "prior",
    ).withColumn("prior_end", F.col("prior.prior_end")).drop("prior")
    best = values.groupBy(*by, "concept_id", F.col("end_date").alias("prior_end")).agg(
        F.max_by("value", F.abs("value")).alias("prior_value")
    )
    return placed.join(best, [*by, "concept_id", "prior_end"], "left")


def prior_reference(prior: DataFrame, by: list[str], top: int = 30) -> DataFrame:
    """The ``top`` prior values by magnitude per filing, largest first.

    A top-k report: each task keeps its best k rows before they meet.
    """
    part = prior.filter("prior_value is not null").withColumn(
        "slot", F.pmod(F.hash("concept_id"), F.lit(16))
    )

    def best(df: DataFrame, keys: list[str]) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(F.desc(F.abs("prior_value")), "concept_id")
        return df.withColumn("rk", F.row_number().over(w)).filter(F.col("rk") <= top)

    return best(best(part, [*by, "slot"]), by).drop("slot")


def contained_phrases(label: Column) -> Column:
    """Every run of whole words of a label."""
    words = F.split(label, " ")
    n = F.size(words)
    return F.array_distinct(F.flatten(F.transform(
        F.sequence(F.lit(1), n),
        lambda i: F.transform(
            F.sequence(F.lit(1), n - i + 1),
            lambda k: F.array_join(F.slice(words, i, k), " "),
        ),
    )))


def related_keys(metrics: DataFrame, concepts: DataFrame, filing: str, pattern: str) -> DataFrame:
    """(filing, key, concept_id) where one of key and label contains the other as whole words.

    Both directions are equi joins on phrases, so no pair is formed that does not match.
    """
    k = metrics.filter(F.col("key").rlike(P.ci(pattern))).select(
        filing, "key", T.norm_label(F.col("key")).alias("nk")
    )
    # a label that holds one of the keys holds the pattern too, so no other label's phrases are needed
    c = concepts.select(filing, "concept_id", "label", T.norm_label(F.col("label")).alias("nl"))
    inner = k.select(filing, "key", F.explode(contained_phrases(F.col("nk"))).alias("nl")).join(
        c, [filing, "nl"]
    )
    holds = c.filter(F.col("label").rlike(P.ci(pattern)) | F.col("nl").rlike(P.ci(pattern)))
    outer = holds.select(filing, "concept_id", F.explode(contained_phrases(F.col("nl"))).alias("nk")).join(
        k, [filing, "nk"]
    )
    return inner.select(filing, "key", "concept_id").unionByName(
        outer.select(filing, "key", "concept_id")
    ).distinct()


def momentum(current: DataFrame) -> DataFrame:
    """Rows (value, prior_value) whose ratio leaves the plausible band."""
    ratio = F.col("value") / F.nullif(F.col("prior_value"), F.lit(0.0))
    return current.withColumn("ratio", ratio).filter(
        (F.col("value") != 0) & ((F.col("ratio") < P.MOMENTUM_LOW) | (F.col("ratio") > P.MOMENTUM_HIGH))
    )


def skip_replace_plan(filings: DataFrame, subs: DataFrame, values: DataFrame,
                      dry_run: bool = False) -> DataFrame:
    """What to do with the newest earnings 8-K (cik, filing_date, fye_month) of each company.

    Its fiscal period comes from the filing list, else from the store. A stored period is
    skipped in a dry run and replaced otherwise.
    """
    period = infer_fiscal_period(filings, subs)
    stored = latest_period(values).select(
        "cik", F.col("fiscal_year").alias("l_fy"), F.col("quarter").alias("l_q"),
        F.col("period_type").alias("l_type"),
    )
    known = period.join(stored, "cik", "left").withColumns({
        "quarter": F.when(F.col("fiscal_year").isNull(), F.col("l_q")).otherwise(F.col("quarter")),
        "period_type": F.coalesce("period_type", "l_type"),
        "fiscal_year": F.coalesce("fiscal_year", "l_fy"),
    }).drop("l_fy", "l_q", "l_type").withColumn(
        "q_key", F.when(F.col("period_type") == "quarterly", F.col("quarter")).otherwise(F.lit(0))
    )
    counts = values.withColumn(
        "q_key", F.when(F.col("period_type") == "quarterly", F.col("quarter")).otherwise(F.lit(0))
    ).groupBy("cik", "period_type", "fiscal_year", "q_key").agg(F.count(F.lit(1)).alias("n_stored"))
    out = known.join(counts, ["cik", "period_type", "fiscal_year", "q_key"], "left")
    n = F.coalesce("n_stored", F.lit(0))
    action = F.when(n == 0, "new").otherwise("skip" if dry_run else "replace")
    return out.withColumns({"n_stored": n, "action": action}).drop("q_key")


def coverage(companies: DataFrame, values: DataFrame, nxt: DataFrame) -> DataFrame:
    """Companies with their last stored period, the filing due next, and whether it is out."""
    last = latest_period(values)
    counts = period_counts(values)
    stored = last.join(
        counts.withColumnRenamed("quarter", "cq"),
        ["cik", "period_type", "fiscal_year"], "left",
    ).filter("period_type = 'annual' or quarter <=> cq").groupBy(
        "cik", "period_type", "fiscal_year", "quarter", "end_date"
    ).agg(F.sum("n_values").alias("n_values"))
    out = companies.join(stored, "cik", "left").join(
        nxt.select("cik", "available", "sec_report_date", "latest_report_date"), "cik", "left"
    )
    note = (
        F.when(F.col("end_date").isNull(), "no data yet")
        .when(F.col("available"), "filed")
        .when(F.col("latest_report_date").isNotNull(), "stored, nothing newer")
        .otherwise("not yet")
    )
    return out.withColumns({
        "next_due": F.when(F.col("end_date").isNotNull(), fiscal.next_label(
            F.col("period_type"), F.col("fiscal_year"), F.col("quarter"))),
        "note": note,
    })


def not_yet_saved(companies: DataFrame, runs: DataFrame, year: Column) -> DataFrame:
    """Companies without a run document of the year."""
    key = F.concat_ws("_", F.col("ticker"), year.cast("string"), F.lit("latest"))
    return companies.withColumn("_id", key).join(runs.select("_id"), "_id", "left_anti").drop("_id")
