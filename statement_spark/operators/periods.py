"""As-of and nearest-date joins, and the period a filing reports on."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import fiscal

PERIODIC = ("10-Q", "10-K")


def _by_day(rows: DataFrame, by: list[str], day: Column, payload: Column, order: Column) -> DataFrame:
    """One row per key and calendar day: however many rows a key has, its days are bounded."""
    return rows.select(*by, day.alias("day"), payload.alias("payload"), order.alias("o")).filter(
        "day is not null"
    ).groupBy(*by, "day").agg(F.min_by("payload", "o").alias("payload"), F.min("o").alias("o"))


def _timeline(left: DataFrame, right: DataFrame, by: list[str], left_day: str) -> DataFrame:
    """Distinct probe days of a key and its series days on one line."""
    probes = left.select(*by, F.col(left_day).alias("day")).distinct().filter("day is not null")
    kind = right.schema["payload"].dataType
    return probes.select(
        *by, "day", F.lit(True).alias("probe"), F.lit(None).cast(kind).alias("payload"),
        F.lit(None).cast(right.schema["o"].dataType).alias("o"),
    ).unionByName(right.withColumn("probe", F.lit(False)))


def asof_previous(left: DataFrame, right: DataFrame, by: list[str], left_day: str, right_day: str,
                  payload: Column, order: Column, name: str) -> DataFrame:
    """Add ``name``: the payload of the last right row strictly before the left row's day.

    Right rows of one day count by ``order`` (the first). The ordered pass runs over distinct
    days per key, a number the calendar bounds, and the result joins back on (key, day): a key
    with a third of all rows is spread over its days.
    """
    series = _by_day(right, by, F.col(right_day), payload, order)
    w = Window.partitionBy(*by).orderBy("day", F.col("probe").desc())
    seen = _timeline(left, series, by, left_day).withColumn(
        name, F.last("payload", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    ).filter("probe").select(*by, F.col("day").alias(left_day), name)
    return left.join(seen, [*by, left_day], "left")


def nearest_by_day(left: DataFrame, right: DataFrame, by: list[str], left_day: str, right_day: str,
                   payload: Column, order: Column, within: int, name: str) -> DataFrame:
    """Add ``name``: the payload of the right row closest to the left row's day, at most
    ``within`` days away; equal distances go to the lower ``order``."""
    series = _by_day(right, by, F.col(right_day), payload, order)
    item = F.when(~F.col("probe"), F.struct("day", "o", "payload"))
    w = Window.partitionBy(*by).orderBy("day", "probe")
    line = _timeline(left, series, by, left_day).withColumns({
        "before": F.last(item, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)),
        "after": F.first(item, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing)),
    }).filter("probe")

    def option(c: str) -> Column:
        x = F.col(c)
        return F.when(
            x.isNotNull(),
            F.struct(F.abs(F.datediff(x["day"], "day")).alias("d"), x["o"].alias("o"),
                     x["payload"].alias("p")),
        )

    best = F.array_min(F.array_compact(F.array(option("before"), option("after"))))
    hit = line.withColumn("best", best).select(
        *by, F.col("day").alias(left_day), F.when(F.col("best.d") <= within, F.col("best.p")).alias(name)
    )
    return left.join(hit, [*by, left_day], "left")


def infer_period_end(filings: DataFrame, subs: DataFrame) -> DataFrame:
    """Period end of 8-K filings (cik, filing_date, report_date) with the method that gave it.

    The periodic filing closest to one year earlier, moved one year on, is the best witness;
    then the given date when it lies between the last period end and the filing, then the last
    period end when it is at most 60 days old, then 30 days before the filing.
    """
    periodic = subs.filter(F.col("form").isin(*PERIODIC))
    end = F.struct(F.col("report_date").alias("end"))
    probed = filings.withColumn("year_ago", F.add_months("filing_date", -12))
    near = nearest_by_day(
        probed, periodic.filter("report_date is not null"), ["cik"], "year_ago", "filing_date",
        end, F.col("pos"), 90, "near",
    )
    both = asof_previous(near, periodic, ["cik"], "filing_date", "report_date", end,
                         F.col("pos"), "prior")
    projected = F.add_months("near.end", 12)
    gap = F.datediff("filing_date", projected)
    raw, prior = F.col("report_date"), F.col("prior.end")
    method = (
        F.when(F.col("filing_date").isNull(), None)
        .when(gap.between(1, 100), "projected")
        .when(raw.isNull(), None)
        .when((prior < raw) & (raw < F.col("filing_date")), "reported")
        .when(prior.isNull(), "unchecked")
        .when(F.datediff("filing_date", prior) <= 60, "last_period")
        .otherwise("estimated")
    )
    value = (
        F.when(F.col("method") == "projected", projected)
        .when(F.col("method").isin("reported", "unchecked"), raw)
        .when(F.col("method") == "last_period", prior)
        .when(F.col("method") == "estimated", F.date_sub("filing_date", 30))
    )
    return both.withColumn("method", method).withColumn("period_end", value).drop(
        "near", "prior", "year_ago"
    )


def infer_fiscal_period(filings: DataFrame, subs: DataFrame) -> DataFrame:
    """Fiscal period of 8-K filings (cik, filing_date, fye_month) from the last periodic filing:
    the same period when both were filed within 60 days, else the next one."""
    periodic = subs.filter(F.col("form").isin(*PERIODIC))
    prior = asof_previous(
        filings, periodic, ["cik"], "filing_date", "report_date",
        F.struct(F.col("report_date").alias("end"), F.col("filing_date").alias("filed"), "form"),
        F.col("pos"), "prior",
    )
    fy, q = fiscal.fiscal_period(F.col("prior.end"), F.col("fye_month"))
    same = F.abs(F.datediff("filing_date", "prior.filed")) <= 60
    known = F.col("prior").isNotNull() & F.col("fye_month").isNotNull()
    return prior.withColumns({
        "fiscal_year": F.when(known & same, fy).when(known & (q < 4), fy).when(known, fy + 1),
        "quarter": F.when(known & same, q).when(known & (q < 4), q + 1).when(known, F.lit(1)),
        "period_type": F.when(known & same & (F.col("prior.form") == "10-K"), "annual").when(
            known, "quarterly"),
    }).drop("prior")


def next_filing(last_stored: DataFrame, subs: DataFrame) -> DataFrame:
    """Is the next earnings 8-K there? Companies (cik, last_end) against their filing lists.

    The newest dated Item 2.02 8-K counts when its date reaches the expected next period end
    less 30 days.
    """
    dated = subs.filter("form = '8-K' and report_date is not null")
    newest = dated.groupBy("cik").agg(
        F.min_by(F.struct("report_date", "accession", "primary_doc"),
                 F.when(F.col("items").contains("2.02"), F.col("pos"))).alias("e"),
        F.min_by("report_date", "pos").alias("any_date"),
    )
    threshold = F.date_sub(fiscal.expected_next_end(F.col("last_end")), 30)
    out = last_stored.join(newest, "cik", "left")
    available = F.coalesce(F.col("e.report_date") >= threshold, F.lit(False))
    return out.select(
        *last_stored.columns, available.alias("available"),
        F.when(available, F.col("e.report_date")).alias("sec_report_date"),
        F.when(available, F.col("e.accession")).alias("accession"),
        F.coalesce("e.report_date", "any_date").alias("latest_report_date"),
    )
