"""Fiscal calendar on Columns."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import patterns as P


def period_end_date(text: Column) -> Column:
    """DATE of the first ``Month D, YYYY`` in a text; null when there is none or it is invalid."""
    pattern = P.ci(P.MONTH_DATE)
    name = F.lower(F.substring(F.regexp_extract(text, pattern, 1), 1, 3))
    month = ((F.instr(F.lit(P.MONTH_STARTS), name) + 2) / 3).cast("int").cast("string")
    day = F.concat_ws(
        "-", F.regexp_extract(text, pattern, 3), month, F.regexp_extract(text, pattern, 2)
    )
    return day.try_cast("date")


def _lookup(table: dict, key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key)


def duration_count(text: Column) -> Column:
    word = F.lower(F.regexp_extract(text, P.ci(P.DURATION), 1))
    return F.coalesce(word.try_cast("int"), _lookup(P.NUMBER_WORDS, word))


def duration_unit(text: Column) -> Column:
    first = F.lower(F.substring(F.regexp_extract(text, P.ci(P.DURATION), 2), 1, 1))
    return _lookup({"m": "months", "w": "weeks"}, first)


def quarter_in_text(text: Column) -> Column:
    """Quarter a text states: an ordinal first, then a cumulative duration; 3 months says nothing."""
    ordinal = F.lower(F.regexp_extract(text, P.ci(P.ORDINAL_QUARTER), 1))
    digit = F.regexp_extract(text, P.ci(P.ORDINAL_QUARTER), 2).try_cast("int")
    n, unit = duration_count(text), duration_unit(text)
    stated = F.coalesce(digit, _lookup(P.ORDINALS, ordinal))
    by_length = (
        F.when((unit == "weeks") & n.between(25, 27), 2)
        .when((unit == "weeks") & n.between(38, 40), 3)
        .when((unit == "months") & (n == 6), 2)
        .when((unit == "months") & (n == 9), 3)
    )
    return F.coalesce(stated, by_length)


def period_type_in_text(text: Column) -> Column:
    return F.when(text.rlike(P.ci(P.ANNUAL_PERIOD)), "annual").otherwise("quarterly")


def fye_month(code: Column) -> Column:
    """Month of an ``MMDD`` code; 12 when it is absent or no month."""
    m = F.substring(code, 1, 2).try_cast("int")
    return F.when(m.between(1, 12), m).otherwise(F.lit(12))


def fiscal_year(end: Column, fye: Column) -> Column:
    return F.year(end) + F.when(F.month(end) > fye, 1).otherwise(0)


def fiscal_quarter(end: Column, fye: Column) -> Column:
    start = fye % 12 + 1
    return (F.floor(F.pmod(F.month(end) - start, F.lit(12)) / 3) + 1).cast("int")


def fiscal_period(end: Column, fye: Column, text: Column | None = None) -> tuple[Column, Column]:
    """(fiscal year, quarter). A date in the text wins, and so does a quarter it states."""
    if text is None:
        return fiscal_year(end, fye), fiscal_quarter(end, fye)
    d = F.coalesce(period_end_date(text), end)
    return fiscal_year(d, fye), F.coalesce(quarter_in_text(text), fiscal_quarter(d, fye))


def period_start(text: Column, end: Column) -> Column:
    n, unit = duration_count(text), duration_unit(text)
    return F.when(unit == "weeks", F.date_add(end, 1 - n * 7)).when(
        unit == "months", F.trunc(F.add_months(end, 1 - n), "MM")
    )


def nominal_year_end(year: Column, month: Column, day: Column) -> Column:
    """Nominal fiscal year end of a year, the day clamped to the month."""
    first = F.make_date(year, month, F.lit(1))
    return F.least(F.date_add(first, day - 1), F.last_day(first))


def date_period_type(end: Column, fye: Column, code: Column) -> Column:
    """Annual when the end lies in the year-end month or within 7 days of a nominal year end."""
    day = F.when(F.length(code) >= 4, F.substring(code, 3, 2).try_cast("int"))
    near = F.exists(
        F.array(F.year(end) - 1, F.year(end), F.year(end) + 1),
        lambda y: F.abs(F.datediff(end, nominal_year_end(y, fye, day))) <= 7,
    )
    return (
        F.when(end.isNull() | fye.isNull(), "quarterly")
        .when(F.month(end) == fye, "annual")
        .when((day > 0) & near, "annual")
        .otherwise("quarterly")
    )


def next_period_type(stored_type: Column, stored_quarter: Column, stored_end: Column,
                     current_end: Column) -> Column:
    """Cadence Q1, Q2, Q3, annual. A filing that is not newer keeps the stored type."""
    return (
        F.when(stored_type.isNull(), F.lit(None).cast("string"))
        .when(current_end <= stored_end, stored_type)
        .when((stored_type == "quarterly") & (stored_quarter == 3), "annual")
        .otherwise("quarterly")
    )


def final_period_type(cadence: Column, by_date: Column) -> Column:
    return (
        F.when(cadence.isNull(), by_date).when(by_date == "annual", "annual").otherwise(cadence)
    )


def save_route(override: Column, end: Column, fye: Column, text: Column) -> Column:
    """Period type used when saving: override, then year-end month, then the words."""
    return (
        F.when(override.isin("annual", "quarterly"), override)
        .when(F.month(end) == fye, "annual")
        .otherwise(period_type_in_text(text))
    )


def form_type(period_type: Column) -> Column:
    return F.when(period_type == "annual", "10-K").otherwise("10-Q")


def save_end_date(text: Column, report_date: Column) -> Column:
    return F.coalesce(period_end_date(text), report_date)


def expected_next_end(last_end: Column) -> Column:
    """Three months on, day clamped."""
    return F.add_months(last_end, 3)


def year_in_text(text: Column) -> Column:
    return F.regexp_extract(text, P.ci(P.YEAR_IN_TEXT), 1).try_cast("int")


def next_label(period_type: Column, fy: Column, quarter: Column) -> Column:
    """Label of the filing that is due next; a Q4 counts as the closed year."""
    y, q = fy.cast("string"), F.coalesce(quarter, F.lit(0))
    return (
        F.when((period_type == "annual") | (q >= 4),
               F.concat(F.lit("FY"), (fy + 1).cast("string"), F.lit(" Q1 8-K")))
        .when(q == 3, F.concat(F.lit("FY"), y, F.lit(" Annual 8-K")))
        .otherwise(F.concat(F.lit("FY"), y, F.lit(" Q"), (q + 1).cast("string"), F.lit(" 8-K")))
    )


def period_label(period_type: Column, fy: Column, quarter: Column) -> Column:
    y = fy.cast("string")
    return F.when(
        (period_type == "quarterly") & (quarter > 0),
        F.concat(F.lit("FY"), y, F.lit(" Q"), quarter.cast("string")),
    ).otherwise(F.concat(F.lit("FY"), y, F.lit(" Annual")))
