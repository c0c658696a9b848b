"""Numbers on Columns: cell parsing, scaling, closeness."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import patterns as P

NUMBER_CELL = r"(?U)^[\s$]*-?[\s$]*\(?[\s$]*-?[\s$]*(?:\d[\d,]*(?:\.\d*)?|\.\d+)\s*[BMTKbmtk]?\s*\)?\s*$"


def parse_number(cell: Column) -> Column:
    """Number of a statement cell: ``$``, commas, (negative), and a B/M/T/K suffix.

    One pattern decides whether the cell is a number; the rest is character work.
    """
    bare = F.translate(cell, " $,()-\u00a0\u2009\u202f\t\nBbMmTtKk", "")
    last = F.upper(F.right(F.rtrim(F.translate(cell, ") \u00a0", "")), F.lit(1)))
    factor = (
        F.when(last == "K", 1e3).when(last == "M", 1e6).when(last == "B", 1e9)
        .when(last == "T", 1e12).otherwise(1.0)
    )
    sign = F.when(cell.contains("(") | cell.contains("-"), -1.0).otherwise(1.0)
    return F.when(cell.rlike(NUMBER_CELL), bare.try_cast("double") * factor * sign)


def is_ratio(key: Column) -> Column:
    return key.rlike(P.ci(P.RATIO_KEY))


def is_share_count(key: Column) -> Column:
    return key.rlike(P.ci(P.SHARE_COUNT_KEY))


def dollar_multiplier(reported: Column, prescanned: Column) -> Column:
    """The smaller of two multipliers above 1, else whichever is above 1."""
    return (
        F.when((reported > 1) & (prescanned > 1), F.least(reported, prescanned))
        .when(prescanned > 1, prescanned)
        .when(reported > 1, reported)
        .otherwise(F.lit(1.0))
    )


def scaled(key: Column, value: Column, dollars: Column, shares: Column) -> Column:
    """Apply a table's scale to one number.

    Ratios, per-share amounts and unit counts stay; share counts take their own multiplier;
    a number that scaling would lift past the plausible ceiling is taken as already full.
    """
    share = is_share_count(key)
    cap = F.when(dollars > 1, F.floor(F.lit(P.IMPLAUSIBLE_ABS) / dollars)).otherwise(
        F.lit(P.DEFAULT_RAW_CAP)
    )
    percent_margin = F.lower(key).contains("gross margin") & (F.abs(value) <= 100)
    dollar = ~share & ~is_ratio(key) & (dollars > 1) & (F.abs(value) < cap) & ~percent_margin
    return (
        F.when(share & (shares > 1) & (F.abs(value) < P.SHARE_RAW_CAP), value * shares)
        .when(dollar, value * dollars)
        .otherwise(value)
    )


def close(a: Column, b: Column, tolerance: float = P.CLOSE_TOLERANCE) -> Column:
    return F.abs(a - b) <= tolerance * F.greatest(F.abs(a), F.abs(b))


def drift(reported: Column, computed: Column) -> Column:
    """Relative distance; null when a side is missing or both are 0."""
    base = F.greatest(F.abs(reported), F.abs(computed))
    return F.when(
        reported.isNotNull() & computed.isNotNull() & (base > 0),
        F.abs(reported - computed) / base,
    )
