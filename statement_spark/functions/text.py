"""Text operators on Columns: labels, captions, cleaning, signatures."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import patterns as P


def collapse(c: Column) -> Column:
    """White-space runs to one space, ends trimmed."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def norm_label(c: Column) -> Column:
    """Case- and white-space-insensitive form of a label."""
    return F.lower(collapse(c))


# ---- concept labels --------------------------------------------------------------------------

def label_head(raw: Column) -> Column:
    """Text before the first taxonomy reference; null when nothing is left."""
    head = collapse(F.split(raw, P.ci(P.TAXONOMY_PREFIX), 2)[0])
    return F.when(head != "", head)


def label_member(raw: Column) -> Column:
    """Readable member qualifier: ``us-gaap:ProductLineMember`` gives ``Product Line``."""
    token = F.regexp_replace(F.regexp_extract(raw, P.ci(P.MEMBER_TOKEN), 1), "Member$", "")
    return F.trim(F.regexp_replace(token, "(?<!^)(?=[A-Z])", " "))


def member_tag(raw: Column) -> Column:
    return F.regexp_extract(raw, P.ci(P.MEMBER_TAG), 1)


def taxonomy_key(concept: Column, tag: Column) -> Column:
    concept = F.coalesce(concept, F.lit(""))
    return F.when(tag != "", F.concat(concept, F.lit("|"), tag)).otherwise(concept)


# ---- scale captions ----------------------------------------------------------------------------

def _bind(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def one_line(text: Column) -> Column:
    """Horizontal white space to single spaces; line breaks stay."""
    return F.regexp_replace(text, r"(?U)[^\S\n]+", " ")


def _most_frequent(text: Column, template: str) -> Column:
    """Unit named most often by ``template``; ties go to the earliest mention."""
    options = [
        F.struct(
            F.regexp_count(text, F.lit(P.ci(template % unit))).alias("n"),
            (-F.regexp_instr(text, F.lit(P.ci(template % unit)))).alias("early"),
            F.lit(unit).alias("unit"),
        )
        for unit in P.SCALES
    ]
    return F.array_max(F.filter(F.array(*options), lambda o: o["n"] > 0))["unit"]


def dominant_scale(text: Column) -> Column:
    """Scale of a text: captions in parentheses first, headings at a line start otherwise."""
    return F.when(
        text.rlike(r"(?i)thousands|millions|billions"),
        _bind(one_line(text), lambda line: F.coalesce(
            _most_frequent(line, P.CAPTION), _most_frequent(line, P.HEADING))),
    )


def shares_scale(text: Column) -> Column:
    return F.when(
        one_line(text).rlike(P.ci(P.SHARES_IN_THOUSANDS)),
        F.lit("thousands"),
    )


def period_phrase(text: Column) -> Column:
    return F.nullif(F.regexp_extract(one_line(text), P.ci(P.PERIOD_PHRASE), 0), F.lit(""))


def scale_factor(scale: Column) -> Column:
    """1e3, 1e6 or 1e9; 1 for anything else."""
    factors = F.create_map(*[F.lit(x) for u, f in P.SCALES.items() for x in (u, float(f))])
    return F.coalesce(F.try_element_at(factors, F.lower(scale)), F.lit(1.0))


# ---- documents and chunks -----------------------------------------------------------------------

def strip_envelope(html: Column) -> Column:
    """Keep what follows <TEXT> when the page is wrapped in a <DOCUMENT> envelope."""
    body = F.regexp_extract(html, r"(?is)<TEXT>(.*)", 1)
    return F.when(
        F.upper(html).contains("<DOCUMENT>") & html.rlike("(?i)<TEXT>"), collapse_ends(body)
    ).otherwise(html)


def collapse_ends(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def strip_boilerplate(text: Column) -> Column:
    """Cut at the first boilerplate heading in the second half of the text."""
    mid = F.floor(F.length(text) / 2).cast("int")
    at = F.regexp_instr(F.substring(text, mid + 1, F.length(text)), F.lit(P.ci(P.BOILERPLATE)))
    cut = F.regexp_replace(F.substring(text, F.lit(1), mid + at - 1), r"(?U)\s+$", "")
    return F.when(at > 0, cut).otherwise(text)


def clean_chunk(text: Column) -> Column:
    """Entities, invisible characters and empty table cells out, line breaks kept."""
    steps = [
        (r"[\u00a0\u200b\u200e\u200f\u2028]", " "),
        (r"&#\d+;", " "),
        (r"(?i)&nbsp;", " "),
        (r"(?i)&amp;", "&"),
        (r"(?i)&lt;", "<"),
        (r"(?i)&gt;", ">"),
        (r"(?U)\|\s*\|\s*\|", " | "),
        (r"(?U)\|\s*\|", " | "),
        (r"(?U)[^\S\n]+", " "),
        (r"(?mU)^\s+", ""),
        (r"(?mU)\s+$", ""),
        (r"(?mU)^[\s|]+$", ""),
    ]
    for pattern, to in steps:
        text = F.regexp_replace(text, pattern, to)
    return text


def chunk_section(text: Column) -> Column:
    """Section named by the ``=== LABEL ===`` header of a chunk, else ``unknown``."""
    names = F.create_map(*[F.lit(x) for s, t in P.SECTION_LABELS.items() for x in (t, s)])
    label = F.trim(F.regexp_extract(text, r"(?s)^=== (.*?) ===", 1))
    return F.coalesce(F.try_element_at(names, label), F.lit("unknown"))


def latest_quarter(text: Column) -> Column:
    """struct(n, labels, latest): distinct quarter columns named in a text, latest last."""
    clean = F.regexp_replace(text, r"\u00a0|&#\d+;|(?i)&nbsp;", " ")
    raw = F.regexp_extract_all(clean, F.lit("(" + P.ci(P.QUARTER_COLUMN) + ")"), F.lit(1))
    tight = F.transform(
        raw, lambda s: F.upper(F.regexp_replace(s, r"(?U)[\s\-–—]+|['′]", ""))
    )
    unified = F.array_distinct(
        F.transform(tight, lambda s: F.regexp_replace(s, r"^(\d)(Q)(\d{2})$", "$2$1$3"))
    )
    keyed = F.transform(
        unified,
        lambda s: F.struct(
            F.when(
                F.length(F.regexp_extract(s, r"^Q\d(\d+)", 1)) == 2,
                2000 + F.regexp_extract(s, r"^Q\d(\d+)", 1).try_cast("int"),
            ).otherwise(F.coalesce(F.regexp_extract(s, r"^Q\d(\d+)", 1).try_cast("int"), F.lit(0)))
            .alias("y"),
            F.coalesce(F.regexp_extract(s, r"^Q(\d)", 1).try_cast("int"), F.lit(0)).alias("q"),
            s.alias("label"),
        ),
    )
    ordered = F.transform(F.array_sort(keyed), lambda x: x["label"])
    return F.struct(
        F.size(unified).alias("n"),
        ordered.alias("labels"),
        F.try_element_at(ordered, F.lit(-1)).alias("latest"),
    )


# ---- grounding and signatures ----------------------------------------------------------------------

def grounding_form(text: Column) -> Column:
    return F.lower(collapse(F.regexp_replace(text, r"[|*`]", " ")))


def grounding_numbers(text: Column) -> Column:
    """Number tokens without commas and signs."""
    raw = F.regexp_extract_all(text, F.lit("(" + P.GROUNDING_NUMBER + ")"), F.lit(1))
    bare = F.transform(
        raw, lambda s: F.regexp_replace(F.regexp_replace(s, r"[^\d.]", ""), r"^\.+|\.+$", "")
    )
    return F.filter(bare, lambda s: s.rlike(r"\d"))


def key_section(key: Column) -> Column:
    expr = F.lit(None).cast("string")
    for section, pattern in reversed(P.KEY_SECTION):
        expr = F.when(key.rlike(P.ci(pattern)), F.lit(section)).otherwise(expr)
    return expr


def finding_signature(ftype: Column, keys: Column, metric: Column, message: Column) -> Column:
    subject = F.when(F.size(keys) > 0, F.array_join(F.array_sort(keys), "|")).otherwise(
        F.coalesce(F.nullif(metric, F.lit("")), message, F.lit(""))
    )
    return F.concat(F.coalesce(ftype, F.lit("")), F.lit("::"), subject)


def compact_value(v: Column) -> Column:
    """82.9B, 315M, 24.3K: three significant digits, small numbers as they are."""

    def three_digits(x: Column, suffix: str) -> Column:
        digits = F.when(F.abs(x) >= 100, 0).when(F.abs(x) >= 10, 1).otherwise(2)
        cell = (
            F.when(digits == 0, F.rint(x))
            .when(digits == 1, F.rint(x * 10) / 10)
            .otherwise(F.rint(x * 100) / 100)
        )
        # 999.6 rounds into a fourth digit, which the compact form writes as 1e+03
        text = F.when(F.abs(cell) >= 1000, F.lit("1e+03")).otherwise(
            F.regexp_replace(cell.cast("decimal(20,2)").cast("string"), r"\.?0+$", "")
        )
        text = F.when((F.abs(cell) >= 1000) & (x < 0), F.lit("-1e+03")).otherwise(text)
        return F.concat(text, F.lit(suffix))

    a = F.abs(v)
    plain = F.regexp_replace(v.cast("string"), r"\.0$", "")
    return (
        F.when(a >= 1e9, three_digits(v / 1e9, "B"))
        .when(a >= 1e6, three_digits(v / 1e6, "M"))
        .when(a >= 1e3, three_digits(v / 1e3, "K"))
        .otherwise(plain)
    )
