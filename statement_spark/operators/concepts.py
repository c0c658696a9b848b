"""Company concept lists and the mapping of metrics to concepts."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import patterns as P, roles, text as T
from ..session import matched


def is_calculated() -> Column:
    return F.col("concept").rlike("(?i)^system:") | (F.lower(F.col("calculated").cast("string")) == "true")


def is_visible() -> Column:
    """Active, and either neither abstract nor hidden, or calculated. A missing flag is not set."""
    plain = ~F.col("abstract").eqNullSafe(True) & ~F.col("hide").eqNullSafe(True)
    return ~F.col("active").eqNullSafe(False) & (plain | F.coalesce(is_calculated(), F.lit(False)))


def statement_concepts(raw: DataFrame, statement_types: tuple[str, ...] = ("income_statement",)) -> DataFrame:
    """Visible concepts with clean, unique labels and a stable taxonomy key, in path order.

    A member qualifier is added only where two rows of a statement share a base label; of equal
    final labels the first in path order stays. Both steps are aggregates joined back by key.
    """
    scope = ["cik", "period_type", "statement_type"]
    tag = T.member_tag(F.col("label"))
    parsed = raw.filter(F.col("statement_type").isin(*statement_types) & is_visible()).select(
        *scope, "concept_id", F.coalesce("concept", F.lit("")).alias("concept"),
        F.coalesce("path", F.lit("")).alias("path"),
        T.label_head(F.col("label")).alias("head"), T.label_member(F.col("label")).alias("member"),
        T.taxonomy_key(F.col("concept"), tag).alias("taxonomy_key"),
    ).filter("head is not null").withColumn("base", F.lower("head"))
    shared = parsed.groupBy(*scope, "base").agg((F.count(F.lit(1)) > 1).alias("shared"))
    final = F.when(
        F.col("shared") & (F.col("member") != ""),
        F.concat("head", F.lit(" ("), "member", F.lit(")")),
    ).otherwise(F.col("head"))
    labelled = parsed.join(shared, [*scope, "base"]).withColumn("label", final)
    cols = ["concept_id", "concept", "label", "path", "taxonomy_key"]
    first = labelled.groupBy(*scope, F.lower("label").alias("final_key")).agg(
        F.min_by(F.struct(*cols), F.struct("path", "concept_id")).alias("c")
    )
    return first.select(*scope, "c.*").withColumn("concept_ord", F.struct("path", "concept_id"))


def calculated_concepts(raw: DataFrame, statement_types: tuple[str, ...] = ("income_statement",)) -> DataFrame:
    """Visible rows that are calculated rather than reported."""
    plain = (
        ~F.col("abstract").eqNullSafe(True) & ~F.col("hide").eqNullSafe(True)
        & ~F.col("active").eqNullSafe(False)
    )
    return raw.filter(
        F.col("statement_type").isin(*statement_types) & plain & F.coalesce(is_calculated(), F.lit(False))
    ).select("cik", "period_type", "statement_type", "concept_id", "concept", "path",
             T.label_head(F.col("label")).alias("label")).filter("label is not null")


def with_roles(concepts: DataFrame, answers: DataFrame | None = None) -> DataFrame:
    """Add ``role``: taxonomy key, then label patterns, then a model answer with a known role.

    ``answers``: (cik, label, role).
    """
    known = concepts.withColumn("role", roles.role_of(F.col("label"), F.col("taxonomy_key")))
    if answers is None:
        return known
    legal = answers.filter(F.col("role").isin(*P.ROLES)).select(
        "cik", "label", F.col("role").alias("answered")
    ).dropDuplicates(["cik", "label"])
    return known.join(legal, ["cik", "label"], "left").withColumn(
        "role", F.coalesce("role", "answered")
    ).drop("answered")


def role_candidates(concepts: DataFrame) -> DataFrame:
    """Concepts a model may be asked a role for: not dimensional, no role yet."""
    return concepts.filter(~F.col("taxonomy_key").contains("|") & F.col("role").isNull())


def parent_path(path: Column) -> Column:
    return F.nullif(F.regexp_extract(path, r"^(.+)\.[^.]+$", 1), F.lit(""))


def children(concepts: DataFrame, by: str = "cik") -> DataFrame:
    """(by, parent_id, child_id): concepts exactly one path level below another; an equi join."""
    parents = concepts.filter("path <> ''").select(
        by, F.col("concept_id").alias("parent_id"), F.col("path").alias("up")
    )
    kids = concepts.select(by, F.col("concept_id").alias("child_id"), parent_path(F.col("path")).alias("up"))
    return kids.filter("up is not null").join(matched(parents), [by, "up"]).select(by, "parent_id", "child_id")


def prompt_lines(concepts: DataFrame, by: str = "cik") -> DataFrame:
    """Lines of the concept list: quoted label, parent's label, key in brackets."""
    parents = concepts.filter("path <> '' and label <> ''").groupBy(by, F.col("path").alias("up")).agg(
        F.min_by("label", F.struct(~F.col("taxonomy_key").rlike("(?i)" + P.STANDARD_PREFIX), "concept_ord"))
        .alias("parent")
    )
    hint = F.coalesce(F.nullif(F.trim("taxonomy_key"), F.lit("")), F.nullif(F.trim("concept"), F.lit("")))
    line = F.concat(
        F.lit('  • "'), "label", F.lit('"'),
        F.coalesce(F.concat(F.lit(" -- "), "parent"), F.lit("")),
        F.coalesce(F.concat(F.lit("  ["), hint, F.lit("]")), F.lit("")),
    )
    return concepts.filter("label <> ''").withColumn("up", parent_path(F.col("path"))).join(
        parents, [by, "up"], "left"
    ).select(by, "concept_id", "concept_ord", line.alias("line"))


def concept_list(lines: DataFrame, by: str = "cik") -> DataFrame:
    """The list as one text per company: a company's dictionary, one line per concept."""
    return lines.groupBy(by).agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("concept_ord", "line"))), lambda x: x["line"]),
            "\n",
        ).alias("concept_list")
    )


def map_metrics(metrics: DataFrame, concepts: DataFrame, filing: str = "filing_id") -> DataFrame:
    """(filing, concept_id, key, value, tier): tier 0 taxonomy key (bare or in brackets),
    tier 1 exact label, tier 2 normalised label.

    ``metrics`` and ``concepts`` share the column ``cik``. A metric takes its lowest tier, of
    equal labels the last concept counts, and a concept takes the last metric mapped to it.
    The three look-ups are one equi join on (cik, tier, key form).
    """
    key = F.coalesce(F.nullif("taxonomy_key", F.lit("")), F.nullif("concept", F.lit("")))
    forms = F.array(
        F.struct(F.lit(0).alias("tier"), key.alias("form")),
        F.struct(F.lit(1).alias("tier"), F.col("label").alias("form")),
        F.struct(F.lit(2).alias("tier"), T.norm_label(F.col("label")).alias("form")),
    )
    lookup = concepts.select("cik", "concept_id", "concept_ord", F.inline(forms)).filter(
        "form is not null"
    ).groupBy("cik", "tier", "form").agg(F.max_by("concept_id", "concept_ord").alias("concept_id"))
    wanted = F.array(
        F.struct(F.lit(0).alias("tier"),
                 F.regexp_replace("key", r"^\[(.*)\]$", "$1").alias("form")),
        F.struct(F.lit(1).alias("tier"), F.col("key").alias("form")),
        F.struct(F.lit(2).alias("tier"), T.norm_label(F.col("key")).alias("form")),
    )
    asked = metrics.filter("num_value is not null").select(
        filing, "cik", "key", "key_ord", "num_value", F.inline(wanted)
    )
    hits = asked.join(matched(lookup), ["cik", "tier", "form"])
    per_metric = hits.groupBy(filing, "key").agg(
        F.min_by(F.struct("concept_id", "num_value", "key_ord", "tier"), "tier").alias("m")
    )
    return per_metric.groupBy(filing, F.col("m.concept_id").alias("concept_id")).agg(
        F.max_by(F.struct("key", F.col("m.num_value").alias("value"), F.col("m.tier").alias("tier"),
                          F.col("m.key_ord").alias("key_ord")), F.col("m.key_ord")).alias("x")
    ).select(filing, "concept_id", "x.*")


def unmapped(concepts: DataFrame, mapped: DataFrame, filing: str = "filing_id") -> DataFrame:
    """Concepts of each filing that have no value; ``is_segment`` marks dimensional ones."""
    return concepts.join(matched(mapped.select(filing, "concept_id")), [filing, "concept_id"], "left_anti").withColumn(
        "is_segment", F.coalesce(F.col("taxonomy_key").contains("|"), F.lit(False))
    )


def semantic_candidates(missing: DataFrame) -> DataFrame:
    """Unmapped concepts a model may still match: no comprehensive income, not dimensional."""
    return missing.filter(~F.col("is_segment") & ~F.col("label").rlike(P.ci(P.OCI_LABEL)))


def apply_semantic_map(mapped: DataFrame, answers: DataFrame, metrics: DataFrame,
                       asked: DataFrame, filing: str = "filing_id") -> DataFrame:
    """Add the matches of model answers (filing, resp_ord, concept_id, key).

    Only asked concepts and supplied keys are legal, and a key is used once: the first wins.
    """
    legal = answers.join(matched(asked.select(filing, "concept_id")), [filing, "concept_id"], "left_semi").join(
        matched(metrics.filter("num_value is not null").select(filing, "key", "num_value", "key_ord")), [filing, "key"]
    )
    once = legal.groupBy(filing, "key").agg(
        F.min_by(F.struct("concept_id", "num_value", "key_ord"), "resp_ord").alias("m")
    ).select(
        filing, "m.concept_id", "key", F.col("m.num_value").alias("value"),
        F.lit(3).alias("tier"), "m.key_ord",
    )
    new = once.join(matched(mapped.select(filing, "concept_id")), [filing, "concept_id"], "left_anti")
    return mapped.unionByName(new)


def scan_candidates(missing: DataFrame) -> DataFrame:
    """Unmapped concepts worth looking for in table rows."""
    label = F.lower("label")
    return missing.filter(
        ~label.contains("[member]") & ~F.col("is_segment") & ~label.contains("comprehensive income")
        & (F.length("label") > 3)
    )


def scan_rows(missing: DataFrame, rows: DataFrame, filing: str = "filing_id") -> DataFrame:
    """Find missing concepts among statement rows (filing, table_idx, row_idx, key, value).

    A label matches a row of the same normalised text. A label "Parent, Child" also matches a
    row below a row named like the parent: by its full text, else by at least half of the child
    words longer than three letters. Words meet by equi join, so rows that share no word never
    pair. Values outside [1e3, 1e14] do not count, nor does a lone number that reads as a year
    (``n_values``, where given, tells how many a row has).
    """
    lone = F.col("n_values") == 1 if "n_values" in rows.columns else F.lit(False)
    year = lone & F.col("value").between(1900, 2100)
    plausible = rows.filter(F.abs("value").between(1e3, 1e14) & ~year).withColumn("nk", T.norm_label(F.col("key")))
    want = scan_candidates(missing).select(filing, "concept_id", T.norm_label(F.col("label")).alias("nl"))
    place = F.struct("table_idx", "row_idx")
    direct = want.join(plausible, (want[filing] == plausible[filing]) & (want["nl"] == plausible["nk"])).select(
        want[filing], "concept_id", F.lit(0).alias("how"), place.alias("place"), "value"
    )
    split = want.filter(F.col("nl").contains(",")).select(
        filing, "concept_id", F.trim(F.split("nl", ",", 2)[0]).alias("parent"),
        F.trim(F.split("nl", ",", 2)[1]).alias("child"),
    )
    under = plausible.filter("parent is not null").select(
        filing, T.norm_label(F.col("parent")).alias("parent"), "nk", place.alias("place"), "value"
    )
    words = lambda c: F.array_distinct(F.filter(F.split(c, r"\s+"), lambda w: F.length(w) > 3))
    exact = split.join(under, [filing, "parent"]).filter("nk = child").select(
        filing, "concept_id", F.lit(1).alias("how"), "place", "value"
    )
    child_words = split.select(filing, "parent", "concept_id", F.size(words("child")).alias("n"),
                               F.explode(words("child")).alias("w"))
    row_words = under.select(filing, "parent", "place", "value", F.explode(words("nk")).alias("w"))
    partial = child_words.join(row_words, [filing, "parent", "w"]).groupBy(
        filing, "concept_id", "place", "value", "n"
    ).agg(F.count(F.lit(1)).alias("hit")).filter("hit >= n * 0.5").select(
        filing, "concept_id", F.lit(2).alias("how"), "place", "value"
    )
    hits = direct.unionByName(exact).unionByName(partial)
    return hits.groupBy(filing, "concept_id").agg(
        F.min_by("value", F.struct("how", "place")).alias("value")
    )


def parent_rows(rows: DataFrame, filing: str = "filing_id") -> DataFrame:
    """Add ``parent``: the last label without a value above a row of the same table.

    One table is one page's cells, so the ordered pass is over a bounded group.
    """
    w = Window.partitionBy(filing, "table_idx").orderBy("row_idx")
    return rows.withColumn(
        "parent", F.last(F.when(F.col("value").isNull(), F.col("key")), ignorenulls=True).over(w)
    )


def balance_sheet_context(before: Column, around: Column, label: Column) -> Column:
    """True where a text match lies in a balance sheet rather than an income statement."""
    headed = before.rlike(P.ci(P.BALANCE_HEADER))
    totals = around.rlike(P.ci(P.BALANCE_TOTAL)) & ~label.rlike(P.ci(P.INCOME_WORD))
    return headed | totals
