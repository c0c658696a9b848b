"""License scan by ordered signature rules, in DataFrame functions only.

A text's words (letters, digits and non-ASCII, A-Z lowered) are joined by single spaces. Rules are tried in the order of
`license_signatures`, each only where its keyword occurs, and only in texts that hold one of the words that a rule can't
do without. All matches become spans. Overlaps are settled from left to right: a span inside a kept one goes; of two
that overlap in part, the one of the stronger priority stays, and both stay if neither is stronger.

Null and empty texts have no words and no spans. Equal spans are settled by priority, then confidence, then label.
Repeated rows are scanned alike. Nothing is shuffled, and spans stay in their document's row; a column with the result's
name gives way to it.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from statement_spark.llm.common import ALNUM_SEPARATORS, boxed, lower_ascii, unboxed
from statement_spark.llm.license_signatures import needed_word, signatures

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# The base phrases and their labels.
BASE_LABELS = {
    "gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit",
}
BASE = r"(?<![^ ])(?:" + "|".join(BASE_LABELS) + r")(?![^ ])"
SPAN = "struct<start:int,stop:int,priority:int,label:string,confidence:double>"
KEPT = f"array<{SPAN}>"


def rules(table: list[tuple[str, int, str, float, str]]) -> Column:
    """The signature table as one literal array."""
    return F.array(*[
        F.struct(F.lit(label).alias("label"), F.lit(priority).alias("priority"), F.lit(keyword).alias("keyword"),
                 F.lit(confidence).alias("confidence"), F.lit(pattern).alias("pattern"))
        for label, priority, keyword, confidence, pattern in table
    ])


def _spans(words: Column, rule: Column) -> Column:
    """Where a rule's pattern matches: the stretches between matches give the offsets."""
    found = F.regexp_extract_all(words, rule["pattern"], F.lit(0))
    between = F.split(words, rule["pattern"], -1)
    start = F.struct(F.lit(0).alias("at"), F.array().cast(KEPT).alias("spans"))

    def step(state: Column, pair: Column) -> Column:
        begin = state["at"] + F.char_length(pair["gap"])
        stop = begin + F.char_length(pair["hit"])
        span = F.struct(begin.alias("start"), stop.alias("stop"), rule["priority"].alias("priority"), rule["label"].alias("label"),
                        rule["confidence"].alias("confidence")).cast(SPAN)
        return F.struct(stop.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    pairs = F.zip_with(F.slice(between, 1, F.size(found)), found, lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit")))
    return F.aggregate(pairs, start, step, lambda state: state["spans"])


def _settled(spans: Column) -> Column:
    """Spans left after containment and priority, from left to right: of overlapping spans the one with the stronger (lower)
    priority, whether or not it lies inside the other; of equal ones the containing one."""
    ordered = F.transform(
        F.array_sort(F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), (-s["stop"]).alias("back"), s["priority"].alias("priority"),
            (-s["confidence"]).alias("doubt"), s["label"].alias("label")))),
        lambda s: F.struct(s["start"], (-s["back"]).alias("stop"), s["priority"], s["label"], (-s["doubt"]).alias("confidence")).cast(SPAN))
    none = F.struct(F.array().cast(KEPT).alias("kept"), F.lit(None).cast(SPAN).alias("last"))

    def flushed(state: Column) -> Column:
        return F.when(state["last"].isNull(), state["kept"]).otherwise(F.concat(state["kept"], F.array(state["last"])))

    def step(state: Column, span: Column) -> Column:
        last = state["last"]
        return (
            F.when(last.isNotNull() & (span["stop"] <= last["stop"]) & (span["priority"] >= last["priority"]), state)
            .when(last.isNotNull() & (span["start"] < last["stop"]) & (span["priority"] > last["priority"]), state)
            .when(last.isNotNull() & (span["start"] < last["stop"]) & (span["priority"] < last["priority"]),
                  F.struct(state["kept"].alias("kept"), span.alias("last")))
            .otherwise(F.struct(flushed(state).alias("kept"), span.alias("last")))
        )

    return F.aggregate(ordered, none, step, flushed)


def scan(docs: DataFrame, text: str = "text", out: str = "licenses",
         table: list[tuple[str, int, str, float, str]] | None = None) -> DataFrame:
    """`docs` with a struct column `out`: n_words, base (places of base phrases), spans in the normalised text, labels
    and score, the greatest confidence among the kept spans (0 without any)."""
    table = signatures() if table is None else table
    needed = sorted({needed_word(pattern, keyword) for _, _, keyword, _, pattern in table} | {"licen", "cc"})
    lowered = boxed(docs, _low=lower_ascii(F.coalesce(F.col(text), F.lit(""))))
    may = reduce(lambda a, b: a | b, [F.contains(F.col("_low"), F.lit(word)) for word in needed])
    joined = lowered.withColumn("_words", F.when(may, F.trim(F.regexp_replace(F.col("_low"), ALNUM_SEPARATORS, " "))))
    words = F.col("_words")
    tried = F.filter(rules(table), lambda rule: F.contains(words, rule["keyword"]))
    spans = F.when(words.isNotNull(), F.flatten(F.transform(tried, lambda rule: _spans(words, rule))))
    counted = (
        joined.withColumn("_n", F.regexp_count(F.col("_low"), F.lit(WORD)).cast("bigint"))
        .withColumn("_hits", F.when(words.rlike(BASE), F.regexp_extract_all(words, F.lit(BASE), F.lit(0))))
        .withColumn("_spans", spans)
        .withColumn("_kept", F.when(F.size("_spans") > 0, _settled(F.col("_spans"))))
    )
    hits, kept, n_words = F.col("_hits"), F.col("_kept"), F.col("_n")
    gaps = F.split(words, BASE, -1)

    def blanks(part: Column) -> Column:
        return (F.char_length(part) - F.char_length(F.replace(part, F.lit(" "), F.lit("")))).cast("bigint")

    named = F.create_map(*[F.lit(x) for pair in BASE_LABELS.items() for x in pair])
    base_labels = F.array_sort(F.array_distinct(F.transform(F.coalesce(hits, F.array().cast("array<string>")), lambda hit: named[hit])))
    own = F.coalesce(F.transform(kept, lambda s: s["label"]), F.array().cast("array<string>"))
    result = F.struct(
        n_words.alias("n_words"), F.when(hits.isNull(), 0).otherwise(F.size(hits)).cast("bigint").alias("n_base"),
        F.when(hits.isNotNull(), blanks(F.element_at(gaps, 1))).alias("first_word"),
        F.when(hits.isNotNull(), n_words - blanks(F.element_at(gaps, -1)) - blanks(F.element_at(hits, -1)) - 1).alias("last_word"),
        base_labels.alias("base_labels"),
        F.array_sort(F.array_distinct(F.concat(base_labels, own))).alias("labels"),
        F.coalesce(F.array_max(F.transform(kept, lambda s: s["confidence"])), F.lit(0.0)).alias("score"),
        F.coalesce(kept, F.array().cast(KEPT)).alias("spans"), words.alias("normalised"),
    )
    return unboxed(counted, docs.columns, **{out: result})
