"""Looking for concepts without a value in the text of their filing.

The text is read once into a positional index of the words that occur in any label looked for: word, number of the
word, place, line. Labels meet it by equi join on (filing, word); a label stands where its words follow each other, that is
where word number less offset agrees for all of them. Only the windows around these places go back to the text, gathered
per filing, so the text is not copied for each concept.

A label means whole words. A label "Parent, Child" that the text does not have as a whole is looked for as its child
within ``CHILD_REACH`` characters behind its parent: the child's words in a row, else the line with the most of its longer
words, if the window has at least half of them. Filings without a text and concepts without words give nothing.
"""
from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import patterns as P
from ..session import staged
from . import concepts as C

_WORD = re.compile(r"[^\W_]+(?:[.'’&/-][^\W_]+)*")
WORD = r"[\p{L}\p{N}]+(?:[.'’&/-][\p{L}\p{N}]+)*"
CHILD_REACH = 600
BEFORE, BEHIND = 200, 400


def clean_text(text: Column) -> Column:
    """Lower case, one blank for blanks, marks and references; line feeds stay."""
    bare = F.translate(text, " ​", "  ")
    for pattern in (r"&#\d+;", r"<[^<>]*>", r"[^\S\n]+"):
        bare = F.regexp_replace(bare, pattern, " ")
    return F.lower(bare)


def words_of(label: Column) -> Column:
    return F.regexp_extract_all(F.lower(label), F.lit(WORD), F.lit(0))


def _places(text: str, wanted: set[str]) -> Iterator[dict]:
    """Places of the wanted words of one text."""
    line, at = 0, 0
    for no, m in enumerate(_WORD.finditer(text)):
        if m.group() in wanted:
            line += text.count("\n", at, m.start())
            at = m.start()
            yield {"word": m.group(), "no": no, "at": at, "end": m.end(), "line": line}


def word_index(texts: DataFrame, words: DataFrame, filing: str = "filing_id") -> DataFrame:
    """(filing, word, no, at, end, line) of the ``words`` (filing, word) in the cleaned ``texts`` (filing, body)."""
    @F.arrow_udf(returnType="array<struct<word:string,no:int,at:int,end:int,line:int>>")
    def postings(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("word", pa.string()), *((n, pa.int32()) for n in ("no", "at", "end", "line"))]))
        for bodies, wanted in batches:
            yield pa.array([list(_places(t or "", set(w or ()))) for t, w in zip(bodies.to_pylist(), wanted.to_pylist())], kind)

    wanted = words.groupBy(filing).agg(F.collect_set("word").alias("wanted"))
    found = texts.join(wanted, filing).select(filing, postings.asNondeterministic()("body", "wanted").alias("p"))
    return found.select(filing, F.inline("p"))


def occurrences(labels: DataFrame, index: DataFrame, filing: str = "filing_id") -> DataFrame:
    """(filing, concept_id, part, at, end): where the ``words`` of ``labels`` (filing, concept_id, part, words) stand in a row
    and on one line."""
    each = labels.select(filing, "concept_id", "part", F.size("words").alias("n"), F.posexplode("words").alias("offset", "word"))
    met = each.join(index, [filing, "word"]).withColumn("start", F.col("no") - F.col("offset"))
    return met.groupBy(filing, "concept_id", "part", "start", "n", "line").agg(
        F.count(F.lit(1)).alias("hit"), F.min("at").alias("at"), F.max("end").alias("end")).filter("hit = n").select(
        filing, "concept_id", "part", "at", "end")


def _below_parents(split: DataFrame, found: DataFrame, index: DataFrame, filing: str) -> DataFrame:
    """(filing, concept_id, how, at, end) of a child behind the first parent that has it: 1 in a row, 2 by its words."""
    parent = found.filter("part = 'parent'").select(filing, "concept_id", F.col("at").alias("p_at"), F.col("end").alias("p_end"))
    reach = (F.col("at") >= F.col("p_end")) & (F.col("end") <= F.col("p_at") + CHILD_REACH)
    exact = parent.join(found.filter("part = 'child'").drop("part"), [filing, "concept_id"]).filter(reach).select(
        filing, "concept_id", "p_at", F.lit(1).alias("how"), "at", "end")
    long = F.array_distinct(F.filter("child", lambda w: F.length(w) > 3))
    words = split.select(filing, "concept_id", F.size(long).alias("n"), F.explode(long).alias("word"))
    near = words.join(index, [filing, "word"]).join(parent, [filing, "concept_id"]).filter(reach)
    by_line = near.groupBy(filing, "concept_id", "p_at", "n", "line").agg(
        F.collect_set("word").alias("ws"), F.min("at").alias("at"), F.max("end").alias("end"))
    partial = by_line.groupBy(filing, "concept_id", "p_at", "n").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("ws")))).alias("hit"),
        F.max(F.struct(F.size("ws").alias("k"), (-F.col("line")).alias("l"), "at", "end")).alias("best")).filter("hit >= n * 0.5").select(
        filing, "concept_id", "p_at", F.lit(2).alias("how"), "best.at", "best.end")
    return exact.unionByName(partial).groupBy(filing, "concept_id").agg(
        F.min(F.struct("p_at", "how", "at", "end")).alias("x")).select(filing, "concept_id", "x.how", "x.at", "x.end")


def _numbers(tail: Column, line_start: Column) -> Column:
    """Numbers behind a label: at the start of a line a whole run of them, else the next one with its fraction."""
    run = F.regexp_extract_all(F.regexp_extract(tail, r"^\D*?((?:\$?[\s|]*\d[\d,]*[\s|]*)+)", 1), F.lit(r"\d[\d,]*"), F.lit(0))
    single = F.regexp_extract(tail, r"^\D*?(\d[\d,]*(?:\.\d+)?)", 1)
    one = F.when(single != "", F.array(single)).otherwise(F.array().cast("array<string>"))
    return F.when(line_start & (F.size(run) > 0), run).otherwise(one)


def search(missing: DataFrame, texts: DataFrame, filing: str = "filing_id") -> DataFrame:
    """(filing, concept_id, value, n_values, how) of the ``missing`` concepts (filing, concept_id, label, …) that the ``texts``
    (filing, raw_text) give a value for; how: 0 the label, 1 its child behind the parent, 2 most of the child's words.

    Of several places a line's start goes first, then the first one. Behind it the last of the numbers in a row counts.
    A value outside [1e3, 1e14], a lone number that reads as a year, and a plain label in a balance sheet are none.
    """
    want = C.scan_candidates(missing).select(filing, "concept_id", "label", words_of(F.col("label")).alias("words")).filter("size(words) > 0")
    halves = F.split("label", ",", 2)
    split = want.filter(F.col("label").contains(",")).select(
        filing, "concept_id", words_of(halves[0]).alias("parent"), words_of(halves[1]).alias("child")).filter("size(parent) > 0 and size(child) > 0")
    bodies = staged(texts.filter("raw_text is not null").select(filing, clean_text(F.col("raw_text")).alias("body")), "bodies")
    index = staged(word_index(bodies, want.select(filing, F.explode("words").alias("word")), filing), "word_index")
    part = lambda df, name: df.select(filing, "concept_id", F.lit(name).alias("part"), F.col(name).alias("words"))
    labels = want.select(filing, "concept_id", F.lit("whole").alias("part"), "words").unionByName(part(split, "parent")).unionByName(part(split, "child"))
    found = staged(occurrences(labels, index, filing), "occurrences")

    whole = found.filter("part = 'whole'").select(filing, "concept_id", F.lit(0).alias("how"), "at", "end")
    below = _below_parents(split, found, index, filing).join(whole.select(filing, "concept_id").distinct(), [filing, "concept_id"], "left_anti")
    places = whole.unionByName(below).join(want.select(filing, "concept_id", "label"), [filing, "concept_id"])
    per_filing = places.groupBy(filing).agg(F.collect_list(F.struct("concept_id", "label", "how", "at", "end")).alias("places"))
    body = F.col("body")

    def window(p: Column) -> Column:
        start = F.greatest(p["at"] - BEFORE, F.lit(0))
        before = F.substring(body, start + 1, p["at"] - start)
        return F.struct(
            p["concept_id"].alias("concept_id"), p["label"].alias("label"), p["how"].alias("how"), p["at"].alias("at"), before.alias("before"),
            F.substring(body, p["at"] + 1, F.lit(BEHIND)).alias("around"), F.substring(body, p["end"] + 1, F.lit(BEHIND)).alias("tail"))

    windows = bodies.join(per_filing, filing).select(filing, F.inline(F.transform("places", window)))
    line_start = F.trim(F.substring_index("before", "\n", -1)) == ""
    read = windows.withColumn("numbers", _numbers(F.col("tail"), line_start)).filter("size(numbers) > 0")
    value = F.regexp_replace(F.element_at("numbers", -1), ",", "").cast("double")
    guarded = (F.col("how") == 0) & C.balance_sheet_context(F.col("before"), F.concat_ws(" ", "before", "around"), F.col("label"))
    first = read.groupBy(filing, "concept_id").agg(F.min(F.struct(
        (~line_start).alias("inside"), "at", "how", value.alias("value"), F.size("numbers").alias("n_values"), guarded.alias("guarded"))).alias("x"))
    year = (F.col("n_values") == 1) & F.col("value").between(*P.YEAR_RANGE)
    return first.select(filing, "concept_id", "x.value", "x.n_values", "x.how", "x.guarded").filter(
        F.col("value").between(*P.TEXT_VALUE_RANGE) & ~year & ~F.col("guarded")).drop("guarded")
