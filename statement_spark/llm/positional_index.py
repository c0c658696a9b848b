"""Benchmark decontamination by a distributed positional inverted index, in DataFrame functions only.

1. The training frequency of every benchmark term is counted; a window with a term that never occurs can't match.
2. For each window the `rarest` terms are picked. Postings (term, document, position) of the picked terms are written as
   the index; common words have no postings unless a window holds nothing rarer.
3. Postings meet the benchmark's own positions of the term. Taking off the position in the item gives where the item
   would start in the document; lists that agree on this place are intersected, and windows whose picked terms
   all occur there are candidates.
4. Candidates are compared word by word with the document.

`near_matches` intersects the same kind of postings by distance instead: an item's rarest terms within `span` words.

Null and empty texts have no words; documents without words are never contaminated, items without words or without id
match nothing. Repeated rows get the same result each; items with the same id count once. Rows of `docs` keep their columns, of which
one with the result's name gives way to it.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from statement_spark.llm.common import boxed, lower_ascii, unboxed
from statement_spark.session import small, staged

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
RAREST = 3


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """`docs` as `_row`, `_text` and `_key`, which names a row by id and text. Two rows with one key only share candidates,
    and these are compared with each row's own words."""
    return boxed(docs, _key=F.xxhash64(F.col(doc_id), F.col(text)), _text=F.col(text))


def _items(items: DataFrame, item_id: str, text: str) -> DataFrame:
    split = items.select(F.col(item_id).cast("string").alias("item"), words_of(F.col(text)).alias("words"))
    return staged(split.where("item is not null and size(words) > 0").distinct().withColumn("digest", F.xxhash64("words")), "items")


def frequencies(docs: DataFrame, items: DataFrame, text: str) -> DataFrame:
    """(term, n): how often each term of `items` occurs in `docs`; terms that never occur are missing."""
    terms = items.select(F.explode("words").alias("term")).distinct()
    seen = docs.select(F.explode(words_of(F.col(text))).alias("term"))
    return staged(seen.join(small(staged(terms, "terms")), "term").groupBy("term").agg(F.count(F.lit(1)).alias("n")), "frequencies")


def postings(docs: DataFrame, terms: DataFrame, text: str) -> DataFrame:
    """The index: (term, _key, at) for the given terms, written to the shared folder."""
    placed = docs.select("_key", F.posexplode(words_of(F.col(text))).alias("at", "term"))
    return staged(placed.join(small(staged(terms.distinct(), "terms")), "term").distinct(), "postings")


def _probes(items: DataFrame, found: DataFrame, window: int, rarest: int) -> DataFrame:
    """Every window that may occur: item, digest, start, n (its words) and the item positions of its rarest terms."""
    opened = items.select(
        "item", "digest", F.least(F.size("words"), F.lit(window)).alias("n"), "words",
        F.explode(F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0)))).alias("start"))
    terms = opened.select(
        "item", "digest", "start", "n", F.posexplode(F.slice("words", F.col("start") + 1, F.col("n"))).alias("shift", "term"))
    weighed = terms.join(found.withColumnRenamed("n", "times"), "term").groupBy("item", "digest", "start", "n").agg(
        F.array_sort(F.collect_list(F.struct("times", "term", "shift"))).alias("ranked"))
    picked = weighed.where(F.size("ranked") == F.col("n")).select(
        "item", "digest", "start", "n", F.slice("ranked", 1, rarest).alias("picks"))
    return staged(picked, "probes")


def candidates(docs: DataFrame, items: DataFrame, text: str, window: int = WINDOW, rarest: int = RAREST) -> DataFrame:
    """(_key, options): per document the places where windows may stand, with the item's words. `docs` has `_key`."""
    probes = _probes(items, frequencies(docs, items, text), window, rarest)
    spots = probes.select("item", "digest", "start", F.explode("picks").alias("pick")).select(
        "item", "digest", F.col("pick.term").alias("term"), (F.col("start") + F.col("pick.shift")).alias("spot")).distinct()
    index = postings(docs, spots.select("term"), text)
    met = index.join(small(staged(spots, "spots")), "term").groupBy(
        "_key", "item", "digest", (F.col("at") - F.col("spot")).alias("origin")).agg(F.collect_set("spot").alias("spots"))
    needs = probes.groupBy("item", "digest").agg(F.first("n").alias("n"), F.collect_list(F.struct(
        "start", F.transform("picks", lambda p: F.col("start") + p["shift"]).alias("spots"))).alias("windows"))
    known = staged(items.join(needs, ["item", "digest"]).select("item", "digest", "n", "windows", "words"), "windows")
    agreed = met.join(small(known), ["item", "digest"]).select(
        "_key", "item", "origin", "n", "words",
        F.transform(
            F.filter("windows", lambda w: F.forall(w["spots"], lambda s: F.array_contains(F.col("spots"), s))),
            lambda w: w["start"]).alias("starts"))
    return staged(
        agreed.where(F.size("starts") > 0).groupBy("_key").agg(
            F.collect_list(F.struct("item", "origin", "n", "starts", "words")).alias("options")), "candidates")


def matches(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
            item_text: str = "text", out: str = "contamination", window: int = WINDOW, rarest: int = RAREST) -> DataFrame:
    """`docs` with a struct column `out`: n_words, n_hit, items (ids as strings, sorted) and hits (item, first word)."""
    keyed = _keyed(docs, doc_id, text)
    options = candidates(keyed.select("_key", "_text"), _items(benchmark, item_id, item_text), "_text", window, rarest)
    joined = keyed.join(small(options), "_key", "left").withColumn("_words", words_of(F.col("_text")))

    def same(option: Column, start: Column) -> Column:
        at = option["origin"] + start
        fits = (at >= 0) & (at + option["n"] <= F.size("_words"))
        return fits & (F.slice("_words", F.greatest(at, F.lit(0)) + 1, option["n"]) == F.slice(option["words"], start + 1, option["n"]))

    true = F.filter(
        F.transform("options", lambda o: F.struct(
            o["item"].alias("item"), o["n"].alias("n"),
            F.transform(F.filter(o["starts"], lambda s: same(o, s)), lambda s: o["origin"] + s).alias("at"))),
        lambda o: F.size(o["at"]) > 0)
    checked = joined.withColumn("_true", F.when(F.col("options").isNotNull(), true))
    covered = F.array_distinct(F.flatten(F.transform("_true", lambda o: F.flatten(
        F.transform(o["at"], lambda a: F.sequence(a, a + o["n"] - 1))))))
    result = F.struct(
        F.size("_words").cast("bigint").alias("n_words"),
        F.when(F.size("_true") > 0, F.size(covered)).otherwise(0).cast("bigint").alias("n_hit"),
        F.coalesce(F.array_sort(F.array_distinct(F.transform("_true", lambda o: o["item"]))), F.array().cast("array<string>")).alias("items"),
        F.coalesce(F.flatten(F.transform("_true", lambda o: F.transform(
            o["at"], lambda a: F.struct(o["item"].alias("item"), a.alias("first_word"))))),
            F.array().cast("array<struct<item:string,first_word:int>>")).alias("hits"),
    )
    # through an explode, so that a caller's filter on the result does not run the comparison again
    done = checked.select("_row", F.explode(F.array(result)).alias("_result"))
    return unboxed(done, docs.columns, **{out: F.col("_result")})


def contaminated(out: str = "contamination") -> Column:
    """At least a twentieth of the document's words stand in benchmark passages."""
    return (F.col(f"{out}.n_hit") > 0) & (20 * F.col(f"{out}.n_hit") >= F.col(f"{out}.n_words"))


def near_matches(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                 item_text: str = "text", terms: int = 4, span: int = 60) -> DataFrame:
    """(doc_id, item_id, first_word): the first place where an item's rarest distinct terms (`terms` of them, or all it
    has) stand within `span` words in any order."""
    keyed = _keyed(docs, doc_id, text).select("_key", "_text", F.col(f"_row.`{doc_id}`").alias("doc_id"))
    items = _items(benchmark, item_id, item_text)
    found = frequencies(keyed, items, "_text")
    own = items.select("item", "digest", F.explode(F.array_distinct("words")).alias("term")).join(found, "term", "left")
    ranked = own.groupBy("item", "digest").agg(
        F.slice(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "term"))), 1, terms).alias("picks"))
    wanted = ranked.where(F.element_at("picks", 1)["n"] > 0).select(
        "item", "digest", F.size("picks").alias("n_terms"), F.explode("picks.term").alias("term"))
    index = postings(keyed, wanted.select("term"), "_text")
    ahead = Window.partitionBy("_key", "item", "digest").orderBy("at").rangeBetween(0, span - 1)
    near = index.join(small(staged(wanted, "wanted")), "term").withColumn("held", F.size(F.collect_set("term").over(ahead)))
    first = near.where("held = n_terms").groupBy("_key", "item").agg(F.min("at").alias("first_word"))
    return keyed.select("_key", "doc_id").join(first, "_key").select("doc_id", F.col("item").alias("item_id"), "first_word")
