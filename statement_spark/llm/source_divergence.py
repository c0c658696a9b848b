"""Divergence between the sources of a language, from smoothed shares of its terms, on run-length coded counts.

Every term of a language has one count in each of its sources. Terms with the same counts in all sources are
interchangeable, so the vocabulary is reordered by its counts and each source's column becomes runs of equal counts. For
two sources the run boundaries are merged; on each stretch both counts are constant, so the divergence of one term
times the length of the stretch is the sum over the stretch. No term is visited for a pair, and terms that neither
source has are one stretch.

A reordered vocabulary is dealt in order to tasks (by range, so a language with most terms takes many) and cut
into blocks of at most `block_entries` counts; sums over blocks add up. Shares are exact: integers in parts of a thousand
million, computed without limit on the counts' size.

Null texts, languages and sources are read as empty strings. A group (language, source) without terms counts nothing and
still has its pairs; a language without kept terms has pairs of value 0; an empty table gives no rows. Copies and
repeated rows count as often as they come. A term's list of counts has one entry per source of its language; the pairs
have their square, so that number bounds the list long before it bounds memory.
"""
from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from statement_spark.session import small, staged

LEAST_DOCS = 10
TERM_RANKS = 10
SCALE = 1_000_000_000
HELD_TERMS = 500_000
BLOCK_ENTRIES = 1 << 18
PAIR_ROWS = 1 << 16

# Fixed value: what stands between terms, as a translation to blanks.
BETWEEN_TERMS = bytes(c if c > 0x7F or 0x41 <= c <= 0x5A or 0x61 <= c <= 0x7A else 0x20 for c in range(256))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) of a task's rows, added up as far as `HELD_TERMS` allows."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def rows() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            terms = pa.array(list(n), pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(n), pa.string()), pa.array([source] * len(n), pa.string()), terms,
                 pa.array(n.values(), pa.int64()), pa.array([docs[t] for t in n], pa.int64())],
                ["lang", "source", "term", "n", "docs"])
        held.clear()

    for batch in batches:
        for lang, source, body in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "body"))):
            words = body.translate(BETWEEN_TERMS).lower().split()
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            n.update(words)
            docs.update(set(words))
        if sum(len(n) for n, _ in held.values()) > HELD_TERMS:
            yield from rows()
    yield from rows()


def _or_empty(column: str) -> Column:
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def kept_terms(docs: DataFrame, text: str, lang: str, source: str, least_docs: int) -> DataFrame:
    """(lang, term, total, counts) of terms in at least `least_docs` of a language's rows; counts by source, ascending."""
    own = docs.select(_or_empty(lang).alias("lang"), _or_empty(source).alias("source"), _or_empty(text).cast("binary").alias("body"))
    counted = own.mapInArrow(_counted, "lang string, source string, term string, n bigint, docs bigint")
    by_source = counted.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    by_term = by_source.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.array_sort(F.collect_list(F.struct("source", "n"))).alias("counts"))
    return staged(by_term.where(F.col("docs") >= least_docs).select("lang", "term", "total", "counts"), "terms")


def group_sizes(docs: DataFrame, terms: DataFrame, lang: str, source: str) -> DataFrame:
    """(lang, source, n, lang_n, v) of every group of `docs`: term occurrences in the group and language, kept terms."""
    groups = docs.select(_or_empty(lang).alias("lang"), _or_empty(source).alias("source")).distinct()
    of_group = terms.select("lang", F.explode("counts").alias("c")).groupBy("lang", F.col("c.source").alias("source")).agg(F.sum("c.n").alias("n"))
    of_lang = terms.groupBy("lang").agg(F.sum("total").alias("lang_n"), F.count(F.lit(1)).alias("v"))
    sizes = groups.join(of_group, ["lang", "source"], "left").join(small(of_lang), "lang", "left")
    return staged(sizes.na.fill(0, ["n", "lang_n", "v"]), "groups")


def _share(count: Column, n: Column, v: Column) -> Column:
    """The smoothed share in parts of `SCALE`, exact whatever the counts."""
    top, bottom = (count.cast("decimal(20,0)") + 2) * F.lit(SCALE).cast("decimal(10,0)"), (n + 2 * v).cast("decimal(20,0)")
    return F.call_function("div", top, bottom) + 1


def _divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def run_columns(batches: Iterator[pa.RecordBatch], block_entries: int = BLOCK_ENTRIES) -> Iterator[pa.RecordBatch]:
    """Blocks (lang, length, columns) of rows (lang, counts, terms) in order; a column is a source's starts and counts."""
    lang, length, entries, runs = None, 0, 0, {}

    def block() -> pa.RecordBatch:
        columns = []
        for source, (starts, counts, end) in runs.items():
            closed = end < length
            columns.append({"source": source, "starts": starts + [end] * closed, "counts": counts + [0] * closed})
        return pa.RecordBatch.from_arrays(
            [pa.array([lang], pa.string()), pa.array([length], pa.int64()), pa.array([columns], BLOCK_COLUMNS)], ["lang", "length", "columns"])

    for batch in batches:
        for own, counts, terms in zip(*(batch.column(c).to_pylist() for c in ("lang", "counts", "terms"))):
            if length and (own != lang or entries >= block_entries):
                yield block()
                length, entries, runs = 0, 0, {}
            lang = own
            for c in counts:
                run = runs.get(c["source"])
                if run is None:
                    run = runs[c["source"]] = [[0], [0], length] if length else [[], [], 0]
                starts, values, end = run
                if end < length and values[-1] != 0:
                    starts.append(end)
                    values.append(0)
                if not values or values[-1] != c["n"]:
                    starts.append(length)
                    values.append(c["n"])
                run[2] = length + terms
            length += terms
            entries += len(counts)
    if length:
        yield block()


BLOCK_COLUMNS = pa.list_(pa.struct([("source", pa.string()), ("starts", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))]))


def shares(counts: list[int], n: int, v: int) -> np.ndarray:
    """Smoothed shares of counts in a group of `n` occurrences; Python's integers have no limit."""
    by_count = {c: 1 + SCALE * (c + 2) // (n + 2 * v) for c in set(counts)}
    return np.array([by_count[c] for c in counts], np.int64)


def run_sum(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray], length: int) -> int:
    """Sum of the divergence over a block of two columns, each given as its runs' starts and shares."""
    cuts = np.union1d(x[0], y[0])
    p = x[1][np.searchsorted(x[0], cuts, "right") - 1]
    q = y[1][np.searchsorted(y[0], cuts, "right") - 1]
    return int(((p - q) ** 2 // (p + q) * np.diff(cuts, append=length)).sum())


def _pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, a, b, value) of every pair of a language's sources in each block."""
    for batch in batches:
        for lang, length, columns, v, sides in zip(*(batch.column(c).to_pylist() for c in ("lang", "length", "columns", "v", "sides"))):
            runs = {c["source"]: (c["starts"], c["counts"]) for c in columns}
            ready = []
            for side in sides if length else []:
                starts, counts = runs.get(side["source"], ([0], [0]))
                ready.append((np.array(starts, np.int64), shares(counts, side["n"], v)))
            names, rows = [side["source"] for side in sides], []
            for i in range(len(names)):
                rows += [(names[i], names[j], run_sum(ready[i], ready[j], length) if length else 0) for j in range(i + 1, len(names))]
                if len(rows) >= PAIR_ROWS or (rows and i == len(names) - 1):
                    a, b, values = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(rows), pa.string()), pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(values, pa.int64())],
                        ["lang", "a", "b", "value"])
                    rows = []


def source_pairs(terms: DataFrame, groups: DataFrame, block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """(lang, source, item, value) for every two sources of a language, both ways."""
    profiles = terms.groupBy("lang", "counts").agg(F.count(F.lit(1)).alias("terms"))
    ordered = profiles.withColumn("sources", F.size("counts"))
    keys = ["lang", "sources", "counts"]
    ordered = ordered.repartitionByRange(*keys).sortWithinPartitions(*keys).select("lang", "counts", "terms")
    blocks = ordered.mapInArrow(
        lambda batches: run_columns(batches, block_entries),
        "lang string, length bigint, columns array<struct<source:string,starts:array<bigint>,counts:array<bigint>>>")
    sides = staged(groups.groupBy("lang").agg(F.max("v").alias("v"), F.array_sort(F.collect_list(F.struct("source", "n"))).alias("sides")), "sides")
    bare = sides.where("v = 0").select(
        "lang", F.lit(0).cast("bigint").alias("length"), F.array().cast(blocks.schema["columns"].dataType).alias("columns"))
    met = staged(blocks.unionByName(bare), "blocks").join(small(sides), "lang")
    summed = met.mapInArrow(_pair_sums, "lang string, a string, b string, value bigint").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    return summed.select("lang", both.alias("x"), "value").select("lang", "x.source", "x.item", "value")


def leading_terms(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of the terms whose share in a group is above that in its language."""
    found = terms.select("lang", F.col("term").alias("item"), "total", F.explode("counts").alias("c"))
    found = found.select("lang", F.col("c.source").alias("source"), "item", "total", F.col("c.n").alias("count"))
    met = found.join(small(groups), ["lang", "source"])
    shared = met.select(
        "lang", "source", "item",
        _share(F.col("count"), F.col("n"), F.col("v")).alias("p"), _share(F.col("total"), F.col("lang_n"), F.col("v")).alias("q"))
    return shared.where("p > q").select("lang", "source", "item", _divergence(F.col("p"), F.col("q")).alias("value"))


def _ranked(rows: DataFrame, part: str, most: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = rows.withColumn("rank", F.row_number().over(order))
    ranked = ranked if most is None else ranked.where(F.col("rank") <= most)
    return ranked.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = LEAST_DOCS,
          term_ranks: int = TERM_RANKS, block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """(lang, source, part, item, value, rank): a group's distances to the other sources of its language (part `pair`, all
    of them) and the terms that set it apart from the language (part `term`, the first `term_ranks`); ties by item."""
    terms = kept_terms(docs, text, lang, source, least_docs)
    groups = group_sizes(docs, terms, lang, source)
    return _ranked(source_pairs(terms, groups, block_entries), "pair").unionByName(_ranked(leading_terms(terms, groups), "term", term_ranks))
