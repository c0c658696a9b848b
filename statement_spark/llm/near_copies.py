"""Near copies by SimHash, verified by the exact Jaccard similarity of shingle sets, and by rare-first prefixes what it can't reach.

Operator 10 comes first: texts of one fingerprint meet their least, and its buckets and pivot tables bring the least
ones of fingerprints within two bits together. These pairs are verified on the texts; texts so linked are known to be one
component, and none of their pairs is verified again. Similar texts may differ in many more bits, so the prefixes find the rest.

All texts put their shingles in one order, rare ones first. Two texts whose sets reach the similarity share a shingle
among the first of each, as many as a text can miss and still reach it, plus one; so texts meet by the shingles of their
prefixes and no linked pair is lost. Sizes, places and sketches screen the pairs inside the join in which they meet, and
those left are verified on the texts. A sketch holds for each of its cells whether an odd number of the text's shingles
falls there; two sketches differ in at most as many cells as the sets differ in shingles, so no linked pair is screened out.
Few cells go with every row, more of them to the comparisons across components and to all pairs before their texts meet.

What is wanted are components, so a shared shingle's texts are not all paired. Up to `pair_limit` texts are; more are dealt
into groups, in each of which all are compared with the least. Of the components so found, a shingle's texts outside its
largest are then compared with all of its texts in other components: no pair across components is left out, and a
large group of near copies costs rows in proportion to its members and those it does not hold.

The order comes from counts in a sample of texts. It decides how many texts meet, never which are linked. Texts without
words are one group; repeated texts are compared once. Rows are known by id and text: of a group the row stays whose id is
the smallest and, where texts share that id, whose text has the smallest digest; of rows equal in both one stays, the
first by its content. Rows without an id all stay.
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from statement_spark.llm import simhash_pivots
from statement_spark.llm.common import octets, small_batches
from statement_spark.llm.components import connected
from statement_spark.llm.simhash_pivots import shingle_hashes
from statement_spark.session import small, staged

WORDS_EACH = 5
PERCENT = 80
PAIR_LIMIT = 8
SAMPLE_TEXTS = 20_000
MOST_COMMON = 200_000
SKETCH_CELLS = 256
WIDE_CELLS = 2048
MEETING_GROUPS = 32
BATCH_TEXTS = 500


def prefix(own: np.ndarray, common: tuple[np.ndarray, np.ndarray], percent: int) -> np.ndarray:
    """Of a text's distinct shingles the first ones by count in the sample (0 if not `common`) and hash."""
    known, counts = common
    seen = np.zeros(len(own), np.int64)
    if len(known):
        at = np.minimum(np.searchsorted(known, own), len(known) - 1)
        seen = np.where(known[at] == own, counts[at], 0)
    ordered = own[np.lexsort((own, seen))]
    return ordered[:len(own) - -(-percent * len(own) // 100) + 1]


def sketch(own: np.ndarray, cells: int = WIDE_CELLS) -> np.ndarray:
    """For each cell whether an odd number of the distinct shingles falls there, as 64-bit integers."""
    found = np.bincount((own & (cells - 1)).astype(np.int64), minlength=cells)
    return np.packbits(found & 1).view("<i8")


def folded(wide: np.ndarray, cells: int) -> np.ndarray:
    """The sketch of fewer cells: each is the parity of those that fall together."""
    return np.bitwise_xor.reduce(wide.reshape(-1, cells // 64), axis=0)


def shingles(body: bytes, words_each: int) -> set:
    words = body.lower().split()
    return {b" ".join(words)} if len(words) <= words_each else set(zip(*[words[i:] for i in range(words_each)]))


def similar(a: bytes, b: bytes, words_each: int = WORDS_EACH, percent: int = PERCENT) -> bool:
    """Whether the shingle sets' Jaccard similarity is `percent` or more."""
    x, y = shingles(a, words_each), shingles(b, words_each)
    both = len(x & y)
    return 100 * both >= percent * (len(x) + len(y) - both)


def _common(texts: DataFrame, words_each: int, sample_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes that several texts of a sample hold, ascending, and their counts."""
    step = max(texts.count() // sample_texts, 1)
    some = texts.where(F.pmod(F.xxhash64("text"), F.lit(step)) == 0).select("text").distinct()

    @F.arrow_udf(returnType="array<bigint>")
    def hashed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([np.unique(shingle_hashes(v.as_py() or b"", words_each)) for v in batch], pa.list_(pa.int64()))

    held = some.select(F.explode(hashed.asNondeterministic()(octets("text"))).alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    rows = held.where("n > 2").orderBy(F.desc("n"), "h").limit(MOST_COMMON).toPandas().sort_values("h")
    return rows["h"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)


def _texts(docs: DataFrame, words_each: int, percent: int, sample_texts: int) -> DataFrame:
    """(node, digest, first, fp, size, prefix, sketch, wide) of the distinct texts of `docs` (doc_id, text)."""
    common = docs.sparkSession.sparkContext.broadcast(_common(docs, words_each, sample_texts))

    @F.arrow_udf(returnType="struct<size:int,prefix:array<bigint>,sketch:array<bigint>,wide:array<bigint>>")
    def prefixes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        many = pa.list_(pa.int64())
        for batch in batches:
            size, first, narrow, wide = [], [], [], []
            for v in batch:  # one text at a time: what is kept of it is small
                shingle = np.unique(shingle_hashes(v.as_py() or b"", words_each))
                cells = sketch(shingle)
                size.append(len(shingle))
                first.append(prefix(shingle, common.value, percent).copy())
                narrow.append(folded(cells, SKETCH_CELLS))
                wide.append(cells)
            yield pa.StructArray.from_arrays(
                [pa.array(size, pa.int32()), *(pa.array(x, many) for x in (first, narrow, wide))], ["size", "prefix", "sketch", "wide"])

    # one after the other: both in one pass would hold two Python workers to a core, with their memory, from then on
    printed = simhash_pivots.fingerprints(docs.select("doc_id", "text")).select("doc_id", _digest(), "fp")
    printed = staged(printed.groupBy("digest").agg(F.min("doc_id").alias("first"), F.first("fp").alias("fp")), "printed")
    own = docs.select(_digest(), prefixes.asNondeterministic()(octets("text")).alias("p")).groupBy("digest").agg(F.first("p").alias("p"))
    return staged(own.join(printed, "digest").select(F.monotonically_increasing_id().alias("node"), "digest", "first", "fp", "p.*"), "texts")


def _digest(text: str = "text") -> Column:
    return F.unhex(F.md5(F.coalesce(octets(text), F.lit(b"")))).alias("digest")


def _alike(percent: int, sketches: str = "sketch", cells: int = SKETCH_CELLS) -> Column:
    """Whether the sketches of a pair x, y allow it to reach the similarity."""
    apart = [F.bit_count(F.col(f"x.{sketches}")[i].bitwiseXOR(F.col(f"y.{sketches}")[i])) for i in range(cells // 64)]
    return (100 + percent) * reduce(add, apart) <= (100 - percent) * (F.col("x.size") + F.col("y.size"))


def _may_reach(percent: int) -> Column:
    """Whether a pair x, y (size, place of a shared shingle, sketch) may reach the similarity."""
    x, y = F.col("x.size"), F.col("y.size")
    most = F.least("x.place", "y.place") + 1 + F.least(x - F.col("x.place") - 1, y - F.col("y.place") - 1)
    return (100 * F.least(x, y) >= percent * F.greatest(x, y)) & ((100 + percent) * most >= percent * (x + y)) & _alike(percent)


def _pairs(met: DataFrame, percent: int) -> DataFrame:
    """Of (x, y) the distinct pairs of nodes worth verifying."""
    return met.where((F.col("x.node") != F.col("y.node")) & _may_reach(percent)).select(
        F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def _verified(pairs: DataFrame, docs: DataFrame, texts: DataFrame, words_each: int, percent: int, known: DataFrame | None = None) -> DataFrame:
    """The pairs (a, b) whose texts reach the similarity; the wide sketches decide first whose texts are compared.

    Pairs of one component of `known` (node, root) are left out."""
    own = texts.select("node", F.struct("size", "wide").alias("own"))
    met = pairs.join(own.select(F.col("node").alias("a"), F.col("own").alias("x")), "a").join(own.select(F.col("node").alias("b"), F.col("own").alias("y")), "b")
    alike = met.where(_alike(percent, "wide", WIDE_CELLS)).select("a", "b")
    if known is not None:
        roots = [known.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}")) for c in ("a", "b")]
        alike = alike.join(roots[0], "a", "left").join(roots[1], "b", "left").where(
            ~F.coalesce(F.col("root_a") == F.col("root_b"), F.lit(False))).select("a", "b")
    pairs = staged(alike, "pairs")
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = staged(texts.select("node", "digest").join(nodes, "node", "left_semi"), "wanted")
    bodies = staged(
        docs.select(_digest(), octets("text").alias("body")).join(small(wanted), "digest").groupBy("node").agg(F.first("body").alias("body")),
        "bodies")

    @F.arrow_udf(returnType="boolean")
    def reach(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for a, b in batches:
            yield pa.array([similar(x.as_py() or b"", y.as_py() or b"", words_each, percent) for x, y in zip(a, b)], pa.bool_())

    left = bodies.select(F.col("node").alias("a"), F.col("body").alias("left"))
    right = bodies.select(F.col("node").alias("b"), F.col("body").alias("right"))
    both = pairs.join(left, "a").join(right, "b")
    return staged(both.where(reach.asNondeterministic()("left", "right")).select("a", "b"), "linked")


def fingerprint_links(docs: DataFrame, texts: DataFrame, words_each: int = WORDS_EACH, percent: int = PERCENT) -> DataFrame:
    """Edges (a, b) of operator 10 over the nodes of `texts` that reach the similarity: of one fingerprint each text with
    the least, and of fingerprints that are linked the least ones."""
    least = staged(texts.groupBy("fp").agg(F.min("node").alias("lead")), "fingerprints")
    same = texts.select("node", "fp").join(least, "fp").where("node <> lead").select(F.col("lead").alias("a"), F.col("node").alias("b"))
    near = simhash_pivots.links(least.select("fp")).join(least.select(F.col("fp").alias("a"), F.col("lead").alias("x")), "a").join(
        least.select(F.col("fp").alias("b"), F.col("lead").alias("y")), "b")
    near = near.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    return _verified(same.unionByName(near), docs, texts, words_each, percent)


def links(docs: DataFrame, texts: DataFrame, words_each: int = WORDS_EACH, percent: int = PERCENT,
          pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """Edges (a, b) over the nodes of `texts` whose components are those of all pairs that reach the similarity."""
    printed = fingerprint_links(docs, texts, words_each, percent)
    known = staged(connected(printed), "known")
    rows = texts.select("node", "size", F.posexplode("prefix").alias("place", "shingle"))
    x = F.struct("node", "size", "place", "sketch").alias("x")
    shared = staged(rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared")
    some = rows.join(shared, "shingle").join(texts.select("node", "sketch"), "node")
    met = staged(some.select("shingle", x, "n"), "met")
    few, many = met.where(F.col("n") <= pair_limit), met.where(F.col("n") > pair_limit)
    paired = few.select("shingle", "x").join(few.select("shingle", F.col("x").alias("y")), "shingle").where("x.node < y.node")
    part = F.pmod(F.xxhash64("shingle", "x.node"), F.ceil(F.col("n") / pair_limit)).alias("part")
    dealt = many.select("shingle", part, "x")
    least = dealt.groupBy("shingle", "part").agg(F.min("x").alias("y"))
    led = dealt.join(staged(least, "least"), ["shingle", "part"])
    first = _verified(_pairs(paired.select("x", "y").unionByName(led.select("x", "y")), percent), docs, texts, words_each, percent, known)
    first = first.unionByName(printed)

    roots = connected(first)
    inside = staged(
        many.select("shingle", "x", F.col("x.node").alias("node")).join(roots, "node", "left")
        .select("shingle", "x", F.coalesce("root", "node").alias("root")), "inside")
    parts = inside.groupBy("shingle", "root").agg(F.count(F.lit(1)).alias("n")).groupBy("shingle").agg(
        F.max_by("root", F.struct("n", "root")).alias("main"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    mixed = inside.join(staged(parts.select("shingle", "main"), "parts"), "shingle").select("shingle", "x", "root", "main", F.col("x.node").alias("node"))
    mixed = staged(_with_own(staged(mixed, "mixed"), texts), "mixed")
    outside = mixed.where("root <> main").select("shingle", F.col("x").alias("y"), F.col("root").alias("other"))
    met_before = F.arrays_overlap("x.before", "y.before")
    across = mixed.select("shingle", "x", "root").join(outside, "shingle").where(
        (F.col("root") != F.col("other")) & _may_reach(percent) & _alike(percent, "wide", WIDE_CELLS // 2) & ~met_before)
    second = _verified(_pairs(across.select("x", "y"), percent), docs, texts, words_each, percent)
    return first.unionByName(second)


def _with_own(mixed: DataFrame, texts: DataFrame) -> DataFrame:
    """`mixed` with two more fields in `x`: half of the wide sketch, and the node's least shingles here of the groups before
    this shingle's (shingles are grouped by hash).

    Two nodes that have one of these in common meet there too, so they need not meet here. In the first group whose
    least shingles agree nothing stands before, so every pair meets at least once, and alike ones not often more.
    """
    group = F.pmod("shingle", F.lit(MEETING_GROUPS))
    least = mixed.groupBy("node", group.alias("group")).agg(F.min("shingle").alias("least"))
    own = least.groupBy("node").agg(F.collect_list(F.struct("group", "least")).alias("own"))
    wide = texts.select("node", F.transform(F.sequence(F.lit(0), F.lit(WIDE_CELLS // 128 - 1)), lambda i: F.col("wide")[i].bitwiseXOR(
        F.col("wide")[i + WIDE_CELLS // 128])).alias("wide"))
    before = F.transform(F.filter("own", lambda e: e["group"] < group), lambda e: e["least"])
    rows = mixed.join(own, "node").join(wide, "node")
    return rows.select("shingle", "root", "main", F.struct("x.*", "wide", before.alias("before")).alias("x"))


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words_each: int = WORDS_EACH, percent: int = PERCENT,
               pair_limit: int = PAIR_LIMIT, sample_texts: int = SAMPLE_TEXTS) -> DataFrame:
    """One row of every component, that of its smallest id, with the columns of `docs`; rows without an id all stay."""
    own = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    with small_batches(docs.sparkSession, BATCH_TEXTS):
        texts = _texts(own, words_each, percent, sample_texts)
        linked = links(own, texts, words_each, percent, pair_limit)
    roots = connected(linked)
    named = texts.select("node", "first", "digest").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = named.where("first IS NOT NULL")
    least = staged(named.groupBy("root").agg(F.min(F.struct("first", "digest")).alias("x")).select(F.col("x.first").alias("id"), "x.digest"), "firsts")
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(doc_id).alias("id"), _digest(text))
    again = staged(keyed.groupBy("id", "digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id", "digest"), "again")
    kept = keyed.join(least, ["id", "digest"], "left_semi")
    one = kept.join(small(again), ["id", "digest"], "left_semi").groupBy("id", "digest").agg(F.min_by("row", F.to_json("row")).alias("row"))
    rows = kept.join(small(again), ["id", "digest"], "left_anti").select("row").unionByName(one.select("row"))
    return rows.select("row.*").unionByName(docs.where(F.col(doc_id).isNull()))
