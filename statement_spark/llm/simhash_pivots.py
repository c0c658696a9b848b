"""Near-duplicates by SimHash, with pairs screened through pivot distance tables.

A document's fingerprint is the bitwise majority of its shingles' hashes. Distinct fingerprints are compared, never
copies. Two fingerprints within `radius` bits agree on all but `radius` of `blocks` bit blocks, so one of the choices of
`blocks - radius` blocks brings every linked pair together. Inside such a bucket a pair is first screened through the
pivot table: each fingerprint carries its Hamming distances to fixed reference fingerprints, and by the triangle
inequality a pair whose distances to any reference differ by more than `radius` can't be linked. What is left is verified.

A bucket of more than `pair_limit` fingerprints is not paired. For it every member writes itself and each one-bit
neighbour within the bits that vary there; two fingerprints are within two bits exactly if they write a common value, so
linking every writer of a value to the smallest gives the same components with rows in proportion to the members.

Null and empty texts have no shingles: their fingerprint is zero, and they are linked like any other. Repeated rows get
the same result. A component's id is its smallest non-null document id (null if there is none).
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from statement_spark.llm.common import octets
from statement_spark.llm.components import connected
from statement_spark.session import staged

RADIUS = 2
BLOCKS = 5
PIVOTS = 16
PAIR_LIMIT = 64
SEED = 42


def shingle_hashes(body: bytes, words_each: int, seed: int = SEED) -> np.ndarray:
    """Signed 64-bit hashes of the lower-cased words in shingles of `words_each`, with repeats; a shorter text is one shingle."""
    words = body.lower().split()
    line = b" ".join(words)
    hashed = xxhash.xxh64_intdigest
    if len(words) <= words_each:
        hashes = [hashed(line, seed)]
    else:
        lengths = [len(w) + 1 for w in words]
        ends = np.cumsum(lengths)
        starts = (ends - lengths).tolist()
        stops = (ends - 1)[words_each - 1:].tolist()
        hashes = [hashed(line[start:stop], seed) for start, stop in zip(starts, stops)]
    return np.array(hashes, "<u8").view("<i8")


def fingerprint(body: bytes, words_each: int = 3, seed: int = SEED) -> int:
    """Signed 64-bit SimHash of the text's lower-cased words in shingles of `words_each`."""
    if not body.strip():
        return 0
    hashes = shingle_hashes(body, words_each, seed)
    votes = np.zeros(64, np.int64)
    values = hashes.view(np.uint8).reshape(-1, 8)
    for at in range(0, len(values), 1 << 16):  # very long texts in steps, for memory
        votes += np.unpackbits(values[at:at + (1 << 16)], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fp", words_each: int = 3) -> DataFrame:
    """`docs` with the fingerprint as a signed bigint `out` (in place of a column of that name); one pass, no shuffle."""

    @F.arrow_udf(returnType="bigint")
    def simhash(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([fingerprint(v.as_py() or b"", words_each) for v in batch], pa.int64())

    return docs.withColumn(out, simhash.asNondeterministic()(octets(text)))


def references(n: int = PIVOTS) -> list[int]:
    """The reference fingerprints: hashes of 0, 1, 2 and so on, as signed 64-bit integers."""
    return [int(np.uint64(xxhash.xxh64_intdigest(str(i).encode(), SEED)).astype(np.int64)) for i in range(n)]


def pivot_distances(fp: Column, pivots: list[int]) -> Column:
    return F.array(*[F.bit_count(fp.bitwiseXOR(F.lit(p).cast("bigint"))).cast("tinyint") for p in pivots])


def _masks(blocks: int, radius: int) -> list[int]:
    edges = [64 * i // blocks for i in range(blocks + 1)]
    whole = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:])]
    masks = [sum(chosen) for chosen in combinations(whole, blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _screened(pairs: DataFrame, radius: int) -> DataFrame:
    """Of (x, y: fp and distances) the linked pairs: the pivot screen first, then the exact distance."""
    apart = F.array_max(F.zip_with("x.far", "y.far", lambda a, b: F.abs(a - b)))
    return pairs.where((apart <= radius) & (F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= radius)).select(
        F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))


def links(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, pivots: int = PIVOTS,
          pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """Edges (a, b) over distinct fingerprints `prints` (fp) whose components are those of all pairs within `radius`."""
    if radius > 2:
        raise ValueError("buckets over pair_limit are resolved for a radius of at most 2")
    item = F.struct("fp", pivot_distances(F.col("fp"), references(pivots)).alias("far"))
    keys = F.array(*[
        F.struct(F.lit(i).cast("tinyint").alias("choice"), F.col("fp").bitwiseAND(F.lit(m).cast("bigint")).alias("bits"))
        for i, m in enumerate(_masks(blocks, radius))
    ])
    rows = prints.select(item.alias("x"), F.explode(keys).alias("bucket"))
    buckets = staged(
        rows.groupBy("bucket").agg(
            F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high"),
            F.bit_and("x.fp").alias("shared"), F.bit_or("x.fp").alias("any"))
        .where("n > 1"), "buckets")
    twos = _screened(buckets.where("n = 2").select(F.col("low").alias("x"), F.col("high").alias("y")), radius)
    members = staged(
        rows.join(buckets.where("n > 2").select("bucket", "n", F.expr("any & ~shared").alias("varying")), "bucket"), "members")
    few = members.where(F.col("n") <= pair_limit)
    pairs = few.select("bucket", "x").join(few.select("bucket", F.col("x").alias("y")), "bucket").where("x.fp < y.fp")
    near = twos.unionByName(_screened(pairs.select("x", "y"), radius))
    writers = (
        members.where(F.col("n") > pair_limit)
        .select(F.col("x.fp").alias("fp"), F.explode(F.concat(
            F.array(F.lit(0).cast("bigint")),
            F.filter(F.array(*[F.lit(1 << i if i < 63 else -(1 << 63)).cast("bigint") for i in range(64)]),
                     lambda bit: bit.bitwiseAND(F.col("varying")) != 0))).alias("flip"))
        .select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("value")).distinct()
    )
    leaders = writers.groupBy("value").agg(F.min("fp").alias("lead"), F.count(F.lit(1)).alias("n")).where("n > 1")
    stars = writers.join(leaders, "value").where("fp <> lead").select(F.col("fp").alias("a"), F.col("lead").alias("b"))
    return near.unionByName(stars)


def classes(prints: DataFrame, doc_id: str = "doc_id", fp: str = "fp") -> DataFrame:
    """(fp, component_id) for the distinct fingerprints of a (document, fingerprint) table."""
    firsts = staged(prints.groupBy(F.col(fp).alias("fp")).agg(F.min(doc_id).alias("first")), "fingerprints")
    roots = connected(links(firsts.select("fp")))
    named = firsts.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = staged(named.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    return named.join(least, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp, component_id), a row for every row of `docs`."""
    prints = staged(fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))).select("doc_id", "fp"), "simhash")
    return prints.join(classes(prints), "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of every component, that of its smallest id, with the columns of `docs`; rows without an id all stay."""
    firsts = near_duplicates(docs, doc_id, text).where("doc_id = component_id").select(F.col("doc_id").alias(doc_id)).distinct()
    kept = docs.join(firsts, doc_id, "left_semi").dropDuplicates([doc_id])
    return kept.unionByName(docs.where(F.col(doc_id).isNull()))
