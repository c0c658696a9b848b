"""Removal of repeated byte strings: every byte covered by a string of `length` bytes that also starts elsewhere goes.

A window is a string of `length` bytes. Among the hashes of its `gram`-byte substrings the leftmost least one is its
anchor, which depends on nothing but the window's bytes; equal windows have equal anchors at equal offsets. Neighbouring
windows share anchors, so a text is told by a few anchors, each with its run of windows and the bytes they span, the
anchor's context.

1. Anchors whose gram occurs once in the corpus are done: none of their windows is repeated.
2. Contexts that occur as a whole more than once have all their windows repeated. Copies are counted, never gathered.
3. The other contexts of a repeated gram are the edges of repeats. A group of them is suffix-sorted at the anchor, by
   mergesort with comparisons that find the common extension by binary search over prefix polynomial hashes and
   verify it on the bytes; likewise to the left. Joining neighbours by falling common extension to the right, and
   looking up neighbours in the left order, gives every window that two contexts share, without pairing all.
4. Groups of more than `group_limit` contexts are not gathered: their windows are counted by a 128-bit hash instead.

Null and empty texts have no bytes; texts shorter than `length` keep all theirs. Repeated rows are copies of each other
and lose what is covered by such strings in all of them. Hashes of grams and contexts are 64 bits each.
"""
from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cmp_to_key

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from statement_spark.llm.common import unboxed
from statement_spark.session import small, staged

STEP = 1 << 20  # window starts that are worked on at a time
WORD = (1 << 64) - 1
_rng = np.random.default_rng(20)
DIGITS = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class Settings:
    length: int = 400
    gram: int = 100
    group_limit: int = 512


def powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n + 1, np.uint64)
    np.multiply.accumulate(np.full(n, base, np.uint64), out=out[1:])
    return out


def prefix_hashes(body: np.ndarray, power: np.ndarray) -> np.ndarray:
    """Polynomial hashes, modulo 2^64, of all prefixes."""
    out = np.zeros(len(body) + 1, np.uint64)
    np.cumsum(DIGITS[body] * power[:len(body)], out=out[1:])
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def anchors(body: np.ndarray, settings: Settings, power: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of one stretch: (first window, last window, anchor, gram hash, context hash) of every run of windows."""
    n_windows = len(body) - settings.length + 1
    if n_windows < 1:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    prefix, top, grams = prefix_hashes(body, power), len(power) - 1, settings.length - settings.gram + 1
    hashes = mixed((prefix[settings.gram:] - prefix[:-settings.gram]) * power[top - np.arange(len(prefix) - settings.gram)])
    low = np.uint64((1 << 21) - 1)  # places within a stretch fit; equal upper bits fall to the leftmost
    ranked = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    blocks = np.concatenate([ranked, np.full(-len(ranked) % grams, WORD, np.uint64)]).reshape(-1, grams)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:n_windows], ahead[grams - 1:grams - 1 + n_windows])
    place = (least & low).astype(np.int64)
    turns = np.flatnonzero(np.diff(place)) + 1
    first = np.concatenate([[0], turns])
    last = np.concatenate([turns - 1, [n_windows - 1]])
    context = mixed((prefix[last + settings.length] - prefix[first]) * power[top - first])
    return first, last, place[first], hashes[place[first]], context


def _rows_of(doc_id: str, text: str) -> list[Column]:
    """Two hashes that name a row by id and text; rows that agree in both are copies, with equal results."""
    return [F.xxhash64(F.col(doc_id), F.col(text)).alias("r1"), F.xxhash64(F.lit(1), F.col(text), F.col(doc_id)).alias("r2")]


def anchor_table(docs: DataFrame, settings: Settings) -> DataFrame:
    """(r1, r2, first, last, anchor, gram, context) for `docs` of (r1, r2, body)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        power = powers(BASES[0], STEP + settings.length)
        for batch in batches:
            parts, owners = [], []
            for row, value in enumerate(batch.column("body")):
                whole = np.frombuffer(value.as_buffer() or b"", np.uint8) if value.is_valid else np.zeros(0, np.uint8)
                for at in range(0, max(len(whole) - settings.length + 1, 0), STEP):
                    found = anchors(whole[at:at + STEP + settings.length - 1], settings, power)
                    parts.append((found[0] + at, found[1] + at, found[2] + at, found[3], found[4]))
                    owners.append(np.full(len(found[0]), row))
            if not parts:
                continue
            owner = np.concatenate(owners)
            columns = [np.concatenate([p[i] for p in parts]) for i in range(5)]
            r1, r2 = (batch.column(c).to_numpy(zero_copy_only=False)[owner] for c in ("r1", "r2"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (r1, r2, *columns[:3], columns[3].view(np.int64), columns[4].view(np.int64))],
                ["r1", "r2", "first", "last", "anchor", "gram", "context"])

    return docs.mapInArrow(run, "r1 long, r2 long, first long, last long, anchor long, gram long, context long")


class Context:
    """A context's bytes with their prefix hashes; `at` is the anchor's offset there."""

    __slots__ = ("body", "at", "prefix", "index")

    def __init__(self, body: bytes, at: int, index: int, power: np.ndarray):
        self.body, self.at, self.index = body, at, index
        self.prefix = prefix_hashes(np.frombuffer(body, np.uint8), power).tolist()


class Extensions:
    """Common extensions of contexts to either side of their anchors, by binary search over prefix hashes."""

    def __init__(self, power: np.ndarray):
        self.power, self.top = power.tolist(), len(power) - 1

    def piece(self, c: Context, start: int, stop: int) -> int:
        return (c.prefix[stop] - c.prefix[start]) * self.power[self.top - start] & WORD

    def right(self, x: Context, y: Context) -> int:
        low, high = 0, min(len(x.body) - x.at, len(y.body) - y.at)
        while low < high:
            mid = (low + high + 1) // 2
            if self.piece(x, x.at, x.at + mid) == self.piece(y, y.at, y.at + mid):
                low = mid
            else:
                high = mid - 1
        if x.body[x.at:x.at + low] != y.body[y.at:y.at + low]:  # a collision
            low = next(i for i in range(low) if x.body[x.at + i] != y.body[y.at + i])
        return low

    def left(self, x: Context, y: Context) -> int:
        low, high = 0, min(x.at, y.at)
        while low < high:
            mid = (low + high + 1) // 2
            if self.piece(x, x.at - mid, x.at) == self.piece(y, y.at - mid, y.at):
                low = mid
            else:
                high = mid - 1
        if x.body[x.at - low:x.at] != y.body[y.at - low:y.at]:
            low = next(i for i in range(low) if x.body[x.at - 1 - i] != y.body[y.at - 1 - i])
        return low

    def by_right(self, x: Context, y: Context) -> int:
        n = self.right(x, y)
        return _order(x.body[x.at + n:x.at + n + 1], y.body[y.at + n:y.at + n + 1])

    def by_left(self, x: Context, y: Context) -> int:
        n = self.left(x, y)
        return _order(x.body[:x.at - n][-1:], y.body[:y.at - n][-1:])


def _order(a: bytes, b: bytes) -> int:
    return (a > b) - (a < b)


def shared_windows(group: list[Context], length: int, extensions: Extensions) -> list[list[tuple[int, int]]]:
    """For each context, in the order given, stretches [start, stop) of it that windows shared with another cover.

    `sorted` is a mergesort. Contexts next to each other in right order are joined from the longest common extension
    down; the smaller side's members look up their neighbours by left order in the larger side."""
    found: list[list[tuple[int, int]]] = [[] for _ in group]
    for place, c in enumerate(group):
        c.index = place
    rights = sorted(group, key=cmp_to_key(extensions.by_right))
    lefts = sorted(group, key=cmp_to_key(extensions.by_left))
    rank = [0] * len(group)
    for place, c in enumerate(lefts):
        rank[c.index] = place
    joins = sorted(((extensions.right(a, b), i) for i, (a, b) in enumerate(zip(rights, rights[1:]))), reverse=True)
    cluster = [[rank[c.index]] for c in rights]  # sorted left ranks, held at a cluster's root
    root = list(range(len(rights)))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def meet(a: Context, b: Context, right: int) -> None:
        left = extensions.left(a, b)
        if left + right >= length:
            for c in (a, b):
                found[c.index].append((c.at - left, c.at + right))

    for right, i in joins:
        a, b = top(i), top(i + 1)
        if len(cluster[a]) < len(cluster[b]):
            a, b = b, a
        members = cluster[a]
        for mine in cluster[b]:
            at = bisect.bisect(members, mine)
            for near in members[max(at - 1, 0):at + 1]:
                meet(lefts[mine], lefts[near], right)
        for mine in cluster[b]:
            bisect.insort(members, mine)
        cluster[b], root[b] = [], a
    return found


def _edges(contexts: DataFrame, settings: Settings) -> DataFrame:
    """(r1, r2, start, stop) of what edges share, group by group; `contexts`: gram, copies, r1, r2, first, anchor, body."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        power = powers(BASES[1], 2 * settings.length)
        extensions = Extensions(power)
        gram, group = None, []

        def solved() -> list[tuple]:
            members = [Context(r["body"], r["anchor"] - r["first"], i, power) for i, r in enumerate(group)]
            stretches = shared_windows(members, settings.length, extensions)
            return [(r["r1"], r["r2"], r["first"] + start, r["first"] + stop)
                    for r, some in zip(group, stretches) if r["copies"] == 1 for start, stop in set(some)]

        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], pa.int64()) for i in range(4)], ["r1", "r2", "start", "stop"])

        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if row["gram"] != gram:
                    rows += solved()
                    gram, group = row["gram"], []
                group.append(row)
            yield out(rows)
        yield out(solved())

    return contexts.repartition("gram").sortWithinPartitions("gram").mapInArrow(run, "r1 long, r2 long, start long, stop long")


def _squeezed(body: Column) -> Column:
    """Texts travel compressed."""

    @F.arrow_udf(returnType="binary")
    def squeeze(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            yield pa.array([packer.compress(v.as_py()) if v.is_valid else None for v in batch], pa.binary())

    return squeeze.asNondeterministic()(body)


def _cut_out(texts: DataFrame, wanted: DataFrame, settings: Settings) -> DataFrame:
    """Contexts with their bytes where the group is gathered, windows with their hashes where it is not.

    `texts`: r1, r2, squeezed; `wanted`: r1, r2, places (gram, copies, first, last, anchor, gathered)."""
    schema = ("gram long, copies long, r1 long, r2 long, first long, anchor long, body binary, w1 long, w2 long")
    names = [field.split(" ")[0] for field in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker, tables = zstandard.ZstdDecompressor(), [powers(b, 2 * settings.length) for b in BASES]
        top = 2 * settings.length
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                text = unpacker.decompress(row["squeezed"])
                for p in row["places"]:
                    body = text[p["first"]:p["last"] + settings.length]
                    if p["gathered"]:
                        rows.append((p["gram"], p["copies"], row["r1"], row["r2"], p["first"], p["anchor"], body, None, None))
                        continue
                    starts, hashes = np.arange(len(body) - settings.length + 1), []
                    for power in tables:
                        prefix = prefix_hashes(np.frombuffer(body, np.uint8), power)
                        hashes.append(((prefix[settings.length:] - prefix[:-settings.length]) * power[top - starts]).view(np.int64).tolist())
                    rows += [(p["gram"], p["copies"], row["r1"], row["r2"], p["first"] + s, p["anchor"], None, w1, w2)
                             for s, w1, w2 in zip(starts.tolist(), *hashes)]
            kinds = [pa.int64()] * 6 + [pa.binary()] + [pa.int64()] * 2
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    return texts.join(wanted, ["r1", "r2"]).select("r1", "r2", "squeezed", "places").mapInArrow(run, schema)


def repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """(r1, r2, start, stop): stretches of repeated windows by row of `docs`, not yet merged."""
    named = docs.where(F.octet_length(F.col(text)) >= settings.length).select(*_rows_of(doc_id, text), F.col(text).cast("binary").alias("body"))
    found = staged(anchor_table(named, settings), "anchors")
    grams = found.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), F.min("context").alias("low"), F.max("context").alias("high"))
    # written first, so that the join reads both sides from shuffles of its own and Spark can split a hot gram
    many = staged(grams.where("n > 1").selectExpr("gram", "low <> high AS mixed"), "grams")
    again = staged(found.join(many, "gram"), "repeated")
    whole = again.where("not mixed").select("r1", "r2", F.col("first").alias("start"), (F.col("last") + settings.length).alias("stop"))
    unequal = again.where("mixed")
    kinds = staged(
        unequal.groupBy("gram", "context").agg(
            F.count(F.lit(1)).alias("copies"), F.min(F.struct("r1", "r2", "first", "last", "anchor")).alias("one")), "contexts")
    some = unequal.join(kinds.where("copies > 1").select("gram", "context"), ["gram", "context"]).select(
        "r1", "r2", F.col("first").alias("start"), (F.col("last") + settings.length).alias("stop"))
    sizes = kinds.groupBy("gram").agg(F.count(F.lit(1)).alias("size"), F.sum(F.expr("cast(copies = 1 AS int)")).alias("single"))
    open_groups = staged(
        sizes.where("size > 1 and single > 0").select("gram", (F.col("size") <= settings.group_limit).alias("gathered")), "groups")
    wanted = staged(
        kinds.join(open_groups, "gram").groupBy("one.r1", "one.r2").agg(F.collect_list(F.struct(
            "gram", "copies", "one.first", "one.last", "one.anchor", "gathered")).alias("places")), "edges")
    texts = named.join(small(wanted.select("r1", "r2")), ["r1", "r2"], "left_semi").select("r1", "r2", _squeezed(F.col("body")).alias("squeezed"))
    cut = staged(_cut_out(texts.dropDuplicates(["r1", "r2"]), wanted, settings), "edge_bytes")
    edges = _edges(cut.where("body is not null").select("gram", "copies", "r1", "r2", "first", "anchor", "body"), settings)
    windows = cut.where("body is null")
    twice = windows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("w1", "w2")
    counted = windows.where("copies = 1").join(twice, ["w1", "w2"]).select(
        "r1", "r2", F.col("first").alias("start"), (F.col("first") + settings.length).alias("stop"))
    return whole.unionByName(some).unionByName(edges).unionByName(counted)


def merged(stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, stop in sorted(stretches):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [(a, b) for a, b in out]


RESULT = pa.struct([
    ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), ("kept", pa.binary()),
])
RESULT_DDL = "struct<n_bytes:bigint,n_removed:bigint,n_spans:bigint,spans:array<struct<start:bigint,stop:bigint>>,kept:binary>"


def _without(squeezed: Column, stretches: Column) -> Column:
    """A compressed text without its repeats."""

    @F.arrow_udf(returnType=RESULT_DDL)
    def without(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        unpacker = zstandard.ZstdDecompressor()
        for bodies, lists in batches:
            rows = []
            for body, some in zip(bodies, lists):
                text = unpacker.decompress(body.as_py()) if body.is_valid else b""
                spans = merged([(s["start"], s["stop"]) for s in some.as_py() or []])
                edges = [0] + [x for span in spans for x in span] + [len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                rows.append((len(text), len(text) - len(kept), len(spans), [{"start": a, "stop": b} for a, b in spans], kept))
            yield pa.StructArray.from_arrays(
                [pa.array([r[i] for r in rows], RESULT.field(i).type) for i in range(len(RESULT))], fields=list(RESULT))

    return without.asNondeterministic()(squeezed, stretches)


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", out: str = "dedup",
                   settings: Settings = Settings()) -> DataFrame:
    """`docs` with a struct column `out` in place of `text`: n_bytes, n_removed, n_spans, spans and kept (binary)."""
    stretches = repeats(docs, doc_id, text, settings).groupBy("r1", "r2").agg(
        F.collect_set(F.struct("start", "stop")).alias("_stretches"))
    r1, r2 = _rows_of(doc_id, text)
    others = docs.drop(text)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in others.columns]).alias("_row"), r1, r2,
        _squeezed(F.col(text).cast("binary")).alias("_squeezed"))
    joined = rows.join(stretches, ["r1", "r2"], "left")
    return unboxed(joined, others.columns, **{out: _without(F.col("_squeezed"), F.col("_stretches"))})
