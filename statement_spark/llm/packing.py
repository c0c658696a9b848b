"""Hierarchical multi-length packing of token sequences.

Windows come in several lengths (tiers), each a power of two. A document is routed to the shortest tier that holds it;
of one longer than the longest tier, whole windows are cut off first and the rest is routed by its own length. Tiers are
packed from the longest to the shortest: a window starts with a piece of its tier, and its gap is filled from shorter
tiers, whole pieces first, then the front of a piece cut to fit. So every window is filled exactly. What can't fill a
window at the end of a task's rows is cut into windows of smaller powers of two, which need no padding either.

Full windows are dealt to step groups by tier, `step_tokens` tokens each, so that all groups of a tier cost the same.

Packing runs within each input partition, on blocks of rows with the unfilled rest carried to the next block: memory is
bounded by `block_tokens` and one document, nothing is shuffled, and a task that is run again gives the same pieces.
Sequence ids carry the partition's number. Null and empty texts are the end id alone; repeated rows are packed as often
as they come; an empty table gives no rows.
"""
from __future__ import annotations

import base64
import json
import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

END = bytes(4)
# Fixed value: how the byte-level vocabulary splits text before its merges.
PARTS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@dataclass(frozen=True)
class Settings:
    ranks_file: str
    tiers: tuple[int, ...] = (128, 256, 512, 1024)
    step_tokens: int = 1 << 16
    block_tokens: int = 1 << 21


class Encoder:
    """Token ids of a byte-level vocabulary as little-endian bytes, with the end id 0 behind them.

    The ranks file of a vocabulary gives the same ids as its merges file, several times as fast. Added tokens stand in the
    merges file alone, which lies beside it under the same name; their strings in a text get their ids.
    """

    def __init__(self, ranks_file: str):
        with open(ranks_file, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        with open(ranks_file.removesuffix(".tiktoken") + ".json", encoding="utf-8") as merges:
            added = {token["content"]: token["id"] for token in json.load(merges)["added_tokens"]}
        self.model = tiktoken.Encoding("own", pat_str=PARTS, mergeable_ranks=ranks, special_tokens=added)

    def __call__(self, text: str | None) -> bytes:
        return self.model.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes() + END if text else END


@lru_cache(maxsize=1)
def encoder(ranks_file: str) -> Encoder:
    """One for all tasks that a Python worker runs."""
    return Encoder(ranks_file)


@dataclass(slots=True)
class Piece:
    doc: int
    start: int
    ids: memoryview
    total: int

    @property
    def length(self) -> int:
        return len(self.ids) // 4

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return (Piece(self.doc, self.start, self.ids[:4 * n], self.total),
                Piece(self.doc, self.start + n, self.ids[4 * n:], self.total))


class Packer:
    """Windows of one task. `add` takes a document's ids, `filled` and `rest` give lists of pieces, a list a window."""

    def __init__(self, tiers: tuple[int, ...]):
        if not tiers or any(t & (t - 1) or t < 1 for t in tiers) or list(tiers) != sorted(set(tiers)):
            raise ValueError("tiers are ascending powers of two")
        self.tiers = tiers
        self.waiting: list[deque[Piece]] = [deque() for _ in tiers]
        self.whole: list[list[Piece]] = []
        self.tokens = 0

    def add(self, doc: int, ids: bytes) -> None:
        piece, top = Piece(doc, 0, memoryview(ids), len(ids) // 4), self.tiers[-1]
        self.tokens += piece.length
        while piece.length >= top:
            window, piece = piece.cut(top)
            self.whole.append([window])
        self.route(piece)

    def route(self, piece: Piece, front: bool = False) -> None:
        if piece.length:
            queue = self.waiting[next(i for i, t in enumerate(self.tiers) if t >= piece.length)]
            queue.appendleft(piece) if front else queue.append(piece)

    def _fill(self, tier: int, room: int) -> list[Piece]:
        """Pieces for a gap: whole ones of shorter tiers, longest tier first, then the front of one."""
        found = []
        for queue in reversed(self.waiting[:tier]):
            while queue and queue[0].length <= room:
                found.append(queue.popleft())
                room -= found[-1].length
        if room:
            queue = next((q for q in self.waiting[:tier + 1] if q), None) or next((q for q in self.waiting[tier + 1:] if q), None)
            if queue:
                piece = queue.popleft()
                if piece.length > room:
                    front, back = piece.cut(room)
                    self.route(back, front=True)
                    piece = front
                found.append(piece)
                if piece.length < room:
                    found += self._fill(tier, room - piece.length)
        return found

    def filled(self) -> Iterator[list[Piece]]:
        """All windows that what waits can fill; the rest goes on waiting."""
        for window in self.whole:
            yield window
        self.whole = []
        for tier in reversed(range(len(self.tiers))):
            size = self.tiers[tier]
            while self.waiting[tier]:
                window = [self.waiting[tier].popleft()]
                window += self._fill(tier, size - window[0].length)
                if sum(p.length for p in window) < size:
                    for piece in window:
                        self.route(piece)
                    self.tokens = sum(p.length for queue in self.waiting for p in queue)
                    return
                yield window
        self.tokens = 0

    def rest(self) -> Iterator[list[Piece]]:
        """What waits at the end, in windows of the powers of two that its tokens add up to."""
        pieces = deque(piece for queue in reversed(self.waiting) for piece in queue)
        self.waiting = [deque() for _ in self.tiers]
        left = sum(p.length for p in pieces)
        while left:
            size, window = min(1 << (left.bit_length() - 1), self.tiers[-1]), []
            left -= size
            while size:
                piece = pieces.popleft()
                if piece.length > size:
                    piece, back = piece.cut(size)
                    pieces.appendleft(back)
                window.append(piece)
                size -= piece.length
            yield window


def pack(docs: DataFrame, settings: Settings, doc_id: str = "doc_id", text: str = "text", with_ids: bool = True) -> DataFrame:
    """A row for every piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, step_group and,
    if asked for, ids."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    long = T.LongType()
    fields = [T.StructField("doc_id", rows.schema["doc_id"].dataType)] + [
        T.StructField(name, long)
        for name in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_group")]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = encoder(settings.ranks_file), Packer(settings.tiers)
        base = TaskContext.get().partitionId() << 33
        names: dict[int, object] = {}
        state = {"docs": 0, "sequence": 0}
        steps: dict[int, tuple[int, int]] = {}  # by tier: its open group and the tokens there
        groups = 0
        kind = None

        def written(windows: Iterator[list[Piece]]) -> pa.RecordBatch:
            nonlocal groups
            columns: list[list] = [[] for _ in fields]
            for window in windows:
                size = sum(p.length for p in window)
                group, there = steps.get(size, (-1, settings.step_tokens))
                if there + size > settings.step_tokens:
                    group, there, groups = groups, 0, groups + 1
                steps[size] = (group, there + size)
                at = 0
                for p in window:
                    row = (names[p.doc], p.start, p.length, zlib.crc32(p.ids), p.total, base + state["sequence"], at, size, base + group)
                    for column, value in zip(columns, (*row, np.frombuffer(p.ids, "<i4")) if with_ids else row):
                        column.append(value)
                    at += p.length
                state["sequence"] += 1
            waiting = {p.doc for queue in packer.waiting for p in queue}
            for doc in [d for d in names if d not in waiting]:
                del names[doc]
            types = [kind, *[pa.int64()] * 8] + [pa.list_(pa.int32())] * with_ids
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [f.name for f in fields])

        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for name, body in zip(batch.column("doc_id"), batch.column("text")):
                names[state["docs"]] = name.as_py()
                packer.add(state["docs"], encode(body.as_py()))
                state["docs"] += 1
                if packer.tokens >= settings.block_tokens:
                    yield written(packer.filled())
        if kind is not None:
            yield written(packer.filled())
            yield written(packer.rest())

    return rows.mapInArrow(run, T.StructType(fields))
