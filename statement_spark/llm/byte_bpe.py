"""Byte-level BPE token ids and back, by the tiktoken library and a local rank file.

`encode` puts the ids of a text into a binary column, little-endian unsigned 32-bit numbers; `decode` turns such a column
into the bytes the ids stand for. No text column is made of them: a cut sequence may end inside a character.

The split pattern gives matches that are merged each by itself, so a long text may be cut wherever a match must end.
Texts over `segment_chars` are cut at the first such place behind every `segment_chars` characters: between a character
and white space, before the last of several white spaces, and where letters, digits and punctuation meet. Only
characters are used whose class every Unicode version agrees on. Runs of white space of `RUN` and more, on which the
library's pattern matching overflows its stack, are merged as the single match they are.

Null and empty texts have no ids; null ids decode to null, ids that the vocabulary lacks and cut numbers too. Repeated rows
are encoded as often as they come. Nothing is shuffled; a task holds one batch of rows and the vocabulary.
"""
from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F

from statement_spark.llm.common import boxed, octets, unboxed

SEGMENT_CHARS = 1 << 16
RUN = 4096

# White space of Unicode; letters, digits and punctuation of old standing (the apostrophe apart, which may
# begin a match that goes on with letters).
BLANK = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LETTER = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u017f\u0410-\u044f\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3"
DIGIT = "0-9"
MARK = "!-&(-/:-@\\[-`{-~\u3001\u3002\uff01\uff0c\uff1a\uff1b\uff1f"

MATCH_ENDS = re.compile(
    f"(?<=[^{BLANK}])(?=[{BLANK}])|(?<=[{BLANK}])(?=[{BLANK}][^{BLANK}])"
    f"|(?<=[{LETTER}])(?=[{DIGIT}{MARK}'])|(?<=[{DIGIT}])(?=[{LETTER}{MARK}'])|(?<=[{MARK}])(?=[{LETTER}{DIGIT}])")
LONG_BLANK = re.compile(f"[{BLANK}]{{{RUN},}}(?![^{BLANK}])")


def segments(text: str, segment_chars: int = SEGMENT_CHARS) -> Iterator[tuple[str, bool]]:
    """Parts of a text that can be encoded one by one, and whether a part is one single match."""
    at = 0
    for run in LONG_BLANK.finditer(text):
        yield from ((part, False) for part in _cut(text, at, run.start(), segment_chars))
        yield run.group(), True
        at = run.end()
    yield from ((part, False) for part in _cut(text, at, len(text), segment_chars))


def _cut(text: str, at: int, end: int, segment_chars: int) -> Iterator[str]:
    while end - at > segment_chars:
        place = MATCH_ENDS.search(text, at + segment_chars, end)
        if place is None:
            break
        yield text[at:place.start()]
        at = place.start()
    if at < end:
        yield text[at:end]


class Vocabulary:
    """The ids of a rank file under a split pattern."""

    def __init__(self, rank_file: str, pattern: str):
        with open(rank_file, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.split = tiktoken.Encoding("split", pat_str=pattern, mergeable_ranks=self.ranks, special_tokens={})

    @cached_property
    def whole(self) -> tiktoken.Encoding:
        """For what is one match by itself; few texts need it."""
        return tiktoken.Encoding("whole", pat_str=r"[\s\S]+", mergeable_ranks=self.ranks, special_tokens={})

    def encode(self, text: str, segment_chars: int = SEGMENT_CHARS) -> bytes:
        parts = [(text, False)] if len(text) <= RUN else segments(text, segment_chars)
        ids = ((self.whole if single else self.split).encode_to_numpy(part, disallowed_special=()) for part, single in parts if part)
        return b"".join(i.astype("<u4").tobytes() for i in ids)

    def decode(self, ids: bytes) -> bytes | None:
        if len(ids) % 4:
            return None
        try:
            return self.split.decode_bytes(np.frombuffer(ids, "<u4").tolist())
        except KeyError:
            return None


@lru_cache(maxsize=2)
def vocabulary(rank_file: str, pattern: str) -> Vocabulary:
    """One for all tasks that a Python worker runs."""
    return Vocabulary(rank_file, pattern)


def _with(rows: DataFrame, source, result: str, function) -> DataFrame:
    held = boxed(rows, _in=source).withColumn("_out", function("_in"))
    return unboxed(held, rows.columns, **{result: F.col("_out")})


def encode(docs: DataFrame, rank_file: str, pattern: str, text: str = "text", ids: str = "ids",
           segment_chars: int = SEGMENT_CHARS) -> DataFrame:
    """`docs` with the ids of each text; a column of that name is replaced. Every executor needs the rank file at its path."""

    @F.arrow_udf(returnType="binary")
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = vocabulary(rank_file, pattern)
        for batch in batches:
            bodies = (v.as_py() or b"" for v in batch)
            yield pa.array([own.encode(body.decode("utf-8", "replace"), segment_chars) for body in bodies], pa.binary())

    return _with(docs, octets(text), ids, encoded)


def decode(rows: DataFrame, rank_file: str, pattern: str, ids: str = "ids", body: str = "decoded") -> DataFrame:
    """`rows` with the bytes that the ids of each row stand for; a column of that name is replaced."""

    @F.arrow_udf(returnType="binary")
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = vocabulary(rank_file, pattern)
        for batch in batches:
            yield pa.array([None if (ids := v.as_py()) is None else own.decode(ids) for v in batch], pa.binary())

    return _with(rows, F.col(f"`{ids}`"), body, decoded)
