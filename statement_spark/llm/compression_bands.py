"""Quality rules on compressibility: zstandard ratios of whole documents and of fixed chunks.

Repetitive text compresses far better than prose and random text hardly at all. How far prose compresses depends
on its length, so limits are a curve over it: `fit` takes the ratios of a table's distinct texts that pass the base rules by
length class, and sets limits around their medians. A document is rejected if its whole-text ratio leaves the limits of its
length, or if chunks outside the limits of theirs hold more than `max_bad_share` of its bytes; the chunks see a document
that is half prose and half filler, which the whole-text ratio averages out. Chunks cover the whole text: what is left
behind the last full one is judged too, by its own length, and counts with its bytes. Texts under `chunked_from` have none.

Null and empty texts have no words and fail the base rules; texts under `least_bytes` have no whole-text
band, since a frame's header outweighs them. Repeated rows are judged alike, each on its own text.
"""
from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from statement_spark.llm.common import BLANKS, octets

SYMBOLS = b"#*$%&|<>"
CONTINUATION_BYTES = bytes(range(0x80, 0xC0))

RESULT = pa.struct([
    ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
    ("n_repeat_words", pa.int64()), ("whole_ratio", pa.float64()), ("bad_chunk_share", pa.float64()),
    ("base_failed", pa.bool_()), ("verdict", pa.string()), ("kept", pa.bool_()),
])
RESULT_DDL = (
    "struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint,"
    "whole_ratio:double,bad_chunk_share:double,base_failed:boolean,verdict:string,kept:boolean>"
)


# Length classes are half octaves; a class sets limits of its own if it has so many distinct texts.
LEAST_TEXTS = 200


def limits(median: float, high_quantile: float) -> tuple[float, float]:
    """Lowest and highest ratio around a class's median; the wider the ratios spread, the higher the highest, within bounds."""
    spread = high_quantile / median - 1
    return 0.86 * median, (1 + min(0.18, max(0.08, 4 * spread))) * median


@dataclass(frozen=True)
class Bands:
    """`classes`: (length in bytes, median ratio, its 95 % quantile), ascending; limits between them follow the length's
    logarithm. As they stand they are those of 8884 documents in four languages."""

    classes: tuple[tuple[float, float, float], ...] = (
        (304, 0.643, 0.711), (431, 0.626, 0.686), (609, 0.592, 0.643), (861, 0.551, 0.589), (1218, 0.521, 0.547), (1722, 0.502, 0.522),
        (2435, 0.484, 0.499), (3444, 0.471, 0.483), (4871, 0.458, 0.466), (6889, 0.449, 0.457), (9742, 0.441, 0.447),
        (13777, 0.431, 0.439), (19484, 0.417, 0.428),
    )
    least_bytes: int = 256
    chunk_bytes: int = 4096
    short_chunk_bytes: int = 512  # of texts too short for two chunks
    chunked_from: int = 1024
    chunk_slack: float = 0.93  # chunks of clean text go lower than whole texts of their length
    max_bad_share: float = 0.30
    fall: float = 0.06
    level: int = 3
    min_words: int = 50

    def of(self, n_bytes: int) -> tuple[float, float] | None:
        if n_bytes < self.least_bytes:
            return None
        bounds = [limits(median, high) for _, median, high in self.classes]
        lengths = [math.log2(length) for length, _, _ in self.classes]
        low, high = (float(np.interp(math.log2(n_bytes), lengths, side)) for side in zip(*bounds))
        return low * (1 - self.fall) ** max(0.0, math.log2(n_bytes) - lengths[-1]), high


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """Words, their code points, symbols, repeated lines and words in repeated three-word windows."""
    words = text.split()
    visible = text.translate(None, BLANKS)
    lines = [line for line in text.split(b"\n") if line.strip()]
    windows = list(zip(words, words[1:], words[2:]))
    repeat_words = 0
    if len(set(windows)) < len(windows):
        counts = Counter(windows)
        covered_to = 0
        for start, window in enumerate(windows):
            if counts[window] > 1:
                repeat_words += start + 3 - max(start, covered_to)
                covered_to = start + 3
    return (
        len(words), len(visible.translate(None, CONTINUATION_BYTES)), len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)), repeat_words,
    )


def band_verdict(text: bytes, bands: Bands, packer: zstandard.ZstdCompressor) -> tuple[float | None, float, str]:
    """Ratio of the whole text, share of bytes in bad chunks, and why it goes ('ok' if it stays)."""
    if not text:
        return None, 0.0, "ok"
    ratio = len(packer.compress(text)) / len(text)
    bad = 0
    if len(text) >= bands.chunked_from:
        step = bands.chunk_bytes if len(text) >= 2 * bands.chunk_bytes else bands.short_chunk_bytes
        limits_of_full = bands.of(step)
        for start in range(0, len(text), step):
            n = min(step, len(text) - start)
            part = text[start:start + n] if n >= bands.least_bytes else text[-bands.least_bytes:]
            low, high = limits_of_full if n == step else bands.of(len(part))
            bad += n * (not bands.chunk_slack * low <= len(packer.compress(part)) / len(part) <= high)
    bad_share = bad / len(text)
    band = bands.of(len(text))
    if bands.max_bad_share < bad_share < 1:  # part of the text; a text bad throughout is named by its whole ratio
        return ratio, bad_share, "bad_chunks"
    if band and ratio < band[0]:
        return ratio, bad_share, "repetitive"
    if band and ratio > band[1]:
        return ratio, bad_share, "incompressible"
    return ratio, bad_share, "bad_chunks" if bad_share > bands.max_bad_share else "ok"


def _base_failed(counts: tuple[int, int, int, int, int], bands: Bands) -> bool:
    return counts[0] < bands.min_words or 100 * counts[4] > 50 * counts[0]


def fit(docs: DataFrame, text: str = "text", bands: Bands = Bands(), least_texts: int = LEAST_TEXTS) -> Bands:
    """`bands` with the classes of the distinct texts of `docs`; a class of fewer than `least_texts` stays as it is."""

    @F.arrow_udf(returnType="double")
    def ratios(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        packer = zstandard.ZstdCompressor(level=bands.level)
        for batch in batches:
            bodies = [v.as_py() or b"" for v in batch]
            yield pa.array([
                len(packer.compress(b)) / len(b) if len(b) >= bands.least_bytes and not _base_failed(base_counts(b), bands) else None
                for b in bodies], pa.float64())

    body = octets(text)
    measured = docs.select(F.octet_length(body).alias("n"), F.xxhash64(body).alias("h"), ratios.asNondeterministic()(body).alias("ratio"))
    by_text = measured.where("ratio IS NOT NULL").distinct()
    found = by_text.groupBy(F.floor(2 * F.log2("n")).alias("class")).agg(
        F.percentile_approx("ratio", [0.5, 0.95], 10_000).alias("q"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_texts)
    known = {math.floor(2 * math.log2(length)): (length, median, high) for length, median, high in bands.classes}
    own = {r["class"]: (2 ** ((r["class"] + 0.5) / 2), *r["q"]) for r in found.collect()}
    return replace(bands, classes=tuple(v for _, v in sorted((known | own).items())))


def judge(docs: DataFrame, text: str = "text", out: str = "quality", bands: Bands = Bands()) -> DataFrame:
    """`docs` with a struct column `out` (in place of one of that name): counts, ratios and the verdict; no shuffle."""

    @F.arrow_udf(returnType=RESULT_DDL)
    def rules(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        packer = zstandard.ZstdCompressor(level=bands.level)
        for batch in batches:
            rows = []
            for value in batch:
                body = value.as_py() or b""
                counts = base_counts(body)
                failed = _base_failed(counts, bands)
                ratio, bad_share, verdict = band_verdict(body, bands, packer)
                rows.append((*counts, ratio, bad_share, failed, verdict, not failed and verdict == "ok"))
            yield pa.StructArray.from_arrays(
                [pa.array([r[i] for r in rows], RESULT.field(i).type) for i in range(len(RESULT))], fields=list(RESULT)
            )

    return docs.withColumn(out, rules.asNondeterministic()(octets(text)))


def keep(docs: DataFrame, text: str = "text", bands: Bands = Bands()) -> DataFrame:
    """The rows of `docs` that pass, with their columns as they were."""
    out = "_quality"
    while out in docs.columns:
        out += "_"
    return judge(docs, text, out, bands).where(f"`{out}`.kept").drop(out)
