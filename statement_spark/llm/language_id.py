"""Language identification by compression.

For every language a raw-content zstandard dictionary is cut from its training texts. A text is compressed with each
dictionary, chunk by chunk; the language whose dictionary gives the fewest bytes is chosen, and the choice is rejected
where the runner-up comes within `min_margin` bytes a byte. Letters only are compressed, in lower case, so that digits,
marks and capitals do not weigh.

Learning reads a bounded, documented sample: `sample_docs` distinct texts of each language, a slice of `slice_bytes`
from each, chosen by a hash of the text. Predictions read whole texts and nothing but the text. A text that is null or
has no letter gives `und` with score 0. Ties go to the language with more training documents, then to the first by name.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F

from statement_spark.llm.common import octets

NOT_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")  # marks belong to their letters, number signs are none
LETTER = regex.compile(r"\p{L}")
MAX_LANGUAGES = 400
RESULT_DDL = "struct<lang:string,runner_up:string,margin:double,score:double,rejected:boolean>"
RESULT = pa.struct([
    ("lang", pa.string()), ("runner_up", pa.string()), ("margin", pa.float64()), ("score", pa.float64()),
    ("rejected", pa.bool_()),
])


@dataclass(frozen=True)
class Settings:
    sample_docs: int = 512
    slice_bytes: int = 128
    chunk_bytes: int = 4096
    level: int = 6
    min_margin: float = 0.01
    margin_scale: float = 0.03


@dataclass(frozen=True)
class Model:
    """Languages with their dictionaries, most frequent language first."""

    dictionaries: tuple[tuple[str, bytes], ...]
    settings: Settings


def letters(text: str) -> str:
    """The letters of a text with their marks, in lower case; nothing if there are marks alone."""
    found = NOT_LETTERS.sub(" ", text.lower()).strip()
    return found if LETTER.search(found) else ""


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", train: Column | None = None,
        settings: Settings = Settings()) -> Model:
    """Learns from rows with text and language (and `train`). Languages and their different texts are counted first; then
    about four times the texts needed are picked by their hash, which bounds what is sorted and collected whatever the size
    of the table and however often a text is copied."""
    rows = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull() & (F.lit(True) if train is None else train))
    by_text = rows.groupBy(F.col(lang).alias("lang"), F.xxhash64(F.col(text)).alias("digest")).agg(F.count(F.lit(1)).alias("n"))
    languages = by_text.groupBy("lang").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts")).orderBy(
        F.desc("n")).limit(MAX_LANGUAGES + 1).collect()
    counts, texts = {r["lang"]: r["n"] for r in languages}, {r["lang"]: r["texts"] for r in languages}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"over {MAX_LANGUAGES} languages; so many dictionaries are not held at a time")
    digest = F.xxhash64(F.col(text))
    # three slices' length leaves enough once marks are gone
    room = F.greatest(F.char_length(F.col(text)) - 3 * settings.slice_bytes, F.lit(1))
    at = (F.pmod(digest, room.cast("long")) + 1).cast("int")
    picks = F.create_map(*[F.lit(v) for name, n in texts.items() for v in (name, min(1.0, 4 * settings.sample_docs / n))]) \
        if counts else F.create_map(F.lit(""), F.lit(0.0))
    wanted = F.pmod(digest, F.lit(1 << 30)) < picks[F.col(lang)] * (1 << 30)
    pieces = rows.where(wanted).groupBy(F.col(lang).alias("lang"), digest.alias("digest")).agg(
        F.min(F.substring(F.col(text), at, F.lit(3 * settings.slice_bytes))).alias("piece"))
    first = Window.partitionBy("lang").orderBy("digest")
    sample = pieces.withColumn("place", F.row_number().over(first)).where(F.col("place") <= settings.sample_docs).collect()
    cut: dict[str, list[bytes]] = {name: [] for name in counts}
    for row in sorted(sample, key=lambda r: (r["lang"], r["digest"])):
        cut[row["lang"]].append(letters(row["piece"]).encode()[: settings.slice_bytes].decode(errors="ignore").encode())
    ranked = sorted(counts, key=lambda name: (-counts[name], name))
    return Model(tuple((name, b" ".join(cut[name])) for name in ranked), settings)


class Scorer:
    """Compressors of one task."""

    def __init__(self, model: Model):
        self.settings = model.settings
        self.names = [name for name, _ in model.dictionaries]
        self.packers = []
        params = zstandard.ZstdCompressionParameters.from_level(
            model.settings.level, write_content_size=False, write_checksum=False, write_dict_id=False)
        for _, content in model.dictionaries:
            if len(content) >= 8:
                words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                words.precompute_compress(compression_params=params)
                self.packers.append(zstandard.ZstdCompressor(compression_params=params, dict_data=words))
            else:
                self.packers.append(zstandard.ZstdCompressor(compression_params=params))

    def sizes(self, body: bytes) -> list[int]:
        step = self.settings.chunk_bytes
        chunks = [body[i:i + step] for i in range(0, len(body), step)]
        return [sum(len(packer.compress(c)) for c in chunks) for packer in self.packers]

    def judge(self, text: bytes | None) -> tuple[str, str | None, float, float, bool]:
        body = letters(text.decode("utf-8", "replace")).encode() if text else b""
        if not body or not self.names:
            return "und", None, 0.0, 0.0, True
        sizes = self.sizes(body)
        ranked = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))
        best = ranked[0]
        if len(ranked) == 1:
            return self.names[best], None, 0.0, 0.5, True
        margin = (sizes[ranked[1]] - sizes[best]) / len(body)
        score = 1 - 0.5 * math.exp(-margin / self.settings.margin_scale)
        return self.names[best], self.names[ranked[1]], margin, score, margin < self.settings.min_margin


def identify(docs: DataFrame, model: Model, text: str = "text", out: str = "language") -> DataFrame:
    """`docs` with a struct column `out` (in place of one of that name); one pass, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded: MAX_LANGUAGES dictionaries of a fixed length

    @F.arrow_udf(returnType=RESULT_DDL)
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(shared.value)
        for batch in batches:
            rows = [scorer.judge(value.as_py()) for value in batch]
            yield pa.StructArray.from_arrays(
                [pa.array([r[i] for r in rows], RESULT.field(i).type) for i in range(len(RESULT))], fields=list(RESULT))

    return docs.withColumn(out, predict.asNondeterministic()(octets(text)))
