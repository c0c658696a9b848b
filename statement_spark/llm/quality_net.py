"""Quality classifier: random-indexing word vectors, pooled per document, under a two-layer network.

Every word owns a sparse random index vector drawn from its hash. Its word vector is its own index vector plus those of
its neighbours in the training sample, so that words used alike point alike. A document is the mean of its word vectors.
Besides words, a document's stream holds marker words: for marks, capitals and digits, for words met before in the
document, and for lines met before. A network with one hidden layer is trained on the pooled vectors in numpy, and its
logits are divided by a temperature fitted on a validation part, so that scores are probabilities.

Learning reads the whole texts of at most `sample_docs` labelled documents, chosen by a hash of the id. Their neighbours are
summed up by bucket in tasks, as whole numbers, and their texts are pooled there; the driver gets the buckets' sums and a vector per
text, whatever the texts' length. Scores read whole texts and nothing but the text. Null and empty texts have the
zero vector and get the network's score for it. Labels that are null or not 0/1 are not learned from; without labels
of both kinds every score is the share of label 1 (one half without any). Repeated labels of a document count each.
"""
from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from statement_spark.llm.common import octets
from statement_spark.session import staged

LETTERS = re.compile(r"[^\W\d_]+")
OTHERS = re.compile(r"[^\w\s]|_")


@dataclass(frozen=True)
class Settings:
    sample_docs: int = 6000
    parts: int = 8
    buckets: int = 1 << 14
    dim: int = 96
    ones: int = 6
    window: int = 2
    hidden: int = 32
    rounds: int = 400
    rate: float = 0.01
    decay: float = 1e-4
    seed: int = 7


@dataclass
class Model:
    settings: Settings
    vectors: np.ndarray
    first: tuple[np.ndarray, np.ndarray]
    second: tuple[np.ndarray, float]
    temperature: float
    mean: np.ndarray
    spread: np.ndarray
    constant: float | None = None


class Words(dict):
    """Bucket numbers of a token's parts, worked out once a task; emptied when it has grown large."""

    LIMIT = 200_000

    def __init__(self, buckets: int):
        self.buckets = buckets

    def bucket(self, part: str) -> int:
        return zlib.crc32(part.encode("utf-8", "surrogatepass")) % self.buckets

    def __missing__(self, token: str) -> tuple[int, ...]:
        if len(self) >= self.LIMIT:
            self.clear()
        parts = LETTERS.findall(token)
        found = [part.lower() for part in parts]
        found += ["<capitals>" for part in parts if len(part) > 1 and part.isupper()]
        found += [f"<mark {mark}>" for mark in OTHERS.findall(token)]
        found += ["<digits>"] if any(c.isdigit() for c in token) else []
        self[token] = out = tuple(self.bucket(part) for part in found)
        return out


def stream(text: str, words: Words) -> list[int]:
    """Bucket numbers of a text's words and markers in order."""
    out: list[int] = []
    again, seen_line, seen = words.bucket("<again>"), words.bucket("<line again>"), set()
    lines = set()
    for line in text.split("\n"):
        tokens = line.split()
        if not tokens:
            continue
        if line in lines:
            out.extend([seen_line] * len(tokens))
        lines.add(line)
        for token in tokens:
            out.extend(words[token])
            if len(token) > 5 and token in seen:
                out.append(again)
            seen.add(token)
    return out


def _index_vectors(settings: Settings) -> np.ndarray:
    rng = np.random.default_rng(settings.seed)
    vectors = np.zeros((settings.buckets, settings.dim), np.int32)
    places = rng.integers(0, settings.dim, (settings.buckets, settings.ones))
    signs = rng.choice(np.array([-1, 1], np.int32), (settings.buckets, settings.ones))
    np.add.at(vectors, (np.arange(settings.buckets)[:, None], places), signs)
    return vectors


SUMMED_PAIRS = 1 << 18
BLOCK = 256


def add_neighbours(near: np.ndarray, ids: np.ndarray, index: np.ndarray, settings: Settings) -> None:
    """Adds to each bucket's row the index vectors of the words within the window around its words in a text."""
    for step in range(1, settings.window + 1):
        for own, other in ((ids[:-step], ids[step:]), (ids[step:], ids[:-step])):
            kinds, counts = np.unique(own * np.int64(settings.buckets) + other, return_counts=True)
            for at in range(0, len(kinds), SUMMED_PAIRS):
                some = kinds[at:at + SUMMED_PAIRS]
                rows = some // settings.buckets  # ascending
                starts = np.flatnonzero(np.diff(rows, prepend=-1))
                near[rows[starts]] += np.add.reduceat(index[some % settings.buckets] * counts[at:at + SUMMED_PAIRS, None], starts, axis=0)


def word_vectors(near: np.ndarray, settings: Settings) -> np.ndarray:
    """Own index vector plus the mean of the neighbours', each of unit length."""
    index = _index_vectors(settings).astype(np.float32)
    norm = np.linalg.norm(near, axis=1, keepdims=True)
    near = np.divide(near, norm, out=np.zeros(near.shape), where=norm > 0)
    own = index / np.maximum(np.linalg.norm(index, axis=1, keepdims=True), 1e-9)
    return (own + 0.5 * near).astype(np.float32)


def neighbour_sums(bodies: DataFrame, settings: Settings) -> np.ndarray:
    """The neighbours' sums of all buckets over the texts (body): partial sums by task, added up by block of buckets."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near, index, words = np.zeros((settings.buckets, settings.dim), np.int64), _index_vectors(settings), Words(settings.buckets)
        for batch in batches:
            for body in batch.column("body"):
                ids = np.array(stream((body.as_py() or b"").decode("utf-8", "replace"), words), np.int64)
                if len(ids) > settings.window:
                    add_neighbours(near, ids, index, settings)
        blocks = range(0, settings.buckets, BLOCK)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(blocks), pa.int32()), pa.array([near[b:b + BLOCK].tobytes() for b in blocks], pa.binary())], ["block", "sums"])

    def added(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(v.as_py(), np.int64) for v in table.column("sums"))
        return pa.table({"block": table.column("block").slice(0, 1), "sums": pa.array([total.tobytes()], pa.binary())})

    schema = "block int, sums binary"
    rows = bodies.select("body").mapInArrow(partial, schema).groupBy("block").applyInArrow(added, schema).collect()
    near = np.zeros((settings.buckets, settings.dim), np.int64)
    for row in rows:
        near[row["block"]:row["block"] + BLOCK] = np.frombuffer(row["sums"], np.int64).reshape(-1, settings.dim)
    return near


def pooled_texts(bodies: DataFrame, vectors: np.ndarray, settings: Settings) -> DataFrame:
    """(id, y, h, features) of the texts (id, y, h, body)."""
    shared = bodies.sparkSession.sparkContext.broadcast(vectors)  # bounded: buckets x dim numbers

    @F.arrow_udf(returnType="array<float>")
    def features(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words = Words(settings.buckets)
        for batch in batches:
            texts = ((v.as_py() or b"").decode("utf-8", "replace") for v in batch)
            yield pa.array([pooled(stream(text, words), shared.value) for text in texts], pa.list_(pa.float32()))

    return bodies.select("id", "y", "h", features.asNondeterministic()("body").alias("features"))


def pooled(ids: list[int] | np.ndarray, vectors: np.ndarray) -> np.ndarray:
    if not len(ids):
        return np.zeros(vectors.shape[1], np.float32)
    kinds, counts = np.unique(np.asarray(ids, np.int64), return_counts=True)
    return (counts.astype(np.float32) / counts.sum()) @ vectors[kinds]


def _forward(x: np.ndarray, model: Model) -> np.ndarray:
    hidden = np.tanh(x @ model.first[0] + model.first[1])
    return hidden @ model.second[0] + model.second[1]


def train(features: np.ndarray, labels: np.ndarray, vectors: np.ndarray, settings: Settings) -> Model:
    """Full-batch Adam; the weights with the least validation loss are kept, then the temperature is fitted there."""
    rng = np.random.default_rng(settings.seed)
    mean, spread = features.mean(axis=0), features.std(axis=0) + 1e-3
    x, y = ((features - mean) / spread).astype(np.float64), labels.astype(np.float64)
    part = rng.permutation(len(y))
    held, used = part[: max(1, len(y) // 5)], part[max(1, len(y) // 5):]
    weights = [
        rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], settings.hidden)), np.zeros(settings.hidden),
        rng.normal(0, 1 / np.sqrt(settings.hidden), settings.hidden), np.zeros(1),
    ]
    moment, square = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    best, kept = np.inf, [w.copy() for w in weights]
    for turn in range(1, settings.rounds + 1):
        hidden = np.tanh(x[used] @ weights[0] + weights[1])
        wrong = (1 / (1 + np.exp(-(hidden @ weights[2] + weights[3][0]))) - y[used]) / len(used)
        back = np.outer(wrong, weights[2]) * (1 - hidden**2)
        slopes = [x[used].T @ back + settings.decay * weights[0], back.sum(axis=0), hidden.T @ wrong + settings.decay * weights[2],
                  np.array([wrong.sum()])]
        for w, g, m, s in zip(weights, slopes, moment, square):
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            w -= settings.rate * (m / (1 - 0.9**turn)) / (np.sqrt(s / (1 - 0.999**turn)) + 1e-8)
        logits = np.tanh(x[held] @ weights[0] + weights[1]) @ weights[2] + weights[3][0]
        loss = np.mean(np.logaddexp(0, logits) - y[held] * logits)
        if loss < best:
            best, kept = loss, [w.copy() for w in weights]
    model = Model(settings, vectors, (kept[0], kept[1]), (kept[2], float(kept[3][0])), 1.0, mean, spread)
    logits = _forward(x[held], model)
    model.temperature = float(min(
        np.geomspace(0.25, 8, 41), key=lambda t: np.mean(np.logaddexp(0, logits / t) - y[held] * logits / t)))
    return model


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
        learn: Column | None = None, settings: Settings = Settings()) -> Model:
    """Learns from the labelled rows of `labels` (restricted by `learn`) and their documents' texts."""
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y")).where(F.col("y").isin(0, 1))
    if learn is not None:
        known = known.where(learn)
    chosen = known.orderBy(F.xxhash64("id"), "id", "y").limit(settings.sample_docs)
    texts = docs.select(F.col(doc_id).alias("id"), octets(text).alias("body")).where("body is not null")
    bodies = staged(texts.join(F.broadcast(chosen), "id").withColumn("h", F.xxhash64("body")).repartition(settings.parts), "sample")
    seen = bodies.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = {r["y"]: r["n"] for r in seen}
    if sum(counts.values()) < 10 or len(counts) < 2:
        empty = np.zeros((settings.buckets, settings.dim), np.float32)
        none = np.zeros(settings.dim)
        share = counts.get(1, 0) / sum(counts.values()) if counts else 0.5
        return Model(settings, empty, (empty[:0], none), (none, 0.0), 1.0, none, none, share)
    vectors = word_vectors(neighbour_sums(bodies, settings), settings)
    rows = pooled_texts(bodies, vectors, settings).orderBy("id", "y", "h").limit(settings.sample_docs).collect()
    return train(np.array([r["features"] for r in rows], np.float32), np.array([r["y"] for r in rows], np.int64), vectors, settings)


def probability(features: np.ndarray, model: Model) -> np.ndarray:
    if model.constant is not None:
        return np.full(len(features), model.constant)
    logits = _forward((features - model.mean) / model.spread, model) / model.temperature
    return 1 / (1 + np.exp(-np.clip(logits, -500, 500)))


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """`docs` with the probability of label 1 as `out` (in place of a column of that name); one pass, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded: buckets x dim numbers

    @F.arrow_udf(returnType="double")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value
        words = Words(own.settings.buckets)
        for batch in batches:
            bodies = [(v.as_py() or b"").decode("utf-8", "replace") for v in batch]
            rows = [pooled(stream(body, words), own.vectors) for body in bodies]
            yield pa.array(probability(np.stack(rows), own) if rows else [], pa.float64())

    return docs.withColumn(out, predict.asNondeterministic()(octets(text)))
