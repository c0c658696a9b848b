"""Collocations of two to four words by dynamic itemset counting over cyclic scans of shards.

Texts are split once, into chunks of word hashes that are dealt to `shards` written folders. The folders are scanned in a
cycle, one a step. A phrase is counted from the step after which both its subphrases (all words but the last, all but the
first) have reached the threshold, and for one full cycle, so lengths are counted side by side and a long phrase doesn't
wait for the end of a pass over the shorter ones. Words, whose counts come with the chunks, are counted from the first
step. The scans end when every phrase
that was started has completed its cycle.

Which step a subphrase reached the threshold in is looked up in a filter: `slots` bytes, of which two per phrase hold
the step they were first set in. Its size is fixed, so it can go to every task, compressed; a slot never changes once it
is set, so a phrase has the same start in every shard. Two phrases that share their slots start superphrases too early or
needlessly, which costs counting and changes no result: no phrase counts as frequent before its own start, so that counts
are of whole phrases, over whole cycles. With more frequent
phrases than the slots can tell apart the scans come near to counting everything.

A phrase is known by the 64-bit hashes of its words. That no two words share one is checked on all words once they
are counted; if two do, counting begins again with another seed. A step adds its counts to those of the phrases still in
their cycle by one aggregate on these numbers, written to the shared folder; phrases that end their cycle below the
threshold are not written any more. Strings come back by the words' own rows.

Null texts are empty, a null language is `und`, copies and repeated rows count as often as they come, empty tables give no
rows. Ties in the order go by count and phrase. A task holds `chunk_bytes` of text, or one piece if it is longer.
"""
from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from statement_spark.llm.common import boxed, small_batches
from statement_spark.session import small, staged, work_dir

LONGEST = 4
NEVER = 255
MOST_STEPS = 250
HELD_WORDS = 100_000
BATCH_TEXTS = 500
SENT_ROWS = 1 << 16
ROW_GROUP_BYTES = 16 << 20

# Fixed value: ends of pieces and tabulators, as a translation to line feeds and blanks.
TO_PIECES = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n\n\n\n\n\n\n\n\n ")


@dataclass(frozen=True)
class Settings:
    least: int = 30
    shards: int = 3
    slots: int = 1 << 24
    chunk_bytes: int = 1 << 20
    scan_words: int = 1 << 19
    batch_chunks: int = 16
    seed: int = 0
    hash_bits: int = 64


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of its front and of its last word."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_hash(lang: str, word: bytes, seed: int = 0, bits: int = 64) -> int:
    """Never 0, which ends a piece."""
    return xxhash.xxh3_64_intdigest(word, seed=xxhash.xxh3_64_intdigest(lang.encode(), seed)) >> (64 - bits) or 1


def slots_of(hashes: np.ndarray, slots: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(slots - 1)
    return (hashes & mask).astype(np.int64), ((hashes >> np.uint64(31)) & mask).astype(np.int64)


def reached(filter_: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """For each hash the first step in which its phrase counts as frequent."""
    first, second = slots_of(hashes, len(filter_))
    return np.maximum(filter_[first], filter_[second])


class Words(dict):
    """Hashes of the words of one language met so far; 0 ends a piece."""

    def __init__(self, lang: str, seed: int = 0, bits: int = 64):
        super().__init__({b"\n": 0})
        self.lang, self.seed, self.bits = lang, seed, bits

    def __missing__(self, word: bytes) -> int:
        self[word] = found = word_hash(self.lang, word, self.seed, self.bits)
        return found


def split_words(body: bytes, words: Words) -> tuple[np.ndarray, Counter]:
    """The word hashes of a chunk, 0 between pieces, and how often each word comes."""
    found = list(filter(None, body.replace(b"\n", b" \n ").split(b" ")))
    own = Counter(found)
    del own[b"\n"]
    return np.fromiter(map(words.__getitem__, found), np.uint64, len(found)), own


def chunks(bodies: list[bytes], chunk_bytes: int) -> Iterator[bytes]:
    """The texts one after another, a piece end between them, cut where a piece ends."""
    whole = b"\n".join(bodies).lower().translate(TO_PIECES)
    at = 0
    while at < len(whole):
        end = len(whole)
        if end - at > chunk_bytes:
            end = whole.rfind(b"\n", at + 1, at + chunk_bytes)
            end = whole.find(b"\n", at + chunk_bytes) if end < 0 else end
            end = len(whole) if end < 0 else end
        yield whole[at:end]
        at = end


def _dealt(docs: DataFrame, text: str, lang: str, settings: Settings) -> DataFrame:
    """(lang, hashes, words, counts, shard) of all chunks, written."""
    path = work_dir(docs.sparkSession, "shards")
    own = boxed(docs, lang=F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")), body=F.col(f"`{text}`").cast("string").cast("binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabularies: dict[str, Words] = {}
        waiting: dict[str, list[bytes]] = {}
        held: dict[str, int] = {}
        shard = -1

        def rows(name: str) -> Iterator[pa.RecordBatch]:
            nonlocal shard
            held[name] = 0
            for body in chunks(waiting.pop(name), settings.chunk_bytes):
                words = vocabularies.get(name)
                if words is None or len(words) > HELD_WORDS:
                    words = vocabularies[name] = Words(name, settings.seed, settings.hash_bits)
                hashes, n = split_words(body, words)
                shard = (shard + 1) % settings.shards
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name], pa.string()), pa.array([hashes.tobytes()], pa.binary()),
                     pa.array([list(n)], pa.list_(pa.binary())), pa.array([list(n.values())], pa.list_(pa.int64())), pa.array([shard], pa.int32())],
                    ["lang", "hashes", "words", "counts", "shard"])

        for batch in batches:
            for name, body in zip(batch.column("lang").to_pylist(), batch.column("body").to_pylist()):
                if body:
                    waiting.setdefault(name, []).append(body)
                    held[name] = held.get(name, 0) + len(body)
                    if held[name] >= settings.chunk_bytes:
                        yield from rows(name)
        for name in list(waiting):
            yield from rows(name)

    cut = own.select("lang", "body").mapInArrow(run, "lang string, hashes binary, words array<binary>, counts array<bigint>, shard int")
    with small_batches(docs.sparkSession, BATCH_TEXTS):  # chunks are large rows, and a reader holds those of a row group
        cut.write.partitionBy("shard").option("compression", "zstd").option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return docs.sparkSession.read.schema(cut.schema).parquet(path)


def _same(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """A place of each different row of the columns, and how often it comes."""
    code = columns[0]
    for column in columns[1:]:
        code = mixed(code, column)
    order = np.argsort(code)
    ordered = code[order]
    new = np.empty(len(code), bool)
    new[0] = True
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    for column in columns:
        ordered = column[order]
        if not np.all(new[1:] | (ordered[1:] == ordered[:-1])):  # two rows with one code
            _, first, n = np.unique(np.stack(columns), axis=1, return_index=True, return_counts=True)
            return first, n
    starts = np.flatnonzero(new)
    return order[starts], np.diff(starts, append=len(code))


def phrase_counts(hashes: np.ndarray, filter_: np.ndarray, step: int, shards: int) -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray]]:
    """(word hashes, start, count) of the phrases of several words that are in their cycle at this step."""
    since = reached(filter_, hashes)
    since[hashes == 0] = NEVER
    front = hashes
    for size in range(2, LONGEST + 1):
        if len(since) < 2:
            return
        start = np.maximum(since[:-1], since[1:])
        open_ = np.flatnonzero(start != NEVER)
        counted = open_[start[open_].astype(np.int64) + shards > step]
        if len(counted):
            first, n = _same([hashes[counted + k] for k in range(size)])
            places = counted[first]
            yield [hashes[places + k] for k in range(size)], start[places], n
        if size == LONGEST:
            return
        longer = np.zeros(len(start), np.uint64)
        longer[open_] = mixed(front[open_], hashes[open_ + size - 1])
        since = np.full(len(start), NEVER, np.uint8)
        since[open_] = np.maximum(reached(filter_, longer[open_]), start[open_])  # others may have set its slots before its own start
        front = longer


KEY = ["w1", "w2", "w3", "w4"]
COUNTED = "w1 bigint, w2 bigint, w3 bigint, w4 bigint, start int, n bigint"


def _scan(shard: DataFrame, filter_, step: int, settings: Settings) -> DataFrame:
    """Counts of one shard's phrases of several words that are in their cycle; 0 behind the last word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(zlib.decompress(filter_.value), np.uint8)
        waiting: list[np.ndarray] = []
        held, end = 0, np.zeros(1, np.uint64)

        def counted() -> Iterator[pa.RecordBatch]:
            hashes = np.concatenate(waiting)
            waiting.clear()
            for columns, start, n in phrase_counts(hashes, known, step, settings.shards):
                numbers = [c.view(np.int64) for c in columns] + [np.zeros(len(n), np.int64)] * (LONGEST - len(columns))
                rows = pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in (*numbers, start.astype(np.int32), n.astype(np.int64))], [*KEY, "start", "n"])
                yield from (rows.slice(at, SENT_ROWS) for at in range(0, rows.num_rows, SENT_ROWS))

        for batch in batches:
            for body in batch.column("hashes").to_pylist():  # a word's hash holds its language: chunks of all count together
                waiting += np.frombuffer(body, np.uint64), end
                held += len(body) // 8
                if held >= settings.scan_words:
                    yield from counted()
                    held = 0
        if waiting:
            yield from counted()

    return shard.select("hashes").mapInArrow(run, COUNTED)


def _hashed(words: DataFrame, settings: Settings) -> DataFrame:
    """`words` (lang, word, n) with the hash of each as `w`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("lang").to_pylist(), batch.column("word").to_pylist())
            hashes = np.array([word_hash(lang, word, settings.seed, settings.hash_bits) for lang, word in pairs], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hashes.view(np.int64))], [*batch.schema.names, "w"])

    rows = words.select("lang", "word", "n")
    return rows.mapInArrow(run, "lang string, word binary, n bigint, w bigint")


def _new_slots(frequent: DataFrame, slots: int) -> list[tuple[int, bytes]]:
    """The slots of the phrases (w1 to w4), as bitmaps: at most one bit a slot comes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in KEY]
            front = columns[0]
            for column in columns[1:]:
                front = np.where(column == 0, front, mixed(front, column))
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(slots_of(front, slots))), pa.int64())], ["slot"])

    slot = frequent.select(*KEY).mapInArrow(run, "slot bigint").select((F.col("slot") + 1).alias("slot"))
    maps = slot.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    return [(r["bucket"], bytes(r["bits"])) for r in maps.collect()]


def _added(new: DataFrame, old: DataFrame | None, keys: list[str], kept: Column | None = None) -> DataFrame:
    """Counts of this step put on those before: keys, `n` of the step, `before`; written, where `kept`."""
    rows = new.withColumn("before", F.lit(0).cast("bigint"))
    if old is not None:
        rows = rows.unionByName(old.select(*keys, F.lit(0).cast("bigint").alias("n"), (F.col("before") + F.col("n")).alias("before")))
    sums = rows.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("before").alias("before"))
    return staged(sums if kept is None else sums.where(kept), "counted")


def count_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", settings: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, n) of every phrase of one to four words with `least` occurrences or more, and (lang, n) of all words."""
    spark, dealt = docs.sparkSession, _dealt(docs, text, lang, settings)
    filter_, sent = np.full(settings.slots, NEVER, np.uint8), None
    words, phrases, done = None, None, []
    total, least = F.col("n") + F.col("before"), settings.least
    reached_now = (F.col("before") < least) & (total >= least)
    step, last_news = 0, -1
    while step < max(settings.shards, last_news + settings.shards + 1):
        if step > MOST_STEPS:
            raise ValueError("more steps than a slot can hold")
        shard, news = dealt.where(F.col("shard") == step % settings.shards), []
        if step < settings.shards:
            each = shard.select("lang", F.inline(F.arrays_zip(F.col("words").alias("word"), F.col("counts").alias("n"))))
            words = _added(each, words, ["lang", "word"])
            if step == settings.shards - 1:
                words = staged(_hashed(words.select("lang", "word", "n", "before").withColumn("n", total), settings).withColumn("before", F.lit(0)), "words")
                if not words.groupBy("w").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
                    return count_phrases(docs, text, lang, replace(settings, seed=settings.seed + 1, hash_bits=64))
                news.append(words.where(F.col("n") >= least).select(F.col("w").alias("w1")))
            else:
                news.append(_hashed(words.where(reached_now), settings).select(F.col("w").alias("w1")))
            news[0] = news[0].select("w1", *[F.lit(0).cast("bigint").alias(c) for c in KEY[1:]])
        if last_news >= 0:
            if sent is not None:
                sent.destroy()  # what it was sent for is written
            sent = spark.sparkContext.broadcast(zlib.compress(filter_, 1))
            going = phrases.where(F.col("start") + settings.shards > step) if phrases is not None else None
            ended = F.col("start") + settings.shards == step + 1
            with small_batches(spark, settings.batch_chunks):
                phrases = _added(_scan(shard, sent, step, settings), going, [*KEY, "start"], ~ended | (total >= least))
            done.append(phrases.where(ended & (total >= least)).select(*KEY, total.alias("n")))
            news.append(phrases.where(reached_now & (F.col("w4") == 0)).select(*KEY))
        for bucket, bits in _new_slots(reduce(DataFrame.unionByName, news), settings.slots) if news else []:
            on = np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")) + (bucket - 1) * 8 * len(bits)
            on = on[filter_[on] == NEVER]
            filter_[on] = step + 1
            last_news = step
        step += 1
    if sent is not None:
        sent.destroy()
    often = staged(words.where(F.col("n") >= least).select("w", "lang", F.col("word").cast("string").alias("word"), "n"), "often")
    return _named(staged(reduce(DataFrame.unionByName, done), "frequent") if done else None, often), words.groupBy("lang").agg(F.sum("n").alias("n"))


def _named(found: DataFrame | None, words: DataFrame) -> DataFrame:
    """(lang, phrase, size, n): words, and phrases by their words' hashes; all words of a frequent phrase are frequent."""
    single = words.select("lang", F.col("word").alias("phrase"), F.lit(1).alias("size"), "n")
    if found is None:
        return single
    names = small(words.select("w", "lang", "word"))
    rows = found.join(names.select(F.col("w").alias("w1"), "lang", F.col("word").alias("word1")), "w1")
    for k in range(2, LONGEST + 1):
        rows = rows.join(names.select(F.col("w").alias(f"w{k}"), F.col("word").alias(f"word{k}")), f"w{k}", "left")
    parts = [F.col(f"word{k}") for k in range(1, LONGEST + 1)]
    several = rows.select("lang", F.concat_ws(" ", *parts).alias("phrase"), F.size(F.array_compact(F.array(*parts))).alias("size"), "n")
    return single.unionByName(several)


def _wide(column: Column) -> Column:
    return column.cast("decimal(25,0)")


def _joined(words: Column, at: Column, n: Column) -> Column:
    return F.array_join(F.slice(words, at, n), " ")


def collocations(docs: DataFrame, most: int = 2000, covered_percent: int = 80, text: str = "text", lang: str = "lang",
                 settings: Settings = Settings()) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's first `most` phrases.

    The score is that of a phrase's weakest cut. A phrase inside a longer one that has `covered_percent` of its
    occurrences is left out, whether or not the longer one stays.
    """
    found, all_words = count_phrases(docs, text, lang, settings)
    found = staged(found, "phrases")
    words = F.split("phrase", " ")
    several = found.where("size > 1").select("lang", "phrase", "size", F.col("n").alias("a"), words.alias("words"))

    inner = F.explode(F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda k: F.transform(
        F.sequence(F.lit(1), F.col("size") - k + 1), lambda at: _joined(F.col("words"), at, k)))))
    covers = several.where("size > 2").select("lang", inner.alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = several.join(covers, ["lang", "phrase"], "left")
    left = left.where(F.col("longer").isNull() | (_wide(F.col("longer")) * 100 < _wide(F.col("a")) * covered_percent))

    cut = left.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "a", "k", _joined(F.col("words"), F.lit(1), F.col("k")).alias("front"),
        _joined(F.col("words"), F.col("k") + 1, F.col("size") - F.col("k")).alias("back"))
    counts = found.select("lang", F.col("phrase").alias("part"), F.col("n").alias("c"))
    cut = cut.join(counts.select("lang", F.col("part").alias("front"), F.col("c").alias("l")), ["lang", "front"])
    cut = cut.join(counts.select("lang", F.col("part").alias("back"), F.col("c").alias("r")), ["lang", "back"])
    score = F.call_function("div", _wide(F.col("a")) * F.lit(2_000_000).cast("decimal(7,0)"), _wide(F.col("l") + F.col("r")))
    weakest = cut.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("w"))

    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = weakest.select("lang", "phrase", "a", "w.score", "w.l", "w.r").withColumn("rank", F.row_number().over(order).cast("bigint"))
    return ranked.where(F.col("rank") <= most).join(all_words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
