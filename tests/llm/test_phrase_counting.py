"""Phrases by dynamic itemset counting against counting them all."""
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from statement_spark.llm import phrase_counting
from statement_spark.llm.phrase_counting import Settings


def counted(rows):
    """Occurrences of phrases of one to four words by language."""
    found = defaultdict(Counter)
    for lang, text in rows:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0A-\x0D]", text):
            words = re.findall("[^\x20\x09]+", piece)
            for k in (1, 2, 3, 4):
                found["und" if lang is None else lang].update(" ".join(words[i:i + k]) for i in range(len(words) - k + 1))
    return found


def mined(rows, least, most=2000, percent=80):
    out = set()
    for lang, f in counted(rows).items():
        total = sum(c for p, c in f.items() if " " not in p)
        often = {p: a for p, a in f.items() if " " in p and a >= least}
        ranked = []
        for phrase, a in often.items():
            words = phrase.split(" ")
            if any(len(o.split(" ")) > len(words) and f" {phrase} " in f" {o} " and 100 * n >= percent * a for o, n in often.items()):
                continue
            cuts = []
            for k in range(1, len(words)):
                l, r = f[" ".join(words[:k])], f[" ".join(words[k:])]
                cuts.append((2_000_000 * a // (l + r), k, l, r))
            score, _, l, r = min(cuts)
            ranked.append((-score, -a, phrase.encode(), phrase, a, l, r))
        out |= {(lang, i + 1, p, a, l, r, total, -s) for i, (s, _, _, p, a, l, r) in enumerate(sorted(ranked)[:most])}
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string").selectExpr("*", "1 AS shard", "'b' AS body", "2 AS n", "'p' AS phrase")


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(12)
    words = ["the", "The", "of", "über", "x'y", "a-b", "\x0bq", "\x00", "é", *("".join(rng.choices("abc", k=2)) for _ in range(30))]
    weights = [40, 20, 20, 10, 5, 5, 3, 1, 3] + [2] * 30
    found = []
    for i in range(300):
        parts = rng.choices(words, weights, k=rng.randint(0, 60))
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ", ", ". ", "\n", "?!"]) for w in parts)
        found.append((rng.choice(["en", "en", "en", "de", None, ""]), text))
    found += [("en", "once upon a time there was")] * 70 + [("en", "Once Upon a time, more")] * 9
    found += [("de", "la la la la la la")] * 20 + [("und", "one two"), (None, "one two"), ("xx", None), ("yy", ""), ("zz", " .. ")]
    found.append(("en", "long piece without an end " * 3000))
    rng.shuffle(found)
    return found


@pytest.mark.parametrize("settings", [
    Settings(least=30), Settings(least=12, shards=1), Settings(least=5, shards=7, chunk_bytes=64, scan_words=50), Settings(least=30, shards=4, slots=8)])
def test_like_counting_all(spark, rows, settings):
    """Also with a filter of eight slots, where nearly every phrase is taken for frequent."""
    got = [tuple(r) for r in phrase_counting.collocations(frame(spark, rows).repartition(3), settings=settings).collect()]
    assert len(got) == len(set(got)) and set(got) == mined(rows, settings.least)


def test_limits(spark, rows):
    few = phrase_counting.collocations(frame(spark, rows), most=3, covered_percent=50, settings=Settings(least=20))
    assert {tuple(r) for r in few.collect()} == mined(rows, 20, 3, 50)


def test_counts_are_of_frequent_phrases_over_one_cycle(spark, rows):
    found, all_words = phrase_counting.count_phrases(frame(spark, rows), settings=Settings(least=25))
    expected = counted(rows)
    assert {(r["lang"], r["phrase"]): r["n"] for r in found.collect()} == {
        (lang, p): n for lang, f in expected.items() for p, n in f.items() if n >= 25}
    assert {r["lang"]: r["n"] for r in all_words.collect()} == {
        lang: n for lang, f in expected.items() if (n := sum(c for p, c in f.items() if " " not in p))}


def test_phrases_that_end_below_the_threshold_are_not_written(spark, rows, monkeypatch):
    written, kept = [], phrase_counting.staged

    def staged(df, purpose):
        written.append(kept(df, purpose))
        return written[-1]

    monkeypatch.setattr(phrase_counting, "staged", staged)
    phrase_counting.count_phrases(frame(spark, rows), settings=Settings(least=25))
    steps = [df.selectExpr("start", "n + before AS n").collect() for df in written if "start" in df.columns]
    assert len(steps) > 4
    for step, counts in enumerate(steps, 1):
        assert all(r["n"] >= 25 or r["start"] + 3 > step + 1 for r in counts)


def test_empty_tables(spark, rows):
    assert phrase_counting.collocations(frame(spark, rows).where("false")).collect() == []
    assert phrase_counting.collocations(frame(spark, [("en", None), (None, "")])).collect() == []


def test_a_phrase_starts_when_both_subphrases_have():
    words = phrase_counting.Words("en")
    filter_ = np.full(1 << 16, phrase_counting.NEVER, np.uint8)
    hashes, own = phrase_counting.split_words(b"a b c d\na b c", words)
    assert own == {b"a": 2, b"b": 2, b"c": 2, b"d": 1} and [words[w] for w in (b"a", b"b", b"c", b"d", b"\n", b"a", b"b", b"c")] == hashes.tolist()
    names = {words[w]: w.decode() for w in own}

    def frequent(step, *phrases):
        for phrase in phrases:
            h = None
            for w in phrase.split(" "):
                one = np.array([words[w.encode()]], np.uint64)
                h = one if h is None else phrase_counting.mixed(h, one)
            for slot in phrase_counting.slots_of(h, len(filter_)):
                filter_[slot] = min(filter_[slot][0], step)

    def at(step):
        return {" ".join(names[int(h)] for h in phrase): (int(s), int(n)) for columns, start, counts in
                phrase_counting.phrase_counts(hashes, filter_, step, 4) for phrase, s, n in zip(zip(*columns), start, counts)}

    assert at(0) == {}
    frequent(1, "a", "b")
    assert at(1) == {"a b": (1, 2)}
    frequent(2, "c", "d")
    assert at(2) == {"a b": (1, 2), "b c": (2, 2), "c d": (2, 1)}
    frequent(4, "a b")
    assert set(at(4)) == {"a b", "b c", "c d"} and at(5).keys() == {"b c", "c d"}
    frequent(6, "b c")
    assert at(6) == {"a b c": (6, 2)} and at(9) == {"a b c": (6, 2)} and at(10) == {}


def test_slots_set_by_others_start_no_phrase_before_its_parts():
    """The slots of "a b" are set in step 1, "a" reaches the threshold in step 5: "a b c" is counted from step 5 on."""
    words = phrase_counting.Words("en")
    hashes, _ = phrase_counting.split_words(b"a b c d", words)
    filter_ = np.full(1 << 16, phrase_counting.NEVER, np.uint8)
    pairs = phrase_counting.mixed(hashes[:-1], hashes[1:])
    for step, phrase in ((5, hashes[:1]), (1, hashes[1:]), (1, pairs)):
        for slot in phrase_counting.slots_of(phrase, len(filter_)):
            filter_[slot] = step

    def starts(step):
        return [(len(columns), s) for columns, start, _ in phrase_counting.phrase_counts(hashes, filter_, step, 3) for s in start.tolist()]

    assert (3, 5) in starts(5) and (3, 5) in starts(7) and 5 not in [s for _, s in starts(8)]


def test_words_with_one_hash_begin_again(spark, rows):
    """With three bits words share hashes; the counts are those of another seed and all bits."""
    found, _ = phrase_counting.count_phrases(frame(spark, rows), settings=Settings(least=25, hash_bits=3))
    assert {(r["lang"], r["phrase"]): r["n"] for r in found.collect()} == {
        (lang, p): n for lang, f in counted(rows).items() for p, n in f.items() if n >= 25}


def test_rows_with_one_code_are_told_apart(monkeypatch):
    a, b = np.array([1, 2, 1, 3], np.uint64), np.array([5, 6, 5, 5], np.uint64)
    for code in (phrase_counting.mixed, lambda x, y: x * np.uint64(0)):
        monkeypatch.setattr(phrase_counting, "mixed", code)
        first, n = phrase_counting._same([a, b])
        assert {(int(a[i]), int(b[i])): int(k) for i, k in zip(first, n)} == {(1, 5): 2, (2, 6): 1, (3, 5): 1}


def test_long_pieces_are_not_cut():
    body = b"a b " * 50_000
    assert list(phrase_counting.chunks([body, b"c"], 1000)) == [body, b"\nc"]
    assert b"".join(phrase_counting.chunks([b"x. Y"] * 3000, 100)) == b"\n".join([b"x\n y"] * 3000)
