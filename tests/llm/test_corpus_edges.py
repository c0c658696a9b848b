"""Odd tables: nulls in any column, empty and long texts, ties, repeated rows, empty tables, clashing names."""
import os
import random
import sys
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings as given_settings, strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

import corpus_pipeline  # noqa: E402
from statement_spark.llm import (  # noqa: E402
    components, compression_bands, language_id, license_rules, license_signatures, packing, positional_index, quality_net,
    simhash_pivots, suffix_dedup, surrogates, warc_derivatives)

random.seed(4)
WORDS = ["".join(random.choice("abcdefghij") for _ in range(random.randint(2, 9))) for _ in range(3000)]
LONG = " ".join(random.choice(WORDS) for _ in range(30_000))
PASSAGE = " ".join(WORDS[:60])
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
# names that the operators use inside, as columns of the caller's
CLASHES = ["_row", "_key", "_text", "_words", "options", "fp", "r1", "r2", "bucket", "x", "term", "label", "id", "y", "key", "kept", "item"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES)

TEXTS = [
    (1, None, "en"), (2, "", "en"), (3, " \n\t ", None), (4, "a", "en"), (5, "!!! 123", "de"), (6, LONG, "en"), (7, LONG, "en"),
    (8, "é漢字 ñ" * 40, "fr"), (None, PASSAGE, "en"), (9, PASSAGE, None), (10, f"before {PASSAGE} after", "en"),
    (11, f"other {PASSAGE} end mail a.b@c.org or A.B@c.org", "de"), (11, f"other {PASSAGE} end mail a.b@c.org or A.B@c.org", "de"),
    (12, "aaaa " * 400, "en"), (13, "Licensed under the MIT License. Licensed under CC BY-NC 4.0.", "en"),
    (14, "x" * 3000, None), (15, None, None),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, lang, None if k % 2 else "s", None if t is None else len(t), *["z" if k % 3 else None] * len(CLASHES))
            for k, (i, t, lang) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(odd):
    return odd.where("false")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(
        [(1, " ".join(WORDS[10:40])), (2, "a"), (3, None), (4, "..."), (None, PASSAGE), (1, "nowhere else " * 9), (5, " ".join(WORDS[:13]))],
        "item_id long, text string")


def test_language(odd, empty):
    model = language_id.fit(odd)
    out = language_id.identify(odd, model)
    assert out.columns == [*odd.columns, "language"]
    rows = out.collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        if not r["text"] or not any(c.isalpha() for c in r["text"]):
            assert (r["language"]["lang"], r["language"]["score"]) == ("und", 0.0)
        else:
            assert r["language"]["lang"] in ("en", "de", "fr")
    assert language_id.identify(empty, model).collect() == []
    none = language_id.fit(empty)
    assert {r["language"]["lang"] for r in language_id.identify(odd, none).collect()} == {"und"}


def test_bands(odd, empty):
    rows = compression_bands.judge(odd).collect()
    assert [tuple(r["quality"])[:5] for r in rows] == [brute.quality_counts(t) for _, t, _ in TEXTS]
    by_id = {r["doc_id"]: r["quality"] for r in rows}
    assert by_id[6]["kept"] and by_id[12]["verdict"] == "repetitive" and not by_id[1]["kept"]
    noise = bytes(random.choice(range(33, 127)) for _ in range(20_000)).decode()
    packer = compression_bands.zstandard.ZstdCompressor(level=3)
    assert compression_bands.band_verdict(noise.encode(), compression_bands.Bands(), packer)[2] == "incompressible"
    half = LONG[:60_000] + "again and " * 6_000
    assert compression_bands.band_verdict(half.encode(), compression_bands.Bands(), packer)[2] == "bad_chunks"
    assert compression_bands.keep(odd).columns == odd.columns
    assert compression_bands.keep(empty).count() == 0


def test_quality_without_labels(spark, odd, empty):
    some = spark.createDataFrame([(1, 1, None), (6, None, 1), (9, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for labels in (some, some.where("false")):
        rows = quality_net.score(odd, quality_net.fit(odd, labels)).collect()
        assert len(rows) == len(TEXTS) and all(0 <= r["score"] <= 1 for r in rows)
    model = quality_net.fit(odd, some)
    assert quality_net.score(empty, model).collect() == []
    good = [(i, " ".join(random.sample(WORDS, 40)), 1) for i in range(60)]
    bad = [(100 + i, " ".join(w.upper() + "!!" for w in random.sample(WORDS, 40)), 0) for i in range(60)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string, quality int")
    model = quality_net.fit(docs.select("doc_id", "text"), docs.select("doc_id", "quality"))
    rows = quality_net.score(docs.unionByName(odd.selectExpr("doc_id", "text", "cast(null AS int) AS quality")), model).collect()
    assert np.mean([(r["score"] > 0.5) == (r["quality"] == 1) for r in rows if r["quality"] is not None]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_fingerprints_and_components(spark, odd, empty):
    rows = simhash_pivots.near_duplicates(odd).collect()
    assert len(rows) == len(TEXTS)
    by_id = {r["doc_id"]: r for r in rows}
    for i, t, _ in TEXTS:
        if i is not None and t != LONG:
            assert by_id[i]["fp"] % 2**64 == brute.fingerprint(t)
    assert by_id[1]["fp"] == by_id[2]["fp"] == 0 and by_id[15]["component_id"] == 1
    assert by_id[7]["component_id"] == 6
    assert simhash_pivots.near_duplicates(empty).collect() == []
    kept = simhash_pivots.keep_first(odd)
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({r["component_id"] for r in rows if r["component_id"] is not None})
    assert None in ids
    assert simhash_pivots.keep_first(empty).count() == 0


@pytest.mark.parametrize("pair_limit", [1, 2, 64])
def test_links_in_and_over_the_pair_limit(spark, pair_limit):
    rng = random.Random(pair_limit)
    centre = rng.getrandbits(64)
    prints = {0: 0, 1: centre, 2: centre ^ 3, 3: (1 << 64) - 1}
    for i in range(4, 160):
        value = centre if i % 2 else rng.getrandbits(64)
        for _ in range(rng.randint(0, 5)):
            value ^= 1 << rng.randrange(64)
        prints[i] = value
    frame = spark.createDataFrame([(i, v - (1 << 64) if v >> 63 else v) for i, v in prints.items()], "doc_id long, fp long")
    links = simhash_pivots.links(frame.select("fp").distinct(), pair_limit=pair_limit)
    roots = {r["node"] % 2**64: r["root"] for r in components.connected(links).collect()}
    want = brute.components(prints)
    got = {i: roots.get(v, v - (1 << 64) if v >> 63 else v) for i, v in prints.items()}
    assert {(a, b) for a in prints for b in prints if want[a] == want[b]} == {(a, b) for a in prints for b in prints if got[a] == got[b]}


def test_long_chain_of_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 100), (200, 201), (201, 200), (None, 3)], "a long, b long")
    found = {r["node"]: r["root"] for r in components.connected(edges).collect()}
    assert found == {**{i: 0 for i in range(61)}, 200: 200, 201: 200}


def test_repeats(odd, empty):
    out = suffix_dedup.remove_repeats(odd)
    assert out.columns == [*[c for c in odd.columns if c != "text"], "dedup"]
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["dedup"]["n_bytes"], r["dedup"]["n_removed"], r["dedup"]["n_spans"]) for r in out.collect())
    want = brute.removed([t for _, t, _ in TEXTS])
    assert got == sorted((i is None, i or 0, *w[:3]) for (i, _, _), w in zip(TEXTS, want))
    assert suffix_dedup.remove_repeats(empty).collect() == []


@pytest.mark.parametrize("limit", [2, 512])
def test_repeats_with_many_edges(spark, limit):
    """Passages cut at random places, so that a gram's contexts differ; small groups are sorted, large ones counted."""
    rng = random.Random(8)
    base = "".join(rng.choice("abcd ") for _ in range(900))
    texts = []
    for _ in range(40):
        a, b = sorted(rng.sample(range(900), 2))
        texts.append("".join(rng.choice("efgh") for _ in range(rng.randint(0, 90))) + base[a:b] + "".join(rng.choice("xyz") for _ in range(50)))
    texts += ["ab" * 400, "ab" * 300, "q" * 700, texts[0]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = suffix_dedup.remove_repeats(docs, settings=suffix_dedup.Settings(length=60, gram=20, group_limit=limit)).collect()
    want = brute.removed(texts, 60)
    assert {r["doc_id"]: (r["dedup"]["n_bytes"], r["dedup"]["n_removed"], r["dedup"]["n_spans"]) for r in out} == {
        i: w[:3] for i, w in enumerate(want)}


@given_settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), min_size=2, max_size=12), st.integers(0, 5))
def test_shared_windows_match_all_pairs(cuts, seed):
    rng = random.Random(seed)
    base, length = bytes(rng.choice(b"ab") for _ in range(60)), 24
    power = suffix_dedup.powers(suffix_dedup.BASES[1], 256)
    group = []
    for i, (left, right) in enumerate(cuts):
        head = bytes(rng.choice(b"xy") for _ in range(30 - left)) + base[30 - left:30]
        group.append(suffix_dedup.Context(head + base[30:30 + right] + bytes(rng.choice(b"pq") for _ in range(30 - right)), 30, i, power))
    found = suffix_dedup.shared_windows(group, length, suffix_dedup.Extensions(power))
    for c, some in zip(group, found):
        got = {k for a, b in some for k in range(a, b - length + 1)}
        shared = {k for k in range(61 - length) if any(c.body[k:k + length] == o.body[k:k + length] for o in group if o is not c)}
        assert got <= shared and {k for k in shared if k <= 30 <= k + length} <= got


def test_positional_index(odd, empty, items):
    out = positional_index.matches(odd, items)
    assert out.columns == [*odd.columns, "contamination"]
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0), r["contamination"]["n_words"], r["contamination"]["n_hit"], r["contamination"]["items"])
                 for r in out.collect())
    found = brute.contamination([t for _, t, _ in TEXTS], [(r["item_id"], r["text"]) for r in items.collect()])
    assert got == sorted(((i is None, i or 0), *w) for (i, _, _), w in zip(TEXTS, found))
    assert positional_index.matches(empty, items).collect() == []
    assert all(not r["contamination"]["n_hit"] for r in positional_index.matches(odd, items.where("false")).collect())


def test_near_matches(spark):
    docs = spark.createDataFrame([(1, "one red two apple three tree"), (2, "red " + "pad " * 80 + "apple tree"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(7, "Apple tree, red"), (8, "absent words")], "item_id long, text string")
    found = positional_index.near_matches(docs, items, terms=3, span=10).collect()
    assert [(r["doc_id"], r["item_id"], r["first_word"]) for r in found] == [(1, "7", 1)]


def test_surrogates_keep_format_gender_and_reference(spark, odd, empty):
    text = ("Mr. John Smith met Mrs Anna Smith; Mr Smith paid 4111 1111 1111 1111, call (212) 555-0100 or +1 212-555-0100 or 212.555.0100. "
            "Г-н Иван Петров; mail JOHN@ACME.ORG or john@acme.org; 10.0.0.1, 123-45-6789, api_key: 'AbCd-0123_xyz9'.")
    docs = spark.createDataFrame([(1, text), (2, "Mr Smith again, 212-555-0100"), (3, "nothing here"), (4, None)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in surrogates.replace(docs, "k").collect()}
    assert rows[3]["text"] == "nothing here" and rows[4]["text"] is None and rows[3]["replaced"] == {}
    new = rows[1]["text"]
    for gone in ("John", "Smith", "Anna", "4111 1111", "555-0100", "555.0100", "Иван", "Петров", "ACME", "acme", "10.0.0.1", "123-45", "AbCd"):
        assert gone not in new
    words = new.split()
    assert words[0] == "Mr." and words[1].endswith("n") and words[6].endswith("a;") is False and words[5].endswith("na")
    surname = words[2]
    assert words[6].rstrip(";") == surname == words[8] and rows[2]["text"].startswith(f"Mr {surname} again")
    card = new.split("paid ")[1][:19]
    digits = [int(c) for c in card if c.isdigit()]
    assert card[4] == card[9] == card[14] == " " and sum(digits[-1::-2]) + sum(sum(divmod(2 * d, 10)) for d in digits[-2::-2]) != 0
    assert (sum(digits[-1::-2]) + sum(sum(divmod(2 * d, 10)) for d in digits[-2::-2])) % 10 == 0
    phones = new.split("call ")[1]
    first = phones[:14]
    plain = "".join(c for c in first if c.isdigit())
    assert f"+1 {plain[:3]}-{plain[3:6]}-{plain[6:]}" in phones and f"{plain[:3]}.{plain[3:6]}.{plain[6:]}" in phones
    assert rows[2]["text"].endswith(f"{plain[:3]}-{plain[3:6]}-{plain[6:]}")
    mails = new.split("mail ")[1].split(";")[0].split(" or ")
    assert mails[0] == mails[1].upper() and mails[1].endswith(".example.org")
    assert any("Ѐ" <= c <= "ӿ" for c in new) and rows[1]["replaced"]["phone"] == 3
    other = surrogates.replace(docs, "another key").where("doc_id = 1").first()["text"]
    assert other != new
    out = surrogates.replace(odd, "k")
    assert out.columns == [*odd.columns, "replaced"] and out.count() == len(TEXTS)
    assert surrogates.replace(empty, "k").count() == 0


def test_surrogates_that_collide_draw_again(spark, monkeypatch):
    def narrow(kind, form, digest, key, turn):
        return F.concat(F.lit("v"), (F.crc32(F.concat(form, F.lit(str(turn)))) % (3 + 4 * turn)).cast("string"))

    monkeypatch.setattr(surrogates, "draw", narrow)
    entities = spark.createDataFrame([("secret", f"e{i}") for i in range(12)] + [("secret", "v1"), ("phone", "e1")], "type string, form string")
    rows = surrogates.assign(entities, "k").collect()
    assert len(rows) == 14 and len({(r["type"], r["surrogate"]) for r in rows}) == 14
    assert not any(r["type"] == "secret" and r["surrogate"] == "v1" for r in rows)


def test_packing(odd, empty):
    for with_ids in (True, False):
        rows = packing.pack(odd, packing.Settings(RANKS, block_tokens=2000), with_ids=with_ids).collect()
        assert sum(r["length"] for r in rows if r["start"] == 0 and r["doc_id"] in (1, 2, 15)) == 3
        assert len({(r["sequence_id"], r["offset"]) for r in rows}) == len(rows)
        sizes = {}
        for r in rows:
            sizes[r["sequence_id"]] = sizes.get(r["sequence_id"], 0) + r["length"]
        assert all(n <= 1024 and n & (n - 1) == 0 for n in sizes.values())
        assert sum(sizes.values()) == sum(r["doc_tokens"] for r in rows if r["start"] == 0)
        if with_ids:
            assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in rows)
    assert packing.pack(empty, packing.Settings(RANKS)).collect() == []


@given_settings(max_examples=100, deadline=None)
@given(st.text(max_size=80))
def test_ranks_give_the_tokenizers_ids(text):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    model.encode_special_tokens = True
    ids = np.frombuffer(packing.encoder(RANKS)(text), "<u4").tolist()
    assert ids == model.encode(text, add_special_tokens=False).ids + [0]


@given_settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 3000), max_size=60))
def test_packer_loses_nothing(lengths):
    packer, windows = packing.Packer((128, 256, 512, 1024)), []
    for doc, n in enumerate(lengths):
        packer.add(doc, np.arange(n, dtype="<u4").tobytes())
        if doc % 7 == 6:
            windows += list(packer.filled())
    windows += [*packer.filled(), *packer.rest()]
    assert all((n := sum(p.length for p in w)) & (n - 1) == 0 and n <= 1024 for w in windows)
    for doc, n in enumerate(lengths):
        mine = sorted((p for w in windows for p in w if p.doc == doc), key=lambda p: p.start)
        assert np.concatenate([np.frombuffer(p.ids, "<u4") for p in mine]).tolist() == list(range(n))


def test_license_rules(odd, empty):
    out = license_rules.scan(odd)
    assert out.columns == [*odd.columns, "licenses"]
    rows = out.collect()
    for (_, text, _), r in zip(TEXTS, rows):
        base = brute.license_base(text)
        assert (r["licenses"]["n_words"], r["licenses"]["n_base"], r["licenses"]["first_word"], r["licenses"]["last_word"]) == base[:4]
        assert [tuple(s)[:4] for s in r["licenses"]["spans"]] == [k[:4] for k in brute.license_labels(text, license_signatures.signatures())]
    assert license_rules.scan(empty).collect() == []
    assert 200 < len(license_signatures.signatures()) < 1000


def test_every_license_rule_passes_the_word_gate(spark):
    """A text that a rule matches holds the word without which the rule isn't tried."""
    samples = [
        "SPDX-License-Identifier: GPL-3.0-or-later", "GNU Lesser General Public License v2.1", "cc by-sa 4.0", "CC0 1.0 Universal", "BSD 3-Clause",
        "3-clause BSD license", "This is free and unencumbered software released into the public domain", "Apache 2.0", "AGPLv3", "wtfpl",
        "Copyright 2020 Some Body. All rights reserved.", "the same terms as Perl itself; under the same terms as perl",
        "creativecommons.org/licenses/by-nc-sa/4.0", "The Software shall be used for Good, not Evil.", "GNU GPL v2 or later", "public domain work",
    ]
    docs = spark.createDataFrame(list(enumerate(samples)), "doc_id long, text string")
    for r in license_rules.scan(docs).collect():
        want = brute.license_labels(samples[r["doc_id"]], license_signatures.signatures())
        assert want and [s["label"] for s in r["licenses"]["spans"]] == [k[3] for k in want]


def test_warc_records(spark):
    import base64
    import hashlib

    pages = spark.createDataFrame([
        (1, "http://a/", "<html lang=en><title>A &amp; B</title><script>x<p></script><p>One&#233; &#x4E2D;<br>two</p><a href='/l?a=1&amp;b=2'>z</a>", "r-1", "2020-01-01T00:00:00Z", {"Server": "s", "Via": None}),
        (1, "http://a/", None, None, None, None), (None, None, "", None, None, {}), (2, "http://b/", "no tags < here > &#0; &bogus;", "r-2", None, None),
    ], "page_id long, url string, html string, rid string, date string, headers map<string,string>")
    rows = warc_derivatives.serialized(warc_derivatives.derive(pages, response_id="rid", date="date", headers="headers", key="page_id")).collect()
    assert len(rows) == 8
    for r in rows:
        block = r["block"].encode()
        sha = "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()
        assert (r["content_length"], r["block_digest"]) == (len(block), sha)
        assert bytes(r["record"]) == r["header"].encode() + b"\r\n" + block + b"\r\n\r\n"
        assert f"WARC-Refers-To: {r['refers_to']}\r\n" in r["header"]
    one = {r["warc_type"]: r for r in rows if r["refers_to"] == "r-1"}
    assert one["conversion"]["block"] == "A & B\nOneé 中\ntwo\nz"
    assert one["metadata"]["block"] == ("title: A & B\r\nsource-header: Server: s\r\nsource-header: Via: \r\noutlink: /l?a=1&b=2\r\n")
    assert one["metadata"]["record_id"] != one["conversion"]["record_id"]
    two = next(r for r in rows if r["refers_to"] == "r-2" and r["warc_type"] == "conversion")
    assert two["block"] == "no tags < here > � &bogus;"
    assert warc_derivatives.derive(pages.where("false")).count() == 0


def test_pipeline_on_odd_tables(spark, odd, empty, items, tmp_path):
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    for docs in (odd, empty):
        now = docs
        for name, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, str(tmp_path))
            if name != corpus_pipeline.STAGES[-1][0]:
                assert now.columns == docs.columns
        assert now.count() >= 0


def test_languages_of_marks_and_number_signs(spark):
    rows = [(i, "the cat sat on the mat and " * 4, "en") for i in range(4)] + [(10 + i, "हिन्दी भाषा में लिखा हुआ पाठ " * 4, "hi") for i in range(4)]
    rows += [(20, "² ½ Ⅷ", None), (21, "\u0301\u0302", None), (22, "123 _ !", None), (23, "हिन्दी", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r["doc_id"]: r["language"]["lang"] for r in language_id.identify(docs, language_id.fit(docs)).collect()}
    assert [found[i] for i in (20, 21, 22)] == ["und"] * 3 and found[0] == "en" and found[10] == "hi" and found[23] == "hi"
    assert language_id.letters("हिन्दी भाषा²") == "हिन्दी भाषा"


def test_licenses_inside_a_weaker_span(spark):
    rows = [(1, "Copyright 2020 Foo BSD 3-Clause License. All rights reserved."), (2, "Copyright (c) 2020 Foo Inc licensed under Apache 2.0. All rights reserved."),
            (3, "Copyright 2020 Foo. All rights reserved.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = {r["doc_id"]: r["licenses"]["labels"] for r in license_rules.scan(docs).collect()}
    assert "bsd-3-clause" in labels[1] and "apache-2.0" in labels[2] and labels[3] == ["all-rights-reserved"]
