"""The registered corpus queries on a whole small table: SQL twins, brute force, round trips, held-out accuracy."""
import os
import sys
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import oracle
import public_tokenizers
import pytest

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402
from test_near_copies import firsts  # noqa: E402

import corpus_pipeline  # noqa: E402
from statement_spark.llm import compression_bands, license_signatures, packing, queries, surrogates  # noqa: E402
from statement_spark.session import staged  # noqa: E402


@pytest.fixture(scope="module")
def docs(sf_dir):
    return duckdb.sql(f"SELECT doc_id, text, lang FROM '{sf_dir}/documents.parquet' ORDER BY doc_id").fetchall()


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    held = {}

    def of(name):
        if name not in held:
            held[name] = queries.QUERIES[name](spark, sf_dir).collect()
        return held[name]

    return of


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(spark, sf_dir, name):
    ok, message = oracle.compare(spark, oracle.connect(sf_dir), queries.QUERIES[name], queries.ORACLES[name], sf_dir)
    assert ok, message


def test_language_of_held_out_texts(rows, docs):
    found = {r["doc_id"]: r for r in rows("op1_language_id")}
    assert set(found) == {d[0] for d in docs}
    held = [d for d in docs if zlib.crc32(str(d[0]).encode()) % 5 == 0]
    assert all(found[d[0]]["held_out"] == (d in held) for d in docs)
    assert np.mean([found[i]["lang_pred"] == lang for i, _, lang in held]) > 0.9
    assert all(0 <= r["score"] <= 1 and r["lang_pred"] in {d[2] for d in docs} | {"und"} for r in found.values())


def test_surrogates_leave_the_rest(rows, docs):
    import re

    found = {r["doc_id"]: r for r in rows("op2_surrogates")}
    assert set(found) == {d[0] for d in docs}
    pattern = re.compile(r'(?<=token = ")[0-9a-f]{40}|[A-Za-z0-9.]+@[a-z0-9.]+\.com|\+1 \(\d{3}\) \d{3}-\d{4}|\b\d{16}\b|\b\d+\.\d+\.\d+\.\d+\b')
    mapped = defaultdict(set)
    for doc, text, _ in docs:
        new, hits = found[doc]["text"], pattern.findall(text)
        assert found[doc]["n_replaced"] == len(hits)
        gaps = pattern.split(text)
        put = re.fullmatch("(.*?)".join(map(re.escape, gaps)), new, re.S)
        assert put, doc
        for a, b in zip(hits, put.groups()):
            mapped[a].add(b)
    assert mapped and all(len(v) == 1 for v in mapped.values())
    values = [next(iter(v)) for v in mapped.values()]
    assert len(set(values)) == len(values) and not set(values) & set(mapped)


def test_packing_round_trip(spark, sf_dir, rows, docs):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows("op4_packing"):
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    for doc, text, _ in docs:
        ids = np.array(model.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        at = 0
        for p in sorted(pieces[doc], key=lambda p: p["start"]):
            assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(ids[at:at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    for members in sequences.values():
        at = 0
        for p in sorted(members, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 1024 and at & (at - 1) == 0


def test_repeated_strings(rows, docs):
    found = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows("op5_suffix_dedup")}
    assert found == {d[0]: b for d, b in zip(docs, brute.removed([d[1] for d in docs]))}


def test_quality_of_held_out_texts(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = {r["doc_id"]: r for r in queries.QUERIES["op6_quality_net"](spark, sf_dir).collect()}
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{sf_dir}/labels.parquet'").fetchall()
    held = [(d, q) for d, q in labels if zlib.crc32(str(d).encode()) % 4 == 2]
    assert all(found[d]["held_out"] for d, _ in held)
    assert np.mean([found[d]["predicted"] == q for d, q in held]) > 0.9
    assert all(r["predicted"] == (r["score"] >= 0.7) for r in found.values())


def test_quality_counts(rows, docs):
    found = {r["doc_id"]: r for r in rows("op7_compression_bands")}
    for doc, text, _ in docs:
        r, counts = found[doc], brute.quality_counts(text)
        assert tuple(r[1:6]) == counts
        assert r["base_failed"] == (counts[0] < 50 or 2 * counts[4] > counts[0])
        assert not (r["kept"] and (r["base_failed"] or r["verdict"] != "ok"))


def test_license_places_and_labels(spark, sf_dir, rows, docs):
    found = {r["doc_id"]: r for r in rows("op9_license_rules")}
    table = license_signatures.signatures()
    assert any(r["n_base"] for r in found.values())
    for doc, text, _ in docs:
        r, base, kept = found[doc], brute.license_base(text), brute.license_labels(text, table)
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (*base[:4], ",".join(base[4]))
        assert r["labels"] == ",".join(sorted({*base[4], *(k[3] for k in kept)}))
        assert r["score"] == max((k[4] for k in kept), default=0.0)


def test_near_duplicate_components(rows, docs):
    found = {r["doc_id"]: r for r in rows("op10_simhash_pivots")}
    prints = {d[0]: brute.fingerprint(d[1]) for d in docs}
    assert {k: r["fingerprint"] for k, r in found.items()} == {k: f"{v:016x}" for k, v in prints.items()}
    assert {k: r["component_id"] for k, r in found.items()} == brute.components(prints)


def test_pipeline_stage_by_stage(spark, sf_dir, docs):
    """Every stage on what its predecessor kept, against the same decisions in plain Python."""
    import zstandard

    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    outs, now = {}, spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = now.columns
    for name, stage in corpus_pipeline.STAGES:
        now = staged(stage(spark, now, sf_dir), name)
        outs[name] = now
        if name != names[-1]:
            assert now.columns == columns
    texts = {d[0]: d[1] for d in docs}
    bands, packer = compression_bands.Bands(), zstandard.ZstdCompressor(level=3)

    def passes(text):
        counts = brute.quality_counts(text)
        return (counts[0] >= 50 and 2 * counts[4] <= counts[0]
                and compression_bands.band_verdict(text.encode(), bands, packer)[2] == "ok")

    kept = {i: t for i, t in texts.items() if passes(t)}
    assert {r["doc_id"] for r in outs["quality_rules"].collect()} == set(kept)
    kept = {i: kept[i] for i in sorted(firsts(kept))}
    assert {r["doc_id"]: r["text"] for r in outs["near_dedup"].collect()} == kept
    items = duckdb.sql(f"SELECT item_id, text FROM '{sf_dir}/benchmark.parquet'").fetchall()
    hits = dict(zip(kept, brute.contamination(list(kept.values()), items)))
    kept = {i: t for i, t in kept.items() if not (hits[i][1] and 20 * hits[i][1] >= hits[i][0])}
    assert {r["doc_id"] for r in outs["decontaminate"].collect()} == set(kept)
    clean = {r["doc_id"]: r for r in outs["private_data"].collect()}
    assert set(clean) == set(kept)
    expected = {r["doc_id"]: r["text"] for r in surrogates.replace(outs["decontaminate"], corpus_pipeline.SURROGATE_KEY).collect()}
    assert {i: r["text"] for i, r in clean.items()} == expected
    encode = packing.Encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    pieces = defaultdict(list)
    for r in outs["pack_sequences"].collect():
        pieces[r["doc_id"]].append((r["start"], r["ids"]))
    assert set(pieces) == set(kept)
    for doc, some in pieces.items():
        whole = [x for _, ids in sorted(some) for x in ids]
        assert np.array(whole, "<u4").tobytes() == encode(clean[doc]["text"])
