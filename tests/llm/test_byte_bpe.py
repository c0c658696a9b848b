"""Byte-level BPE against merges done by hand, on odd texts and at every cut."""
import base64
import hashlib
import random

import duckdb
import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken

from statement_spark.llm import byte_bpe, queries

FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = regex.compile(public_tokenizers.PATTERN)
LONG = 1_200_000


@pytest.fixture(scope="module")
def ranks():
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(FILE, "rb"))}


def by_hand(text, ranks, known={}):
    """Ids of every match, its lowest-ranked neighbours merged until none is in the vocabulary."""
    found = []
    for match in PATTERN.findall(text):
        if match not in known:
            parts = [bytes([b]) for b in match.encode()]
            while len(parts) > 1:
                rank, at = min((ranks.get(a + b, 1 << 40), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
                if rank == 1 << 40:
                    break
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
            known[match] = [ranks[p] for p in parts]
        found += known[match]
    return found


def test_query_on_the_table(spark, sf_dir, ranks):
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall())
    rows = queries.QUERIES["op13_byte_bpe"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r["doc_id"]] or ""
        ids = np.array(by_hand(text, ranks), "<u4")
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


ODD = [
    "it's we'll THEY'RE 'tis ''s x's", "a  b   c\n\n d \t\te  ", "  ", " \n", "<|endoftext|> 1,234.5e-6 ²½Ⅷ", "漢字かなカナ한국어。次！",
    "\x1c\x1d a\x85b　　c  d", "é क्षि हिन्दी भाषा ‍👩‍👧", "\0\0 \x7f", "ab'c 'd'e! 'f", "x" * 3000, "!'s" * 50,
]


def test_cuts_change_nothing(ranks):
    rng, own = random.Random(5), byte_bpe.vocabulary(FILE, public_tokenizers.PATTERN)
    alphabet = "ab'sé漢。!? \t\n　\x851½"
    texts = ODD + ["".join(rng.choices(alphabet, k=6000)) for _ in range(30)] + ["a" + " " * n + end for n in (4094, 4095, 4096, 4097, 9000) for end in ("", "b", "\n", "'s")]
    for text in texts:
        expected = by_hand(text, ranks)
        for size in (1, 3, 50, 1 << 16):
            parts = list(byte_bpe.segments(text, size))
            assert "".join(p for p, _ in parts) == text
            got = [i for p, single in parts for i in (own.whole if single else own.split).encode_ordinary(p)]
            assert got == expected, (text[:40], size)
        assert np.frombuffer(own.encode(text), "<u4").tolist() == expected


def test_long_texts_are_whole():
    own = byte_bpe.vocabulary(FILE, public_tokenizers.PATTERN)
    for part in ("a", "é", "ab", "12", "!", " ", "\n", "word and it's ", "。字", " \n"):
        text = part * (LONG // len(part))
        assert own.decode(own.encode(text)) == text.encode()
    text = "left " + " " * LONG + "right"
    blanks = own.whole.encode_ordinary(" " * LONG)
    assert np.frombuffer(own.encode(text), "<u4").tolist() == own.split.encode_ordinary("left") + blanks + own.split.encode_ordinary(" right")
    prose = "word and it's 12 more.\n" * 20_000  # as the library does without cuts
    assert np.frombuffer(own.encode(prose), "<u4").tolist() == own.split.encode_ordinary(prose)


def test_odd_tables(spark):
    rows = [(1, None, "x"), (2, "", None), (2, "", None), (None, "a b", "y"), *((9, t, "z") for t in ODD)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").selectExpr("*", "'k' AS _row", "1 AS _in", "2 AS _out")
    coded = byte_bpe.encode(docs, FILE, public_tokenizers.PATTERN, segment_chars=5)
    assert coded.columns == docs.columns
    out = byte_bpe.decode(coded, FILE, public_tokenizers.PATTERN)
    assert out.columns == [*docs.columns, "decoded"]
    got = out.collect()
    assert sorted(bytes(r["decoded"]) for r in got) == sorted((t or "").encode() for _, t, _ in rows)
    assert [bytes(r["ids"]) for r in got if r["text"] is None] == [b""]
    assert byte_bpe.encode(docs.where("false"), FILE, public_tokenizers.PATTERN).collect() == []
    bad = spark.createDataFrame([(None,), (b"\x01\x02",), (b"\xff\xff\xff\x7f",), (b"\x00\x00\x00\x00" * 3,)], "ids binary")
    decoded = [r["decoded"] for r in byte_bpe.decode(bad, FILE, public_tokenizers.PATTERN).collect()]
    assert decoded[:3] == [None] * 3 and decoded[3] is not None


def test_ids_cut_inside_a_character():
    own = byte_bpe.vocabulary(FILE, public_tokenizers.PATTERN)
    ids = own.encode("ẞ⾡")
    assert b"".join(own.decode(ids[i:i + 4]) for i in range(0, len(ids), 4)) == "ẞ⾡".encode()
    assert isinstance(own.split, tiktoken.Encoding)
