"""Packing gives the ids of `tokenizers`, also for texts that hold the vocabulary's added tokens."""
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings as given_settings, strategies as st
from tokenizers import Tokenizer

from statement_spark.llm import packing

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
MODEL = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
PARTS = st.one_of(st.just("<|endoftext|>"), st.sampled_from([" ", "  ", "\n", "<|", "|>", "endoftext", "it's", "é漢"]), st.text(max_size=12))


@given_settings(max_examples=300, deadline=None)
@given(st.lists(PARTS, max_size=12).map("".join))
def test_ids_with_added_tokens(text):
    want = MODEL.encode(text, add_special_tokens=False).ids + [0]
    assert np.frombuffer(packing.encoder(RANKS)(text), "<u4").tolist() == want


def test_packed_ids(spark):
    text = "some text <|endoftext|> more<|endoftext|>"
    want = [11246, 2420, 220, 50256, 517, 50256, 0]
    rows = packing.pack(spark.createDataFrame([(1, text)], "doc_id long, text string"), packing.Settings(RANKS)).collect()
    pieces = sorted((r["start"], r["ids"]) for r in rows)
    assert [i for _, ids in pieces for i in ids] == want and {r["doc_tokens"] for r in rows} == {len(want)}
    assert all(r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in rows)
