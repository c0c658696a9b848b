"""The compression bands reject what they are for: random tokens of every length class, filler anywhere in the text."""
import random
import string

import duckdb
import pytest
import zstandard
from pyspark.sql import functions as F

from statement_spark.llm import compression_bands

PACKER = zstandard.ZstdCompressor(level=3)
LENGTHS = [256, 362, 511, 724, 1023, 1448, 2047, 2896, 4096, 8192, 16384, 32768, 65536, 131072]


def tokens(alphabet, n, seed=3):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(alphabet) for _ in range(8)) for _ in range(n // 9 + 1))[:n].encode()


@pytest.fixture(scope="module")
def bands(spark):
    fitted = compression_bands.fit(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))
    return [compression_bands.Bands(), fitted]


@pytest.fixture(scope="module")
def clean():
    sql = "SELECT text FROM '/root/testdata/sf0.1/documents.parquet' JOIN '/root/testdata/sf0.1/labels.parquet' USING (doc_id) WHERE quality = 1 ORDER BY doc_id"
    return [t.encode() for (t,) in duckdb.sql(sql).fetchall()]


@pytest.mark.parametrize("n", LENGTHS)
def test_random_tokens_of_every_class(bands, n):
    alphabets = [string.ascii_letters + string.digits + "+/", string.ascii_lowercase + string.digits]
    for b in bands:
        for alphabet in alphabets + ["0123456789abcdef"] * (n >= 4096):
            assert compression_bands.band_verdict(tokens(alphabet, n), b, PACKER)[2] == "incompressible"


def test_clean_text_stays(bands, clean):
    for b in bands:
        assert sum(compression_bands.band_verdict(t, b, PACKER)[2] != "ok" for t in clean) <= len(clean) / 1000


def test_filler_behind_the_last_full_chunk_and_in_short_texts(bands, clean):
    prose = b" ".join(t for t in clean if len(t) > 6000)[:40_000]
    for b in bands:
        for n, filler in [(12287, 4095), (8190, 3190), (8191, 2700), (4000, 1600), (1500, 700), (20_000, 7500)]:
            text = prose[:n - filler] + (b"buy now cheap " * 800)[:filler]
            assert compression_bands.band_verdict(text, b, PACKER)[2] != "ok", (n, filler)
            assert compression_bands.band_verdict(prose[:n], b, PACKER)[2] == "ok"


def test_limits_follow_the_table(spark):
    words = ["".join(random.Random(i).choices("abcdefgh", k=6)) for i in range(500)]
    rows = [(i, " ".join(random.Random(i).choices(words, k=200))) for i in range(60)] + [(99, None), (98, "")]
    docs = spark.createDataFrame(rows * 3, "doc_id long, text string")
    own = compression_bands.fit(docs, least_texts=50)
    assert own != compression_bands.Bands() and compression_bands.fit(docs) == compression_bands.Bands()
    assert compression_bands.fit(docs.where(F.lit(False))) == compression_bands.Bands()
    found = {r["quality"]["verdict"] for r in compression_bands.judge(docs, bands=own).where("doc_id < 60").collect()}
    assert not found & {"repetitive", "incompressible"}


def test_long_clean_texts_stay_and_long_repeats_go(bands):
    """Clean texts of one language joined up to 1 MB and 4 MB; a passage over and over."""
    sql = ("SELECT lang, string_agg(text, chr(10) ORDER BY doc_id) FROM '/root/testdata/sf0.1/documents.parquet' "
           "JOIN '/root/testdata/sf0.1/labels.parquet' USING (doc_id) WHERE quality = 1 GROUP BY lang")
    joined = {lang: text.encode() for lang, text in duckdb.sql(sql).fetchall()}
    assert len(joined) == 4
    for b in bands:
        for text in joined.values():
            for n in (50_000, 200_000, 800_000, 1_000_000, 4_000_000):
                assert compression_bands.band_verdict(text[:n], b, PACKER)[2] == "ok"
            assert compression_bands.band_verdict(text[:30_000] * 40, b, PACKER)[2] == "repetitive"
