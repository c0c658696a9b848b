"""Language and band verdicts worked out again without the operators' own code, on a whole small table."""
import bisect
import math
import unicodedata

import duckdb
import pytest
import zstandard

from statement_spark.llm import compression_bands, language_id


@pytest.fixture(scope="module")
def texts(sf_dir):
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall())


def test_the_smallest_size_wins(spark, sf_dir, texts):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = language_id.fit(docs)
    found = {r["doc_id"]: r["language"]["lang"] for r in language_id.identify(docs, model).collect()}
    own = model.settings
    params = zstandard.ZstdCompressionParameters.from_level(own.level, write_content_size=False, write_checksum=False, write_dict_id=False)
    packers = [(name, zstandard.ZstdCompressor(compression_params=params, dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT)))
               for name, d in model.dictionaries]
    assert len(packers) == 4
    for doc, text in texts.items():
        kept = "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in (text or "").lower())
        body = " ".join(kept.split()).encode()
        sizes = [sum(len(p.compress(body[i:i + own.chunk_bytes])) for i in range(0, len(body), own.chunk_bytes)) for _, p in packers]
        best = min(range(len(sizes)), key=lambda i: (sizes[i], i))
        assert found[doc] == (packers[best][0] if body else "und")


def between(lengths, values, n):
    """The value at length n on straight lines over the length's logarithm, flat at both ends."""
    k = bisect.bisect_left(lengths, n)
    if k == 0 or k == len(lengths):
        return values[min(k, len(lengths) - 1)]
    share = math.log(n / lengths[k - 1]) / math.log(lengths[k] / lengths[k - 1])
    return values[k - 1] + share * (values[k] - values[k - 1])


def test_band_verdicts(spark, sf_dir, texts):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    bands, packer = compression_bands.Bands(), zstandard.ZstdCompressor(level=3)
    lengths = [c[0] for c in bands.classes]
    lows = [0.86 * m for _, m, _ in bands.classes]
    highs = [m * (1 + min(0.18, max(0.08, 4 * (h / m - 1)))) for _, m, h in bands.classes]

    def inside(part, slack):
        low = between(lengths, lows, len(part)) * (0.94 ** max(0.0, math.log2(len(part) / lengths[-1])))
        return slack * low <= len(packer.compress(part)) / len(part) <= between(lengths, highs, len(part))

    verdicts = set()
    for r in compression_bands.judge(docs, bands=bands).collect():
        body, q = (texts[r["doc_id"]] or "").encode(), r["quality"]
        bad, step = 0, 4096 if len(body) >= 8192 else 512
        for at in range(0, len(body) if len(body) >= 1024 else 0, step):
            part = body[at:at + step]
            bad += 0 if inside(part if len(part) >= 256 else body[-256:], 0.93) else len(part)
        whole = len(body) < 256 or inside(body, 1)
        assert (q["verdict"] == "ok") == (whole and (not body or bad / len(body) <= 0.3)), r["doc_id"]
        assert q["kept"] == (q["verdict"] == "ok" and not q["base_failed"])
        verdicts.add(q["verdict"])
    assert len(verdicts) > 1
