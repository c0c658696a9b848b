"""Source divergence against plain counting, with groups, ties and odd rows that the tables lack."""
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from statement_spark.llm import source_divergence

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def audited(rows, least_docs=10, ranks=10):
    """The audit of (text, lang, source) rows by counting every term of every pair."""
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        words = TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        groups[lang].add(source)
        counts[lang, source].update(words)
        counts[lang].update(words)
        docs[lang].update(set(words))
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least_docs]

        def share(of, v=len(kept), kept=kept):
            n = sum(of[t] for t in kept)
            return {t: 1 + 10**9 * (of[t] + 2) // (n + 2 * v) for t in kept}

        whole, p = share(counts[lang]), {s: share(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(-sum((p[s][t] - p[o][t])**2 // (p[s][t] + p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            own = [(-((p[s][t] - whole[t])**2 // (p[s][t] + whole[t])), t.encode(), t) for t in kept if counts[lang, s][t] and p[s][t] > whole[t]]
            out |= {(lang, s, "pair", item, -v, i + 1) for i, (v, _, item) in enumerate(sorted(pairs))}
            out |= {(lang, s, "term", item, -v, i + 1) for i, (v, _, item) in enumerate(sorted(own)[:ranks])}
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string, source string").selectExpr("*", "1 AS n", "'x' AS term", "'y' AS counts", "2 AS value")


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    words = ["Wort", "über", "não", "x", "É", "zz", *("".join(rng.choices("abcdeÄé", k=rng.randint(1, 3))) for _ in range(60))]
    found = []
    for i in range(400):
        lang, source = rng.choice(["de", "fr", None, ""]), rng.choice(["a", "b", "ä", "Z", None, "hot", "hot", "hot"])
        found.append((rng.choice([" ", "3", "-", "\n"]).join(rng.choices(words, k=rng.randint(0, 40))), lang, source))
    found += [("hot copy of one text", "de", "hot")] * 150  # copies
    found += [(None, "de", "bare"), ("", "fr", "bare"), ("123 ...", None, "bare"), ("rare words only", "xx", "p"), ("other", "xx", "q"), (None, "yy", "alone")]
    found += [("twin " * 3, "tw", s) for s in "abcd" for _ in range(4)]  # ties in all pairs
    rng.shuffle(found)
    return found


@pytest.mark.parametrize("block_entries", [1, 7, 1 << 18])
def test_like_plain_counting(spark, rows, block_entries):
    got = [tuple(r) for r in source_divergence.audit(frame(spark, rows).repartition(5), block_entries=block_entries).collect()]
    assert len(got) == len(set(got)) and set(got) == audited(rows)
    few = source_divergence.audit(frame(spark, rows), least_docs=40, term_ranks=2, block_entries=block_entries).collect()
    assert {tuple(r) for r in few} == audited(rows, 40, 2)


def test_empty_tables_and_rows_without_terms(spark, rows):
    assert source_divergence.audit(frame(spark, rows).where("false")).collect() == []
    bare = [(None, None, "a"), ("", None, "b"), ("few", "", None)]
    assert {tuple(r) for r in source_divergence.audit(frame(spark, bare)).collect()} == audited(bare)


def test_columns_are_the_counts():
    rng = random.Random(2)
    rows = [("de", [{"source": s, "n": rng.randint(1, 3)} for s in "abc" if rng.random() < 0.5], rng.randint(1, 4)) for _ in range(300)]
    rows = sorted((r for r in rows if r[1]), key=lambda r: (len(r[1]), str(r[1]))) + [("fr", [{"source": "z", "n": 5}], 2)]
    batch = pa.RecordBatch.from_pylist([{"lang": a, "counts": b, "terms": c} for a, b, c in rows])
    for size in (1, 50, 10_000):
        whole = defaultdict(list)
        for block in source_divergence.run_columns(iter([batch.slice(0, 100), batch.slice(100)]), size):
            lang, length, columns = (block.column(i)[0].as_py() for i in range(3))
            runs = {c["source"]: np.repeat(c["counts"], np.diff(c["starts"], append=length)) for c in columns}
            assert all(all(a != b for a, b in zip(c["counts"], c["counts"][1:])) for c in columns)  # no run is cut
            for s in "abcz":
                whole[lang, s] += list(runs.get(s, np.zeros(length, int)))
        for lang, s in [("de", "a"), ("de", "b"), ("de", "c"), ("fr", "z")]:
            assert whole[lang, s] == [next((c["n"] for c in counts if c["source"] == s), 0) for own, counts, n in rows if own == lang for _ in range(n)]


def test_shares_of_counts_past_64_bits():
    assert source_divergence.shares([10**18, 0], 10**18, 1).tolist() == [1 + 10**9 * (10**18 + 2) // (10**18 + 2), 1]


def test_share_columns_past_64_bits(spark):
    from pyspark.sql import functions as F

    got = spark.range(1).select(source_divergence._share(F.lit(10**18), F.lit(3 * 10**18), F.lit(7)).alias("p")).first()["p"]
    assert got == 1 + 10**9 * (10**18 + 2) // (3 * 10**18 + 14)
