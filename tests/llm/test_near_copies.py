"""The near_dedup stage against brute-force Jaccard similarity of five-word shingles."""
import os
import random
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

import corpus_pipeline  # noqa: E402
from statement_spark.llm import near_copies  # noqa: E402


def firsts(texts):
    """Smallest id of every component of the pairs with a similarity of 0.8 or more."""
    sets = {}
    for i, text in texts.items():
        words = brute.BLANK.findall(brute.lowered(text))
        sets[i] = {" ".join(words)} if len(words) < 5 else {" ".join(words[k:k + 5]) for k in range(len(words) - 4)}
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sorted(sets):
        for b in sets:
            if a < b and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {i for i in root if top(i) == i}


def test_stage_on_the_table(spark, sf_dir):
    for table in (sf_dir, "/root/testdata/sf0.01"):
        docs = spark.read.parquet(f"{table}/documents.parquet")
        texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{table}/documents.parquet'").fetchall())
        kept = corpus_pipeline.near_dedup(spark, docs, table)
        assert {r["doc_id"] for r in kept.collect()} == firsts(texts)


@pytest.mark.parametrize("pair_limit,sample_texts", [(2, 40), (8, 20_000)])
def test_large_groups_chains_and_edges_of_the_rule(spark, pair_limit, sample_texts):
    rng = random.Random(pair_limit)
    words = ["".join(rng.choice("abcdefghij") for _ in range(7)) for _ in range(4000)]
    texts = []
    for _ in range(3):
        base = rng.choices(words, k=120)
        for _ in range(90):  # copies, most of whose pairs lie on either side of the limit
            copy = list(base)
            for at in rng.sample(range(120), rng.randint(0, 5)):
                copy[at] = rng.choice(words)
            texts.append(" ".join(copy))
    line = " ".join(words[:9])
    texts += [" ".join(rng.choices(words, k=40)) + " " + line for _ in range(60)]
    texts += [" ".join(words[i:i + 44]) for i in range(0, 60, 2)]  # a chain
    texts += [" ".join(words[100:149]), " ".join(words[100:140]), " ".join(words[100:150]), "a b", "A  B", "a b c", "", None, " "]
    rng.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = near_copies.keep_first(docs, pair_limit=pair_limit, sample_texts=sample_texts)
    assert {r["doc_id"] for r in kept.collect()} == firsts(dict(enumerate(texts)))


def test_rows_are_known_by_id_and_text(spark):
    a, b = " ".join(f"w{i}" for i in range(60)), " ".join(f"v{i}" for i in range(60))
    rows = [(1, a, "x"), (1, b, "y"), (2, a, "z"), (2, b + " more", "z"), (3, "own text here", "q"), (3, "own text here", "p"), (None, a, "n"), (None, None, "m")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id string")
    got = sorted(map(str, (tuple(r) for r in near_copies.keep_first(docs).collect())))
    assert got == sorted(map(str, [(1, a, "x"), (1, b, "y"), (3, "own text here", "p"), (None, a, "n"), (None, None, "m")]))


def test_a_line_shared_by_thousands_and_groups_around_the_limit(spark):
    """Short texts that are mostly one line, and one large group most of whose pairs lie near the limit."""
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefghij") for _ in range(7)) for _ in range(4000)]
    line, base = words[:14], words[100:160]
    texts = [" ".join(line + rng.choices(words, k=rng.randint(0, 3))) for _ in range(500)]
    for _ in range(400):
        copy = list(base)
        for at in rng.sample(range(60), rng.randint(0, 3)):
            copy[at] = rng.choice(words)
        texts.append(" ".join(copy))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["doc_id"] for r in near_copies.keep_first(docs).collect()} == firsts(dict(enumerate(texts)))


def test_sketches_never_screen_out_a_linked_pair():
    rng = random.Random(9)
    for _ in range(200):
        x = set(rng.sample(range(1 << 62), rng.randint(1, 400)))
        y = set(rng.sample(sorted(x), len(x) - len(x) // 12)) | set(rng.sample(range(1 << 62), len(x) // 12))
        a, b = (near_copies.sketch(near_copies.np.array(sorted(s), "<i8")) for s in (x, y))
        for cells in (near_copies.WIDE_CELLS, near_copies.SKETCH_CELLS):
            apart = near_copies.folded(a, cells) ^ near_copies.folded(b, cells)
            assert sum((int(v) & 0xFFFFFFFFFFFFFFFF).bit_count() for v in apart) <= len(x ^ y)
        own = near_copies.np.array(sorted(x), "<i8")
        assert (near_copies.folded(a, 256) == near_copies.sketch(own, 256)).all()


def test_one_python_step_in_a_pass(spark, monkeypatch):
    """Fingerprints and prefixes read the texts in passes of their own, so that a core holds one Python worker."""
    plans, staged = [], near_copies.staged
    monkeypatch.setattr(near_copies, "staged", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or staged(df, name))
    docs = spark.createDataFrame([(1, "a b c"), (2, None), (3, "a b c"), (None, "d")], "doc_id long, text string")
    rows = near_copies._texts(docs, 5, 80, 1000).collect()
    assert [p.split("\n\n")[0].count("ArrowEvalPython") for p in plans] == [1, 1]
    assert sorted((r["first"] or 0, r["size"]) for r in rows) == [(0, 1), (1, 1), (2, 1)]


def test_pairs_are_found_by_fingerprints_first(spark, monkeypatch):
    """The edges of operator 10 that reach the similarity; none of their pairs is verified a second time."""
    rng = random.Random(10)
    words = ["".join(rng.choice("abcdefghij") for _ in range(7)) for _ in range(3000)]
    texts = {}
    for i in range(12):
        base = rng.choices(words, k=900)
        copy = list(base)
        copy[i * 7] = rng.choice(words)
        texts[2 * i], texts[2 * i + 1] = " ".join(base), " ".join(copy)
    texts |= {100: "a b", 101: "A  B", 102: "", 103: " "}
    prints = {i: brute.fingerprint(t) for i, t in texts.items()}
    near = {(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2}
    assert len(near) > 4
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    own = near_copies._texts(docs, 5, 80, 1000)
    ids = {r["node"]: r["first"] for r in own.collect()}
    edges = {tuple(sorted((ids[r["a"]], ids[r["b"]]))) for r in near_copies.fingerprint_links(docs, own).collect()}
    assert edges == {(a, b) for a, b in near if near_copies.similar(texts[a].encode(), texts[b].encode())}

    found, verified = [], near_copies._verified
    monkeypatch.setattr(near_copies, "_verified", lambda *args: found.append(verified(*args)) or found[-1])
    kept = corpus_pipeline.near_dedup(spark, docs, "")
    assert {r["doc_id"] for r in kept.collect()} == firsts(texts)
    assert len(found) == 3 and found[0].count() == len(edges) and found[1].count() == 12 + 2 - len(edges)
