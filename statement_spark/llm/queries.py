"""Registered queries of the corpus operators and their SQL twins."""
from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from statement_spark.llm import byte_bpe, compression_bands, language_id, license_rules, packing, phrase_counting, positional_index, quality_net, simhash_pivots, source_divergence, suffix_dedup, surrogates, warc_derivatives, warc_sql
from statement_spark.llm.common import fold, table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")  # the ranks of byte_bpe_50k.json

MULTILINGUAL = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

SURROGATE_KEY = "statement-spark"  # a caller's own key keeps his surrogates apart from those here

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


@query("op1_language_id")
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = fold("doc_id", 5) == 0
    model = language_id.fit(docs, train=~held_out)
    found = language_id.identify(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id", held_out.alias("held_out"), F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"),
        F.col("language.margin").alias("margin"), F.col("language.rejected").alias("rejected"),
    )


@query("op2_surrogates")
def op2_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = surrogates.replace(docs, SURROGATE_KEY)
    return found.select(
        "doc_id", "text", F.aggregate(F.map_values("replaced"), F.lit(0), lambda a, b: a + b).alias("n_replaced"),
        F.array_join(F.array_sort(F.map_keys("replaced")), ",").alias("types"))


@query("op3_positional_index", """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
bw AS (
  SELECT item_id, least(len(w), 13) AS k, array_to_string(w[s : s + least(len(w), 13) - 1], ' ') AS t
  FROM (SELECT *, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS s FROM b WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, s, k, array_to_string(w[s : s + k - 1], ' ') AS t
  FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS s
        FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k)),
hits AS (SELECT doc_id, s, k, item_id FROM dw JOIN bw USING (k, t)),
spots AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(s, s + k - 1)) AS p FROM hits) GROUP BY 1),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hits) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN spots USING (doc_id) LEFT JOIN named USING (doc_id)
""")
def op3_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    found = positional_index.matches(docs, benchmark)
    return found.select(
        "doc_id", "contamination.n_words", "contamination.n_hit", F.size("contamination.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("contamination.items", ","), 256).alias("items_sha256"),
        positional_index.contaminated().alias("contaminated"),
    )


@query("op4_packing")
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, packing.Settings(VOCABULARY), with_ids=False)


@query("op5_suffix_dedup")
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "dedup.n_bytes", "dedup.n_removed", "dedup.n_spans", F.sha2("dedup.kept", 256).alias("kept_sha256"),
        F.octet_length("dedup.kept").cast("bigint").alias("n_kept"), F.make_valid_utf8(F.col("dedup.kept").cast("string")).alias("text"))


@query("op6_quality_net")
def op6_quality_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = quality_net.fit(docs, labels, learn=fold("id", 4) != 2)
    return quality_net.score(docs, model).select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op7_compression_bands")
def op7_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return compression_bands.judge(docs, bands=compression_bands.fit(docs)).select("doc_id", "quality.*")


@query("op8_warc_derivatives", warc_sql.pages_sql())
def op8_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_derivatives.derive(table(spark, sf_dir, "pages"), key="page_id")


@query("op9_license_rules")
def op9_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_rules.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "licenses.n_words", "licenses.n_base", "licenses.first_word", "licenses.last_word",
        F.array_join("licenses.base_labels", ",").alias("base_labels"), F.array_join("licenses.labels", ",").alias("labels"),
        "licenses.score",
    )


@query("op10_simhash_pivots")
def op10_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_pivots.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op11_source_divergence", """
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w, row_number() OVER () AS id
  FROM documents),
t AS (SELECT lang, source, id, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS c FROM t GROUP BY ALL HAVING count(DISTINCT id) >= 10),
langs AS (SELECT lang, sum(c)::HUGEINT AS n, count(*) AS v FROM kept GROUP BY ALL),
grp AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT t.lang, t.source, term, count(*) AS c FROM t JOIN kept USING (lang, term) GROUP BY ALL),
sizes AS (SELECT lang, source, coalesce(sum(c), 0)::HUGEINT AS n FROM grp LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (
  SELECT lang, source, k.term, coalesce(c.c, 0) AS c, 1 + 1000000000::HUGEINT * (coalesce(c.c, 0) + 2) // (s.n + 2 * l.v) AS p,
         1 + 1000000000::HUGEINT * (k.c + 2) // (l.n + 2 * l.v) AS q
  FROM sizes s JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN c USING (lang, source, term)),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(v, 0)::BIGINT AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source AS s, y.source AS o, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS v
             FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) f
    ON f.lang = a.lang AND f.s = a.source AND f.o = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value FROM p WHERE c > 0 AND p > q)
SELECT * FROM (
  SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
WHERE part = 'pair' OR rank <= 10
""")
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(table(spark, sf_dir, "documents").select("text", "lang", "source"))


@query("op12_phrase_counting", """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
f AS (
  SELECT lang, k, array_to_string(w[s : s + k - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, k, unnest(generate_series(1, len(w) - k + 1)) AS s FROM w, (SELECT unnest([1, 2, 3, 4]) AS k))
  GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY ALL),
c AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, f AS a FROM f WHERE k > 1 AND f >= 30),
cuts AS (SELECT *, unnest(generate_series(1, k - 1)) AS j FROM c),
scored AS (
  SELECT cuts.lang, cuts.phrase, a, j, x.f AS l, y.f AS r, (2000000::HUGEINT * a // (x.f + y.f))::BIGINT AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = array_to_string(cuts.w[1 : j], ' ')
  JOIN f y ON y.lang = cuts.lang AND y.phrase = array_to_string(cuts.w[j + 1 : cuts.k], ' ')),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inner_ AS (
  SELECT lang, array_to_string(w[s : s + m - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(generate_series(1, k - m + 1)) AS s FROM (SELECT *, unnest(generate_series(2, k - 1)) AS m FROM c)) GROUP BY ALL),
kept AS (SELECT weakest.* FROM weakest LEFT JOIN inner_ USING (lang, phrase) WHERE longer IS NULL OR 100 * longer::HUGEINT < 80 * a::HUGEINT)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) JOIN n USING (lang) WHERE rank <= 2000
""")
def op12_phrase_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_counting.collocations(table(spark, sf_dir, "documents").select("text", "lang"))


@query("op13_byte_bpe")
def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = byte_bpe.encode(docs, MULTILINGUAL, public_tokenizers.PATTERN)
    found = byte_bpe.decode(coded, MULTILINGUAL, public_tokenizers.PATTERN)
    return found.select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
