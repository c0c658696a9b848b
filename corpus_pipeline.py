"""The corpus pipeline: documents in, packed training sequences out.

STAGES are (name, function) pairs; each function takes (spark, docs, sf_dir) and returns what its successor reads: all
but the last the columns of documents, the last the pieces of the packed sequences with their token ids.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from statement_spark.llm import compression_bands, near_copies, packing, positional_index, surrogates
from statement_spark.llm.common import table
from statement_spark.session import staged

SURROGATE_KEY = "statement-spark"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the compression bands."""
    return compression_bands.keep(docs, bands=compression_bands.fit(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of texts linked by a five-word similarity of 0.8 or more the document with the smallest id.

    Fingerprints and pivot tables of operator 10 find pairs first, prefixes the pairs that are farther apart than two bits."""
    return near_copies.keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words less than a twentieth stand in benchmark passages."""
    found = positional_index.matches(docs, table(spark, sf_dir, "benchmark"))
    return found.where(~positional_index.contaminated()).select(*docs.columns)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data and secrets; n_chars follows the text."""
    changed = surrogates.replace(docs, SURROGATE_KEY)
    n_chars = F.when(F.size("replaced") > 0, F.char_length("text")).otherwise(F.col("n_chars")).cast("bigint")
    return changed.withColumn("n_chars", n_chars).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of the sequences, with its token ids."""
    return packing.pack(docs, packing.Settings(public_tokenizers.path("byte_bpe_50k.tiktoken")))


STAGES = [
    ("quality_rules", quality_rules), ("near_dedup", near_dedup), ("decontaminate", decontaminate),
    ("private_data", private_data), ("pack_sequences", pack_sequences),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each stage's rows are written to the shared folder and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
