"""Helpers shared by the corpus operators: table reads, folds and fixed word alphabets."""
from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# What separates words, as a pattern and as bytes.
ALNUM_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BLANKS = b" \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else, whatever the session's locale."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo `folds`."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def octets(text: str) -> Column:
    """A text column as UTF-8 bytes, the form in which texts go to Python."""
    return F.col(text).cast("binary")


def boxed(docs: DataFrame, **more: Column) -> DataFrame:
    """All columns of `docs` in one struct `_row`, with `more` beside it, so that no working name can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *[v.alias(k) for k, v in more.items()])


def unboxed(rows: DataFrame, columns: list[str], **results: Column) -> DataFrame:
    """The columns out of `_row` and the results after them; a result takes the place of a column of its name."""
    kept = [results.pop(c).alias(c) if c in results else F.col(f"_row.`{c}`") for c in columns]
    return rows.select(*kept, *[v.alias(k) for k, v in results.items()])


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """What is run inside gives its rows to Python so many at a time: a batch is limited by rows only, however large they are."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)
