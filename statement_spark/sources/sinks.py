"""Value, run and status tables on partitioned parquet: upsert, delete, save gate.

Parquet has no MERGE, so a change rewrites the partitions it touches: buckets of companies within a year, or of the run
table, so that a load of few companies rewrites few buckets. How many buckets a table has is settled by its first load, from
its rows, and kept next to it; ``rebucket`` moves a table that has outgrown them to a new place. A load is written twice:
as it comes, which ends its lineage, and merged, by dynamic partition overwrite, which
puts new files in place once all are written. A table has one writer at a time. Rows that lack a partition value can't
be found again by it; they go to the table's rejects, next to it, in a folder of the load's own, which a repeated load replaces.
"""
from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType, TimestampType

from ..functions import fiscal
from ..session import small, staged

VALUE_KEY = ["concept_id", "end_date", "form_type", "quarter"]
VALUE_PARTITIONS = ["period_type", "fiscal_year", "bucket"]
ROWS_PER_BUCKET = 200_000


def value_rows(values: DataFrame, filings: DataFrame, filing: str = "filing_id") -> DataFrame:
    """Rows of the value table from concept values and their filings.

    ``filings``: filing, cik, company_name, fye_month, fye_code, period_text, report_date,
    period_override, loaded_at. A filing without an end date gives no rows.
    """
    text = F.coalesce("period_text", F.lit(""))
    f = filings.withColumn("end_date", fiscal.save_end_date(text, F.col("report_date"))).filter(
        "end_date is not null")
    route = fiscal.save_route(F.col("period_override"), F.col("end_date"), F.col("fye_month"), text)
    fy, q = fiscal.fiscal_period(F.col("end_date"), F.col("fye_month"), text)
    f = f.withColumn("period_type", route).withColumns({
        "form_type": fiscal.form_type(F.col("period_type")),
        "fiscal_year": fy,
        "quarter": F.when(F.col("period_type") == "quarterly", q),
        "start_date": F.when(F.col("period_type") == "quarterly", fiscal.period_start(text, F.col("end_date"))),
    })
    return values.join(f, filing).select(
        "concept_id", "cik", "company_name", F.lit("income_statement").alias("statement_type"),
        "form_type", "end_date", "start_date", "quarter", "fye_code",
        F.lit("earnings_press_release").alias("data_source"), F.lit("USD").alias("unit"),
        F.col("value").cast("double").alias("value"), F.col("derived").alias("calculated"),
        F.lit(True).alias("earning_data"), F.lit(False).alias("dimension_value"),
        F.col("loaded_at").alias("created_at"), "period_type", "fiscal_year",
    )


def bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The stored rows; none before the first load."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _side(path: str, name: str) -> str:
    return f"{path.rstrip('/')}_{name}"


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def bucket_count(spark: SparkSession, path: str, rows: DataFrame | None = None, by: list[str] | None = None,
                 rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    """The table's number of buckets (one if there is no table). With ``rows`` a table without a number gets one, so
    that the largest of the groups ``by`` falls into buckets of ``rows_per_bucket``."""
    side = _side(path, "buckets")
    if _exists(spark, side):
        return spark.read.schema("n int").parquet(side).first()["n"]
    if rows is None:
        return 1
    largest = rows.groupBy(*(by or [])).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    return _set_bucket_count(spark, path, max(1, -(-largest // rows_per_bucket)))


def _set_bucket_count(spark: SparkSession, path: str, n: int) -> int:
    spark.createDataFrame([(n,)], "n int").coalesce(1).write.mode("overwrite").parquet(_side(path, "buckets"))
    return n


def rebucket(spark: SparkSession, path: str, to: str, key: str, partitions: list[str], n: int) -> None:
    """Copy the table to an empty place with another number of buckets; the caller switches over and drops the old one."""
    rows = spark.read.parquet(path).withColumn("bucket", bucket(key, n))
    _set_bucket_count(spark, to, n)
    _replace(rows, to, partitions)


def rejects_path(path: str) -> str:
    return _side(path, "rejects")


def _replace(rows: DataFrame, path: str, partitions: list[str]) -> None:
    """Overwrite just the partitions of ``rows``. The rebalance gathers small partitions into
    few files and splits a large one over several tasks."""
    rows.hint("rebalance", *partitions).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def newest(rows: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """One row per key, the one with the highest ``order``: a grouped aggregate."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("r")).select(*keys, "r.*").select(
        *rows.columns)


def _touched(current: DataFrame, rows: DataFrame, partitions: list[str]) -> DataFrame:
    """Stored rows of the partitions that ``rows`` touches. The partition values are written first: with their size
    known they are broadcast, and the scan of ``current`` opens their folders only."""
    parts = staged(rows.select(*partitions).distinct(), "touched")
    return current.join(small(parts.filter(F.col(partitions[-1]) >= 0)), partitions, "left_semi")


def upsert(spark: SparkSession, rows: DataFrame, path: str, keys: list[str], partitions: list[str], by: str,
           order: str = "created_at", load: str | int | None = None) -> None:
    """Insert rows or replace those with the same key. Of equal keys the newest stays. ``by`` deals rows to buckets;
    ``load`` names the load, such as a stream's batch, for its rejects."""
    rows = staged(rows, "incoming")
    n = bucket_count(spark, path, rows, [p for p in partitions if p != "bucket"])
    rows = rows.withColumn("bucket", bucket(by, n))
    lacking = F.lit(False)
    for p in partitions:
        lacking = lacking | F.col(p).isNull()
    refused = rows.filter(lacking)
    if not refused.isEmpty():
        refused.write.mode("overwrite").parquet(f"{rejects_path(path)}/load={uuid.uuid4().hex if load is None else load}")
    rows = rows.filter(~lacking)
    current = _touched(_read(spark, path, rows.schema), rows, partitions)
    merged = newest(
        current.withColumn("src", F.lit(0)).unionByName(rows.withColumn("src", F.lit(1))),
        [*keys, *[p for p in partitions if p not in keys]], F.struct("src", order),
    ).drop("src")
    _replace(merged, path, partitions)


def upsert_values(spark: SparkSession, rows: DataFrame, path: str, load: str | int | None = None) -> None:
    upsert(spark, rows, path, VALUE_KEY, VALUE_PARTITIONS, "cik", load=load)


def delete_periods(spark: SparkSession, periods: DataFrame, path: str, schema: StructType) -> int:
    """Delete the values of (cik, period_type, fiscal_year, quarter) periods; returns how many.

    Only buckets of these companies are opened. Every touched partition is rewritten; its rows are marked, counted in one pass, and left out. A partition that
    lost all rows loses its folder, as the rows' files name it.
    """
    whole = schema if "bucket" in schema.names else StructType([*schema.fields, StructField("bucket", IntegerType())])
    stored = _read(spark, path, whole)
    by = ["period_type", "fiscal_year"]
    known = periods.filter("period_type is not null and fiscal_year is not null")
    placed = stored.withColumn("folder", F.regexp_extract(F.input_file_name(), "^(.*)/[^/]*$", 1))
    here = known.withColumn("bucket", bucket("cik", bucket_count(spark, path)))
    touched = _touched(placed, here, VALUE_PARTITIONS)
    p = known.select("cik", *by, "quarter", F.lit(True).alias("doomed")).distinct().alias("p")
    t = touched.alias("t")
    same = F.col("t.cik").eqNullSafe(F.col("p.cik")) & F.col("t.quarter").eqNullSafe(F.col("p.quarter"))
    for c in by:
        same = same & (F.col(f"t.{c}") == F.col(f"p.{c}"))
    marked = t.join(small(p), same, "left").select("t.*", F.coalesce("p.doomed", F.lit(False)).alias("doomed"))
    again = staged(marked, "stage")
    removed = again.filter("doomed").count()
    if removed:
        emptied = again.groupBy("folder").agg(F.bool_and("doomed").alias("all")).filter("all")
        _replace(again.filter("not doomed").select(*stored.columns), path, VALUE_PARTITIONS)
        _drop_folders(spark, emptied)
    return removed


def _drop_folders(spark: SparkSession, folders: DataFrame) -> None:
    """Remove the folders of partitions without rows, one by one."""
    jvm = spark._jvm
    for r in folders.select("folder").toLocalIterator():
        folder = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(r[0]))
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def upsert_runs(spark: SparkSession, runs: DataFrame, path: str) -> None:
    """Insert or replace run documents by ``_id`` with the time of writing; a missing id fails."""
    checked = runs.withColumn("_id", F.when(F.col("_id").isNull(), F.raise_error(
        F.lit("run document without _id"))).otherwise(F.col("_id")))
    upsert(spark, checked.withColumn("scraped_at", F.current_timestamp()), path, ["_id"], ["bucket"], "_id", "scraped_at")


def remember_keys(spark: SparkSession, keys: DataFrame, path: str, key: str) -> None:
    """Note the keys in a slim table of one row per key."""
    rows = keys.select(key).filter(F.col(key).isNotNull()).distinct()
    upsert(spark, rows.withColumn("created_at", F.current_timestamp()), path, [key], ["bucket"], key)


def known_keys(spark: SparkSession, wanted: DataFrame, path: str, key: str) -> DataFrame:
    """The noted rows in the buckets of the ``wanted`` keys."""
    schema = StructType([wanted.schema[key], StructField("created_at", TimestampType()), StructField("bucket", IntegerType())])
    return _touched(_read(spark, path, schema), wanted.select(bucket(key, bucket_count(spark, path)).alias("bucket")), ["bucket"])


def find_run(runs: DataFrame, ticker: Column, fiscal_year: Column, quarter: Column) -> DataFrame:
    return runs.filter(F.col("_id") == F.concat_ws("_", ticker, fiscal_year.cast("string"), quarter))


def save_gate(filings: DataFrame, strict: bool = True) -> DataFrame:
    """Add ``saved`` and ``reason``. A strict run refuses identity warnings; values, company,
    year-end month and a period are needed in any case."""
    problems = F.array_compact(F.array(
        F.when(F.coalesce("n_values", F.lit(0)) == 0, F.lit("no values")),
        F.when(F.col("cik").isNull(), F.lit("no company")),
        F.when(F.col("fye_month").isNull(), F.lit("no fiscal year end")),
        F.when((F.coalesce("period_text", F.lit("")) == "") & F.col("report_date").isNull(), F.lit("no period")),
    ))
    refused = F.lit(strict) & (F.size("identity_warnings") > 0)
    reason = F.when(refused, "identity checks failed").when(F.size(problems) > 0, F.array_join(problems, ", "))
    return filings.withColumn("reason", reason).withColumn("saved", F.col("reason").isNull())


def load_gate(filings: DataFrame, companies: DataFrame, concepts: DataFrame) -> DataFrame:
    """Filings with status: skipped without a known company or without concepts."""
    c = companies.select("ticker", F.col("cik").alias("company_cik"), "fye_month", "fye_code")
    n = concepts.groupBy(F.col("cik").alias("company_cik"), "period_type").agg(F.count(F.lit(1)).alias("n_concepts"))
    out = filings.join(small(c), "ticker", "left").join(n, ["company_cik", "period_type"], "left")
    reason = F.when(F.col("company_cik").isNull(), "no historical data for the company").when(
        F.col("n_concepts").isNull(), "no income-statement concepts stored")
    return out.withColumn("reason", reason).withColumn(
        "status", F.when(F.col("reason").isNotNull(), "skipped").otherwise("ready"))


def latest_status(updates: DataFrame) -> DataFrame:
    """Newest status per load request."""
    return updates.groupBy("load_request_id").agg(
        F.max_by(F.struct("status", "period_label"), "event_time").alias("s"),
        F.max("event_time").alias("updated_at")).select("load_request_id", "s.*", "updated_at")
