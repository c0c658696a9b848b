"""Filing intake, job states, status, progress and continuous load as streaming jobs.

What is kept per key is in ``keyed``; windows and sessions are aggregates, combined before the shuffle. Results go
out through ``foreachBatch`` into a table folder per batch, so a batch that runs twice after a
failure writes the same folder again.
"""
from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from ..session import small, work_dir
from ..sources import responses as RS, sinks
from . import keyed


# ---- sources and sinks ---------------------------------------------------------------------------

def read_table_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 1000) -> DataFrame:
    """Stream the parquet file or folder at ``path``, so many files to a batch."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory():
        return reader.parquet(path)
    folder, name = path.rsplit("/", 1)
    return reader.option("pathGlobFilter", name).parquet(folder)


def run_available(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
                  mode: str = "append") -> None:
    """Process what is there and stop; the same query without the trigger runs on."""
    stream.writeStream.foreachBatch(write).outputMode(mode).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def run_until_quiet(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, quiet_ms: int,
                    mode: str = "append") -> None:
    """Run a stream whose timers follow the clock, until ``quiet_ms`` after its last input a batch has ended.

    Such a stream never runs out of batches, so ``availableNow`` would not stop.
    """
    query = stream.writeStream.foreachBatch(write).outputMode(mode).option(
        "checkpointLocation", checkpoint).trigger(processingTime="200 milliseconds").start()
    try:
        seen, last_input = -1, None
        while query.isActive:
            for p in query.recentProgress:
                if p.batchId > seen or p.numInputRows:
                    begun = datetime.fromisoformat(p.timestamp.replace("Z", "+00:00")).timestamp() * 1000
                    if p.numInputRows:
                        last_input = max(last_input or 0, begun + p.batchDuration)
                    elif last_input is not None and begun > last_input + quiet_ms:
                        return
                    seen = p.batchId
            query.awaitTermination(0.1)
    finally:
        query.stop()


def to_table(path: str) -> Callable[[DataFrame, int], None]:
    """Batch writer: one folder per batch, replaced when a batch is repeated."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def run_to_table(spark: SparkSession, stream: DataFrame, mode: str = "append",
                 keys: list[str] | None = None) -> DataFrame:
    """Run a stream over the available input and return its result table.

    With ``keys`` the output is a change feed, and the newest batch of a key counts.
    """
    path = work_dir(spark, "stream")
    run_available(stream, to_table(f"{path}/out"), f"{path}/checkpoint", mode)
    out = spark.read.schema(StructType([*stream.schema.fields])).option("basePath", f"{path}/out").parquet(f"{path}/out/batch=*")
    if not keys:
        return out.select(*stream.columns)
    rows = spark.read.option("basePath", f"{path}/out").parquet(f"{path}/out/batch=*")
    return sinks.newest(rows, keys, F.col("batch")).select(*stream.columns)


# ---- operators ----------------------------------------------------------------------------------------

def intake(messages: DataFrame) -> DataFrame:
    """Valid 8-K jobs of a stream of message texts (``value``)."""
    return messages.withColumn("m", RS.parse_message(F.col("value"))).filter(
        RS.valid_message(F.col("m"))).select(*messages.columns, "m.*")


def job_states(outcomes: DataFrame, key: str, failed: Column, succeeded: Column, at: str = "ts", order: str = "event_id") -> DataFrame:
    """Attempts and action per job: completed after a success, dead_letter at the third failure,
    retry below that; ``entered`` when the action is a new one."""
    jobs = keyed.track_jobs(outcomes, key, at, order, failed=failed, succeeded=succeeded)
    return jobs.select(key, "attempts", "done", "action", "entered", "last_failure")


def dead_letters(states: DataFrame) -> DataFrame:
    return states.filter("action = 'dead_letter'")


def outcome_writer(path: str, key: str) -> Callable[[DataFrame, int], None]:
    """Batch writer of three tables out of one batch of job states: the retry queue, the dead letters and the status.

    All three lie in folders of the batch's number, which a repeated batch replaces, so a batch that failed between
    two of them leaves no row twice. A job enters a table when its action changes.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        states = batch.persist()
        try:
            new = states.filter("entered")
            status = F.when(F.col("action") == "completed", "completed").when(F.col("action") == "dead_letter", "failed").otherwise("processing")
            tables = {
                "retries": new.filter("action = 'retry'").select(key, "attempts", "last_failure"),
                "dead_letters": dead_letters(new).select(key, "attempts", "last_failure"),
                "status": new.select(key, status.alias("status"), "attempts"),
            }
            for name, rows in tables.items():
                rows.write.mode("overwrite").parquet(f"{path}/{name}/batch={batch_id}")
        finally:
            states.unpersist()

    return write


def outcome_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.option("basePath", f"{path}/{name}").parquet(f"{path}/{name}/batch=*")


def status_feed(updates: DataFrame, key: str, status: Column, order: str = "event_id", at: str = "ts") -> DataFrame:
    """Newest status per load request."""
    return keyed.track_jobs(updates, key, at, order, status=status).select(key, "status")


def without_redelivery(jobs: DataFrame, key: str, at: str, within: str) -> DataFrame:
    """Drop jobs delivered again while the first one is within the watermark."""
    return jobs.withWatermark(at, within).dropDuplicatesWithinWatermark([key])


def progress(events: DataFrame, key: str, kind: Column, elapsed_ms: Column | None = None, stage: Column | None = None,
             at: str = "ts", order: str = "event_id") -> DataFrame:
    """Step starts and ends, model calls, time spent in steps, the open stage and the last event of a run."""
    jobs = keyed.track_jobs(events, key, at, order, kind=kind, elapsed_ms=elapsed_ms, stage=stage)
    return jobs.select(key, "started", "ended", "calls", "elapsed_ms", "stage", "last_kind")


def step_durations(starts: DataFrame, ends: DataFrame, on: list[str], within: str, delay: str) -> DataFrame:
    """``starts`` (on, start_id, started) with ``ended`` of the ends (on, ended) of the same step up to ``within`` later.

    Both sides are kept as long as a partner may come. A start without an end leaves with a null once the watermark has
    passed it by ``within``: its step is open. A start meets every end in reach; ``first_ends`` takes the first.
    """
    s = starts.withWatermark("started", delay).select(*[F.col(c).alias(f"s_{c}") for c in on], "start_id", "started")
    e = ends.withWatermark("ended", delay).select(*[F.col(c).alias(f"e_{c}") for c in on], "ended")
    met = F.expr(f"ended >= started AND ended <= started + INTERVAL {within}")
    for c in on:
        met = met & (F.col(f"s_{c}") == F.col(f"e_{c}"))
    return s.join(e, met, "left_outer").select(*[F.col(f"s_{c}").alias(c) for c in on], "start_id", "started", "ended")


def first_ends(durations: DataFrame, on: list[str]) -> DataFrame:
    """One row per start: its first end, the time between in microseconds, and whether the step is open."""
    rows = durations.groupBy(*on, "start_id", "started").agg(F.min("ended").alias("ended"))
    return rows.withColumn("micros", F.unix_micros("ended") - F.unix_micros("started")).withColumn("open", F.col("ended").isNull())


def sessions(events: DataFrame, key: str, at: str, gap: str, delay: str, summary: Column) -> DataFrame:
    """Closed sessions of a run; one without a summary event is stalled."""
    s = events.withWatermark(at, delay).groupBy(F.session_window(at, gap), key).agg(
        F.count(F.lit(1)).alias("n_events"), F.count_if(summary).alias("n_summary"))
    return s.select(
        key, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"),
        "n_events", (F.col("n_summary") == 0).alias("stalled"))


def usage(calls: DataFrame, at: str, delay: str, window: str, slide: str, tokens: Column,
          max_calls: int, max_tokens: float) -> DataFrame:
    """Requests and tokens over sliding windows, and whether they pass the budget."""
    u = calls.withWatermark(at, delay).groupBy(F.window(at, window, slide)).agg(
        F.count(F.lit(1)).alias("calls"), F.sum(tokens).alias("tokens"))
    return u.select(
        F.col("window.start").alias("start"), F.col("window.end").alias("end"), "calls", "tokens",
        ((F.col("calls") > max_calls) | (F.col("tokens") > max_tokens)).alias("over_budget"))


def running_max_before(rows: DataFrame, by: str, order: str, value: str, name: str, width: int) -> DataFrame:
    """Add ``name``: the largest ``value`` of earlier rows of the key, in two levels.

    Rows are cut into ranges of ``width`` along ``order``. Range maxima are aggregates, the pass
    over them sees one row per range, and the pass over rows stays within a range, so a hot key
    is spread over its ranges.
    """
    cut = rows.withColumn("rng", F.floor(F.col(order) / width))
    carry = cut.groupBy(by, "rng").agg(F.max(value).alias("top")).withColumn(
        "carry", F.max("top").over(Window.partitionBy(by).orderBy("rng").rowsBetween(Window.unboundedPreceding, -1)))
    inside = Window.partitionBy(by, "rng").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return cut.join(carry.drop("top"), [by, "rng"]).withColumn(
        name, F.greatest(F.max(value).over(inside), "carry")).drop("rng", "carry")


def enrich(jobs: DataFrame, companies: DataFrame, known: DataFrame) -> DataFrame:
    """Jobs with their company and whether it is among the ``known`` (cik); unknown companies are left out."""
    has = known.select("cik", F.lit(True).alias("has_history"))
    return jobs.join(small(companies), "cik").join(has, "cik", "left").withColumn(
        "has_history", F.coalesce("has_history", F.lit(False)))


def enrich_writer(spark: SparkSession, companies: DataFrame, known_path: str, path: str) -> Callable[[DataFrame, int], None]:
    """Batch writer of enriched jobs. Of the table of known companies, which the load keeps, a batch opens the buckets
    of its own companies; no value table is read."""

    def write(batch: DataFrame, batch_id: int) -> None:
        known = sinks.known_keys(spark, batch.select("cik"), known_path, "cik")
        enrich(batch, companies, known).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def load_writer(spark: SparkSession, path: str, rows: Callable[[DataFrame], DataFrame],
                known_path: str | None = None) -> Callable[[DataFrame, int], None]:
    """Batch writer that turns filings into value rows, upserts them, and notes their companies as known."""

    def write(batch: DataFrame, batch_id: int) -> None:
        values = rows(batch)
        sinks.upsert_values(spark, values, path, batch_id)
        if known_path:
            sinks.remember_keys(spark, values.select("cik"), known_path, "cik")

    return write
