"""State kept per key by ``transformWithState``: jobs, cadence, liveness.

Each processor folds the rows of a key into one small value, so a hot key costs time and no memory. Jobs, of which there
are many, are tracked by ``JobTracker.java`` in the JVM; the others are Python. State
lives in the RocksDB store, on the executors' disk and in the checkpoint, and leaves it: jobs a while after their last
event in event time, silent runs after a time to live. Rows older than the watermark are late and left out.
"""
from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from importlib import resources

from py4j.java_gateway import JavaObject
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from ..functions import patterns as P

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
DAY_MS = 24 * 60 * 60 * 1000

JOB_STATE = ("attempts int, done boolean, started bigint, ended bigint, calls bigint, elapsed_ms bigint, "
             "last_at bigint, last_order bigint, last_kind string, status string, stage_at bigint, stage_order bigint, stage string, failures array<bigint>")
JOB_ROW = ("attempts int, done boolean, started bigint, ended bigint, calls bigint, elapsed_ms bigint, last_kind string, "
           "status string, stage string, last_failure bigint, old_attempts int, old_done boolean")


def with_rocksdb(spark: SparkSession) -> None:
    """Processors with several states, timers or expiry need this store; a batch writes its changes, not whole files."""
    if spark.conf.get(PROVIDER, "") != ROCKSDB:
        spark.conf.set(PROVIDER, ROCKSDB)
        spark.conf.set(CHANGELOG, "true")


_LOADERS: dict[str, JavaObject] = {}


def jvm_class(spark: SparkSession, name: str) -> JavaObject:
    """The class of ``name``.java beside this file, compiled by the Janino that Spark brings; the executors get it as a jar, once an application."""
    application = f"{spark.sparkContext.applicationId}/{name}"
    if application not in _LOADERS:
        above, compiler = spark._jsparkSession.getClass().getClassLoader(), spark._jvm.org.codehaus.janino.SimpleCompiler()
        compiler.setParentClassLoader(above)
        compiler.cook(resources.files(__package__).joinpath(f"{name}.java").read_text(encoding="utf-8"))
        jar = f"{tempfile.mkdtemp(prefix='statement-spark-')}/{name}.jar"
        with zipfile.ZipFile(jar, "w") as out:
            for made, code in dict(compiler.getBytecodes()).items():
                out.writestr(f"{made.replace('.', '/')}.class", bytes(code))
        spark.sparkContext._jsc.addJar(jar)
        urls = spark._sc._gateway.new_array(spark._jvm.java.net.URL, 1)
        urls[0] = spark._jvm.java.io.File(jar).toURI().toURL()
        _LOADERS[application] = spark._jvm.java.net.URLClassLoader(urls, above)
    return _LOADERS[application].loadClass(f"statement_spark.{name}")


def job_tracker(spark: SparkSession, keep_ms: int, most: int) -> JavaObject:
    """The processor of ``JobTracker.java``, which runs in the JVM beside its state: no Python round trip per job."""
    made = spark._sc._gateway.new_array(spark._jvm.java.lang.Object, 3)
    made[0], made[1], made[2] = spark._jvm.java.lang.Long(str(keep_ms)), most, JOB_STATE
    return jvm_class(spark, "JobTracker").getConstructors()[0].newInstance(made)


def track_jobs(events: DataFrame, key: str, at: str = "ts", order: str = "event_id", failed: Column | None = None,
               succeeded: Column | None = None, kind: Column | None = None, status: Column | None = None, stage: Column | None = None,
               elapsed_ms: Column | None = None, keep_days: int = 40, delay: str = "1 day") -> DataFrame:
    """Change feed (key and the columns of ``JOB_ROW``): the state of each job that a batch has events of."""
    spark = events.sparkSession
    with_rocksdb(spark)
    no, none = F.lit(False), F.lit(None)
    rows = events.withWatermark(at, delay).select(
        F.unix_micros(at).alias("at"), F.col(order).cast("bigint").alias("order"),
        F.coalesce(failed if failed is not None else no, no).alias("failed"),
        F.coalesce(succeeded if succeeded is not None else no, no).alias("succeeded"),
        (kind if kind is not None else none).cast("string").alias("kind"), (status if status is not None else none).cast("string").alias("status"),
        (stage if stage is not None else none).cast("string").alias("stage"),
        (elapsed_ms if elapsed_ms is not None else none).cast("bigint").alias("elapsed"),
        F.col(key).alias("key"), F.col(at).alias("event_time"))
    jvm, keyed_by = spark._jvm.org.apache.spark.sql, f"key {rows.schema['key'].dataType.simpleString()}"
    row = lambda ddl: jvm.Encoders.row(jvm.types.StructType.fromDDL(ddl))
    grouped = getattr(rows.groupBy("key")._jgd, "as")(row(keyed_by), rows._jdf.encoder())
    kept = DataFrame(grouped.transformWithState(
        job_tracker(spark, keep_days * DAY_MS, P.MAX_JOB_ATTEMPTS), jvm.streaming.TimeMode.EventTime(), jvm.streaming.OutputMode.Update(),
        row(f"{keyed_by}, {JOB_ROW}")), spark)
    was, now = action(F.col("old_attempts"), F.col("old_done")), action(F.col("attempts"), F.col("done"))
    return kept.withColumnRenamed("key", key).withColumn("action", now).withColumn("entered", was != now).drop("old_attempts", "old_done")


def action(attempts: Column, done: Column) -> Column:
    """What is to be done with a job: nothing after a success, no more after the last attempt, else the next attempt."""
    return F.when(done, "completed").when(attempts >= P.MAX_JOB_ATTEMPTS, "dead_letter").when(attempts > 0, "retry").otherwise("queued")


class Cadence(StatefulProcessor):
    """Whether a filing, in order of arrival, is newer than all before it; the state is the highest date of the company.

    The rows of a company in one batch are put in order here: a number and a date each.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.top = handle.getValueState("top", "top date")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        old = self.top.get()
        top = old[0] if old else None
        for order, end in sorted(((r.order, r.end) for r in rows), key=lambda x: x[0]):
            advance = end is not None and (top is None or end > top)
            top = end if advance else top
            yield Row(key=key[0], order=order, end=end, advance=advance)
        if top is not None:
            self.top.update((top,))

    def close(self) -> None:
        pass


def cadence(filings: DataFrame, key: str, order: str, end: str) -> DataFrame:
    """Filings (key, order, end) with ``advance``; a filing without a date does not advance. A company is one value for good."""
    with_rocksdb(filings.sparkSession)
    rows = filings.select(F.col(key).alias("key"), F.col(order).cast("bigint").alias("order"), F.col(end).cast("date").alias("end"))
    out = rows.groupBy("key").transformWithState(
        Cadence(), f"key {rows.schema['key'].dataType.simpleString()}, order bigint, end date, advance boolean", "Append", "None")
    return out.select(F.col("key").alias(key), F.col("order").alias(order), F.col("end").alias(end), "advance")


RUN_STATE = "start bigint, last_beat bigint, events bigint, timer bigint, told boolean"


class Liveness(StatefulProcessor):
    """Runs that ended with a summary, and runs that fell silent.

    Every batch with beats of a run sets its timer anew, ``silent_ms`` of the clock ahead; when it fires, the run is stalled.
    No event of any other run is needed for that. A stalled run that beats again goes on. Silent runs leave the state after
    the time to live.
    """

    def __init__(self, silent_ms: int, keep_ms: int):
        self.silent_ms, self.keep_ms = silent_ms, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", RUN_STATE, self.keep_ms)

    def _row(self, key, state: str, start, last, events) -> Row:
        return Row(key=key, state=state, start=start, last_beat=last, events=events)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        start, last, events, timer, told = self.run.get() or (None, None, 0, None, False)
        if timer is not None and not told:
            self.handle.deleteTimer(timer)
        for at, _, summary in sorted((r.at, r.order, r.summary) for r in rows if r.at is not None):
            start, last, events = start or at, at, events + 1
            if summary:
                yield self._row(key[0], "finished", start, last, events)
                start, last, events = None, None, 0
        if start is None:
            self.run.clear()
        else:
            timer = timerValues.getCurrentProcessingTimeInMs() + self.silent_ms
            self.handle.registerTimer(timer)
            self.run.update((start, last, events, timer, False))

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        run = self.run.get()
        if run is not None and not run[4]:
            start, last, events, timer, _ = run
            self.run.update((start, last, events, timer, True))
            yield self._row(key[0], "stalled", start, last, events)

    def close(self) -> None:
        pass


def liveness(beats: DataFrame, key: str, at: str, order: str, summary: Column, silent_ms: int, keep_ms: int = 7 * DAY_MS) -> DataFrame:
    """(key, state, start, last_beat, events) of runs as they finish or stall, by the clock."""
    with_rocksdb(beats.sparkSession)
    rows = beats.select(
        F.col(key).alias("key"), F.unix_micros(at).alias("at"), F.col(order).cast("bigint").alias("order"),
        F.coalesce(summary, F.lit(False)).alias("summary"))
    out = rows.groupBy("key").transformWithState(
        Liveness(silent_ms, keep_ms), f"key {rows.schema['key'].dataType.simpleString()}, state string, start bigint, last_beat bigint, events bigint",
        "Append", "ProcessingTime")
    return out.select(F.col("key").alias(key), "state", F.timestamp_micros("start").alias("start"), F.timestamp_micros("last_beat").alias("last_beat"), "events")
