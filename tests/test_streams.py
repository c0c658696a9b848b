"""Streams over several batches equal one batch."""
from datetime import datetime, timedelta
from random import Random

from pyspark.sql import functions as F

from statement_spark.session import work_dir
from statement_spark.sources import sinks
from statement_spark.streaming import keyed, streams as ST


def events(spark, rows, parts):
    """Rows written as one file per part, streamed one file per batch."""
    path = work_dir(spark, "events")
    schema = "event_id bigint, run string, kind string, v int, ts timestamp"
    for i in range(parts):
        spark.createDataFrame(rows[i::parts] if parts == 1 else rows[i * len(rows) // parts:(i + 1) * len(rows) // parts], schema).coalesce(
            1).write.mode("append").parquet(path)
    return ST.read_table_stream(spark, path, spark.read.parquet(path).schema, 1)


def sample(spark, n=60):
    t0 = datetime(2024, 1, 1)
    kinds = ["fail", "start", "ok"]
    return [(i, f"r{(i * i) % 7}", kinds[(i * 5) % 3 if i % 4 else 0], (i * 37) % 50, t0 + timedelta(minutes=7 * i)) for i in range(n)]


def test_job_states_over_batches(spark):
    rows = sample(spark)
    stream = events(spark, rows, 4)
    got = {r.run: (r.attempts, r.action) for r in ST.run_to_table(
        spark, ST.job_states(stream, "run", F.col("kind") == "fail", F.col("kind") == "ok"), "update", ["run"]).collect()}
    for run in {r[1] for r in rows}:
        mine = [r[2] for r in rows if r[1] == run]
        fails = mine.count("fail")
        want = "completed" if "ok" in mine else "dead_letter" if fails >= 3 else "retry" if fails else "queued"
        assert got[run] == (fails, want)


def test_cadence_over_batches(spark):
    rows = sample(spark)
    filings = events(spark, rows, 4).select("event_id", "run", F.date_add(F.lit("2024-01-01").cast("date"), F.col("v")).alias("end"))
    got = {r.event_id: r.advance for r in ST.run_to_table(spark, keyed.cadence(filings, "run", "event_id", "end")).collect()}
    for i, run, _, v, _ in rows:
        before = [r[3] for r in rows if r[1] == run and r[0] < i]
        assert got[i] == (not before or v > max(before))


def test_redelivery_is_dropped(spark):
    stream = events(spark, sample(spark), 3)
    once = ST.without_redelivery(stream.select("run", "ts"), "run", "ts", "10 days")
    got = [r.run for r in ST.run_to_table(spark, once.select("run")).collect()]
    assert sorted(got) == sorted({r[1] for r in sample(spark)})


T0 = datetime(2024, 1, 1)


def test_progress_and_status_over_batches(spark):
    rows = [(i, f"r{i % 3}", ["step_start", "call_llm", "step_end", "summary"][(i * 7) % 4], i, T0 + timedelta(minutes=i)) for i in range(40)]
    stream = events(spark, rows, 5)
    feed = ST.progress(stream, "run", F.col("kind"), F.col("v"), F.concat(F.lit("stage "), F.col("v")))
    got = {r.run: r for r in ST.run_to_table(spark, feed, "update", ["run"]).collect()}
    for run in ("r0", "r1", "r2"):
        mine = [r for r in rows if r[1] == run]
        kinds, stage = [r[2] for r in mine], None
        for _, _, kind, v, _ in mine:
            stage = f"stage {v}" if kind == "step_start" else None if kind in ("step_end", "summary") else stage
        r = got[run]
        assert (r.started, r.ended, r.calls, r.last_kind) == (kinds.count("step_start"), kinds.count("step_end"), kinds.count("call_llm"), kinds[-1])
        assert r.elapsed_ms == sum(m[3] for m in mine if m[2] == "step_end") and r.stage == stage
    status = ST.run_to_table(spark, ST.status_feed(events(spark, rows, 5), "run", F.col("kind")), "update", ["run"])
    assert {r.run: r.status for r in status.collect()} == {run: [r[2] for r in rows if r[1] == run][-1] for run in got}


def test_jobs_leave_the_state_after_their_time(spark):
    """A job silent for longer than its time starts anew; one that goes on keeps its attempts; the store holds no old one."""
    days = lambda n: T0 + timedelta(days=n)
    rows = [(0, "old", "fail", 0, days(0)), (1, "on", "fail", 0, days(0)), (2, "on", "fail", 0, days(8)), (3, "x", "fail", 0, days(14)),
            (4, "on", "fail", 0, days(16)), (5, "x", "fail", 0, days(30)), (6, "old", "fail", 0, days(31)), (7, "y", "fail", 0, days(60))]
    path, stream = work_dir(spark, "expiry"), events(spark, rows, 8)
    jobs = keyed.track_jobs(stream, "run", failed=F.col("kind") == "fail", keep_days=10)
    ST.run_available(jobs, ST.to_table(f"{path}/out"), f"{path}/checkpoint", "update")
    got = [(r.run, r.attempts) for r in spark.read.option("basePath", f"{path}/out").parquet(f"{path}/out/batch=*").orderBy("batch", "run").collect()]
    assert got == [("old", 1), ("on", 1), ("on", 2), ("x", 1), ("on", 3), ("x", 1), ("old", 1), ("y", 1)]
    left = spark.read.format("statestore").option("stateVarName", "job").load(f"{path}/checkpoint")
    assert {r["key"][0] for r in left.select("key").collect()} == {"y"}


def test_a_repeated_batch_leaves_the_same_tables(spark):
    rows = [(i, f"r{i % 2}", ["fail", "fail", "fail", "ok"][(i // 2) % 4 if i % 2 else 0], 0, T0 + timedelta(hours=i)) for i in range(12)]
    path = work_dir(spark, "outcomes")
    write, batches = ST.outcome_writer(path, "run"), []

    def twice(batch, batch_id):
        write(batch, batch_id)
        batches.append(batch_id)
        write(batch, batch_id)

    states = ST.job_states(events(spark, rows, 3), "run", F.col("kind") == "fail", F.col("kind") == "ok")
    ST.run_available(states, twice, f"{path}/checkpoint", "update")
    assert len(batches) >= 3
    dead = ST.outcome_table(spark, path, "dead_letters").collect()
    assert [(r.run, r.last_failure) for r in dead] == [("r0", 4)]
    status = sorted((r.batch, r.run, r.status) for r in ST.outcome_table(spark, path, "status").collect())
    assert status == [(0, "r0", "processing"), (0, "r1", "processing"), (1, "r0", "failed"), (1, "r1", "completed")]
    assert sorted((r.batch, r.run) for r in ST.outcome_table(spark, path, "retries").collect()) == [(0, "r0"), (0, "r1")]


def test_silent_runs_are_told_without_a_later_event(spark):
    beat = lambda i, run, kind, m: (i, run, kind, 0, T0 + timedelta(minutes=m))
    rows = [beat(0, "done", "start", 0), beat(1, "done", "summary", 1), beat(2, "silent", "start", 2), beat(3, "silent", "beat", 3),
            beat(4, "again", "summary", 4), beat(5, "again", "start", 5)]
    path = work_dir(spark, "liveness")
    runs = keyed.liveness(events(spark, rows, 1), "run", "ts", "event_id", F.col("kind") == "summary", 1000)
    ST.run_until_quiet(runs, ST.to_table(f"{path}/out"), f"{path}/checkpoint", 2500)
    got = {(r.run, r.state, r.start, r.last_beat, r.events) for r in spark.read.parquet(f"{path}/out/batch=*").collect()}
    at = lambda m: T0 + timedelta(minutes=m)
    assert got == {("done", "finished", at(0), at(1), 2), ("silent", "stalled", at(2), at(3), 2),
                   ("again", "finished", at(4), at(4), 1), ("again", "stalled", at(5), at(5), 1)}


def test_steps_without_an_end_are_open(spark):
    beat = lambda i, run, kind, step, m: (i, run, kind, step, T0 + timedelta(minutes=m))
    rows = [beat(0, "a", "start", 1, 0), beat(1, "a", "end", 1, 5), beat(2, "a", "end", 1, 7), beat(3, "b", "start", 1, 8), beat(4, "a", "start", 2, 9),
            beat(5, "a", "end", 2, 30), beat(6, "b", "end", 1, 80), beat(7, "z", "start", 9, 300), beat(8, "z", "end", 9, 301)]
    def side(kind, *columns):
        return events(spark, rows, 3).filter(F.col("kind") == kind).select("run", F.col("v").alias("step"), *columns)
    met = ST.step_durations(side("start", F.col("event_id").alias("start_id"), F.col("ts").alias("started")), side("end", F.col("ts").alias("ended")),
                            ["run", "step"], "30 MINUTES", "10 minutes")
    got = {(r.run, r.step, r.start_id, r.micros, r.open) for r in ST.first_ends(ST.run_to_table(spark, met), ["run", "step"]).collect()}
    minute = 60_000_000
    assert got == {("a", 1, 0, 5 * minute, False), ("b", 1, 3, None, True), ("a", 2, 4, 21 * minute, False), ("z", 9, 7, minute, False)}


def test_a_first_load_flips_the_flag_in_the_next_batch(spark):
    rows = [(i, str(i % 2), "job", 0, T0 + timedelta(minutes=i)) for i in range(6)]
    companies = spark.createDataFrame([("0", "zero"), ("1", "one")], "cik string, name string")
    path = work_dir(spark, "enrich")
    write = ST.enrich_writer(spark, companies, f"{path}/known", f"{path}/out")

    def then_load(batch, batch_id):
        write(batch, batch_id)
        if batch_id == 0:  # the load job saves the first values of company 1
            sinks.remember_keys(spark, spark.createDataFrame([("1",), ("1",), (None,)], "cik string"), f"{path}/known", "cik")

    ST.run_available(events(spark, rows, 3).select("event_id", F.col("run").alias("cik")), then_load, f"{path}/checkpoint")
    out = spark.read.parquet(f"{path}/out/batch=*").collect()
    assert sorted((r.event_id, r.name, r.has_history) for r in out) == [
        (0, "zero", False), (1, "one", False), (2, "zero", False), (3, "one", True), (4, "zero", False), (5, "one", True)]
    seen = spark.createDataFrame([("1",)], "cik string")
    assert f"{path}/known" in sinks.known_keys(spark, seen, f"{path}/known", "cik").inputFiles()[0]


def test_jobs_are_tracked_without_python(spark):
    """A Python round trip per job took 100 seconds for 240 thousand jobs."""
    states = ST.job_states(events(spark, sample(spark, 8), 1), "run", F.col("kind") == "fail", F.col("kind") == "ok")
    plan = states._jdf.queryExecution().analyzed().toString()
    assert "TransformWithState" in plan and "InPySpark" not in plan and "InPandas" not in plan


def test_tracked_jobs_equal_a_plain_fold(spark):
    """Rows in any order within a batch, without a time, a kind or a number; a job is known by a number or by none."""
    rnd = Random(5)
    kinds = ["fail", "ok", "step_start", "step_end", "call_llm", "summary", None]
    rows = [(None if rnd.random() < 0.1 else i * 7 % 90, rnd.choice([None, 1, 2, 3, 4]), rnd.choice(kinds), rnd.choice([None, 3, 5]),
             None if rnd.random() < 0.1 else T0 + timedelta(minutes=rnd.randrange(30))) for i in range(90)]
    path = work_dir(spark, "events")
    for part in range(3):
        spark.createDataFrame(rows[part * 30:part * 30 + 30], "event_id bigint, run int, kind string, v int, ts timestamp").coalesce(1).write.mode(
            "append").parquet(path)
    stream = ST.read_table_stream(spark, path, spark.read.parquet(path).schema, 1)
    jobs = keyed.track_jobs(stream, "run", failed=F.col("kind") == "fail", succeeded=F.col("kind") == "ok", kind=F.col("kind"), status=F.col("v"),
                            stage=F.concat(F.lit("s"), F.col("v")), elapsed_ms=F.col("v"))
    assert jobs.schema["run"].dataType.simpleString() == "int"
    out = work_dir(spark, "jobs")
    ST.run_available(jobs, ST.to_table(f"{out}/out"), f"{out}/checkpoint", "update")
    got = {(r.batch, r.run): r for r in spark.read.option("basePath", f"{out}/out").parquet(f"{out}/out/batch=*").collect()}
    number = lambda r: (r[4], -1 if r[0] is None else r[0])
    for run in (None, 1, 2, 3, 4):
        was = "queued"
        for batch in range(3):
            mine = [r for r in rows[:batch * 30 + 30] if r[1] == run]
            if not any(r[1] == run for r in rows[batch * 30:batch * 30 + 30]):
                continue
            count = lambda kind: sum(r[2] == kind for r in mine)
            failures = sorted(r[0] for r in mine if r[2] == "fail" and r[0] is not None)[:3]
            last = max((r for r in mine if r[4] is not None), key=number)
            stages = [r for r in mine if r[4] is not None and r[2] in ("step_start", "step_end", "summary")]
            opened = max(stages, key=number) if stages else None
            took = [r[3] for r in mine if r[2] == "step_end" and r[3] is not None]
            r, action = got[batch, run], "completed" if count("ok") else "dead_letter" if count("fail") >= 3 else "retry" if count("fail") else "queued"
            assert (r.attempts, r.done, r.started, r.ended, r.calls) == (
                count("fail"), count("ok") > 0, count("step_start"), count("step_end"), count("call_llm"))
            assert r.elapsed_ms == (sum(took) if took else None) and r.last_failure == (failures[-1] if failures else None)
            assert (r.last_kind, r.status) == (last[2], None if last[3] is None else str(last[3]))
            assert r.stage == (f"s{opened[3]}" if opened and opened[2] == "step_start" and opened[3] is not None else None)
            assert (r.action, r.entered) == (action, action != was)
            was = action
