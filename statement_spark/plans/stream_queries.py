"""Streaming jobs run over the events table, as change feeds read back in batch."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..session import work_dir
from ..sources import sinks
from ..streaming import keyed, streams as ST
from . import inputs as I
from .catalogue import query


def _events(spark, sf_dir):
    path = f"{sf_dir}/events.parquet"
    stream = ST.read_table_stream(spark, path, spark.read.parquet(path).schema)
    return stream.withColumn("ts", F.col("ts").cast("timestamp")).withColumn(
        "run_id", F.concat_ws("-", "user_id", F.dayofmonth("ts")))


_EV = "ev AS (SELECT *, user_id || '-' || day(ts) AS run_id FROM events)"


@query("stream_retry_dlq", f"""WITH {_EV},
 s AS (SELECT run_id, count(*) FILTER (WHERE event_type = 'error') AS attempts, bool_or(event_type = 'purchase') AS done FROM ev GROUP BY 1)
SELECT run_id, attempts, CASE WHEN done THEN 'completed' WHEN attempts >= 3 THEN 'dead_letter' WHEN attempts > 0 THEN 'retry' ELSE 'queued' END AS action FROM s""")
def stream_retry_dlq(spark, sf_dir):
    states = ST.job_states(_events(spark, sf_dir), "run_id", F.col("event_type") == "error", F.col("event_type") == "purchase")
    return ST.run_to_table(spark, states, "update", ["run_id"]).select("run_id", "attempts", "action")


@query("stream_dead_letters", f"""WITH {_EV}
SELECT run_id FROM ev GROUP BY 1 HAVING count(*) FILTER (WHERE event_type = 'error') >= 3 AND NOT bool_or(event_type = 'purchase')""")
def stream_dead_letters(spark, sf_dir):
    states = ST.job_states(_events(spark, sf_dir), "run_id", F.col("event_type") == "error", F.col("event_type") == "purchase")
    return ST.dead_letters(ST.run_to_table(spark, states, "update", ["run_id"])).select("run_id")


@query("stream_dlq_rows", f"""WITH {_EV}
SELECT run_id, 3 AS attempts, list(event_id ORDER BY event_id)[3] AS last_failure FROM ev WHERE event_type = 'error'
  AND run_id NOT IN (SELECT run_id FROM ev WHERE event_type = 'purchase') GROUP BY 1 HAVING count(*) >= 3""")
def stream_dlq_rows(spark, sf_dir):
    states = ST.job_states(_events(spark, sf_dir), "run_id", F.col("event_type") == "error", F.col("event_type") == "purchase")
    path = work_dir(spark, "outcomes")
    ST.run_available(states, ST.outcome_writer(path, "run_id"), f"{path}/checkpoint", "update")
    return ST.outcome_table(spark, path, "dead_letters").select("run_id", F.least("attempts", F.lit(3)).alias("attempts"), "last_failure")


@query("stream_step_durations", """
WITH e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 AS step FROM events),
 w AS (SELECT least(max(ts) FILTER (WHERE event_type = 'view'), max(ts) FILTER (WHERE event_type = 'click')) - INTERVAL 1 DAY AS w FROM e),
 s AS (SELECT user_id, step, event_id AS start_id, ts FROM e WHERE event_type = 'view'),
 j AS (SELECT s.user_id, s.step, start_id, s.ts AS started, min(c.ts) AS ended FROM s
  LEFT JOIN e c ON c.event_type = 'click' AND c.user_id = s.user_id AND c.step = s.step AND c.ts BETWEEN s.ts AND s.ts + INTERVAL 3 DAY GROUP BY ALL)
SELECT user_id, step, start_id, epoch_us(ended) - epoch_us(started) AS micros, ended IS NULL AS open
FROM j, w WHERE ended IS NOT NULL OR started < w - INTERVAL 3 DAY""")
def stream_step_durations(spark, sf_dir):
    e = _events(spark, sf_dir).withColumn("step", F.get_json_object("props", "$.k").cast("int") % 10)
    starts = e.filter("event_type = 'view'").select("user_id", "step", F.col("event_id").alias("start_id"), F.col("ts").alias("started"))
    ends = e.filter("event_type = 'click'").select("user_id", "step", F.col("ts").alias("ended"))
    met = ST.run_to_table(spark, ST.step_durations(starts, ends, ["user_id", "step"], "3 DAYS", "1 day"))
    return ST.first_ends(met, ["user_id", "step"]).select("user_id", "step", "start_id", "micros", "open")


@query("stream_liveness", """
WITH r AS (SELECT *, coalesce(sum(CASE event_type WHEN 'purchase' THEN 1 ELSE 0 END) OVER (
    PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run FROM events)
SELECT user_id, CASE WHEN bool_or(event_type = 'purchase') THEN 'finished' ELSE 'stalled' END AS state,
  epoch_us(min(ts)) AS start, epoch_us(max(ts)) AS last_beat, count(*) AS events FROM r GROUP BY user_id, run""")
def stream_liveness(spark, sf_dir):
    runs = keyed.liveness(_events(spark, sf_dir), "user_id", "ts", "event_id", F.col("event_type") == "purchase", 1500)
    path = work_dir(spark, "liveness")
    ST.run_until_quiet(runs, ST.to_table(f"{path}/out"), f"{path}/checkpoint", 3000)
    out = spark.read.option("basePath", f"{path}/out").parquet(f"{path}/out/batch=*")
    return out.select("user_id", "state", F.unix_micros("start").alias("start"), F.unix_micros("last_beat").alias("last_beat"), "events")


@query("stream_status_latest", "SELECT user_id, arg_max(event_type, event_id) AS status FROM events GROUP BY 1")
def stream_status_latest(spark, sf_dir):
    feed = ST.status_feed(_events(spark, sf_dir), "user_id", F.col("event_type"))
    return ST.run_to_table(spark, feed, "update", ["user_id"])


@query("stream_intake", """
SELECT event_id, 'T' || user_id AS ticker FROM events WHERE event_type NOT IN ('error', 'view')""")
def stream_intake(spark, sf_dir):
    form = F.when(F.col("event_type") == "view", "10-Q").otherwise("8-K")
    text = F.to_json(F.struct(F.concat(F.lit("T"), F.col("user_id").cast("string")).alias("ticker"), form.alias("filing_type")))
    value = F.when(F.col("event_type") == "error", F.substring(text, 1, 12)).otherwise(text)
    jobs = ST.intake(_events(spark, sf_dir).select("event_id", value.alias("value")))
    return ST.run_to_table(spark, jobs.select("event_id", "ticker"))


@query("stream_redelivery", "SELECT DISTINCT user_id FROM events")
def stream_redelivery(spark, sf_dir):
    once = ST.without_redelivery(_events(spark, sf_dir).select("user_id", "ts"), "user_id", "ts", "60 days")
    return ST.run_to_table(spark, once.select("user_id"))


@query("stream_progress", """
SELECT user_id, count(*) FILTER (WHERE event_type = 'view') AS started, count(*) FILTER (WHERE event_type = 'click') AS ended,
  count(*) FILTER (WHERE event_type = 'signup') AS calls,
  CAST(sum(CAST(round(value * 100) AS BIGINT)) FILTER (WHERE event_type = 'click') AS BIGINT) AS elapsed_ms,
  last(CASE event_type WHEN 'view' THEN 'step_start' WHEN 'click' THEN 'step_end' WHEN 'signup' THEN 'call_llm' WHEN 'purchase' THEN 'summary'
    ELSE 'skip' END ORDER BY ts, event_id) AS last_kind FROM events GROUP BY 1""")
def stream_progress(spark, sf_dir):
    kind = F.element_at(F.create_map(*[F.lit(x) for x in (
        "view", "step_start", "click", "step_end", "signup", "call_llm", "purchase", "summary", "error", "skip")]), F.col("event_type"))
    feed = ST.progress(_events(spark, sf_dir), "user_id", kind, F.round(F.col("value") * 100).cast("bigint"))
    return ST.run_to_table(spark, feed, "update", ["user_id"]).select("user_id", "started", "ended", "calls", "elapsed_ms", "last_kind")


@query("stream_sessions_stalled", """
WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS brk FROM events),
 s AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sid FROM g),
 z AS (SELECT user_id, min(ts) AS a, max(ts) + INTERVAL 6 HOUR AS b, count(*) AS n, count(*) FILTER (WHERE event_type = 'purchase') AS p FROM s GROUP BY user_id, sid)
SELECT user_id, strftime(a, '%Y-%m-%d %H:%M:%S') AS started, n AS n_events, p = 0 AS stalled FROM z
WHERE b <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def stream_sessions_stalled(spark, sf_dir):
    s = ST.sessions(_events(spark, sf_dir), "user_id", "ts", "6 hours", "1 hour", F.col("event_type") == "purchase")
    return ST.run_to_table(spark, s).select(
        "user_id", F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("started"), "n_events", "stalled")


@query("stream_usage_window", """
WITH w AS (SELECT time_bucket(INTERVAL 10 MINUTE, ts) - INTERVAL 10 MINUTE * k AS s, value FROM events, range(6) x(k))
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS start, count(*) AS calls, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS tokens,
  count(*) > 20 OR sum(CAST(round(value * 100) AS BIGINT)) > 100000 AS over_budget FROM w GROUP BY s""")
def stream_usage_window(spark, sf_dir):
    u = ST.usage(_events(spark, sf_dir), "ts", "1 hour", "1 hour", "10 minutes",
                 F.round(F.col("value") * 100).cast("bigint"), 20, 100_000)
    return ST.run_to_table(spark, u, "update", ["start"]).select(
        F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "calls", "tokens", "over_budget")


_END = "DATE '2024-01-01' + CAST(CAST(floor(value * 100) AS BIGINT) % 400 AS INTEGER)"


@query("stream_cadence_late", f"""
SELECT event_id, coalesce(e > max(e) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS advance
FROM (SELECT *, {_END} AS e FROM events)""")
def stream_cadence_late(spark, sf_dir):
    end = F.date_add(F.lit("2024-01-01").cast("date"), (F.floor(F.col("value") * 100) % 400).cast("int"))
    filings = _events(spark, sf_dir).select("event_id", "user_id", end.alias("end_date"))
    return ST.run_to_table(spark, keyed.cadence(filings, "user_id", "event_id", "end_date")).select("event_id", "advance")


@query("stream_enrich", """
SELECT event_id, c_name AS name, user_id IN (SELECT o_custkey FROM orders) AS has_history FROM events JOIN customer ON user_id = c_custkey""")
def stream_enrich(spark, sf_dir):
    companies = I.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("cik"), F.col("c_name").alias("name"))
    history = I.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("cik"))
    jobs = _events(spark, sf_dir).select("event_id", F.col("user_id").alias("cik"))
    path = work_dir(spark, "enrich")
    sinks.remember_keys(spark, history, f"{path}/known", "cik")
    ST.run_available(jobs, ST.enrich_writer(spark, companies, f"{path}/known", f"{path}/out"), f"{path}/checkpoint")
    out = spark.read.option("basePath", f"{path}/out").parquet(f"{path}/out/batch=*")
    return out.select("event_id", "name", "has_history")


@query("stream_upsert", """
SELECT CAST(user_id AS VARCHAR) AS concept_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS end_date, arg_max(value, event_id) AS value
FROM events GROUP BY 1, 2""")
def stream_upsert(spark, sf_dir):
    path = work_dir(spark, "loaded")

    def rows(batch):
        f = batch.select(
            F.col("event_id").alias("filing_id"), F.col("user_id").cast("string").alias("cik"), F.lit("").alias("company_name"),
            F.lit(12).alias("fye_month"), F.lit("1231").alias("fye_code"), F.lit("").alias("period_text"),
            F.col("ts").cast("date").alias("report_date"), F.lit("quarterly").alias("period_override"),
            F.timestamp_seconds("event_id").alias("loaded_at"))
        v = batch.select(F.col("event_id").alias("filing_id"), F.col("user_id").cast("string").alias("concept_id"),
                         "value", F.lit(False).alias("derived"))
        return sinks.value_rows(v, f)

    ST.run_available(_events(spark, sf_dir), ST.load_writer(spark, path, rows), f"{path}-checkpoint")
    return spark.read.parquet(path).select("concept_id", F.col("end_date").cast("string").alias("end_date"), "value")
