"""Model responses as a table: JSON text to typed rows. No model is called from here.

``prompts`` leave as a table and ``responses`` come in as one. ``call_model`` is the only place
where a caller may plug in a function, and it runs inside tasks.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import numbers, patterns as P, text as T

NUMERIC_KINDS = r"^(BIGINT|DOUBLE|FLOAT|DECIMAL)"


def isolate_json(text: Column) -> Column:
    """From the first brace to the last: code fences and chatter fall away."""
    return F.regexp_extract(text, r"(?s)(\{.*\})", 1)


def _object(text: Column) -> Column:
    return F.from_json(isolate_json(text), "map<string,variant>")


def _entries(m: Column) -> Column:
    """Entries in source order; of a repeated key the last one stays, as JSON readers do."""
    e = F.map_entries(m)
    unique = F.filter(
        e,
        lambda x, i: ~F.exists(F.slice(e, i + 2, F.size(e)), lambda y: y["key"] == x["key"]),
    )
    return F.when(F.size(F.array_distinct(F.map_keys(m))) < F.size(e), unique).otherwise(e)


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def _string(v: Column) -> Column:
    return F.when(_kind(v) == "STRING", F.try_variant_get(v, "$", "string"))


def _number(v: Column) -> Column:
    x = F.try_variant_get(v, "$", "double")
    return F.when(_kind(v).rlike(NUMERIC_KINDS) & ~F.isnan(x), x)


def parse_responses(responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects). Rows keep source order in ``key_ord`` and carry the chunk's own
    ``scale`` and ``period``; a response that is no JSON object is a reject.

    Entries are typed and filtered inside the array, so each is looked at once.
    """
    keys = [c for c in responses.columns if c != "text"]
    opened = responses.withColumn("m", _object(F.col("text")))
    rejects = opened.filter("m is null").drop("m")
    scale = F.lower(_string(F.try_element_at("m", F.lit("__scale__"))))
    typed = F.transform(_entries(F.col("m")), lambda e, i: F.struct(
        e["key"].alias("key"),
        (F.shiftleft(F.col("chunk_idx").cast("bigint"), 32) + i).alias("key_ord"),
        _number(e["value"]).alias("num_value"), _string(e["value"]).alias("str_value")))
    valued = F.filter(typed, lambda x: x["num_value"].isNotNull() | x["str_value"].isNotNull())
    rows = opened.select(
        *keys, scale.alias("scale"),
        _string(F.try_element_at("m", F.lit("__period__"))).alias("period"), F.inline(valued))
    return rows, rejects


def metric_rows(rows: DataFrame) -> DataFrame:
    """Without the sentinel keys, except the period label, which merges like a string."""
    return rows.filter(~F.col("key").startswith("__") | (F.col("key") == "__period__"))


def snippets(responses: DataFrame) -> DataFrame:
    """Rows of the nested ``__sources__`` objects: label and cited text."""
    keys = [c for c in responses.columns if c != "text"]
    nested = F.try_element_at(_object(F.col("text")), F.lit("__sources__"))
    m = F.try_variant_get(nested, "$", "map<string,string>")
    return responses.select(*keys, F.posexplode(m).alias("pos", "key", "snippet")).filter(
        F.trim("snippet") != ""
    )


def apply_scale(rows: DataFrame, prescan: Column, shares: Column) -> DataFrame:
    """Scale the numbers of parsed rows. ``prescan`` and ``shares`` are multipliers."""
    dollars = numbers.dollar_multiplier(T.scale_factor(F.coalesce("scale", F.lit(""))), prescan)
    return rows.withColumn(
        "num_value", numbers.scaled(F.col("key"), F.col("num_value"), dollars, shares)
    )


def string_map(text: Column) -> Column:
    """Flat object of strings: mapping and role answers."""
    return F.from_json(isolate_json(text), "map<string,string>")


def keep_flags(responses: DataFrame, candidates: DataFrame, filing: str) -> DataFrame:
    """Keep flag of each undecided table; what the answer does not name is kept."""
    flags = responses.select(
        filing, F.from_json(isolate_json(F.col("text")), "map<string,boolean>").alias("m")
    )
    return candidates.join(flags, filing, "left").select(
        *candidates.columns,
        F.coalesce(F.try_element_at("m", F.col("cand_idx").cast("string")), F.lit(True)).alias("keep"),
    )


def cleanup_answers(responses: DataFrame, filing: str) -> DataFrame:
    """(filing, key, reason) of every removal an answer asks for."""
    parsed = responses.select(
        filing,
        F.from_json(
            isolate_json(F.col("text")), "remove array<string>, reasons map<string,string>"
        ).alias("j"),
    )
    return parsed.select(filing, F.explode(F.array_distinct("j.remove")).alias("key"),
                         F.col("j.reasons").alias("reasons")).select(
        filing, "key", F.try_element_at("reasons", F.col("key")).alias("reason")
    )


def prompt_key(model_tag: Column, prompt: Column) -> Column:
    return F.sha2(F.concat_ws("\n", model_tag, prompt), 256)


def unanswered(prompts: DataFrame, responses: DataFrame) -> DataFrame:
    """Prompts that no stored response answers yet."""
    return prompts.join(responses.select("prompt_sha"), "prompt_sha", "left_anti")


ANSWER_ROW = "prompt_sha string, text string, status string, tries int, error string"
STRICTER = "\n\nReturn ONLY a valid JSON object. No markdown, no commentary."
ERROR_CHARS = 500


def json_object(text: str | None) -> dict | None:
    """The object between the first and the last brace, or none: the parser a caller may replace."""
    import json

    try:
        start, end = (text or "").index("{"), (text or "").rindex("}")
        found = json.loads(text[start:end + 1])
    except ValueError:
        return None
    return found if isinstance(found, dict) else None


def call_model(prompts: DataFrame, call: Callable[[str], str] | None = None, open_session: Callable[[], Callable[[str], str]] | None = None,
               tries: int = 2, parse: Callable[[str], object] = json_object, wait: float = 0.0) -> DataFrame:
    """(prompt_sha, text, status, tries, error) of prompts answered inside tasks by an injected function.

    ``open_session`` makes the function once per task, where a client or a connection belongs to it. An answer that
    ``parse`` makes nothing of is asked for again with a stricter ending; a call that raises is repeated after ``wait``
    seconds, longer each time. After ``tries`` calls the prompt is ``failed``: a row with the last error, never a failed
    task. ``ok`` is an answer at once, ``retried`` a later one.
    """
    import time

    if (call is None) == (open_session is None):
        raise ValueError("either a function or what opens a session")

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        session, refused = call, None
        if open_session is not None:
            try:
                session = open_session()
            except Exception as e:  # without a session no prompt of the task has an answer
                refused = e

        def one(prompt: str) -> tuple[str | None, str, int, str | None]:
            text, error, stricter = None, None, False
            for n in range(1, tries + 1):
                try:
                    if refused is not None:
                        raise refused
                    text = session(prompt + STRICTER if stricter else prompt)
                    if parse(text) is not None:
                        return text, "ok" if n == 1 else "retried", n, None
                    error, stricter = "no JSON object", True
                except Exception as e:
                    error = f"{type(e).__name__}: {e}"[:ERROR_CHARS]
                    if wait and n < tries:
                        time.sleep(wait * 2 ** (n - 1))
            return text, "failed", tries, error

        for b in batches:
            rows = [(sha, *one(prompt)) for sha, prompt in zip(b["prompt_sha"], b["prompt"])]
            yield pd.DataFrame(rows, columns=["prompt_sha", "text", "status", "tries", "error"]).astype({"tries": "int32"})

    return prompts.select("prompt_sha", "prompt").mapInPandas(answer, ANSWER_ROW)


def stored_answers(spark: SparkSession, path: str) -> DataFrame:
    """The newest answer to each prompt at ``path``; none before the first run."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], f"{ANSWER_ROW}, run int")
    rows = spark.read.schema(f"{ANSWER_ROW}, run int").parquet(path)
    rest = [c for c in rows.columns if c != "prompt_sha"]
    return rows.groupBy("prompt_sha").agg(F.max_by(F.struct(*rest), "run").alias("r")).select("prompt_sha", "r.*")


def answer_prompts(prompts: DataFrame, path: str, run: int, tries: int = 2, **how) -> DataFrame:
    """Answers to ``prompts`` (prompt_sha, prompt), stored at ``path`` by prompt key; only those are sent that no earlier run
    answered, each once. A run that is repeated under its number replaces what it stored."""
    spark = prompts.sparkSession
    before = stored_answers(spark, path).filter((F.col("run") < run) & (F.col("status") != "failed"))
    todo = unanswered(prompts.select("prompt_sha", "prompt").dropDuplicates(["prompt_sha"]), before)
    call_model(todo, tries=tries, **how).write.mode("overwrite").parquet(f"{path.rstrip('/')}/run={run}")
    return stored_answers(spark, path).join(prompts.select("prompt_sha").distinct(), "prompt_sha", "left_semi")


def parse_message(text: Column) -> Column:
    """Queue message to a struct; null when it is no JSON."""
    return F.from_json(
        text,
        "ticker string, cik string, accession_number string, company_name string, "
        "period_of_report string, filing_type string, form_type string, "
        "load_request_id string, attempts int, failed_at double, last_error string",
    )


def valid_message(m: Column) -> Column:
    """Only 8-K jobs with a ticker are worked on."""
    form = F.upper(F.coalesce(F.nullif(m["filing_type"], F.lit("")), m["form_type"], F.lit("")))
    return m["ticker"].isNotNull() & (form == "8-K")
