"""Registry of named queries with their SQL twins."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def load() -> None:
    """Import the modules that register queries."""
    from . import (  # noqa: F401
        concept_queries, filing_queries, history_queries, merge_queries, page_queries, quality_queries,
        report_queries, stream_queries,
    )
