"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS choose data and cores.
"""
from __future__ import annotations

import json
import os
import re
import time

from statement_spark.plans import catalogue
from statement_spark.session import local_session

HEADLINE = [
    "render_extract", "statement_rows", "classify_tables", "parse_responses", "scale_apply", "merge_sections",
    "stale_year_filter", "tier_map", "derive_chain", "parent_child_rollup", "findings_by_type", "cleanup_drops",
    "asof_prior_filing", "period_end_inference", "prior_values", "recent_concepts", "concept_labels",
    "chunk_documents", "grounding", "upsert_values", "stream_retry_dlq", "stream_usage_window",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    catalogue.load()
    spark = local_session(cpus, "statement-spark-bench")
    spark.sparkContext.setLogLevel("ERROR")
    catalogue.QUERIES["fiscal_period"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        catalogue.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    sf = re.search(r"sf([\d.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(sf.group(1)) if sf else None, "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
