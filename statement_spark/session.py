"""Session helpers: local session for tests, shared work folder, size-checked broadcast."""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def local_session(cores: int | str = "*", name: str = "statement-spark") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    n = os.cpu_count() if cores == "*" else int(cores)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the shared folder the cluster names in spark.checkpoint.dir.

    Only in a local session without that setting (tests, a laptop) a temporary folder is used and recorded
    in the session, so that all jobs of the session share it; on a cluster its absence is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="statement-spark-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of a frame."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread(df: DataFrame, bytes_per_task: int = 128 * 1024 * 1024) -> DataFrame:
    """Give every core a share of an input too small to fill them all by its scan splits.

    For work that is dear per byte, such as parsing. An input with a full split per core is
    returned as it is, so large ones are never shuffled for this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if estimated_bytes(df) < cores * bytes_per_task else df


def small(df: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast when the optimizer's size estimate is under the limit.

    Above the limit the frame is returned as it is, and the join shuffles (AQE splits skew).
    """
    return F.broadcast(df) if estimated_bytes(df) <= limit_bytes else df


def matched(df: DataFrame) -> DataFrame:
    """Mark ``df`` to be joined by sorting, where it grows with the filings or companies.

    Its rows repeat much, so a shuffle of a few MB may hold some hundred MB of them: by the written size Spark would
    broadcast them through the driver.
    """
    return df.hint("merge")


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared work folder and read it back.

    Ends the lineage where several later steps use the same rows, and survives lost executors.
    """
    spark = df.sparkSession
    path = work_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
