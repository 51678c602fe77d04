"""Spark session settings for local runs and for a large cluster."""

from __future__ import annotations

import math

from pyspark.sql import SparkSession

# Settings that hold at any size: the plan is corrected at run time, hot join
# partitions are split, and small ones are merged.
COMMON_SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Several driver round trips per column expression, only to name a line in errors.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: str = "8", app_name: str = "crmflow", **extra: str) -> SparkSession:
    """A single-machine session, as used by the tests and ``bench.py``."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in {**COMMON_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def cluster_settings(input_bytes: int, total_cores: int) -> dict[str, str]:
    """Session settings for an input of ``input_bytes`` on ``total_cores`` cores.

    Shuffle partitions start at about 128 MB of input each (and no fewer than two
    per core); adaptive execution merges the ones that turn out small, so a high
    start costs little while a low one spills.
    """
    target = 128 * 1024 * 1024
    partitions = max(2 * total_cores, math.ceil(input_bytes / target))
    return {
        **COMMON_SETTINGS,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.files.maxPartitionBytes": str(2 * target),
        "spark.sql.parquet.aggregatePushdown": "true",
    }
