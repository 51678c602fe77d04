"""Queries of this subpackage, the SQL to compare them with, and reading of the given tables."""

from __future__ import annotations

import re
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: The setting that bounds an Arrow batch, and the bytes that operators here are made for.
BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name``, with equivalent SQL if there is any."""

    def register(function):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def _bytes_of(setting: str) -> int:
    """The bytes that a size setting such as 64m or 4194304b means."""
    number, unit = re.fullmatch(r"(\d+)\s*([kmgtp]?)b?", setting.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def prepare_session(spark: SparkSession) -> None:
    """Let Python workers import this package, and bound the Arrow batches they are sent by bytes.

    The package is found where the driver has it; workers on other machines need it installed
    or shipped (``--py-files``) in any case. Batches bounded by rows alone hold ten thousand
    texts of any length; a smaller bound of the session's own stays.
    """
    if _bytes_of(spark.conf.get(BATCH_LIMIT)) > BATCH_BYTES:
        spark.conf.set(BATCH_LIMIT, f"{BATCH_BYTES}b")
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(":")
    if root not in known:
        environment["PYTHONPATH"] = ":".join([root, *filter(None, known)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare_session(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
