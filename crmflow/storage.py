"""The shared folder: written tables that cut lineage and survive executor loss."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession


#: Paths of the tables that the innermost ``temporary_tables`` block removes.
_temporary: ContextVar[list[str] | None] = ContextVar("temporary", default=None)


@cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="crmflow-")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A session that names none gets a temporary folder in local mode only; on a
    cluster that would not be shared, so it is an error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_dir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/crmflow/{label}-{uuid.uuid4().hex}"


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Tables that ``materialize`` writes inside are removed at the end, but for those that stay.

    Frames that leave the block must read none of the removed ones.
    """
    paths: list[str] = []
    token = _temporary.set(paths)
    try:
        yield
    finally:
        _temporary.reset(token)
        for path in paths:
            remove_folder(spark, path)


def materialize(df: DataFrame, label: str = "table", stays: bool = False) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Several dependants then scan columns of a stored table instead of each
    recomputing the plan, and a lost executor costs only its own tasks.
    A table that ``stays`` outlives a ``temporary_tables`` block.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    paths = _temporary.get()
    if paths is not None and not stays:
        paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _folder(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def complete_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below a path that a write has finished; none if it is missing."""
    system, place = _folder(spark, path)
    if not system.exists(place):
        return []
    child = spark._jvm.org.apache.hadoop.fs.Path
    folders = [status.getPath() for status in system.listStatus(place) if status.isDirectory()]
    return sorted(f.getName() for f in folders if system.exists(child(f, "_SUCCESS")))


def remove_folder(spark: SparkSession, path: str) -> None:
    system, place = _folder(spark, path)
    system.delete(place, True)
