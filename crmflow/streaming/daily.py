"""Daily metrics on a stream of transactions.

Each batch adds a folder of totals per day and customer. Every ``compact_every`` batches, all
totals so far become one snapshot, from the one before and the batches since: reading takes
the latest snapshot and at most that many batches, however long the stream has run. Batches
and snapshots that a newer snapshot has taken in are removed one snapshot later, so that readers
of the older one can end. No day is ever shut to late rows; they come with a later batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from crmflow.plans.daily import add_daily_parts, daily_parts, merge_daily_parts
from crmflow.storage import complete_folders, remove_folder

#: Batches between two snapshots.
COMPACT_EVERY = 16


def _numbers(spark: SparkSession, path: str, kind: str) -> list[int]:
    """Numbers of the complete batches or snapshots, ascending."""
    names = complete_folders(spark, f"{path}/{kind}")
    return sorted(int(name.split("=")[1]) for name in names if name.startswith("upto="))


def _open_parts(spark: SparkSession, path: str, upto: int | None = None) -> tuple[list[str], list[int], list[int]]:
    """Folders whose parts make up all batches (to ``upto``), and the numbers of snapshots and batches there are."""
    snapshots, batches = _numbers(spark, path, "snapshots"), _numbers(spark, path, "batches")
    last = max((n for n in snapshots if upto is None or n <= upto), default=-1)
    chosen = [f"{path}/snapshots/upto={last}"] if last >= 0 else []
    chosen += [f"{path}/batches/upto={n}" for n in batches if n > last and (upto is None or n <= upto)]
    return chosen, snapshots, batches


def compact_daily_parts(spark: SparkSession, path: str, upto: int) -> None:
    """Write the snapshot of all batches to ``upto``, and remove what the snapshot before took in."""
    chosen, snapshots, batches = _open_parts(spark, path, upto)
    if upto not in snapshots:
        parts = add_daily_parts(spark.read.parquet(*chosen))
        parts.write.mode("overwrite").parquet(f"{path}/snapshots/upto={upto}")
    before = max((n for n in snapshots if n < upto), default=-1)
    for number in snapshots:
        if number < before:
            remove_folder(spark, f"{path}/snapshots/upto={number}")
    for number in batches:
        if number <= before:
            remove_folder(spark, f"{path}/batches/upto={number}")


def stream_daily_parts(
    transactions: DataFrame, path: str, checkpoint: str, compact_every: int = COMPACT_EVERY
) -> StreamingQuery:
    """Add everything that has arrived to the totals per day and customer at ``path``, then stop.

    A batch that runs again after a failure writes the same folder again, so nothing counts
    twice. No row is too late.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        daily_parts(batch).write.mode("overwrite").parquet(f"{path}/batches/upto={number}")
        if (number + 1) % compact_every == 0:
            compact_daily_parts(spark, path, number)

    return (
        transactions.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_daily_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The daily table of all batches so far: open days and rows without a date included."""
    chosen, _, _ = _open_parts(spark, path)
    if not chosen:
        raise FileNotFoundError(f"no batch has been written to {path}")
    return merge_daily_parts(spark.read.parquet(*chosen))
