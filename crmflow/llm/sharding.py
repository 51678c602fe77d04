"""Groups of equal texts on shards of nearly equal size, by longest-processing-time scheduling.

Two levels keep the heap small. Groups are hashed to parts; each part sorts its groups by
size and gives each to the least loaded of its bins. The bins of all parts, at most
``MAX_BINS``, are then sorted by size and go to the least loaded shard in the same way. Texts
are read once; from then on only their sizes and hashes travel.

Null and empty texts are one group, of size 1 per row. Groups are formed by a 64-bit hash:
should two texts collide, they only stay together. Repeated rows count each time. An empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from crmflow.storage import materialize

#: Bins sent to the driver (or the number of shards, if that is more).
MAX_BINS = 1 << 18
_MAX_PARTS = 4096
_BINS = 1 << 15


def least_loaded(sizes: np.ndarray, bins: int) -> np.ndarray:
    """The bin of each item: the largest first, each to the bin with the least so far."""
    heap = [(0, i) for i in range(bins)]
    chosen = np.empty(len(sizes), np.int64)
    sizes_list = sizes.tolist()
    for i in np.argsort(-sizes, kind="stable").tolist():
        load, target = heap[0]
        heapq.heapreplace(heap, (load + sizes_list[i], target))
        chosen[i] = target
    return chosen


def _text_key(text):
    return F.xxhash64(F.coalesce(text, F.lit("")))


def group_shards(groups: DataFrame, shards: int) -> DataFrame:
    """``groups`` with columns key and bytes, one row per key, as key and shard."""
    spark = groups.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(_MAX_PARTS, 4 * tasks, MAX_BINS // shards))
    bins = shards * max(1, _BINS // (parts * shards))

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("key", ignore_index=True)
        part["bin"] = part["part"] * bins + least_loaded(part["bytes"].to_numpy(), bins)
        return part[["key", "bytes", "bin"]]

    packed = materialize(
        groups.withColumn("part", F.pmod(F.xxhash64("key", F.lit("part")), F.lit(parts)))
        .groupBy("part")
        .applyInPandas(pack, "key bigint, bytes bigint, bin bigint"),
        "packed",
    )
    loads = packed.groupBy("bin").agg(F.sum("bytes").alias("bytes")).toPandas().sort_values("bin")
    loads["shard"] = least_loaded(loads["bytes"].to_numpy(np.int64), shards)
    rows = list(zip(loads["bin"].tolist(), loads["shard"].tolist()))
    placed = spark.createDataFrame(rows, "bin bigint, shard int")
    return packed.join(F.broadcast(placed), "bin").select("key", "shard")


def assign_shards(
    docs: DataFrame, shards: int = 8, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: id, ``size``, ``text_crc32``, ``shard`` and ``slot``.

    Slots number the rows of a shard from 0 without gaps.
    """
    text = docs[text_column]
    rows = materialize(
        docs.select(
            docs[id_column],
            (F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 1).alias("size"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
            _text_key(text).alias("key"),
        ),
        "sizes",
    )
    groups = rows.groupBy("key").agg(F.sum("size").alias("bytes"))
    placed = rows.join(group_shards(groups, shards), "key")
    # Slots by cells of hashed rows: a shard's rows are never sorted in one task.
    cells = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = placed.withColumn("cell", F.pmod(F.xxhash64(id_column, "key"), F.lit(cells)))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("shard", "cell")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    )
    within = Window.partitionBy("shard", "cell").orderBy(id_column, "key")
    return (
        placed.withColumn("place", F.row_number().over(within))
        .join(offsets, ["shard", "cell"])
        .select(
            id_column, "size", "text_crc32", "shard", (F.col("first") + F.col("place") - 1).alias("slot")
        )
    )


def add_shard(docs: DataFrame, shards: int = 8, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` with their shard; an input column of that name is replaced."""
    keyed = docs.drop("shard") if "shard" in docs.columns else docs
    row = F.struct(*[keyed[c] for c in keyed.columns]).alias("row")
    text = keyed[text_column]
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 1
    groups = docs.groupBy(_text_key(docs[text_column]).alias("key")).agg(F.sum(size).alias("bytes"))
    placed = group_shards(groups, shards)
    return keyed.select(row, _text_key(text).alias("key")).join(placed, "key").select("row.*", "shard")
