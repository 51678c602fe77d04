"""Mixing of sources to target weights by systematic sampling.

Each source has a target number of words; the ratio to its size is the expected number of
copies of each of its documents. Along the documents of a source, ordered by size and then
by hash, these expectations are summed up from one random offset, and a document is emitted
once per whole number passed. Ordering by size keeps the words taken within about one
document of the target. Sums over hot sources come from range partitions and their totals,
so no task holds a source.

A null text has no words; a null source is a source of its own, the last one. Sources of
no words have target 0 and their documents are not taken. Repeated rows are drawn like
others. The offset depends on seed and source only, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from crmflow.llm.text import WORD_BYTES, find_words, text_slices
from crmflow.llm.workers import giving_back
from crmflow.operators.ordering import global_positions
from crmflow.storage import materialize

#: Weights of the sources in code-point order, repeated.
WEIGHTS = (3, 1, 2)
#: The mix holds this share (in percent) of all words; no source more than this many times its own.
TOTAL_PERCENT = 150
MAX_COPIES = 2


def count_words(column: pa.Array) -> np.ndarray:
    counts = [
        np.diff(find_words(data, offsets, WORD_BYTES)[2])
        for _, _, data, offsets in text_slices(column)
    ]
    return np.concatenate(counts) if counts else np.empty(0, np.int64)


def measured(docs: DataFrame, id_column: str, text_column: str, source_column: str) -> DataFrame:
    """Per row: id, source, a hash of the whole row, and its number of words."""
    rows = docs.select(
        docs[id_column].alias("id"),
        docs[source_column].cast("string").alias("source"),
        F.xxhash64(*[docs[c] for c in docs.columns]).alias("row_key"),
        docs[text_column].alias("text"),
    )
    kind = rows.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(count_words(batch.column(3)))],
                ["id", "source", "row_key", "size"],
            )

    return rows.mapInArrow(giving_back(run), f"id {kind}, source string, row_key bigint, size bigint")


def source_targets(
    rows: DataFrame, weights: Sequence[float], total_percent: int, max_copies: int
) -> DataFrame:
    """Per source: ``source_size`` and ``target``, shares by weight with the excess of full sources reshared.

    A share of weight * level that would pass ``max_copies`` times the size stops there; the
    level rises until the shares sum up. Each step is one aggregate over the sources.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sizes = sizes.withColumn("last", F.col("source").isNull())
    ordered = global_positions(sizes, ["last", "source"], distinct=True)
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        (F.pmod(F.col("_position") - 1, F.lit(len(weights))) + 1).cast("int"),
    )
    sources = materialize(
        ordered.select(
            "source",
            "source_size",
            weight.alias("weight"),
            (F.lit(float(max_copies)) * F.col("source_size")).alias("most"),
        ),
        "sources",
    )
    level, full = 0.0, -1
    while True:
        capped = (F.col("most") <= F.col("weight") * F.lit(level)) & F.lit(full >= 0)
        state = sources.agg(
            F.sum("source_size").alias("words"),
            F.sum(F.when(capped, F.col("most"))).alias("taken"),
            F.sum(F.when(~capped, F.col("weight"))).alias("open"),
            F.count(F.when(capped, 1)).alias("full"),
        ).first()
        if state["full"] == full or not state["open"]:
            break
        full = state["full"]
        level = (total_percent / 100 * state["words"] - (state["taken"] or 0.0)) / state["open"]
    target = F.least("most", F.col("weight") * F.lit(level))
    return sources.select("source", "source_size", target.alias("target"))


def mixture(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: Sequence[float] = WEIGHTS,
    total_percent: int = TOTAL_PERCENT,
    max_copies: int = MAX_COPIES,
    seed: int = 42,
) -> DataFrame:
    """One row per row of ``docs``: id, source, row_key, size, source_size, target, copies."""
    rows = materialize(measured(docs, id_column, text_column, source_column), "measured")
    targets = materialize(source_targets(rows, weights, total_percent, max_copies), "targets")
    drawn = rows.withColumns(
        {"last": F.col("source").isNull(), "draw": F.xxhash64("row_key", F.lit(seed))}
    )
    placed = global_positions(drawn, ["last", "source", "size", "draw"], distinct=True)
    firsts = placed.groupBy("source").agg(F.min("_position").alias("first"))
    known = targets.withColumnRenamed("source", "of").join(
        firsts.withColumnRenamed("source", "of_first"), F.col("of").eqNullSafe(F.col("of_first"))
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # 31 bits of a hash as a number in [0, 1).
    offset = F.pmod(F.xxhash64("source", F.lit(seed)), F.lit(1 << 31)) / F.lit(float(1 << 31))
    rank = F.col("_position") - F.col("first")
    return (
        placed.join(known.drop("of_first"), F.col("source").eqNullSafe(F.col("of")))
        .withColumns({"rate": rate, "offset": offset, "rank": rank})
        .withColumn(
            "copies",
            F.floor(F.col("offset") + F.col("rate") * (F.col("rank") + 1))
            - F.floor(F.col("offset") + F.col("rate") * F.col("rank")),
        )
        .select("id", "source", "row_key", "size", "source_size", "target", "copies")
    )


def mix_sources(docs: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` as often as they are drawn, with all their columns.

    Rows that agree in every column share their copies evenly.
    """
    plan = mixture(docs, id_column=id_column, **options)
    drawn = plan.groupBy("row_key").agg(
        F.sum("copies").alias("total"), F.count(F.lit(1)).alias("rows")
    )
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    keyed = docs.select(row, F.xxhash64(*[docs[c] for c in docs.columns]).alias("row_key"))
    same = Window.partitionBy("row_key").orderBy("row_key")
    share = F.expr("total * place div rows - total * (place - 1) div rows")
    return (
        keyed.join(drawn.filter("total > 0"), "row_key")
        .withColumn("place", F.row_number().over(same))
        .withColumn("copies", share)
        .filter("copies > 0")
        .select("row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
        .select("row.*")
    )
