"""Near-duplicate documents by a parity-sketch join on word shingles.

A document is the set of its distinct five-word shingles. Every shingle XORs its hash into
one word of a sketch, so a word tells the parity of the shingles that fell into it and each
differing shingle changes at most one word: the number of differing words never exceeds the
symmetric difference, which a similarity of 0.75 bounds by a seventh of both sizes.

Pigeonhole join: two sketches that differ in at most d words agree in one of the first d + 1
words that are not empty, counted in a fixed order. Documents therefore meet under those
words, per size band; a document enters its own band and the one below. The words travel
packed, by hash of their value; where two or more texts meet is a bucket.

Verification is exact and comes in two rounds, so that a group of near copies never yields
all its pairs. First every member of a bucket is compared with one leader. Then only members
that are still in different components are compared; a bit sketch (one bit per shingle),
whose Hamming distance bounds the difference in the same way, sorts most of these out before
a text is fetched. Links lead to connected components.

A sample tells which shingles are common; these come last in the order of the words, so
passages shared by many documents rarely make a bucket. The sample shapes the buckets only:
any choice gives the same links.

Equal sets are one class from the start, and hashes are of 64 bits. Texts with fewer than
five words are one shingle; null texts and those without words are linked with nothing. Rows
without id take part in no link unless another row has the same set. Repeated rows are in one
component; an id with several texts is in the component of each text's row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from crmflow.llm.similar_sets import (
    bit_sketch,
    find_buckets,
    in_bitmap,
    key_bitmap,
    link_classes,
    set_class,
)
from crmflow.llm.text import mix, shingle_sets, text_slices
from crmflow.llm.workers import giving_back
from crmflow.storage import materialize

SHINGLE_WORDS = 5
PERCENT = 75
#: One row in so many is looked at for common shingles; found so often there, one is common.
SAMPLE_ONE_IN = 32
COMMON_COUNT = 8
#: Common shingles that are broadcast (8 bytes each); further ones only cost time.
MAX_COMMON = 1_000_000
#: Below this size every shingle gets a word of its own.
_SMALL_BAND = 128


def size_bounds(percent: int = PERCENT) -> np.ndarray:
    """The smallest size of each band: partners are in the same band or the next."""
    bounds = [1]
    while bounds[-1] < 1 << 40:
        bounds.append(max(bounds[-1] + 1, -(-bounds[-1] * 100 // percent)))
    return np.array(bounds, np.int64)


def sketch_words(shingles: np.ndarray, common: np.ndarray, bounds: np.ndarray, percent: int) -> np.ndarray:
    """The words under which a set of shingles meets its partners, as hashes of band, place and value."""
    size = len(shingles)
    if len(common):
        at = np.searchsorted(common, shingles)
        at[at == len(common)] = 0
        frequent = common[at] == shingles
        ordered = np.concatenate([shingles[~frequent], shingles[frequent]])
        rare = size - int(frequent.sum())
    else:
        ordered, rare = shingles, size
    top = ordered >> np.uint64(32)
    own = int(np.searchsorted(bounds, size, "right")) - 1
    lowest = int(np.searchsorted(bounds, -(-size * percent // 100), "right")) - 1
    found = []
    for band in range(lowest, own + 1):
        largest = int(bounds[band + 1]) - 1
        partner = size * 100 // percent if band == own else largest
        differ = (100 - percent) * (size + partner) // (100 + percent)
        places = largest if largest >= _SMALL_BAND else 1 << 20
        place = (top * np.uint64(places)) >> np.uint64(32)
        place[rare:] += np.uint64(places)
        starts = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        values = np.bitwise_xor.reduceat(ordered, starts)[: differ + 1]
        place = place[starts[: differ + 1]] + np.uint64(band << 42)
        found.append(mix(values ^ mix(place)))
    return np.concatenate(found)


def _sets(column: pa.Array) -> Iterator[np.ndarray]:
    for _, _, data, offsets in text_slices(column):
        yield from shingle_sets(data, offsets, SHINGLE_WORDS)


def _keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = docs[text_column]
    return docs.select(docs[id_column].alias("id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def set_profile(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Per row: id, text_key, size of the set, its class (0 if empty) and its bit sketch."""
    rows = _keyed(docs, id_column, text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(len(s), set_class(s), bit_sketch(s)) for s in _sets(batch.column(2))]
            kinds = (pa.int64(), pa.int64(), pa.binary())
            columns = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                ["id", "text_key", "n", "class", "sketch"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(giving_back(run), f"id {kind}, text_key bigint, n bigint, class bigint, sketch binary")


def common_shingles(docs: DataFrame, id_column: str, text_column: str) -> np.ndarray:
    """Shingles found often in a sample of rows; they only shape the buckets."""
    rows = _keyed(docs, id_column, text_column)
    sample = rows.filter(F.pmod(F.xxhash64("id", "text_key"), F.lit(SAMPLE_ONE_IN)) == 0).select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found in _sets(batch.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["shingle"])

    counts = sample.mapInArrow(giving_back(run), "shingle bigint").groupBy("shingle").count()
    frequent = counts.filter(F.col("count") >= COMMON_COUNT)
    rows = frequent.orderBy(F.desc("count"), "shingle").limit(MAX_COMMON).select("shingle").toPandas()
    return np.sort(rows["shingle"].to_numpy(np.int64).view(np.uint64))


def buckets_of(
    docs: DataFrame, id_column: str, text_column: str, shingles: int, common: np.ndarray, percent: int
) -> DataFrame:
    """Rows (bucket, class): texts that agree in a word of their sketches."""
    bounds, shared = size_bounds(percent), docs.sparkSession.sparkContext.broadcast(common)

    def hashed(batch: pa.RecordBatch, done: set[int]) -> Iterator[tuple[int, np.ndarray]]:
        for found in _sets(batch.column(2)):
            name = set_class(found)
            if len(found) and name not in done:
                done.add(name)
                yield name, sketch_words(found, shared.value, bounds, percent)

    rows = _keyed(docs, id_column, text_column).filter("id IS NOT NULL")
    return find_buckets(rows, hashed, shingles)


def fetch_texts(
    docs: DataFrame, classes: DataFrame, wanted: DataFrame, id_column: str, text_column: str
) -> DataFrame:
    """Class and text for the classes that ``wanted`` names.

    A bitmap of bounded size over the text keys keeps most other texts out of the shuffle.
    """
    chosen = classes.join(wanted, "class").select(
        "class", F.col("id").alias("_id"), F.col("text_key").alias("_key")
    )
    chosen = materialize(chosen, "wanted")
    shared = key_bitmap(chosen, "_key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(1).to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(in_bitmap(shared.value, keys)))

    rows = _keyed(docs, id_column, text_column)
    rows = rows.mapInArrow(giving_back(run), rows.schema)
    same = (rows["id"] == chosen["_id"]) & (rows["text_key"] == chosen["_key"])
    return rows.join(chosen, same).select("class", "text")


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = PERCENT
) -> DataFrame:
    """One row per row of ``docs``: id, text_key, ``n_shingles``, ``component_id``, ``class``, ``keeper``.

    ``component_id`` is the smallest id reachable by links. ``keeper`` tells whether the row
    is the one of its component to keep; rows without shingles or component are kept.
    """
    profile = materialize(set_profile(docs, id_column, text_column), "profile")
    total = profile.agg(F.sum("n")).first()[0] or 0
    common = common_shingles(docs, id_column, text_column)
    buckets = materialize(buckets_of(docs, id_column, text_column, total, common, percent), "buckets")
    classes = (
        profile.filter("n > 0 AND id IS NOT NULL")
        .groupBy("class")
        .agg(
            F.min(F.struct("id", "text_key")).alias("first"),
            F.max("n").alias("n"),
            F.max("sketch").alias("sketch"),
            F.count(F.lit(1)).alias("copies"),
        )
        .select("class", "first.id", "first.text_key", "n", "sketch", "copies")
    )
    classes = materialize(classes, "classes")

    labels = link_classes(
        buckets,
        classes,
        lambda wanted: materialize(fetch_texts(docs, classes, wanted, id_column, text_column), "texts"),
        _sets,
        percent,
    )

    component = F.coalesce("component", "class")
    placed = classes.join(labels, classes["class"] == labels["node"], "left")
    firsts = (
        placed.groupBy(component.alias("label"))
        .agg(F.min(F.struct("id", "text_key")).alias("keep"))
        .select("label", F.col("keep.id").alias("keep_id"), F.col("keep.text_key").alias("keep_key"))
    )
    keepers = placed.select("class", component.alias("label")).join(firsts, "label").drop("label")
    kept = (F.col("id") == F.col("keep_id")) & (F.col("text_key") == F.col("keep_key"))
    return profile.join(keepers, "class", "left").select(
        F.col("id").alias(id_column),
        "text_key",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("id")).otherwise(F.coalesce("keep_id", "id")).alias("component_id"),
        "class",
        F.coalesce(kept, F.lit(True)).alias("keeper"),
    )


def drop_near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = PERCENT
) -> DataFrame:
    """The rows of ``docs`` without those near to one that stays, with all their columns."""
    found = near_duplicates(docs, id_column, text_column, percent)
    gone = materialize(
        found.filter("NOT keeper").select(F.col(id_column).alias("gone_id"), F.col("text_key").alias("gone_key")),
        "gone",
    ).distinct()
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    keyed = docs.select(
        row, docs[id_column].alias("id"), F.xxhash64(docs[text_column]).alias("text_key"),
        F.trim(F.coalesce(docs[text_column], F.lit(""))).alias("body"),
    )
    same = (F.col("id") == F.col("gone_id")) & (F.col("text_key") == F.col("gone_key"))
    left = keyed.join(gone, same, "left_anti")
    # Rows that agree in id and text: one stays, unless the text has no words.
    copies = Window.partitionBy("id", "text_key").orderBy("id")
    single = left.withColumn("copy", F.row_number().over(copies))
    empty = F.col("id").isNull() | (F.length(F.regexp_replace("body", r"[\x20\x09-\x0D]+", "")) == 0)
    return single.filter((F.col("copy") == 1) | empty).select("row.*")
