"""Fuzzy line deduplication: MinHash signatures, banding, exact verification, components.

Equal lines are one class from the start. Each class gets a MinHash signature over its
shingles of eight characters, and lines that agree in a band meet. Candidates are verified
by the exact Jaccard similarity of their shingle sets, links lead to connected components,
and of every component the line that comes first (by id, then place) stays.

Lines are what line feeds separate; those without a word are neither compared nor removed.
A line shorter than a shingle is a shingle of its own. A null text has no lines and stays
null. Rows without id come last in the order. Rows that agree in id and text are one
document, written once for each row. Other columns are kept by ``dedup_lines``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType

from crmflow.llm.similar_sets import bit_sketches, find_buckets, in_bitmap, key_bitmap, link_classes
from crmflow.llm.text import column_bytes, mix
from crmflow.llm.workers import giving_back
from crmflow.storage import materialize, temporary_tables

#: Characters of a shingle: a power of two.
SHINGLE = 8
#: Jaccard similarity, in percent, from which lines are alike.
PERCENT = 80
#: A pair at the threshold meets with probability 1 - (1 - 0.8 ** 3) ** 8, above 0.99.
BANDS, ROWS = 8, 3
_SPACE = b" \t\n\x0b\x0c\r"
#: Characters hashed at once; their hashes fit the cache.
_CHUNK = 1 << 16

_BASE = 0x9E3779B97F4A7C15
_LOW_POINTS = mix(np.arange(1 << 16, dtype=np.uint64))
_SEEDS = mix(np.arange(2 * BANDS * ROWS, dtype=np.uint64))
_MASKS = (_SEEDS[: BANDS * ROWS] >> np.uint64(32)).astype(np.uint32)
_FACTORS = (_SEEDS[BANDS * ROWS :] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def _texts(column: pa.Array) -> Iterator[bytes]:
    data, offsets = column_bytes(column)
    buffer, cuts = memoryview(np.ascontiguousarray(data)), offsets.tolist()
    for low, high in zip(cuts[:-1], cuts[1:]):
        yield bytes(buffer[low:high])


def lines_of(text: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Number, class and bytes of each line with a word."""
    for number, line in enumerate(text.split(b"\n")):
        if line.strip(_SPACE):
            # Signed, as Spark's long is.
            yield number, xxhash.xxh3_64_intdigest(line) - (1 << 63), line


def _mix_in_place(values: np.ndarray) -> None:
    """``mix``, without an array for each step."""
    values += np.uint64(0x9E3779B97F4A7C15)
    shifted = values >> np.uint64(30)
    values ^= shifted
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= np.right_shift(values, np.uint64(27), out=shifted)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= np.right_shift(values, np.uint64(31), out=shifted)


def _mixed_points(points: np.ndarray) -> np.ndarray:
    """``mix`` of code points; nearly all are in a table."""
    mixed = _LOW_POINTS.take(points, mode="clip")
    high = points >= len(_LOW_POINTS)
    if high.any():
        mixed[high] = mix(points[high].astype(np.uint64))
    return mixed


def shingle_hashes(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of some lines, and where those of each line start (and the total)."""
    # A line feed ends every line; the others let a shingle start at each place up to the last of them.
    joined = b"\n".join(lines) + b"\n" * SHINGLE
    points = np.frombuffer(joined.decode().encode("utf-32-le"), np.uint32)
    ends = np.flatnonzero(points[: len(points) - SHINGLE + 1] == 10)
    starts = np.append(0, ends[:-1] + 1)
    # Widths double: the hash of 2w characters is made of those of w.
    wide, width = _mixed_points(points), 1
    while width < SHINGLE:
        wider = wide[:-width] * np.uint64(pow(_BASE, width, 1 << 64))
        wider += wide[width:]
        wide, width = wider, 2 * width
    # A shingle starts at all places of a line but its last ones, in a short line at the first.
    inside = np.ones(len(wide), bool)
    for back in range(SHINGLE):
        inside[np.maximum(ends - back, starts)] = False
    short = np.flatnonzero(ends - starts < SHINGLE)
    inside[starts[short]] = True
    found = wide[inside]
    _mix_in_place(found)
    cuts = np.append(0, np.cumsum(np.maximum(ends - starts - SHINGLE + 1, 1)))
    for i in short.tolist():
        found[cuts[i]] = xxhash.xxh3_64_intdigest(lines[i])
    return found, cuts


def signatures(lines: list[bytes]) -> np.ndarray:
    """One row of band hashes per line."""
    hashes, cuts = shingle_hashes(lines)
    upper = (hashes >> np.uint64(32)).astype(np.uint32)
    permuted = np.empty_like(upper)
    least = np.empty((BANDS * ROWS, len(lines)), np.uint32)
    for row in range(BANDS * ROWS):
        np.bitwise_xor(upper, _MASKS[row], out=permuted)
        permuted *= _FACTORS[row]
        np.minimum.reduceat(permuted, cuts[:-1], out=least[row])
    least = least.reshape(BANDS, ROWS, len(lines)).astype(np.uint64)
    bands = np.arange(BANDS, dtype=np.uint64)[:, None]
    for row in range(ROWS):
        bands = mix(bands ^ least[:, row])
    return bands.T


def _distinct_shingles(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The ascending distinct shingles of each line, for some lines at a time, and their cuts."""

    def distinct() -> tuple[np.ndarray, np.ndarray]:
        hashes, cuts = shingle_hashes(lines)
        for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            hashes[low:high].sort()
        fresh = np.ones(len(hashes), bool)
        np.not_equal(hashes[1:], hashes[:-1], out=fresh[1:])
        fresh[cuts[:-1]] = True
        return hashes[fresh], np.append(0, np.cumsum(np.add.reduceat(fresh, cuts[:-1], dtype=np.int64)))

    held, lines = 0, []
    for line in _texts(column):
        lines.append(line)
        held += len(line)
        if held >= _CHUNK:
            yield distinct()
            held, lines = 0, []
    if lines:
        yield distinct()


def line_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The ascending distinct shingles of each line of a column."""
    for shingles, cuts in _distinct_shingles(column):
        for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            yield shingles[low:high]


def _keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = docs[text_column]
    return docs.select(docs[id_column].alias("id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def _occurrences(rows: DataFrame) -> DataFrame:
    """Per line with a word: id and text_key of its document, its number and class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, numbers, classes = [], [], []
            for place, text in enumerate(_texts(batch.column(2))):
                for number, name, _ in lines_of(text):
                    places.append(place)
                    numbers.append(number)
                    classes.append(name)
            owners = batch.select([0, 1]).take(pa.array(places, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*owners.columns, pa.array(numbers, pa.int64()), pa.array(classes, pa.int64())],
                ["id", "text_key", "line", "class"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(giving_back(run), f"id {kind}, text_key bigint, line bigint, class bigint")


def _hashed(batch: pa.RecordBatch, done: set[int]) -> Iterator[tuple[int, np.ndarray]]:
    """Class and band hashes of each line that the task has not seen."""
    names, lines, held = [], [], 0
    for text in _texts(batch.column(2)):
        for _, name, line in lines_of(text):
            if name not in done:
                done.add(name)
                names.append(name)
                lines.append(line)
                held += len(line)
                if held >= _CHUNK:
                    yield from zip(names, signatures(lines))
                    names, lines, held = [], [], 0
    if names:
        yield from zip(names, signatures(lines))


def _line_texts(rows: DataFrame, buckets: DataFrame) -> DataFrame:
    """Class and text of the lines that are in buckets."""
    shared = key_bitmap(buckets, "class")
    wanted = buckets.select("class").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for batch in batches:
            names, lines = [], []
            for text in _texts(batch.column(2)):
                for _, name, line in lines_of(text):
                    if name not in done:
                        done.add(name)
                        names.append(name)
                        lines.append(line)
            kept = np.flatnonzero(in_bitmap(shared.value, np.array(names, np.int64))) if names else []
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([names[i] for i in kept], pa.int64()),
                    pa.array([lines[i].decode() for i in kept], pa.string()),
                ],
                ["class", "text"],
            )

    found = rows.mapInArrow(giving_back(run), "class bigint, text string")
    return found.join(wanted, "class").groupBy("class").agg(F.min("text").alias("text"))


def _measured(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, sketches = [pa.array([], pa.int64())], [pa.array([], pa.binary())]
            for shingles, cuts in _distinct_shingles(batch.column(1)):
                sizes.append(pa.array(np.diff(cuts), pa.int64()))
                sketches.append(bit_sketches(shingles, cuts))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.concat_arrays(sizes), pa.concat_arrays(sketches)],
                [*batch.schema.names, "n", "sketch"],
            )

    return texts.mapInArrow(giving_back(run), "class bigint, text string, copies bigint, n bigint, sketch binary")


def _lines_gone(rows: DataFrame, lines: DataFrame, percent: int) -> DataFrame:
    """The lines to be removed: rows (id, text_key, line, …) of ``lines``, all lines with a word."""
    total = lines.count()
    buckets = materialize(find_buckets(rows, _hashed, total * BANDS), "line-buckets")
    copies = lines.groupBy("class").agg(F.count(F.lit(1)).alias("copies"))
    repeated = materialize(copies.filter("copies > 1"), "line-copies")
    texts = _line_texts(rows, buckets).join(repeated, "class", "left")
    texts = texts.select("class", "text", F.coalesce("copies", F.lit(1).cast("bigint")).alias("copies"))
    classes = materialize(_measured(texts), "line-classes")
    labels = link_classes(buckets, classes, lambda _: classes.select("class", "text"), line_sets, percent)
    # A line that is there once and like no other stays, and is not looked at again.
    roots = labels.select(F.col("component").alias("class"), "component").distinct()
    named = labels.select(F.col("node").alias("class"), "component").unionAll(roots)
    doubtful = repeated.join(named, "class", "full").select("class", F.coalesce("component", "class").alias("label"))
    known = materialize(lines.join(doubtful, "class").drop("class"), "line-places")
    place = F.struct(F.col("id").isNull().alias("last"), "id", "text_key", "line")
    keepers = known.groupBy("label").agg(F.min(place).alias("keep"))
    # Ids may be null, so the comparison is null-safe.
    return known.join(keepers, "label").filter(~place.eqNullSafe(F.col("keep")))


def _numbers_gone(rows: DataFrame, lines: DataFrame, percent: int) -> DataFrame:
    """Per document (_id, _key) that loses lines: the numbers of those to ``remove``."""
    gone = _lines_gone(rows, lines, percent).groupBy("id", "text_key")
    found = gone.agg(F.array_sort(F.collect_set("line")).alias("remove"))
    return found.select(F.col("id").alias("_id"), F.col("text_key").alias("_key"), "remove")


def repeated_lines(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = PERCENT
) -> DataFrame:
    """Per document (id, text_key): ``n_lines`` with a word, and the numbers of those to ``remove``."""
    rows = _keyed(docs, id_column, text_column)
    lines = materialize(_occurrences(rows), "lines")
    with temporary_tables(docs.sparkSession):
        found = materialize(_numbers_gone(rows, lines, percent), "line-numbers", stays=True)
    totals = lines.groupBy("id", "text_key").agg(F.count_distinct("line").alias("n_lines"))
    same = totals["id"].eqNullSafe(found["_id"]) & (totals["text_key"] == found["_key"])
    none = F.array().cast("array<bigint>")
    return totals.join(found, same, "left").select("id", "text_key", "n_lines", F.coalesce("remove", none).alias("remove"))


@F.arrow_udf(StringType())
def without_lines(texts: pa.Array, remove: pa.Array) -> pa.Array:
    """Each text without the lines of the given numbers; null stays null. A text is split once."""
    shorter = []
    for text, numbers in zip(texts, remove):
        if not text.is_valid:
            shorter.append(None)
            continue
        lines = text.as_py().split("\n")
        kept = np.ones(len(lines), bool)
        kept[numbers.values.to_numpy()] = False
        shorter.append("\n".join(lines[i] for i in np.flatnonzero(kept).tolist()))
    return pa.array(shorter, pa.string())


def dedup_lines(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = PERCENT
) -> DataFrame:
    """The rows of ``docs`` without their repeated lines; all other columns stay as they are."""
    rows = _keyed(docs, id_column, text_column)
    with temporary_tables(docs.sparkSession):
        lines = materialize(_occurrences(rows), "lines")
        found = materialize(_numbers_gone(rows, lines, percent), "line-numbers", stays=True)
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    text = docs[text_column]
    keyed = docs.select(row, docs[id_column].alias("id"), F.xxhash64(text).alias("text_key"))
    same = keyed["id"].eqNullSafe(found["_id"]) & (keyed["text_key"] == found["_key"])
    joined = keyed.join(found, same, "left")
    # Only texts that lose lines go to a worker.
    changed = F.when(F.col("remove").isNotNull(), F.col(f"row.`{text_column}`"))
    joined = joined.withColumn("shorter", without_lines(changed, "remove"))
    columns = [
        F.coalesce("shorter", F.col(f"row.`{c}`")).alias(c)
        if c == text_column
        else F.col(f"row.`{c}`").alias(c)
        for c in docs.columns
    ]
    return joined.select(*columns)
