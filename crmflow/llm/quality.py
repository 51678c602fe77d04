"""Repetition rules: how much of a text lies inside duplicated word n-grams and lines.

Each slice of an Arrow batch is hashed once; windows of several lengths get rolling
hashes, and equal hashes inside one text mark the duplicates. No shuffle is needed.

Null and empty texts have no words and fail the base rule (fewer than ten words).
Rows are judged one by one, so repeated rows get equal verdicts and all columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from crmflow.llm.text import (
    SLICE_BYTES,
    WORD_BYTES,
    find_words,
    hash_spans,
    mix,
    text_slices,
    window_hashes,
    windows_inside,
)
from crmflow.llm.workers import giving_back

MIN_WORDS = 10
#: Words in repeated five-word windows, per hundred.
MAX_REPEAT_PERCENT = 20
REPEAT_WORDS = 5
#: n-gram length -> largest share (in percent) of a text's word characters that may lie in
#: second or later occurrences of n-grams of that length. Fixed values of published rules.
MAX_COVER_PERCENT = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}
#: The same for second or later occurrences of whole lines.
MAX_LINE_PERCENT = 20

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _repeats(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(len(keys), bool)
    at = np.searchsorted(twice, keys)
    at[at == len(twice)] = 0
    return twice[at] == keys


def _later(keys: np.ndarray) -> np.ndarray:
    """Positions of keys that occurred before."""
    at = np.flatnonzero(_repeats(keys))
    order = at[np.argsort(keys[at], kind="stable")]
    return order[1:][keys[order[1:]] == keys[order[:-1]]]


def _covered(positions: np.ndarray, size: int, count: int) -> np.ndarray:
    """Which of ``count`` words lie in a window of ``size`` that starts at one of the positions."""
    edges = np.zeros(count + 1, np.int32)
    edges[positions] += 1
    edges[positions + size] -= 1
    return np.cumsum(edges[:-1]) > 0


def measure(data: np.ndarray, offsets: np.ndarray, lengths: Sequence[int]) -> dict[str, np.ndarray]:
    """The counts of each text: words, their characters, symbols, repeats, characters covered."""

    def per_text(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(values) + 1, np.int64)
        np.cumsum(values, out=sums[1:])
        return sums[cuts[1:]] - sums[cuts[:-1]]

    texts = len(offsets) - 1
    starts, ends, first = find_words(data, offsets, WORD_BYTES)
    points = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=points[1:])
    chars = points[ends] - points[starts]
    found = {
        "n_words": np.diff(first).astype(np.int64),
        "word_chars": per_text(chars, first),
        "n_symbols": per_text(_SYMBOL[data], offsets),
    }

    hashes = hash_spans(data, starts, ends)
    owner = np.repeat(mix(np.arange(texts, dtype=np.uint64)), np.diff(first))
    for size in dict.fromkeys((REPEAT_WORDS, *lengths)):
        inside = np.flatnonzero(windows_inside(first, size))
        keys = mix(window_hashes(hashes, size)[inside] ^ owner[inside])
        if size == REPEAT_WORDS:
            again = _covered(inside[_repeats(keys)], size, len(starts))
            found["n_repeat_words"] = per_text(again, first)
        if size in lengths:
            again = _covered(inside[_later(keys)], size, len(starts))
            found[f"dup_chars_{size}"] = per_text(chars * again, first)

    breaks = np.flatnonzero(data == 0x0A)
    line_starts = np.union1d(offsets[:-1][np.diff(offsets) > 0], breaks + 1)
    line_starts = line_starts[line_starts < len(data)]
    line_ends = np.append(line_starts, len(data))[1:]
    line_ends = line_ends - (data[line_ends - 1] == 0x0A)
    words_before = np.searchsorted(starts, [line_starts, line_ends])
    worded = words_before[1] > words_before[0]
    line_starts, line_ends, words_before = line_starts[worded], line_ends[worded], words_before[:, worded]
    text_of = np.searchsorted(offsets, line_starts, "right") - 1
    line_first = np.searchsorted(text_of, np.arange(texts + 1))
    keys = mix(hash_spans(data, line_starts, line_ends) ^ mix(text_of.astype(np.uint64)))
    again = np.zeros(len(keys), bool)
    again[_later(keys)] = True
    chars_before = np.append(0, np.cumsum(chars))
    line_chars = chars_before[words_before[1]] - chars_before[words_before[0]]
    found["n_dup_lines"] = per_text(again, line_first)
    found["dup_line_chars"] = per_text(line_chars * again, line_first)
    return found


def verdicts(found: dict[str, np.ndarray], covers: dict[int, int], line_percent: int) -> None:
    """Adds ``base_failed`` and ``kept`` to the counts."""
    words, chars = found["n_words"], found["word_chars"]
    failed = (words < MIN_WORDS) | (100 * found["n_repeat_words"] > MAX_REPEAT_PERCENT * words)
    kept = ~failed & (100 * found["dup_line_chars"] <= line_percent * chars)
    for size, percent in covers.items():
        kept &= 100 * found[f"dup_chars_{size}"] <= percent * chars
    found["base_failed"], found["kept"] = failed, kept


def _judged(column: pa.Array, covers: dict[int, int], line_percent: int) -> Iterator[dict]:
    for _, _, data, offsets in text_slices(column, SLICE_BYTES):
        found = measure(data, offsets, list(covers))
        verdicts(found, covers, line_percent)
        yield found


def repetition_report(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    covers: dict[int, int] | None = None,
    line_percent: int = MAX_LINE_PERCENT,
) -> DataFrame:
    """One row per row of ``docs``: its id, the counts, ``base_failed`` and ``kept``.

    Other columns are not read. A null or empty text has all counts 0 and is not kept.
    """
    covers = MAX_COVER_PERCENT if covers is None else covers
    rows = docs.select(docs[id_column], docs[text_column])
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars"]
    counts += [f"dup_chars_{size}" for size in covers]
    names = [*counts, "base_failed", "kept"]
    schema = ", ".join(
        [f"`{id_column}` {rows.schema[0].dataType.simpleString()}"]
        + [f"{name} bigint" for name in counts]
        + ["base_failed boolean", "kept boolean"]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = list(_judged(batch.column(1), covers, line_percent))
            if done:
                columns = [np.concatenate([d[name] for d in done]) for name in names]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *map(pa.array, columns)], [id_column, *names]
                )

    return rows.mapInArrow(giving_back(run), schema)


def drop_repetitive(
    docs: DataFrame,
    text_column: str = "text",
    covers: dict[int, int] | None = None,
    line_percent: int = MAX_LINE_PERCENT,
) -> DataFrame:
    """The rows of ``docs`` that pass all rules, with all their columns."""
    covers = MAX_COVER_PERCENT if covers is None else covers
    place = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [d["kept"] for d in _judged(batch.column(place), covers, line_percent)]
            if done:
                yield batch.filter(pa.array(np.concatenate(done)))

    return docs.mapInArrow(giving_back(run), docs.schema)
