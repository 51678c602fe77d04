"""Words, windows and 64-bit hashes of UTF-8 text, for whole Arrow columns at a time.

All delimiters used here are ASCII, so work on bytes agrees with work on code points.
Hashes are polynomials modulo 2**64 over randomised byte values, finished by a mixer;
equal hashes are taken for equal words, lines or shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes looked at together: their arrays take some twenty times as much, and fit the cache.
SLICE_BYTES = 1 << 20
_CHUNK = 1 << 18
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of uint64 that spreads every input bit over the word."""
    x = values + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, count: int) -> np.ndarray:
    table = np.full(count, base, dtype=np.uint64)
    table[0] = 1
    return np.multiply.accumulate(table)


_UP, _DOWN = _powers(_BASE, _CHUNK + 1), _powers(_BASE_INVERSE, _CHUNK + 1)
_BYTE_VALUES = mix(np.arange(256, dtype=np.uint64))

_BYTES = np.arange(256)
#: Bytes of words: all but space and U+0009 to U+000D.
WORD_BYTES = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))
#: Bytes of words of letters and digits, once A-Z are lower case.
ALNUM_BYTES = (
    ((_BYTES >= 0x30) & (_BYTES <= 0x39))
    | ((_BYTES >= 0x41) & (_BYTES <= 0x5A))
    | ((_BYTES >= 0x61) & (_BYTES <= 0x7A))
    | (_BYTES >= 0x80)
)
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 0x20, _BYTES).astype(np.uint8)
EXACT = _BYTES.astype(np.uint8)


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offset of each text in them; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column) or offsets is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)
    ends = ends[column.offset : column.offset + len(column) + 1].astype(np.int64)
    content = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return content[ends[0] : ends[-1]], ends - ends[0]


def text_slices(
    column: pa.Array, max_bytes: int = SLICE_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cuts a column in runs of rows of about ``max_bytes``; a longer text is a run of its own.

    Yields the first row, the row after the last, their bytes and their offsets.
    """
    data, offsets = column_bytes(column)
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = int(np.searchsorted(offsets, offsets[low] + max_bytes, side="right")) - 1
        high = min(rows, max(high, low + 1))
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def find_words(
    data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and for each text the number of its first word (and the total)."""
    inside = np.zeros(len(data) + 2, bool)
    np.take(word_bytes, data, out=inside[1:-1])
    begins = inside[1:-1] & ~inside[:-2]
    stops = inside[1:-1] & ~inside[2:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    begins[cuts] = inside[1:-1][cuts]
    stops[cuts - 1] = inside[1:-1][cuts - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets)


def hash_spans(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray = EXACT
) -> np.ndarray:
    """A hash of each span of bytes; spans ascend and do not overlap."""
    values = _BYTE_VALUES[fold]
    sums = np.zeros(len(starts), np.uint64)
    running = np.zeros(_CHUNK + 1, np.uint64)
    for low in range(0, len(data), _CHUNK):
        high = min(low + _CHUNK, len(data))
        first, last = np.searchsorted(ends, low, "right"), np.searchsorted(starts, high, "left")
        if first >= last:
            continue
        np.cumsum(values[data[low:high]] * _UP[: high - low], out=running[1 : high - low + 1])
        a = np.clip(starts[first:last] - low, 0, high - low)
        b = np.clip(ends[first:last] - low, 0, high - low)
        sums[first:last] += (running[b] - running[a]) * np.uint64(pow(_BASE, low, 1 << 64))
    blocks = [pow(_BASE_INVERSE, low, 1 << 64) for low in range(0, len(data) + 1, _CHUNK)]
    blocks = np.array(blocks or [1], np.uint64)
    return mix(sums * blocks[starts // _CHUNK] * _DOWN[starts % _CHUNK])


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of the ``size`` words from each position on (positions with too few are left out)."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for i in range(size):
        total += hashes[i : i + count] * _UP[i + 1]
    return mix(total ^ np.uint64(size))


def windows_inside(first_word: np.ndarray, size: int) -> np.ndarray:
    """For each position of ``window_hashes``: does the window stay inside one text?"""
    count = int(first_word[-1]) - size + 1
    if count <= 0:
        return np.empty(0, bool)
    inside = np.ones(count + size, bool)
    for back in range(1, size):
        at = first_word[1:] - back
        inside[at[(at >= 0) & (at >= first_word[:-1])]] = False
    # A text shorter than the window has no position from which a window fits.
    return inside[:count]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = 5) -> Iterator[np.ndarray]:
    """For each text the ascending distinct hashes of its word shingles, A-Z as lower case.

    A text of fewer words has one shingle, its whole sequence; one without words none.
    """
    starts, ends, first = find_words(data, offsets, WORD_BYTES)
    hashes = hash_spans(data, starts, ends, LOWER)
    windows = window_hashes(hashes, size)
    for low, high in zip(first[:-1].tolist(), first[1:].tolist()):
        if high - low >= size:
            found = np.sort(windows[low : high - size + 1])
            keep = np.ones(len(found), bool)
            np.not_equal(found[1:], found[:-1], out=keep[1:])
            yield found[keep]
        else:
            yield window_hashes(hashes[low:high], high - low) if high > low else hashes[:0]
