"""Benchmark decontamination with an FM-index over each shard of training text.

A shard is a few megabytes of one task's documents. Words become symbols of the
benchmark's vocabulary; a word outside it can be part of no occurrence, so it ends a run,
and runs shorter than the shortest phrase are left out. The runs are concatenated, suffix
sorted and kept as a Burrows-Wheeler transform in a wavelet matrix. All phrases are searched
backward at once; occurrences are located by walking to sampled suffix positions, and the
spans of a document are merged. Documents are read where they lie; nothing is shuffled.

Phrases are searched in blocks of bounded size, each broadcast on its own, so a benchmark
of any size takes several passes instead of a larger broadcast.

Null texts and texts without words have no hits. Items without words are no phrases; items
without id are searched like others and named by no id. Several rows of one item id count
as one item. Rows are judged one by one, so repeated rows get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from crmflow.llm.text import ALNUM_BYTES, LOWER, column_bytes, find_words, hash_spans, text_slices
from crmflow.llm.workers import block_by_block, giving_back
from crmflow.storage import materialize

PHRASE_WORDS = 10
#: Phrases of one broadcast: at most about 250 bytes each.
BLOCK_PHRASES = 200_000
#: One suffix position in so many is kept.
SAMPLE_EVERY = 8
#: Bytes of text in a shard.
SHARD_BYTES = 2 << 20


def phrases_of(items: DataFrame, id_column: str, text_column: str, size: int) -> DataFrame:
    """The distinct phrases of all items: word hashes, and the ids of the items that hold them."""
    rows = items.select(
        items[id_column].cast("string").alias("item"), items[text_column].alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, names, phrases = batch.column(0).to_pylist(), [], []
            data, offsets = column_bytes(batch.column(1))
            starts, ends, first = find_words(data, offsets, ALNUM_BYTES)
            hashes = hash_spans(data, starts, ends, LOWER).view(np.int64)
            for name, low, high in zip(ids, first[:-1].tolist(), first[1:].tolist()):
                for at in range(low, max(high - size + 1, low + 1) if high > low else low):
                    names.append(name)
                    phrases.append(hashes[at : min(at + size, high)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(phrases, pa.list_(pa.int64()))],
                ["item", "phrase"],
            )

    found = rows.mapInArrow(giving_back(run), "item string, phrase array<bigint>").distinct()
    return found.groupBy("phrase").agg(F.sort_array(F.collect_set("item")).alias("items"))


@dataclass
class Phrases:
    """A block of phrases: their words as symbols from 1, the last word first, 0 where they end."""

    vocabulary: np.ndarray
    words: np.ndarray
    lengths: np.ndarray
    item_names: list[str]
    item_cuts: np.ndarray
    item_numbers: np.ndarray

    @classmethod
    def of(cls, rows: list) -> Phrases:
        lengths = np.array([len(r.phrase) for r in rows], np.int64)
        vocabulary = np.unique(np.concatenate([np.array(r.phrase, np.int64) for r in rows]).view(np.uint64))
        words = np.zeros((int(lengths.max()), len(rows)), np.int64)
        for i, row in enumerate(rows):
            symbols = np.searchsorted(vocabulary, np.array(row.phrase, np.int64).view(np.uint64)) + 1
            words[: len(symbols), i] = symbols[::-1]
        names = sorted({name for r in rows for name in r.names})
        number = {name: i for i, name in enumerate(names)}
        cuts = np.append(0, np.cumsum([len(r.names) for r in rows]))
        numbers = np.array([number[n] for r in rows for n in r.names], np.int64)
        return cls(vocabulary, words, lengths, names, cuts, numbers)


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All integers of [start, start + count) for each pair, one after the other."""
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(int(counts.sum()))


def sort_suffixes(symbols: np.ndarray) -> np.ndarray:
    """The suffixes of an array of non-negative symbols in order, by prefix doubling.

    Every 0 ends a run: zeros rank by position, so suffixes differ at the end of a run at
    the latest, and no comparison reads beyond it. The array ends with 0.
    """
    zeros = symbols == 0
    count = len(symbols)
    first = np.where(zeros, np.cumsum(zeros) - 1, symbols + int(zeros.sum()))
    bits = max(1, int(first.max()).bit_length())
    depth = max(1, min(63 // bits, count))
    key = np.zeros(count, np.int64)
    for i in range(depth):
        key <<= bits
        key[: count - i] |= first[i:]
    order = np.argsort(key, kind="stable")
    while True:
        ordered = key[order]
        fresh = np.append(True, ordered[1:] != ordered[:-1])
        rank = np.empty(count, np.int64)
        rank[order] = np.cumsum(fresh) - 1
        if fresh.all() or depth >= count:
            return order
        # Only suffixes that still tie are sorted again, within their ties.
        tied = ~fresh
        tied[:-1] |= ~fresh[1:]
        at = order[tied]
        beyond = np.where(at + depth < count, rank[np.minimum(at + depth, count - 1)], 0)
        key = rank << 32
        key[at] |= beyond
        order[tied] = at[np.argsort(key[at], kind="stable")]
        depth *= 2


class FMIndex:
    """Backward search over runs of symbols, each ended by 0."""

    def __init__(self, symbols: np.ndarray, largest: int, sample_every: int = SAMPLE_EVERY):
        order = sort_suffixes(symbols)
        self.count = len(symbols)
        before = symbols[order - 1]
        self.smaller = np.append(0, np.cumsum(np.bincount(symbols, minlength=largest + 1)))
        self.bits = range(int(largest).bit_length() - 1, -1, -1)
        self.ones, self.zeros = [], []
        level = before
        for bit in self.bits:
            on = (level >> bit) & 1
            self.ones.append(np.append(0, np.cumsum(on)).astype(np.int32))
            self.zeros.append(self.count - int(self.ones[-1][-1]))
            level = np.concatenate([level[on == 0], level[on == 1]])
        self.begin = self._descend(np.arange(largest + 1), np.zeros(largest + 1, np.int64))
        self.before = before
        # Run starts are sampled too, so a walk never has to pass the end of a run.
        kept = (order % sample_every == 0) | (before == 0)
        self.sampled = np.append(0, np.cumsum(kept))
        self.positions = order[kept]
        self.kept = kept

    def _descend(self, symbols: np.ndarray, rows: np.ndarray) -> np.ndarray:
        for bit, ones, zeros in zip(self.bits, self.ones, self.zeros):
            above = ones[rows]
            rows = np.where((symbols >> bit) & 1, zeros + above, rows - above)
        return rows

    def step(self, symbols: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The first row of a symbol's suffixes, plus its count before each row."""
        return self.smaller[symbols] + self._descend(symbols, rows) - self.begin[symbols]

    def search(self, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phrases that occur, and the first and last-plus-one row of their suffixes."""
        alive = np.arange(len(phrases.lengths))
        low, high = np.zeros(len(alive), np.int64), np.full(len(alive), self.count)
        for words in phrases.words:
            symbols = words[alive]
            more = np.flatnonzero(symbols)
            low[more] = self.step(symbols[more], low[more])
            high[more] = self.step(symbols[more], high[more])
            left = low < high
            alive, low, high = alive[left], low[left], high[left]
        return alive, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The position of the suffix in each row."""
        found = np.empty(len(rows), np.int64)
        walking, steps = np.arange(len(rows)), 0
        while len(walking):
            done = self.kept[rows]
            found[walking[done]] = self.positions[self.sampled[rows[done]]] + steps
            walking, rows = walking[~done], rows[~done]
            rows = self.step(self.before[rows], rows)
            steps += 1
        return found


def occurrences(
    hashes: np.ndarray, first_word: np.ndarray, phrases: Phrases
) -> tuple[np.ndarray, np.ndarray]:
    """Phrase and first word of each occurrence in the texts of a shard."""
    nothing = np.empty(0, np.int64), np.empty(0, np.int64)
    if not len(hashes):
        return nothing
    at = np.searchsorted(phrases.vocabulary, hashes)
    at[at == len(phrases.vocabulary)] = 0
    known = phrases.vocabulary[at] == hashes
    # Runs of known words: they end at unknown words and at the ends of texts.
    begins = known.copy()
    begins[1:] &= ~known[:-1]
    heads = first_word[:-1][first_word[:-1] < len(known)]
    begins[heads] = known[heads]
    run_starts = np.flatnonzero(begins)
    stops = np.append(known[1:], False)
    stops[heads[heads > 0] - 1] = False
    run_ends = np.flatnonzero(known & ~stops) + 1
    long = run_ends - run_starts >= phrases.lengths.min()
    run_starts, lengths = run_starts[long], (run_ends - run_starts)[long]
    if not len(run_starts):
        return nothing
    words = _ranges(run_starts, lengths)
    runs = np.arange(len(lengths))
    symbols = np.zeros(len(words) + len(lengths), np.int64)
    word_at = np.zeros(len(symbols), np.int64)
    places = np.arange(len(words)) + np.repeat(runs, lengths)
    symbols[places], word_at[places] = at[words] + 1, words
    index = FMIndex(symbols, len(phrases.vocabulary))
    alive, low, high = index.search(phrases)
    rows = _ranges(low, high - low)
    return np.repeat(alive, high - low), word_at[index.locate(rows)]


SPAN = "struct<word: bigint, word_end: bigint, start: bigint, end: bigint>"


def shard_hits(column: pa.Array, phrases: Phrases | None, shard_bytes: int) -> Iterator[tuple]:
    """For each text of a column: its words, merged spans (in words and code points) and items hit."""
    for _, _, data, offsets in text_slices(column, shard_bytes):
        starts, ends, first = find_words(data, offsets, ALNUM_BYTES)
        counts = np.diff(first).tolist()
        word = np.empty(0, np.int64)
        if phrases is not None:
            phrase, word = occurrences(hash_spans(data, starts, ends, LOWER), first, phrases)
        if not len(word):
            yield from ((count, [], []) for count in counts)
            continue
        edges = np.zeros(len(starts) + 1, np.int64)
        np.add.at(edges, word, 1)
        np.add.at(edges, word + phrases.lengths[phrase], -1)
        hit = np.cumsum(edges)[:-1] > 0
        points = np.append(0, np.cumsum((data & 0xC0) != 0x80))
        text_of = np.searchsorted(first, word, "right") - 1
        order = np.lexsort((phrase, text_of))
        text_of, phrase = text_of[order], phrase[order]
        cuts = np.searchsorted(text_of, np.arange(len(offsets)))
        for i, count in enumerate(counts):
            if cuts[i] == cuts[i + 1]:
                yield count, [], []
                continue
            edge = np.diff(np.pad(hit[first[i] : first[i + 1]].astype(np.int8), 1))
            a, b = np.flatnonzero(edge > 0), np.flatnonzero(edge < 0)
            base = points[offsets[i]]
            begins, stops = points[starts[first[i] + a]] - base, points[ends[first[i] + b - 1]] - base
            spans = np.stack([a, b, begins, stops], axis=1).tolist()
            mine = np.unique(phrase[cuts[i] : cuts[i + 1]])
            sizes = phrases.item_cuts[mine + 1] - phrases.item_cuts[mine]
            items = np.unique(phrases.item_numbers[_ranges(phrases.item_cuts[mine], sizes)])
            yield count, spans, [phrases.item_names[j] for j in items]


def phrase_blocks(items: DataFrame, id_column: str, text_column: str, size: int, block: int) -> list:
    """The phrases as broadcasts of about ``block`` phrases each; one empty broadcast if there are none."""
    context = items.sparkSession.sparkContext
    found = phrases_of(items, id_column, text_column, size).withColumnRenamed("items", "names")
    found = materialize(found, "phrases")
    count = -(-found.count() // block)
    blocks = []
    for number in range(count):
        rows = found.filter(F.pmod(F.xxhash64("phrase"), F.lit(count)) == number).collect()
        if rows:
            blocks.append(context.broadcast(Phrases.of(rows)))
    return blocks or [context.broadcast(None)]


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joins overlapping spans of the last column but one, found by several passes."""
    for batch in batches:
        merged = []
        for spans in batch.column(batch.num_columns - 2).to_pylist():
            done: list[dict] = []
            for span in sorted(spans, key=lambda s: s["word"]):
                if done and span["word"] <= done[-1]["word_end"]:
                    if span["word_end"] > done[-1]["word_end"]:
                        done[-1] |= {"word_end": span["word_end"], "end": span["end"]}
                else:
                    done.append(dict(span))
            merged.append(done)
        columns = list(batch.columns)
        columns[-2] = pa.array(merged, batch.column(batch.num_columns - 2).type)
        yield pa.RecordBatch.from_arrays(columns, batch.schema.names)


def benchmark_hits(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    size: int = PHRASE_WORDS,
    shard_bytes: int = SHARD_BYTES,
    block_phrases: int = BLOCK_PHRASES,
) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_words``, merged ``spans`` to remove, and ``items``.

    ``spans`` hold word numbers and code points, ends exclusive; ``items`` the sorted ids, as
    text, of the items with a phrase in the document. Other columns are not read.
    """
    rows = docs.select(docs[id_column], docs[text_column])
    blocks = phrase_blocks(items, item_column, "text", size, block_phrases)
    kind = rows.schema[0].dataType.simpleString()
    schema = f"`{id_column}` {kind}, n_words bigint, spans array<{SPAN}>, items array<string>"
    fields = pa.list_(pa.struct([(n, pa.int64()) for n in ("word", "word_end", "start", "end")]))

    def one_pass(rows: DataFrame, block, schema: str) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = list(shard_hits(batch.column(1), block.value, shard_bytes))
                counts, spans, names = zip(*found) if found else ((), (), ())
                spans = [
                    [dict(zip(("word", "word_end", "start", "end"), s)) for s in own] for own in spans
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(i) for i in range(batch.num_columns) if i != 1],
                        pa.array(counts, pa.int64()),
                        pa.array(spans, fields),
                        pa.array(names, pa.list_(pa.string())),
                    ],
                    [n for i, n in enumerate(batch.schema.names) if i != 1] + ["n_words", "spans", "items"],
                )

        return rows.mapInArrow(giving_back(run), schema)

    if len(blocks) == 1:
        return one_pass(rows, blocks[0], schema)
    keyed = rows.select(rows[0], rows[1], F.sha2(rows[1], 256).alias("text_key"))
    wide = schema.replace(", n_words", ", text_key string, n_words", 1)
    found = one_pass(keyed, blocks[0], wide)
    for block in blocks[1:]:
        found = found.unionAll(one_pass(keyed, block, wide))
    merged = (
        found.groupBy(id_column, "text_key", "n_words")
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.flatten(F.collect_set("spans")).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.expr(f"copies div {len(blocks)}"))))
        .select(id_column, "n_words", "spans", "items")
    )
    return merged.mapInArrow(giving_back(_merge), schema)


def drop_contaminated(
    docs: DataFrame,
    items: DataFrame,
    text_column: str = "text",
    item_column: str = "item_id",
    size: int = PHRASE_WORDS,
    shard_bytes: int = SHARD_BYTES,
    block_phrases: int = BLOCK_PHRASES,
) -> DataFrame:
    """The rows of ``docs`` that hold no phrase of any item, with all their columns."""
    place, schema = docs.columns.index(text_column), docs.schema

    def one_pass(rows: DataFrame, block) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hits = shard_hits(batch.column(place), block.value, shard_bytes)
                yield batch.filter(pa.array([not spans for _, spans, _ in hits], pa.bool_()))

        return rows.mapInArrow(giving_back(run), schema)

    blocks = phrase_blocks(items, item_column, "text", size, block_phrases)
    return block_by_block(docs, blocks, one_pass, "uncontaminated")
