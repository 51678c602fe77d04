"""Similarity joins on classes of sets: buckets, candidate pairs, exact comparison, components.

A class is a distinct set, named by a 64-bit hash. Classes that agree in one of some words
(hashes made by a caller) are in a bucket. Candidate pairs come in two rounds, so that a large
group of similar sets never yields all its pairs: first each member of a bucket with one
leader, then only members that are still in different components. Bit sketches, whose
Hamming distance is at most the symmetric difference, sort out most pairs before a text is
fetched; the comparison itself is exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from crmflow.llm.components import components
from crmflow.llm.text import mix
from crmflow.llm.workers import giving_back, group_giving_back
from crmflow.storage import materialize

#: Words of one group in the bucket search, and those a task packs at once.
GROUP_WORDS = 4_000_000
PACK_WORDS = 2_000_000
#: Members of a bucket compared in one step; larger buckets are cut in blocks.
BLOCK_MEMBERS = 1000
#: Up to this many members, all pairs are compared at once (a few thousand sketches).
SMALL_BLOCK = 48
#: A bitmap that tells wanted keys from most others: its bits per key, and fewest and most bits (1 and 32 MB).
BITS_PER_KEY = 16
FILTER_BITS, MAX_FILTER_BITS = 1 << 23, 1 << 28
#: Each key sets a bit for each of these turns of its own bits.
_TURNS = (0, 21, 42)

Sets = Callable[[pa.Array], Iterator[np.ndarray]]


def bit_sketch(shingles: np.ndarray) -> bytes:
    """One parity bit per place, two places or more per shingle; a power of two, so sketches fold."""
    bits = max(64, 1 << int(2 * len(shingles) - 1).bit_length())
    counts = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def bit_sketches(shingles: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """``bit_sketch`` of each run of distinct shingles between cuts, none of them empty."""
    # The exponent of a float is the bit length of its whole number.
    bits = np.maximum(64, np.int64(1) << np.frexp(2.0 * np.diff(cuts) - 1)[1].astype(np.int64))
    ends = np.cumsum(bits)
    place = (shingles & np.repeat(bits - 1, np.diff(cuts)).view(np.uint64)).view(np.int64)
    place += np.repeat(ends - bits, np.diff(cuts))
    parity = (np.bincount(place, minlength=int(ends[-1])) & 1).astype(np.uint8)
    offsets = (np.append(0, ends) >> 3).astype(np.int32)
    packed = np.packbits(parity, bitorder="little")
    return pa.Array.from_buffers(pa.binary(), len(bits), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])


def set_class(shingles: np.ndarray) -> int:
    """A signed 64-bit hash of a set."""
    if not len(shingles):
        return 0
    total = mix(shingles).sum(dtype=np.uint64) + np.uint64(len(shingles))
    return int(mix(np.array([total], np.uint64)).view(np.int64)[0])


def _pack(classes: list, words: list, groups: int) -> pa.RecordBatch:
    """One row per group of word hashes: its classes, how many words each has, and the words."""
    all_words = np.concatenate(words)
    owner = np.repeat(np.arange(len(classes)), [len(w) for w in words])
    group = ((all_words >> np.uint64(32)) * np.uint64(groups)) >> np.uint64(32)
    order = np.argsort(group, kind="stable")
    group, owner, low = group[order], owner[order], all_words[order].astype(np.uint32)
    names = np.array(classes, np.int64)
    cuts = np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1])), len(group))
    rows = []
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        heads = np.flatnonzero(np.append(True, owner[a + 1 : b] != owner[a : b - 1]))
        lengths = np.diff(np.append(heads, b - a)).astype(np.uint32)
        rows.append((int(group[a]), names[owner[a:b][heads]].tobytes(), lengths.tobytes(), low[a:b].tobytes()))
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["part", "classes", "lengths", "words"]
    )


def _meet(table: pa.Table) -> pa.Table:
    """The buckets of one group: where two or more classes have the same word."""
    classes, words = [], []
    for own, lengths, low in zip(*(table.column(c).to_pylist() for c in ("classes", "lengths", "words"))):
        classes.append(np.repeat(np.frombuffer(own, np.int64), np.frombuffer(lengths, np.uint32)))
        words.append(np.frombuffer(low, np.uint32))
    word, member = np.concatenate(words), np.concatenate(classes)
    del classes, words
    ordered = np.sort(word)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    del ordered
    buckets, members = np.empty(0, np.int64), np.empty(0, np.int64)
    if len(twice):
        at = np.searchsorted(twice, word)
        at[at == len(twice)] = 0
        shared = twice[at] == word
        word, member = word[shared], member[shared]
        order = np.lexsort((member, word))
        word, member = word[order], member[order]
        fresh = np.append(True, (word[1:] != word[:-1]) | (member[1:] != member[:-1]))
        word, member = word[fresh], member[fresh]
        heads = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        counts = np.diff(np.append(heads, len(word)))
        # A bucket is named by its members, so equal buckets are one.
        name = mix(np.add.reduceat(mix(member.view(np.uint64)), heads) + counts.astype(np.uint64))
        _, first = np.unique(name, return_index=True)
        kept = np.zeros(len(heads), bool)
        kept[first] = True
        kept &= counts > 1
        rows = np.repeat(kept, counts)
        buckets, members = np.repeat(name.view(np.int64), counts)[rows], member[rows]
    return pa.table({"bucket": pa.array(buckets), "class": pa.array(members)})


def find_buckets(rows: DataFrame, hashed: Callable, words: int) -> DataFrame:
    """Rows (bucket, class): classes that agree in a word.

    ``hashed`` maps an Arrow batch of ``rows`` to (class, words) pairs; a task takes each class
    once. ``words`` is about the number of all words and sets the number of groups.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = max(1, tasks, -(-words // GROUP_WORDS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        classes, held_words, held = [], [], 0
        for batch in batches:
            for name, own in hashed(batch, done):
                classes.append(name)
                held_words.append(own)
                held += len(own)
                if held >= PACK_WORDS:
                    yield _pack(classes, held_words, groups)
                    classes, held_words, held = [], [], 0
        if classes:
            yield _pack(classes, held_words, groups)

    packed = rows.mapInArrow(giving_back(run), "part bigint, classes binary, lengths binary, words binary")
    return packed.groupBy("part").applyInArrow(group_giving_back(_meet), "bucket bigint, class bigint").distinct()


def _pack_bitmap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words (word, bits) of a bitmap, a row for each batch: four bytes of each place, eight of its bits."""
    for batch in batches:
        word, bits = (column.to_numpy() for column in batch.columns)
        packed = [word.astype(np.uint32).tobytes(), bits.tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array([cell], pa.binary()) for cell in packed], ["words", "bits"])


def key_bitmap(rows: DataFrame, column: str) -> Broadcast:
    """A bitmap over the long keys of a column, which are hashes; of bounded size."""
    bits = min(MAX_FILTER_BITS, max(FILTER_BITS, 1 << (rows.count() * BITS_PER_KEY).bit_length()))
    turned = [
        F.shiftleft(column, 64 - turn).bitwiseOR(F.shiftrightunsigned(column, turn)) if turn else F.col(column)
        for turn in _TURNS
    ]
    places = rows.select(F.explode(F.array(*[t.bitwiseAND(F.lit(bits - 1)) for t in turned])).alias("bit"))
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bit").bitwiseAND(63).cast("int"))
    flags = places.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(one).alias("bits"))
    bitmap = np.zeros(bits >> 6, np.uint64)
    # Packed, as a row for each word takes the driver's Python some sixty times the bitmap.
    for words, own in flags.mapInArrow(giving_back(_pack_bitmap), "words binary, bits binary").collect():
        bitmap[np.frombuffer(words, np.uint32)] = np.frombuffer(own, np.uint64)
    return rows.sparkSession.sparkContext.broadcast(bitmap)


def in_bitmap(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """May each key be among those of the bitmap?"""
    keys, last = keys.astype(np.uint64), np.uint64((len(bitmap) << 6) - 1)
    found = np.ones(len(keys), bool)
    for turn in _TURNS:
        at = keys if not turn else keys << np.uint64(64 - turn) | keys >> np.uint64(turn)
        at = at & last
        found &= (bitmap[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
    return found


def _folded(sketch: bytes, words: int) -> np.ndarray:
    bits = np.frombuffer(sketch, np.uint64)
    while len(bits) > words:
        half = len(bits) // 2
        bits = bits[:half] ^ bits[half:]
    return bits


def _may_link(distance, total, percent: int):
    return distance * (100 + percent) <= total * (100 - percent)


def _passes(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, a_n, b_n, a_sketch, b_sketch) whose sketches do not rule out a link, as (a, b)."""
    for batch in batches:
        ones, twos, n, m, left, right = (column.to_pylist() for column in batch.columns)
        kept = []
        for i in range(batch.num_rows):
            words = min(len(left[i]), len(right[i])) // 8
            distance = int(np.bitwise_count(_folded(left[i], words) ^ _folded(right[i], words)).sum())
            if _may_link(distance, n[i] + m[i], percent):
                kept.append(i)
        yield pa.RecordBatch.from_arrays(
            [pa.array([ones[i] for i in kept], pa.int64()), pa.array([twos[i] for i in kept], pa.int64())],
            ["a", "b"],
        )


def _verified(batches: Iterator[pa.RecordBatch], sets: Sets, percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, text of a, text of b) that are similar enough, as (a, b)."""
    for batch in batches:
        linked = []
        for left, right in zip(sets(batch.column(2)), sets(batch.column(3))):
            shared = len(np.intersect1d(left, right, assume_unique=True))
            linked.append(100 * shared >= percent * (len(left) + len(right) - shared))
        yield batch.select([0, 1]).filter(pa.array(linked, pa.bool_()))


def _with_both(pairs: DataFrame, rows: DataFrame, columns: list[str]) -> DataFrame:
    """Columns of both ends of each pair, by class."""
    for side in ("a", "b"):
        own = rows.select(F.col("class").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in columns])
        pairs = pairs.join(own, side)
    return pairs.select("a", "b", *[f"{side}_{c}" for c in columns for side in ("a", "b")])


def plausible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that their sizes and bit sketches do not rule out."""
    near = _with_both(pairs, classes, ["n", "sketch"])
    near = near.filter(F.least("a_n", "b_n") * 100 >= F.greatest("a_n", "b_n") * percent)
    return near.mapInArrow(giving_back(lambda batches: _passes(batches, percent)), "a bigint, b bigint")


def verify(pairs: DataFrame, texts: DataFrame, sets: Sets, percent: int) -> DataFrame:
    """The pairs (a, b) that are links."""
    compared = _with_both(pairs, texts, ["text"])
    return compared.mapInArrow(giving_back(lambda batches: _verified(batches, sets, percent)), "a bigint, b bigint")


def _leader_pairs(buckets: DataFrame, classes: DataFrame) -> DataFrame:
    """Each member of a bucket with the one that has most copies."""
    members = buckets.join(classes.select("class", "copies", "n"), "class")
    leaders = members.groupBy("bucket").agg(F.max(F.struct("copies", "class", "n")).alias("leader"))
    return (
        members.join(leaders, "bucket")
        .filter(F.col("class") != F.col("leader.class"))
        .select(
            F.least("class", "leader.class").alias("a"), F.greatest("class", "leader.class").alias("b")
        )
        .distinct()
    )


def _compare_blocks(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """For a class of a block, those of other labels that its sketch does not rule out.

    Rows (bucket, low, high, side, class, label, n, sketch) come sorted by block. Pairs stay
    packed by class, as they come up again in many buckets.
    """

    def partners(rows: list) -> Iterator[tuple[int, np.ndarray]]:
        labels, counts = np.unique([r[5] for r in rows], return_counts=True)
        # Classes of small components come first and have the long lists.
        rows.sort(key=lambda r: counts[np.searchsorted(labels, r[5])])
        words = min(len(r[7]) for r in rows) // 8
        sketches = np.stack([_folded(r[7], words) for r in rows])
        side, name, label, size = (np.array([r[i] for r in rows], np.int64) for i in (3, 4, 5, 6))
        crossed = rows[0][1] != rows[0][2]
        if len(rows) <= SMALL_BLOCK:
            # All pairs of a small block at once.
            i, j = np.triu_indices(len(rows), 1)
            meets = label[i] != label[j]
            if crossed:
                meets &= side[i] != side[j]
            meets &= np.minimum(size[i], size[j]) * 100 >= np.maximum(size[i], size[j]) * percent
            i, j = i[meets], j[meets]
            distance = np.bitwise_count(sketches[i] ^ sketches[j]).sum(axis=1, dtype=np.int64)
            near = _may_link(distance, size[i] + size[j], percent)
            i, j = i[near], j[near]
            heads = np.flatnonzero(np.append(True, i[1:] != i[:-1])) if len(i) else i
            for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(i)]):
                yield int(name[i[a]]), name[j[a:b]]
            return
        for i in range(len(rows) - 1):
            others = label[i + 1 :] != label[i]
            if crossed:
                others &= side[i + 1 :] != side[i]
            least, most = np.minimum(size[i + 1 :], size[i]), np.maximum(size[i + 1 :], size[i])
            others &= least * 100 >= most * percent
            at = i + 1 + np.flatnonzero(others)
            if len(at):
                distance = np.bitwise_count(sketches[at] ^ sketches[i]).sum(axis=1, dtype=np.int64)
                at = at[_may_link(distance, size[at] + size[i], percent)]
                if len(at):
                    yield int(name[i]), name[at]

    def out(found: list) -> pa.RecordBatch:
        names, others = zip(*found)
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.int64()), pa.array(others, pa.list_(pa.int64()))], ["a", "others"]
        )

    block, rows, found = None, [], []
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns)):
            if row[:3] != block:
                if len(rows) > 1:
                    found += partners(rows)
                    if len(found) > 1000:
                        yield out(found)
                        found = []
                block, rows = row[:3], []
            rows.append(row)
    if len(rows) > 1:
        found += partners(rows)
    if found:
        yield out(found)


def _cross_pairs(buckets: DataFrame, labels: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs of a bucket in different components that their sketches do not rule out."""
    known = labels.select(F.col("node").alias("class"), "component")
    members = buckets.join(known, "class", "left").select(
        "bucket", "class", F.coalesce("component", "class").alias("label")
    )
    mixed = (
        members.groupBy("bucket")
        .agg(F.min("label").alias("one"), F.max("label").alias("two"), F.count(F.lit(1)).alias("members"))
        .filter("one <> two")
        .select("bucket", F.expr(f"(members - 1) div {BLOCK_MEMBERS} + 1").alias("blocks"))
    )
    side = F.pmod(F.xxhash64("class"), F.col("blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    cut = (
        members.join(mixed, "bucket")
        .withColumn("side", side)
        .withColumn("other", other)
        .join(classes.select("class", "n", "sketch"), "class")
        .select(
            "bucket",
            F.least("side", "other").alias("low"),
            F.greatest("side", "other").alias("high"),
            "side",
            "class",
            "label",
            "n",
            "sketch",
        )
    )
    block = ["bucket", "low", "high"]
    found = (
        cut.repartition(*block)
        .sortWithinPartitions(*block)
        .mapInArrow(giving_back(lambda b: _compare_blocks(b, percent)), "a bigint, others array<bigint>")
    )
    found = found.groupBy("a").agg(F.array_distinct(F.flatten(F.collect_list("others"))).alias("others"))
    pairs = found.select("a", F.explode("others").alias("b"))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def link_classes(
    buckets: DataFrame, classes: DataFrame, fetch: Callable[[DataFrame], DataFrame], sets: Sets, percent: int
) -> DataFrame:
    """Rows (node, component) of the classes that have links.

    ``classes`` has columns class, n, sketch and copies; ``fetch`` gives (class, text) for a
    frame of classes at least, as a stored table, and ``sets`` the sets of a column of texts.
    """

    def linked(pairs: DataFrame) -> DataFrame:
        ends = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
        return verify(pairs, fetch(ends), sets, percent)

    leader_pairs = materialize(_leader_pairs(buckets, classes), "leaders")
    links = materialize(linked(materialize(plausible(leader_pairs, classes, percent), "near")), "links")
    labels = components(links)
    crossing = _cross_pairs(buckets, labels, classes, percent).join(leader_pairs, ["a", "b"], "left_anti")
    more = linked(materialize(crossing, "crossing"))
    return components(links.unionAll(more))
