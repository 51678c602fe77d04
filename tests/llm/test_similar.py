"""Near duplicates of documents and lines against brute force."""

import random
import time
import tracemalloc
from collections import Counter
from itertools import combinations
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from crmflow.llm import line_dedup, parity_join, similar_sets
from crmflow.llm.components import components
from crmflow.llm.text import mix
from crmflow.storage import shared_dir
from tests.llm.frames import awkward_texts, documents, edited, joined, prose, shingles, words


def near_texts(seed=1):
    rng = random.Random(seed)
    passage = prose(rng, 60)
    texts = awkward_texts()
    for _ in range(12):
        base = prose(rng, rng.randrange(6, 150))
        texts += [base, base.upper(), *[edited(rng, base, rng.choice([0.01, 0.03, 0.05])) for _ in range(3)]]
    base = prose(rng, 120)
    texts += [edited(rng, base, 0.02) for _ in range(60)] + [base] * 10
    texts += [prose(rng, 40) + " " + passage + " " + prose(rng, 40) for _ in range(40)]
    texts += [passage + " " + prose(rng, 9) for _ in range(12)]
    return texts


def components_of(texts):
    sets = [shingles(t) for t in texts]
    linked = [
        (i, j)
        for i, j in combinations(range(len(texts)), 2)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])
    ]
    return sets, joined(range(len(texts)), linked)


@pytest.mark.parametrize("options", [{}, {"BLOCK_MEMBERS": 7, "PACK_WORDS": 50, "GROUP_WORDS": 100}])
def test_components_against_brute_force(spark, monkeypatch, options):
    for name, value in options.items():
        monkeypatch.setattr(similar_sets, name, value)
    if options:
        monkeypatch.setattr(parity_join, "SAMPLE_ONE_IN", 1)
    texts = near_texts()
    sets, want = components_of(texts)
    rows = parity_join.near_duplicates(documents(spark, texts)).collect()
    assert {r.doc_id: r.n_shingles for r in rows} == {i: len(s) for i, s in enumerate(sets)}
    assert {r.doc_id: r.component_id for r in rows} == want
    assert sorted(r.doc_id for r in rows if r.keeper) == sorted(
        {want[i] for i, s in enumerate(sets) if s} | {i for i, s in enumerate(sets) if not s}
    )


def test_one_of_each_group_stays(spark):
    texts = near_texts(2)
    sets, want = components_of(texts)
    docs = documents(spark, texts)
    kept = parity_join.drop_near_duplicates(docs.unionAll(docs))
    assert kept.columns == docs.columns
    found = Counter(r.doc_id for r in kept.select("doc_id").collect())
    assert found == {
        **{i: 2 for i, s in enumerate(sets) if not s},
        **{want[i]: 1 for i, s in enumerate(sets) if s},
    }


def test_rows_without_id(spark):
    docs = documents(spark, ["a b c d e f", "a b c d e f", "other words here", None], ids=[None, 4, None, None])
    rows = parity_join.near_duplicates(docs).collect()
    assert sorted((r.doc_id, r.component_id, r.n_shingles) for r in rows if r.doc_id is not None) == [(4, 4, 2)]
    assert sorted(r.n_shingles for r in rows) == [0, 1, 2, 2]
    assert parity_join.near_duplicates(docs.limit(0)).count() == 0
    assert parity_join.drop_near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("size", [1, 2, 3, 5, 40, 200, 900])
def test_similar_sets_share_a_word(size):
    rng = np.random.default_rng(size)
    bounds = parity_join.size_bounds()
    for _ in range(60):
        first = np.unique(mix(rng.integers(0, 2**62, size).astype(np.uint64)))
        larger = size * 100 // 75
        most = 25 * (2 * size) // 175  # symmetric difference of two sets of this size at the threshold
        cut = rng.integers(0, most // 2 + 1)
        keep = rng.permutation(first)[cut:]
        added = min(cut, larger - len(keep))
        second = np.unique(np.append(keep, mix(rng.integers(2**62, 2**63, added).astype(np.uint64))))
        shared = len(np.intersect1d(first, second))
        if 100 * shared < 75 * (len(first) + len(second) - shared):
            continue
        common = np.sort(rng.permutation(first)[: size // 2])
        for known in (np.empty(0, np.uint64), common):
            a, b = (parity_join.sketch_words(s, known, bounds, 75) for s in (first, second))
            assert len(np.intersect1d(a, b))


def test_bit_sketch_bounds_the_difference():
    rng = np.random.default_rng(5)
    for _ in range(50):
        pool = mix(rng.integers(0, 2**62, 120).astype(np.uint64))
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 120))) for _ in "ab")
        left, right = similar_sets.bit_sketch(a), similar_sets.bit_sketch(b)
        size = min(len(left), len(right)) // 8
        distance = np.bitwise_count(similar_sets._folded(left, size) ^ similar_sets._folded(right, size)).sum()
        assert distance <= len(np.setxor1d(a, b))


def test_connected_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)]
    edges += [(i, i + 1) for i in range(1000, 1060)] + [(2000, i) for i in range(2001, 2100)] + [(5, 5)]
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    want = joined(nodes, [e for e in edges if e[0] != e[1]])
    frame = spark.createDataFrame([*edges, edges[0], (None, 3)], "a bigint, b bigint")
    found = {r.node: r.component for r in components(frame).collect()}
    assert {n: found.get(n, n) for n in nodes} == want
    assert components(frame.limit(0)).count() == 0


def line_texts():
    rng = random.Random(8)
    lines = [prose(rng, rng.randrange(12, 40)) for _ in range(30)]
    texts = awkward_texts()[:9]
    for _ in range(40):
        own = [rng.choice(lines) for _ in range(4)]
        own += ["", "  ", edited(rng, rng.choice(lines), 0.01), prose(rng, 20), "short", "é語" * rng.randrange(1, 4)]
        rng.shuffle(own)
        texts.append("\n".join(own))
    return texts


def line_shingles(line):
    return frozenset(line[i : i + 8] for i in range(len(line) - 7)) if len(line) >= 8 else frozenset([line])


def deduplicated(texts):
    rows = [(i, n, line) for i, t in enumerate(texts) for n, line in enumerate((t or "").split("\n")) if words(line)]
    distinct = {line: k for k, line in enumerate(dict.fromkeys(line for _, _, line in rows))}
    sets = {k: line_shingles(line) for line, k in distinct.items()}
    linked = [
        (a, b) for a, b in combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    label = joined(sets, linked)
    seen, gone = set(), set()
    for i, n, line in rows:
        name = label[distinct[line]]
        gone |= {(i, n)} if name in seen else set()
        seen.add(name)
    return [
        None if t is None else "\n".join(l for n, l in enumerate(t.split("\n")) if (i, n) not in gone)
        for i, t in enumerate(texts)
    ], len(linked)


def awkward_lines():
    lines = [line for text in line_texts() if text for line in text.split("\n") if words(line)]
    return lines + ["a", "🙂", "🙂é語" * 9, "1234567", "12345678", "123456789", " x\t\r", "ab" * 40_000]


def test_shingles_of_lines():
    """Of lines together as of each alone: a hash for each shingle, in order."""
    lines = awkward_lines()
    hashes, cuts = line_dedup.shingle_hashes([line.encode() for line in lines])
    names = {}
    for line, low, high in zip(lines, cuts[:-1].tolist(), cuts[1:].tolist()):
        own = [line[i : i + 8] for i in range(len(line) - 7)] or [line]
        assert high - low == len(own)
        assert all(names.setdefault(text, h) == h for text, h in zip(own, hashes[low:high].tolist()))
    assert len(set(names.values())) == len(names)
    together = line_dedup.signatures([line.encode() for line in lines])
    alone = [line_dedup.signatures([line.encode()])[0] for line in lines]
    assert (together == np.stack(alone)).all()


def test_sets_and_sketches_of_lines():
    lines = awkward_lines()
    want = [np.unique(line_dedup.shingle_hashes([line.encode()])[0]) for line in lines]
    found = list(line_dedup.line_sets(pa.array(lines)))
    assert len(found) == len(want) and all(np.array_equal(a, b) for a, b in zip(found, want))
    sketches = similar_sets.bit_sketches(np.concatenate(want), np.append(0, np.cumsum([len(s) for s in want])))
    assert sketches.to_pylist() == [similar_sets.bit_sketch(s) for s in want]


def test_sets_of_lines_cost_little_beside_their_hashes():
    rng = random.Random(9)
    lines = [prose(rng, rng.randrange(5, 60)) for _ in range(4000)]
    column, encoded = pa.array(lines), [line.encode() for line in lines]

    def plain():
        hashes, cuts = line_dedup.shingle_hashes(encoded)
        return [np.unique(hashes[a:b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]

    def seconds(call):
        taken = []
        for _ in range(3):
            began = time.process_time()
            call()
            taken.append(time.process_time() - began)
        return min(taken)

    # About 0.2; one by one, lines take as long as this comparison.
    assert seconds(lambda: list(line_dedup.line_sets(column))) < 0.6 * seconds(plain)


def test_line_dedup_against_brute_force(spark):
    texts = line_texts()
    want, linked = deduplicated(texts)
    assert linked > 20
    docs = documents(spark, texts)
    out = line_dedup.dedup_lines(docs)
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == dict(enumerate(want))


def test_line_dedup_of_odd_tables(spark):
    docs = documents(spark, ["a line here\nb", "a line here", None, "a line here"], ids=[None, 2, 3, 2])
    out = sorted((r.doc_id or -1, r.text or "") for r in line_dedup.dedup_lines(docs).collect())
    # The row without id comes last in the order; rows alike in id and text are one document.
    assert out == [(-1, "b"), (2, "a line here"), (2, "a line here"), (3, "")]
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_texts_of_very_many_lines(spark):
    """A text is split once, however many of its lines stay."""
    lines = [f"line {i} of {i * 7919 % 100_003} and {i * 104_729 % 99_991}" for i in range(100_000)]
    text = "\n".join([*lines, lines[5], "", *lines[:3]])
    found = line_dedup.dedup_lines(documents(spark, [text, "one\ntwo"], extra=False)).orderBy("doc_id").collect()
    assert found[0]["text"].split("\n")[-1] == "" and found[1]["text"] == "one\ntwo"
    assert found[0]["text"] == "\n".join([*dict.fromkeys(found[0]["text"].split("\n"))])


def test_line_dedup_removes_its_tables(spark):
    folder = Path(shared_dir(spark).removeprefix("file://"), "crmflow")
    before = set(folder.glob("*"))
    docs = documents(spark, line_texts())
    out = line_dedup.dedup_lines(docs)
    left = set(folder.glob("*")) - before
    assert [p.name.rsplit("-", 1)[0] for p in left] == ["line-numbers"]
    assert out.count() == docs.count()


@pytest.mark.parametrize("count", [0, 1, 200_000])
def test_key_bitmap(spark, monkeypatch, count):
    """It knows all its keys, and grows with them: few others pass."""
    monkeypatch.setattr(similar_sets, "FILTER_BITS", 1 << 16)
    hashed = spark.range(count).select(F.xxhash64("id").alias("key"))
    bitmap = similar_sets.key_bitmap(hashed, "key").value
    keys = np.array([r.key for r in hashed.collect()], np.int64)
    assert similar_sets.in_bitmap(bitmap, keys).all()
    others = np.array([r.key for r in spark.range(10**6, 10**6 + 20_000).select(F.xxhash64("id").alias("key")).collect()])
    assert similar_sets.in_bitmap(bitmap, others).mean() < 0.02


def test_key_bitmap_takes_the_driver_little_more_than_its_size(spark, monkeypatch):
    monkeypatch.setattr(similar_sets, "FILTER_BITS", 1 << 16)
    arrow = "spark.sql.execution.arrow.pyspark.enabled"
    before = spark.conf.get(arrow)
    # As sessions have it that do not ask for more.
    spark.conf.set(arrow, "false")
    tracemalloc.start()
    try:
        shared = similar_sets.key_bitmap(spark.range(200_000).select(F.xxhash64("id").alias("key")), "key")
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
        spark.conf.set(arrow, before)
    assert shared.value.nbytes == 1 << 19
    assert peak < 10 * shared.value.nbytes
