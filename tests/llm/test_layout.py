"""Sharding and mixing."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from crmflow.llm import mixing, sharding
from tests.llm.frames import awkward_texts, documents, prose, words


def test_least_loaded_is_largest_first():
    sizes = np.array([7, 5, 4, 4, 3, 3, 2])
    chosen = sharding.least_loaded(sizes, 3)
    loads = np.bincount(chosen, weights=sizes, minlength=3)
    assert chosen.tolist() == [0, 1, 2, 2, 1, 0, 1] and loads.tolist() == [10, 10, 8]
    assert len(sharding.least_loaded(np.array([], np.int64), 3)) == 0


def test_shards_keep_equal_texts_and_balance(spark):
    rng = random.Random(1)
    texts = [*awkward_texts()[:9], *[prose(rng, rng.randrange(5, 300)) for _ in range(400)]]
    texts += [texts[20]] * 60 + [texts[21]] * 30
    rows = sharding.assign_shards(documents(spark, texts), shards=4).collect()
    assert len(rows) == len(texts)
    by_text, slots, loads = defaultdict(set), defaultdict(list), Counter()
    for row in rows:
        text = texts[row.doc_id] or ""
        assert row["size"] == len(text.encode()) + 1
        by_text[text].add(row.shard)
        slots[row.shard].append(row.slot)
        loads[row.shard] += row["size"]
    assert all(len(shards) == 1 for shards in by_text.values())
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    assert max(loads.values()) - min(loads.values()) < 0.02 * sum(loads.values())
    again = sharding.assign_shards(documents(spark, texts), shards=4).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, rows), key=repr)


def test_shards_of_odd_tables(spark):
    docs = documents(spark, [None, "", "a"], ids=[None, None, 3])
    rows = sharding.assign_shards(docs, shards=2).collect()
    assert len(rows) == 3 and len({r.shard for r in rows if r.text_crc32 == 0}) == 1
    assert sharding.assign_shards(docs.limit(0)).count() == 0
    added = sharding.add_shard(docs.selectExpr("*", "'old' AS shard"), 2)
    assert added.columns == [*docs.columns, "shard"] and added.count() == 3
    assert {r.shard for r in added.collect()} <= {0, 1}
    assert sharding.add_shard(docs.limit(0)).count() == 0


def filled(sizes, weights, share, most):
    """Shares by weight; the excess of full sources is reshared until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    rest, full = share * sum(sizes.values()), {}
    while True:
        open_ = [s for s in order if s not in full]
        total = sum(weight[s] for s in open_)
        level = {s: rest * weight[s] / total for s in open_}
        above = [s for s in open_ if level[s] >= most * sizes[s]]
        if not above or not total:
            return full | level
        for s in above:
            full[s] = most * sizes[s]
            rest -= full[s]


def mixed_documents(spark):
    rng = random.Random(2)
    texts = [*awkward_texts()[:9], *[prose(rng, rng.randrange(1, 60)) for _ in range(600)]]
    names = ["a", "B", "é", None, "zz", "a2", "none"]
    source = lambda i: "none" if i < 3 else names[min(i % 11, 5)]
    return texts, source, documents(spark, texts, source=source)


def test_targets_and_copies(spark):
    texts, source, docs = mixed_documents(spark)
    rows = mixing.mixture(docs).collect()
    assert len(rows) == len(texts)
    sizes = Counter()
    for i, text in enumerate(texts):
        sizes[source(i)] += len(words(text))
    targets = filled(sizes, mixing.WEIGHTS, 1.5, 2)
    taken = Counter()
    for row in rows:
        assert row["size"] == len(words(texts[row.id])) and row.source_size == sizes[row.source]
        assert row.target == pytest.approx(targets[row.source], rel=1e-9)
        assert 0 <= row.copies <= 2
        taken[row.source] += row.copies * row["size"]
    for name, target in targets.items():
        assert abs(taken[name] - target) <= 2 * 60
    again = mixing.mixture(docs.orderBy("text")).collect()
    key = lambda r: (r.id, r.copies)
    assert sorted(map(key, again)) == sorted(map(key, rows))


def test_rows_are_emitted_as_often_as_drawn(spark):
    _, _, docs = mixed_documents(spark)
    docs = docs.unionAll(docs.filter("doc_id in (20, 21, 22)"))
    drawn = Counter()
    for row in mixing.mixture(docs).collect():
        drawn[row.id] += row.copies
    out = mixing.mix_sources(docs)
    assert out.columns == docs.columns
    assert Counter(r.doc_id for r in out.collect()) == +drawn


def test_mix_of_empty_tables(spark):
    docs = documents(spark, [None, "", " "])
    assert [r.copies for r in mixing.mixture(docs).collect()] == [0, 0, 0]
    assert mixing.mix_sources(docs).count() == 0
    assert mixing.mixture(docs.limit(0)).count() == mixing.mix_sources(docs.limit(0)).count() == 0
