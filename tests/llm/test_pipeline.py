"""The stages of the pipeline, each against brute force on its own input."""

from collections import Counter

import corpus_pipeline
from crmflow.llm.registry import BATCH_BYTES, BATCH_LIMIT, _bytes_of, prepare_session
from crmflow.storage import materialize
from tests.llm.frames import documents, joined, shingles, words
from tests.llm.test_layout import filled
from tests.llm.test_similar import components_of
from tests.llm.test_text_rules import hits, measured


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(materialize(stage(spark, frames[-1], small), "stage"))
    texts = [{r.doc_id: r for r in frame.collect()} for frame in frames]
    assert all(frame.columns == docs.columns for frame in frames[:-1])

    assert set(texts[1]) == {i for i, r in texts[0].items() if not measured(r.text)[-1]}

    ids = sorted(texts[1])
    _, group = components_of([texts[1][i].text for i in ids])
    assert set(texts[2]) == {ids[k] for k in set(group.values())}

    clean = {i for i, r in texts[2].items() if not hits(r.text, items)[1]}
    assert set(texts[3]) == clean and len(clean) < len(texts[2])

    sizes, taken = Counter(), Counter()
    for row in frames[3].collect():
        sizes[row.source] += len(words(row.text))
    for row in frames[4].collect():
        taken[row.source] += len(words(row.text))
    largest = max(len(words(r.text)) for r in texts[3].values())
    for source, target in filled(sizes, (3, 1, 2), 1.5, 2).items():
        assert abs(taken[source] - target) <= largest
    assert max(Counter(r.doc_id for r in frames[4].collect()).values()) <= 2

    shard = {}
    for row in frames[5].collect():
        assert shard.setdefault(row.text, row.shard) == row.shard
    assert frames[5].columns == [*docs.columns, "shard"]
    assert frames[5].count() == frames[4].count()


def test_awkward_input_passes_all_stages(spark, small):
    docs = documents(spark, [None, "", "a b", " ".join(map(str, range(50)))] * 2)
    for frame in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            frame = stage(spark, frame, small)
        assert frame.columns == [*docs.columns, "shard"]
        frame.collect()
    assert joined([1, 2], [(1, 2)]) == {1: 1, 2: 1} and not shingles("")


def test_batches_are_bounded_by_bytes(spark):
    before = spark.conf.get(BATCH_LIMIT)
    try:
        for own, expected in (("64m", BATCH_BYTES), ("1m", 1 << 20)):
            spark.conf.set(BATCH_LIMIT, own)
            prepare_session(spark)
            assert _bytes_of(spark.conf.get(BATCH_LIMIT)) == expected
    finally:
        spark.conf.set(BATCH_LIMIT, before)
