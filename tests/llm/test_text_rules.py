"""Hashing of texts, quality rules and decontamination against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from crmflow.llm import decontaminate, quality
from crmflow.llm.text import WORD_BYTES, find_words, hash_spans, text_slices, window_hashes, windows_inside
from crmflow.llm.workers import BLOCKS_AT_ONCE
from tests.llm.frames import awkward_texts, documents, lower, prose, words


@pytest.mark.parametrize("limit", [1, 64, 1 << 20])
def test_words_and_hashes_do_not_depend_on_slices(limit):
    texts = awkward_texts()
    seen = {}
    for low, high, data, offsets in text_slices(pa.array(texts, pa.string()), limit):
        starts, ends, first = find_words(data, offsets, WORD_BYTES)
        hashes = hash_spans(data, starts, ends)
        for i in range(low, high):
            a, b = first[i - low], first[i - low + 1]
            found = [bytes(data[s:e]).decode() for s, e in zip(starts[a:b], ends[a:b])]
            assert found == words(texts[i])
            for word, value in zip(found, hashes[a:b].tolist()):
                assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)


def test_windows_stay_inside_their_text():
    first = np.array([0, 3, 3, 4, 9])
    inside = windows_inside(first, 3)
    assert np.flatnonzero(inside).tolist() == [0, 4, 5, 6]
    assert len(window_hashes(np.arange(9, dtype=np.uint64), 3)) == len(inside)
    assert len(windows_inside(first, 10)) == 0


def measured(text):
    own = words(text)
    grams = Counter(tuple(own[i : i + 5]) for i in range(len(own) - 4))
    repeated = {i + j for i in range(len(own) - 4) if grams[tuple(own[i : i + 5])] > 1 for j in range(5)}
    covered, seen = set(), set()
    for i in range(len(own) - 4):
        gram = tuple(own[i : i + 5])
        covered |= set(range(i, i + 5)) if gram in seen else set()
        seen.add(gram)
    lines, duplicates, line_chars = set(), 0, 0
    for line in (text or "").split("\n"):
        if words(line):
            if line in lines:
                duplicates += 1
                line_chars += sum(map(len, words(line)))
            lines.add(line)
    failed = len(own) < 10 or 100 * len(repeated) > 20 * len(own)
    return (
        len(own),
        sum(map(len, own)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        duplicates,
        len(repeated),
        line_chars,
        sum(len(own[i]) for i in covered),
        failed,
    )


def repetitive_texts():
    rng = random.Random(3)
    base = prose(rng, 60)
    return [
        *awkward_texts(),
        base,
        base + " " + base,
        "\n".join([prose(rng, 12)] * 4 + [prose(rng, 40)]),
        "\n".join([base, prose(rng, 80), base.replace("alpha", "#")]),
        "<b> " * 30,
    ]


def test_quality_counts(spark):
    texts = repetitive_texts()
    docs = documents(spark, texts)
    rows = quality.repetition_report(docs).collect()
    assert len(rows) == len(texts)
    for row in rows:
        found = (
            row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words,
            row.dup_line_chars, row.dup_chars_5, row.base_failed,
        )
        assert found == measured(texts[row.doc_id])
        assert not (row.kept and row.base_failed)


def test_lines_alone_can_reject(spark):
    rng = random.Random(5)
    lines = [prose(rng, 4) for _ in range(8)]
    text = "\n".join(line for line in lines for _ in range(2))
    row = quality.repetition_report(documents(spark, [text])).first()
    assert not row.base_failed and not row.kept


def test_quality_filter_keeps_columns_and_repeated_rows(spark):
    rng = random.Random(4)
    good = prose(rng, 100)
    docs = documents(spark, [good, "short", None, good], ids=[1, 2, 3, 1])
    kept = quality.drop_repetitive(docs)
    assert kept.schema == docs.schema
    assert [r.doc_id for r in kept.collect()] == [1, 1]
    empty = docs.limit(0)
    assert quality.drop_repetitive(empty).count() == quality.repetition_report(empty).count() == 0


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def hits(text, items):
    own, hit, found = alnum(text), set(), set()
    for name, item in items:
        phrase = alnum(item)
        size = min(10, len(phrase))
        for at in range(len(phrase) - size + 1) if size else ():
            window = phrase[at : at + size]
            for i in range(len(own) - size + 1):
                if own[i : i + size] == window:
                    hit |= set(range(i, i + size))
                    found |= {str(name)} if name is not None else set()
    return len(own), len(hit), sorted(found)


def contaminated():
    rng = random.Random(11)
    items = [(i, prose(rng, 14)) for i in range(6)]
    items += [(6, "Just three words"), (7, None), (8, ""), (None, prose(rng, 12)), (1, "another row of item one")]
    texts = awkward_texts()
    for _, item in items:
        if item:
            part = item.split(" ")
            texts += [
                prose(rng, 30) + " " + item + " " + prose(rng, 30),
                " ".join(part[:9]),
                " ".join(part[1:11]).upper() + "! " + " ".join(part[2:13]),
                f"{item}. {item}, {prose(rng, 3)} {item}",
            ]
    return texts, items


@pytest.mark.parametrize("block, shard", [(1 << 20, 1 << 20), (7, 400)])
def test_hits_against_brute_force(spark, block, shard):
    texts, items = contaminated()
    docs = documents(spark, [*texts, texts[-1]], ids=[*range(len(texts)), len(texts) - 1])
    table = spark.createDataFrame(items, "item_id bigint, text string")
    rows = decontaminate.benchmark_hits(docs, table, block_phrases=block, shard_bytes=shard).collect()
    assert len(rows) == len(texts) + 1
    for row in rows:
        text = texts[row.doc_id]
        n_hit = sum(s.word_end - s.word for s in row.spans)
        assert (row.n_words, n_hit, row["items"]) == hits(text, items)
        for span in row.spans:
            assert alnum(text[span.start : span.end]) == alnum(text)[span.word : span.word_end]
    kept = decontaminate.drop_contaminated(docs, table, block_phrases=block)
    assert kept.schema == docs.schema
    assert kept._jdf.queryExecution().executedPlan().toString().count("MapInArrow") <= BLOCKS_AT_ONCE
    clean = sorted(i for i, text in enumerate(texts) if not hits(text, items)[1])
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == clean


def test_empty_tables_have_no_hits(spark):
    docs = documents(spark, ["some words", None])
    nothing = spark.createDataFrame([], "item_id bigint, text string")
    assert [r.spans for r in decontaminate.benchmark_hits(docs, nothing).collect()] == [[], []]
    assert decontaminate.drop_contaminated(docs, nothing).count() == 2
    items = spark.createDataFrame([(1, "some words")], "item_id bigint, text string")
    assert decontaminate.benchmark_hits(docs.limit(0), items).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_index_locates_every_occurrence(seed):
    rng = np.random.default_rng(seed)
    symbols = np.append(rng.integers(0, 4, 400), 0)
    order = decontaminate.sort_suffixes(symbols)
    index = decontaminate.FMIndex(symbols, 3, sample_every=5)
    assert index.locate(np.arange(len(symbols)))[symbols[order] > 0].tolist() == order[symbols[order] > 0].tolist()
    for phrase in ([1], [1, 2], [3, 3, 1], [2, 1, 2, 3]):
        words = np.zeros((4, 1), np.int64)
        words[: len(phrase), 0] = phrase[::-1]
        block = decontaminate.Phrases(np.arange(4), words, np.array([len(phrase)]), [], None, None)
        _, low, high = index.search(block)
        found = sorted(index.locate(np.arange(low[0], high[0]) if len(low) else np.empty(0, np.int64)).tolist())
        n = len(phrase)
        assert found == [i for i in range(len(symbols) - n + 1) if symbols[i : i + n].tolist() == phrase]
