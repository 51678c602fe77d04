"""Archives, URL filters and token totals."""

import hashlib
import random

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

from crmflow.llm import queries_counts, token_counts, url_filter, warc
from crmflow.llm.queries_counts import TOKENIZERS
from crmflow.llm.workers import BLOCKS_AT_ONCE
from crmflow.operators.skew import DEFAULT_POLICY, SkewPolicy
from crmflow.storage import scratch_path
from tests.llm.frames import awkward_texts, documents, prose

PAGES = "page_id bigint, url string, html string"


def pages(spark):
    big, huge = "é<p>" * 400, "語" * 90_000
    rows = [
        (1, "http://a/1", big), (2, "http://a/2\r\nX: y", big), (7, None, big), (3, "%0A", "small"),
        (4, "http://a/4", "small"), (5, "http://a/5", None), (6, "http://a/6", ""), (None, "http://b", big),
        (8, "http://c", huge), (9, "http://d", huge), (7, None, big), (None, None, huge + "x"),
        (10, "http://e", "WARC/1.1\r\n\r\n" * 100),
    ]
    return rows, spark.createDataFrame(rows, PAGES).withColumn("record", F.lit("clash"))


#: No list of repeated digests counts as small.
BY_BITMAP = SkewPolicy(broadcast_rows=0)


@pytest.mark.parametrize("chunk, policy", [(100, DEFAULT_POLICY), (64 << 10, DEFAULT_POLICY), (64 << 10, BY_BITMAP)])
def test_archive_round_trip(spark, chunk, policy):
    rows, table = pages(spark)
    path = scratch_path(spark, "warc-test")
    warc.write_archive(table, path, chunk_bytes=chunk, policy=policy)
    stored = spark.read.schema(warc.CHUNKS).parquet(path)
    assert stored.agg(F.max(F.octet_length("data"))).first()[0] <= chunk
    found = [tuple(r) for r in warc.read_records(stored).collect()]
    largest = {}
    for page_id, _, html in rows:
        if len((html or "").encode()) >= 1000 and page_id is not None:
            largest[html] = max(page_id, largest.get(html, page_id))
    want = []
    for page_id, url, html in rows:
        payload, first = (html or "").encode(), largest.get(html)
        refers = first if first is not None and (page_id is None or page_id < first) else None
        want.append(
            (
                None if page_id is None else str(page_id), len(payload), hashlib.sha1(payload).hexdigest(),
                "response" if refers is None else "revisit", None if refers is None else str(refers), url,
            )
        )
    assert sorted(found, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("words", [1, 1 << 19])
def test_only_repeated_payloads_are_shuffled(spark, monkeypatch, words):
    """With one word nearly every large payload is asked for, with many hardly any; the result is the same."""
    monkeypatch.setattr(warc, "FILTER_WORDS", words)
    made = spark.range(3000).select(
        F.col("id").alias("page_id"), F.lit(None).cast("string").alias("url"),
        F.repeat(F.when(F.col("id") % 10 == 0, F.col("id") % 70).otherwise(F.col("id")).cast("string"), 700).alias("html"),
    )
    def kinds(policy):
        return sorted(map(tuple, warc.decide_revisits(made, "page_id", "url", "html", policy).drop("payload").collect()))

    plain = kinds(DEFAULT_POLICY)
    assert kinds(BY_BITMAP) == plain and 250 < sum(row[-1] is not None for row in plain) < 300
    decided = warc.decide_revisits(made, "page_id", "url", "html", DEFAULT_POLICY)
    plan = decided._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_damaged_archives_are_noticed(spark):
    _, table = pages(spark)
    path = scratch_path(spark, "warc-test")
    warc.write_archive(table, path, chunk_bytes=100)
    stored = spark.read.schema(warc.CHUNKS).parquet(path)
    with pytest.raises(Exception, match="missing or damaged"):
        warc.read_records(stored.filter("chunk <> 2")).collect()
    with pytest.raises(Exception, match="cut short"):
        warc.read_records(stored.filter("NOT last")).collect()
    path = scratch_path(spark, "warc-test")
    warc.write_archive(table.limit(0), path)
    assert warc.read_records(spark.read.schema(warc.CHUNKS).parquet(path)).count() == 0


@pytest.mark.parametrize("shards", [1, 5])
def test_cascade_is_exact_on_its_universe(shards):
    rng = np.random.default_rng(shards)
    one, two = (rng.integers(0, 2**63, 60_000).astype(np.uint64) * np.uint64(2) for _ in "ab")
    listed = rng.random(len(one)) < 0.4
    part = (two >> np.uint64(33)).astype(np.int64) % shards
    rows = []
    for shard in range(shards):
        own = part == shard
        levels = url_filter.build_levels(one[own], two[own], listed[own])
        assert len(levels) > 2
        rows += [{"shard": shard, "level": i, "bits": bits.tobytes()} for i, bits in enumerate(levels)]
    assert (url_filter.Cascade(rows, shards).listed(one, two) == listed).all()
    rest = [row for row in rows if row["shard"] != 0]
    assert (url_filter.Cascade(rest, shards).listed(one, two) == (listed & (part != 0))).all()


def test_ten_blocks_of_a_list_take_few_workers_at_once(spark):
    keys = spark.range(4000).select(
        *url_filter._key_hashes([F.col("id").cast("string")]), (F.col("id") % 3 == 0).alias("listed")
    )
    blocks = url_filter.build_cascade(keys, shard_keys=100, block_bytes=200)
    assert len(blocks) >= 10
    rows = spark.range(4000).select(F.col("id").cast("string").alias("key"))
    marked = url_filter.mark_listed(rows, ["key"], blocks)
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert 1 <= plan.count("MapInArrow") <= BLOCKS_AT_ONCE
    assert all(row.listed == (int(row.key) % 3 == 0) for row in marked.collect())


def test_urls(spark):
    rng = random.Random(1)
    hosts = ["Example.ORG", "x.example.org", "notexample.org", "a.com", "b.net", "com", ""]
    paths = ["", "/", "/es/", "/en/1", "/en/1234", "/fr/", "/de/x", "/é"]
    urls = [None, "", "no scheme", "http://", "a://b://c/d", "http://b.net\n/x", "x://user@b.net:80/"]
    urls += [f"http://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '?utm_source=1', '#f'])}" for _ in range(300)]
    rows = [(i, url, "") for i, url in enumerate(urls)] + [(0, None, "")]
    table = spark.createDataFrame(rows, PAGES).withColumns({"host": F.lit("clash"), "one": F.lit(1)})
    judged = url_filter.judge_urls(table, table["url"].contains("utm_source="), shard_keys=20, block_bytes=64)
    found = judged.collect()
    assert len(found) == len(rows)

    def parts(url):
        _, mark, rest = (url or "").partition("://")
        end = min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])
        host = rest[:end].split("/")[0]
        lowered = "".join(c.lower() if c.isascii() else c for c in host)
        return (lowered, rest[len(host) : end]) if mark else ("", "")

    blocked = {parts(url) for url in urls if "utm_source=" in (url or "")}
    for row in found:
        host, path = parts(urls[row.page_id])
        fits = [
            (len(h + p), h + p, verdict)
            for verdict, h, p in url_filter.RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)
        ]
        rule = max(fits)[1:] if fits else (None, "block" if (host, path) in blocked else "allow")
        assert (row.host, row.path, row.rule, row.verdict) == (host, path, *rule)
    assert url_filter.judge_urls(table.limit(0), table["url"].isNull()).count() == 0
    with pytest.raises(ValueError, match="already"):
        url_filter.mark_listed(table.withColumn("listed", F.lit(1)), ["url"], [])


def test_totals_follow_signed_changes(spark):
    texts = ["some words", None, "", "more words here", "some words", "x" * 3000]
    docs = documents(spark, texts)
    name, path = next(iter(TOKENIZERS.items()))
    counted = token_counts.count_tokens(docs, {name: path})
    tokens = {r.doc_id: r[name] for r in counted.collect()}
    assert tokens[1] == tokens[2] == 0 and tokens[0] == tokens[4] == 2
    rollup = token_counts.TokenRollup(spark, scratch_path(spark, "rollup-test"))
    rollup.commit(1, token_counts.change(counted, 1, name, F.col(name)))

    def totals():
        return {(r.source, r.lang): (r.docs, r.tokens) for r in rollup.totals().collect()}

    def expected(rows):
        sums = {}
        for i, count in rows:
            key = ([None, "s1", "s2", "s1"][i % 4], ["en", "fr", None][i % 3])
            docs, tokens = sums.get(key, (0, 0))
            sums[key] = (docs + 1, tokens + count)
        return sums

    assert totals() == expected(tokens.items())
    # Revise one count, delete two documents; replaying the batch changes nothing.
    revised = counted.filter("doc_id = 3")
    changes = (
        token_counts.change(revised, -1, name, F.col(name))
        .unionAll(token_counts.change(revised, 1, name, F.lit(50)))
        .unionAll(token_counts.change(counted.filter("doc_id IN (0, 5)"), -1, name, F.col(name)))
    )
    after = expected([(i, 50 if i == 3 else n) for i, n in tokens.items() if i not in (0, 5)])
    for _ in range(3):
        rollup.commit(2, changes)
        assert totals() == after
    rollup.commit(3, changes.limit(0))
    assert totals() == after


def _frame(spark, rows):
    return spark.createDataFrame(rows, token_counts.DELTAS)


def _totals(rollup):
    return {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in rollup.totals().collect()}


def test_rollup_without_batches_has_no_totals(spark):
    rollup = token_counts.TokenRollup(spark, scratch_path(spark, "rollup-none"))
    assert rollup.totals().count() == 0
    rollup.compact()
    assert rollup.folders_read() == []
    rollup.commit(1, _frame(spark, []))
    assert _totals(rollup) == {}


def test_batch_committed_again_without_rows_is_empty(spark):
    rollup = token_counts.TokenRollup(spark, scratch_path(spark, "rollup-again"))
    rollup.commit(1, _frame(spark, [("a", None, "t", 2, 10)]))
    rollup.commit(2, _frame(spark, [("a", None, "t", 1, 7), (None, "en", "t", 1, 3)]))
    assert _totals(rollup) == {("a", None, "t"): (3, 17), (None, "en", "t"): (1, 3)}
    rollup.commit(2, _frame(spark, []))
    assert _totals(rollup) == {("a", None, "t"): (2, 10)}


def test_snapshots_bound_what_is_read(spark):
    rollup = token_counts.TokenRollup(spark, scratch_path(spark, "rollup-many"), snapshot_every=3)
    for batch in range(1, 9):
        rollup.commit(batch, _frame(spark, [("a", "en", "t", 1, batch)]))
        assert len(rollup.folders_read()) <= 3
        assert _totals(rollup) == {("a", "en", "t"): (batch, batch * (batch + 1) // 2)}
    # A batch that snapshots cover is corrected: they are dropped, and the totals follow.
    rollup.commit(2, _frame(spark, [("a", "en", "t", 1, 102)]))
    assert _totals(rollup) == {("a", "en", "t"): (8, 136)}
    rollup.commit(2, _frame(spark, [("a", "en", "t", 1, 102)]))
    assert _totals(rollup) == {("a", "en", "t"): (8, 136)}


def test_token_query_against_brute_force(spark, tmp_path):
    """The query's four commits, with its tokenizers, over awkward documents."""
    rng = random.Random(4)
    texts = [*awkward_texts(), *[prose(rng, 20) for _ in range(6)]]
    texts += texts[-3:]
    folder = str(tmp_path / "docs")
    documents(spark, texts).write.parquet(f"{folder}/documents.parquet")
    found = queries_counts.op3_token_counts(spark, folder).collect()
    encodings = {
        name: tiktoken.Encoding(
            name,
            pat_str=token_counts.PATTERN,
            mergeable_ranks=token_counts.read_ranks(spark, path),
            special_tokens={},
        )
        for name, path in queries_counts.TOKENIZERS.items()
    }
    old, new = encodings
    first, want = {}, {}
    for i, text in enumerate(texts):
        if first.setdefault(text, i) != i:
            continue
        lang, source = ["en", "fr", None][i % 3], [None, "s1", "s2", "s1"][i % 4]
        name = old if lang == "en" else new
        docs, tokens = want.get((source, lang, name), (0, 0))
        size = len(encodings[name].encode_ordinary(text or ""))
        want[source, lang, name] = docs + 1, tokens + size
    assert {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in found} == want
