"""Spelling variants and Merkle proofs against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from crmflow.llm import merkle, spelling
from crmflow.llm.queries_words import op12_spelling_variants, op13_merkle_manifest
from tests.llm.frames import awkward_texts, documents


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def vocabulary(rows, min_length=7, min_count=2):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = fold(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= min_length
    return {w: n for w, n in counts.items() if n >= min_count}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def variants(words):
    partners = {w: [v for v in words if near(w, v)] for w in words}
    forms = {}
    for word, others in partners.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= 10 * words[word]:
            forms[word] = best
    rows = set()
    for word in words:
        root = word
        while root in forms:
            root = forms[root]
        form = forms.get(word)
        rows.add((word, form, root, words[word], len(partners[word]), words.get(form)))
    return rows


def found_variants(spark, words):
    rows = spark.createDataFrame([(w, n) for w, n in words.items()] or [("", 0)], "word string, n bigint")
    rows = rows.filter("n > 0").select("word", "n", F.xxhash64("word").alias("id"))
    found = spelling.spelling_forms(rows).select("word", "form", "root", "n", "n_near", "form_n")
    return [tuple(r) for r in found.collect()]


def crafted_words():
    rng = random.Random(3)
    words = {}
    for stem in ["aaaaaaa", "abababab", "zebrafish", "éàéàéàé", "ÿ" * 7, "ab" * 31 + "a", "ab" * 32, "q" * 64, "q" * 66]:
        words[stem] = rng.choice([1, 10, 100, 1000])
        for _ in range(12):
            at, letter = rng.randrange(len(stem) + 1), rng.choice("abzqéÿ")
            kind = rng.randrange(3)
            changed = stem[:at] + (letter if kind else "") + stem[at + (kind != 1) :]
            words.setdefault(changed, rng.choice([1, 2, 9, 10, 11, 100, 1000]))
    # A chain of forms, ties by word, and long words one letter apart.
    words |= {"chainaaa": 1, "chainaab": 10, "chainabb": 100, "chainbbb": 1000, "chainbbbb": 10_000}
    words |= {"tiedwordx": 1, "tiedwordb": 50, "tiedworda": 50, "tiedword": 50}
    long = "".join(rng.choice("abcé") for _ in range(3000))
    words |= {long: 5, long[:1500] + long[1501:]: 70, long[:700] + "z" + long[701:]: 700, long + "z": 1}
    return words


def test_neighbours_and_forms_by_brute_force(spark):
    words = crafted_words()
    found = found_variants(spark, words)
    assert len(found) == len(words)
    assert set(found) == variants(words)


def test_no_words(spark):
    assert found_variants(spark, {}) == []


def test_long_word_yields_rows_in_proportion(spark):
    word = "x" * 50_000 + "y" * 50_000
    rows = spark.createDataFrame([(word, 2)], "word string, n bigint").withColumn("id", F.xxhash64("word"))
    found = spelling.rotations(rows).agg(F.count(F.lit(1)), F.max(F.length("key"))).first()
    assert found[0] == 2 * len(word) + 1 and found[1] < 40


def test_words_of_awkward_texts(spark):
    rng = random.Random(4)
    stems = ["spelling", "Spelled", "VARIANT", "ÀÉÎÕÜàé", "permuter", "rotated", "a1b2c3d"]
    texts = awkward_texts() + [" ".join(rng.choice(stems) for _ in range(400)) for _ in range(30)] + ["x" * 50_000]
    ids = [None if i % 7 == 3 else i // 2 for i in range(len(texts))]
    table = documents(spark, texts, ids)
    words = spelling.vocabulary(spelling.word_runs(table))
    want = vocabulary(zip(ids, texts))
    assert {r.word: r.n for r in words.collect()} == want
    assert {tuple(r) for r in spelling.spelling_forms(words).collect()} == variants(want)


def test_the_given_documents(spark, small):
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    found = op12_spelling_variants(spark, small).select("word", "form", "root", "n", "n_near", "form_n").collect()
    want = vocabulary(rows)
    assert {r.word: r.n for r in found} == want
    forms = {r.word: r.form for r in found if r.form}
    for row in rng_sample(found):
        others = [v for v in want if near(row.word, v)]
        assert row.n_near == len(others)
        best = min(others, key=lambda v: (-want[v], v), default=None)
        assert row.form == (best if best is not None and want[best] >= 10 * row.n else None)
        root = row.word
        while root in forms:
            root = forms[root]
        assert row.root == root


def rng_sample(rows):
    return random.Random(5).sample(rows, min(40, len(rows)))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climb(nodes, at, fanout):
    """Levels of (before, after) above one node, and the last node."""
    steps = []
    while len(nodes) > 1:
        low = at - at % fanout
        steps.append(("".join(nodes[low:at]), "".join(nodes[at + 1 : low + fanout])))
        nodes = [sha("".join(nodes[i : i + fanout])) for i in range(0, len(nodes), fanout)]
        at //= fanout
    return steps, nodes[0]


def proofs(rows, fanout=8):
    """Rows (order, leaf, subroot, root, proof, folded, verified) for rows (group, order, leaf, presented)."""
    null_first = lambda v: (v is not None, v.encode() if isinstance(v, str) else v or 0)
    groups = {}
    for row in rows:
        groups.setdefault(row[0], []).append(row)
    names = sorted(groups, key=null_first)
    for own in groups.values():
        own.sort(key=lambda r: (null_first(r[1]), r[2]))
    subroots = [climb([r[2] for r in groups[g]], 0, fanout)[1] for g in names]
    result = []
    for number, name in enumerate(names):
        upper, root = climb(subroots, number, fanout)
        for at, (_, order, leaf, shown) in enumerate(groups[name]):
            steps, subroot = climb([r[2] for r in groups[name]], at, fanout)
            folded, text = shown, ""
            for before, after in steps + upper:
                folded, text = sha(before + folded + after), text + before + after
            result.append((order, leaf, subroot, root, sha(text), folded, folded == root))
    return sorted(result, key=repr)


@pytest.mark.parametrize("fanout,block_levels", [(8, 3), (8, 0), (2, 1), (3, 0), (2, 2)])
def test_proofs_by_brute_force(spark, fanout, block_levels):
    rng = random.Random(fanout * 10 + block_levels)
    rows = []
    for group in [None, "", "a", "b", "c", "é", "z", "zz", "zzz", "zzzz", "語"]:
        for i in range(rng.choice([1, 2, 7, 8, 9, 17, 33, 64, 65, 90])):
            order = rng.choice([None, i, i, i, 5])
            leaf = sha(f"{group}{i % 6 if rng.random() < 0.2 else i}")
            rows.append((group, order, leaf, leaf if leaf[0] < "b" else sha("other" + leaf)))
    table = spark.createDataFrame(rows, "lang string, doc_id bigint, leaf string, shown string")
    table = table.select("*", *[F.lit(1).alias(c) for c in ("tree", "block", "order", "group", "digest")])
    found = merkle.manifest(table, table["leaf"], table["shown"], fanout=fanout, block_levels=block_levels)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == proofs(rows, fanout)


def test_proofs_of_no_rows(spark):
    table = spark.createDataFrame([], "lang string, doc_id bigint, leaf string")
    assert merkle.manifest(table, table["leaf"]).collect() == []


def test_manifest_of_awkward_texts(spark, tmp_path):
    texts = awkward_texts() * 3
    ids = [None if i % 9 == 4 else i // 2 for i in range(len(texts))]
    documents(spark, texts, ids).write.parquet(f"{tmp_path}/documents.parquet")
    rows = []
    for r in spark.read.parquet(f"{tmp_path}/documents.parquet").collect():
        head = field(r.doc_id) + field(r.source) + field(r.lang) + field(r.n_chars)
        leaf = sha(head + field(r.text))
        tampered = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0
        shown = sha(head + field(fold(r.text) if r.text is not None else None)) if tampered else leaf
        rows.append((r.lang, r.doc_id, leaf, shown))
    found = op13_merkle_manifest(spark, str(tmp_path))
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == proofs(rows)


def test_meetings_stay_small(spark):
    """However the blocks are spread over groups, no meeting has more members than the fanout."""
    rows = [("big", i, sha(str(i)), sha(str(i))) for i in range(700)] + [
        (f"g{i}", 0, sha(f"g{i}"), sha(f"g{i}")) for i in range(20)
    ]
    table = spark.createDataFrame(rows, "lang string, doc_id bigint, leaf string, shown string")
    seen = []
    swap = merkle._swap

    def watched(messages, keys):
        seen.append(messages.groupBy(*keys).count().agg(F.max("count")).first()[0])
        return swap(messages, keys)

    merkle._swap = watched
    try:
        found = merkle.manifest(table, table["leaf"], block_levels=0)
        assert sorted((tuple(r) for r in found.collect()), key=repr) == proofs(rows)
    finally:
        merkle._swap = swap
    assert len(seen) == 6 and max(seen) <= merkle.FANOUT
