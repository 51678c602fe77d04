"""Spelling variants by permuterm rotations.

A word of which one code point is skipped is written with a terminator and rotated so that the
skipped place is at its end: ``X c Y`` gives the key ``Y$X``, a prefix of its rotation
``Y$Xc``. All words that agree in a key differ from each other by one replacement, and the word
whose whole rotation is the key, ``XY``, by one inserted or deleted code point. Rotations are
sorted by key; a scan of each group gives every member the number of its neighbours and the
most frequent one. A key has a member per letter at most, so groups are bounded by the
alphabet, and what a member yields is one row, not its pairs.

Each pair meets once: a replacement has one place, and of a run of equal letters only the first
may be the inserted one. Keys longer than ``TEXT_KEY`` are replaced by hashes, which are
made for all places of a word from its prefix hashes, so that long words stay linear; equal
64-bit hashes are taken for equal keys and words.

Null texts have no words; a null id is written as nothing in front of the colon.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from crmflow.llm.text import mix
from crmflow.storage import materialize

RUN = r"[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: One word in so many loses a letter, which simulates misspelling.
DROP_ONE_IN = 31
MIN_LENGTH, MIN_COUNT = 7, 2
#: A form is at least this many times as frequent.
FORM_RATIO = 10
#: Keys of more code points are hashed.
TEXT_KEY = 64
#: Bits of a code point below the count in a score.
_POINT_BITS = 21
_BASE = 0x9E3779B97F4A7C15


def word_runs(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_length: int = MIN_LENGTH
) -> DataFrame:
    """Column ``word``: one row per run of letters of ``min_length`` or more after the rule on lost letters."""
    runs = F.regexp_extract_all(docs[text_column], F.lit(f"({RUN}{{{min_length},}})"), F.lit(1))
    found = docs.select(docs[id_column].cast("string").alias("id"), F.explode(runs).alias("run"))
    found = found.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    hashed = F.crc32(F.concat(F.coalesce("id", F.lit("")), F.lit(":"), F.col("run")))
    at = F.pmod(F.col("h"), F.length("run")).cast("int")
    left = F.substring(F.col("run"), F.lit(1), at)
    right = F.substring(F.col("run"), at + 2, F.length("run"))
    word = F.when(F.col("h") % DROP_ONE_IN == 0, F.concat(left, right)).otherwise(F.col("run"))
    return found.withColumn("h", hashed).select(word.alias("word")).filter(F.length("word") >= min_length)


def vocabulary(words: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """Columns word, n and id (a hash of the word) of the words that occur often enough."""
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)
    return counts.select("word", "n", F.xxhash64("word").alias("id"))


def _rotations_in_text(words: DataFrame) -> DataFrame:
    """Rotations of words whose keys are all short enough to be written out."""
    length = F.length("word")
    at = F.col("at")
    left = F.substring(F.col("word"), F.lit(1), at)
    places = words.withColumn("at", F.explode(F.sequence(F.lit(0), length)))
    letter = F.substring(F.col("word"), at + 1, F.lit(1))
    before = F.substring(F.col("word"), at, F.lit(1))
    whole = F.concat(F.substring(F.col("word"), at + 1, length), F.lit("$"), left)
    skipping = F.concat(F.substring(F.col("word"), at + 2, length), F.lit("$"), left)
    kinds = F.array(
        F.struct(whole.alias("key"), F.lit(None).cast("int").alias("letter"), F.lit(False).alias("first")),
        F.when(
            at < length,
            F.struct(
                skipping.alias("key"), F.ascii(letter).alias("letter"), ((at == 0) | (letter != before)).alias("first")
            ),
        ),
    )
    rows = places.select("id", "n", F.explode(F.filter(kinds, lambda k: k.isNotNull())).alias("r"))
    return rows.select("r.key", "r.letter", "r.first", "n", "id")


def _long_keys(points: np.ndarray, skip: bool) -> list[str]:
    """The keys of all rotations of a long word: with a letter skipped, or whole."""
    length = len(points)
    values = mix(points.astype(np.uint64))
    powers = np.full(length + 2, _BASE, np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    # Polynomials with the first letter as the highest: H(uv) = H(u) * B^|v| + H(v).
    prefix = np.zeros(length + 1, np.uint64)
    total = 0
    for i, value in enumerate(values.tolist()):
        total = (total * _BASE + value) & ((1 << 64) - 1)
        prefix[i + 1] = total
    starts = np.arange(length if skip else length + 1)
    tails = starts + 1 if skip else starts
    right = prefix[length] - prefix[tails] * powers[length - tails]
    mark = mix(np.array([36], np.uint64))[0]
    whole = (right * np.uint64(_BASE) + mark) * powers[starts] + prefix[starts]
    size = length if skip else length + 1
    return [f"#{size}:{value:016x}" for value in mix(whole).tolist()]


def _rotations_hashed(words: DataFrame) -> DataFrame:
    """Rotations of long words; keys that short partners have too are written out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for word, n, name in zip(*(batch.column(i).to_pylist() for i in range(3))):
                points = np.frombuffer(word.encode("utf-32-le"), np.uint32)
                length = len(points)
                if length > TEXT_KEY:
                    skipping = _long_keys(points, True)
                else:
                    skipping = [f"{word[i + 1 :]}${word[:i]}" for i in range(length)]
                whole = _long_keys(points, False)
                first = np.append(True, points[1:] != points[:-1])
                count = len(skipping) + len(whole)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(skipping + whole),
                        pa.array(points.tolist() + [None] * len(whole), pa.int32()),
                        pa.array(np.append(first, np.zeros(len(whole), bool))),
                        pa.array(np.full(count, n)),
                        pa.array(np.full(count, name)),
                    ],
                    ["key", "letter", "first", "n", "id"],
                )

    return words.select("word", "n", "id").mapInArrow(run, "key string, letter int, first boolean, n bigint, id bigint")


def rotations(words: DataFrame) -> DataFrame:
    """Rows (key, letter, first, n, id): rotations that skip a letter, and whole ones without letter."""
    short = F.length("word") < TEXT_KEY
    return _rotations_in_text(words.filter(short)).unionAll(_rotations_hashed(words.filter(~short)))


def scan_groups(rows: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """Rows (id, near, form_n, form_id): what a word meets under one key.

    ``form_n`` and ``form_id`` tell of the most frequent neighbour under the key, where it is
    ``ratio`` times as frequent. Members that meet nobody have no row.
    """
    # Of one key, words are in the order of the letter, so a score settles ties of counts.
    point = F.lit((1 << _POINT_BITS) - 1) - F.col("letter")
    score = F.when(F.col("letter").isNotNull(), F.col("n") * F.lit(1 << _POINT_BITS) + point)
    rows = rows.withColumn("score", score)
    group = Window.partitionBy("key").orderBy(F.col("score").desc_nulls_last())
    every = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    member = F.struct("score", "n", "id")
    seen = rows.select(
        "id",
        "n",
        "letter",
        "first",
        F.count("letter").over(every).alias("skipping"),
        F.count(F.when(F.col("first"), 1)).over(every).alias("firsts"),
        F.max(F.when(F.col("letter").isNull(), F.struct("n", "id"))).over(every).alias("whole"),
        F.max(F.when(F.col("first"), member)).over(every).alias("best_first"),
        F.first(F.when(F.col("letter").isNotNull(), member)).over(every).alias("best"),
        F.lead(F.when(F.col("letter").isNotNull(), member)).over(group).alias("next"),
    )
    is_whole = F.col("letter").isNull()
    meets = F.col("first") & F.col("whole").isNotNull()
    near = F.when(is_whole, F.col("firsts")).otherwise(F.col("skipping") - 1 + meets.cast("int"))
    other = F.when(F.col("best.id") == F.col("id"), F.col("next")).otherwise(F.col("best"))
    alike = F.when(is_whole, F.col("best_first")).otherwise(other)
    joined = F.when(~is_whole & meets, F.col("whole"))
    found = seen.select("id", "n", near.cast("bigint").alias("near"), alike.alias("alike"), joined.alias("joined"))
    found = found.filter(F.col("near") > 0)
    # Up to two candidates: one of equal length and one of another length.
    candidates = F.array(
        F.struct(F.col("alike.n").alias("n"), F.col("alike.id").alias("id")),
        F.struct(F.col("joined.n").alias("n"), F.col("joined.id").alias("id")),
    )
    return found.select(
        "id", "near", F.filter(candidates, lambda c: c["n"] >= F.col("n") * ratio).alias("forms")
    )


def spelling_forms(words: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """Per row of ``words`` (word, n, id): word, n, n_near, form, form_n and root.

    A word's form is its most frequent neighbour (ties: the first in code-point order), where
    that is ``ratio`` times as frequent; the root is reached by following forms.
    """
    met = materialize(scan_groups(rotations(words), ratio), "spelling-met")
    near = met.groupBy("id").agg(F.sum("near").alias("n_near"))
    offers = met.select("id", F.explode("forms").alias("offer")).select("id", "offer.n", F.col("offer.id").alias("form_id"))
    offers = materialize(offers, "spelling-offers")
    most = offers.groupBy(F.col("id").alias("of")).agg(F.max("n").alias("form_n"))
    ties = offers.join(most, (F.col("id") == F.col("of")) & (F.col("n") == F.col("form_n")))
    named = words.select(F.col("id").alias("form_id"), F.col("word").alias("form"))
    forms = (
        ties.select("id", "form_id", "form_n")
        .join(named, "form_id")
        .groupBy("id")
        .agg(F.min(F.struct("form", "form_id")).alias("f"), F.max("form_n").alias("form_n"))
        .select("id", "f.form", "f.form_id", "form_n")
    )
    forms = materialize(forms, "spelling-forms")
    roots = follow(forms.select("id", F.col("form_id").alias("root_id")))
    top = words.select(F.col("id").alias("root_id"), F.col("word").alias("root"))
    roots = roots.join(top, "root_id").select("id", "root")
    return (
        words.join(near, "id", "left")
        .join(forms.select("id", "form", "form_n"), "id", "left")
        .join(roots, "id", "left")
        .select(
            "word",
            "form",
            F.coalesce("root", "word").alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
            "form_n",
        )
    )


def follow(steps: DataFrame) -> DataFrame:
    """Rows (id, root_id) moved on to the last id of their chain; steps double each round.

    Counts rise by a factor with each step, so a chain has a logarithm of the largest count.
    """
    while True:
        onward = steps.select(F.col("id").alias("root_id"), F.col("root_id").alias("next"))
        moved = steps.join(onward, "root_id", "left")
        moved = materialize(moved.select("id", "root_id", "next"), "spelling-roots")
        steps = moved.select("id", F.coalesce("next", "root_id").alias("root_id"))
        if not moved.filter("next IS NOT NULL").limit(1).count():
            return steps
