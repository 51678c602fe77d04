"""URL rules, and exact membership of keys in a list by a cascade of Bloom filters.

The cascade is built over the complete universe of the corpus's distinct keys. Level 0
holds the listed keys, level 1 the keys of the rest that level 0 wrongly accepts, level 2 the
listed keys that level 1 wrongly accepts, and so on until a level accepts no wrong key. For
every key of the universe the first level that rejects it tells whether it is listed.

Keys are two 64-bit hashes, dealt to shards of bounded size; a shard is built in one task
from its distinct keys. The finished levels are broadcast in blocks of bounded bytes, each
applied in its own pass, so a list of any size needs no join and no larger broadcast.

A null url, or one without ``://``, has an empty host and path, which is a key like others.
Repeated rows get equal verdicts; an empty list gives no levels and lists nothing. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from crmflow.llm.text import mix
from crmflow.llm.workers import block_by_block
from crmflow.storage import materialize

#: Rules as (verdict, host, path). Fixed values of the query's contract.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
SHARD_KEYS = 500_000
BITS_PER_KEY = 10
PROBES = 5
BLOCK_BYTES = 32 << 20

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 2)


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct of verdict and rule of the longest rule that fits, null if none does."""
    found = F.lit(None)
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = (host == rule_host) | host.endswith("." + rule_host)
        rule = F.struct(F.lit(verdict).alias("verdict"), F.lit(rule_host + rule_path).alias("rule"))
        found = F.when(fits & path.startswith(rule_path), rule).otherwise(found)
    return found


def _probes(one: np.ndarray, two: np.ndarray, level: int) -> Iterator[np.ndarray]:
    """The hash functions of a level."""
    seed = mix(np.array([level], np.uint64))[0]
    first, step = mix(one ^ seed), mix(two + seed) | np.uint64(1)
    for i in range(PROBES):
        yield first + np.uint64(i) * step


def _accepts(bits: np.ndarray, one: np.ndarray, two: np.ndarray, level: int) -> np.ndarray:
    accepted = np.ones(len(one), bool)
    for probe in _probes(one, two, level):
        at = probe % np.uint64(8 * len(bits))
        accepted &= (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return accepted


def build_levels(one: np.ndarray, two: np.ndarray, listed: np.ndarray) -> list[np.ndarray]:
    """The bit arrays of all levels for a universe of distinct keys."""
    inside, outside = np.flatnonzero(listed), np.flatnonzero(~listed)
    levels: list[np.ndarray] = []
    while len(inside):
        bits = np.zeros(max(8, -(-len(inside) * BITS_PER_KEY // 8)), np.uint8)
        for probe in _probes(one[inside], two[inside], len(levels)):
            at = probe % np.uint64(8 * len(bits))
            np.bitwise_or.at(bits, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
        wrong = outside[_accepts(bits, one[outside], two[outside], len(levels))]
        levels.append(bits)
        inside, outside = wrong, inside
    return levels


class Cascade:
    """Levels of some shards, laid end to end so that a whole batch is probed at once."""

    def __init__(self, rows: Sequence, shards: int):
        self.shards = shards
        self.levels = []
        self.depth = np.full(shards, -1, np.int64)  # -1: the shard is in another block
        for row in rows:
            self.depth[row["shard"]] = max(self.depth[row["shard"]], row["level"] + 1)
        for level in range(max((row["level"] + 1 for row in rows), default=0)):
            own = [row for row in rows if row["level"] == level]
            offset, size = np.zeros(shards, np.int64), np.ones(shards, np.int64)
            cuts = np.cumsum([0] + [len(row["bits"]) for row in own])
            for row, cut in zip(own, cuts):
                offset[row["shard"]], size[row["shard"]] = cut, 8 * len(row["bits"])
            bits = np.frombuffer(b"".join(bytes(row["bits"]) for row in own), np.uint8)
            self.levels.append((offset, size, bits))

    def listed(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Is each key listed? False for keys of shards in other blocks."""
        shard = (two >> np.uint64(33)).astype(np.int64) % self.shards
        depth = self.depth[shard]
        answer = np.zeros(len(one), bool)
        alive = np.flatnonzero(depth > 0)
        for level, (offset, size, bits) in enumerate(self.levels):
            accepted = np.ones(len(alive), bool)
            own = shard[alive]
            for probe in _probes(one[alive], two[alive], level):
                at = (probe % size[own].astype(np.uint64)).astype(np.int64)
                accepted &= (bits[offset[own] + (at >> 3)] >> (at & 7).astype(np.uint8)) & 1 == 1
            answer[alive[~accepted]] = level % 2 == 1
            alive = alive[accepted]
            ended = depth[alive] == level + 1
            answer[alive[ended]] = level % 2 == 0
            alive = alive[~ended]
        return answer


def _key_hashes(key: Sequence[Column]) -> list[Column]:
    return [
        F.xxhash64(*key).alias("one"),
        F.xxhash64(F.lit("second hash"), *key).alias("two"),
    ]


def build_cascade(keys: DataFrame, shard_keys: int = SHARD_KEYS, block_bytes: int = BLOCK_BYTES) -> list:
    """Broadcast blocks of a cascade over all rows of ``keys`` (one, two, listed); a key is listed if any row is."""
    spark = keys.sparkSession
    universe = materialize(keys.groupBy("one", "two").agg(F.max("listed").alias("listed")), "universe")
    shards = max(1, -(-universe.count() // shard_keys))

    def levels(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["one", "two"])
        one, two = (part[c].to_numpy().view(np.uint64) for c in ("one", "two"))
        built = build_levels(one, two, part["listed"].to_numpy(bool))
        shard = int(part["shard"].iloc[0])
        return pd.DataFrame(
            {"shard": shard, "level": range(len(built)), "bits": [b.tobytes() for b in built]}
        )

    shard = F.pmod(F.shiftrightunsigned("two", 33), F.lit(shards))
    built = materialize(
        universe.withColumn("shard", shard)
        .groupBy("shard")
        .applyInPandas(levels, "shard bigint, level bigint, bits binary"),
        "cascade",
    )
    total = built.agg(F.sum(F.octet_length("bits"))).first()[0] or 0
    blocks = -(-total // block_bytes)
    found = []
    for block in range(blocks):
        rows = built.filter(F.pmod("shard", F.lit(blocks)) == block).collect()
        if rows:
            found.append(spark.sparkContext.broadcast(Cascade(rows, shards)))
    return found


def mark_listed(rows: DataFrame, key: Sequence[str], blocks: Sequence, flag: str = "listed") -> DataFrame:
    """``rows`` with a flag column: is the key of the row in the cascade's list?"""
    if flag in rows.columns:
        raise ValueError(f"the rows have a column {flag!r} already")
    names = rows.columns
    hashed = rows.select(*rows.columns, *_key_hashes([rows[k] for k in key]), F.lit(False).alias(flag))

    def one_pass(rows: DataFrame, block) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                one, two = (
                    batch.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in (-3, -2)
                )
                before = batch.column(-1).to_numpy(zero_copy_only=False)
                columns = [*batch.columns[:-1], pa.array(before | block.value.listed(one, two))]
                yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

        return rows.mapInArrow(run, hashed.schema)

    return block_by_block(hashed, blocks, one_pass, "marked").select(*names, flag)


def judge_urls(
    pages: DataFrame,
    listed: Column,
    id_column: str = "page_id",
    url_column: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES,
    **options,
) -> DataFrame:
    """One row per page: its id, host, path, rule and verdict.

    The longest fitting rule decides; without one, a page is blocked if any page of the same
    host and path meets the condition ``listed``. ``options`` go to ``build_cascade``.
    """
    url = pages[url_column]
    parts = [host_of(url).alias("host"), path_of(url).alias("path")]
    keys = pages.select(*parts, F.coalesce(listed, F.lit(False)).alias("listed"))
    keys = keys.select(*_key_hashes([keys["host"], keys["path"]]), "listed")
    blocks = build_cascade(keys, **options)
    rows = mark_listed(pages.select(pages[id_column], *parts), ["host", "path"], blocks)
    found = rows.withColumn("found", matching_rule(F.col("host"), F.col("path"), rules))
    return found.select(
        id_column,
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"),
    )
