"""Many keys in many texts: Aho-Corasick automata over blocks of keys.

An automaton reads a text once, however many keys there are. Keys are dealt by hash into blocks
of bounded bytes; a block's keys are broadcast and each task builds the automaton once. Texts
never move. Several blocks are taken one after another, each written before the next, so that
no task holds more than one automaton.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType

from crmflow.storage import materialize

#: Text of the keys of one block; its automaton takes some fifty times as much.
BLOCK_BYTES = 2 << 20


def _finder(shared):
    """A function from texts to the longest key inside each; of equal lengths the smallest, else null."""
    held = []

    # Nested, so that workers need not have this package.
    def longest(texts: pa.Array) -> pa.Array:
        import ahocorasick

        if not held:
            automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
            for key in shared.value:
                automaton.add_word(key)
            automaton.make_automaton()
            held.append(automaton)
        found = []
        for text in texts.to_pylist():
            best, size = None, 0
            for end, length in held[0].iter(text) if text else ():
                if length >= size:
                    key = text[end - length + 1 : end + 1]
                    if length > size or key < best:
                        best, size = key, length
            found.append(best)
        return pa.array(found, pa.string())

    return F.arrow_udf(longest, StringType())


def longest_keys(
    df: DataFrame, field: str, keys: DataFrame, key: str, name: str, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``df`` with ``name``: the longest of ``keys`` inside ``field`` (then the smallest), NULL for none.

    Empty and NULL keys are inside nothing.
    """
    context = df.sparkSession.sparkContext
    named = keys.select(F.col(key).alias("key")).where(F.length(key) > 0).distinct()
    total = named.agg(F.sum(F.octet_length("key")).cast("bigint")).first()[0] or 0
    blocks = -(-total // block_bytes)
    if not blocks:
        return df.withColumn(name, F.lit(None).cast("string"))
    if blocks > 1:
        named = materialize(named, "keys")
    found = df
    for number in range(blocks):
        part = named.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == number) if blocks > 1 else named
        shared = context.broadcast(part.toArrow().column("key").to_pylist())
        inside = _finder(shared)(F.col(field))
        if number:
            found = found.withColumn("_inside", inside)
            longer = F.length("_inside") > F.length(name)
            tied = (F.length("_inside") == F.length(name)) & (F.col("_inside") < F.col(name))
            better = F.col(name).isNull() | longer | tied
            inside = F.when(F.col("_inside").isNotNull() & better, F.col("_inside")).otherwise(F.col(name))
        found = found.withColumn(name, inside).drop("_inside")
        if number < blocks - 1:
            found = materialize(found, "searched")
    return found
