"""Token totals by source, language and tokenizer version, maintained by signed deltas.

A batch is a frame of signed changes: an inserted document adds its tokens, a deleted one
takes them away, a revised count takes the old one away and adds the new. A commit sums the
batch and replaces the folder of its batch number, so committing a batch again, after a
failure or by mistake, changes nothing, and a corrected batch, even one that is now empty,
replaces the old one. Totals are kept in snapshots: the sum over all batches up to a number.
They are read as the last snapshot plus the batches behind it, whose number is bounded.

One writer commits at a time. A null text has no tokens. Null sources and languages are groups of
their own. Repeated rows count each time. An empty batch changes nothing, and without batches, or
without the folder, there are no totals. Other columns of the changes are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from crmflow.storage import complete_folders, remove_folder

#: Pattern that cuts a text before the merges. Fixed value that goes with the vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
KEYS = ("source", "lang", "tokenizer")
DELTAS = "source string, lang string, tokenizer string, docs bigint, tokens bigint"
#: Batches after which the totals become a snapshot.
SNAPSHOT_EVERY = 16


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """A vocabulary of merge ranks; the file is of fixed size and goes to all tasks."""
    rows = spark.read.text(path).collect()
    return {base64.b64decode(a): int(b) for a, b in (row[0].split() for row in rows if row[0].strip())}


@cache
def _encoding(name: str, ranks) -> tiktoken.Encoding:
    return tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks.value, special_tokens={})


def count_tokens(
    docs: DataFrame,
    tokenizers: dict[str, str],
    text_column: str = "text",
    keep: tuple[str, ...] = ("doc_id", "source", "lang"),
) -> DataFrame:
    """The columns ``keep`` of each row, and the tokens of its text by each tokenizer (name -> path)."""
    spark = docs.sparkSession
    shared = {name: spark.sparkContext.broadcast(read_ranks(spark, path)) for name, path in tokenizers.items()}
    rows = docs.select(*[docs[c] for c in keep], docs[text_column].alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encodings = [_encoding(name, ranks) for name, ranks in shared.items()]
        for batch in batches:
            counts: list[list[int]] = [[] for _ in encodings]
            for text in batch.column(batch.num_columns - 1):
                value = text.as_py() or ""
                for encoding, own in zip(encodings, counts):
                    own.append(len(encoding.encode_ordinary(value)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *[pa.array(own, pa.int64()) for own in counts]],
                [*batch.schema.names[:-1], *shared],
            )

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return rows.mapInArrow(run, ", ".join([*kept, *[f"`{name}` bigint" for name in shared]]))


def change(rows: DataFrame, sign: int, tokenizer: str, tokens: Column) -> DataFrame:
    """Signed changes of one document per row: +1 inserts, -1 deletes."""
    return rows.select(
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        F.lit(tokenizer).alias("tokenizer"),
        F.lit(sign).cast("bigint").alias("docs"),
        (F.lit(sign) * tokens).cast("bigint").alias("tokens"),
    )


class TokenRollup:
    """Totals at ``path``: a folder of summed changes per batch, and snapshots of the totals.

    Every ``snapshot_every`` batches the totals so far become a snapshot; the last two stay, so
    that a reader of the one before goes on. Batches stay, too: committing one that a snapshot
    covers drops that snapshot, and the next one is built again from what is left.
    """

    def __init__(self, spark: SparkSession, path: str, snapshot_every: int = SNAPSHOT_EVERY):
        self.spark, self.path, self.snapshot_every = spark, path, snapshot_every

    def commit(self, batch: int, changes: DataFrame) -> None:
        """Sums the changes and makes them the content of the batch; again is the same as once."""
        for number in self._numbers("snapshots"):
            if number >= batch:
                remove_folder(self.spark, self._folder("snapshots", number))
        _summed(changes).write.mode("overwrite").parquet(self._folder("batches", batch))
        if len(self._open()) >= self.snapshot_every:
            self.compact()

    def compact(self) -> None:
        """Write the totals of all batches as a snapshot."""
        opened = self._open()
        if not opened:
            return
        self._sums().write.mode("overwrite").parquet(self._folder("snapshots", opened[-1]))
        for number in self._numbers("snapshots")[:-2]:
            remove_folder(self.spark, self._folder("snapshots", number))

    def totals(self) -> DataFrame:
        """Documents and tokens per source, language and tokenizer; groups without documents are left out."""
        return self._sums().filter("docs <> 0 OR tokens <> 0")

    def folders_read(self) -> list[str]:
        """Folders that hold the totals now: the last snapshot and the batches behind it."""
        snapshot = [self._folder("snapshots", n) for n in self._numbers("snapshots")[-1:]]
        return snapshot + [self._folder("batches", n) for n in self._open()]

    def _sums(self) -> DataFrame:
        folders = self.folders_read()
        if not folders:
            return self.spark.createDataFrame([], DELTAS)
        return _summed(self.spark.read.schema(DELTAS).parquet(*folders))

    def _folder(self, kind: str, number: int) -> str:
        return f"{self.path}/{kind}/{number}"

    def _numbers(self, kind: str) -> list[int]:
        return sorted(int(name) for name in complete_folders(self.spark, f"{self.path}/{kind}"))

    def _open(self) -> list[int]:
        """Batches behind the last snapshot."""
        closed = self._numbers("snapshots")[-1:]
        return [n for n in self._numbers("batches") if not closed or n > closed[0]]


def _summed(changes: DataFrame) -> DataFrame:
    return changes.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
