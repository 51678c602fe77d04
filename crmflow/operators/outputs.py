"""Operators with several outputs, computed once: rows are written with a flag, outputs read by it.

A plan that derives each output from the input computes the input once per output. Here one
job writes every row under the output it belongs to and counts them on the way; an output is
then a scan of its own folder. The owner of the outputs removes them (``remove``, or a ``with``
block) when they are no longer needed.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from crmflow.operators.joins import KeyPair, join_tables, key_pairs
from crmflow.operators.ordering import OrderKey, number_rows, row_hash
from crmflow.operators.skew import DEFAULT_POLICY, SkewPolicy
from crmflow.storage import remove_folder, scratch_path

#: Rows whose key is NULL are spread over this many values of a salt.
_NULL_SALTS = 4096


def _free_name(name: str, taken: Sequence[str]) -> str:
    """``name``, lengthened until no column is called so."""
    used = {c.lower() for c in taken}
    while name in used:
        name += "_"
    return name


class StoredOutputs(Mapping[str, DataFrame]):
    """The outputs of one written table by name, and how many rows each has.

    ``names`` are the outputs; ``output`` gives for each row the name of its own, and rows
    where it is NULL belong to none. An output without rows is an empty frame. ``columns`` are
    those to keep, so that ``output`` may rest on others.
    """

    def __init__(
        self,
        df: DataFrame,
        output: Column,
        names: Sequence[str],
        label: str = "outputs",
        columns: Sequence[str] | None = None,
    ) -> None:
        self.names = list(names)
        self._spark = df.sparkSession
        self._columns = df.columns if columns is None else list(columns)
        self._flag = _free_name("_output", self._columns)
        kept = [df.schema[c] for c in self._columns]
        self._schema = T.StructType([*kept, T.StructField(self._flag, T.StringType())])
        self.path = scratch_path(self._spark, label)
        seen = Observation()
        flag = F.col(self._flag)
        flagged = df.select(*self._columns, output.alias(self._flag)).where(flag.isin(self.names))
        counts = [F.count_if(flag == name).alias(f"n{i}") for i, name in enumerate(self.names)]
        flagged.observe(seen, *counts).write.partitionBy(self._flag).parquet(self.path)
        self.rows = {name: seen.get[f"n{i}"] for i, name in enumerate(self.names)}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.names:
            raise KeyError(name)
        stored = self._spark.read.schema(self._schema).parquet(self.path)
        return stored.where(F.col(self._flag) == name).select(*self._columns)

    def __iter__(self) -> Iterator[str]:
        return iter(self.names)

    def __len__(self) -> int:
        return len(self.names)

    def remove(self) -> None:
        """Delete the stored rows; frames read from them can no longer run."""
        remove_folder(self._spark, self.path)

    def __enter__(self):
        return self

    def __exit__(self, *_: object) -> None:
        self.remove()


def filter_outputs(df: DataFrame, condition: Column | str, null_as_false: bool = False) -> StoredOutputs:
    """``true``, ``false`` and ``null`` rows of a condition, which is evaluated once per row.

    With ``null_as_false`` the third output is empty and its rows are in the second.
    """
    test = F.expr(condition) if isinstance(condition, str) else condition
    unknown = "false" if null_as_false else "null"
    output = F.when(test, "true").when(~test, "false").otherwise(unknown)
    return StoredOutputs(df, output, ["true", "false", "null"], "filtered")


def unique_outputs(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[OrderKey] = (),
    policy: SkewPolicy = DEFAULT_POLICY,
) -> StoredOutputs:
    """``unique``, the first row of each key, and ``duplicate``, all others, from one numbering."""
    number = _free_name("_row", df.columns)
    numbered = number_rows(df, keys, order_by, number, policy)
    output = F.when(F.col(number) == 1, "unique").otherwise("duplicate")
    return StoredOutputs(numbered, output, ["unique", "duplicate"], "unique", df.columns)


class JoinOutputs:
    """Matched pairs and unmatched rows of both sides, with each input computed once.

    The left rows are written as they are. Their distinct keys flag the right rows, which are
    written by flag; the distinct keys of the matched right rows then flag the left ones. The
    second step is only done when ``left_only`` or ``rows`` is asked for, and pairs are joined when
    they are read, from matched right rows alone. No probe looks for hot keys: the sides
    that carry rows meet stored distinct keys, a shape that adaptive execution splits at a
    hot key, and rows with a NULL key, which match nothing, are dealt by their content.
    """

    def __init__(
        self,
        left: DataFrame,
        right: DataFrame,
        keys: Sequence[KeyPair],
        select: Mapping[str, str | None] | None = None,
        prefix: str = "Right_",
        policy: SkewPolicy = DEFAULT_POLICY,
    ) -> None:
        self._keys, self._select, self._prefix, self._policy = key_pairs(keys), select, prefix, policy
        self._left = StoredOutputs(left, F.lit("all"), ["all"], "left")
        left_keys = self._distinct(self._left["all"], [l for l, _ in self._keys])
        self._right = _flag_by_keys(right, [r for _, r in self._keys], left_keys["all"])
        left_keys.remove()

    @staticmethod
    def _distinct(df: DataFrame, names: Sequence[str]) -> StoredOutputs:
        set_keys = reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])
        found = df.where(set_keys).select(*[F.col(n).alias(f"_k{i}") for i, n in enumerate(names)]).distinct()
        return StoredOutputs(found, F.lit("all"), ["all"], "keys")

    @cached_property
    def _left_flagged(self) -> StoredOutputs:
        matched_keys = self._distinct(self._right["matched"], [r for _, r in self._keys])
        flagged = _flag_by_keys(self._left["all"], [l for l, _ in self._keys], matched_keys["all"])
        matched_keys.remove()
        return flagged

    @property
    def matched(self) -> DataFrame:
        """Pairs of rows with equal keys, with columns as in ``join_tables``."""
        known = "_left_flagged" in self.__dict__
        left = self._left_flagged["matched"] if known else self._left["all"]
        return join_tables(
            left, self._right["matched"], self._keys, "inner", self._select, self._prefix, self._policy
        )

    @property
    def left_only(self) -> DataFrame:
        return self._left_flagged["unmatched"]

    @property
    def right_only(self) -> DataFrame:
        return self._right["unmatched"]

    @property
    def rows(self) -> dict[str, int]:
        """Rows of each side with and without a match, counted while they were written."""
        left, right = self._left_flagged.rows, self._right.rows
        return {
            "left_matched": left["matched"],
            "left_only": left["unmatched"],
            "right_matched": right["matched"],
            "right_only": right["unmatched"],
        }

    def remove(self) -> None:
        """Delete the stored rows."""
        self._left.remove()
        self._right.remove()
        if "_left_flagged" in self.__dict__:
            self._left_flagged.remove()

    def __enter__(self):
        return self

    def __exit__(self, *_: object) -> None:
        self.remove()


def _marked(df: DataFrame, names: Sequence[str], keys: DataFrame, hit: str) -> DataFrame:
    """The rows with a column that is true where their keys are among the distinct ``keys``, else NULL."""
    salt = _free_name("_salt", df.columns)
    unset = reduce(lambda a, b: a | b, [F.col(n).isNull() for n in names])
    dealt = F.pmod(row_hash(df), F.lit(_NULL_SALTS))
    rows = df.withColumn(salt, F.when(unset, dealt).otherwise(F.lit(-1).cast("bigint")))
    marks = keys.select("*", F.lit(-1).cast("bigint").alias("_k_salt"), F.lit(True).alias(hit))
    on = [rows[n] == marks[f"_k{i}"] for i, n in enumerate(names)]
    joined = rows.join(marks, [*on, rows[salt] == marks["_k_salt"]], "left")
    return joined.select(*[rows[c] for c in df.columns], marks[hit])


def _flag_by_keys(df: DataFrame, names: Sequence[str], keys: DataFrame) -> StoredOutputs:
    """Outputs ``matched`` and ``unmatched``: whether a row's keys are among distinct ``keys``."""
    hit = _free_name("_hit", df.columns)
    output = F.when(F.col(hit), "matched").otherwise("unmatched")
    return StoredOutputs(_marked(df, names, keys, hit), output, ["matched", "unmatched"], "side", df.columns)
