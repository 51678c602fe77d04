"""Sort keys, and positions in a global order without a single-task window.

The plain window is used wherever no group is too large for one task. Otherwise
rows are range-partitioned on (group, order), which splits a hot group over many
tasks, and written once; the written table freezes the chosen ranges. Positions
then come from the place inside a part plus the rows of the parts before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from crmflow.operators.skew import (
    DEFAULT_POLICY,
    SkewPolicy,
    hot_groups,
    null_safe_match,
    split_hot,
)
from crmflow.storage import materialize

OrderKey = str | tuple[str, str]

# monotonically_increasing_id keeps the partition number above this bit and the
# place inside the partition below it.
_PLACE_BITS = 33
_PLACE_MASK = (1 << _PLACE_BITS) - 1
_COPIES_PER_CHUNK = 1_000_000


def order_columns(order_by: Sequence[OrderKey]) -> list[Column]:
    """Sort columns from names or ``(name, "asc"|"desc")``; NULLs first on asc, last on desc."""
    columns = []
    for key in order_by:
        name, direction = (key, "asc") if isinstance(key, str) else key
        if direction == "asc":
            columns.append(F.col(name).asc_nulls_first())
        elif direction == "desc":
            columns.append(F.col(name).desc_nulls_last())
        else:
            raise ValueError(f"sort direction must be asc or desc, not {direction!r}")
    return columns


def order_names(order_by: Sequence[OrderKey]) -> list[str]:
    return [key if isinstance(key, str) else key[0] for key in order_by]


def row_hash(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """Hash of the given (default: all) columns, used to break ties by content."""
    return F.xxhash64(*[F.col(c) for c in (columns or df.columns)])


def task_count(df: DataFrame) -> int:
    """Partitions of an exchange that adaptive execution must not merge: its rows multiply behind it."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def number_copies(df: DataFrame) -> DataFrame:
    """The same rows with ``_chunk`` and ``_copy``, which tell identical rows apart.

    Copies are counted before the shuffle and unrolled behind it in chunks of bounded
    size, so however many there are of one row, they spread over all tasks.
    """
    chunk = _COPIES_PER_CHUNK
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_total"))
    chunks = counted.withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0), F.expr(f"(_total - 1) div {chunk}")))
    )
    size = F.least(F.lit(chunk), F.col("_total") - F.col("_chunk") * chunk).cast("bigint")
    return (
        chunks.withColumn("_size", size)
        .repartition(task_count(df), row_hash(df), F.col("_chunk"))
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_size"))))
        .drop("_total", "_size")
    )


def has_hot_copies(df: DataFrame, order_by: Sequence[OrderKey], policy: SkewPolicy) -> bool:
    """True when one set of identical rows is too large for one task.

    Looks at the order columns first; only if those tie that often are whole rows read.
    """
    if hot_groups(df, list(dict.fromkeys(order_names(order_by))), policy) is None:
        return False
    return hot_groups(df.select(row_hash(df).alias("_hash")), ["_hash"], policy) is not None


def global_positions(
    df: DataFrame,
    order_by: Sequence[OrderKey],
    policy: SkewPolicy = DEFAULT_POLICY,
    distinct: bool = False,
) -> DataFrame:
    """Adds ``_part``, ``_place`` (1-based, inside the part) and ``_position`` (1-based, global).

    Ties are broken by row content; identical rows are interchangeable. Writes the
    ordered rows to the shared folder. ``distinct`` says that no two rows are
    identical, which saves looking for copies.
    """
    columns = df.columns
    order = [*order_columns(order_by), F.col("_hash")]
    rows = df
    if not distinct and has_hot_copies(df, order_by, policy):
        rows = number_copies(df)
        order += [F.col("_chunk"), F.col("_copy")]
    stored = materialize(
        rows.withColumn("_hash", row_hash(df))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id()),
        "ordered",
    )
    placed = stored.withColumns(
        {
            "_part": F.shiftright("_slot", _PLACE_BITS),
            "_place": F.col("_slot").bitwiseAND(F.lit(_PLACE_MASK)) + 1,
        }
    )
    # One row per range partition, so this window and the broadcast stay small.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn("_position", F.col("_before") + F.col("_place"))
        .select(*columns, "_part", "_place", "_position")
    )


def _split_numbering(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[OrderKey],
    policy: SkewPolicy,
    distinct: bool = False,
) -> DataFrame:
    """Adds ``_part``, ``_position`` and ``_group_row`` (1-based inside the group)."""
    placed = global_positions(df, [*keys, *order_by], policy, distinct)
    if not keys:
        return placed.withColumn("_group_row", F.col("_position")).drop("_place")
    # Hot groups only, hence bounded by SkewPolicy.max_hot_groups.
    starts = placed.groupBy(*keys).agg((F.min("_position") - 1).alias("_group_start"))
    starts = starts.select(*[F.col(k).alias(f"_start_{k}") for k in keys], "_group_start")
    match = null_safe_match(placed, starts, [(k, f"_start_{k}") for k in keys])
    return (
        placed.join(F.broadcast(starts), match)
        .withColumn("_group_row", F.col("_position") - F.col("_group_start"))
        .drop("_place", "_group_start", *[f"_start_{k}" for k in keys])
    )


def _tie_break(df: DataFrame, order_by: Sequence[OrderKey]) -> list[Column]:
    return [*order_columns(order_by), row_hash(df).asc()]


def per_group(
    df: DataFrame,
    keys: Sequence[str],
    plain,
    split,
    policy: SkewPolicy,
) -> DataFrame:
    """``plain`` on ordinary groups and ``split`` on hot ones; no keys means one hot group."""
    if not keys:
        return split(df)
    hot = hot_groups(df, keys, policy)
    if hot is None:
        return plain(df)
    hot_rows, cold_rows = split_hot(df, keys, hot)
    return plain(cold_rows).unionByName(split(hot_rows))


def number_rows(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[OrderKey],
    name: str = "row_number",
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Consecutive numbers from 1 in each group (or over the table with no group)."""

    def plain(rows: DataFrame) -> DataFrame:
        window = Window.partitionBy(*partition_by).orderBy(*_tie_break(df, order_by))
        return rows.withColumn(name, F.row_number().over(window).cast("bigint"))

    def split(rows: DataFrame) -> DataFrame:
        return (
            _split_numbering(rows, partition_by, order_by, policy)
            .withColumn(name, F.col("_group_row"))
            .drop("_part", "_position", "_group_row")
        )

    return per_group(df, partition_by, plain, split, policy)


def record_id(
    df: DataFrame,
    order_by: Sequence[OrderKey],
    name: str = "RecordID",
    start: int = 1,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Dense ids over the whole table in the given order."""
    numbered = number_rows(df, [], order_by, "_number", policy)
    return numbered.select(
        (F.col("_number") + (start - 1)).alias(name), *df.columns
    )


def sparse_record_id(df: DataFrame, name: str = "RecordID") -> DataFrame:
    """Unique, increasing but not consecutive ids, with no shuffle."""
    return df.select(F.monotonically_increasing_id().alias(name), "*")


def running_total(
    df: DataFrame,
    value: str,
    order_by: Sequence[OrderKey],
    partition_by: Sequence[str] = (),
    name: str | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Running sum of ``value`` in order, per group or over the whole table."""
    name = name or f"RunTot_{value}"
    keys = list(partition_by)

    def plain(rows: DataFrame) -> DataFrame:
        window = (
            Window.partitionBy(*keys)
            .orderBy(*_tie_break(df, order_by))
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        return rows.withColumn(name, F.sum(value).over(window))

    def split(rows: DataFrame) -> DataFrame:
        numbered = _split_numbering(rows, keys, order_by, policy)
        inside = (
            Window.partitionBy(*keys, "_part")
            .orderBy("_position")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        # One row per (group, range partition).
        earlier = Window.partitionBy(*[f"_carry_{k}" for k in keys]).orderBy("_carry_part").rowsBetween(
            Window.unboundedPreceding, -1
        )
        carry = (
            numbered.groupBy(*keys, "_part")
            .agg(F.sum(value).alias("_sum"))
            .select(
                *[F.col(k).alias(f"_carry_{k}") for k in keys],
                F.col("_part").alias("_carry_part"),
                "_sum",
            )
            .withColumn("_carry", F.sum("_sum").over(earlier))
            .drop("_sum")
        )
        match = null_safe_match(
            numbered, carry, [("_part", "_carry_part"), *[(k, f"_carry_{k}") for k in keys]]
        )
        own = F.sum(value).over(inside)
        return (
            numbered.join(F.broadcast(carry), match)
            .withColumn("_own", own)
            .withColumn(
                name,
                F.when(F.col("_own").isNull(), F.col("_carry")).otherwise(
                    F.col("_own") + F.coalesce(F.col("_carry"), F.lit(0))
                ),
            )
            .select(*df.columns, name)
        )

    return per_group(df, keys, plain, split, policy)


def neighbour_rows(
    df: DataFrame,
    outputs: dict[str, tuple[str, int]],
    order_by: Sequence[OrderKey],
    partition_by: Sequence[str] = (),
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Values from rows before or after in order, the base of a multi-row formula.

    ``outputs`` maps a new column to ``(column, offset)``: -1 is the previous row,
    1 the next. A row that does not exist gives NULL.
    """
    keys = list(partition_by)

    def plain(rows: DataFrame) -> DataFrame:
        window = Window.partitionBy(*keys).orderBy(*_tie_break(df, order_by))
        return rows.withColumns(
            {
                new: (F.lag(column, -offset) if offset < 0 else F.lead(column, offset)).over(window)
                for new, (column, offset) in outputs.items()
            }
        )

    def split(rows: DataFrame) -> DataFrame:
        # A global position is unique, so each lookup is an evenly spread equi-join.
        numbered = materialize(_split_numbering(rows, keys, order_by, policy), "numbered")
        result = numbered
        for new, (column, offset) in outputs.items():
            other = numbered.select(
                (F.col("_position") - offset).alias("_wanted"),
                (F.col("_group_row") - offset).alias("_wanted_row"),
                F.col(column).alias(new),
                *[F.col(k).alias(f"_other_{k}") for k in keys],
            )
            match = (result["_position"] == other["_wanted"]) & (result["_group_row"] == other["_wanted_row"])
            if keys:
                match = match & null_safe_match(result, other, [(k, f"_other_{k}") for k in keys])
            result = result.join(other, match, "left").drop(
                "_wanted", "_wanted_row", *[f"_other_{k}" for k in keys]
            )
        return result.select(*df.columns, *outputs)

    return per_group(df, keys, plain, split, policy)


def value_ranks(
    df: DataFrame,
    order_by: Sequence[OrderKey],
    partition_by: Sequence[str] = (),
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """One row per (group, order value): ``rank``, ``dense_rank``, ``value_rows``, ``group_rows``.

    Ties collapse before anything is ordered, so a value held by a third of the
    rows is one row here.
    """
    keys, names = list(partition_by), order_names(order_by)
    counts = df.groupBy(*keys, *names).agg(F.count(F.lit(1)).alias("value_rows"))
    before = F.coalesce(F.col("_before"), F.lit(0))

    def shaped(rows: DataFrame, rank: Column, dense_rank: Column) -> DataFrame:
        return rows.select(
            *keys,
            *names,
            (rank + 1).alias("rank"),
            dense_rank.cast("bigint").alias("dense_rank"),
            "value_rows",
            "group_rows",
        )

    def plain(rows: DataFrame) -> DataFrame:
        group = Window.partitionBy(*keys)
        ordered = group.orderBy(*order_columns(order_by))
        ranked = rows.withColumns(
            {
                "_before": F.sum("value_rows").over(ordered.rowsBetween(Window.unboundedPreceding, -1)),
                "_dense": F.row_number().over(ordered),
                "group_rows": F.sum("value_rows").over(group),
            }
        )
        return shaped(ranked, before, F.col("_dense"))

    def split(rows: DataFrame) -> DataFrame:
        placed = _split_numbering(rows, keys, order_by, policy, distinct=True)
        inside = (
            Window.partitionBy(*keys, "_part")
            .orderBy("_position")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        group = Window.partitionBy(*[f"_carry_{k}" for k in keys])
        earlier = group.orderBy("_carry_part").rowsBetween(Window.unboundedPreceding, -1)
        # One row per (hot group, range partition).
        carry = (
            placed.groupBy(*keys, "_part")
            .agg(F.sum("value_rows").alias("_sum"))
            .select(
                *[F.col(k).alias(f"_carry_{k}") for k in keys],
                F.col("_part").alias("_carry_part"),
                "_sum",
            )
            .withColumns(
                {
                    "_carry": F.coalesce(F.sum("_sum").over(earlier), F.lit(0)),
                    "group_rows": F.sum("_sum").over(group),
                }
            )
        )
        match = null_safe_match(
            placed, carry, [("_part", "_carry_part"), *[(k, f"_carry_{k}") for k in keys]]
        )
        ranked = placed.join(F.broadcast(carry), match).withColumn(
            "_before", F.sum("value_rows").over(inside)
        )
        return shaped(ranked, F.col("_carry") + before, F.col("_group_row"))

    return per_group(counts, keys, plain, split, policy)
