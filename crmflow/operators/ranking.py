"""Rank-type window functions that survive hot groups and tied values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from crmflow.operators.ordering import (
    OrderKey,
    _split_numbering,
    _tie_break,
    global_positions,
    order_columns,
    order_names,
    per_group,
    value_ranks,
)
from crmflow.operators.skew import DEFAULT_POLICY, SkewPolicy, hot_groups, null_safe_match, split_hot


def rows_before(df: DataFrame, column: str, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """Adds ``_before``, the rows with a smaller value (NULL is smallest), and ``_rows``, all rows.

    The rows are ordered by value in as many range parts as adaptive execution finds fit, and written
    once; equal values may fill any number of parts. Inside a part a plain window ranks them.
    Only the first value of a part can have begun in an earlier one: where it did is
    looked up for these values alone, one per part.
    """
    placed = global_positions(df, [column], policy)
    parts = placed.groupBy("_part").agg(
        F.count(F.lit(1)).alias("_size"), F.min_by(column, "_place").alias("_first")
    )
    # One row per range partition from here on.
    edges = parts.select(F.col("_first").alias("_edge")).distinct()
    starts = (
        placed.join(F.broadcast(edges), placed[column].eqNullSafe(edges["_edge"]))
        .groupBy("_edge")
        .agg((F.min("_position") - 1).alias("_start"))
    )
    totals = parts.withColumn("_rows", F.sum("_size").over(Window.partitionBy()))
    known = totals.join(F.broadcast(starts), totals["_first"].eqNullSafe(starts["_edge"])).select(
        F.col("_part").alias("_of"), "_first", "_start", "_rows"
    )
    inside = Window.partitionBy("_part").orderBy(F.col(column).asc_nulls_first())
    ranked = placed.withColumn("_inside", F.rank().over(inside).cast("bigint") - 1)
    before = F.when(F.col(column).eqNullSafe(F.col("_first")), F.col("_start")).otherwise(
        F.col("_position") - F.col("_place") + F.col("_inside")
    )
    return ranked.join(F.broadcast(known), ranked["_part"] == known["_of"]).select(
        *df.columns, before.alias("_before"), "_rows"
    )


def percent_rank(
    df: DataFrame,
    order_by: Sequence[OrderKey],
    name: str = "percent_rank",
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """``(rank - 1) / (rows - 1)`` over the whole table, 0 for a single row; ties share a rank.

    Reads the input several times: store a costly one first.
    """
    names = order_names(order_by)
    single = order_by[0] if len(order_by) == 1 else None
    column = single if isinstance(single, str) else None
    if column and isinstance(df.schema[column].dataType, T.NumericType):
        counted = rows_before(df, column, policy)
        share = F.when(F.col("_rows") > 1, F.col("_before") / (F.col("_rows") - 1))
        return counted.select(*df.columns, F.coalesce(share, F.lit(0.0)).alias(name))
    ranks = value_ranks(df, order_by, policy=policy).select(
        *names,
        F.when(
            F.col("group_rows") > 1, (F.col("rank") - 1) / (F.col("group_rows") - 1)
        ).otherwise(F.lit(0.0)).alias(name),
    )
    return attach_by_value(df, ranks, names, policy)


def attach_by_value(
    df: DataFrame, values: DataFrame, names: Sequence[str], policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Join a table with one row per value back to the rows; NULL values match, hot values are split."""
    extra = [c for c in values.columns if c not in names]
    right = values.select(*[F.col(c).alias(f"_value_{c}") for c in names], *extra)
    pairs = [(c, f"_value_{c}") for c in names]
    drop = [f"_value_{c}" for c in names]

    def attach(rows: DataFrame, lookup: DataFrame) -> DataFrame:
        return rows.join(lookup, null_safe_match(rows, lookup, pairs)).drop(*drop)

    hot = hot_groups(df, names, policy)
    if hot is None:
        return attach(df, right)
    hot_rows, cold_rows = split_hot(df, names, hot)
    marks = F.broadcast(hot)
    few = right.join(marks, null_safe_match(right, marks, [(f"_value_{c}", c) for c in names]), "left_semi")
    return attach(cold_rows, right).unionByName(attach(hot_rows, F.broadcast(few)))


def rank_rows(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[OrderKey],
    buckets: int = 4,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Adds ``row_number``, ``rank``, ``dense_rank``, ``percent_rank`` and ``ntile``.

    Row numbers and tiles break ties by row content, ranks do not.
    """
    keys, names = list(partition_by), order_names(order_by)

    def plain(rows: DataFrame) -> DataFrame:
        ties = Window.partitionBy(*keys).orderBy(*order_columns(order_by))
        total = Window.partitionBy(*keys).orderBy(*_tie_break(df, order_by))
        return rows.withColumns(
            {
                "row_number": F.row_number().over(total).cast("bigint"),
                "rank": F.rank().over(ties).cast("bigint"),
                "dense_rank": F.dense_rank().over(ties).cast("bigint"),
                "percent_rank": F.percent_rank().over(ties),
                "ntile": F.ntile(buckets).over(total).cast("bigint"),
            }
        )

    def split(rows: DataFrame) -> DataFrame:
        numbered = _split_numbering(rows, keys, order_by, policy).drop("_part", "_position")
        # The group is part of the value here, so a hot group is many values.
        ranks = value_ranks(rows, order_by, keys, policy).drop("value_rows")
        joined = attach_by_value(numbered, ranks, [*keys, *[n for n in names if n not in keys]], policy)
        n, row = F.col("group_rows"), F.col("_group_row")
        small = F.expr(f"group_rows div {buckets}")
        larger = n % buckets
        in_larger = larger * (small + 1)
        tile = F.when(row <= in_larger, F.ceil(row / (small + 1))).otherwise(
            larger + F.ceil((row - in_larger) / F.greatest(small, F.lit(1)))
        )
        return joined.select(
            *df.columns,
            row.alias("row_number"),
            "rank",
            "dense_rank",
            F.when(n > 1, (F.col("rank") - 1) / (n - 1)).otherwise(F.lit(0.0)).alias("percent_rank"),
            tile.cast("bigint").alias("ntile"),
        )

    return per_group(df, keys, plain, split, policy)


def dense_rank_small(df: DataFrame, order_by: Sequence[OrderKey], name: str) -> DataFrame:
    """``dense_rank`` over a table that is already a small aggregate (one row per campaign, say).

    The rank is taken over the distinct values and attached back, so even here no
    window holds tied rows.
    """
    names = order_names(order_by)
    window = Window.orderBy(*order_columns(order_by))
    ranks = df.select(*names).distinct().withColumn(name, F.dense_rank().over(window))
    right = ranks.select(*[F.col(c).alias(f"_value_{c}") for c in names], name)
    match = null_safe_match(df, right, [(c, f"_value_{c}") for c in names])
    return df.join(right, match).drop(*[f"_value_{c}" for c in names])
