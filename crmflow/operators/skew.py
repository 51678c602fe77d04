"""Finding hot groups, and joins that stay balanced when they exist.

Every probe here returns a list bounded by the policy and only steers the plan:
a group the probe misses is still processed whole, just without being split.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T


@dataclass(frozen=True)
class SkewPolicy:
    """How much one task may be given before a group is split.

    rows_per_task    a group above this many rows is hot
    probe_fraction   share of the rows the probe looks at
    max_hot_groups   at most this many groups are treated as hot
    broadcast_rows   a table up to this many rows …
    broadcast_bytes  … and this many bytes may be broadcast
    """

    rows_per_task: int = 20_000_000
    probe_fraction: float = 0.01
    max_hot_groups: int = 10_000
    broadcast_rows: int = 1_000_000
    broadcast_bytes: int = 128 * 1024 * 1024
    seed: int = 17


DEFAULT_POLICY = SkewPolicy()


def null_safe_match(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    """Join condition under which NULL keys equal each other."""
    return reduce(
        lambda a, b: a & b, [left[lk].eqNullSafe(right[rk]) for lk, rk in pairs]
    )


def hot_groups(
    df: DataFrame, keys: Sequence[str], policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame | None:
    """Distinct ``keys`` of groups too large for one task, or None.

    The result is a local table of at most ``max_hot_groups`` rows. The probe
    reads the key columns of a sample and pre-aggregates before its shuffle.
    """
    rows = df.select(*keys)
    if policy.probe_fraction < 1:
        rows = rows.sample(fraction=policy.probe_fraction, seed=policy.seed)
    limit = policy.rows_per_task * policy.probe_fraction
    found = (
        rows.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > limit)
        .orderBy(F.col("_rows").desc())
        .limit(policy.max_hot_groups)
        .drop("_rows")
    )
    hot = found.collect()
    if not hot:
        return None
    return df.sparkSession.createDataFrame(hot, found.schema)


def split_hot(
    df: DataFrame, keys: Sequence[str], hot: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Rows of the hot groups, and all other rows (NULL keys compare equal)."""
    marks = F.broadcast(hot)  # bounded by SkewPolicy.max_hot_groups
    match = null_safe_match(df, marks, [(k, k) for k in keys])
    return df.join(marks, match, "left_semi"), df.join(marks, match, "left_anti")


def _row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row's values take."""
    sizes: list[Column] = []
    for field in df.schema.fields:
        kind = field.dataType
        if isinstance(kind, (T.StringType, T.BinaryType)):
            sizes.append(F.octet_length(field.name))
        elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            sizes.append(F.octet_length(F.to_json(F.struct(field.name))))
    return reduce(lambda a, b: a + F.coalesce(b, F.lit(0)), sizes, F.lit(8 * len(df.columns)))


def fits_broadcast(df: DataFrame, policy: SkewPolicy = DEFAULT_POLICY) -> bool:
    """True when ``df`` is measured to stay within the policy's broadcast rows and bytes."""
    # Without a limit, which would bring its rows into one task: each task sends one row of sums.
    found = df.agg(
        F.count(F.lit(1)).alias("rows"), F.sum(_row_bytes(df).cast("bigint")).alias("bytes")
    ).first()
    return found["rows"] <= policy.broadcast_rows and (found["bytes"] or 0) <= policy.broadcast_bytes


def join_unique(
    df: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    policy: SkewPolicy = DEFAULT_POLICY,
    hot: DataFrame | None = None,
    probe: bool = True,
) -> DataFrame:
    """Equi-join ``df`` to a ``lookup`` that has one row per key.

    Rows of hot keys meet their few lookup rows by broadcast, so no task gets a
    hot key whole; the rest is an ordinary join. ``how`` is ``left`` or ``inner``.
    ``hot`` passes on an earlier probe, ``probe=False`` skips it.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"join_unique supports left and inner, not {how!r}")
    if hot is None and probe:
        hot = hot_groups(df, keys, policy)
    if hot is None:
        return df.join(lookup, list(keys), how)
    hot_rows, cold_rows = split_hot(df, keys, hot)
    # One lookup row per hot key, hence no larger than the hot list.
    hot_lookup = lookup.join(F.broadcast(hot), list(keys), "left_semi")
    return cold_rows.join(lookup, list(keys), how).unionByName(
        hot_rows.join(F.broadcast(hot_lookup), list(keys), how)
    )
