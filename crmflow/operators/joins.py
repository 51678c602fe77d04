"""Joins: three outputs, any type, find and replace, append fields, star lookup."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from crmflow.operators.search import longest_keys
from crmflow.operators.skew import (
    DEFAULT_POLICY,
    SkewPolicy,
    fits_broadcast,
    hot_groups,
    join_unique,
    split_hot,
)
from crmflow.storage import materialize

KeyPair = str | tuple[str, str]

# Up to this many lookup keys are tried one by one on each row.
_KEYS_PER_ROW_SCAN = 100


def key_pairs(keys: Sequence[KeyPair]) -> list[tuple[str, str]]:
    return [(k, k) if isinstance(k, str) else k for k in keys]


def _null_free(df: DataFrame, names: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose keys are all set, and rows with a NULL key (which can match nothing)."""
    any_null = reduce(lambda a, b: a | b, [F.col(n).isNull() for n in names])
    return df.where(~any_null), df.where(any_null)


def _right_names(
    left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], prefix: str
) -> dict[str, str]:
    """Output names of the right columns: a same-named key is dropped, other clashes are prefixed."""
    same = {r for l, r in pairs if l == r}
    return {
        c: prefix + c if c in left.columns else c for c in right.columns if c not in same
    }


def join_tables(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[KeyPair],
    how: str = "inner",
    select: Mapping[str, str | None] | None = None,
    prefix: str = "Right_",
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Equi-join of type inner, left, right or outer, with keys that may differ in name.

    Columns of the right side that clash get a prefix; a same-named key appears
    once, with the value of whichever side has it. ``select`` renames output
    columns, or drops them when mapped to None.

    Adaptive execution splits a hot key on either side of an inner join, but only
    on the left of a left join; so a left join whose right side has hot keys becomes
    the inner join plus the unmatched rows. Rows with a NULL key match nothing and
    skip the shuffle.
    """
    pairs = key_pairs(keys)
    left_keys, right_keys = [l for l, _ in pairs], [r for _, r in pairs]
    names = _right_names(left, right, pairs, prefix)
    tagged = right.select(*[F.col(c).alias(f"_r_{c}") for c in right.columns])
    right_out = [F.col(f"_r_{c}").alias(n) for c, n in names.items()]

    def matched(rows: DataFrame, join_type: str) -> DataFrame:
        on = [rows[l] == tagged[f"_r_{r}"] for l, r in pairs]
        return rows.join(tagged, on, join_type).select(*[rows[c] for c in left.columns], *right_out)

    def left_alone(rows: DataFrame) -> DataFrame:
        """Unmatched left rows in the output's shape."""
        nulls = [F.lit(None).cast(right.schema[c].dataType).alias(n) for c, n in names.items()]
        return rows.select(*left.columns, *nulls)

    def right_alone(rows: DataFrame) -> DataFrame:
        """Unmatched right rows in the output's shape; a same-named key keeps its value."""
        columns = [
            F.col(c) if (c, c) in pairs else F.lit(None).cast(left.schema[c].dataType).alias(c)
            for c in left.columns
        ]
        return rows.select(*columns, *[F.col(c).alias(n) for c, n in names.items()])

    if how not in ("inner", "left", "right", "outer"):
        raise ValueError(f"unknown join type {how!r}")
    if how in ("inner", "right"):
        result = matched(left, "inner")
    elif hot_groups(right, right_keys, policy) is None:
        keyed, unkeyed = _null_free(left, left_keys)
        result = matched(keyed, "left").unionByName(left_alone(unkeyed))
    else:
        result = matched(left, "inner").unionByName(
            left_alone(left_only(left, right, keys, policy))
        )
    if how in ("right", "outer"):
        result = result.unionByName(right_alone(right_only(left, right, keys, policy)))
    if select:
        dropped = [c for c, new in select.items() if new is None]
        renamed = {c: new for c, new in select.items() if new is not None}
        result = result.drop(*dropped).withColumnsRenamed(renamed)
    return result


def left_only(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[KeyPair],
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Left rows without a match; NULL keys have none.

    The right side is reduced to distinct keys before its shuffle. Left rows of hot
    keys are tested by broadcast against the few of those keys that exist.
    """
    pairs = key_pairs(keys)
    names = [l for l, _ in pairs]
    keyed, unkeyed = _null_free(left, names)
    others = right.select(*[F.col(r).alias(l) for l, r in pairs]).distinct()
    hot = hot_groups(keyed, names, policy)
    if hot is None:
        return keyed.join(others, names, "left_anti").unionByName(unkeyed)
    hot_rows, cold_rows = split_hot(keyed, names, hot)
    present = others.join(F.broadcast(hot), names, "left_semi")
    return (
        cold_rows.join(others, names, "left_anti")
        .unionByName(hot_rows.join(F.broadcast(present), names, "left_anti"))
        .unionByName(unkeyed)
    )


def right_only(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[KeyPair],
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Right rows without a match."""
    return left_only(right, left, [(r, l) for l, r in key_pairs(keys)], policy)


def join_outputs(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[KeyPair],
    select: Mapping[str, str | None] | None = None,
    prefix: str = "Right_",
    policy: SkewPolicy = DEFAULT_POLICY,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Matched pairs, left rows without a match, right rows without a match."""
    return (
        join_tables(left, right, keys, "inner", select, prefix, policy),
        left_only(left, right, keys, policy),
        right_only(left, right, keys, policy),
    )


def unique_lookup(lookup: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """One row per non-NULL key: the smallest by the other columns, so the pick is repeatable."""
    rest = [c for c in columns if c != key]
    rows = lookup.where(F.col(key).isNotNull())
    if not rest:
        return rows.select(key).distinct()
    return rows.groupBy(key).agg(F.min(F.struct(*rest)).alias("_row")).select(key, "_row.*")


def find_replace(
    df: DataFrame,
    field: str,
    lookup: DataFrame,
    find: str,
    replacement: str | None = None,
    append: Sequence[str] = (),
    mode: str = "whole",
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Replace text found in a lookup table, and/or append the found row's fields.

    ``whole`` replaces a value equal to a lookup key; ``start`` replaces a key the
    value begins with; ``any`` replaces every occurrence of a key inside the value.
    If several keys fit, the longest wins (then the smallest). Values without a
    match stay as they are; duplicate lookup keys never multiply rows.
    """
    carried = list(dict.fromkeys([*([replacement] if replacement else []), *append]))
    keys = unique_lookup(lookup, find, [find, *carried]).select(
        F.col(find).alias("_found"),
        *[F.col(c).alias(f"_new_{c}") for c in carried],
    )
    if mode not in ("whole", "start", "any"):
        raise ValueError(f"unknown find mode {mode!r}")
    if mode != "whole" and keys.limit(_KEYS_PER_ROW_SCAN + 1).count() <= _KEYS_PER_ROW_SCAN:
        joined = _scan_keys(df, field, keys, mode)
    elif mode == "any":
        found = longest_keys(df, field, keys, "_found", "_found")
        if fits_broadcast(keys, policy):
            joined = found.join(F.broadcast(keys), "_found", "left")
        else:
            joined = join_unique(materialize(found, "searched"), keys, ["_found"], "left", policy)
    else:
        values = (
            keys.withColumn(field, F.col("_found"))
            if mode == "whole"
            else _longest_prefix(df, field, keys, policy)
        )
        if fits_broadcast(values, policy):
            joined = df.join(F.broadcast(values), field, "left")
        else:
            joined = join_unique(df, values, [field], "left", policy)
    column = F.col(field)
    if replacement:
        new = F.col(f"_new_{replacement}")
        hit = F.col("_found").isNotNull() & new.isNotNull()
        if mode == "whole":
            replaced = new
        elif mode == "start":
            replaced = F.concat(new, F.substring(column, F.length("_found") + 1, F.length(column)))
        else:
            replaced = F.replace(column, F.col("_found"), new)
        column = F.when(hit, replaced).otherwise(column)
    return joined.select(
        *[column.alias(c) if c == field else F.col(c) for c in df.columns],
        *[F.col(f"_new_{c}").alias(c) for c in append],
    )


def _longest_first() -> Column:
    """Sorting by this puts longer keys first, equal lengths in text order."""
    return F.struct((-F.length("_found")).alias("_rank"), F.col("_found"))


def _scan_keys(df: DataFrame, field: str, keys: DataFrame, mode: str) -> DataFrame:
    """Try a few keys on each row, longest first: no text is shuffled."""
    value = F.col(field)
    few = keys.where(F.length("_found") > 0).select("_found").orderBy(_longest_first())
    found = F.lit(None).cast("string")
    # At most _KEYS_PER_ROW_SCAN keys; the last one tested ends up innermost.
    for row in reversed(few.collect()):
        key = F.lit(row["_found"])
        fits = value.startswith(key) if mode == "start" else value.contains(key)
        found = F.when(fits, key).otherwise(found)
    return df.withColumn("_found", found).join(F.broadcast(keys), "_found", "left")


def _longest_prefix(df: DataFrame, field: str, keys: DataFrame, policy: SkewPolicy) -> DataFrame:
    """For each distinct value of ``field``, the longest of very many keys that it starts with.

    An equi-join on the value's beginnings of the keys' lengths: no value is compared
    with every key, and neither side has a size limit.
    """
    lengths = keys.where(F.length("_found") > 0).agg(
        F.array_sort(F.collect_set(F.length("_found")))
    )
    values = df.select(field).where(F.col(field).isNotNull()).distinct()
    values = values.withColumn("_length", F.explode(lengths.scalar())).where(
        F.col("_length") <= F.length(field)
    )
    pieces = values.select(field, F.substring(F.col(field), F.lit(1), F.col("_length")).alias("_found"))
    if fits_broadcast(keys, policy):
        hits = pieces.join(F.broadcast(keys), "_found")
    else:
        hits = join_unique(pieces, keys, ["_found"], "inner", policy)
    return (
        hits.groupBy(field)
        .agg(F.min_by(F.struct(*keys.columns), _longest_first()).alias("_best"))
        .select(field, "_best.*")
    )


def append_fields(df: DataFrame, source: DataFrame, max_source_rows: int = 1_000) -> DataFrame:
    """Every row of ``df`` with every row of a small ``source``.

    The source's size is checked; it travels as one array and is unrolled next to
    each row, with no join. A larger source is refused: the result would be its
    size times the table's.
    """
    if source.limit(max_source_rows + 1).count() > max_source_rows:
        raise ValueError(f"append_fields takes a source of at most {max_source_rows} rows")
    rows = source.agg(F.collect_list(F.struct("*"))).scalar()
    return df.select("*", F.inline(rows))


def lookup_dimensions(
    df: DataFrame,
    dimensions: Sequence[tuple[DataFrame, str]],
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Left star lookup: each dimension has one row per key and is broadcast only if small."""
    for dimension, key in dimensions:
        if fits_broadcast(dimension, policy):
            df = df.join(F.broadcast(dimension), key, "left")
        else:
            df = join_unique(df, dimension, [key], "left", policy)
    return df


def null_key_counts(
    left: DataFrame, right: DataFrame, keys: Sequence[KeyPair]
) -> DataFrame:
    """Rows with a NULL key on each side: ``side``, ``key``, ``null_rows``, ``total_rows``."""
    pairs = key_pairs(keys)

    def side(df: DataFrame, label: str, names: Sequence[str]) -> DataFrame:
        counts = df.agg(
            F.count(F.lit(1)).alias("total_rows"),
            *[F.count_if(F.col(n).isNull()).alias(f"_null_{i}") for i, n in enumerate(names)],
        )
        rows = F.array(
            *[
                F.struct(F.lit(n).alias("key"), F.col(f"_null_{i}").alias("null_rows"))
                for i, n in enumerate(names)
            ]
        )
        return counts.select(F.lit(label).alias("side"), F.inline(rows), "total_rows")

    return side(left, "left", [l for l, _ in pairs]).unionByName(
        side(right, "right", [r for _, r in pairs])
    )
