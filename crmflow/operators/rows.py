"""Row-set operators: union, sort, sample, unique, generate rows, upsert."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from crmflow.operators.ordering import (
    OrderKey,
    has_hot_copies,
    number_copies,
    number_rows,
    order_columns,
    row_hash,
    task_count,
)
from crmflow.operators.skew import DEFAULT_POLICY, SkewPolicy

# Spark pre-limits row_number() <= n on the map side up to this n.
_GROUP_LIMIT = 1_000
#: Samples of up to this many rows are sorted as a whole, a few rows per task.
_SORTED_SAMPLE = 10_000


def union_by_name(inputs: Sequence[DataFrame]) -> DataFrame:
    """All rows of all inputs, matched by column name; a missing column is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), inputs)


def sort_rows(
    df: DataFrame, order_by: Sequence[OrderKey], policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Global sort with a repeatable order among ties.

    The content hash lets equal sort keys span range partitions; identical rows too
    many for one task are numbered first, so that they can, too.
    """
    order = [*order_columns(order_by), F.col("_hash")]
    rows = df
    if has_hot_copies(df, order_by, policy):
        rows = number_copies(df)
        order += [F.col("_chunk"), F.col("_copy")]
    return rows.withColumn("_hash", row_hash(df)).orderBy(*order).select(*df.columns)


def top_k(df: DataFrame, order_by: Sequence[OrderKey], k: int) -> DataFrame:
    """First ``k`` rows in order: each task keeps k, so nothing is sorted whole."""
    return (
        df.withColumn("_hash", row_hash(df))
        .orderBy(*order_columns(order_by), "_hash")
        .limit(k)
        .drop("_hash")
    )


def first_rows(df: DataFrame, n: int, order_by: Sequence[OrderKey] = ()) -> DataFrame:
    """Any ``n`` rows, or the first ``n`` in order."""
    return top_k(df, order_by, n) if order_by else df.limit(n)


def first_rows_per_group(
    df: DataFrame,
    n: int,
    group_by: Sequence[str],
    order_by: Sequence[OrderKey],
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """First ``n`` rows of each group.

    Up to 1,000 the limit is applied per group in each map task, before the
    shuffle; a larger ``n`` uses the numbering that splits hot groups.
    """
    if n > _GROUP_LIMIT:
        numbered = number_rows(df, group_by, order_by, "_row", policy)
    else:
        window = Window.partitionBy(*group_by).orderBy(*order_columns(order_by), row_hash(df))
        numbered = df.withColumn("_row", F.row_number().over(window))
    return numbered.where(F.col("_row") <= n).drop("_row")


def random_sample(df: DataFrame, fraction: float, seed: int = 0) -> DataFrame:
    """Each row with the given probability; repeatable for the same input files."""
    return df.sample(fraction=fraction, seed=seed)


def key_sample(df: DataFrame, keys: Sequence[str], percent: float) -> DataFrame:
    """Rows whose key hash falls into the given share: repeatable, whatever the partitioning.

    The hash is the first 32 bits of the MD5 of the keys' text.
    """
    text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    bits = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return df.where(bits < int(percent / 100 * 2**32))


def fixed_sample(df: DataFrame, size: int, keys: Sequence[str], seed: int = 0) -> DataFrame:
    """``size`` rows (all, if there are fewer): those of the smallest seeded key hashes.

    Every set of keys is as likely as any other, and the choice does not depend on the
    partitioning. The hash is the MD5 of the seed and the keys' text; ties go by the row's
    content. A large sample is cut at a bucket of hashes, found from counts per bucket, and only
    rows of that bucket are sorted.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    hashed = df.withColumn("_draw", F.md5(text))
    order = [F.col("_draw"), row_hash(df)]
    if size <= _SORTED_SAMPLE:
        return hashed.orderBy(*order).limit(size).drop("_draw")
    # 2 ** 20 buckets of about equal size.
    bucketed = hashed.withColumn("_bucket", F.left("_draw", F.lit(5)))
    counts = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_bucket")) - F.col("_rows")
    cut = counts.withColumn("_before", before).where(F.col("_before") < size).agg(
        F.max(F.struct("_bucket", "_before")).alias("cut")
    ).first()["cut"]
    if cut is None:
        return df
    rest = bucketed.where(F.col("_bucket") == cut["_bucket"]).orderBy(*order).limit(size - cut["_before"])
    return bucketed.where(F.col("_bucket") < cut["_bucket"]).unionByName(rest).drop("_draw", "_bucket")


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def unique_split(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[OrderKey] = (),
    policy: SkewPolicy = DEFAULT_POLICY,
) -> tuple[DataFrame, DataFrame]:
    """First row of each key, and all other rows; together exactly the input.

    Both come from one numbering. Ties in the order go by row content.
    """
    numbered = number_rows(df, keys, order_by, "_row", policy)
    return (
        numbered.where("_row = 1").drop("_row"),
        numbered.where("_row > 1").drop("_row"),
    )


def unique_rows(df: DataFrame, keys: Sequence[str], order_by: Sequence[OrderKey] = ()) -> DataFrame:
    """First row of each key only: one row per key and map task reaches the shuffle."""
    if not keys:
        return df.distinct()
    return first_rows_per_group(df, 1, keys, order_by)


def generate_rows(
    df: DataFrame,
    name: str,
    start: Column | int,
    stop: Column | int,
    step: Column | int = 1,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """One row per value of start, start + step, … up to stop, for each input row.

    A row whose start lies beyond its stop gives none. If one input row gives more
    than a task should take, its values are made in chunks on many tasks.
    """
    first, last, by = [
        (v if isinstance(v, Column) else F.lit(v)).cast("bigint") for v in (start, stop, step)
    ]
    by = F.nullif(by, F.lit(0).cast("bigint"))
    runs = F.when(by > 0, first <= last).when(by < 0, first >= last).otherwise(F.lit(False))
    # NULL rather than an error where constants give an impossible sequence.
    first = F.when(runs, first)
    steps = F.call_function("div", last - first, by)
    bounded = df.where(runs).withColumns({"_first": first, "_last": last, "_by": by, "_steps": steps})
    longest = bounded.agg(F.max("_steps")).first()[0]
    if longest is not None and longest >= policy.rows_per_task:
        size = policy.rows_per_task
        chunks = bounded.withColumn(
            "_chunk", F.explode(F.sequence(F.lit(0), F.expr(f"_steps div {size}")))
        ).repartition(task_count(df), row_hash(df), F.col("_chunk"))
        begin = F.col("_first") + F.col("_chunk") * size * F.col("_by")
        end = begin + F.least(F.lit(size - 1), F.col("_steps") - F.col("_chunk") * size) * F.col("_by")
        bounded = chunks.withColumns({"_first": begin, "_last": end})
    value = F.explode(F.sequence("_first", "_last", "_by"))
    return bounded.withColumn(name, value).select(*[c for c in df.columns if c != name], name)


def upsert(
    current: DataFrame, changes: DataFrame, keys: Sequence[str], version: str
) -> DataFrame:
    """Latest row per key from both tables; on equal versions the change wins.

    One partial aggregate per map task, so a key with very many versions never
    meets in one place.
    """
    columns = current.columns
    both = current.withColumn("_new", F.lit(0)).unionByName(
        changes.select(*columns).withColumn("_new", F.lit(1))
    )
    rest = [c for c in columns if c not in keys and c != version]
    latest = F.max_by(
        F.struct(version, *rest), F.struct(version, "_new", F.xxhash64(*columns).alias("_hash"))
    )
    return both.groupBy(*keys).agg(latest.alias("_row")).select(*keys, "_row.*").select(*columns)
