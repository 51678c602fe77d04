"""Data quality: null and duplicate counts in one pass, dedup, imputation, narrow types."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from crmflow.operators.ordering import value_ranks
from crmflow.operators.skew import DEFAULT_POLICY, SkewPolicy

# Candidate types of auto_field, narrowest first.
NARROW_TYPES = ["int", "bigint", "double", "date", "timestamp"]
# A whole number as a bigint is written out.
PLAIN_INTEGER = r"^(0|-?[1-9]\d{0,18})$"
INT_RANGE = (-(2**31), 2**31 - 1)
# A number that a double reads back: no leading zeros, no type suffix.
PLAIN_NUMBER = r"^-?(0|[1-9]\d*)(\.\d+)?([eE][+-]?\d+)?$"
# Years that a timestamp holds in full, in any time zone; dates reach further.
TIMESTAMP_YEARS = (-290307, 294246)
# A date without anything that could be a time of day.
PLAIN_DATE = r"^\s*[+-]?\d+(-\d+){0,2}\s*$"


def data_columns(df: DataFrame) -> list[str]:
    """Columns that hold data: names starting with ``_`` are lineage."""
    return [c for c in df.columns if not c.startswith("_")]


def null_counts(df: DataFrame, only_with_nulls: bool = True) -> DataFrame:
    """``column_name, null_count`` for every data column, from a single pass."""
    columns = data_columns(df)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in columns])
    result = counts.select(F.inline(rows))
    return result.where("null_count > 0") if only_with_nulls else result


def duplicate_count(df: DataFrame) -> DataFrame:
    """``row_count, distinct_count, duplicate_count`` over the data columns (NULLs equal)."""
    groups = df.groupBy(*data_columns(df)).agg(F.count(F.lit(1)).alias("_copies"))
    return groups.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("row_count"),
        F.count(F.lit(1)).alias("distinct_count"),
    ).withColumn("duplicate_count", F.col("row_count") - F.col("distinct_count"))


def drop_exact_duplicates(df: DataFrame, earliest_by: str = "_ingestion_timestamp") -> DataFrame:
    """One row per set of equal data columns; its lineage columns are those of the earliest row."""
    columns = data_columns(df)
    lineage = [c for c in df.columns if c not in columns]
    if not lineage:
        return df.distinct()
    first = [c for c in lineage if c == earliest_by]
    kept = F.min(F.struct(*first, *[c for c in lineage if c not in first]))
    return df.groupBy(*columns).agg(kept.alias("_kept")).select(*columns, "_kept.*").select(*df.columns)


def quality_report(df: DataFrame, table: str) -> DataFrame:
    """One row: original, cleaned and removed rows, and a map of the columns that have NULLs.

    Null and duplicate counts come from the same grouped pass over the rows.
    """
    columns = data_columns(df)
    groups = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    nulls = [
        F.coalesce(F.sum(F.when(F.col(c).isNull(), F.col("_copies"))), F.lit(0)).alias(f"_null_{i}")
        for i, c in enumerate(columns)
    ]
    totals = groups.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("original_row_count"),
        F.count(F.lit(1)).alias("cleaned_row_count"),
        *nulls,
    )
    pairs = F.array(
        *[F.struct(F.lit(c), F.col(f"_null_{i}").alias("n")) for i, c in enumerate(columns)]
    )
    removed = F.col("original_row_count") - F.col("cleaned_row_count")
    return totals.select(
        F.lit(table).alias("table_name"),
        "original_row_count",
        "cleaned_row_count",
        removed.alias("rows_removed"),
        removed.alias("duplicate_count"),
        F.map_from_entries(F.filter(pairs, lambda p: p["n"] > 0)).alias("null_counts"),
    )


def exact_median(df: DataFrame, column: str, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """One row ``median`` (double): mean of the middle values, found by rank without a single-task sort."""
    ranks = value_ranks(df.where(F.col(column).isNotNull()), [column], policy=policy)
    low, high = F.expr("(group_rows + 1) div 2"), F.expr("(group_rows + 2) div 2")

    def covers(place: Column) -> Column:
        return (F.col("rank") <= place) & (place < F.col("rank") + F.col("value_rows"))

    value = F.col(column).cast("double")
    return ranks.agg(
        ((F.max(F.when(covers(low), value)) + F.max(F.when(covers(high), value))) / 2).alias("median")
    )


def most_frequent(df: DataFrame, column: str) -> DataFrame:
    """One row ``mode``: the most frequent non-NULL value, the smallest on a tie."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_rows"))
    best = F.min_by(F.col(column), F.struct((-F.col("_rows")).alias("_rank"), F.col(column)))
    return counts.agg(best.alias("mode"))


def impute(
    df: DataFrame,
    methods: Mapping[str, str | tuple[str, object]],
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Fill NULLs per column by ``mean``, ``median``, ``mode`` or ``("constant", value)``.

    Each statistic is a one-row subquery over the column; the result keeps the column's type.
    """
    fills = {}
    for column, method in methods.items():
        kind = df.schema[column].dataType
        name, constant = (method, None) if isinstance(method, str) else method
        if name == "constant":
            fill = F.lit(constant)
        elif name == "mean":
            fill = df.agg(F.avg(column)).scalar()
        elif name == "median":
            fill = exact_median(df, column, policy).scalar()
        elif name == "mode":
            fill = most_frequent(df, column).scalar()
        else:
            raise ValueError(f"unknown imputation {name!r}")
        fills[column] = F.coalesce(F.col(column), fill.cast(kind))
    return df.withColumns(fills)


def _fits(column: Column, kind: str) -> Column:
    """Whether the text keeps its meaning under the type.

    Whole numbers must read back as the same text (``007`` stays text), and a date
    must have no time of day. A double needs a plain number without leading zeros and with
    no more digits than it can hold; a timestamp needs a date part, as a bare time of day
    would become a moment of today. A date beyond the years of timestamps is judged by its text.
    """
    cast = column.try_cast(kind)
    # Only text of the right form is converted: a failed conversion to a number is slow.
    if kind in ("int", "bigint"):
        whole = F.when(column.rlike(PLAIN_INTEGER), column).try_cast("bigint")
        same = whole.cast("string") == column
        return same & whole.between(*INT_RANGE) if kind == "int" else same
    if kind == "double":
        number = F.when(column.rlike(PLAIN_NUMBER), column)
        digits = F.length(F.regexp_replace(F.regexp_replace(number, "[eE].*", ""), "[^0-9]", ""))
        return number.try_cast(kind).isNotNull() & (digits <= 15)
    if kind == "timestamp":
        return cast.isNotNull() & column.rlike(r"^\s*[+-]?\d{4,6}-")
    if kind == "date":
        near = F.year(cast).between(*TIMESTAMP_YEARS)
        midnight = F.when(near, cast).cast("timestamp")
        return F.when(near, midnight == column.try_cast("timestamp")).otherwise(column.rlike(PLAIN_DATE) & cast.isNotNull())
    return cast.isNotNull()


def narrow_types(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, str]:
    """Narrowest type each text column fits, from one aggregate over all candidates.

    Each value is a row of its own there, so that the code of the tests does not grow with the columns.
    """
    columns = list(columns or [f.name for f in df.schema.fields if f.dataType.typeName() == "string"])
    if not columns:
        return {}
    values = F.array(*[F.struct(F.lit(i).alias("place"), F.col(c).cast("string").alias("text")) for i, c in enumerate(columns)])
    texts = df.select(F.inline(values)).where("text IS NOT NULL")
    fits = [F.coalesce(_fits(F.col("text"), kind), F.lit(False)) for kind in NARROW_TYPES]
    found = texts.groupBy("place").agg(*[F.every(f).alias(kind) for f, kind in zip(fits, NARROW_TYPES)])
    chosen = dict.fromkeys(columns, "string")
    for row in found.collect():  # one row per column
        chosen[columns[row["place"]]] = next((kind for kind in NARROW_TYPES if row[kind]), "string")
    return chosen


def auto_field(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Cast each text column to the narrowest type all its values fit."""
    types = narrow_types(df, columns)
    return df.withColumns({c: F.col(c).try_cast(kind) for c, kind in types.items() if kind != "string"})
