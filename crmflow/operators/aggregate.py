"""Summarize, cross tab and transpose."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from crmflow.operators.ordering import OrderKey, number_rows, order_names
from crmflow.operators.skew import DEFAULT_POLICY, SkewPolicy

_ROWS_PER_TEXT_PART = 100_000


@dataclass(frozen=True)
class Summary:
    """One aggregate: an action on a field under an output name (default: the field's)."""

    field: str
    action: str
    name: str | None = None
    approximate: bool = False

    @property
    def output(self) -> str:
        return self.name or self.field


def _ends(field: str, order_by: Sequence[OrderKey], last: bool) -> Column:
    """First or last value in order; NULLs count as values, ties go by field value."""
    directions = {d for _, d in ((k, "asc") if isinstance(k, str) else k for k in order_by)}
    if not order_by or len(directions) > 1:
        raise ValueError("First and Last need order columns that all run the same way")
    # A struct is never NULL, so NULL order values and fields take part.
    key = F.struct(*[F.col(n) for n in order_names(order_by)], F.col(field).alias("_tie"))
    ascending = directions == {"asc"}
    pick = F.max_by if last == ascending else F.min_by
    return pick(F.struct(F.col(field).alias("_value")), key)["_value"]


def summarize(
    df: DataFrame,
    group_by: Sequence[str],
    summaries: Sequence[Summary],
    order_by: Sequence[OrderKey] = (),
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Group (or aggregate the whole table, with no group) and apply actions.

    Actions: Sum, Count (non-NULL), CountAll, CountNonNull, CountDistinct, Avg, Min,
    Max, First, Last, Concat, StdDev, Variance. First, Last and Concat take
    ``order_by``; an unknown action counts as First. Concat joins with a comma and
    skips NULLs; its text is put together by ``concat_text``.
    """
    plain = [s for s in summaries if s.action != "Concat"]
    texts = [s for s in summaries if s.action == "Concat"]
    columns = []
    for item in plain:
        field = F.col(item.field)
        if item.action == "Sum":
            column = F.sum(field)
        elif item.action in ("Count", "CountNonNull"):
            column = F.count(field)
        elif item.action == "CountAll":
            column = F.count(F.lit(1))
        elif item.action == "CountDistinct":
            column = F.approx_count_distinct(field) if item.approximate else F.count_distinct(field)
        elif item.action == "Avg":
            column = F.avg(field)
        elif item.action == "Min":
            column = F.min(field)
        elif item.action == "Max":
            column = F.max(field)
        elif item.action == "StdDev":
            column = F.stddev_samp(field)
        elif item.action == "Variance":
            column = F.var_samp(field)
        else:
            column = _ends(item.field, order_by, last=item.action == "Last")
        columns.append(column.alias(item.output))
    if texts and not plain:
        columns.append(F.count(F.lit(1)).alias("_rows"))
    result = df.groupBy(*group_by).agg(*columns) if columns else None
    for item in texts:
        text = concat_text(df, group_by, item.field, order_by, item.output, policy=policy)
        if group_by:
            keys = [F.col(g).alias(f"_text_{g}") for g in group_by]
            text = text.select(*keys, item.output)
            match = [result[g].eqNullSafe(text[f"_text_{g}"]) for g in group_by]
            result = result.join(text, match, "left").drop(*[f"_text_{g}" for g in group_by])
        else:
            result = result.withColumn(item.output, text.scalar())
    return result.select(*group_by, *[s.output for s in summaries])


def concat_parts(
    df: DataFrame,
    group_by: Sequence[str],
    field: str,
    order_by: Sequence[OrderKey],
    name: str = "text",
    separator: str = ",",
    rows_per_part: int = _ROWS_PER_TEXT_PART,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """The ordered text of each group in consecutive parts of bounded size: group, ``part``, text.

    Whole however large a group is: a hot group's rows are numbered and joined in many tasks.
    """
    rows = df.where(F.col(field).isNotNull()).select(
        *dict.fromkeys([*group_by, *order_names(order_by), field])
    )
    order = list(order_by) or [field]
    numbered = number_rows(rows, group_by, order, "_row", policy)
    return (
        numbered.withColumn("part", F.expr(f"(_row - 1) div {rows_per_part}"))
        .groupBy(*group_by, "part")
        .agg(F.sort_array(F.collect_list(F.struct("_row", F.col(field).cast("string").alias("_text")))).alias("_items"))
        .select(*group_by, "part", F.array_join(F.col("_items")["_text"], separator).alias(name))
    )


def concat_text(
    df: DataFrame,
    group_by: Sequence[str],
    field: str,
    order_by: Sequence[OrderKey],
    name: str,
    separator: str = ",",
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """All values of each group as one text, in order (by value if no order is given).

    Built from the bounded parts of ``concat_parts``. The result is one cell, so a
    group's text has to fit Spark's 2 GB cell; above that, use the parts.
    """
    parts = concat_parts(df, group_by, field, order_by, "_text", separator, policy=policy)
    return parts.groupBy(*group_by).agg(
        F.array_join(
            F.sort_array(F.collect_list(F.struct("part", "_text")))["_text"], separator
        ).alias(name)
    )


def cross_tab(
    df: DataFrame,
    group_by: Sequence[str],
    header: str,
    field: str,
    method: str = "Sum",
    values: Sequence[object] | None = None,
    order_by: Sequence[OrderKey] = (),
    policy: SkewPolicy = DEFAULT_POLICY,
    rest: str | None = None,
) -> DataFrame:
    """One column per header value, holding the method's result for (group, header).

    The cells are aggregated first, pivoted after: the pivot sees one row per cell.
    Give ``values`` to save the job that looks for them; with ``rest``, all other headers
    (NULL, too) share one more column of that name, without it they are left out.
    """
    if rest is not None:
        if values is None or rest in map(str, values):
            raise ValueError("rest needs the header values, and a name that is none of them")
        listed = F.col(header).isin(*values)
        df = df.withColumn(header, F.when(listed, F.col(header).cast("string")).otherwise(rest))
        values = [*map(str, values), rest]
    cells = summarize(df, [*group_by, header], [Summary(field, method, "_cell")], order_by, policy)
    pivoted = cells.groupBy(*group_by).pivot(header, list(values) if values is not None else None)
    return pivoted.agg(F.first("_cell"))


def transpose(
    df: DataFrame,
    keys: Sequence[str],
    fields: Sequence[str],
    name_column: str = "Name",
    value_column: str = "Value",
    value_type: str = "string",
) -> DataFrame:
    """One row per (row, field), values cast to a common type."""
    typed = df.select(*keys, *[F.col(f).try_cast(value_type).alias(f) for f in fields])
    return typed.unpivot(list(keys), list(fields), name_column, value_column)
