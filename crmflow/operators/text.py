"""Text tools: split to columns or rows, regex and date conversion."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _parts(field: str, delimiter: str) -> Column:
    return F.split(F.col(field), re.escape(delimiter), -1)


def text_to_columns(
    df: DataFrame,
    field: str,
    delimiter: str = ",",
    columns: int = 2,
    root: str | None = None,
    keep_rest: bool = False,
) -> DataFrame:
    """Split on a literal delimiter into ``root1 … rootN``; missing parts are NULL.

    Extra parts are dropped, or with ``keep_rest`` stay in the last column as they were.
    """
    parts = F.split(F.col(field), re.escape(delimiter), columns) if keep_rest else _parts(field, delimiter)
    root = root or field
    return df.withColumns({f"{root}{i + 1}": F.get(parts, F.lit(i)) for i in range(columns)})


def text_to_rows(df: DataFrame, field: str, delimiter: str = ",") -> DataFrame:
    """One row per part of the field; a NULL field keeps its row."""
    return df.withColumn(field, F.explode_outer(_parts(field, delimiter)))


def regex_match(df: DataFrame, field: str, pattern: str, name: str, allow_empty: bool = False) -> DataFrame:
    """Whether the pattern is found; a zero-length match counts only with ``allow_empty``."""
    column = F.col(field)
    if allow_empty:
        found = column.rlike(pattern)
    else:
        found = F.regexp_extract(column, pattern, 0) != ""
    return df.withColumn(name, found)


def regex_replace(df: DataFrame, field: str, pattern: str, replacement: str, name: str | None = None) -> DataFrame:
    return df.withColumn(name or field, F.regexp_replace(F.col(field), pattern, replacement))


def regex_parse(df: DataFrame, field: str, pattern: str, names: Sequence[str]) -> DataFrame:
    """One column per group of the first match; empty text where nothing matches."""
    return df.withColumns(
        {name: F.regexp_extract(F.col(field), pattern, i + 1) for i, name in enumerate(names)}
    )


def regex_tokenize(df: DataFrame, field: str, pattern: str, name: str) -> DataFrame:
    """One row per match of the whole pattern."""
    return df.withColumn(name, F.explode(F.regexp_extract_all(F.col(field), F.lit(pattern), F.lit(0))))


def text_to_datetime(df: DataFrame, field: str, pattern: str, name: str) -> DataFrame:
    """Parse text with a date pattern; text that does not fit gives NULL."""
    return df.withColumn(name, F.try_to_timestamp(F.col(field), F.lit(pattern)))


def datetime_to_text(df: DataFrame, field: str, pattern: str, name: str) -> DataFrame:
    return df.withColumn(name, F.date_format(F.col(field), pattern))
