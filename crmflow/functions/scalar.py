"""Helpers for derive and filter expressions.

Functions that Spark already has with the same meaning (``upper``, ``lpad``,
``year``, ``abs``, ``least`` …) are used directly and are not wrapped here.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def left_text(text: Column, n: int) -> Column:
    return F.left(text, F.lit(n))


def right_text(text: Column, n: int) -> Column:
    return F.right(text, F.lit(n))


def replace_text(text: Column, find: str, new: str) -> Column:
    """Literal replacement; the search text is not a pattern."""
    return F.replace(text, F.lit(find), F.lit(new))


def find_text(text: Column, find: str) -> Column:
    """1-based place of the first occurrence, 0 if absent."""
    return F.locate(find, text)


def is_empty(text: Column) -> Column:
    """True for NULL and for the empty text; never NULL."""
    return text.isNull() | (text == "")


def is_not_empty(text: Column) -> Column:
    return text.isNotNull() & (text != "")


def to_number(value: Column) -> Column:
    return value.try_cast("double")


def to_integer(value: Column) -> Column:
    return value.try_cast("int")


def to_date(text: Column, pattern: str | None = None) -> Column:
    """Text to date, NULL where it does not fit."""
    if pattern is None:
        return text.try_cast("date")
    return F.try_to_timestamp(text, F.lit(pattern)).cast("date")


def to_datetime(text: Column, pattern: str | None = None) -> Column:
    """Text to timestamp, NULL where it does not fit."""
    if pattern is None:
        return text.try_cast("timestamp")
    return F.try_to_timestamp(text, F.lit(pattern))


def date_plus(date: Column, n: Column | int, unit: str = "days") -> Column:
    """Date moved by n days, months or years (month ends are clipped)."""
    count = n if isinstance(n, Column) else F.lit(n)
    if unit == "days":
        return F.date_add(date, count)
    if unit == "months":
        return F.add_months(date, count)
    if unit == "years":
        return F.add_months(date, count * 12)
    raise ValueError(f"unknown unit {unit!r}")


def date_diff(start: Column, end: Column, unit: str = "days") -> Column:
    """Whole days, months or years from start to end."""
    if unit == "days":
        return F.datediff(end, start)
    months = F.months_between(end, start).cast("int")
    if unit == "months":
        return months
    if unit == "years":
        return (months / 12).cast("int")
    raise ValueError(f"unknown unit {unit!r}")


def regex_found(text: Column, pattern: str, allow_empty: bool = False) -> Column:
    """Whether the pattern is found; a zero-length match counts only with ``allow_empty``."""
    if allow_empty:
        return text.rlike(pattern)
    return F.regexp_extract(text, pattern, 0) != ""


def regex_count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def in_list(value: Column, *items: object) -> Column:
    return value.isin(*items)
