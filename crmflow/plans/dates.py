"""The explicit "today" of every rule."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F

AsOf = date | str | Column


def as_date(as_of: AsOf) -> Column:
    """A date, an ISO text or a column as a date column."""
    return (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast("date")
