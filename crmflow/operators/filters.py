"""Split filter and simple predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def filter_split(
    df: DataFrame, condition: Column | str, null_as_false: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Rows where the condition holds, and rows where it does not.

    Rows where it is NULL go to neither output, or to the second with ``null_as_false``.
    """
    test = F.expr(condition) if isinstance(condition, str) else condition
    if null_as_false:
        test = F.coalesce(test, F.lit(False))
    return df.where(test), df.where(~test)


def simple_predicate(df: DataFrame, column: str, operator: str, operand: object = None) -> Column:
    """Condition from a column, an operator name and a text operand.

    The operand is cast to the column's type, so numbers compare as numbers.
    """
    field = F.col(column)
    if operator == "is null":
        return field.isNull()
    if operator == "is not null":
        return field.isNotNull()
    if operator == "contains":
        return field.cast("string").contains(F.lit(str(operand)))
    value = F.lit(operand).cast(df.schema[column].dataType)
    comparisons = {
        "=": field == value,
        "!=": field != value,
        "<": field < value,
        "<=": field <= value,
        ">": field > value,
        ">=": field >= value,
    }
    if operator not in comparisons:
        raise ValueError(f"unknown operator {operator!r}")
    return comparisons[operator]
