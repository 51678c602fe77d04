"""Projection operators: select, derive, cleanse, cast, band."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def select_fields(
    df: DataFrame,
    keep: Sequence[str] = (),
    drop: Sequence[str] = (),
    rename: Mapping[str, str] | None = None,
    types: Mapping[str, str] | None = None,
    keep_unknown: bool = False,
) -> DataFrame:
    """Keep, drop, rename and cast columns.

    ``keep_unknown`` also keeps every column named in neither list. Casts that
    fail give NULL.
    """
    rename, types = rename or {}, types or {}
    gone = set(drop)
    if keep_unknown:
        wanted = [c for c in df.columns if c not in gone]
    else:
        wanted = [c for c in keep if c not in gone]
    columns = []
    for name in wanted:
        column = F.col(name).try_cast(types[name]) if name in types else F.col(name)
        columns.append(column.alias(rename.get(name, name)))
    return df.select(*columns)


def formula(df: DataFrame, fields: Sequence[tuple[str, Column | str] | tuple[str, Column | str, str]]) -> DataFrame:
    """Create or overwrite columns in order; a later field sees the earlier ones.

    Each field is ``(name, expression)`` or ``(name, expression, type)``.
    """
    for name, expression, *kind in fields:
        column = F.expr(expression) if isinstance(expression, str) else expression
        df = df.withColumn(name, column.try_cast(kind[0]) if kind else column)
    return df


def formula_multi_field(
    df: DataFrame,
    columns: Sequence[str],
    function: Callable[[Column], Column],
    prefix: str = "",
) -> DataFrame:
    """Apply one expression to many columns, in place or as ``prefix`` + name."""
    return df.withColumns({prefix + c: function(F.col(c)) for c in columns})


def cleanse(
    df: DataFrame, columns: Sequence[str], upper_case: bool = True, trim_spaces: bool = True
) -> DataFrame:
    """Trim and upper-case text columns; names that do not exist are ignored."""
    changed, present = {}, set(df.columns)
    for name in columns:
        if name in present:
            column = F.col(name)
            if trim_spaces:
                column = F.trim(column)
            if upper_case:
                column = F.upper(column)
            changed[name] = column
    return df.withColumns(changed) if changed else df


def try_cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the named columns that exist; a value that does not fit becomes NULL."""
    present = set(df.columns)
    return df.withColumns(
        {name: F.col(name).try_cast(kind) for name, kind in types.items() if name in present}
    )


def band(column: Column, rules: Sequence[tuple[str, object, object]], otherwise: object) -> Column:
    """First matching rule's label; ``otherwise`` also catches NULL.

    A rule is ``(op, bound, label)`` with op one of ``< <= > >= = in``.
    """
    tests = {
        "<": lambda bound: column < bound,
        "<=": lambda bound: column <= bound,
        ">": lambda bound: column > bound,
        ">=": lambda bound: column >= bound,
        "=": lambda bound: column == bound,
        "in": lambda bound: column.isin(*bound),
    }
    chain = F
    for op, bound, label in rules:
        chain = chain.when(tests[op](bound), F.lit(label))
    return chain.otherwise(F.lit(otherwise))


def percent_of(part: Column, whole: Column, otherwise: float | None = 0.0) -> Column:
    """``round(100 * part / whole, 2)``, or ``otherwise`` where whole is not positive."""
    guarded = F.when(whole > 0, whole)
    return F.when(whole > 0, F.round(part / guarded * 100, 2)).otherwise(
        F.lit(otherwise).cast("double")
    )


def fill_nulls(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Fill NULLs in the named columns that exist."""
    columns = set(df.columns)
    present = {name: value for name, value in values.items() if name in columns}
    return df.fillna(present) if present else df


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename after trimming blanks around the headers; absent names are ignored."""
    trimmed = {c: c.strip() for c in df.columns if c != c.strip()}
    return df.withColumnsRenamed(trimmed).withColumnsRenamed(dict(names))
