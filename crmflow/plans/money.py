"""Exact money sums.

Sums of doubles depend on the order of addition, so they change from run to run. Amounts are
therefore summed as decimals, in ten-thousandths with six more places, which is exact and
order-free, and turned into a double at the end.

One rule holds for sums, means, counts, largest and smallest amounts: an amount is a finite
number below ``TOO_LARGE``; everything else (NULL, NaN, infinities) is none. An amount is the
decimal number that is written shortest for its double; beyond ten places it is rounded.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

UNITS_PER_ONE = 10_000
#: Amounts from here on are none; sums of ten thousand million smaller ones fit.
TOO_LARGE = 1e18
#: Below this, whole ten-thousandths fit a bigint and a double tells them apart.
_PLAIN = 1e11
_UNITS = "decimal(38,6)"


def is_amount(amount: Column) -> Column:
    """True for what counts as an amount, whatever its number of places."""
    return F.coalesce(F.abs(amount) < F.lit(TOO_LARGE), F.lit(False)) & ~F.isnan(amount.cast("double"))


def units(amount: Column) -> Column:
    """Amount in ten-thousandths, exactly; NULL for what is no amount.

    Amounts of up to four places, which are nearly all, are scaled as doubles: turning a double
    into a decimal goes through its text. ``rint`` stays a primitive operation, where ``round``
    goes through a decimal object per row.
    """
    number = amount.cast("double")
    scaled = F.rint(number * UNITS_PER_ONE)
    plain = (F.abs(number) < F.lit(_PLAIN)) & (scaled / F.lit(float(UNITS_PER_ONE)) == number)
    odd = F.when(is_amount(amount), amount.cast("decimal(28,10)") * F.lit(UNITS_PER_ONE))
    return F.when(plain, scaled.try_cast("bigint").cast(_UNITS)).otherwise(odd.cast(_UNITS))


def from_units(total: Column) -> Column:
    return total.cast("double") / F.lit(float(UNITS_PER_ONE))


def mean_of_units(total: Column, rows: Column) -> Column:
    """Mean amount; NULL without rows."""
    return F.when(rows > 0, from_units(total) / rows)
