"""Column helpers for money and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wide enough that a sum of doubles becomes order-independent, and therefore
# repeatable, before it is rounded to cents.
EXACT = "decimal(28,8)"
MONEY = "decimal(18,2)"


def exact_sum(amount: str | Column) -> Column:
    """Sum a double column in decimal, rounded to cents.

    Float addition depends on partition order; decimal addition does not. NaN
    and out-of-range amounts have no decimal form and count as missing instead
    of failing the job.
    """
    column = F.col(amount) if isinstance(amount, str) else amount
    return F.round(F.sum(column.try_cast(EXACT)), 2).cast(MONEY)


def ratio(numerator: str, denominator: str, places: int | None = None) -> Column:
    """Null-safe division in double; NULL when the denominator is zero."""
    top, bottom = (F.col(c).cast("double") for c in (numerator, denominator))
    value = top / F.nullif(bottom, F.lit(0.0))
    return value if places is None else F.round(value, places)
