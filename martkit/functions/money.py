"""Money as exact decimals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(c, precision: int = 14, scale: int = 2) -> Column:
    """Column as a decimal, rounded half up."""
    return F.col(c).cast(f"decimal({precision},{scale})") if isinstance(c, str) else c.cast(
        f"decimal({precision},{scale})"
    )


def signed_amount(amount, status, refunded: str = "refunded") -> Column:
    """Amount with the sign flipped for refunds (PRJ-5)."""
    amount, status = _col(amount), _col(status)
    return F.when(status == refunded, -amount).otherwise(amount)


def ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """Rounded quotient, null when the denominator is 0 (AG-6)."""
    return F.round(F.try_divide(numerator, denominator), digits)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c
