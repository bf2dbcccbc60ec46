"""Money and ratio expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(value: Column, precision: int = 14) -> Column:
    return value.cast(f"decimal({precision},2)")


def mean_scaled(value: Column, precision: int = 14) -> Column:
    """Average rounded once, half away from zero, to two decimals; NULL over no rows.

    ``value`` has two decimals at most. The division is one of whole hundredths: a rounded
    quotient, rounded again, could be one hundredth off.
    """
    return mean_of(F.sum(value.cast("decimal(20,2)")), F.count(value), precision)


def mean_of(total: Column, count: Column, precision: int = 14) -> Column:
    """``mean_scaled`` of values whose exact sum and count are known; NULL for a count of zero."""
    n = F.nullif(count.cast("decimal(19,0)"), F.lit(0))
    hundredths = (total * 100).cast("decimal(34,0)")
    doubled = F.abs(hundredths) * 2 + n
    whole = F.call_function("div", doubled, n * 2)
    signed = F.when(hundredths < 0, -whole).otherwise(whole)
    return (signed.cast("decimal(22,0)") / 100).cast(f"decimal({precision},2)")


def mean_money(value: Column) -> Column:
    """Average rounded half up to cents; NULL over no rows."""
    return mean_scaled(value)


def rate_pct(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent, two decimals; NULL when either is missing or zero."""
    return F.round(part * F.lit(100.0).cast("decimal(4,1)") / F.nullif(whole, F.lit(0)), 2).cast(
        "decimal(6,2)"
    )


def net_amount(amount: Column, fee: Column) -> Column:
    return money(amount - fee)


def fee(amount: Column, pct: Column, flat: Column) -> Column:
    """Percentage plus flat fee, rounded half up to cents."""
    return money(F.round(amount * pct + flat, 2), 10)
