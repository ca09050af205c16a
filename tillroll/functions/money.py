"""Exact arithmetic: decimals in, decimals out, halves rounded away from zero."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

PRICE = "decimal(12,3)"
LINE_VALUE = "decimal(14,3)"
MONEY = "decimal(24,3)"
CENTS = "decimal(24,2)"

_WIDE = "decimal(30,3)"


def ratio(num: Column, den: Column, places: int, precision: int = 18) -> Column:
    """num / den rounded to `places`; NULL when the denominator is zero.

    Works on the integer quotient of doubled operands, so no intermediate rounding can
    move a result across a half. Decimal division would cut the scale first.
    """
    scale = 10**places
    top = F.abs(num.cast(_WIDE)) * F.lit(2 * scale)
    bottom = F.nullif(F.abs(den.cast(_WIDE)), F.lit(0).cast(_WIDE))
    units = F.call_function("div", top + bottom, bottom * F.lit(2))
    signed = F.when((num < 0) != (den < 0), -units).otherwise(units)
    step = F.lit(Decimal(1).scaleb(-places))
    return (signed.cast("decimal(19,0)") * step).cast(f"decimal({precision},{places})")


def thousandths(amount: Column) -> Column:
    """An amount with three decimals as a whole number, for ranking and summing.

    A sum of these needs no decimal objects, which about halves the cost of an aggregate. It
    is exact up to 9.2e15 units of money per group; beyond that it raises, as ANSI sums do.
    """
    return (amount.cast(MONEY) * F.lit(1000)).cast("bigint")


def from_thousandths(whole: Column) -> Column:
    return (whole.cast("decimal(20,0)") * F.lit(Decimal("0.001"))).cast(MONEY)


def hundredths(amount: Column) -> Column:
    return (amount.cast(CENTS) * F.lit(100)).cast("bigint")


def total_or_zero(amount: Column, dtype: str = MONEY) -> Column:
    return F.coalesce(amount.cast(dtype), F.lit(0).cast(dtype))
