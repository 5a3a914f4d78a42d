"""Decimal money and guarded ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
MONEY_SUM = "decimal(38,2)"


def money(value: Column) -> Column:
    """Fix a derived amount to the declared money type; cents round half up."""
    return value.cast(MONEY)


def to_usd(amount: Column, rate: Column) -> Column:
    """Convert with an exchange rate; a missing rate counts as 1."""
    return money(F.round(amount * F.coalesce(rate, F.lit(1).cast("decimal(5,4)")), 2))


def round_half_away(value: Column, digits: int) -> Column:
    """Binary rounding of a double: scale, round to a whole number, scale back.

    ``F.round`` on a double rounds its shortest decimal text instead, which differs
    for values such as 1.005.
    """
    scale = F.lit(float(10**digits))
    return F.round(value.cast("double") * scale) / scale


def ratio(numerator: Column, denominator: Column, digits: int | None = None) -> Column:
    """Double quotient, NULL where the divisor is zero."""
    quotient = numerator.cast("double") / F.nullif(
        denominator.cast("double"), F.lit(0.0)
    )
    return quotient if digits is None else round_half_away(quotient, digits)
