"""Exact money (F2, C9): amounts of 29 integer and 9 fraction digits, as wide as the
warehouse's numeric type, converted and multiplied without losing a digit.

Spark's decimals end at 38 digits, so ``decimal(38,9) * decimal(12,6)`` would drop
fraction digits (and round twice). A wide amount is taken apart into two limbs,

    amount = high * 10^10 + low        high: 19 digits, low: 10 integer and 9 fraction digits

whose products with a rate fit: the high one is a whole number (rates have 6 fraction
digits and 10^10 covers them), the low one is rounded half up to cents and carried into
it. Both limbs have the sign of the amount, so rounding is away from zero on either side.
Amounts below 10^16 take the plain product, which is exact in 38 digits.

Results past decimal(38,2) are null; ``is_lost`` tells such a null from a missing input.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNT_TYPE = "decimal(38,9)"
CENT_TYPE = "decimal(38,2)"
RATE_TYPE = "decimal(12,6)"

_LIMB = 10 ** 10
_RATE_UNIT = 10 ** 6
_PLAIN = Decimal(10 ** 16 - 1)


def convert(amount: Column, rate: Column) -> Column:
    """ROUND(amount * rate, 2), half away from zero, as ``CENT_TYPE``."""
    a, r = amount.cast(AMOUNT_TYPE), rate.cast(RATE_TYPE)
    plain = F.round(a.cast("decimal(25,9)") * r, 2).cast(CENT_TYPE)
    limb = F.lit(Decimal(_LIMB))
    low = (a % limb).cast("decimal(19,9)")
    high = ((a - low) / limb).cast("decimal(19,0)")
    units = (r * F.lit(Decimal(_RATE_UNIT))).cast("decimal(12,0)")
    whole = high * units * F.lit(Decimal(_LIMB // _RATE_UNIT))          # decimal(38,0)
    wide = (whole + F.round(low * r, 2).cast("decimal(20,2)")).cast(CENT_TYPE)
    # no abs or minus: Spark negates decimals in 34 digits
    return F.when(a.between(F.lit(-_PLAIN), F.lit(_PLAIN)), plain).otherwise(wide)


def times(amount: Column, quantity: Column) -> Column:
    """amount * quantity in cents, exact; null past ``CENT_TYPE``."""
    return F.try_multiply(amount.cast(CENT_TYPE), quantity.cast("decimal(10,0)"))


def total(amount: Column) -> Column:
    """Sum, null past the type."""
    return F.try_sum(amount)


def is_lost(result: Column, *inputs: Column) -> Column:
    """All inputs are there, the result is not."""
    there = F.lit(True)
    for c in inputs:
        there = there & c.isNotNull()
    return there & result.isNull()
