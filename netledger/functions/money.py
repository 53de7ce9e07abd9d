"""Exact fee arithmetic on decimals."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

CENT = Decimal("0.01")

# Settlement flags that mean "cleared".
CLEARED = ["1", "2", "3", "4", "5", "6"]

# Fee types, percentage and fixed amount.
RATE_TYPE = "10"
FIXED_TYPE = "11"


def is_cleared(sett_flg: Column) -> Column:
    """True for the cleared flags, false for every other or missing flag."""
    return F.coalesce(sett_flg.isin(*CLEARED), F.lit(False))


def to_yuan(cents: Column) -> Column:
    return cents * F.lit(CENT)


def is_supported(calc_type: Column) -> Column:
    return F.coalesce(calc_type.isin(RATE_TYPE, FIXED_TYPE), F.lit(False))


def raw_fee(amount: Column, calc_type: Column, rate: Column, fixed: Column,
            rate_divisor: int = 100) -> Column:
    """Percentage or fixed fee before limits; other types cost nothing."""
    if rate_divisor not in (1, 100):
        raise ValueError("rate_divisor is 1 or 100")
    by_rate = amount * rate
    if rate_divisor == 100:
        by_rate = by_rate * F.lit(CENT)
    return (F.when(calc_type == RATE_TYPE, by_rate)
            .when(calc_type == FIXED_TYPE, fixed)
            .otherwise(F.lit(Decimal("0.00"))))


def clamp(fee: Column, low: Column, high: Column, unbounded_negative_cap: bool = False) -> Column:
    """Below ``low`` gives ``low``, else above ``high`` gives ``high``.

    With ``unbounded_negative_cap`` a negative upper limit means "no limit".
    """
    above = fee > high
    if unbounded_negative_cap:
        above = above & (high >= 0)
    return F.when(fee < low, low).when(above, high).otherwise(fee)


def signed_net(amount: Column, fee: Column, dc_flag: Column) -> Column:
    """Debit (1) takes the amount back, credit (-1) pays it out, less the fee."""
    return F.when(dc_flag == 1, fee - amount).when(dc_flag == -1, amount - fee)
