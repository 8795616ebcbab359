"""Arithmetic behind the payment advice."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine import fixed_values as fixed


def interest_factor(rate_pct: float | None) -> Column:
    """``1 + rate/100``; an unknown rate gives NULL."""
    return F.lit(None if rate_pct is None else 1 + rate_pct / 100).cast("double")


def cash_price(price: Column, discount: Column) -> Column:
    return F.round(price - price * discount, 2)


def instalment_total(value: Column, count: Column) -> Column:
    return F.round(value * count, 2)


def cash_saving(price: Column, discounted: Column) -> Column:
    return F.round(price - discounted, 2)


def instalment_saving(price: Column, total: Column, factor: Column) -> Column:
    """What the price difference earns at the rate, never below zero."""
    gain = (price - total) * factor
    return F.when(gain <= 0, F.lit(0.0)).otherwise(F.round(gain, 2))


def instalment_discount_pct(price: Column, total: Column) -> Column:
    """Discount hidden in the instalments, 0 to 100; NULL for a zero price."""
    return F.round(F.lit(100.0) - F.try_divide(total, price) * 100, 2)


def advice(discount: Column, pct: Column) -> Column:
    """The larger discount wins; equal or unknown gives no advice."""
    return (
        F.when(discount < pct, fixed.ADVICE_INSTALMENTS)
        .when(discount > pct, fixed.ADVICE_CASH)
        .otherwise(fixed.ADVICE_NONE)
    )
