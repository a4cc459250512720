"""Exact decimal arithmetic for the gross -> net-invoice -> net chain.

Prices are DECIMAL(15,4) and deduction rates DECIMAL(5,4) fractions.  Every
step is kept exact (no silent rounding): Spark caps decimal precision at 38
and, past it, rounds the scale, so the intermediates are narrowed to widths
that still hold every realistic amount:

* gross       = qty * price                          DECIMAL(26,4)  exact
* net invoice = gross - gross * pre  -> DECIMAL(30,8)               exact
  (|gross| < 2.2e20 since qty is INT and a DECIMAL(15,4) price is < 1e11,
  and |rate| < 10, so |net invoice| < 2.5e21 fits 22 integer digits)
* net         = nis - nis * (discounts + other)      DECIMAL(38,12) exact

Sums of DECIMAL(38,12) stay DECIMAL(38,12); a sum is scaled to millions
inside DECIMAL(30,12) (totals below 1e18; ANSI mode raises rather than
wraps beyond).  Reports round once, at the very end (ROUND half away from
zero, like the reference engine), and are returned as DECIMAL.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

NET_INVOICE_TYPE = "decimal(30,8)"
# A summed amount is narrowed to 18 integer digits before scaling to
# millions so that sum * 0.000001 stays inside 38 digits exactly.
SUM_TYPE = "decimal(30,12)"
MILLION = Decimal("0.000001")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def gross_amount(qty: str | Column, price: str | Column) -> Column:
    """sold quantity x gross price (exact)."""
    return _col(qty) * _col(price)


def net_invoice_amount(gross: str | Column, pre_rate: str | Column) -> Column:
    """gross - gross * pre-invoice rate (exact)."""
    g = _col(gross)
    return (g - g * _col(pre_rate)).cast(NET_INVOICE_TYPE)


def net_amount(net_invoice: str | Column, discounts: str | Column, other: str | Column) -> Column:
    """nis - nis * (discounts + other deductions): the two post-invoice rates
    are added, then applied to the already discounted amount (exact)."""
    nis = _col(net_invoice)
    return nis - nis * (_col(discounts) + _col(other))


def to_money(total: str | Column, scale: int = 2) -> Column:
    """ROUND(total, scale), half away from zero (DECIMAL)."""
    return F.round(_col(total), scale)


def to_millions(total: str | Column, scale: int = 2) -> Column:
    """ROUND(total / 1,000,000, scale): exact in decimals, rounded once, half
    away from zero (DECIMAL)."""
    return F.round(_col(total).cast(SUM_TYPE) * F.lit(MILLION), scale).cast("decimal(26,2)")


def accuracy_pct(abs_error_sum: str | Column, forecast_sum: str | Column) -> Column:
    """ROUND((forecast - abs_error) / forecast * 100, 2) of integer sums, rounded
    once, half away from zero (DECIMAL).

    With n = 10000 * (f - a) the result is sign * floor((2|n| + |f|) / (2|f|)) /
    100, all in exact integers: floor(x / y) = (x - pmod(x, y)) / y has no
    remainder that decimal division could round.  A zero forecast sum gives NULL
    (the reference engine's division by zero), never an error.
    """
    a = _col(abs_error_sum).cast("decimal(38,0)")
    f = _col(forecast_sum).cast("decimal(38,0)")
    n = (F.lit(10000) * (f - a)).cast("decimal(38,0)")
    twice = (F.lit(2) * F.abs(f)).cast("decimal(38,0)")
    x = (F.lit(2) * F.abs(n) + F.abs(f)).cast("decimal(38,0)")
    q = ((x - F.pmod(x, twice)) / twice).cast("decimal(20,0)")
    sign = (F.signum(n) * F.signum(f)).cast("decimal(1,0)")
    return F.when(f != 0, (sign * q * F.lit(Decimal("0.01"))).cast("decimal(24,2)"))
