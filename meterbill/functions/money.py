"""Exact money arithmetic: decimals in, rounded doubles out."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterbill.schemas import MONEY, PRICE


def dlit(value: str) -> Column:
    """Decimal literal with its own precision, e.g. dlit('1.20') -> DECIMAL(3,2)."""
    return F.lit(Decimal(value))


def as_price(c: Column) -> Column:
    return c.cast(PRICE)


def as_money(c: Column) -> Column:
    return c.cast(MONEY)


def out_money(c: Column, digits: int = 2) -> Column:
    """Round an exact amount half-up and hand it out as DOUBLE."""
    return F.round(c, digits).cast(T.DoubleType())


def out_ratio(num: Column, den: Column, digits: int = 4, scale: int | None = None) -> Column:
    """(num [* scale]) / den as DOUBLE rounded to ``digits``; NULL when den is
    0 or NULL. Ratios are reporting values, so double division is used (the
    same arithmetic any SQL engine applies to a decimal quotient)."""
    n = num.cast(T.DoubleType())
    if scale is not None:
        n = n * F.lit(float(scale))
    return F.round(F.try_divide(n, den.cast(T.DoubleType())), digits)
