"""Presence, money and ratio expressions."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewrack import domain


def as_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def filled(value: str | Column) -> Column:
    """Present, for filters: one comparison that reaches the scan; null when null."""
    return as_column(value) > F.lit("")


def has(value: str | Column) -> Column:
    """True when present: neither null nor the empty string. Never null itself."""
    return F.coalesce(filled(value), F.lit(False))


def or_default(value: str | Column, default: str) -> Column:
    column = as_column(value)
    return F.when(has(column), column).otherwise(F.lit(default))


def any_of(conditions: list[Column]) -> Column:
    return reduce(or_, conditions)


def all_of(conditions: list[Column]) -> Column:
    return reduce(and_, conditions)


def money(value: str | Column) -> Column:
    return as_column(value).cast("decimal(18,2)")


def fx_rate(currency: str | Column) -> Column:
    """Fixed rate to GBP; null for a currency outside the table."""
    column = as_column(currency)
    chain = None
    for code, rate in domain.FX_TO_GBP.items():
        literal = F.lit(rate).cast("decimal(5,4)")
        chain = (
            F.when(column == code, literal) if chain is None else chain.when(column == code, literal)
        )
    return chain


def to_gbp(amount: str | Column, currency: str | Column) -> Column:
    return F.round(as_column(amount) * fx_rate(currency), 2).cast("decimal(18,2)")


def ratio(numerator: Column, denominator: Column, scale: int) -> Column:
    """Exact decimal quotient rounded half-up; 0 when the denominator is 0."""
    quotient = numerator.cast("decimal(20,0)") / F.when(
        denominator != 0, denominator.cast("decimal(20,0)")
    )
    return F.coalesce(F.round(quotient, scale), F.lit(0)).cast(f"decimal(9,{scale})")


def percentage(part: Column, whole: Column) -> Column:
    return ratio(part * 100, whole, 2)
