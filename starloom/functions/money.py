"""Exact decimal money arithmetic (NUM1-NUM6, NUL2, AG10)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def line_total(quantity="quantity", unit_price="unit_price", discount="discount") -> Column:
    """NUM1: ``quantity * unit_price - discount``; the discount is an absolute
    amount per line, not per unit. int * decimal(10,2) - decimal(10,2) is an
    exact decimal(22,2)."""
    return _c(quantity) * _c(unit_price) - _c(discount)


def gross_value(quantity="quantity", unit_price="unit_price") -> Column:
    """NUM5: ``quantity * unit_price``."""
    return _c(quantity) * _c(unit_price)


def unit_margin(unit_price="unit_price", cost_price="cost_price") -> Column:
    """NUM2: ``unit_price - cost_price`` (decimal(11,2), may be negative)."""
    return _c(unit_price) - _c(cost_price)


def round2(c: str | Column) -> Column:
    """NUM3: HALF_UP rounding to cents."""
    return F.round(_c(c), 2)


def safe_ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """NUL2 / AG10: ``numerator / NULLIF(denominator, 0)`` in double; ANSI mode
    would raise on a zero divisor, NULLIF turns it into NULL instead."""
    return _c(numerator).cast("double") / F.nullif(_c(denominator), F.lit(0)).cast("double")


def exact(c: str | Column) -> Column:
    """A money total as DECIMAL in cents, wide enough for any table."""
    return _c(c).cast("decimal(38,2)")


def as_double(c: str | Column) -> Column:
    """Exact decimal result exposed as double (sum first, convert once)."""
    return _c(c).cast("double")


def off_by_more_than(a: str | Column, b: str | Column, tol: float) -> Column:
    """NUM4: ``abs(a - b) > tol``; NULL operands give NULL (never a violation)."""
    return F.abs(_c(a) - _c(b)) > F.lit(tol)
