"""Null-aware predicates (NUL1-NUL5, FLT3)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F


def any_distinct(pairs: list[tuple[Column, Column]]) -> Column:
    """NUL4: true when any pair differs null-safely (``IS DISTINCT FROM``);
    NULL vs NULL is equal, NULL vs value is a change."""
    if not pairs:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [~a.eqNullSafe(b) for a, b in pairs])


def typed_null(type_name: str) -> Column:
    """NUL5: ``lit(None).cast(type)``."""
    return F.lit(None).cast(type_name)


def within_validity(ts: Column, start: Column, end: Column) -> Column:
    """FLT3: half-open validity ``start <= ts < end`` where a NULL end is open."""
    return (ts >= start) & (end.isNull() | (ts < end))
