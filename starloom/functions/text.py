"""Text cleaning expressions (STR1-STR3). All JVM-side, codegen'd."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def clean(c: str | Column) -> Column:
    """STR1: strip leading/trailing spaces."""
    return F.trim(F.col(c) if isinstance(c, str) else c)


def lower_clean(c: str | Column) -> Column:
    """STR2: ``lower(trim(c))`` for e-mails and status codes."""
    return F.lower(clean(c))


def title_clean(c: str | Column) -> Column:
    """STR3: ``initcap(trim(c))``; lower-cases the rest of each word."""
    return F.initcap(clean(c))


RULES = {"trim": clean, "lower": lower_clean, "initcap": title_clean}


def apply_rule(rule: str, c: str | Column) -> Column:
    try:
        return RULES[rule](c)
    except KeyError:
        raise ValueError(f"unknown text rule {rule!r}; expected one of {sorted(RULES)}") from None
