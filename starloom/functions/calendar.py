"""Calendar attribute expressions (DAT1-DAT5)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_of(ts: str | Column) -> Column:
    """DAT1: calendar day of a timestamp (``to_date``)."""
    return F.to_date(_c(ts))


def date_key(d: str | Column) -> Column:
    """DAT4: integer ``yyyyMMdd`` key computed arithmetically (no string
    formatting/parsing round trip)."""
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def month_name(d: str | Column) -> Column:
    return F.date_format(_c(d), "MMMM")


def day_name(d: str | Column) -> Column:
    return F.date_format(_c(d), "EEEE")


def calendar_columns(d: str = "full_date") -> dict[str, Column]:
    """DAT3/DAT4: the nine calendar attributes; ``day_of_week`` 1 = Sunday."""
    c = F.col(d)
    return {
        "date_key": date_key(c),
        "full_date": c,
        "day": F.dayofmonth(c),
        "month": F.month(c),
        "month_name": month_name(c),
        "quarter": F.quarter(c),
        "year": F.year(c),
        "day_of_week": F.dayofweek(c),
        "day_name": day_name(c),
    }


def start_of_day(d: str | Column) -> Column:
    """DAT5 / CST1: a date promoted to midnight, as timestamp without zone."""
    return _c(d).cast("timestamp_ntz")
