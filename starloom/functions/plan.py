"""Plan helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Row bound under which a table is broadcast explicitly. The tables broadcast
# by the operators have one row per partition/slice, so the bound is a known
# number before anything runs; beyond it the planner decides (sort-merge or
# AQE's runtime broadcast when the measured size is small).
BROADCAST_ROW_LIMIT = 200_000


def bounded_broadcast(df: DataFrame, row_bound: int, limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """``broadcast(df)`` when ``df`` is known to hold at most ``row_bound``
    rows and that bound is under ``limit``; otherwise ``df`` unchanged."""
    return F.broadcast(df) if row_bound <= limit else df
