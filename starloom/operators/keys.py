"""Distributed dense surrogate keys (WN2, WN3, WN4).

``Window.orderBy(...)`` without a partition (the reference's key assignment)
moves every row into one task. Instead:

1. range-partition on the business order and sort inside each partition;
2. tag rows with ``monotonically_increasing_id`` = (partition << 33) + position;
3. store (in ``spark.checkpoint.dir``) so the layout and the tags are fixed
   and survive executor loss;
4. count rows per partition (one tiny aggregate, at most N rows), turn the
   counts into start offsets, and broadcast that table (its size is bounded
   by the number of partitions, not by the data);
5. key = start + offset(partition) + position.

The result equals ``row_number() over (order by keys) - 1 + start`` when
the order columns are unique.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from starloom.functions.plan import bounded_broadcast
from starloom.session import stored

_POS_BITS = 33
_MID = "_sl_mid"
_PID = "_sl_pid"
_OFF = "_sl_off"


def _partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return num_partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def dense_key(df: DataFrame, order_cols: list[str], key_col: str, start: int | Column = 0,
              num_partitions: int | None = None) -> DataFrame:
    """Append ``key_col`` = start + 0-based rank of each row in ``order_cols``
    order (columns must form a unique, total order). The stored copy that fixes
    the layout also cuts the lineage, so everything built on the keyed table
    (a dimension feeding a fact) reads stored rows instead of re-running
    staging."""
    n = _partitions(df, num_partitions)
    tagged = stored(
        df.repartitionByRange(n, *order_cols)
        .sortWithinPartitions(*order_cols)
        .withColumn(_MID, F.monotonically_increasing_id()), "keys")
    pid = F.shiftright(F.col(_MID), _POS_BITS)
    counts = tagged.groupBy(pid.alias(_PID)).agg(F.count(F.lit(1)).alias("_sl_n"))
    # running total over <= n rows: a single-partition window on a bounded table
    offsets = counts.select(
        _PID, (F.sum("_sl_n").over(Window.orderBy(_PID)) - F.col("_sl_n")).alias(_OFF)
    )
    pos = F.col(_MID).bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    start_col = start if isinstance(start, Column) else F.lit(start)
    return (
        tagged.join(bounded_broadcast(offsets, n), pid == F.col(_PID))
        .withColumn(key_col, (start_col + F.col(_OFF) + pos).cast("long"))
        .drop(_MID, _PID, _OFF)
        .select(key_col, *df.columns)
    )


def next_key_start(existing: DataFrame, key_col: str) -> int:
    """WN4: first free key = max(existing) + 1, or 0 for an empty table (one
    scalar from a one-row aggregate)."""
    row = existing.agg(F.max(key_col).alias("m")).first()
    return 0 if row is None or row["m"] is None else int(row["m"]) + 1


def continue_keys(existing: DataFrame, additions: DataFrame, key_col: str,
                  order_cols: list[str], num_partitions: int | None = None) -> DataFrame:
    """Keys for ``additions`` continuing after the highest key of ``existing``,
    ordered by ``order_cols``."""
    return dense_key(additions, order_cols, key_col, next_key_start(existing, key_col), num_partitions)
