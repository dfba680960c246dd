"""Previous / next row within a key, without routing a key to one task.

``Window.partitionBy(key).orderBy(t)`` sends every row of a key to a single
task; with one key holding a third of the rows that task holds a third of
the data. Here the rows are *range*-partitioned on ``(key, order...)``, so a
hot key is spread over as many partitions as its share needs, and the
neighbour is computed in two parts:

1. inside each range slice: ``lag``/``lead`` over a window partitioned by
   (slice id, key), so a window group is at most one balanced slice;
2. at slice borders: the first row of a slice takes its predecessor from
   the last row of the previous non-empty slice (and symmetrically for the
   successor). Those border rows come from a per-slice aggregate with one
   row per slice, which is broadcast (size bounded by the partition count).

The ``order`` columns must make ``(keys, order)`` unique (a total order).
The neighbour columns are NULL where the neighbour belongs to another key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from starloom.functions.plan import bounded_broadcast
from starloom.session import stored

_PID = "_sl_pid"


def _n(df: DataFrame, n: int | None) -> int:
    return n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def sliced(df: DataFrame, sort_cols: list[str], n: int) -> DataFrame:
    """``df`` with a slice id column ``_sl_pid``: consecutive ranges of the
    ``sort_cols`` order of roughly equal size, by a range exchange whose result
    is stored (in the cluster's checkpoint dir) with the slice id as data: Spark seeds range-bound sampling with the RDD id, so
    two executions of one range exchange may cut differently."""
    return stored(df.repartitionByRange(n, *sort_cols).withColumn(_PID, F.spark_partition_id()), "slices")


def with_neighbours(df: DataFrame, keys: list[str], order: list[str], cols: list[str],
                    prev: bool = True, nxt: bool = False, num_partitions: int | None = None,
                    prefix_prev: str = "prev_", prefix_next: str = "next_",
                    keep_slice: bool = False, presliced: bool = False) -> DataFrame:
    """Add ``prev_<c>`` / ``next_<c>`` for every ``c`` in ``cols`` (values of the
    adjacent row of the same key in ``order``), plus ``prev_exists`` /
    ``next_exists`` flags. ``keep_slice`` also returns the slice id
    (``_sl_pid``) so a caller can run further per-slice steps on the same
    layout; ``presliced`` takes a ``df`` that already carries it (from
    ``sliced``, and stored, because two branches of the plan read it)."""
    sort_cols = [*keys, *order]
    carried = list(dict.fromkeys([*keys, *cols]))
    # The slice id is read by two branches of the plan (rows, per-slice
    # borders), so it must be the same in both: see ``sliced``.
    n = _n(df, num_partitions)
    ranged = df if presliced else sliced(df, sort_cols, n)
    # Window groups are (slice, key): a slice holds many keys, a hot key spans
    # many slices, so no group is larger than one slice and most are small.
    w = Window.partitionBy(_PID, *keys).orderBy(*order)
    packed = F.struct(*[F.col(c) for c in sort_cols + [c for c in carried if c not in sort_cols]])
    sort_key = F.struct(*[F.col(c) for c in sort_cols])

    def key_of(struct_col: str) -> F.Column:
        return F.struct(*[F.col(f"{struct_col}.{c}") for c in sort_cols])

    # one row per slice: its first/last row and the neighbouring slices' rows
    tiny = Window.orderBy(_PID)  # over one row per slice: bounded by the slice count
    border = ranged.groupBy(_PID).agg(F.min(packed).alias("_sl_first"), F.max(packed).alias("_sl_last"))
    border = border.select(
        _PID, key_of("_sl_first").alias("_sl_head_key"), key_of("_sl_last").alias("_sl_tail_key"),
        F.lag("_sl_last").over(tiny).alias("_sl_before"), F.lead("_sl_first").over(tiny).alias("_sl_after"))

    sel = [F.col(c) for c in ranged.columns]
    if prev:
        sel.append(F.lag(F.lit(1)).over(w).isNotNull().alias("_sl_pin"))
        sel += [F.lag(c).over(w).alias(f"_sl_p_{c}") for c in cols]
    if nxt:
        sel.append(F.lead(F.lit(1)).over(w).isNotNull().alias("_sl_nin"))
        sel += [F.lead(c).over(w).alias(f"_sl_n_{c}") for c in cols]
    out = ranged.select(*sel).join(bounded_broadcast(border, n), _PID, "left")

    def same_key(side: str) -> F.Column:
        cond = F.col(side).isNotNull()
        for k in keys:
            cond = cond & F.col(f"{side}.{k}").eqNullSafe(F.col(k))
        return cond

    final = [F.col(c) for c in df.columns if c != _PID] + ([F.col(_PID)] if keep_slice else [])
    if prev:
        # the first row of a slice takes its predecessor from the slice before
        head = sort_key.eqNullSafe(F.col("_sl_head_key"))
        across = same_key("_sl_before")
        final.append(F.when(head, across).otherwise(F.col("_sl_pin")).alias("prev_exists"))
        final += [F.when(head, F.when(across, F.col(f"_sl_before.{c}"))).otherwise(F.col(f"_sl_p_{c}"))
                  .alias(f"{prefix_prev}{c}") for c in cols]
    if nxt:
        tail = sort_key.eqNullSafe(F.col("_sl_tail_key"))
        across = same_key("_sl_after")
        final.append(F.when(tail, across).otherwise(F.col("_sl_nin")).alias("next_exists"))
        final += [F.when(tail, F.when(across, F.col(f"_sl_after.{c}"))).otherwise(F.col(f"_sl_n_{c}"))
                  .alias(f"{prefix_next}{c}") for c in cols]
    return out.select(*final)
