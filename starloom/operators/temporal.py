"""Point-in-time (validity interval) joins (JN4, JN5, DQ18).

A fact at time ``ts`` matches the version of its key with
``effective_from <= ts < effective_to`` (NULL ``effective_to`` = open).

Catalyst plans this as an equi-join on the key with the interval as a
residual predicate; AQE splits skewed key partitions on the fact side.
A key with many versions and many facts would compare all of the one with all
of the other. ``interval_index`` parts them: a version is stored under the few
canonical time cells that make up its interval (cells of 8, 64, 512 ... seconds,
the largest that fit), and a fact looks into the one cell of each size that
holds its time. An interval of n seconds has at most 14 cells per size, open
or century-long ones included, and versions of a key that do not overlap
share no cell but those of one second. ``asof_join`` avoids pairing altogether
(time-ordered stream per key).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from starloom.functions.nulls import within_validity
from starloom.functions.plan import bounded_broadcast
from starloom.operators.sequence import sliced


CELL_BITS = 3        # a cell holds 8 of the next smaller size
CELL_LEVELS = 13     # sizes; 8**13 seconds reach beyond the year 9999
MANY_VERSIONS = 64   # versions from which a key's are indexed


def _seconds(ts: Column) -> Column:
    """Whole seconds of a time without zone, from 1970 (negative before)."""
    day = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    return day * 86_400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def _cells_between(low: Column, high: Column, level: int) -> Column:
    cell = F.transform(F.sequence(low, high - 1), lambda c: F.struct(F.lit(level).alias("level"), c.alias("cell")))
    return F.when(low < high, cell).otherwise(F.array().cast("array<struct<level:int,cell:bigint>>"))


def interval_cells(valid_from: Column, valid_to: Column) -> Column:
    """Canonical cells (level, cell) covering [valid_from, valid_to); a NULL end
    is open. At each size the cells that fit into the interval but into no
    larger cell that fits."""
    a = _seconds(valid_from)
    last = (1 << CELL_BITS * CELL_LEVELS) - 1
    b = F.least(F.coalesce(_seconds(valid_to) + 1, F.lit(last)), F.lit(last))  # the second of the end is partly in
    parts = []
    for level in range(CELL_LEVELS):
        def edge(x: Column, up: bool, at: int) -> Column:
            return F.shiftright(x + ((1 << CELL_BITS * at) - 1 if up else 0), CELL_BITS * at)
        low, high = edge(a, True, level), edge(b, False, level)
        if level == CELL_LEVELS - 1:
            parts.append(_cells_between(low, high, level))
            continue
        inner_low, inner_high = edge(a, True, level + 1) * (1 << CELL_BITS), edge(b, False, level + 1) * (1 << CELL_BITS)
        covered = inner_low < inner_high
        parts.append(_cells_between(low, F.when(covered, inner_low).otherwise(high), level))
        parts.append(_cells_between(F.when(covered, inner_high).otherwise(high), high, level))
    return F.concat(*parts)


def interval_index(versions: DataFrame, valid_from: str = "effective_from", valid_to: str = "effective_to") -> DataFrame:
    """``versions``, each once per cell of its interval: ``_sl_level``, ``_sl_cell``.
    A version that ends before it starts, or has no start, has no cells."""
    cells = F.explode(interval_cells(F.col(valid_from), F.col(valid_to)))
    return versions.withColumn("_sl_at", cells).select(
        *versions.columns, F.col("_sl_at.level").alias("_sl_level"), F.col("_sl_at.cell").alias("_sl_cell"))


def point_in_time_join(facts: DataFrame, versions: DataFrame, key: str, ts: str,
                       how: str = "inner", valid_from: str = "effective_from",
                       valid_to: str = "effective_to", many: int | None = None) -> DataFrame:
    """Join each fact row to the version valid at its ``ts``.

    Output: every fact column plus every version column except ``key``.
    ``many``: keys with more than so many versions meet through the interval
    index (inner joins only); one job counts the versions of each key."""
    if many is not None:
        if how != "inner":
            raise ValueError("the interval index serves inner joins")
        return _indexed_join(facts, versions, key, ts, valid_from, valid_to, many)
    f = facts.alias("_f")
    v = versions.alias("_v")
    cond = (F.col(f"_f.{key}") == F.col(f"_v.{key}")) & within_validity(
        F.col(f"_f.{ts}"), F.col(f"_v.{valid_from}"), F.col(f"_v.{valid_to}"))
    return f.join(v, cond, how).select(*_joined_columns(facts, versions, key))


def _joined_columns(facts: DataFrame, versions: DataFrame, key: str) -> list[Column]:
    return ([F.col(f"_f.{c}") for c in facts.columns]
            + [F.col(f"_v.{c}") for c in versions.columns if c != key and c not in facts.columns])


def _indexed_join(facts: DataFrame, versions: DataFrame, key: str, ts: str, valid_from: str, valid_to: str,
                  many: int) -> DataFrame:
    long = versions.groupBy(key).count().filter(F.col("count") > many).select(F.col(key).alias("_sl_key")).checkpoint(eager=True)
    n = long.count()
    if not n:
        return point_in_time_join(facts, versions, key, ts, "inner", valid_from, valid_to)
    long = bounded_broadcast(long, n)
    cond = F.col(key) == F.col("_sl_key")
    plain = point_in_time_join(facts.join(long, cond, "left_anti"), versions.join(long, cond, "left_anti"), key, ts,
                               "inner", valid_from, valid_to)
    cells = interval_index(versions.join(long, cond, "left_semi"), valid_from, valid_to).checkpoint(eager=True)
    used = sorted(r[0] for r in cells.select("_sl_level").distinct().collect())  # at most CELL_LEVELS numbers
    seconds = _seconds(F.col(ts))
    probes = F.array(*[F.struct(F.lit(level).alias("level"), F.shiftright(seconds, CELL_BITS * level).alias("cell"))
                       for level in used])
    f = (facts.join(long, cond, "left_semi").withColumn("_sl_at", F.explode(probes))
         .withColumns({"_sl_level": F.col("_sl_at.level"), "_sl_cell": F.col("_sl_at.cell")}).alias("_f"))
    v = cells.alias("_v")
    same = [F.col(f"_f.{c}") == F.col(f"_v.{c}") for c in (key, "_sl_level", "_sl_cell")]
    hit = same[0] & same[1] & same[2] & within_validity(
        F.col(f"_f.{ts}"), F.col(f"_v.{valid_from}"), F.col(f"_v.{valid_to}"))
    return plain.unionByName(f.join(v, hit).select(*_joined_columns(facts, versions, key)))


def version_match_count(facts: DataFrame, versions: DataFrame, fact_id: str, key: str, ts: str,
                        version_key: str, valid_from: str = "effective_from",
                        valid_to: str = "effective_to", many: int | None = None) -> DataFrame:
    """JN5: number of versions matching each fact (0, 1 or many): a left
    point-in-time join, then ``count(version_key)`` per fact id. With ``many``,
    matches are counted through the interval index and facts without one added."""
    f, v = facts.select(fact_id, key, ts), versions.select(key, version_key, valid_from, valid_to)
    if many is None:
        joined = point_in_time_join(f, v, key, ts, how="left", valid_from=valid_from, valid_to=valid_to)
        return joined.groupBy(fact_id).agg(F.count(version_key).cast("long").alias("match_count"))
    found = point_in_time_join(f, v, key, ts, "inner", valid_from, valid_to, many).select(fact_id, version_key)
    none = facts.select(fact_id, F.lit(None).cast(versions.schema[version_key].dataType).alias(version_key))
    return found.unionByName(none).groupBy(fact_id).agg(F.count(version_key).cast("long").alias("match_count"))


def asof_join(facts: DataFrame, versions: DataFrame, key: str, ts: str, how: str = "inner",
              valid_from: str = "effective_from", valid_to: str = "effective_to",
              num_partitions: int | None = None) -> DataFrame:
    """Point-in-time join that never pairs a key's facts with all of its
    versions: facts and version starts are merged into one time-ordered
    stream per key and every fact takes the latest version started at or
    before it (then ``ts < effective_to`` is checked). For dimensions whose
    versions of one key do not overlap (a valid SCD2) it returns what
    ``point_in_time_join`` returns; with overlaps it returns the latest-started
    version only.

    The stream is cut into slices of (key, time) order (``sequence.sliced``),
    so a key with a third of all facts is spread over many slices; the latest version
    reaching into a slice from earlier slices comes from a table with one row
    per slice (broadcast, bounded by the slice count)."""
    from pyspark.sql.types import StructType

    vcols = [c for c in versions.columns if c != key]
    fstruct = StructType(facts.schema.fields)
    vstruct = StructType([versions.schema[c] for c in vcols])
    t, kind, pid = "_sl_t", "_sl_kind", "_sl_pid"
    f = facts.select(F.col(key), F.col(ts).alias(t), F.lit(1).alias(kind),
                     F.struct(*[F.col(c) for c in facts.columns]).alias("_sl_f"),
                     F.lit(None).cast(vstruct).alias("_sl_v"))
    v = versions.select(F.col(key), F.col(valid_from).alias(t), F.lit(0).alias(kind),
                        F.lit(None).cast(fstruct).alias("_sl_f"),
                        F.struct(*[F.col(c) for c in vcols]).alias("_sl_v"))
    n = num_partitions or int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # a version starting exactly at a fact's time sorts first (half-open intervals)
    ranged = sliced(f.unionByName(v), [key, t, kind], n)
    upto = Window.partitionBy(pid, key).orderBy(t, kind).rowsBetween(Window.unboundedPreceding, 0)
    filled = ranged.withColumn("_sl_cur", F.last("_sl_v", ignorenulls=True).over(upto)).filter(
        F.col(kind) == 1)
    last_v = ranged.groupBy(pid).agg(
        F.max(F.when(F.col(kind) == 0, F.struct(F.col(key).alias("k"), F.col(t).alias("t"),
                                                F.col("_sl_v").alias("v")))).alias("_sl_lv"))
    before = Window.orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)  # one row per slice
    carry = last_v.select(pid, F.last("_sl_lv", ignorenulls=True).over(before).alias("_sl_carry"))
    j = filled.join(bounded_broadcast(carry, n), pid, "left")
    carried = F.when(F.col("_sl_carry.k").eqNullSafe(F.col(key)), F.col("_sl_carry.v"))
    ver = F.coalesce(F.col("_sl_cur"), carried)
    open_end = ver.getField(valid_to).isNull() | (F.col(t) < ver.getField(valid_to))
    matched = ver.isNotNull() & open_end
    out = j.withColumn("_sl_ver", F.when(matched, ver))
    if how == "inner":
        out = out.filter(F.col("_sl_ver").isNotNull())
    elif how != "left":
        raise ValueError("how must be 'inner' or 'left'")
    cols = [F.col(f"_sl_f.{c}").alias(c) for c in facts.columns]
    cols += [F.col(f"_sl_ver.{c}").alias(c) for c in vcols if c not in facts.columns]
    return out.select(*cols)
