"""Slowly changing dimensions (OP5-OP9, OP24, DQ17, DQ19).

One engine, ``scd2_merge``, covers both reference jobs:

* ``mode="snapshot"`` (OP7): a full or partial snapshot of the source; a
  version opens only when a tracked attribute differs null-safely from the
  current version; unknown ids are inserted from their start column.
* ``mode="strict"`` (OP6): a change feed; every row opens a new version;
  unknown ids are rejected.

The current versions and the change set are combined with **one** full outer
join on the business id (both sides are unique per id after validation, so
the join cannot skew). Closed history rows (``is_current = false``) are
append-only and pass through untouched. New version keys continue after the
highest existing key with the distributed dense key (no global window).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from starloom.functions.nulls import any_distinct, typed_null
from starloom.operators.keys import dense_key, next_key_start
from starloom.operators.sequence import sliced, with_neighbours
from starloom.operators.staging import latest_per_key
from starloom.session import stored
from starloom.sources.readers import require_columns


class Scd2ValidationError(ValueError):
    def __init__(self, violations: list[tuple[str, int]]):
        self.violations = violations
        super().__init__("change set rejected: " + ", ".join(f"{c}={n}" for c, n in violations))


@dataclass(frozen=True)
class Scd2Spec:
    key: str                          # business id
    version_key: str                  # surrogate key of a version
    tracked: tuple[str, ...]          # attributes whose change opens a version
    change_ts: str = "updated_at"     # change time in the source
    carried: tuple[str, ...] = ()     # untracked attributes copied from the source
    new_start: str | None = None      # source column giving a new id's start (else change_ts)
    valid_from: str = "effective_from"
    valid_to: str = "effective_to"
    current: str = "is_current"

    @property
    def dim_columns(self) -> list[str]:
        return [self.version_key, self.key, *self.tracked, *self.carried,
                self.valid_from, self.valid_to, self.current]


CUSTOMER_SCD2 = Scd2Spec(
    key="customer_id", version_key="customer_key",
    tracked=("first_name", "last_name", "email", "city", "state", "country"),
    change_ts="updated_at", carried=("signup_date",), new_start="signup_date",
)


def _ts(c: Column) -> Column:
    return c.cast("timestamp_ntz")


# ------------------------------------------------------------------ checks
def _classify(dim: DataFrame, changes: DataFrame, spec: Scd2Spec, mode: str) -> DataFrame:
    """Current versions full-outer-joined with the change set, with flags
    ``_matched``, ``_changed``, ``_new``."""
    cur = dim.filter(F.col(spec.current)).select(
        spec.key, *[F.col(c).alias(f"_d_{c}") for c in dim.columns if c != spec.key])
    src_cols = [spec.key, *spec.tracked, *spec.carried, spec.change_ts]
    if spec.new_start and spec.new_start not in src_cols:
        src_cols.append(spec.new_start)
    src = changes.select(*[F.col(c) for c in src_cols]).withColumn("_s_present", F.lit(True))
    j = cur.join(src, spec.key, "full_outer")
    matched = F.col(f"_d_{spec.version_key}").isNotNull() & F.col("_s_present").isNotNull()
    if mode == "snapshot":
        diff = any_distinct([(F.col(c), F.col(f"_d_{c}")) for c in spec.tracked])
        changed = matched & diff
    elif mode == "strict":
        changed = matched
    else:
        raise ValueError(f"mode must be 'snapshot' or 'strict', not {mode!r}")
    new = F.col(f"_d_{spec.version_key}").isNull() & F.col("_s_present").isNotNull()
    return j.withColumns({"_matched": matched, "_changed": changed, "_new": new})


def scd2_violations(dim: DataFrame, changes: DataFrame, spec: Scd2Spec, mode: str = "snapshot",
                    on_new: str = "insert") -> DataFrame:
    """DQ19: change-feed validity before a merge, as data:
    ``(check, violations)`` with one row per check (one job computes all).

    Runs before uniqueness is known, so it uses only skew-tolerant shapes:
    per-key counts (map-side partial aggregation), an inner join and an anti
    join against the current versions (AQE splits a hot key on the change
    side); the full outer join of the merge runs only after this passed."""
    dup_src = changes.groupBy(spec.key).count().filter(F.col("count") > 1)
    cur = dim.filter(F.col(spec.current))
    dup_cur = cur.groupBy(spec.key).count().filter(F.col("count") > 1)
    d = cur.select(spec.key, *[F.col(c).alias(f"_d_{c}") for c in (*spec.tracked, spec.valid_from)])
    matched = changes.select(spec.key, *spec.tracked, spec.change_ts).join(d, spec.key)
    changed = matched
    if mode == "snapshot":
        changed = matched.filter(any_distinct([(F.col(c), F.col(f"_d_{c}")) for c in spec.tracked]))
    elif mode != "strict":
        raise ValueError(f"mode must be 'snapshot' or 'strict', not {mode!r}")
    start = F.col(f"_d_{spec.valid_from}")
    bad_time = changed.filter(F.col(spec.change_ts).isNull() | start.isNull()
                              | (_ts(F.col(spec.change_ts)) <= start))
    parts = [
        dup_src.select(F.lit("duplicate_change_ids").alias("check")),
        dup_cur.select(F.lit("multiple_current_versions").alias("check")),
        bad_time.select(F.lit("change_time_not_after_current_start").alias("check")),
    ]
    names = ["duplicate_change_ids", "multiple_current_versions", "change_time_not_after_current_start"]
    if on_new == "reject":
        unknown = changes.select(spec.key).join(cur.select(spec.key), spec.key, "left_anti")
        parts.append(unknown.select(F.lit("id_without_current_version").alias("check")))
        names.append("id_without_current_version")
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    counts = found.groupBy("check").agg(F.count(F.lit(1)).cast("long").alias("violations"))
    all_checks = dim.sparkSession.createDataFrame([(n,) for n in names], "check string")
    return all_checks.join(counts, "check", "left").select(
        "check", F.coalesce("violations", F.lit(0).cast("long")).alias("violations"))


def _enforce(violations: DataFrame) -> None:
    bad = [(r["check"], int(r["violations"])) for r in violations.filter("violations > 0").collect()]
    if bad:
        raise Scd2ValidationError(bad)


# ------------------------------------------------------------------- merge
def scd2_changes(dim: DataFrame, changes: DataFrame, spec: Scd2Spec, mode: str = "snapshot",
                 on_new: str = "insert") -> tuple[DataFrame, DataFrame]:
    """The two halves of a merge, before keys are assigned:
    (current versions after closing, new versions without version key). The
    outer join is stored, so both halves read one execution of it."""
    cls = stored(_classify(dim, changes, spec, mode), "classes")
    d = lambda c: F.col(f"_d_{c}")
    chg = _ts(F.col(spec.change_ts))
    current_after = cls.filter(d(spec.version_key).isNotNull()).select(*[
        (F.col(spec.key) if c == spec.key
         else F.when(F.col("_changed"), chg).otherwise(d(c)).alias(c) if c == spec.valid_to
         else F.when(F.col("_changed"), F.lit(False)).otherwise(d(c)).alias(c) if c == spec.current
         else d(c).alias(c))
        for c in dim.columns])
    start_new = _ts(F.col(spec.new_start)) if spec.new_start else chg
    opens = F.col("_changed") | (F.col("_new") if on_new == "insert" else F.lit(False))
    additions = cls.filter(opens).select(
        spec.key, *spec.tracked, *spec.carried,
        F.when(F.col("_new"), start_new).otherwise(chg).alias(spec.valid_from),
        typed_null("timestamp_ntz").alias(spec.valid_to),
        F.lit(True).alias(spec.current),
    )
    return current_after, additions


def _sequence_violations(dim: DataFrame, changes: DataFrame, spec: Scd2Spec) -> DataFrame:
    """Checks for a batch with several changes per id: ids may repeat, but
    (id, change time) must be unique and every change of a known id must be
    later than its current version's start."""
    dup_times = changes.groupBy(spec.key, spec.change_ts).count().filter("count > 1").select(
        F.lit("duplicate_change_times").alias("check"))
    cur = dim.filter(F.col(spec.current))
    multi = cur.groupBy(spec.key).count().filter("count > 1").select(
        F.lit("multiple_current_versions").alias("check"))
    late = changes.join(cur.select(spec.key, F.col(spec.valid_from).alias("_sl_from")), spec.key).filter(
        F.col(spec.change_ts).isNull() | F.col("_sl_from").isNull()
        | (_ts(F.col(spec.change_ts)) <= F.col("_sl_from"))).select(
        F.lit("change_time_not_after_current_start").alias("check"))
    names = ["duplicate_change_times", "multiple_current_versions", "change_time_not_after_current_start"]
    counts = dup_times.unionByName(multi).unionByName(late).groupBy("check").agg(
        F.count(F.lit(1)).cast("long").alias("violations"))
    checks = dim.sparkSession.createDataFrame([(n,) for n in names], "check string")
    return checks.join(counts, "check", "left").select(
        "check", F.coalesce("violations", F.lit(0).cast("long")).alias("violations"))


def _merge_sequence(dim: DataFrame, changes: DataFrame, spec: Scd2Spec, mode: str = "snapshot") -> DataFrame:
    """Merge of a batch holding several changes per id, applied in
    change-time order: the current version and the id's changes form one
    small log that is collapsed with ``scd2_from_log``. In snapshot mode equal
    consecutive tracked values extend a version; in strict mode every change
    row opens one (its time is part of the compared values). A new id's first
    version starts at ``new_start``."""
    vk, key = spec.version_key, spec.key
    extra = [c for c in spec.carried]
    cur = dim.filter(F.col(spec.current)).select(
        key, F.col(spec.valid_from).alias("_sl_t"), *spec.tracked, *extra, F.col(vk))
    src = changes.select(key, _ts(F.col(spec.change_ts)).alias("_sl_t"), *spec.tracked, *extra,
                         F.lit(None).cast("long").alias(vk))
    compared = list(spec.tracked)
    log = cur.unionByName(src)
    if mode == "strict":
        log = log.withColumn("_sl_row_t", F.col("_sl_t"))
        compared.append("_sl_row_t")
    versions = scd2_from_log(log, key, "_sl_t", compared, carry=[*extra, vk])
    if mode == "strict":
        versions = versions.drop("_sl_row_t")
    versions = versions.withColumnsRenamed({"effective_from": spec.valid_from, "effective_to": spec.valid_to,
                                            "is_current": spec.current})
    kept = versions.filter(F.col(vk).isNotNull())
    fresh = versions.filter(F.col(vk).isNull()).drop(vk)
    if spec.new_start:
        known = cur.select(key).withColumn("_sl_known", F.lit(True))
        first = fresh.groupBy(key).agg(F.min(spec.valid_from).alias("_sl_first"))
        fresh = fresh.join(known, key, "left").join(first, key).withColumn(
            spec.valid_from,
            F.when(F.col("_sl_known").isNull() & (F.col(spec.valid_from) == F.col("_sl_first")),
                   _ts(F.col(spec.new_start))).otherwise(F.col(spec.valid_from))).drop("_sl_known", "_sl_first")
    keyed = dense_key(fresh, [key, spec.valid_from], vk, next_key_start(dim, vk))
    history = dim.filter(~F.col(spec.current) | F.col(spec.current).isNull())
    cols = dim.columns
    return history.select(*cols).unionByName(kept.select(*cols)).unionByName(keyed.select(*cols))


def scd2_merge(dim: DataFrame, changes: DataFrame, spec: Scd2Spec = CUSTOMER_SCD2,
               mode: str = "snapshot", on_new: str | None = None, validate: bool = True,
               return_parts: bool = False, sequence: bool = False):
    """Apply a change set to a Type 2 dimension and return the new dimension
    (``return_parts=True``: also the closed rows and the new versions).

    ``on_new``: ``"insert"`` (snapshot default), ``"reject"`` (strict
    default) or ``"ignore"``. With ``validate`` the change set is checked
    first (one job) and rejected with ``Scd2ValidationError``.
    ``sequence=True`` accepts several changes per id and applies them in
    change-time order instead of rejecting the batch (both modes; ``on_new``
    then rejects or inserts, and the parts are not told apart).
    Missing columns fail before any job (SRC9).
    """
    require_columns(dim, spec.dim_columns, "dimension")
    require_columns(changes, [spec.key, *spec.tracked, *spec.carried, spec.change_ts,
                              *([spec.new_start] if spec.new_start else [])], "change set")
    if sequence and (return_parts or on_new == "ignore"):
        raise ValueError("sequence=True takes neither return_parts nor on_new='ignore'")
    if sequence:
        if validate:
            checks = _sequence_violations(dim, changes, spec)
            if mode == "strict" and (on_new or "reject") == "reject":
                unknown = changes.select(spec.key).join(
                    dim.filter(F.col(spec.current)).select(spec.key), spec.key, "left_anti")
                checks = checks.unionByName(unknown.agg(F.count(F.lit(1)).cast("long").alias("violations"))
                                            .select(F.lit("id_without_current_version").alias("check"),
                                                    "violations"))
            _enforce(checks)
        return _merge_sequence(dim, changes, spec, mode)
    on_new = on_new or ("insert" if mode == "snapshot" else "reject")
    if validate:
        _enforce(scd2_violations(dim, changes, spec, mode, on_new))
    history = dim.filter(~F.col(spec.current) | F.col(spec.current).isNull())
    current_after, additions = scd2_changes(dim, changes, spec, mode,
                                            "insert" if on_new == "insert" else "ignore")
    keyed = dense_key(additions, [spec.key], spec.version_key, next_key_start(dim, spec.version_key))
    merged = history.unionByName(current_after).unionByName(keyed.select(*dim.columns))
    if return_parts:
        closed = current_after.filter(~F.col(spec.current))
        return merged, closed, keyed.select(*dim.columns)
    return merged


def scd2_what_if(dim: DataFrame, source: DataFrame, key_value, overrides: dict, change_time: str,
                 spec: Scd2Spec = CUSTOMER_SCD2) -> DataFrame:
    """OP24: simulate a change of one entity on read-only inputs: overlay the
    attribute values and change time for ``key_value`` and return the merged
    candidate (nothing is written). Other entities of the source stay out, so
    drift between source and dimension opens no versions."""
    over = {c: F.lit(v) for c, v in overrides.items()}
    over[spec.change_ts] = F.lit(change_time).cast("timestamp_ntz")
    return scd2_merge(dim, source.filter(F.col(spec.key) == F.lit(key_value)).withColumns(over), spec, mode="snapshot")


# ----------------------------------------------------------- from a change log
def _marked(log: DataFrame, key: str, order: list[str], tracked: list[str], n: int) -> DataFrame:
    """The sliced log with ``_sl_start`` (the row starts a version: its tracked
    values differ null-safely from the previous row of its key) and the
    previous row's time."""
    ranged = sliced(log, [key, *order], n)
    rows = with_neighbours(ranged, [key], order, [*tracked, order[0]], num_partitions=n, keep_slice=True, presliced=True)
    start = ~F.col("prev_exists") | any_distinct([(F.col(c), F.col(f"prev_{c}")) for c in tracked])
    return rows.withColumn("_sl_start", start).drop("prev_exists", *[f"prev_{c}" for c in tracked])


def _ended(starts: DataFrame, key: str, order: list[str], n: int) -> DataFrame:
    """Stored version starts with the next start's time and the time of the
    last row before it (``next_*``; none for the last version of a key)."""
    ts = order[0]
    return with_neighbours(starts, [key], order, [ts, f"prev_{ts}"], prev=False, nxt=True, num_partitions=n, presliced=True)


def scd2_from_log(log: DataFrame, key: str, ts: str, tracked: list[str], tiebreak: list[str] | None = None,
                  num_partitions: int | None = None, carry: list[str] | None = None) -> DataFrame:
    """OP5: versions from a whole change log. A version starts at every row
    whose tracked values differ (null-safely) from the previous row of the same
    key; it ends where the next version of that key starts (NULL = open).
    ``carry`` columns are taken from the row that starts a version.

    The log is cut into slices of (key, time) order once, so a key with a huge
    history is spread over many tasks. Its neighbours tell the starts; the
    starts, stored (they are what the dimension will hold), tell the ends by
    the same neighbour step on the same slices."""
    order = [ts, *(tiebreak or [])]
    carry = list(carry or [])
    n = num_partitions or int(log.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    marked = _marked(log.select(key, *order, *tracked, *carry), key, order, tracked, n)
    starts = stored(marked.filter("_sl_start").drop("_sl_start"), "starts")
    ended = _ended(starts, key, order, n)
    return ended.select(
        key, *tracked, F.col(ts).alias("effective_from"), F.col(f"next_{ts}").alias("effective_to"),
        F.col(f"next_{ts}").isNull().alias("is_current"), *carry)


# ------------------------------------------------- log rows in any order
def log_row_columns(key: str, ts: str, tiebreak: str, tracked: list[str], version_key: str) -> list[str]:
    """Columns of the rows ``scd2_merge_rows`` keeps: every change-log row once,
    whether it starts a version, and for starts its key, end and last-seen time."""
    return [key, ts, tiebreak, *tracked, "is_start", version_key, "effective_to", "last_seen"]


def scd2_merge_rows(state: DataFrame, batch: DataFrame, key: str, ts: str, tiebreak: str, tracked: list[str],
                    version_key: str, key_start: int, num_partitions: int | None = None) -> DataFrame:
    """OP5/DQ19, rows in any order: merge change-log rows into stored ones
    (``log_row_columns``) and return only the rows that are new or changed.

    A late row splits the version that covers its time, is absorbed by it, or
    joins its neighbours, as if the whole log had been read in order. For that
    a version's confirming rows stay stored beside its start (a split version
    goes on at the first confirmation behind the late row). Of each key in
    the batch, only the versions that end at or after its earliest new row,
    and their confirmations, are read again; earlier history is not touched.

    Version keys stay with their start row. Where an earlier row takes over a
    version's start, the version keeps its key; where two versions join, the
    smaller key stays. A row already stored (same key, time and tiebreak) counts once."""
    order = [ts, tiebreak]
    n = num_partitions or int(batch.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    new = batch.select(key, ts, F.col(tiebreak).cast(state.schema[tiebreak].dataType).alias(tiebreak), *tracked)
    low = new.groupBy(key).agg(F.min(ts).alias("_sl_low"))
    known = state.join(low, key)
    at = F.struct(*order)
    first = known.filter(F.col("is_start") & (F.col("effective_to").isNull() | (F.col("effective_to") >= F.col("_sl_low")))
                         ).groupBy(key).agg(F.min(at).alias("_sl_first"))
    was = ["is_start", version_key, "effective_to", "last_seen"]
    touched = known.join(first, key).filter(at >= F.col("_sl_first")).select(
        key, *order, *tracked, F.struct(*was).alias("_sl_was"))
    log = touched.unionByName(new, allowMissingColumns=True)
    log = latest_per_key(log, [key, *order], ["_sl_was"])  # a stored row wins over its repetition
    rows = _marked(log, key, order, tracked, n)

    # a start without a key takes the smallest key that lost its start to it
    run = F.sum(F.col("_sl_start").cast("int")).over(Window.partitionBy("_sl_pid", key).orderBy(*order))
    rows = rows.withColumn("_sl_run", run)
    left = F.min(f"_sl_was.{version_key}").over(Window.partitionBy("_sl_pid", key, "_sl_run"))
    rows = rows.withColumn(version_key, F.when(F.col("_sl_start"), F.coalesce(f"_sl_was.{version_key}", left)))
    rows = stored(rows.drop("_sl_run"), "log")
    tops = rows.groupBy(key).agg(F.max(ts).alias("_sl_top"))
    starts = _ended(rows.filter("_sl_start"), key, order, n).join(tops, key).select(
        key, *order, *tracked, "_sl_was", F.lit(True).alias("is_start"), version_key,
        F.col(f"next_{ts}").alias("effective_to"),
        F.when(F.col(f"next_{ts}").isNull(), F.col("_sl_top")).otherwise(F.col(f"next_prev_{ts}")).alias("last_seen"))
    fresh = dense_key(starts.filter(F.col(version_key).isNull()).drop(version_key), [key, *order], version_key, key_start)
    seen = rows.filter(~F.col("_sl_start")).select(
        key, *order, *tracked, "_sl_was", F.lit(False).alias("is_start"), F.lit(None).cast("long").alias(version_key),
        typed_null("timestamp_ntz").alias("effective_to"), typed_null("timestamp_ntz").alias("last_seen"))
    merged = starts.filter(F.col(version_key).isNotNull()).unionByName(fresh).unionByName(seen)
    return merged.filter(~F.struct(*was).eqNullSafe(F.col("_sl_was"))).select(
        log_row_columns(key, ts, tiebreak, tracked, version_key))


def scd2_rejects(batch: DataFrame, key: str, ts: str, current: DataFrame | None = None) -> DataFrame:
    """Rows that no version can take, with ``reason``: without a key, without a
    time, and, if the ``current`` versions (key, effective_from) are given,
    not later than their key's current version."""
    reason = F.when(F.col(key).isNull(), "no key").when(F.col(ts).isNull(), "no time")
    if current is None:
        return batch.withColumn("reason", reason).filter("reason IS NOT NULL")
    starts = current.select(F.col(key).alias("_sl_key"), F.col("effective_from").alias("_sl_from"))
    late = reason.when(F.col(ts) <= F.col("_sl_from"), "late")
    return (batch.join(starts, F.col(key) == F.col("_sl_key"), "left").withColumn("reason", late)
            .filter("reason IS NOT NULL").select(*batch.columns, "reason"))


def scd2_late_rows(dim: DataFrame, batch: DataFrame, key: str, ts: str) -> DataFrame:
    """Batch rows that cannot be applied to an event dimension: without a
    time, or not later than the start of their key's current version."""
    starts = dim.filter(F.col("is_current")).select(key, F.col("effective_from").alias("_sl_cur_from"))
    late = F.col(ts).isNull() | (F.col(ts) <= F.col("_sl_cur_from"))
    return batch.join(starts, key, "left").filter(late).select(*batch.columns)


def scd2_apply_log(dim: DataFrame, batch: DataFrame, key: str, ts: str, tracked: list[str],
                   tiebreak: str, version_key: str, key_start: int | None = None,
                   on_late: str = "raise") -> DataFrame:
    """Append a batch of change-log rows to a Type 2 dimension built by
    ``scd2_from_log`` (the streaming / incremental form of OP5).

    The current version of each key is put in front of the key's batch rows
    and the combined log is collapsed again: a batch row equal to the current
    version extends it, a different one closes it. Closed history is
    untouched; new versions get keys after the highest existing key (or from
    ``key_start`` when ``dim`` holds only the current versions). Late rows
    (``scd2_late_rows``) raise ``Scd2ValidationError`` with their number;
    ``on_late="skip"`` leaves them out, for callers that store them."""
    if on_late == "raise":
        late_rows = scd2_late_rows(dim, batch, key, ts).count()
        if late_rows:
            raise Scd2ValidationError([("late_rows", late_rows)])
    cur = dim.filter(F.col("is_current")).select(
        key, F.col("effective_from").alias(ts), F.lit(None).cast("long").alias(tiebreak), *tracked,
        F.col(version_key))
    history = dim.filter(~F.col("is_current"))
    starts = cur.select(key, F.col(ts).alias("_sl_cur_from"))
    ev = batch.select(key, ts, F.col(tiebreak).cast("long").alias(tiebreak), *tracked).join(
        starts, key, "left").filter(F.col("_sl_cur_from").isNull() | (F.col(ts) > F.col("_sl_cur_from"))).select(
        key, ts, tiebreak, *tracked, F.lit(None).cast("long").alias(version_key))
    versions = scd2_from_log(cur.unionByName(ev), key, ts, tracked, [tiebreak], carry=[version_key])
    kept = versions.filter(F.col(version_key).isNotNull())
    fresh = versions.filter(F.col(version_key).isNull()).drop(version_key)
    start = key_start if key_start is not None else next_key_start(dim, version_key)
    keyed = dense_key(fresh, [key, "effective_from"], version_key, start)
    cols = dim.columns
    return history.select(*cols).unionByName(kept.select(*cols)).unionByName(keyed.select(*cols))


# ------------------------------------------------------------------- SCD 1
def scd1_upsert(dim: DataFrame, changes: DataFrame, key: str, attrs: list[str],
                change_ts: str | None = "updated_at", insert_new: bool = False,
                version_key: str | None = None, new_start: str | None = None) -> DataFrame:
    """OP8: overwrite attributes in place with ``coalesce(new, old)`` (a NULL
    in the change set never clears a value). Every version of an id is
    updated. The change set is reduced to its latest row per id first, so
    duplicate change rows cannot multiply dimension rows (the reference fans
    out). ``insert_new`` appends unknown ids with continuing keys."""
    if change_ts and change_ts in changes.columns:
        ch = latest_per_key(changes.select(key, *attrs, change_ts), [key], [change_ts]).drop(change_ts)
    else:
        ch = latest_per_key(changes.select(key, *attrs), [key], [])
    ch = ch.select(key, *[F.col(a).alias(f"_n_{a}") for a in attrs])
    j = dim.join(ch, key, "left")
    out = j.select(*[F.coalesce(F.col(f"_n_{c}"), F.col(c)).alias(c) if c in attrs else F.col(c)
                     for c in dim.columns])
    if not insert_new:
        return out
    if not version_key:
        raise ValueError("insert_new needs version_key")
    fresh = ch.join(dim.select(key).distinct(), key, "left_anti")
    start = _ts(F.col(new_start)) if new_start and new_start in changes.columns else F.current_timestamp().cast("timestamp_ntz")
    extra = {}
    for c in dim.columns:
        if c == key or c == version_key:
            continue
        if c in attrs:
            extra[c] = F.col(f"_n_{c}")
        elif c == "effective_from":
            extra[c] = start
        elif c == "effective_to":
            extra[c] = typed_null("timestamp_ntz")
        elif c == "is_current":
            extra[c] = F.lit(True)
        else:
            extra[c] = F.lit(None).cast(dim.schema[c].dataType)
    rows = fresh.select(key, *[v.alias(c) for c, v in extra.items()])
    keyed = dense_key(rows, [key], version_key, next_key_start(dim, version_key))
    return out.unionByName(keyed.select(*dim.columns))


def scd1_refresh(existing: DataFrame, staged: DataFrame, key: str, version_key: str) -> DataFrame:
    """Type 1 refresh of a keyed dimension from a full staging snapshot with
    stable keys: ids present in both keep their key and take the staged
    attributes, ids only in the dimension are kept (no deletes), new ids get
    keys after the highest existing one (ordered by id). Rebuilding the keys
    from scratch would re-point every stored fact row."""
    attrs = [c for c in existing.columns if c not in (key, version_key)]
    keys = existing.select(key, version_key)
    updated = staged.join(keys, key).select(*existing.columns)
    gone = existing.join(staged.select(key), key, "left_anti").select(*existing.columns)
    fresh = staged.join(keys.select(key), key, "left_anti").select(key, *attrs)
    keyed = dense_key(fresh, [key], version_key, next_key_start(existing, version_key))
    return updated.unionByName(gone).unionByName(keyed.select(*existing.columns))


# -------------------------------------------------------------- start repair
def scd2_repair_start(dim: DataFrame, key: str = "customer_id", version_key: str = "customer_key",
                      start_col: str = "signup_date", valid_from: str = "effective_from",
                      orders: DataFrame | None = None, expected_orders: int | None = None) -> DataFrame:
    """OP9: the earliest version of every id (by start, then key) starts at
    ``start_col`` midnight. The earliest version is found with a per-id
    ``min(struct(start, key))`` aggregate (partial map-side, skew-safe) and
    matched back on the unique version key."""
    require_columns(dim, [key, version_key, start_col, valid_from], "dimension")
    first = dim.groupBy(key).agg(F.min(F.struct(F.col(valid_from), F.col(version_key))).alias("_m")).select(
        F.col(f"_m.{version_key}").alias("_sl_first_key"))
    j = dim.join(first, F.col(version_key) == F.col("_sl_first_key"), "left")
    repaired = j.select(*[
        F.when(F.col("_sl_first_key").isNotNull(), _ts(F.col(start_col))).otherwise(F.col(c)).alias(c)
        if c == valid_from else F.col(c) for c in dim.columns])
    if orders is not None:   # abort before anything is written, as the reference job does
        _enforce(scd2_repair_checks(repaired, dim, orders, key, version_key, expected_orders=expected_orders))
    return repaired


def scd2_repair_checks(candidate: DataFrame, original: DataFrame, orders: DataFrame,
                       key: str = "customer_id", version_key: str = "customer_key",
                       order_id: str = "order_id", order_ts: str = "order_date",
                       expected_orders: int | None = None) -> DataFrame:
    """OP9's guards as data, one job: ``(check, violations)`` for NULL starts,
    a changed row count, orders not matching exactly one version and (when
    given) an unexpected number of checked orders. ``scd2_repair_start(...,
    orders=...)`` raises on any of them before anything is written."""
    from starloom.operators.temporal import version_match_count

    one = F.lit(1)
    parts = [
        candidate.agg(F.count_if(F.col("effective_from").isNull()).cast("long").alias("v")).select(
            F.lit("null_effective_from").alias("check"), "v"),
        candidate.select(F.lit(1).alias("s")).unionByName(original.select(F.lit(-1).alias("s"))).agg(
            F.abs(F.sum("s")).cast("long").alias("v")).select(F.lit("row_count_changed").alias("check"), "v"),
    ]
    matches = version_match_count(orders.dropDuplicates([order_id]), candidate, order_id, key, order_ts,
                                  version_key)
    parts.append(matches.agg(F.count_if(F.col("match_count") != 1).cast("long").alias("v")).select(
        F.lit("orders_not_matching_one_version").alias("check"), "v"))
    if expected_orders is not None:
        parts.append(matches.agg(F.abs(F.count(one) - F.lit(expected_orders)).cast("long").alias("v")).select(
            F.lit("checked_order_count").alias("check"), "v"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumnRenamed("v", "violations")


# --------------------------------------------------------------- integrity
def scd2_integrity(dim: DataFrame, key: str = "customer_id", version_key: str = "customer_key",
                   valid_from: str = "effective_from", valid_to: str = "effective_to",
                   current: str = "is_current") -> DataFrame:
    """DQ17 plus chain continuity, as ``(check, violations)`` rows:

    * duplicate_version_keys - version keys used more than once
    * multiple_current_versions - ids with more than one current version
    * invalid_ranges - closed versions with ``effective_to <= effective_from``
    * broken_chain - closed versions whose end is not the start of another
      version of the same id; an equi-join on ``(id, time)``
    * overlapping_versions - versions that start before the version of the
      same id before them (by start) has ended; where any two overlap, such
      neighbours do. Slices of (id, start) order, no window over a whole id
    """
    dup_keys = dim.groupBy(version_key).count().filter("count > 1").select(F.lit("duplicate_version_keys").alias("check"))
    multi = dim.filter(F.col(current)).groupBy(key).count().filter("count > 1").select(
        F.lit("multiple_current_versions").alias("check"))
    bad = dim.filter(F.col(valid_to).isNotNull() & (F.col(valid_to) <= F.col(valid_from))).select(
        F.lit("invalid_ranges").alias("check"))
    starts = dim.select(F.col(key).alias("_k"), F.col(valid_from).alias("_t")).distinct()
    closed = dim.filter(F.col(valid_to).isNotNull()).select(key, valid_to)
    broken = closed.join(starts, (F.col(key) == F.col("_k")) & (F.col(valid_to) == F.col("_t")), "left_anti").select(
        F.lit("broken_chain").alias("check"))
    near = with_neighbours(dim.select(key, valid_from, version_key, valid_to), [key], [valid_from, version_key], [valid_to])
    prev_to = F.col(f"prev_{valid_to}")
    overlap = near.filter(F.col("prev_exists") & (prev_to.isNull() | (prev_to > F.col(valid_from)))).select(
        F.lit("overlapping_versions").alias("check"))
    found = dup_keys.unionByName(multi).unionByName(bad).unionByName(broken).unionByName(overlap)
    counts = found.groupBy("check").agg(F.count(F.lit(1)).cast("long").alias("violations"))
    names = ["duplicate_version_keys", "multiple_current_versions", "invalid_ranges", "broken_chain", "overlapping_versions"]
    checks = dim.sparkSession.createDataFrame([(n,) for n in names], "check string")
    return checks.join(counts, "check", "left").select(
        "check", F.coalesce("violations", F.lit(0).cast("long")).alias("violations"))
