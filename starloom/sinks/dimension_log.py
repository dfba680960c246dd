"""A Type 2 dimension stored as a log of its changed rows (OP22, SRC3, SNK9).

Every batch of change-log rows, in any order, is merged by
``scd.scd2_merge_rows``; only rows that are new or changed are written:

    <root>/data/batch=<n>/        rows changed by batch <n>
    <root>/base/batch=<n>/        all rows as of batch <n> (compaction)
    <root>/rejected/batch=<n>/    rows of batch <n> that were not taken, with reason
    <root>/_commits/seq=<s>/      one row: batch, mark, highest key, base, counts

The commit record is written aside and renamed, and holds the table version
and the high-water mark together: a reader sees both or neither. Files of a
batch without a record are ignored and replaced by the retry; a replayed
batch number is skipped; two writers cannot both take one sequence number.

Reading merges on the way: of every row (key, time, tiebreak) the one of the
highest committed batch counts. ``compact`` writes the merged rows as the new
base, so later reads start from it, and ``vacuum`` removes what no committed
reader needs any more.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType, TimestampNTZType

from starloom.operators.scd import log_row_columns, scd2_merge_rows, scd2_rejects
from starloom.operators.staging import latest_per_key
from starloom.sinks.publish import delete, exists, listed, write_observed, write_once

COMMIT = ("seq long, batch long, mark timestamp_ntz, max_key long, base long, changed_rows long, rejected_rows long, "
          "committed_at timestamp_ntz")


class DimensionLog:
    def __init__(self, spark: SparkSession, root: str, schema: StructType, key: str, ts: str, tiebreak: str,
                 tracked: list[str], version_key: str = "version_key"):
        self.spark, self.root = spark, root.rstrip("/")
        self.key, self.ts, self.tiebreak, self.tracked, self.version_key = key, ts, tiebreak, list(tracked), version_key
        self.source = StructType([schema[c] for c in (key, ts, tiebreak, *tracked)])
        self.identity = [key, ts, tiebreak]
        time = TimestampNTZType()
        self.stored = StructType([
            *[StructField(f.name, f.dataType) for f in self.source.fields], StructField("is_start", BooleanType()),
            StructField(version_key, LongType()), StructField("effective_to", time), StructField("last_seen", time)])

    # ------------------------------------------------------------- reading
    def commits(self) -> DataFrame:
        path = f"{self.root}/_commits"
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], COMMIT)
        return self.spark.read.parquet(path).select([c.split()[0] for c in COMMIT.split(", ")])

    def last(self) -> Row | None:
        return self.commits().orderBy(F.desc("seq")).first()

    def mark(self) -> dt.datetime | None:
        """High-water mark of the last commit (none: nothing was loaded)."""
        last = self.last()
        return None if last is None else last.mark

    def _read(self, kind: str) -> DataFrame:
        schema = StructType([*self.stored.fields, StructField("batch", LongType())])
        path = f"{self.root}/{kind}"
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def rows(self, last: Row | None = None, keys: DataFrame | None = None) -> DataFrame:
        """The committed log rows (of ``keys``, else all), each as its last batch
        left it. Rows of other keys are left out before anything is merged."""
        last = last or self.last()
        if last is None:
            return self.spark.createDataFrame([], self.stored)
        base = -1 if last.base is None else last.base
        changed = self._read("data").filter((F.col("batch") > base) & (F.col("batch") <= last.batch))
        every = self._read("base").filter(F.col("batch") == base)
        if last.batch > base:
            every = every.unionByName(changed)
        if keys is not None:
            every = every.join(keys, self.key, "left_semi")
        if last.batch > base:
            every = latest_per_key(every, self.identity, ["batch"])
        return every.select(self.stored.names)

    def versions(self, last: Row | None = None) -> DataFrame:
        return self.rows(last).filter("is_start").select(
            self.version_key, self.key, *self.tracked, F.col(self.ts).alias("effective_from"), "effective_to",
            F.col("effective_to").isNull().alias("is_current"), "last_seen")

    def rejected(self) -> DataFrame:
        """Rows that no committed batch took, with the reason and the batch."""
        path, last = f"{self.root}/rejected", self.last()
        schema = StructType([*self.source.fields]).add("reason", "string").add("batch", "long")
        if last is None or not exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path).filter(F.col("batch") <= last.batch)

    # ------------------------------------------------------------- writing
    def apply(self, batch: DataFrame, number: int | None = None, mark: dt.datetime | None = None,
              late: str = "merge") -> bool:
        """Merge a batch and commit it with ``mark`` (none: the old mark
        stays). ``number``: the batch's own number, so that a replay is
        skipped (then False is returned). ``late="reject"`` puts rows that are
        not later than their key's current version aside instead."""
        if late not in ("merge", "reject"):
            raise ValueError("late must be 'merge' or 'reject'")
        last = self.last()
        done = -1 if last is None else last.batch
        number = done + 1 if number is None else number
        if number <= done:
            return False
        batch = batch.select(*[F.col(f.name).cast(f.dataType) for f in self.source.fields])
        rows = self.rows(last, batch.select(self.key).distinct())
        current = None
        if late == "reject":
            current = rows.filter("is_start AND effective_to IS NULL").select(self.key, F.col(self.ts).alias("effective_from"))
        bad = scd2_rejects(batch, self.key, self.ts, current)
        rejected = write_observed(bad, f"{self.root}/rejected/batch={number}", "overwrite")["rows"]
        good = batch.filter(F.col(self.key).isNotNull() & F.col(self.ts).isNotNull())
        if late == "reject":
            put_aside = self.spark.read.schema(self.source).parquet(f"{self.root}/rejected/batch={number}")
            good = good.join(put_aside.select(self.identity).distinct(), self.identity, "left_anti")
        start = 0 if last is None or last.max_key is None else last.max_key + 1
        changed = scd2_merge_rows(rows, good, self.key, self.ts, self.tiebreak, self.tracked, self.version_key, start)
        target = f"{self.root}/data/batch={number}"
        written = write_observed(changed, target, "overwrite")["rows"]
        top = self.spark.read.schema(self.stored).parquet(target).agg(F.max(self.version_key)).first()[0]
        top = max((x for x in (top, None if last is None else last.max_key) if x is not None), default=None)
        self._commit(last, number, mark if mark is not None else (None if last is None else last.mark), top,
                     None if last is None else last.base, written, rejected)
        return True

    def _commit(self, last: Row | None, batch: int, mark, max_key, base, changed: int, rejected: int) -> None:
        seq = 0 if last is None else last.seq + 1
        record = self.spark.createDataFrame([(seq, batch, mark, max_key, base, changed, rejected, dt.datetime.now())], COMMIT)
        write_once(record.coalesce(1), f"{self.root}/_commits/seq={seq}")

    def compact(self) -> None:
        """All rows as of the last batch become the new base."""
        last = self.last()
        if last is None or last.base == last.batch:
            return
        self.rows(last).write.mode("overwrite").parquet(f"{self.root}/base/batch={last.batch}")
        self._commit(last, last.batch, last.mark, last.max_key, last.batch, 0, 0)

    def vacuum(self) -> None:
        """Remove bases and changes that the last two commits do not read,
        and files of batches that were never committed."""
        kept = self.commits().orderBy(F.desc("seq")).limit(2).collect()
        if not kept:
            return
        bases = {c.base for c in kept}
        low = min(-1 if c.base is None else c.base for c in kept)
        for n, path in listed(self.spark, f"{self.root}/base", "batch"):
            if n not in bases:
                delete(self.spark, path)
        for n, path in listed(self.spark, f"{self.root}/data", "batch"):
            if n <= low or n > kept[0].batch:
                delete(self.spark, path)
