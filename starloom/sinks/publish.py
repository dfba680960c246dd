"""Writers and the staged publish protocol (SNK1-SNK8, SNK10).

``publish`` replaces a table directory without ever exposing a half-written
table:

1. write the new data to a sibling staging directory (``errorifexists``),
   counting rows in the same job (``observe``);
2. optionally verify the staged copy (``verify(df) -> violations``);
3. refuse if a backup directory already exists (never overwrite a backup);
   write a journal of what is about to be moved;
4. rename live -> backup, staging -> live (Hadoop ``FileSystem.rename``, so
   it works on any Hadoop-compatible store);
5. optionally re-read and re-verify the published table; on any failure the
   backup is renamed back;
6. ``keep_backup=False`` deletes the backup only after success; of older
   backups the latest ``retain`` stay.

A publish that dies between the renames leaves its journal: ``recover``, with
which the next publish starts, then finishes or undoes it.

On object stores where rename is a copy, point readers at a versioned
directory instead (``publish_versioned`` writes ``<path>/v=<n>`` and commits
it with a one-row table ``<path>/_commits/v=<n>``; the highest one counts).
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field
from functools import reduce
from typing import Callable, Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F


class PublishError(RuntimeError):
    pass


@dataclass
class PublishResult:
    path: str
    rows: int | None = None
    backup: str | None = None
    dry_run: bool = False
    violations: int = 0
    metrics: dict = field(default_factory=dict)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p, jvm


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return bool(fs.exists(p))


def rename(spark: SparkSession, src: str, dst: str) -> None:
    fs, s, jvm = _fs(spark, src)
    if not fs.rename(s, jvm.org.apache.hadoop.fs.Path(dst)):
        raise PublishError(f"rename {src} -> {dst} failed")


def write_once(df: DataFrame, path: str) -> None:
    """Write aside, then rename: ``path`` appears whole or not at all. An
    existing ``path`` is an error."""
    spark = df.sparkSession
    if exists(spark, path):
        raise PublishError(f"{path} already exists")
    parent, name = path.rstrip("/").rsplit("/", 1)
    aside = f"{parent}._staging_{name}_{uuid.uuid4().hex[:6]}"
    df.write.parquet(aside)
    fs, p, _ = _fs(spark, parent)
    fs.mkdirs(p)
    rename(spark, aside, path)


def listed(spark: SparkSession, path: str, name: str) -> list[tuple[int, str]]:
    """(n, path) of the directories ``<path>/<name>=<n>``."""
    fs, p, _ = _fs(spark, path)
    if not fs.exists(p):
        return []
    found = [str(s.getPath().getName()) for s in fs.listStatus(p)]
    return sorted((int(f.split("=")[1]), f"{path}/{f}") for f in found if f.startswith(f"{name}="))


def delete(spark: SparkSession, path: str) -> None:
    fs, p, _ = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


# --------------------------------------------------------------- plain sinks
def write_csv(df: DataFrame, path: str) -> None:
    """SNK1: headered CSV landing files (one part file per task)."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """SNK2 / SNK3 (``mode="errorifexists"``)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def save_table(df: DataFrame, name: str, mode: str = "overwrite", path: str | None = None,
               bucket_by: list[str] | None = None, buckets: int | None = None) -> DataFrame:
    """SNK8: materialise as a catalog table (at ``path``, else in the
    warehouse) and read it back. With ``bucket_by`` rows are hashed into
    ``buckets`` and sorted in them, so later joins and groupings on these
    columns need no exchange of this table. ``buckets`` is best the number of
    shuffle partitions of the jobs that read it (the default)."""
    spark = df.sparkSession
    w = df.write.mode(mode).format("parquet")
    if path:
        w = w.option("path", path)
    if bucket_by:
        n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        # one file per bucket: rows are dealt to the writing tasks as the buckets will be
        w = df.repartition(n, *bucket_by).write.mode(mode).format("parquet").bucketBy(n, *bucket_by).sortBy(*bucket_by)
        w = w.option("path", path) if path else w
    w.saveAsTable(name)
    return spark.table(name)


def write_ordered(df: DataFrame, path: str, order: list[Column | str], files: int | None = None) -> None:
    """SO2/SO3: globally ordered output. Rows are range-partitioned and sorted
    within their file; the files' numbers follow the order, so reading them one
    after the other is the ordered table. No task holds more than a file."""
    n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.repartitionByRange(n, *order).sortWithinPartitions(*order).write.mode("errorifexists").parquet(path)


def read_ordered(spark: SparkSession, path: str, position: str = "position") -> DataFrame:
    """The rows of ``write_ordered`` with their place (from 1) in the order,
    from each row's file and its place there (one row per file is added up)."""
    df = spark.read.parquet(path)
    rows = df.select("*", F.col("_metadata.file_name").alias("_sl_file"), F.col("_metadata.row_index").alias("_sl_row"))
    counts = rows.groupBy("_sl_file").agg(F.count(F.lit(1)).alias("_sl_n"))
    before = Window.orderBy("_sl_file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    offsets = counts.select("_sl_file", F.coalesce(F.sum("_sl_n").over(before), F.lit(0)).alias("_sl_before"))
    return rows.join(offsets, "_sl_file").select(
        (F.col("_sl_before") + F.col("_sl_row") + 1).cast("long").alias(position), *df.columns)


def write_observed(df: DataFrame, path: str, mode: str = "errorifexists",
                   partition_by: list[str] | None = None) -> dict:
    """SNK10: write and report the row count from the *same* job."""
    obs = Observation(f"w{uuid.uuid4().hex[:8]}")
    write_parquet(df.observe(obs, F.count(F.lit(1)).alias("rows")), path, mode, partition_by)
    return dict(obs.get)


# ------------------------------------------------------------ staged publish
def _journal(path: str) -> str:
    return f"{path.rstrip('/')}._journal"


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p, _ = _fs(spark, path + "._new")
    out = fs.create(p, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    rename(spark, path + "._new", path)


def _read_text(spark: SparkSession, path: str) -> str:
    return "".join(r.value for r in spark.read.text(path).collect())


def backups(spark: SparkSession, path: str) -> list[str]:
    """Backups of a published table, oldest first."""
    fs, p, _ = _fs(spark, path)
    parent, prefix = p.getParent(), f"{p.getName()}._backup_"
    if not fs.exists(parent):
        return []
    names = sorted(n for n in (str(f.getPath().getName()) for f in fs.listStatus(parent)) if n.startswith(prefix))
    return [f"{path.rstrip('/')}{n[len(p.getName()):]}" for n in names]


def recover(spark: SparkSession, path: str) -> str | None:
    """Finish or undo a publish that died, by its journal; every publish starts
    with this, and so may a reader. The staged copy was whole and verified
    before the journal was written, so the table is rolled forward once the old
    one was moved away, and left as it is before that. Returns what was done."""
    if not exists(spark, _journal(path)):
        return None
    entry = json.loads(_read_text(spark, _journal(path)))
    staging, backup = entry["staging"], entry["backup"]
    if exists(spark, path):
        # before the first rename, or after the last one
        done = "completed" if exists(spark, backup) or not exists(spark, staging) else "undone"
        delete(spark, staging)
    elif exists(spark, staging):
        rename(spark, staging, path)
        done = "rolled forward"
    elif exists(spark, backup):
        rename(spark, backup, path)
        done = "restored"
    else:
        raise PublishError(f"{path}: neither table, staged copy nor backup is left")
    delete(spark, _journal(path))
    return done


def publish(df: DataFrame | Iterable[DataFrame], path: str, verify: Callable[[DataFrame], int] | None = None,
            keep_backup: bool = True, dry_run: bool = False, post_verify: bool = True,
            partition_by: list[str] | None = None, retain: int = 3) -> PublishResult:
    """``retain``: backups kept, the one of this publish included. Several
    DataFrames are the slices of one table: they are written one after the
    other, each asked for when the one before is stored."""
    parts = iter([df] if isinstance(df, DataFrame) else df)
    first = next(parts)
    spark = first.sparkSession
    if dry_run:  # SNK7: counts and violations, nothing written
        df = reduce(lambda a, b: a.unionByName(b), parts, first)
        rows = df.count()
        bad = int(verify(df)) if verify else 0
        return PublishResult(path, rows=rows, dry_run=True, violations=bad)

    recover(spark, path)
    stamp = time.strftime("%Y%m%d_%H%M%S") + f"_{time.time_ns() % 10**9:09d}_" + uuid.uuid4().hex[:6]
    staging = f"{path.rstrip('/')}._staging_{stamp}"
    backup = f"{path.rstrip('/')}._backup_{stamp}"
    metrics = write_observed(first, staging, "errorifexists", partition_by)
    for part in parts:
        more = write_observed(part, staging, "append", partition_by)
        metrics["rows"] = metrics["rows"] + more["rows"]
    if verify:
        bad = int(verify(spark.read.parquet(staging)))
        if bad:
            delete(spark, staging)
            raise PublishError(f"verification found {bad} violation(s); live table unchanged")
    if exists(spark, backup):
        delete(spark, staging)
        raise PublishError(f"backup {backup} already exists; inspect it first")
    had_live = exists(spark, path)
    _write_text(spark, _journal(path), json.dumps({"staging": staging, "backup": backup}))
    try:
        if had_live:
            rename(spark, path, backup)
        rename(spark, staging, path)
        if verify and post_verify:
            bad = int(verify(spark.read.parquet(path)))
            if bad:
                raise PublishError(f"post-publish verification found {bad} violation(s)")
    except Exception:
        if had_live and exists(spark, backup):
            delete(spark, path)
            rename(spark, backup, path)
        elif not had_live:
            delete(spark, path)
        delete(spark, staging)
        delete(spark, _journal(path))
        raise
    delete(spark, _journal(path))
    result = PublishResult(path, rows=int(metrics.get("rows", 0)), backup=backup if had_live else None,
                           metrics=metrics)
    if had_live and not keep_backup:  # SNK6: destructive swap, only after success
        delete(spark, backup)
        result.backup = None
    for old in backups(spark, path)[:-retain] if retain else []:
        delete(spark, old)
    return result


def publish_versioned(df: DataFrame, root: str) -> str:
    """Object-store friendly publish: write ``<root>/v=<n>``, then commit it
    with a row of its own. A crash between the two leaves the last version
    live; the retry replaces the uncommitted files."""
    spark = df.sparkSession
    current = read_current_version(spark, root)
    nxt = (current or 0) + 1
    target = f"{root.rstrip('/')}/v={nxt}"
    write_parquet(df, target, "overwrite")
    pointer = spark.createDataFrame([(nxt, target)], "version int, path string")
    write_once(pointer.coalesce(1), f"{root.rstrip('/')}/_commits/n={nxt}")
    return target


def read_current_version(spark: SparkSession, root: str) -> int | None:
    ptr = f"{root.rstrip('/')}/_commits"
    if not exists(spark, ptr):
        return None
    row = spark.read.parquet(ptr).agg(F.max("version").alias("v")).first()
    return None if row is None else row["v"]


def read_versioned(spark: SparkSession, root: str) -> DataFrame:
    v = read_current_version(spark, root)
    if v is None:
        raise PublishError(f"no published version under {root}")
    return spark.read.parquet(f"{root.rstrip('/')}/v={v}")
