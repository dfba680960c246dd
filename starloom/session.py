"""Session construction and cluster-facing settings.

On a cluster the session is created by the launcher; ``configure`` only fills
in settings that are unset, so an operator never overrides what the cluster
names (in particular ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the engine relies on. Applied only where the session has no value.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Tasks stay small as tables grow: joined and grouped rows take some 25
    # times their shuffled (compressed) bytes in memory, so small shuffle
    # partitions are merged up to 16 MB only and scans are split at 32 MB
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.files.maxPartitionBytes": "32m",
    # timestamps in the data are NTZ; pin the zone so casts are stable
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    conf = spark.conf
    for key, value in DEFAULTS.items():
        if conf.get(key, None) in (None, ""):
            conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    return spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint dir named by the cluster; set a local one only
    when none is configured (local runs and tests)."""
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    named = checkpoint_dir(spark)
    if not named:
        master = sc.master or ""
        if not master.startswith("local"):
            # a machine-local folder is not visible to other executors and is
            # lost with its machine: the cluster must name a shared one
            raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder (HDFS/S3/...) "
                               "for checkpoints and scratch tables")
        named = tempfile.mkdtemp(prefix="starloom-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(named)
    return named


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder, removed when the
    session's JVM ends."""
    path = f"{ensure_checkpoint_dir(spark)}/starloom-{name}-{uuid.uuid4().hex[:10]}"
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(p)
    fs.deleteOnExit(p)
    for made in getattr(_open, "scopes", [])[-1:]:
        made.append(path)
    return path


_open = threading.local()


@contextmanager
def scratch_released(spark: SparkSession):
    """Scratch folders made in the block, by this thread, are removed at its
    end: for steps whose result is stored elsewhere by then."""
    scopes = _open.__dict__.setdefault("scopes", [])
    scopes.append([])
    try:
        yield
    finally:
        for path in scopes.pop():
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


# A whole refresh runs hundreds of jobs. Shuffle files are else removed when the
# driver's JVM happens to collect the plans that made them; its tables are kept
# twice (live and backup), and written for few readers.
SMALL_ON_DISK = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


@contextmanager
def small_on_disk(spark: SparkSession):
    """``SMALL_ON_DISK`` holds in the block, where the cluster names nothing
    else: shuffle files go with the query that wrote them, Parquet is packed
    tighter."""
    named = spark.sparkContext.getConf()
    before = {k: spark.conf.get(k, None) for k in SMALL_ON_DISK if named.get(k, None) is None}
    for k in before:
        spark.conf.set(k, SMALL_ON_DISK[k])
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stored(df: DataFrame, name: str = "rows") -> DataFrame:
    """``df`` computed once into a scratch folder and read back: the lineage
    is cut as by a reliable checkpoint, but the last stage runs once (an eager
    checkpoint runs it to count and again to write), readers take the columns
    they need, and small files are read together."""
    path = scratch_dir(df.sparkSession, name) + "/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "starloom") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = (
        builder.config("spark.ui.enabled", "false")
        # checkpoint files of DataFrames that are no longer referenced are
        # removed by the context cleaner (sessions run many keyed builds)
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    if master and master.startswith("local"):
        builder = builder.config("spark.driver.memory", os.environ.get("STARLOOM_DRIVER_MEM", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def input_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below ``path``, on any store Spark reads."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return int(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength())


def size_partitions(spark: SparkSession, input_bytes: int, target_bytes: int = 256 << 20,
                    min_partitions: int | None = None) -> int:
    """Size ``spark.sql.shuffle.partitions`` so one shuffle partition holds about
    ``target_bytes`` of input (AQE then coalesces small ones), unless the
    session already names a value explicitly. The same number sets how many
    slices the range-partitioned operators (dense keys, neighbours) cut. Scan
    splits follow ``spark.sql.files.maxPartitionBytes`` (``DEFAULTS``)."""
    cores = spark.sparkContext.defaultParallelism
    wanted = max(min_partitions or cores, -(-input_bytes // target_bytes))
    explicit = spark.sparkContext.getConf().get("spark.sql.shuffle.partitions", None)
    if explicit is None:
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
        return wanted
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
