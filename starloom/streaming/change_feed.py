"""Structured Streaming form of the incremental change load (OP22 stream
variant).

A file (or any) streaming source delivers change-log rows; every micro-batch
is merged into a Type 2 dimension stored as a log of changed rows
(``sinks.dimension_log``): a batch writes rows in proportion to the keys it
changes, commits with one record, and is skipped when it is replayed. Rows
that come late are merged where they belong, or put aside with
``late="reject"``; rows without a key or a time are always put aside, so no row
stops the stream. ``trigger(availableNow=True)`` processes everything present
and stops: the streaming replacement of the reference's stored high-water
mark.

State lives under the cluster's ``spark.checkpoint.dir`` (shared storage).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from starloom.session import scratch_dir
from starloom.sinks.dimension_log import DimensionLog


def run_change_stream(spark: SparkSession, source: str, schema: StructType, key: str, ts: str,
                      tracked: list[str], tiebreak: str, version_key: str = "version_key",
                      root: str | None = None, base_path: str | None = None,
                      max_files_per_trigger: int | None = None, late: str = "merge",
                      compact_every: int | None = None) -> DimensionLog:
    """Run the stream to completion (availableNow) and return the stored
    dimension. ``root``: where it is kept (none: a folder that goes with the
    session). ``compact_every``: batches between compactions."""
    root = root or scratch_dir(spark, "stream")
    log = DimensionLog(spark, root, schema, key, ts, tiebreak, tracked, version_key)
    reader = spark.readStream.schema(schema)
    if base_path:
        reader = reader.option("basePath", base_path)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source).select(key, ts, tiebreak, *tracked)

    def body(df: DataFrame, batch_id: int) -> None:
        log.apply(df, batch_id, late=late)
        if compact_every and batch_id % compact_every == compact_every - 1:
            log.compact()
            log.vacuum()

    q = (stream.writeStream.foreachBatch(body)
         .option("checkpointLocation", f"{root}/_stream")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return log
