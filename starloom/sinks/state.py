"""Pipeline state table: stored high-water marks (SRC3, SNK9).

The state is a small DataFrame ``(pipeline_name, table_name,
last_processed_at, updated_at)`` published with the staged writer. Reading a
mark is a point lookup (one scalar); advancing it is an upsert by
``unionByName`` of the untouched rows and one new row computed from the
committed batch (``max`` of its change column). A missing state row is not
an error: it means "full load".
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

STATE_SCHEMA = ("pipeline_name string, table_name string, last_processed_at timestamp_ntz, "
                "updated_at timestamp_ntz")


def initial_state(spark: SparkSession, marks: list[tuple[str, str, str | dt.datetime | None]]) -> DataFrame:
    rows = [(p, t, dt.datetime.fromisoformat(m) if isinstance(m, str) else m, None) for p, t, m in marks]
    return spark.createDataFrame(rows, STATE_SCHEMA)


def read_watermark(state: DataFrame, pipeline: str, table: str):
    row = state.filter((F.col("pipeline_name") == pipeline) & (F.col("table_name") == table)).select(
        "last_processed_at").first()
    return None if row is None else row["last_processed_at"]


def advance(state: DataFrame, pipeline: str, table: str, batch: DataFrame, ts_col: str,
            bound: dt.datetime | None = None) -> DataFrame:
    """New state after ``batch`` was committed: the mark moves to the batch's
    highest change time (unchanged for an empty batch), or to ``bound``, the
    upper bound the batch was read with; other rows are kept.
    Adds ``rows_in_batch`` for the run report."""
    this = (F.col("pipeline_name") == pipeline) & (F.col("table_name") == table)
    old = read_watermark(state, pipeline, table)
    new = batch.agg(F.max(ts_col).alias("_m"), F.count(F.lit(1)).cast("long").alias("rows_in_batch")).select(
        F.lit(pipeline).alias("pipeline_name"), F.lit(table).alias("table_name"),
        F.coalesce(F.lit(bound).cast("timestamp_ntz"), F.col("_m"), F.lit(old).cast("timestamp_ntz")).alias("last_processed_at"),
        F.current_timestamp().cast("timestamp_ntz").alias("updated_at"), "rows_in_batch")
    kept = state.filter(~this).withColumn("rows_in_batch", F.lit(None).cast("long"))
    return kept.unionByName(new)
