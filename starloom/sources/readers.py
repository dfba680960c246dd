"""Typed readers and extraction primitives (SRC1-SRC11).

* full snapshots come from any ``DataFrameReader`` (JDBC reads are split
  into primary-key ranges so a table is read by many tasks, never into one
  driver-side frame);
* incremental extraction is a filter on the change column, pushed down to
  the source (JDBC ``WHERE`` / Parquet row-group statistics);
* CSV is always read with a declared schema and a corrupt-record column.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"


class ContractError(ValueError):
    pass


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str, lower: int, upper: int,
              num_partitions: int, properties: dict | None = None) -> DataFrame:
    """SRC1: full snapshot of a database table, read in ``num_partitions``
    primary-key ranges in parallel."""
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower, upperBound=upper,
                           numPartitions=num_partitions, properties=properties or {})


def read_csv(spark: SparkSession, path: str, schema: StructType, header: bool = True,
             keep_corrupt: bool = True) -> DataFrame:
    """SRC4/SRC5: CSV with a declared schema (never inferred: a header-only file
    would otherwise turn every column into a string). Rows that do not fit the
    schema keep their text in ``_corrupt_record`` (PERMISSIVE mode)."""
    fields = list(schema.fields)
    if keep_corrupt and CORRUPT not in schema.fieldNames():
        fields.append(StructField(CORRUPT, StringType(), True))
    reader = (spark.read.option("header", header).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT).schema(StructType(fields)))
    return reader.csv(path)


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """SRC6/SRC7: Parquet (a directory or a glob)."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def snapshot(df: DataFrame) -> DataFrame:
    """SRC1 over an already-open source: every row, every column."""
    return df


def changes_since(df: DataFrame, ts_col: str, watermark, lookback: dt.timedelta | None = None) -> DataFrame:
    """SRC2: rows with ``ts_col > watermark`` (strict, as the reference). A
    ``lookback`` re-reads a window before the mark to catch rows committed
    late with an older timestamp; the consumer de-duplicates by key. No
    watermark (no state row) means a full load."""
    if watermark is None:
        return df
    mark = watermark if not isinstance(watermark, str) else dt.datetime.fromisoformat(watermark)
    if lookback:
        mark = mark - lookback
    return df.filter(F.col(ts_col) > F.lit(mark).cast("timestamp_ntz"))


def require_columns(df: DataFrame, required: list[str], what: str = "input") -> DataFrame:
    """SRC9: fail naming the first missing column (metadata only, no job)."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ContractError(f"Missing {what} column(s): {', '.join(missing)}")
    return df


def is_empty(df: DataFrame) -> bool:
    """SRC10/SRC11: emptiness via a limit-1 job (not a full count)."""
    return df.isEmpty()


def corrupt_rows(df: DataFrame) -> DataFrame:
    """Rows of a CSV read that did not match the declared schema."""
    if CORRUPT not in df.columns:
        return df.limit(0)
    return df.filter(F.col(CORRUPT).isNotNull())


def register_views(tables: dict[str, DataFrame], suffix: str = "") -> dict[str, str]:
    """SRC7 / SNK8 (views): expose DataFrames to ``spark.sql`` text under
    ``name + suffix`` (a per-run suffix keeps concurrent runs apart). Returns
    name -> view name."""
    names = {}
    for name, df in tables.items():
        view = f"{name}{suffix}"
        df.createOrReplaceTempView(view)
        names[name] = view
    return names
