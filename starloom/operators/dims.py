"""Initial dimensions (OP2, OP3) and the calendar (OP4, SRC8)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.functions.calendar import calendar_columns, start_of_day
from starloom.functions.nulls import typed_null
from starloom.operators.keys import dense_key

CUSTOMER_ATTRS = ["first_name", "last_name", "email", "city", "state", "country"]
DIM_CUSTOMER_COLUMNS = ["customer_key", "customer_id", *CUSTOMER_ATTRS, "signup_date",
                        "effective_from", "effective_to", "is_current"]


def dim_customer_initial(stg_customers: DataFrame, start_key: int = 0) -> DataFrame:
    """OP2: one open version per customer starting at signup midnight; keys are
    dense by ``customer_id`` (deterministic, unlike the reference's
    ``monotonically_increasing_id``)."""
    base = stg_customers.select(
        "customer_id", *CUSTOMER_ATTRS, "signup_date",
        start_of_day("signup_date").alias("effective_from"),
        typed_null("timestamp_ntz").alias("effective_to"),
        F.lit(True).alias("is_current"),
    )
    return dense_key(base, ["customer_id"], "customer_key", start_key).select(*DIM_CUSTOMER_COLUMNS)


def dim_product(stg_products: DataFrame) -> DataFrame:
    """OP3 (Type 0/1 product dimension)."""
    base = stg_products.select("product_id", "product_name", "category", "subcategory",
                               "unit_price", "cost_price", "profit_per_unit", "supplier")
    return dense_key(base, ["product_id"], "product_key")


def dim_payment(stg_payments: DataFrame) -> DataFrame:
    """OP3: payment dimension (amount and date stay in staging)."""
    base = stg_payments.select("payment_id", "order_id", "payment_method", "payment_status")
    return dense_key(base, ["payment_id"], "payment_key")


def _as_date(d) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))


def dim_date(spark: SparkSession, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """OP4: one row per day of the inclusive range. Generated with
    ``spark.range`` (distributed, exact row-count statistics for the planner)
    rather than a single-row ``explode(sequence(...))``."""
    first, last = _as_date(start), _as_date(end)
    days = (last - first).days + 1
    if days <= 0:
        raise ValueError(f"empty calendar range {first}..{last}")
    parts = days // 4096 + 1
    base = spark.range(0, days, 1, parts).select(
        F.date_add(F.lit(first.isoformat()).cast("date"), F.col("id").cast("int")).alias("full_date")
    )
    cols = calendar_columns("full_date")
    return base.select(*[expr.alias(name) for name, expr in cols.items()])


def calendar_span(events: DataFrame, ts: str) -> tuple[str, str]:
    """Whole calendar years covering the data: Jan 1 of the first event's year
    to Dec 31 of the last event's year (one scalar aggregate)."""
    row = events.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi")).first()
    if row is None or row["lo"] is None:
        raise ValueError("cannot derive a calendar from an empty table")
    return f"{row['lo'].year:04d}-01-01", f"{row['hi'].year:04d}-12-31"
