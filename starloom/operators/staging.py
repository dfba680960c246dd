"""Declarative staging (OP1) and deterministic de-duplication (AG12).

``stage(df, spec)`` = typed projection -> text cleaning -> latest row per
business key -> derived columns. Bad rows are not filtered (as in the
reference); data-quality operators report them instead.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column, DataFrame, Observation, functions as F

from starloom.functions import money
from starloom.functions.text import apply_rule
from starloom.session import stored


def latest_per_key(df: DataFrame, keys: list[str], recency: list[str]) -> DataFrame:
    """Keep one row per ``keys``: the greatest ``recency`` columns, ties broken
    by every remaining column, so the survivor is deterministic (the reference's
    ``dropDuplicates`` keeps an arbitrary row). NULL recency sorts lowest.

    Expressed as ``max(struct(recency..., rest...))`` per key: a single
    aggregation with a map-side partial step, so a hot key collapses to one
    row per input partition before the shuffle (a window would route every
    row of a hot key to one task).
    """
    rest = [c for c in df.columns if c not in keys and c not in recency]
    order = recency + rest
    packed = F.max(F.struct(*[F.col(c) for c in order])).alias("_sl_latest")
    return df.groupBy(*keys).agg(packed).select(
        *keys, *[F.col(f"_sl_latest.{c}").alias(c) for c in order]
    ).select(*df.columns)


REPEATED_KEYS_BROADCAST = 1_000_000  # 8-byte hashes


def latest_of_repeated(df: DataFrame, keys: list[str], recency: list[str]) -> DataFrame:
    """``latest_per_key`` for a stored source whose keys rarely repeat: a first
    pass counts 8-byte hashes of the keys (a hash aggregation, no sort); only
    rows whose hash repeats pay for the grouping, all others pass through
    without a shuffle. Different keys that share a hash are grouped too, and
    kept apart there."""
    mark = F.xxhash64(*keys)
    found = Observation(f"repeated-{uuid.uuid4().hex[:8]}")  # counted by the job that stores them
    repeated = stored(df.groupBy(mark.alias("_sl_mark")).count().filter("count > 1").select("_sl_mark")
                      .observe(found, F.count(F.lit(1)).alias("n")), "repeated")
    n = found.get["n"]
    if not n:
        return df
    repeated = F.broadcast(repeated) if n <= REPEATED_KEYS_BROADCAST else repeated.hint("shuffle_hash")
    some = mark == F.col("_sl_mark")
    again = latest_per_key(df.join(repeated, some, "left_semi"), keys, recency)
    return df.join(repeated, some, "left_anti").unionByName(again)


@dataclass(frozen=True)
class StageSpec:
    name: str
    keys: tuple[str, ...]
    columns: tuple[tuple[str, str], ...]          # declared (name, type)
    recency: tuple[str, ...] = ("updated_at",)
    text: dict[str, str] = field(default_factory=dict)   # column -> rule
    derived: tuple[tuple[str, Callable[[], Column]], ...] = ()
    required: tuple[str, ...] = ()                       # NOT NULL in the source (keys always are)
    checks: tuple[tuple[str, Callable[[], Column]], ...] = ()   # must not be false, after cleaning

    @property
    def column_names(self) -> list[str]:
        return [c for c, _ in self.columns]


def _typed(df: DataFrame, spec: StageSpec) -> DataFrame:
    # try_cast at the raw boundary: a value that does not fit its declared type
    # becomes NULL (reported by the quality checks) instead of failing the job
    typed = df.select(*[F.col(c).try_cast(t).alias(c) for c, t in spec.columns])
    return typed.withColumns({c: apply_rule(rule, c) for c, rule in spec.text.items()})


def _finished(cleaned: DataFrame, spec: StageSpec, dedupe: bool) -> DataFrame:
    if dedupe:
        cleaned = latest_of_repeated(cleaned, list(spec.keys), [r for r in spec.recency if r in cleaned.columns])
    if spec.derived:
        cleaned = cleaned.withColumns({name: fn() for name, fn in spec.derived})
    return cleaned


def stage(df: DataFrame, spec: StageSpec, dedupe: bool = True) -> DataFrame:
    return _finished(_typed(df, spec), spec, dedupe)


def reject_reasons(spec: StageSpec) -> Column:
    """Why a raw row cannot be staged (empty: it can): ``cast:<column>`` for a
    value that does not fit its type, ``null:<column>`` for a missing key or
    required value, ``check:<name>`` for a broken source constraint."""
    types = dict(spec.columns)
    raw = {c: F.col(c) for c in types}
    typed = {c: raw[c].try_cast(t) for c, t in spec.columns}
    found = [F.when(raw[c].isNotNull() & typed[c].isNull(), F.lit(f"cast:{c}")) for c in types]
    found += [F.when(raw[c].isNull(), F.lit(f"null:{c}")) for c in dict.fromkeys([*spec.keys, *spec.required])]
    return F.filter(F.array(*found), lambda r: r.isNotNull())


def stage_split(df: DataFrame, spec: StageSpec, dedupe: bool = True) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): the staged rows, and the raw rows that cannot be
    staged, every column as text, with the array ``reasons``. A row is rejected
    as a whole, so rows whose key does not fit never collapse into one."""
    raw = df.select(*[F.col(c) for c in spec.column_names])
    judged = raw.withColumn("_sl_why", reject_reasons(spec)).withColumn("_sl_raw", F.struct(*spec.column_names))
    typed = judged.select("_sl_why", "_sl_raw", *[F.col(c).try_cast(t).alias(c) for c, t in spec.columns])
    typed = typed.withColumns({c: apply_rule(rule, c) for c, rule in spec.text.items()})
    broken = [F.when(~fn(), F.lit(f"check:{name}")) for name, fn in spec.checks]
    typed = typed.withColumn("_sl_why", F.concat("_sl_why", F.filter(F.array(*broken), lambda r: r.isNotNull()))
                             if broken else F.col("_sl_why"))
    rejected = typed.filter(F.size("_sl_why") > 0).select(
        *[F.col(f"_sl_raw.{c}").cast("string").alias(c) for c in spec.column_names], F.col("_sl_why").alias("reasons"))
    accepted = typed.filter(F.size("_sl_why") == 0).select(*spec.column_names)
    return _finished(accepted, spec, dedupe), rejected


MONEY = "decimal(10,2)"
TS = "timestamp_ntz"

# The domains of the source's constraints
ORDER_STATUSES = ["pending", "confirmed", "shipped", "delivered", "cancelled"]
PAYMENT_STATUSES = ["pending", "completed", "failed", "refunded"]

CUSTOMERS = StageSpec(
    name="customers",
    keys=("customer_id",),
    columns=(("customer_id", "bigint"), ("first_name", "string"), ("last_name", "string"),
             ("email", "string"), ("city", "string"), ("state", "string"), ("country", "string"),
             ("signup_date", "date"), ("updated_at", TS)),
    text={"first_name": "trim", "last_name": "trim", "email": "lower", "city": "trim",
          "state": "trim", "country": "trim"},
)

PRODUCTS = StageSpec(
    name="products",
    keys=("product_id",),
    columns=(("product_id", "bigint"), ("product_name", "string"), ("category", "string"),
             ("subcategory", "string"), ("unit_price", MONEY), ("cost_price", MONEY),
             ("supplier", "string"), ("updated_at", TS)),
    text={"product_name": "trim", "category": "initcap", "subcategory": "initcap", "supplier": "trim"},
    derived=(("profit_per_unit", lambda: money.unit_margin()),),
)

ORDERS = StageSpec(
    name="orders",
    keys=("order_id",),
    columns=(("order_id", "bigint"), ("customer_id", "bigint"), ("order_date", TS),
             ("order_status", "string"), ("updated_at", TS)),
    text={"order_status": "lower"},
    required=("customer_id", "order_date", "order_status"),
    checks=(("order_status", lambda: F.col("order_status").isin(ORDER_STATUSES)),),
)

# Orders and items as a source keeps them that ships to an address and numbers
# its items; the driver's tables have neither (``adapters`` builds the specs above).
SHIPPED_ORDERS = StageSpec(
    name="shipped_orders",
    keys=("order_id",),
    columns=(("order_id", "bigint"), ("customer_id", "bigint"), ("order_date", TS),
             ("order_status", "string"), ("shipping_city", "string"), ("shipping_state", "string"), ("updated_at", TS)),
    text={"order_status": "lower", "shipping_city": "trim", "shipping_state": "trim"},
    required=("customer_id", "order_date", "order_status"),
    checks=(("order_status", lambda: F.col("order_status").isin(ORDER_STATUSES)),),
)

NUMBERED_ITEMS = StageSpec(
    name="numbered_items",
    keys=("order_item_id",),
    columns=(("order_item_id", "bigint"), ("order_id", "bigint"), ("product_id", "bigint"), ("quantity", "int"),
             ("unit_price", MONEY), ("discount", MONEY)),
    recency=(),
    derived=(("line_total", lambda: money.line_total()),),
    required=("order_id", "product_id", "quantity", "unit_price", "discount"),
    checks=(("quantity_positive", lambda: F.col("quantity") > 0), ("unit_price_not_negative", lambda: F.col("unit_price") >= 0),
            ("discount_not_negative", lambda: F.col("discount") >= 0)),
)

ORDER_ITEMS = StageSpec(
    name="order_items",
    keys=("order_id", "line_number", "product_id", "supplier_id"),
    columns=(("order_id", "bigint"), ("line_number", "int"), ("product_id", "bigint"),
             ("supplier_id", "bigint"), ("quantity", "int"), ("unit_price", MONEY),
             ("discount", MONEY), ("updated_at", TS)),
    derived=(("line_total", lambda: money.line_total()),),
    required=("quantity", "unit_price", "discount"),
    checks=(("quantity_positive", lambda: F.col("quantity") > 0), ("unit_price_not_negative", lambda: F.col("unit_price") >= 0),
            ("discount_not_negative", lambda: F.col("discount") >= 0)),
)

PAYMENTS = StageSpec(
    name="payments",
    keys=("payment_id",),
    columns=(("payment_id", "bigint"), ("order_id", "bigint"), ("payment_method", "string"),
             ("payment_status", "string"), ("amount", MONEY), ("payment_date", TS)),
    recency=("payment_date",),
    text={"payment_method": "lower", "payment_status": "lower"},
    required=("order_id", "payment_method", "payment_status", "amount", "payment_date"),
    checks=(("payment_status", lambda: F.col("payment_status").isin(PAYMENT_STATUSES)),
            ("amount_not_negative", lambda: F.col("amount") >= 0)),
)

SPECS = {s.name: s for s in (CUSTOMERS, PRODUCTS, ORDERS, ORDER_ITEMS, PAYMENTS, SHIPPED_ORDERS, NUMBERED_ITEMS)}


def stage_customers(raw: DataFrame) -> DataFrame:
    return stage(raw, CUSTOMERS)


def stage_products(raw: DataFrame) -> DataFrame:
    return stage(raw, PRODUCTS)


def stage_orders(raw: DataFrame) -> DataFrame:
    return stage(raw, ORDERS)


def stage_order_items(raw: DataFrame) -> DataFrame:
    return stage(raw, ORDER_ITEMS)


def stage_payments(raw: DataFrame) -> DataFrame:
    return stage(raw, PAYMENTS)
