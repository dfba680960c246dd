"""Named queries: one entry per operator of the inventory.

Every callable takes ``(spark, sf_dir)``, reads the driver tables (whole
tables, no sampling) and returns a DataFrame whose columns match the DuckDB
oracle text of the same name in ``starloom.plans.oracle``.
"""

from __future__ import annotations

import functools
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DecimalType

from starloom.functions.nulls import typed_null
from starloom.operators import keys as key_ops, marts, quality as dq, reconcile as rec, scd
from starloom.operators.staging import ORDER_STATUSES, PAYMENT_STATUSES, latest_of_repeated, latest_per_key
from starloom.operators.temporal import MANY_VERSIONS, point_in_time_join as _pit, version_match_count as _vmc
from starloom.plans.warehouse import REQUIRED, Warehouse
from starloom.sources import adapters

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str | None = None):
    def register(fn):
        @functools.wraps(fn)
        def run(spark, sf_dir):
            return expose(fn(spark, sf_dir))
        QUERIES[name or fn.__name__] = run
        return fn
    return register


def expose(df: DataFrame) -> DataFrame:
    """Decimals leave a query as double (exact sums are taken before)."""
    if not any(isinstance(f.dataType, DecimalType) for f in df.schema.fields):
        return df
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType)
                       else F.col(f.name) for f in df.schema.fields])


def _wh(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse(spark, sf_dir)


# ------------------------------------------------------------------ staging
@query()
def stage_customers(spark, sf_dir):
    return _wh(spark, sf_dir).stg_customers


@query()
def stage_products(spark, sf_dir):
    return _wh(spark, sf_dir).stg_products


@query()
def stage_orders(spark, sf_dir):
    return _wh(spark, sf_dir).stg_orders


@query()
def stage_order_items(spark, sf_dir):
    return _wh(spark, sf_dir).stg_order_items


@query()
def stage_payments(spark, sf_dir):
    return _wh(spark, sf_dir).stg_payments


@query()
def dedupe_lineitem(spark, sf_dir):
    """AG12 on a key that really repeats: one line per (l_orderkey,
    l_linenumber), the latest ship date wins, remaining columns break ties."""
    li = _wh(spark, sf_dir).t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice", "l_discount")
    return latest_of_repeated(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query()
def dedupe_latest(spark, sf_dir):
    """AG12 on the change log: the latest event of every user (whole rows)."""
    ev = _wh(spark, sf_dir).t.events
    return latest_of_repeated(ev, ["user_id"], ["ts"])


def _faulty_orders(w: Warehouse) -> DataFrame:
    """The raw orders as text, as a careless export would deliver them: of the
    ids some have a letter in front, or none; some dates are no dates, some
    customers are missing, some states unknown."""
    text = adapters.raw_orders(w.t)
    text = text.select(*[F.col(c).cast("string").alias(c) for c in text.columns])
    n = F.col("order_id").cast("long")

    def where(step: int, c: str, value) -> F.Column:
        return F.when(n % step == 0, value).otherwise(F.col(c)).alias(c)
    return text.select(
        F.when(n % 97 == 0, F.concat(F.lit("A"), "order_id")).when(n % 101 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("order_id")).alias("order_id"),
        where(79, "customer_id", F.lit(None).cast("string")), where(89, "order_date", F.lit("not a date")),
        where(83, "order_status", F.lit("lost")), F.col("updated_at"))


@query()
def stage_rejected(spark, sf_dir):
    """OP1/CST1: what a faulty delivery of all orders gives: accepted orders
    by status, rejected rows by their reasons."""
    from starloom.operators.staging import ORDERS, stage_split
    accepted, rejected = stage_split(_faulty_orders(_wh(spark, sf_dir)), ORDERS)
    n = F.count(F.lit(1)).cast("long").alias("n_rows")
    return (accepted.groupBy(F.lit("accepted").alias("outcome"), F.col("order_status").alias("detail")).agg(n)
            .unionByName(rejected.groupBy(F.lit("rejected").alias("outcome"),
                                          F.array_join("reasons", ",").alias("detail")).agg(n)))


# --------------------------------------------------------------- dimensions
@query()
def dim_customer_initial(spark, sf_dir):
    return _wh(spark, sf_dir).dim_customer


@query()
def dim_product(spark, sf_dir):
    return _wh(spark, sf_dir).dim_product


@query()
def dim_payment(spark, sf_dir):
    return _wh(spark, sf_dir).dim_payment


@query()
def dim_date(spark, sf_dir):
    return _wh(spark, sf_dir).dim_date


# --------------------------------------------------------------------- fact
@query()
def fact_orders(spark, sf_dir):
    return _wh(spark, sf_dir).fact


# -------------------------------------------------------------------- marts
@query()
def daily_sales(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return marts.daily_sales(w.sales, w.dim_date)


@query()
def mart_daily_sales(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return marts.mart_daily_sales(w.sales, w.dim_date)


@query()
def product_performance(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return marts.product_performance(w.sales, w.dim_product)


@query()
def mart_product_performance(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return marts.mart_product_performance(w.sales, w.dim_product)


@query()
def customer_sales(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return marts.customer_sales(w.sales, w.dim_customer)


@query()
def mart_customer_performance(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return marts.mart_customer_performance(w.sales, w.dim_customer)


@query()
def mart_category_performance(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return marts.mart_category_performance(w.sales, w.dim_product)


@query()
def mart_payment_analysis(spark, sf_dir):
    return marts.mart_payment_analysis(_wh(spark, sf_dir).stg_payments)


@query()
def customers_without_sales(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return marts.customers_without_sales(w.sales, w.dim_customer)


@query()
def versions_without_sales(spark, sf_dir):
    """OP20 on a dimension with late moves: of the versions opened then, only
    some have sales."""
    w = _wh(spark, sf_dir)
    dim = scd.scd2_merge(w.dim_customer, _customer_moves(w, LATE_MOVE_AT), scd.CUSTOMER_SCD2)
    return marts.customers_without_sales(w.sales_with(dim), dim)


@query()
def orders_without_items(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return marts.orders_without_items(w.stg_orders, w.stg_order_items)


@query()
def kpi_totals(spark, sf_dir):
    return marts.kpi_totals(_wh(spark, sf_dir).sales)


@query()
def revenue_by_category(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return marts.revenue_by_category(w.sales, w.dim_product)


@query()
def payment_amount_by_method(spark, sf_dir):
    return marts.payment_amount_by_method(_wh(spark, sf_dir).stg_payments)


@query()
def payment_status_counts(spark, sf_dir):
    return marts.payment_status_counts(_wh(spark, sf_dir).stg_payments)


@query()
def top10_products(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return marts.top_products(w.sales, w.dim_product, 10)


@query()
def top10_customers(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return marts.top_customers(w.sales, w.dim_customer, 10)


# ======================================================== SCD / temporal

# Fixed scenario values (shared with the oracle text):
EVENTS_MARK = "2024-01-01 12:00:00"    # stored high-water mark of the events load
MOVE_REGION = "EUROPE"                  # customers of this region move ...
MOVE_CITY = "BERLIN"                    # ... to this city ...
MOVE_AT = "1998-01-01 00:00:00"         # ... at this time
LATE_MOVE_AT = "2001-11-15 00:00:00"    # a move near the end of the order dates
SCD1_STATE = "NATION_3"                 # SCD1 corrections for this state
WHAT_IF_ID, WHAT_IF_CITY, WHAT_IF_AT = 7, "LISBON", "1999-06-01 08:30:00"
WATERMARK = "2000-01-01 00:00:00"       # stored high-water mark for orders

EVENT_SCD2 = scd.Scd2Spec(key="user_id", version_key="version_key", tracked=("event_type",),
                          change_ts="ts")


def _ts(s: str):
    return F.lit(s).cast("timestamp_ntz")


def _events(w: Warehouse) -> DataFrame:
    return w.t.events.select("user_id", "ts", "event_id", "event_type")


def _open_versions(events: DataFrame) -> DataFrame:
    """One open version per user of a one-row-per-user event table."""
    s = events.select("user_id", "event_type", F.col("ts").alias("effective_from"),
                      typed_null("timestamp_ntz").alias("effective_to"), F.lit(True).alias("is_current"))
    return key_ops.dense_key(s, ["user_id"], "version_key")


def _event_log(w: Warehouse, root: str):
    """An empty stored dimension of the users' event types."""
    from starloom.sinks.dimension_log import DimensionLog
    return DimensionLog(w.spark, root, _events(w).schema, "user_id", "ts", "event_id", ["event_type"])


def _event_base_dim(w: Warehouse) -> DataFrame:
    """Dimension state after the first event of every user."""
    first = _events(w).groupBy("user_id").agg(F.min(F.struct("ts", "event_id", "event_type")).alias("r"))
    return _open_versions(first.select("user_id", "r.*"))


def _event_marked_dim(w: Warehouse) -> DataFrame:
    """Dimension state at the stored mark of the incremental load."""
    seen = _events(w).filter(F.col("ts") < _ts(EVENTS_MARK))
    return _open_versions(latest_per_key(seen, ["user_id"], ["ts", "event_id"]))


def _event_snapshot(w: Warehouse) -> DataFrame:
    """The last event of every user."""
    return latest_per_key(_events(w), ["user_id"], ["ts", "event_id"]).select("user_id", "event_type", "ts")


def _later_events(w: Warehouse, base: DataFrame) -> DataFrame:
    start = base.select("user_id", F.col("effective_from").alias("_from"))
    return _events(w).join(start, "user_id").filter(F.col("ts") > F.col("_from")).drop("_from")


def _event_feed(w: Warehouse, base: DataFrame) -> DataFrame:
    """Strict feed: the latest event per user after its open version."""
    return latest_per_key(_later_events(w, base), ["user_id"], ["ts", "event_id"]).select("user_id", "event_type", "ts")


def _snapshot_merge(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return scd.scd2_merge(_event_base_dim(w), _event_snapshot(w), EVENT_SCD2, mode="snapshot",
                          return_parts=True)


def _customer_moves(w: Warehouse, at: str = MOVE_AT) -> DataFrame:
    moved = F.col("country") == MOVE_REGION
    return w.stg_customers.withColumns({
        "city": F.when(moved, F.lit(MOVE_CITY)).otherwise(F.col("city")),
        "updated_at": F.when(moved, _ts(at)).otherwise(F.col("updated_at")),
    })


def dim_customer_moved(w: Warehouse) -> DataFrame:
    return scd.scd2_merge(w.dim_customer, _customer_moves(w), scd.CUSTOMER_SCD2, mode="snapshot")


def _moved_with_fact_dims(w: Warehouse, others=("dim_product", "dim_payment")) -> DataFrame:
    """The moved customer dimension, built while the ``others`` are keyed (independent jobs overlap)."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=1) as pool:
        moved = pool.submit(dim_customer_moved, w)
        w.build_dimensions(others)
        return moved.result()


@query()
def scd2_from_log(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return scd.scd2_from_log(adapters.change_log(w.t), "user_id", "ts", ["event_type"], ["event_id"])


@query()
def scd2_merge_snapshot(spark, sf_dir):
    return _snapshot_merge(spark, sf_dir)[0]


@query()
def scd2_close_current(spark, sf_dir):
    return _snapshot_merge(spark, sf_dir)[1]


@query()
def scd2_new_versions(spark, sf_dir):
    return _snapshot_merge(spark, sf_dir)[2]


@query()
def scd2_merge_strict(spark, sf_dir):
    w = _wh(spark, sf_dir)
    base = _event_base_dim(w)
    return scd.scd2_merge(base, _event_feed(w, base), EVENT_SCD2, mode="strict")


@query()
def scd2_log_rejected(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return scd.scd2_late_rows(_event_base_dim(w), _events(w), "user_id", "ts")


@query()
def scd2_customer_moves(spark, sf_dir):
    return dim_customer_moved(_wh(spark, sf_dir))


@query()
def scd2_what_if(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return scd.scd2_what_if(w.dim_customer, w.stg_customers, WHAT_IF_ID, {"city": WHAT_IF_CITY}, WHAT_IF_AT)


@query()
def scd1_upsert(spark, sf_dir):
    w = _wh(spark, sf_dir)
    fix = w.stg_customers.filter(F.col("state") == SCD1_STATE).select(
        "customer_id", "first_name", "last_name", typed_null("string").alias("email"),
        F.concat("city", F.lit(" NORTH")).alias("city"), "state", "country", "updated_at")
    attrs = ["first_name", "last_name", "email", "city", "state", "country"]
    return scd.scd1_upsert(w.dim_customer, fix, "customer_id", attrs)


@query()
def scd2_repair_start(spark, sf_dir):
    """The moved dimension loaded late (every first version starts 45 days
    after signup) is repaired back to signup midnight."""
    w = _wh(spark, sf_dir)
    late = dim_customer_moved(w).withColumn(
        "effective_from",
        F.when(F.col("effective_from") == F.col("signup_date").cast("timestamp_ntz"),
               F.col("effective_from") + F.expr("INTERVAL 45 DAYS")).otherwise(F.col("effective_from")))
    return scd.scd2_repair_start(late)


@query()
def point_in_time_join(spark, sf_dir):
    """Every event matched to the version of its user valid at its time
    (keys with a long history through the interval index)."""
    w = _wh(spark, sf_dir)
    versions = scd.scd2_from_log(adapters.change_log(w.t), "user_id", "ts", ["event_type"], ["event_id"])
    v = versions.select("user_id", F.col("event_type").alias("version_type"), "effective_from", "effective_to")
    ev = w.t.events.select("event_id", "user_id", "ts", "event_type")
    return _pit(ev, v, "user_id", "ts", many=MANY_VERSIONS).select(
        "event_id", "user_id", "ts", "event_type", "version_type", "effective_from")


@query()
def version_match_count(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return _vmc(w.stg_orders, dim_customer_moved(w), "order_id", "customer_id", "order_date", "customer_key",
                many=MANY_VERSIONS)


@query()
def fact_orders_versioned(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return w.fact_with(_moved_with_fact_dims(w))


@query()
def customer_sales_versioned(spark, sf_dir):
    w = _wh(spark, sf_dir)
    dim = _moved_with_fact_dims(w, ("dim_product",))
    return marts.customer_sales(w.sales_with(dim), dim)


# ================================================================ keys
@query()
def surrogate_key_dense(spark, sf_dir):
    li = _wh(spark, sf_dir).t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return key_ops.dense_key(li, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], "item_key")


@query()
def surrogate_key_continue(spark, sf_dir):
    """A party dimension: customers keyed first, suppliers continue after the
    highest customer key."""
    t = _wh(spark, sf_dir).t
    cust = key_ops.dense_key(t.customer.select(F.col("c_custkey").alias("party_id"),
                                               F.lit("customer").alias("party_type")),
                             ["party_id"], "party_key")
    sup = t.supplier.select(F.col("s_suppkey").alias("party_id"), F.lit("supplier").alias("party_type"))
    return cust.unionByName(key_ops.continue_keys(cust, sup, "party_key", ["party_id"]))


# ============================================================ extraction
@query()
def snapshot_extract(spark, sf_dir):
    from starloom.sources.readers import snapshot
    return snapshot(adapters.raw_orders(_wh(spark, sf_dir).t))


@query()
def incremental_extract(spark, sf_dir):
    from starloom.sinks.state import initial_state, read_watermark
    from starloom.sources.readers import changes_since
    state = initial_state(spark, [("warehouse", "orders", WATERMARK)])
    wm = read_watermark(state, "warehouse", "orders")
    return changes_since(adapters.raw_orders(_wh(spark, sf_dir).t), "updated_at", wm)


@query()
def watermark_next(spark, sf_dir):
    from starloom.sinks.state import advance, initial_state, read_watermark
    from starloom.sources.readers import changes_since
    state = initial_state(spark, [("warehouse", "orders", WATERMARK)])
    wm = read_watermark(state, "warehouse", "orders")
    batch = changes_since(adapters.raw_orders(_wh(spark, sf_dir).t), "updated_at", wm)
    return advance(state, "warehouse", "orders", batch, "updated_at").select(
        "pipeline_name", "table_name", "last_processed_at", "rows_in_batch")


@query()
def order_totals(spark, sf_dir):
    return rec.order_totals(_wh(spark, sf_dir).stg_order_items)


# ========================================================= data quality
def _fact_marts(w: Warehouse):
    f = w.sales
    return {
        "daily": marts.mart_daily_sales(f, w.dim_date),
        "product": marts.product_performance(f, w.dim_product),
        "customer": marts.customer_sales(f, w.dim_customer),
        "category": marts.mart_category_performance(f, w.dim_product),
        "payment": marts.mart_payment_analysis(w.stg_payments),
    }


def _declared_marts(w: Warehouse):
    """The marts in the shape their declared tests name."""
    f = w.sales
    return {
        "mart_daily_sales": marts.mart_daily_sales(f, w.dim_date),
        "mart_product_performance": marts.mart_product_performance(f, w.dim_product),
        "mart_customer_performance": marts.mart_customer_performance(f, w.dim_customer),
        "mart_category_performance": marts.mart_category_performance(f, w.dim_product),
        "mart_payment_analysis": marts.mart_payment_analysis(w.stg_payments),
    }


@query()
def dq_not_null(spark, sf_dir):
    w = _wh(spark, sf_dir)
    m = _declared_marts(w.store_fact())
    tables = {"fact_orders": w.fact, "dim_customer": w.dim_customer, **m}
    return dq.union_all([dq.not_null(tables[t], t, columns) for t, columns in REQUIRED.items()])


@query()
def dq_row_rules(spark, sf_dir):
    """DQ1/DQ4-DQ7/DQ10: every rule that a row alone can break, all rules of a
    table in one aggregate over one scan of it."""
    w = _wh(spark, sf_dir).store_fact()
    c = F.col
    return dq.union_all([
        dq.table_rules(w.fact, "fact_orders", [
            *dq.not_null_rules(*REQUIRED["fact_orders"]),
            *dq.range_rules(quantity_not_positive=c("quantity") <= 0, unit_price_negative=c("unit_price") < 0,
                            discount_negative=c("discount") < 0, revenue_negative=c("revenue") < 0),
            *dq.identity_rules(), dq.null_key_rule()]),
        dq.table_rules(w.stg_orders, "stg_orders", [
            *dq.not_null_rules("order_id", "customer_id", "order_date", "order_status"),
            *dq.accepted_rules(order_status=ORDER_STATUSES)]),
        dq.table_rules(w.stg_payments, "stg_payments", [
            *dq.not_null_rules("payment_id", "order_id", "payment_method", "payment_status", "amount", "payment_date"),
            *dq.accepted_rules(payment_status=PAYMENT_STATUSES, payment_method=PAYMENT_METHODS),
            *dq.range_rules(amount_negative=c("amount") < 0)]),
        dq.table_rules(w.stg_products, "stg_products", [
            *dq.not_null_rules("product_id", "product_name", "category"),
            *dq.range_rules(unit_price_negative=c("unit_price") < 0, cost_price_negative=c("cost_price") < 0,
                            margin_negative=c("profit_per_unit") < 0)]),
    ])


@query()
def dq_unique(spark, sf_dir):
    w = _wh(spark, sf_dir)
    m = _fact_marts(w)
    declared = _declared_marts(w)
    return dq.union_all([
        dq.unique(declared["mart_daily_sales"], "mart_daily_sales", "full_date"),
        dq.unique(declared["mart_product_performance"], "mart_product_performance", "product_key"),
        dq.unique(declared["mart_customer_performance"], "mart_customer_performance", "customer_key"),
        dq.unique(w.dim_date, "dim_date", "full_date"),
        dq.unique(w.dim_product, "dim_product", "product_key"),
        dq.unique(w.dim_customer, "dim_customer", "customer_key"),
        dq.unique(m["category"], "mart_category_performance", "category"),
        dq.unique(w.stg_customers, "stg_customers", "email"),
        dq.unique(w.stg_customers, "stg_customers", "customer_id"),
        dq.unique(w.stg_products, "stg_products", "product_id"),
        dq.unique(w.stg_orders, "stg_orders", "order_id"),
        dq.unique(w.stg_payments, "stg_payments", "payment_id"),
    ])


@query()
def dq_relationships(spark, sf_dir):
    w = _wh(spark, sf_dir)
    m = _fact_marts(w.store_fact())
    declared = _declared_marts(w)
    f = w.fact
    return dq.union_all([
        dq.relationship(f, "fact_orders", "customer_key", w.dim_customer, "customer_key"),
        dq.relationship(f, "fact_orders", "product_key", w.dim_product, "product_key"),
        dq.relationship(f, "fact_orders", "date_key", w.dim_date, "date_key"),
        dq.relationship(f, "fact_orders", "payment_key", w.dim_payment, "payment_key"),
        dq.relationship(declared["mart_product_performance"], "mart_product_performance", "product_key",
                        w.dim_product, "product_key"),
        dq.relationship(declared["mart_customer_performance"], "mart_customer_performance", "customer_key",
                        w.dim_customer, "customer_key"),
        dq.relationship(w.stg_payments, "stg_payments", "order_id", w.stg_orders, "order_id"),
        dq.relationship(w.stg_order_items, "stg_order_items", "product_id", w.stg_products, "product_id"),
        dq.relationship(m["product"], "product_performance", "product_key", w.dim_product, "product_key"),
        dq.relationship(m["customer"], "customer_sales", "customer_key", w.dim_customer, "customer_key"),
        dq.relationship(w.stg_orders, "stg_orders", "customer_id", w.stg_customers, "customer_id"),
        dq.relationship(w.stg_order_items, "stg_order_items", "order_id", w.stg_orders, "order_id"),
    ])


# Fixed domain of the source:
PAYMENT_METHODS = ["credit_card", "debit_card", "upi", "net_banking"]


@query()
def dq_accepted_values(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return dq.union_all([
        dq.accepted_values(w.stg_orders, "stg_orders", {"order_status": ORDER_STATUSES}),
        dq.accepted_values(w.stg_payments, "stg_payments", {"payment_status": PAYMENT_STATUSES,
                                                           "payment_method": PAYMENT_METHODS}),
    ])


@query()
def dq_ranges(spark, sf_dir):
    w = _wh(spark, sf_dir)
    c = F.col
    return dq.union_all([
        dq.ranges(w.sales, "fact_orders", {"quantity_not_positive": c("quantity") <= 0,
                                          "unit_price_negative": c("unit_price") < 0,
                                          "discount_negative": c("discount") < 0,
                                          "revenue_negative": c("revenue") < 0}),
        dq.ranges(w.stg_products, "stg_products", {"unit_price_negative": c("unit_price") < 0,
                                                   "cost_price_negative": c("cost_price") < 0,
                                                   "margin_negative": c("profit_per_unit") < 0}),
        dq.ranges(w.stg_payments, "stg_payments", {"amount_negative": c("amount") < 0}),
    ])


@query()
def dq_revenue_identity(spark, sf_dir):
    return dq.revenue_identity(_wh(spark, sf_dir).sales)


@query()
def dq_orders_before_signup(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return dq.orders_before_signup(w.stg_orders, w.stg_customers)


@query()
def dq_null_keys(spark, sf_dir):
    return dq.null_keys(_wh(spark, sf_dir).fact)


@query()
def dq_duplicate_fact_groups(spark, sf_dir):
    return dq.duplicate_fact_groups(_wh(spark, sf_dir).sales)


@query()
def dq_scd2_integrity(spark, sf_dir):
    return scd.scd2_integrity(dim_customer_moved(_wh(spark, sf_dir)))


@query()
def dq_change_feed(spark, sf_dir):
    """DQ19 on a raw feed (every event after the first, not reduced per user)
    against the event dimension: duplicates and unknown ids are reported."""
    w = _wh(spark, sf_dir)
    base = _event_base_dim(w)
    feed = _later_events(w, base).select("user_id", "event_type", "ts")
    return scd.scd2_violations(base, feed, EVENT_SCD2, mode="strict", on_new="reject")


# ======================================================== reconciliation
@query()
def reconcile_revenue(spark, sf_dir):
    w = _wh(spark, sf_dir)
    m = _fact_marts(w.store_fact("sales"))
    return rec.revenue_report(w.sales, m["daily"], m["product"], m["customer"], m["category"])


@query()
def reconcile_orders(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return rec.orders_report(w.sales, _fact_marts(w.store_fact("sales"))["daily"])


@query()
def reconcile_coverage(spark, sf_dir):
    w = _wh(spark, sf_dir)
    m = _fact_marts(w.store_fact("sales"))
    return rec.coverage_report(w.sales, w.dim_product, m["product"], m["customer"], m["category"])


@query()
def reconcile_payments(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return rec.payments_report(w.stg_payments, marts.mart_payment_analysis(w.stg_payments), w.stg_order_items)


@query()
def reconcile_payments_paid(spark, sf_dir):
    """DQ15/AG14 on payments that pay what their order's items come to, as the
    source writes them: every check passes."""
    w = _wh(spark, sf_dir)
    totals = rec.order_totals(w.stg_order_items).select("order_id", "order_total")
    paid = w.stg_payments.join(totals, "order_id").withColumn("amount", F.col("order_total")).drop("order_total")
    return rec.payments_report(paid, marts.mart_payment_analysis(paid), w.stg_order_items)


@query()
def dq_null_measures(spark, sf_dir):
    w = _wh(spark, sf_dir)
    m = _fact_marts(w.store_fact("sales"))
    return rec.null_measures({"mart_daily_sales": (m["daily"], "total_revenue"),
                              "product_performance": (m["product"], "total_revenue"),
                              "customer_sales": (m["customer"], "total_revenue"),
                              "mart_category_performance": (m["category"], "total_revenue"),
                              "mart_payment_analysis": (m["payment"], "total_payment_amount")})


# ============================================ publish / incremental / stream
def _scratch(spark, name: str) -> str:
    """A fresh directory under the cluster's checkpoint dir (shared storage)."""
    from starloom.session import scratch_dir
    return scratch_dir(spark, name)


@query()
def publish_roundtrip(spark, sf_dir):
    """SNK4/SNK5: publish the customer dimension twice through the staged
    protocol (the second run moves the first to a backup), verify after the
    write, and read the live table back."""
    from starloom.sinks.publish import publish
    w = _wh(spark, sf_dir)
    path = _scratch(spark, "publish") + "/dim_customer"
    integrity = lambda df: scd.scd2_integrity(df).agg(F.sum("violations")).first()[0]
    publish(w.dim_customer, path, verify=integrity)
    publish(w.dim_customer, path, verify=integrity)
    return spark.read.parquet(path)


@query()
def incremental_load(spark, sf_dir):
    """OP22: stored mark -> events after it -> appended to the event
    dimension -> published -> mark advanced. Returns the new dimension."""
    from starloom.plans.incremental import incremental_run
    from starloom.sinks.publish import publish
    from starloom.sinks.state import initial_state
    w = _wh(spark, sf_dir)
    base = _event_marked_dim(w)
    state = initial_state(spark, [("warehouse", "events", EVENTS_MARK)])
    path = _scratch(spark, "incremental") + "/dim_events"
    run = incremental_run(
        w.t.events, state, "warehouse", "events", "ts",
        apply=lambda batch: scd.scd2_apply_log(base, batch, "user_id", "ts", ["event_type"], "event_id",
                                               "version_key"),
        publish=lambda df: publish(df, path))
    return spark.read.parquet(path) if run.applied else base


@query()
def incremental_stream(spark, sf_dir):
    """OP22 stream variant: the events file as a streaming source,
    availableNow trigger, foreachBatch merge into the event dimension."""
    import os
    from starloom.streaming.change_feed import run_change_stream
    src = os.path.join(sf_dir, "event[s].parquet")
    schema = _wh(spark, sf_dir).t.events.schema
    log = run_change_stream(spark, src, schema, "user_id", "ts", ["event_type"], "event_id", base_path=sf_dir)
    return log.versions().drop("last_seen")


@query()
def scd2_log_two_batches(spark, sf_dir):
    """OP5/DQ19: the whole log in two batches whose times interleave, so that
    the second holds late rows of nearly every key: its rows split versions,
    confirm them or join their neighbours. Same versions as ``scd2_from_log``."""
    w = _wh(spark, sf_dir)
    log = _event_log(w, _scratch(spark, "batches"))
    second = F.pmod(F.col("event_id"), F.lit(3)) == 0
    for part in (~second, second):
        log.apply(_events(w).filter(part))
    return log.versions().drop("version_key")


@query()
def incremental_stream_files(spark, sf_dir):
    """OP22: the events arrive in three deliveries whose times interleave; the
    stream takes up each as a micro-batch, merged on read and compacted after
    the second."""
    from starloom.streaming.change_feed import run_change_stream
    w = _wh(spark, sf_dir)
    root = _scratch(spark, "files")
    for i in range(3):
        _events(w).filter(F.pmod(F.col("event_id"), F.lit(3)) == i).write.parquet(f"{root}/feed/part{i}")
        log = run_change_stream(spark, f"{root}/feed/part*", _events(w).schema, "user_id", "ts", ["event_type"], "event_id",
                                root=f"{root}/state", base_path=f"{root}/feed", compact_every=2)
    return log.versions().drop("version_key")


@query()
def incremental_two_runs(spark, sf_dir):
    """OP22 with stored state: a run over what the source held at the old
    mark, then one over everything; each reads its mark from the last commit
    and stores the new one with its rows. Returns the dimension with the
    stored mark and the number of commits."""
    from starloom.plans.incremental import incremental_log_run
    w = _wh(spark, sf_dir)
    log = _event_log(w, _scratch(spark, "runs"))
    incremental_log_run(_events(w).filter(F.col("ts") < _ts(EVENTS_MARK)), log)
    incremental_log_run(_events(w), log)
    last = log.last()
    return log.versions().drop("version_key").withColumns({
        "stored_mark": F.lit(last.mark).cast("timestamp_ntz"), "commits": F.lit(last.seq + 1).cast("long")})


@query()
def dq_fact_grain(spark, sf_dir):
    """OP10 grain: order lines that appear more than once in the fact (payment
    fan-out) and order lines that the inner joins dropped."""
    from starloom.operators.fact import fact_orders as build_fact
    w = _wh(spark, sf_dir)
    line = ["order_id", "line_number", "product_id", "supplier_id"]
    f = build_fact(w.stg_orders, w.stg_order_items, w.dim_customer, w.dim_product, w.dim_date,
                   w.dim_payment, keep_line_id=True)
    fanned = f.groupBy(*line).count().filter("count > 1")
    dropped = w.stg_order_items.select(*line).join(f.select(*line).distinct(), line, "left_anti")
    return dq.union_all([dq.violation_count(fanned, "fact_grain_fan_out", "fact_orders", ",".join(line)),
                         dq.violation_count(dropped, "fact_grain_dropped_lines", "stg_order_items", ",".join(line))])


@query()
def dq_version_matches(spark, sf_dir):
    """DQ18: orders that do not match exactly one customer version."""
    w = _wh(spark, sf_dir)
    m = _vmc(w.stg_orders, w.dim_customer, "order_id", "customer_id", "order_date", "customer_key")
    return dq.violation_count(m.filter(F.col("match_count") != 1), "exactly_one_version", "orders", "customer_id")


@query()
def mart_daily_sales_sql(spark, sf_dir):
    """OP13 through the SQL text surface: the warehouse tables are registered
    as temporary views and the mart is plain ``spark.sql`` text (the dbt
    model's form); Catalyst plans it like the DataFrame version."""
    import uuid
    from starloom.sources.readers import register_views
    w = _wh(spark, sf_dir)
    v = register_views({"fact_orders": w.sales, "dim_date": w.dim_date}, "_" + uuid.uuid4().hex[:8])
    return spark.sql(f"""
        WITH basket AS (
            SELECT date_key, order_id, sum(quantity) AS pieces, sum(revenue) AS amount
            FROM {v["fact_orders"]} GROUP BY date_key, order_id
        ), trading_day AS (
            SELECT date_key, count(*) AS baskets, sum(pieces) AS pieces, sum(amount) AS amount
            FROM basket GROUP BY date_key
        )
        SELECT cal.full_date, cal.year, cal.month, cal.month_name, cal.quarter, baskets AS total_orders,
               bigint(pieces) AS total_items_sold, double(amount) AS total_revenue,
               double(amount) / baskets AS average_order_value
        FROM trading_day JOIN {v["dim_date"]} AS cal USING (date_key)""")


@query()
def daily_sales_ordered(spark, sf_dir):
    """SO2: the daily mart written in the order of its days, with each row's
    place as read back from the files."""
    from starloom.sinks.publish import read_ordered, write_ordered
    w = _wh(spark, sf_dir)
    path = _scratch(spark, "ordered") + "/daily"
    write_ordered(marts.daily_sales(w.sales, w.dim_date), path, ["full_date"])
    return read_ordered(spark, path)


@query()
def incremental_extract_ordered(spark, sf_dir):
    """SO3: the change set after the stored mark in the order of its change
    times, ties by id."""
    from starloom.sinks.publish import read_ordered, write_ordered
    path = _scratch(spark, "extract") + "/orders"
    write_ordered(incremental_extract(spark, sf_dir), path, ["updated_at", "order_id"])
    return read_ordered(spark, path)


@query()
def catalog_bucketed_join(spark, sf_dir):
    """SNK8: staged orders and items as catalog tables bucketed by order;
    joined and summed per order without another exchange."""
    import uuid
    from starloom.sinks.publish import save_table
    w = _wh(spark, sf_dir)
    root, name = _scratch(spark, "catalog"), uuid.uuid4().hex[:8]
    orders = save_table(w.stg_orders, f"stg_orders_{name}", path=f"{root}/orders", bucket_by=["order_id"])
    items = save_table(w.stg_order_items, f"stg_order_items_{name}", path=f"{root}/items", bucket_by=["order_id"])
    return orders.join(items, "order_id").groupBy("order_id", "order_status").agg(
        F.count(F.lit(1)).alias("item_count"), F.sum("line_total").cast("double").alias("order_total"))


@query()
def fact_orders_asof(spark, sf_dir):
    """OP10 with the customer version resolved by the as-of stream join
    (hot-key safe): identical rows to ``fact_orders`` for a valid SCD2."""
    from starloom.operators.fact import fact_orders as build_fact
    w = _wh(spark, sf_dir)
    w.build_dimensions()
    return build_fact(w.stg_orders, w.stg_order_items, w.dim_customer, w.dim_product, w.dim_date,
                      w.dim_payment, pit="asof")


@query()
def dq_repair_checks(spark, sf_dir):
    """OP9 guards on the repaired moved dimension against all staged orders."""
    w = _wh(spark, sf_dir)
    moved = dim_customer_moved(w)
    late = moved.withColumn(
        "effective_from",
        F.when(F.col("effective_from") == F.col("signup_date").cast("timestamp_ntz"),
               F.col("effective_from") + F.expr("INTERVAL 45 DAYS")).otherwise(F.col("effective_from")))
    repaired = scd.scd2_repair_start(late)
    return scd.scd2_repair_checks(repaired, late, w.stg_orders)


# ============================================= landing, swaps, whole refresh
@query()
def csv_landing_roundtrip(spark, sf_dir):
    """SNK1, SRC4/SRC5: the raw orders land as headered CSV files, are read with
    their declared types and staged; a row that does not fit is told apart."""
    from pyspark.sql.types import StructType
    from starloom.operators.staging import ORDERS, stage
    from starloom.sinks.publish import write_csv
    from starloom.sources.readers import CORRUPT, read_csv
    path = _scratch(spark, "landing") + "/orders"
    raw = adapters.raw_orders(_wh(spark, sf_dir).t)
    write_csv(raw, path)
    landed = read_csv(spark, path, StructType([raw.schema[c] for c in raw.columns]))
    return stage(landed.filter(F.col(CORRUPT).isNull()), ORDERS)


@query()
def parquet_glob_snapshot(spark, sf_dir):
    """SNK2/SRC7: orders written by year and read back through a glob over the
    years' folders."""
    from starloom.sinks.publish import write_parquet
    from starloom.sources.readers import read_parquet
    path = _scratch(spark, "years") + "/orders"
    raw = adapters.raw_orders(_wh(spark, sf_dir).t)
    write_parquet(raw.withColumn("year", F.year("order_date")), path, partition_by=["year"])
    return read_parquet(spark, f"{path}/year=*", raw.columns)


@query()
def publish_swap_report(spark, sf_dir):
    """SNK6/SNK7/SNK10: a dry run, a first publish and a destructive swap of the
    staged orders, with the rows each reports from its own job."""
    from starloom.sinks import publish as pub
    orders = _wh(spark, sf_dir).stg_orders
    path = _scratch(spark, "swap") + "/orders"
    done = [("dry_run", pub.publish(orders, path, dry_run=True)), ("first", pub.publish(orders, path)),
            ("swap", pub.publish(orders, path, keep_backup=False))]
    stored = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("stored").alias("step"), F.col("n").cast("long").alias("n_rows"), F.lit(len(pub.backups(spark, path))).cast("long").alias("n_backups"))
    steps = spark.createDataFrame([(step, r.rows, int(r.backup is not None)) for step, r in done],
                                  "step string, n_rows long, n_backups long")
    return steps.unionByName(stored)


@query()
def dq_expected_count(spark, sf_dir):
    """DQ9: row counts against a parameter; the second misses its number by all
    rows."""
    w = _wh(spark, sf_dir)
    expected = w.t.orders.count()
    return dq.union_all([dq.expected_count(w.stg_orders, "stg_orders", expected),
                         dq.expected_count(w.stg_payments, "stg_payments", 0)])


@query()
def full_refresh_second_run(spark, sf_dir):
    """OP23: the whole refresh twice into one place; rows of every table after
    the second run, which merged into the stored dimensions, and the rejected
    rows."""
    import os
    from starloom.plans.warehouse import full_refresh
    root = _scratch(spark, "refresh")
    full_refresh(spark, sf_dir, root)
    names = [n for n in full_refresh(spark, sf_dir, root) if n != "failed_checks" and not n.startswith("quality/")]
    counts = [spark.read.parquet(os.path.join(root, n)).agg(F.count(F.lit(1)).cast("long").alias("n_rows")).select(
        F.lit(n).alias("table_name"), "n_rows") for n in names]
    return dq.union_all(counts)
