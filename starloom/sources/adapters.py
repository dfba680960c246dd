"""Projections of the driver's TPC-H-style tables onto the five raw source
shapes of the warehouse (customers, products, orders, order_items,
payments) plus the change log used for Type 2 history.

These are plain narrow projections/joins: they keep every row of the
driver tables, so the work of every downstream query grows with the data.
The matching DuckDB text lives in ``starloom.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starloom.sources.tables import Tables

MONEY = "decimal(10,2)"

# Fixed values of the adapter (shared with the oracle SQL):
SIGNUP_BASE_DATE = "1995-01-01"   # signup = base + (custkey % SIGNUP_SPREAD_DAYS)
SIGNUP_SPREAD_DAYS = 400
PRODUCT_UPDATED_AT = "1995-01-01 00:00:00"
COST_RATIO = "0.6"                # cost_price = unit_price * 0.6
DISCOUNT_SCALE = 1000             # l_discount (0..0.10) -> absolute 0..100
# order status by TPC-H status letter (anything else: SHIPPED);
# payment status by orderkey % 6: 0-2 COMPLETED, 3 PENDING, 4 FAILED, 5 REFUNDED
ORDER_STATUS = {"F": "DELIVERED", "O": "PENDING"}


def raw_customers(t: Tables) -> DataFrame:
    c, n, r = t.customer, t.nation, t.region
    signup = F.date_add(F.lit(SIGNUP_BASE_DATE).cast("date"),
                        (F.col("c_custkey") % SIGNUP_SPREAD_DAYS).cast("int"))
    return (
        c.join(n, c.c_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
            F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
            F.concat("c_name", F.lit("@Example.COM")).alias("email"),
            F.col("c_mktsegment").alias("city"),
            F.col("n_name").alias("state"),
            F.col("r_name").alias("country"),
            signup.alias("signup_date"),
            signup.cast("timestamp_ntz").alias("updated_at"),
        )
    )


def raw_products(t: Tables) -> DataFrame:
    price = F.col("p_retailprice").cast(MONEY)
    return t.part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("subcategory"),
        price.alias("unit_price"),
        (price * F.lit(COST_RATIO).cast("decimal(2,1)")).cast(MONEY).alias("cost_price"),
        F.concat(F.lit("Supplier "), (F.col("p_partkey") % 10).cast("string")).alias("supplier"),
        F.lit(PRODUCT_UPDATED_AT).cast("timestamp_ntz").alias("updated_at"),
    )


def _order_status() -> F.Column:
    expr = F.lit("SHIPPED")
    for letter, status in reversed(ORDER_STATUS.items()):
        expr = F.when(F.col("o_orderstatus") == letter, F.lit(status)).otherwise(expr)
    return expr


def raw_orders(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
        _order_status().alias("order_status"),
        F.col("o_orderdate").alias("updated_at"),
    )


def raw_order_items(t: Tables) -> DataFrame:
    """Unit price is looked up from the product (one set-based join, never a
    per-row query); the discount becomes an absolute amount per line."""
    li, p = t.lineitem, t.part
    return li.join(p, li.l_partkey == p.p_partkey).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("p_retailprice").cast(MONEY).alias("unit_price"),
        (F.col("l_discount").cast("decimal(4,2)") * F.lit(DISCOUNT_SCALE)).cast(MONEY).alias("discount"),
        F.col("l_shipdate").alias("updated_at"),
    )


def _payment_status() -> F.Column:
    m = F.col("o_orderkey") % 6
    return (F.when(m < 3, "COMPLETED").when(m == 3, "PENDING")
            .when(m == 4, "FAILED").otherwise("REFUNDED"))


def raw_payments(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("payment_id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderpriority").alias("payment_method"),
        _payment_status().alias("payment_status"),
        F.col("o_totalprice").cast(MONEY).alias("amount"),
        F.col("o_orderdate").alias("payment_date"),
    )


def change_log(t: Tables) -> DataFrame:
    """The ``events`` table as an attribute change log: key ``user_id``,
    change time ``ts``, tracked attribute ``event_type``, tie-break
    ``event_id``."""
    return t.events.select("user_id", "ts", "event_id", "event_type")


RAW = {
    "customers": raw_customers,
    "products": raw_products,
    "orders": raw_orders,
    "order_items": raw_order_items,
    "payments": raw_payments,
}
