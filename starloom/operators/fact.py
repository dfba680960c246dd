"""Order-item fact (OP10, OP11).

Semantics follow the reference: all joins are inner, so items of orders
outside the calendar, without a payment, or dated before the customer's
first version are dropped; several payments for one order multiply its rows;
order and payment status are not filtered.

Plan shape: every order-grain lookup (customer version, calendar day,
payment) is resolved on the orders side first, so the item-grain data is
shuffled once for the order join and once for the product lookup. Small
sides are broadcast by the planner only when their measured size is under
the (adaptive) broadcast threshold; otherwise they are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starloom.functions.calendar import day_of
from starloom.operators.temporal import asof_join, point_in_time_join

FACT_COLUMNS = ["order_id", "customer_key", "product_key", "date_key", "payment_key",
                "quantity", "unit_price", "discount", "revenue"]


def resolve_orders(stg_orders: DataFrame, dim_customer: DataFrame, dim_date: DataFrame,
                   dim_payment: DataFrame, pit: str = "interval") -> DataFrame:
    """Order grain: (order_id, customer_key, date_key, payment_key). Staged
    payments may stand in for ``dim_payment``: orders then lose or multiply
    rows alike, without a payment key.
    ``pit="asof"`` resolves customer versions with the as-of stream join
    (for customers with very long histories and many orders)."""
    o = stg_orders.select("order_id", "customer_id", "order_date")
    versions = dim_customer.select("customer_id", "customer_key", "effective_from", "effective_to")
    join = asof_join if pit == "asof" else point_in_time_join
    ov = join(o, versions, "customer_id", "order_date").select("order_id", "order_date", "customer_key")
    cal = dim_date.select("full_date", "date_key")
    od = ov.join(cal, day_of(ov.order_date) == cal.full_date).select("order_id", "customer_key", "date_key")
    pay = dim_payment.select(*[c for c in ("order_id", "payment_key") if c in dim_payment.columns])
    return od.join(pay, "order_id")


def fact_orders(stg_orders: DataFrame, stg_items: DataFrame, dim_customer: DataFrame,
                dim_product: DataFrame, dim_date: DataFrame, dim_payment: DataFrame,
                keep_line_id: bool = False, pit: str = "interval") -> DataFrame:
    """One row per order item (per payment); without ``payment_key`` if
    ``dim_payment`` has none. ``keep_line_id`` keeps the item's
    natural key so fan-out can be detected (grain check)."""
    orders = resolve_orders(stg_orders, dim_customer, dim_date, dim_payment, pit)
    item_cols = ["order_id", "product_id", "quantity", "unit_price", "discount", "line_total"]
    if keep_line_id:
        item_cols += ["line_number", "supplier_id"]
    items = stg_items.select(*item_cols)
    prod = dim_product.select("product_id", "product_key")
    f = items.join(orders, "order_id").join(prod, "product_id")
    out = [c if c != "revenue" else F.col("line_total").alias("revenue") for c in FACT_COLUMNS
           if c != "payment_key" or c in orders.columns]
    if keep_line_id:
        out += ["line_number", "product_id", "supplier_id"]
    return f.select(*out)
