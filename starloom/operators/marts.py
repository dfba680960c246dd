"""Analytics marts and KPIs (OP12-OP21, SO1-SO5).

Every mart aggregates the fact *before* joining a dimension (pre-aggregation):
the join then sees one row per group key instead of one per fact row, and
the partial (map-side) aggregation collapses hot keys before any shuffle.
Money is summed exactly and stays DECIMAL (38 digits, cents); ratios are double.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starloom.functions.money import as_double, exact, gross_value, round2, safe_ratio


def _order_grain(fact: DataFrame, *extra_keys: str) -> DataFrame:
    """Fact rolled up to (order_id, extra keys): item count, units, revenue.
    ``count(distinct order_id)`` per group then becomes a plain ``count``."""
    return fact.groupBy("order_id", *extra_keys).agg(
        F.sum("quantity").alias("_units"),
        F.sum("revenue").alias("_revenue"),
    )


def _date_from_key(c: str) -> F.Column:
    k = F.col(c)
    return F.make_date((k / 10000).cast("int"), ((k / 100) % 100).cast("int"), (k % 100).cast("int"))


# ---------------------------------------------------------------- daily sales
def _daily(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    per_day = _order_grain(fact, "date_key").groupBy("date_key").agg(
        F.count(F.lit(1)).cast("long").alias("total_orders"),
        F.sum("_units").cast("long").alias("units"),
        F.sum("_revenue").alias("revenue"),
    )
    cal = dim_date.select("date_key", "full_date", "year", "month", "month_name", "quarter")
    return per_day.join(cal, "date_key")


def daily_sales(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """OP12 (Spark contract): units_sold, total_revenue per day."""
    d = _daily(fact, dim_date)
    return d.select("full_date", "year", "month", "month_name", "quarter", "total_orders",
                    F.col("units").alias("units_sold"), exact("revenue").alias("total_revenue"))


def mart_daily_sales(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """OP13 (SQL contract): total_items_sold and average_order_value."""
    d = _daily(fact, dim_date)
    return d.select("full_date", "year", "month", "month_name", "quarter", "total_orders",
                    F.col("units").alias("total_items_sold"),
                    exact("revenue").alias("total_revenue"),
                    safe_ratio("revenue", "total_orders").alias("average_order_value"))


# ------------------------------------------------------------------ products
PRODUCT_ATTRS = ["product_key", "product_id", "product_name", "category", "subcategory"]


def product_performance(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """OP14: units_sold, round(total_revenue, 2) per product."""
    per = fact.groupBy("product_key").agg(F.sum("quantity").cast("long").alias("units_sold"),
                                          F.sum("revenue").alias("_rev"))
    return per.join(dim_product.select(*PRODUCT_ATTRS), "product_key").select(
        *PRODUCT_ATTRS, "units_sold", exact(round2("_rev")).alias("total_revenue"))


def mart_product_performance(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """OP15: orders, units, gross sales, discount, revenue per product."""
    per = _order_grain_product(fact).groupBy("product_key").agg(
        F.count(F.lit(1)).cast("long").alias("total_orders"),
        F.sum("_units").cast("long").alias("total_units_sold"),
        F.sum("_gross").alias("_gross"),
        F.sum("_disc").alias("_disc"),
        F.sum("_revenue").alias("_rev"),
    )
    return per.join(dim_product.select(*PRODUCT_ATTRS), "product_key").select(
        *PRODUCT_ATTRS, "total_orders", "total_units_sold",
        exact("_gross").alias("gross_sales"), exact("_disc").alias("total_discount"),
        exact("_rev").alias("total_revenue"))


def _order_grain_product(fact: DataFrame) -> DataFrame:
    return fact.groupBy("order_id", "product_key").agg(
        F.sum("quantity").alias("_units"),
        F.sum(gross_value()).alias("_gross"),
        F.sum("discount").alias("_disc"),
        F.sum("revenue").alias("_revenue"),
    )


# ----------------------------------------------------------------- customers
CUSTOMER_ATTRS = ["customer_key", "customer_id", "first_name", "last_name", "city", "state", "country"]


def _per_customer(fact: DataFrame) -> DataFrame:
    per_order = fact.groupBy("order_id", "customer_key").agg(
        F.sum("quantity").alias("_units"), F.sum("revenue").alias("_revenue"),
        F.min("date_key").alias("_first"), F.max("date_key").alias("_last"))
    return per_order.groupBy("customer_key").agg(
        F.count(F.lit(1)).cast("long").alias("total_orders"),
        F.sum("_units").cast("long").alias("_units"),
        F.sum("_revenue").alias("_rev"),
        F.min("_first").alias("_first"),
        F.max("_last").alias("_last"),
    )


def customer_sales(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """OP16: customers (versions) with sales only (inner join)."""
    per = _per_customer(fact)
    return per.join(dim_customer.select(*CUSTOMER_ATTRS), "customer_key").select(
        *CUSTOMER_ATTRS, "total_orders", F.col("_units").alias("units_purchased"),
        exact(round2("_rev")).alias("total_revenue"))


def mart_customer_performance(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """OP17: every customer version, zero-filled when it has no sales."""
    per = _per_customer(fact)
    dim = dim_customer.select(*CUSTOMER_ATTRS, "is_current")
    j = dim.join(per, "customer_key", "left")
    return j.select(
        *CUSTOMER_ATTRS, "is_current",
        F.coalesce("total_orders", F.lit(0).cast("long")).alias("total_orders"),
        F.coalesce("_units", F.lit(0).cast("long")).alias("total_items_purchased"),
        exact(F.coalesce("_rev", F.lit(0))).alias("total_revenue"),
        _date_from_key("_first").alias("first_purchase_date"),
        _date_from_key("_last").alias("most_recent_purchase_date"),
    )


# ---------------------------------------------------------------- categories
def mart_category_performance(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """OP18: units_sold, round(total_revenue, 2) per category."""
    per = fact.groupBy("product_key").agg(F.sum("quantity").alias("_units"),
                                          F.sum("revenue").alias("_rev"))
    j = per.join(dim_product.select("product_key", "category"), "product_key")
    return j.groupBy("category").agg(
        F.sum("_units").cast("long").alias("units_sold"),
        exact(round2(F.sum("_rev"))).alias("total_revenue"))


# ------------------------------------------------------------------ payments
def mart_payment_analysis(stg_payments: DataFrame) -> DataFrame:
    """OP19: from staging payments, per (method, status)."""
    return stg_payments.groupBy("payment_method", "payment_status").agg(
        F.count("payment_id").cast("long").alias("payment_count"),
        exact(round2(F.sum("amount"))).alias("total_payment_amount"))


# ---------------------------------------------------------- anti-join checks
def customers_without_sales(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """OP20: dimension versions with no fact row (distinct keys first, so the
    anti join shuffles one row per key rather than one per fact row)."""
    with_sales = fact.select("customer_key").distinct()
    return dim_customer.join(with_sales, "customer_key", "left_anti").select(
        "customer_key", "customer_id", "first_name", "last_name")


def orders_without_items(stg_orders: DataFrame, stg_items: DataFrame) -> DataFrame:
    """Orders that have no order item (anti join on order_id)."""
    return stg_orders.join(stg_items.select("order_id").distinct(), "order_id", "left_anti").select(
        "order_id", "customer_id", "order_date")


# ---------------------------------------------------------------------- KPIs
def kpi_totals(fact: DataFrame) -> DataFrame:
    """OP21: Total Revenue, Total Orders, Units Sold, Average Order Value."""
    per_order = _order_grain(fact)
    return per_order.agg(
        exact(F.sum("_revenue")).alias("total_revenue"),
        F.count(F.lit(1)).cast("long").alias("total_orders"),
        F.sum("_units").cast("long").alias("units_sold"),
        safe_ratio(F.sum("_revenue"), F.count(F.lit(1))).alias("average_order_value"),
    )


def revenue_by_category(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """OP21: category revenue and its share of the total (a scalar subquery)."""
    per = fact.groupBy("product_key").agg(F.sum("revenue").alias("_rev"))
    cat = per.join(dim_product.select("product_key", "category"), "product_key").groupBy(
        "category").agg(F.sum("_rev").alias("_rev"))
    total = cat.agg(as_double(F.sum("_rev"))).scalar()
    return cat.select("category", exact("_rev").alias("total_revenue"),
                      (as_double("_rev") / total).alias("revenue_share"))


def payment_amount_by_method(stg_payments: DataFrame) -> DataFrame:
    return stg_payments.groupBy("payment_method").agg(
        F.count("payment_id").cast("long").alias("payment_count"),
        exact(F.sum("amount")).alias("total_amount"))


def payment_status_counts(stg_payments: DataFrame) -> DataFrame:
    return stg_payments.groupBy("payment_status").agg(
        F.count("payment_id").cast("long").alias("payment_count"),
        exact(F.sum("amount")).alias("total_amount"))


def top_products(fact: DataFrame, dim_product: DataFrame, k: int = 10) -> DataFrame:
    """SO5: top-k products by revenue, product_id breaks ties (TakeOrderedAndProject)."""
    per = fact.groupBy("product_key").agg(F.sum("revenue").alias("_rev"),
                                          F.sum("quantity").cast("long").alias("units_sold"))
    j = per.join(dim_product.select("product_key", "product_id", "product_name", "category"), "product_key")
    return j.orderBy(F.col("_rev").desc(), F.col("product_id").asc()).limit(k).select(
        "product_key", "product_id", "product_name", "category", "units_sold",
        exact("_rev").alias("total_revenue"))


def top_customers(fact: DataFrame, dim_customer: DataFrame, k: int = 10) -> DataFrame:
    """SO5: top-k customers (business id, all versions) by revenue."""
    per = fact.groupBy("customer_key").agg(F.sum("revenue").alias("_rev"))
    ids = per.join(dim_customer.select("customer_key", "customer_id"), "customer_key").groupBy(
        "customer_id").agg(F.sum("_rev").alias("_rev"))
    cur = dim_customer.filter(F.col("is_current")).select("customer_id", "first_name", "last_name")
    return ids.orderBy(F.col("_rev").desc(), F.col("customer_id").asc()).limit(k).join(
        cur, "customer_id", "left").orderBy(F.col("_rev").desc(), F.col("customer_id").asc()).select(
        "customer_id", "first_name", "last_name", exact("_rev").alias("total_revenue"))
