"""Full-refresh composition (OP23): raw -> staging -> dimensions -> fact ->
marts, in dependency order, inside one Spark session. Each stage is a lazy
DataFrame built once per ``Warehouse`` and shared by everything downstream.
A suite that uses the fact several times stores it first (``store_fact``).
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import cached_property
from itertools import chain

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.operators import dims, fact as fact_ops, staging
from starloom.session import input_bytes, scratch_released, size_partitions, small_on_disk, stored
from starloom.sources import adapters
from starloom.sources.tables import Tables

# Calendar: by default whole years spanning the order dates (derived from the
# data, so the calendar follows the tables it serves); a fixed range can be
# passed instead (a shorter one drops out-of-range orders from the fact).
CALENDAR = None


def at_once(step, items, most: int | None = None) -> list:
    """``step`` of every item, in the items' order, ``most`` at a time. Jobs
    submitted from separate threads share the cluster instead of queueing one
    after the other; what they shuffle lies on disk together."""
    from concurrent.futures import ThreadPoolExecutor

    items = list(items)
    with ThreadPoolExecutor(max_workers=min(len(items), most or len(items))) as pool:
        return list(pool.map(step, items))


SLICE_BYTES = 1 << 30  # input whose joined rows are shuffled, and lie on disk, at once


def slices(n: int, key, *tables: DataFrame):
    """The tables cut into ``n`` slices by the hash of ``key``, all alike: joins
    and groupings on the key give the same rows slice by slice."""
    for i in range(n):
        here = [t if n == 1 else t.filter(F.pmod(F.xxhash64(key), F.lit(n)) == i) for t in tables]
        yield here if len(here) > 1 else here[0]


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str, calendar: tuple[str, str] | None = CALENDAR):
        self.spark = spark
        self.sf_dir = sf_dir
        self.calendar = calendar
        self.t = Tables(spark, sf_dir)

    # raw sources -------------------------------------------------------
    def raw(self, name: str) -> DataFrame:
        return adapters.RAW[name](self.t)

    # staging -----------------------------------------------------------
    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stage_customers(self.raw("customers"))

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stage_products(self.raw("products"))

    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.stage_orders(self.raw("orders"))

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return staging.stage_order_items(self.raw("order_items"))

    @cached_property
    def stg_payments(self) -> DataFrame:
        return staging.stage_payments(self.raw("payments"))

    # dimensions --------------------------------------------------------
    @cached_property
    def dim_customer(self) -> DataFrame:
        return dims.dim_customer_initial(self.stg_customers)

    @cached_property
    def dim_product(self) -> DataFrame:
        return dims.dim_product(self.stg_products)

    @cached_property
    def dim_payment(self) -> DataFrame:
        return dims.dim_payment(self.stg_payments)

    @cached_property
    def dim_date(self) -> DataFrame:
        span = self.calendar or dims.calendar_span(self.raw("orders").select("order_date"), "order_date")
        return dims.dim_date(self.spark, *span)

    def build_dimensions(self, names=("dim_customer", "dim_product", "dim_payment")) -> None:
        """Key the independent dimensions concurrently. Each keying runs its
        own small jobs (sample, store), see ``at_once``."""
        todo = [n for n in names if n not in self.__dict__]
        if len(todo) <= 1:
            for n in todo:
                getattr(self, n)
            return
        for n, df in zip(todo, at_once(lambda n: type(self).__dict__[n].func(self), todo)):
            self.__dict__[n] = df

    # fact --------------------------------------------------------------
    def fact_with(self, dim_customer: DataFrame) -> DataFrame:
        self.build_dimensions(("dim_product", "dim_payment"))
        return fact_ops.fact_orders(self.stg_orders, self.stg_order_items, dim_customer,
                                    self.dim_product, self.dim_date, self.dim_payment)

    @cached_property
    def fact(self) -> DataFrame:
        self.build_dimensions()
        return self.fact_with(self.dim_customer)

    def sales_with(self, dim_customer: DataFrame) -> DataFrame:
        """The fact without ``payment_key``: payments only decide which orders
        appear and how often, so the payment table is not numbered."""
        return fact_ops.fact_orders(self.stg_orders, self.stg_order_items, dim_customer,
                                    self.dim_product, self.dim_date, self.stg_payments)

    @cached_property
    def sales(self) -> DataFrame:
        if "fact" in self.__dict__:
            return self.fact
        self.build_dimensions(("dim_customer", "dim_product"))
        return self.sales_with(self.dim_customer)

    def store_fact(self, name: str = "fact") -> "Warehouse":
        """Compute the fact (or ``sales``) once, into a scratch folder;
        everything built on it afterwards reads the stored rows."""
        self.__dict__[name] = stored(getattr(self, name), name)
        return self


# ------------------------------------------------------------ check suites
# Columns that must not be NULL, by table
REQUIRED = {
    "fact_orders": ["order_id", "customer_key", "product_key", "date_key", "payment_key", "quantity", "unit_price",
                    "discount", "revenue"],
    "dim_customer": ["customer_key", "customer_id", "effective_from"],
    "mart_daily_sales": ["full_date", "total_orders", "total_items_sold", "total_revenue", "average_order_value"],
    "mart_product_performance": ["product_key", "total_orders", "total_units_sold", "gross_sales", "total_discount",
                                 "total_revenue"],
    "mart_customer_performance": ["customer_key", "customer_id", "total_orders", "total_items_purchased", "total_revenue"],
    "mart_category_performance": ["category", "units_sold", "total_revenue"],
    "mart_payment_analysis": ["payment_method", "payment_status", "payment_count", "total_payment_amount"],
}
# Unique columns, and child column -> parent column
UNIQUE = [("dim_date", "full_date"), ("dim_product", "product_key"), ("dim_customer", "customer_key"),
          ("mart_daily_sales", "full_date"), ("mart_product_performance", "product_key"),
          ("mart_customer_performance", "customer_key"), ("mart_category_performance", "category"),
          ("stg_customers", "customer_id"), ("stg_products", "product_id"), ("stg_orders", "order_id"),
          ("stg_payments", "payment_id")]
PARENTS = [("fact_orders", "customer_key", "dim_customer"), ("fact_orders", "product_key", "dim_product"),
           ("fact_orders", "date_key", "dim_date"), ("fact_orders", "payment_key", "dim_payment"),
           ("mart_product_performance", "product_key", "dim_product"),
           ("mart_customer_performance", "customer_key", "dim_customer"), ("stg_orders", "customer_id", "stg_customers"),
           ("stg_order_items", "order_id", "stg_orders"), ("stg_order_items", "product_id", "stg_products"),
           ("stg_payments", "order_id", "stg_orders")]


def row_and_key_checks(t: dict[str, DataFrame], n: int = 1) -> list[DataFrame | list[DataFrame]]:
    """DQ1-DQ8, DQ10, DQ11, DQ18 over stored tables: all row rules of a table
    in one aggregate, then keys, parents and groups (in ``n`` slices of orders),
    for ``quality.report_rows``."""
    from starloom.operators import quality as dq
    from starloom.operators.temporal import version_match_count

    c = F.col
    more = {
        "fact_orders": [*dq.range_rules(quantity_not_positive=c("quantity") <= 0, unit_price_negative=c("unit_price") < 0,
                                        discount_negative=c("discount") < 0, revenue_negative=c("revenue") < 0),
                        *dq.identity_rules(), dq.null_key_rule()],
        "stg_orders": dq.accepted_rules(order_status=staging.ORDER_STATUSES),
        "stg_payments": [*dq.accepted_rules(payment_status=staging.PAYMENT_STATUSES),
                         *dq.range_rules(amount_negative=c("amount") < 0)],
        "stg_products": dq.range_rules(unit_price_negative=c("unit_price") < 0, cost_price_negative=c("cost_price") < 0,
                                       margin_negative=c("profit_per_unit") < 0),
    }
    rules = {name: [*dq.not_null_rules(*REQUIRED.get(name, [])), *more.get(name, [])] for name in {**REQUIRED, **more}}
    matches = version_match_count(t["stg_orders"], t["dim_customer"], "order_id", "customer_id", "order_date", "customer_key")
    return [
        *[dq.table_rules(t[name], name, own) for name, own in rules.items()],
        *[dq.unique(t[name], name, column) for name, column in UNIQUE],
        *[dq.relationship(t[name], name, fk, t[parent], fk) for name, fk, parent in PARENTS],
        [dq.duplicate_fact_groups(some) for some in slices(n, "order_id", t["fact_orders"])], dq.orders_before_signup(t["stg_orders"], t["stg_customers"]),
        dq.violation_count(matches.filter("match_count <> 1"), "exactly_one_version", "stg_orders", "customer_id"),
    ]


def reconciliation(t: dict[str, DataFrame]) -> list[DataFrame]:
    """DQ12-DQ16 over stored tables."""
    from starloom.operators import reconcile as rec

    fact = t["fact_orders"]
    daily, product, customer, category, payment = (t[f"mart_{n}"] for n in (
        "daily_sales", "product_performance", "customer_performance", "category_performance", "payment_analysis"))
    return [
        rec.revenue_report(fact, daily, product, customer, category), rec.orders_report(fact, daily),
        rec.coverage_report(fact, t["dim_product"], product, customer.filter("total_orders > 0"), category),
        rec.payments_report(t["stg_payments"], payment, t["stg_order_items"])]


# ------------------------------------------------------------ full refresh
def full_refresh(spark: SparkSession, sf_dir: str, out_root: str, calendar: tuple[str, str] | None = CALENDAR,
                 fail_on_error: bool = False) -> dict:
    """OP23: extract -> 5 staging -> 4 dimensions -> fact -> 5 marts -> checks,
    in dependency order, every table published through the staged writer.

    An existing customer dimension is never rebuilt from staging (that would
    destroy its history and move its keys): the snapshot is merged into it
    with ``scd2_merge``. Each
    published table is re-read by the next step, so every step starts from
    stored data (lineage is cut at every table).

    Beside the tables and their backups the disk holds what one step shuffles:
    shuffle files and scratch rows go with their step. Input beyond
    ``SLICE_BYTES`` is taken two steps, and in the largest steps one slice, at a
    time: fewer of its rows are then shuffled at once."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    size = input_bytes(spark, sf_dir)
    # 16 MB of the input's columnar files come to a few 100 MB of joined rows
    size_partitions(spark, size, target_bytes=16 << 20)
    try:
        with small_on_disk(spark):
            return _refresh(spark, sf_dir, out_root, calendar, fail_on_error, max(1, -(-size // SLICE_BYTES)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def _refresh(spark: SparkSession, sf_dir: str, out_root: str, calendar: tuple[str, str] | None, fail_on_error: bool,
             n: int) -> dict:
    import os

    from starloom.operators import marts, quality as dq, scd
    from starloom.sinks.publish import exists, publish

    def path(name: str) -> str:
        return os.path.join(out_root, name)

    def put(name: str, df: DataFrame | Iterable[DataFrame], partition_by: list[str] | None = None, verify=None) -> DataFrame:
        parts = iter([df] if isinstance(df, DataFrame) else df)
        first = next(parts)
        report[name] = publish(chain([first], parts), path(name), verify, partition_by=partition_by, post_verify=False).rows
        # read back with the written schema: partition values (e.g. a boolean)
        # are not type-inferred from directory names
        return spark.read.schema(first.schema).parquet(path(name)).select(*first.columns)

    def each(step, items, most: int | None = None) -> list:
        def alone(item):
            with scratch_released(spark):
                return step(item)
        return at_once(alone, items, most if n == 1 else 2)

    report: dict = {}
    w = Warehouse(spark, sf_dir, calendar)

    def staged(name: str) -> DataFrame:
        spec, raw = staging.SPECS[name], w.raw(name)
        # rows of one business key lie in one slice
        by = F.col(spec.keys[0]).try_cast(dict(spec.columns)[spec.keys[0]])
        split = [staging.stage_split(some, spec) for some in slices(n if name == "order_items" else 1, by, raw)]
        put(f"rejected/{name}", (rejected for _, rejected in split))
        return put(f"staging/{name}", (accepted for accepted, _ in split))

    sources = ("order_items", "orders", "payments", "products", "customers")  # the largest first
    stg = dict(zip(sources, each(staged, sources)))

    def customers() -> DataFrame:
        target = path("warehouse/dim_customer")
        if exists(spark, target):
            current = spark.read.parquet(target).withColumn(
                "is_current", F.col("is_current").cast("boolean")).select(*dims.DIM_CUSTOMER_COLUMNS)
            merged = scd.scd2_merge(current, stg["customers"], scd.CUSTOMER_SCD2)
        else:
            merged = dims.dim_customer_initial(stg["customers"])
        # history is append-only and a merge reads only current rows: split the
        # customer dimension by is_current so that read is partition-pruned
        # the candidate is checked as it is stored, before it takes the table's place
        return put("warehouse/dim_customer", merged, ["is_current"], verify=lambda df: scd.scd2_integrity(
            df.withColumn("is_current", F.col("is_current").cast("boolean"))).agg(F.sum("violations")).first()[0])

    def keyed_dim(name: str, build, key: str, version_key: str) -> DataFrame:
        fresh = build(stg[name.split("_", 1)[1] + "s"])
        target = path(f"warehouse/{name}")
        if exists(spark, target):   # keys stay stable across refreshes
            old = spark.read.parquet(target)
            fresh = scd.scd1_refresh(old, fresh.drop(version_key), key, version_key)
        return put(f"warehouse/{name}", fresh)

    dim_customer, dim_product, dim_payment, dim_date = each(lambda build: build(), [
        customers, lambda: keyed_dim("dim_product", dims.dim_product, "product_id", "product_key"),
        lambda: keyed_dim("dim_payment", dims.dim_payment, "payment_id", "payment_key"),
        lambda: put("warehouse/dim_date", w.dim_date)])
    # the fact is laid out by order month (date_key // 100) for time pruning;
    # its rows are dealt by month first, else every task writes a file of every month
    fact = put("warehouse/fact_orders", (fact_ops.fact_orders(
        orders, items, dim_customer, dim_product, dim_date, payments).withColumn(
        "order_month", (F.col("date_key") / 100).cast("int")).hint("rebalance", F.col("order_month"))
        for orders, items, payments in slices(n, "order_id", stg["orders"], stg["order_items"], dim_payment)), ["order_month"])
    # rows of a mart come from the fact rows of one day (so of one month), product or customer version
    marts_of = {
        "mart_daily_sales": (marts.mart_daily_sales(f, dim_date) for f in slices(n, "order_month", fact)),
        "mart_product_performance": (marts.mart_product_performance(f, d) for f, d in slices(n, "product_key", fact, dim_product)),
        "mart_customer_performance": (marts.mart_customer_performance(f, d) for f, d in slices(n, "customer_key", fact, dim_customer)),
        "mart_category_performance": marts.mart_category_performance(fact, dim_product),
        "mart_payment_analysis": marts.mart_payment_analysis(stg["payments"])}
    mart = dict(zip(marts_of, each(lambda name: put(f"analytics/{name}", marts_of[name]), marts_of)))
    tables = {"dim_customer": dim_customer, "dim_product": dim_product, "dim_payment": dim_payment, "dim_date": dim_date,
              "fact_orders": fact, **{f"stg_{name}": df for name, df in stg.items()}, **mart}
    with scratch_released(spark):
        suites = {"warehouse_checks": row_and_key_checks(tables, n), "reconciliation": reconciliation(tables),
                  "scd2_integrity": [scd.scd2_integrity(dim_customer).withColumn(
                      "status", F.when(F.col("violations") == 0, "PASS").otherwise("FAIL"))]}
        # a report is one row per check, and each check a job of its own
        found = iter(each(dq.report_rows, [check for suite in suites.values() for check in suite], 8))
        checked = [put(f"quality/{name}", spark.createDataFrame([r for _ in suite for r in next(found)], suite[0].schema))
                   for name, suite in suites.items()]
    failed = [r["check"] for suite in checked for r in suite.filter("status = 'FAIL'").collect()]  # one row per check
    report["failed_checks"] = len(failed)
    if fail_on_error and failed:
        raise dq.QualityError(", ".join(failed))
    return report
