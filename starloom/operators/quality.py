"""Data-quality checks returning violations as data (DQ1-DQ11, DQ20).

Every check returns rows ``(check, table_name, column_name, violations,
status)``; a suite is the ``unionByName`` of its checks, so a whole suite is
one Spark job when it is collected or written. Checks over one table share a
single aggregation pass (one ``agg`` with a conditional count per rule).
``fail_on_error`` raises after the report was computed.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, functions as F

from starloom.functions.money import line_total, off_by_more_than

REPORT_COLUMNS = ["check", "table_name", "column_name", "violations", "status"]


class QualityError(AssertionError):
    pass


def _status(v: Column) -> Column:
    return F.when(v == 0, F.lit("PASS")).otherwise(F.lit("FAIL"))


def violation_count(df: DataFrame, check: str, table: str, column: str) -> DataFrame:
    """Report row counting the rows of ``df`` (a violation set); the building
    block for custom checks."""
    n = df.agg(F.count(F.lit(1)).cast("long").alias("violations"))
    return n.select(F.lit(check).alias("check"), F.lit(table).alias("table_name"),
                    F.lit(column).alias("column_name"), "violations", _status(F.col("violations")).alias("status"))


def report_rows(check: DataFrame | list[DataFrame]) -> list[Row]:
    """The rows of a check (one per rule). A list holds a check of counts over
    disjoint slices of its table: one runs after the other, violations add up."""
    if isinstance(check, DataFrame):
        return check.collect()
    found = [r for part in check for r in part.collect()]
    total = sum(r["violations"] for r in found)
    return [Row(**{**found[0].asDict(), "violations": total, "status": "FAIL" if total else "PASS"})]


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


# --------------------------------------------------------------- row rules
@dataclass(frozen=True)
class Rule:
    """A rule that one row alone can break: ``broken`` is true where it does."""
    check: str
    column: str
    broken: Column


def not_null_rules(*columns: str) -> list[Rule]:
    return [Rule("not_null", c, F.col(c).isNull()) for c in columns]


def accepted_rules(**values: list[str]) -> list[Rule]:
    return [Rule("accepted_values", c, F.col(c).isNotNull() & ~F.col(c).isin(v)) for c, v in values.items()]


def range_rules(**broken: Column) -> list[Rule]:
    return [Rule("range", name, pred) for name, pred in broken.items()]


def identity_rules(tolerances: tuple[float, ...] = (0.0, 0.01)) -> list[Rule]:
    """DQ7: ``revenue`` against ``quantity * unit_price - discount``."""
    return [Rule("revenue_identity", name, pred) for name, pred in _identity(tolerances).items()]


def null_key_rule(keys=("customer_key", "product_key", "date_key", "payment_key")) -> Rule:
    return Rule("null_dimension_keys", ",".join(keys), reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys]))


def table_rules(df: DataFrame, table: str, rules: list[Rule]) -> DataFrame:
    """All row rules of one table, whatever their kind, as conditional counts
    of one aggregate: one scan, one report row per rule."""
    counts = df.agg(*[F.count_if(r.broken).alias(f"v{i}") for i, r in enumerate(rules)])
    rows = F.array(*[F.struct(F.lit(r.check).alias("check"), F.lit(r.column).alias("column_name"),
                              F.col(f"v{i}").cast("long").alias("violations")) for i, r in enumerate(rules)])
    return counts.select(F.inline(rows)).select(
        "check", F.lit(table).alias("table_name"), "column_name", "violations", _status(F.col("violations")).alias("status"))


# ------------------------------------------------------------- generic rules
def not_null(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """DQ1: NULL count per column, all columns in one pass."""
    return table_rules(df, table, not_null_rules(*columns))


def unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """DQ2: number of non-NULL values occurring more than once."""
    dups = df.filter(F.col(column).isNotNull()).groupBy(column).count().filter("count > 1")
    return violation_count(dups, "unique", table, column)


def relationship(child: DataFrame, table: str, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """DQ3 / JN10: child rows whose non-NULL key has no parent (anti join;
    the parent side is reduced to distinct keys first)."""
    keys = parent.select(F.col(pk).alias("_sl_pk")).distinct()
    orphans = child.filter(F.col(fk).isNotNull()).join(keys, F.col(fk) == F.col("_sl_pk"), "left_anti")
    return violation_count(orphans, "relationships", table, fk)


def accepted_values(df: DataFrame, table: str, rules: dict[str, list[str]]) -> DataFrame:
    """DQ4: non-NULL values outside the accepted list, one pass for all columns."""
    return table_rules(df, table, accepted_rules(**rules))


def ranges(df: DataFrame, table: str, rules: dict[str, Column]) -> DataFrame:
    """DQ5/DQ6: ``rules`` maps a rule name to a *violation* predicate."""
    return table_rules(df, table, range_rules(**rules))


# -------------------------------------------------------------- fact checks
def _identity(tolerances: tuple[float, ...]) -> dict[str, Column]:
    expected = line_total()
    return {("revenue_exact" if t == 0 else f"revenue_off_by_more_than_{int(round(t * 100))}_cents"):
            (F.col("revenue") != expected) if t == 0 else off_by_more_than("revenue", expected, t)
            for t in tolerances}


def revenue_identity(fact: DataFrame, tolerances: tuple[float, ...] = (0.0, 0.01)) -> DataFrame:
    """DQ7: ``revenue`` vs ``quantity*unit_price - discount``: exact (the
    Spark job) and within 0.01 (the SQL test). NULL operands never violate."""
    return table_rules(fact, "fact_orders", identity_rules(tolerances))


def orders_before_signup(stg_orders: DataFrame, stg_customers: DataFrame) -> DataFrame:
    """DQ8: orders dated before the customer's signup day."""
    j = stg_orders.select("customer_id", "order_date").join(
        stg_customers.select("customer_id", "signup_date"), "customer_id")
    bad = j.filter(F.col("order_date") < F.col("signup_date").cast("timestamp_ntz"))
    return violation_count(bad, "orders_before_signup", "orders", "order_date")


def null_keys(fact: DataFrame, keys=("customer_key", "product_key", "date_key", "payment_key")) -> DataFrame:
    """DQ10: fact rows with any NULL dimension key."""
    bad = fact.filter(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys]))
    return violation_count(bad, "null_dimension_keys", "fact_orders", ",".join(keys))


def duplicate_fact_groups(fact: DataFrame,
                          cols=("order_id", "product_key", "quantity", "unit_price", "discount")) -> DataFrame:
    """DQ11: groups of identical (order, product, quantity, price, discount)."""
    dups = fact.groupBy(*cols).count().filter("count > 1")
    return violation_count(dups, "duplicate_fact_groups", "fact_orders", ",".join(cols))


def expected_count(df: DataFrame, table: str, expected: int) -> DataFrame:
    """DQ9: row count equals a parameter (violations = |actual - expected|)."""
    n = df.agg(F.abs(F.count(F.lit(1)) - F.lit(expected)).cast("long").alias("violations"))
    return n.select(F.lit("expected_count").alias("check"), F.lit(table).alias("table_name"),
                    F.lit("*").alias("column_name"), "violations", _status(F.col("violations")).alias("status"))


def fail_on_error(report: DataFrame) -> DataFrame:
    failed = report.filter(F.col("status") == "FAIL").collect()  # one row per rule
    if failed:
        raise QualityError("; ".join(f"{r['check']} {r['table_name']}.{r['column_name']}={r['violations']}"
                                     for r in failed))
    return report
