"""Plan shape: the physical plans stay JVM-side, push filters into the scan
and prune columns."""

import contextlib
import io

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
QUERIES = entry.queries()


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", ["fact_orders", "mart_daily_sales", "scd2_from_log", "scd2_merge_snapshot",
                                  "point_in_time_join", "dedupe_lineitem", "reconcile_revenue"])
def test_no_python_in_plan(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for marker in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas"):
        assert marker not in text, f"{name} runs Python: {marker}"


def test_watermark_filter_reaches_scan(spark):
    text = plan(QUERIES["incremental_extract"](spark, SF))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_orderdate:timestamp_ntz>" in text


def test_event_queries_read_whole_table_and_prune_columns(spark):
    # the merge stores its outer join, so its inputs are looked at
    from starloom.plans import queries
    text = plan(queries._event_snapshot(queries.Warehouse(spark, SF)))
    assert "LessThan(ts" not in text
    assert "props" not in text.split("ReadSchema:")[1].split("\n")[0]


def test_payment_mart_reads_two_tables_columns_only(spark):
    text = plan(QUERIES["mart_payment_analysis"](spark, SF))
    schemas = [line for line in text.splitlines() if line.startswith("ReadSchema")]
    # no payment repeats, so staging drops no row and needs no recency column
    assert schemas == ["ReadSchema: struct<o_orderkey:bigint,o_totalprice:double,o_orderpriority:string>"]


def test_hot_customer_interval_join_is_split_by_aqe(spark):
    """A customer with a third of all orders: AQE splits its partition of the
    point-in-time join (thresholds lowered so the tiny test data qualifies)."""
    import datetime as dt
    import random

    from starloom.operators.temporal import point_in_time_join

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    saved = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        rnd = random.Random(1)
        t0 = dt.datetime(2024, 1, 1)
        orders = spark.createDataFrame(
            [(i, 0 if i % 3 == 0 else rnd.randint(1, 500), t0 + dt.timedelta(minutes=i)) for i in range(30000)],
            "order_id long, customer_id long, order_date timestamp_ntz")
        versions = spark.createDataFrame(
            [(c, c, dt.datetime(2023, 1, 1), None) for c in range(501)],
            "customer_key long, customer_id long, effective_from timestamp_ntz, effective_to timestamp_ntz")
        df = point_in_time_join(orders, versions, "customer_id", "order_date")
        assert len(df.collect()) == 30000
        assert "SortMergeJoin(skew=true)" in plan(df)
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
