"""Staging, keys, sequence, quality, publish and state on literal fixtures."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import Window, functions as F

from starloom.operators import fact as fact_ops, quality as dq
from starloom.operators.keys import continue_keys, dense_key
from starloom.operators.sequence import with_neighbours
from starloom.operators.staging import CUSTOMERS, PRODUCTS, latest_per_key, stage
from starloom.sinks import publish as pub
from starloom.sinks.state import advance, initial_state, read_watermark
from starloom.sources.readers import changes_since, corrupt_rows, read_csv, require_columns, ContractError

T = dt.datetime


def test_dirty_customers_csv(spark, scratch):
    path = os.path.join(scratch, "customers.csv")
    with open(path, "w") as f:
        f.write("customer_id,first_name,last_name,email,city,state,country,signup_date,updated_at\n"
                "1,  Ann ,Lee, ANN@X.COM ,Pune,MH,IN,2024-01-01,2024-01-01 10:00:00\n"
                "1,Ann,Lee,ann@new.com,Mumbai,MH,IN,2024-01-01,2024-02-01 10:00:00\n"
                "1.0,Bad,Row,b@x.com,,MH,IN,2024-01-01,2024-01-01 10:00:00\n"
                "2,Bo,Ray,bo@x.com,,NO,NO,2024-01-02,2024-01-02 00:00:00\n")
    schema = "customer_id long, first_name string, last_name string, email string, city string, state string, " \
             "country string, signup_date date, updated_at timestamp_ntz"
    from pyspark.sql.types import _parse_datatype_string
    raw = read_csv(spark, path, _parse_datatype_string(schema)).cache()
    assert corrupt_rows(raw).count() == 1
    out = {r["customer_id"]: r for r in stage(raw.drop("_corrupt_record"), CUSTOMERS).collect()}
    assert out[1]["email"] == "ann@new.com" and out[1]["city"] == "Mumbai"      # newest wins
    assert out[2]["city"] is None                                               # empty -> NULL, kept
    assert None in out                                                          # bad id kept as NULL, reported
    raw.unpersist()


def test_products_initcap_and_negative_margin(spark):
    raw = spark.createDataFrame(
        [(1, " Lamp ", " home DECOR ", "usb LIGHTS", "10.00", "12.50", "S1", T(2024, 1, 1))],
        "product_id long, product_name string, category string, subcategory string, unit_price string, "
        "cost_price string, supplier string, updated_at timestamp_ntz")
    r = stage(raw, PRODUCTS).first()
    assert r["category"] == "Home Decor" and r["subcategory"] == "Usb Lights" and r["product_name"] == "Lamp"
    assert float(r["profit_per_unit"]) == -2.5


def test_latest_per_key_is_deterministic(spark):
    df = spark.createDataFrame([(1, T(2024, 1, 1), "b"), (1, T(2024, 1, 1), "a"), (1, None, "z"), (2, None, "q")],
                               "k long, ts timestamp_ntz, v string")
    got = {r["k"]: r["v"] for r in latest_per_key(df, ["k"], ["ts"]).collect()}
    assert got == {1: "b", 2: "q"}


def test_dense_key_matches_row_number(spark):
    rnd = random.Random(7)
    ids = rnd.sample(range(1, 10**9), 5000)
    df = spark.createDataFrame([(i, str(i)) for i in ids], "id long, v string")
    keyed = dense_key(df, ["id"], "k", start=10, num_partitions=7)
    ref = {i: n + 10 for n, i in enumerate(sorted(ids))}
    assert {r["id"]: r["k"] for r in keyed.collect()} == ref
    more = spark.createDataFrame([(i,) for i in (5, 3)], "id long").withColumn("v", F.lit("x"))
    cont = continue_keys(keyed, more, "k", ["id"])
    assert sorted((r["id"], r["k"]) for r in cont.collect()) == [(3, 5010), (5, 5011)]


def test_neighbours_with_hot_key(spark):
    rnd = random.Random(3)
    rows = [(0, i, rnd.choice("ab")) for i in range(3000)]                  # one key: a third of the rows
    rows += [(rnd.randint(1, 300), 10_000 + i, rnd.choice("ab")) for i in range(6000)]
    df = spark.createDataFrame(rows, "k long, t long, v string")
    got = with_neighbours(df, ["k"], ["t"], ["v", "t"], prev=True, nxt=True, num_partitions=9)
    w = Window.partitionBy("k").orderBy("t")
    ref = df.select("k", "t", F.lag("v").over(w).alias("rv"), F.lead("t").over(w).alias("rn"))
    j = got.join(ref, ["k", "t"])
    assert j.count() == 9000
    assert j.filter(~F.col("prev_v").eqNullSafe(F.col("rv")) | ~F.col("next_t").eqNullSafe(F.col("rn"))).count() == 0


def test_fact_fanout_and_losses(spark):
    orders = spark.createDataFrame([(1, 1, T(2024, 1, 5)), (2, 1, T(2024, 1, 6)), (3, 1, T(2030, 1, 1))],
                                   "order_id long, customer_id long, order_date timestamp_ntz")
    items = spark.createDataFrame([(1, 1, 2, 5.0, 1.0, 9.0), (2, 1, 1, 5.0, 0.0, 5.0), (3, 1, 1, 5.0, 0.0, 5.0)],
                                  "order_id long, product_id long, quantity int, unit_price double, "
                                  "discount double, line_total double")
    cust = spark.createDataFrame([(0, 1, T(2024, 1, 1), None)],
                                 "customer_key long, customer_id long, effective_from timestamp_ntz, "
                                 "effective_to timestamp_ntz")
    prod = spark.createDataFrame([(0, 1)], "product_key long, product_id long")
    from starloom.operators.dims import dim_date
    cal = dim_date(spark, "2024-01-01", "2024-12-31")
    pay = spark.createDataFrame([(0, 1), (1, 1), (2, 3)], "payment_key long, order_id long")  # order 1 twice
    f = fact_ops.fact_orders(orders, items, cust, prod, cal, pay)
    got = sorted((r["order_id"], r["payment_key"]) for r in f.collect())
    assert got == [(1, 0), (1, 1)]   # fan-out on 2 payments; no payment and outside calendar dropped


def test_quality_checks_on_bad_fact(spark):
    fact = spark.createDataFrame(
        [(1, 0, 0, 20240101, 0, 0, 10.0, 0.0, 0.0),       # quantity 0
         (2, 0, 0, 20240101, 0, 1, 10.0, 20.0, -10.0),    # negative revenue
         (3, 0, 0, 20240101, 0, 1, 10.0, 0.0, 10.02),     # off by 0.02
         (4, None, 0, 20240101, 0, 1, 10.0, 0.0, 10.0),   # NULL key
         (5, 0, 0, 20240101, 0, 1, 10.0, 0.0, 10.0),
         (5, 0, 0, 20240101, 0, 1, 10.0, 0.0, 10.0)],     # repeated group
        "order_id long, customer_key long, product_key long, date_key int, payment_key long, quantity int, "
        "unit_price double, discount double, revenue double")
    rng = {r["column_name"]: r["violations"] for r in
           dq.ranges(fact, "f", {"q": F.col("quantity") <= 0, "rev": F.col("revenue") < 0}).collect()}
    assert rng == {"q": 1, "rev": 1}
    ident = {r["column_name"]: r["violations"] for r in dq.revenue_identity(fact).collect()}
    assert ident == {"revenue_exact": 1, "revenue_off_by_more_than_1_cents": 1}
    assert dq.null_keys(fact).first()["violations"] == 1
    assert dq.duplicate_fact_groups(fact).first()["violations"] == 1
    nn = {r["column_name"]: r["status"] for r in dq.not_null(fact, "f", ["order_id", "customer_key"]).collect()}
    assert nn == {"order_id": "PASS", "customer_key": "FAIL"}
    with pytest.raises(dq.QualityError):
        dq.fail_on_error(dq.null_keys(fact))


def test_watermark_ties_lookback_and_missing_state(spark):
    src = spark.createDataFrame([(1, T(2024, 1, 1)), (2, T(2024, 1, 1)), (3, T(2024, 1, 2))],
                                "id long, updated_at timestamp_ntz")
    state = initial_state(spark, [("p", "t", "2024-01-01 00:00:00")])
    mark = read_watermark(state, "p", "t")
    assert [r["id"] for r in changes_since(src, "updated_at", mark).collect()] == [3]            # strict >
    assert changes_since(src, "updated_at", mark, dt.timedelta(seconds=1)).count() == 3        # lookback
    assert changes_since(src, "updated_at", read_watermark(state, "p", "missing")).count() == 3  # full load
    nxt = advance(state, "p", "t", changes_since(src, "updated_at", mark), "updated_at")
    assert read_watermark(nxt, "p", "t") == T(2024, 1, 2)
    with pytest.raises(ContractError):
        require_columns(src, ["id", "nope"])


def test_publish_rollback(spark, scratch):
    path = os.path.join(scratch, "tbl")
    good = spark.createDataFrame([(1,), (2,)], "x long")
    res = pub.publish(good, path)
    assert res.rows == 2 and res.backup is None
    with pytest.raises(pub.PublishError):
        pub.publish(spark.createDataFrame([(9,)], "x long"), path, verify=lambda df: 1)
    assert sorted(r["x"] for r in spark.read.parquet(path).collect()) == [1, 2]   # live unchanged
    calls = []

    def fail_after_publish(df):
        calls.append(1)
        return 0 if len(calls) == 1 else 1   # staged copy passes, published copy fails

    with pytest.raises(pub.PublishError):
        pub.publish(spark.createDataFrame([(7,)], "x long"), path, verify=fail_after_publish)
    assert sorted(r["x"] for r in spark.read.parquet(path).collect()) == [1, 2]   # backup restored
    res = pub.publish(spark.createDataFrame([(3,)], "x long"), path, keep_backup=False)
    assert res.backup is None and [r["x"] for r in spark.read.parquet(path).collect()] == [3]
    dry = pub.publish(good, path, dry_run=True)
    assert dry.dry_run and dry.rows == 2
    root = os.path.join(scratch, "versioned")
    pub.publish_versioned(good, root)
    pub.publish_versioned(spark.createDataFrame([(5,)], "x long"), root)
    assert [r["x"] for r in pub.read_versioned(spark, root).collect()] == [5]


def test_full_refresh_and_csv_sink(spark, scratch):
    from starloom.plans.warehouse import full_refresh
    from starloom.sinks.publish import write_csv
    out = os.path.join(scratch, "wh")
    rep = full_refresh(spark, "/root/testdata/sf0.001", out)
    assert rep["warehouse/fact_orders"] > 0 and rep["warehouse/dim_date"] == 2557
    # a second run merges into the stored dimensions; unchanged data keeps every key
    keys1 = sorted(spark.read.parquet(os.path.join(out, "warehouse/dim_product")).select(
        "product_id", "product_key").collect())
    rep2 = full_refresh(spark, "/root/testdata/sf0.001", out)
    assert rep2["warehouse/fact_orders"] == rep["warehouse/fact_orders"]
    keys2 = sorted(spark.read.parquet(os.path.join(out, "warehouse/dim_product")).select(
        "product_id", "product_key").collect())
    assert keys1 == keys2
    # a changed city opens a version and leaves the other keys alone
    path = os.path.join(out, "warehouse/dim_customer")
    old = {r.customer_id: r for r in spark.read.parquet(path).collect()}
    spark.read.parquet(path).withColumn("city", F.when(F.col("customer_id") == 5, F.lit("ELSEWHERE")).otherwise(
        F.col("city"))).withColumn("effective_from", F.when(F.col("customer_id") == 5, F.expr(
            "effective_from - INTERVAL 1 DAY")).otherwise(F.col("effective_from"))).write.partitionBy("is_current").parquet(os.path.join(scratch, "moved"))
    from starloom.sinks.publish import publish
    publish(spark.read.parquet(os.path.join(scratch, "moved")), path, partition_by=["is_current"])
    full_refresh(spark, "/root/testdata/sf0.001", out)
    now = spark.read.parquet(path).collect()
    assert len(now) == len(old) + 1
    assert all(r.customer_key == old[r.customer_id].customer_key for r in now if r.customer_id != 5)
    assert sorted(str(r.is_current).lower() for r in now if r.customer_id == 5) == ["false", "true"]
    csv = os.path.join(scratch, "landing")
    write_csv(spark.read.parquet(os.path.join(out, "staging/orders")), csv)
    assert spark.read.option("header", True).csv(csv).count() == rep["staging/orders"]


def test_stream_in_several_batches_equals_whole_log(spark, scratch):
    from starloom.operators.scd import scd2_from_log
    from starloom.streaming.change_feed import run_change_stream
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    src = os.path.join(scratch, "feed")
    days = sorted({r[0] for r in ev.select(F.to_date("ts")).distinct().collect()})
    cuts = [days[0], days[len(days) // 3], days[2 * len(days) // 3], days[-1] + dt.timedelta(days=1)]
    for i in range(3):
        part = ev.filter((F.to_date("ts") >= F.lit(cuts[i])) & (F.to_date("ts") < F.lit(cuts[i + 1])))
        part.coalesce(1).write.parquet(os.path.join(src, f"part{i}"))
    log = run_change_stream(spark, os.path.join(src, "part*"), ev.schema, "user_id", "ts", ["event_type"],
                            "event_id", base_path=src, max_files_per_trigger=1,
                            root=os.path.join(scratch, "state"))
    got, ref = log.versions(), scd2_from_log(ev, "user_id", "ts", ["event_type"], ["event_id"])
    cols = ["user_id", "event_type", "effective_from", "effective_to", "is_current"]
    assert sorted(got.select(*cols).collect()) == sorted(ref.select(*cols).collect())
    assert got.select("version_key").distinct().count() == got.count()
    assert log.last().batch == 2


def test_scd1_refresh_keeps_keys(spark):
    from starloom.operators.scd import scd1_refresh
    old = spark.createDataFrame([(0, 10, "a"), (1, 20, "b"), (2, 30, "c")], "k long, id long, v string")
    new = spark.createDataFrame([(15, "n"), (20, "B"), (30, "c")], "id long, v string")
    got = sorted(tuple(r) for r in scd1_refresh(old, new, "id", "k").collect())
    assert got == [(0, 10, "a"), (1, 20, "B"), (2, 30, "c"), (3, 15, "n")]


def test_expected_count_check(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "x long")
    assert dq.expected_count(df, "t", 3).first()["status"] == "PASS"
    row = dq.expected_count(df, "t", 5).first()
    assert row["violations"] == 2 and row["status"] == "FAIL"


def test_stage_try_casts_bad_values(spark):
    raw = spark.createDataFrame([("7", "x", "y", "A@B.C", "c", "s", "k", "2024-01-01", "2024-01-02 00:00:00"),
                                 ("1.0", "x", "y", "q@b.c", "c", "s", "k", "not a date", "2024-01-02 00:00:00")],
                                ",".join(f"c{i} string" for i in range(9)))
    raw = raw.toDF(*[c for c, _ in CUSTOMERS.columns])
    rows = {r["email"]: r for r in stage(raw, CUSTOMERS, dedupe=False).collect()}
    assert rows["a@b.c"]["customer_id"] == 7
    assert rows["q@b.c"]["customer_id"] is None and rows["q@b.c"]["signup_date"] is None


def test_incremental_run_empty_batch_and_advance(spark, scratch):
    from starloom.plans.incremental import incremental_run
    src = spark.createDataFrame([(1, T(2024, 1, 1)), (2, T(2024, 1, 3))], "id long, updated_at timestamp_ntz")
    state = initial_state(spark, [("p", "t", "2024-01-05 00:00:00")])
    published = []
    run = incremental_run(src, state, "p", "t", "updated_at", apply=lambda b: b,
                          publish=lambda df: published.append(df.count()))
    assert not run.applied and published == []                        # nothing newer: target untouched
    state = initial_state(spark, [("p", "t", "2024-01-02 00:00:00")])
    run = incremental_run(src, state, "p", "t", "updated_at", apply=lambda b: b,
                          publish=lambda df: published.append(df.count()))
    assert run.applied and published == [1]
    assert read_watermark(run.state, "p", "t") == T(2024, 1, 3)        # advanced after the publish


def test_observed_write_counts_in_the_same_job(spark, scratch):
    m = pub.write_observed(spark.range(0, 1234).toDF("x"), os.path.join(scratch, "obs"))
    assert m["rows"] == 1234


def test_incremental_run_stops_at_its_upper_bound(spark, scratch):
    """Rows that reach the source during a run wait for the next one."""
    from starloom.plans.incremental import incremental_run
    from starloom.sinks.state import initial_state
    path = os.path.join(scratch, "live")
    rows = "id long, updated_at timestamp_ntz"
    spark.createDataFrame([(1, dt.datetime(2024, 1, 2))], rows).write.parquet(path)
    state = initial_state(spark, [("p", "t", "2024-01-01 00:00:00")])

    def late(batch):
        got = batch.collect()
        spark.createDataFrame([(2, dt.datetime(2024, 1, 3))], rows).write.mode("append").parquet(path)
        return spark.createDataFrame(got, rows)

    order, stored = [], []
    run = incremental_run(spark.read.parquet(path), state, "p", "t", "updated_at", apply=late,
                          publish=lambda df: order.append([r.id for r in df.collect()]),
                          store=lambda s: stored.extend(s.collect()))
    assert order == [[1]]
    assert stored[0].last_processed_at == dt.datetime(2024, 1, 2)
    again = incremental_run(spark.read.parquet(path), run.state, "p", "t", "updated_at", apply=lambda b: b)
    assert [r.id for r in again.result.collect()] == [2]


def test_crash_before_the_commit_keeps_the_last_version(spark, scratch):
    from starloom.sinks import publish as pub
    root = os.path.join(scratch, "committed")
    pub.publish_versioned(spark.range(3), root)
    spark.range(9).write.parquet(f"{root}/v=2")  # a writer that died before its commit
    assert pub.read_versioned(spark, root).count() == 3
    pub.publish_versioned(spark.range(5), root)
    assert pub.read_versioned(spark, root).count() == 5
    with pytest.raises(pub.PublishError):
        pub.write_once(spark.range(1), f"{root}/_commits/n=2")
