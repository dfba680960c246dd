"""Publish journal, ordered and bucketed output, interval index, rejects,
two-phase de-duplication, one-scan rules."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from starloom.operators import quality as dq, temporal
from starloom.operators.staging import (NUMBERED_ITEMS, ORDERS, SHIPPED_ORDERS, latest_of_repeated, latest_per_key, stage,
                                        stage_split)
from starloom.sinks import publish as pub

T = dt.datetime


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------------ publish
class Killed(BaseException):
    pass


def test_publish_killed_at_any_step_leaves_a_readable_table(spark, scratch, monkeypatch):
    """Every file operation of a second publish may be its last."""
    steps = 0
    while True:
        path = os.path.join(scratch, f"t{steps}")
        pub.publish(spark.range(3), path)
        left = steps

        def dying(real):
            def call(*args):
                nonlocal left
                if left == 0:
                    raise Killed
                left -= 1
                return real(*args)
            return call
        ended = True
        with monkeypatch.context() as m:
            for name in ("rename", "delete", "_write_text", "write_observed"):
                m.setattr(pub, name, dying(getattr(pub, name)))
            try:
                pub.publish(spark.range(5), path, keep_backup=False)
            except Killed:
                ended = False
        pub.recover(spark, path)
        assert spark.read.parquet(path).count() == (5 if ended else spark.read.parquet(path).count())
        assert spark.read.parquet(path).count() in (3, 5)
        pub.publish(spark.range(7), path)  # the next publish starts clean
        assert spark.read.parquet(path).count() == 7 and not pub.exists(spark, path + "._journal")
        if ended:
            break
        steps += 1
    assert steps >= 5


def test_publish_keeps_the_latest_backups(spark, scratch):
    path = os.path.join(scratch, "kept")
    for n in range(1, 7):
        pub.publish(spark.range(n), path, retain=2)
    assert [spark.read.parquet(b).count() for b in pub.backups(spark, path)] == [4, 5]


def test_ordered_output_is_ordered_across_files(spark, scratch):
    path = os.path.join(scratch, "ordered")
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"), F.lit("x").alias("position2"))
    pub.write_ordered(rows, path, ["v"], files=5)
    files = sorted(f for f in os.listdir(path) if f.endswith(".parquet"))
    assert len(files) == 5
    assert [r.v for f in files for r in spark.read.parquet(os.path.join(path, f)).collect()] == list(range(1000))
    assert all(r.position == r.v + 1 for r in pub.read_ordered(spark, path).collect())


def test_bucketed_tables_join_without_an_exchange(spark, scratch):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = pub.save_table(spark.range(500).withColumn("x", F.col("id") % 7), "bucketed_a", path=f"{scratch}/a", bucket_by=["id"])
        b = pub.save_table(spark.range(900).withColumn("y", F.col("id") % 5), "bucketed_b", path=f"{scratch}/b", bucket_by=["id"])
        both = a.join(b, "id").groupBy("id").agg(F.sum("y"))
        assert both.count() == 500
        assert "Exchange" not in plan(both).split("Initial Plan")[0]
        assert len([f for f in os.listdir(f"{scratch}/a") if f.endswith(".parquet")]) <= 4  # one file per bucket
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        for t in ("bucketed_a", "bucketed_b"):
            spark.sql(f"DROP TABLE IF EXISTS {t}")


# ------------------------------------------------------------ interval index
def test_interval_cells_are_few_and_exact(spark):
    rows = [(0, T(1, 1, 1), T(9999, 12, 31)), (1, T(1969, 12, 31, 23, 59, 58), T(1970, 1, 1, 0, 0, 3)),
            (2, T(2024, 1, 1), None), (3, T(2024, 1, 1), T(2024, 1, 1)), (4, T(2024, 1, 1), T(2023, 1, 1)),
            (5, None, T(2024, 1, 1)), (6, T(2024, 2, 29, 1, 2, 3, 4), T(2024, 2, 29, 1, 2, 3, 5))]
    v = spark.createDataFrame(rows, "id long, effective_from timestamp_ntz, effective_to timestamp_ntz")
    cells = {}
    for r in temporal.interval_index(v).collect():
        cells.setdefault(r.id, []).append((r._sl_level, r._sl_cell))
    assert 4 not in cells and 5 not in cells
    assert all(len(c) <= 14 * temporal.CELL_LEVELS for c in cells.values())
    for i, start, end in rows:
        if i in cells:
            spans = sorted((c << 3 * level, (c + 1) << 3 * level) for level, c in cells[i])
            assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))  # one after the other, none twice
            assert spans[0][0] == int((start - T(1970, 1, 1)).total_seconds() // 1)


def test_point_in_time_join_with_a_key_hot_on_both_sides(spark):
    rnd = random.Random(2)
    vers, facts = [], []
    for key, n in ((0, 900), (1, 3), (2, 200)):
        t = T(2020, 1, 1)
        for i in range(n):
            end = t + dt.timedelta(seconds=rnd.choice((1, 5, 70, 4000, 10**6)), microseconds=rnd.choice((0, 0, 500)))
            vers.append((key, i, t, T(9999, 12, 31) if i == n - 1 and key else None if i == n - 1 else end))
            t = end + dt.timedelta(seconds=rnd.choice((0, 0, 0, 3)))  # gaps too
    vers += [(2, 1000, T(2020, 1, 1), T(9999, 12, 31)), (None, 1, T(2020, 1, 1), None)]  # one that overlaps all others
    starts = [v[2] for v in vers if v[0] is not None]
    for i in range(3000):
        facts.append((i, rnd.choice((0, 0, 1, 2, 3, None)), rnd.choice(starts) + dt.timedelta(seconds=rnd.choice((-1, 0, 1, 900)))))
    v = spark.createDataFrame(vers, "k long, n long, effective_from timestamp_ntz, effective_to timestamp_ntz")
    f = spark.createDataFrame(facts, "id long, k long, ts timestamp_ntz")
    got, want = (sorted((r.id, r.n) for r in temporal.point_in_time_join(f, v, "k", "ts", many=m).collect()) for m in (100, None))
    assert got == want and len(got) > 2000
    counts = [sorted(map(tuple, temporal.version_match_count(f, v, "id", "k", "ts", "n", many=m).collect())) for m in (100, None)]
    assert counts[0] == counts[1] and len(counts[0]) == 3000 and {0, 1, 2} <= {n for _, n in counts[0]}
    index = temporal.interval_index(v.filter("k = 0"))
    pairs = f.filter("k = 0").withColumn("s", temporal._seconds(F.col("ts"))).join(
        index, F.expr("shiftright(s, 3 * _sl_level) = _sl_cell"))
    assert pairs.count() < 3 * f.filter("k = 0").count()  # each fact meets few versions, not all 900
    with pytest.raises(ValueError):
        temporal.point_in_time_join(f, v, "k", "ts", how="left", many=1)


# -------------------------------------------------------------------- staging
def test_rejected_rows_keep_their_text_and_reasons(spark):
    raw = spark.createDataFrame([
        ("1", "5", "2024-01-01 00:00:00", " Shipped ", "2024-01-01 00:00:00"), ("1", "5", "2024-01-02 00:00:00", "pending", "2024-01-03 00:00:00"),
        ("x1", "5", "2024-01-01 00:00:00", "pending", None), ("x2", None, "soon", "pending", None),
        (None, "5", "2024-01-01 00:00:00", "lost", None), ("9", "5", "2024-01-01 00:00:00", None, None)],
        "order_id string, customer_id string, order_date string, order_status string, updated_at string")
    good, bad = stage_split(raw, ORDERS)
    assert [(r.order_id, r.order_status) for r in good.collect()] == [(1, "pending")]
    assert {(r.order_id, tuple(r.reasons)) for r in bad.collect()} == {
        ("x1", ("cast:order_id",)), ("x2", ("cast:order_id", "cast:order_date", "null:customer_id")),
        (None, ("null:order_id", "check:order_status")), ("9", ("null:order_status",))}
    assert good.schema == stage(raw, ORDERS).schema


def test_the_sources_own_order_columns(spark):
    orders = spark.createDataFrame([(1, 2, T(2024, 1, 1), "SHIPPED", " Pune ", "MH ", T(2024, 1, 1))] * 2,
                                   "order_id int, customer_id int, order_date timestamp_ntz, order_status string, "
                                   "shipping_city string, shipping_state string, updated_at timestamp_ntz")
    row = stage(orders, SHIPPED_ORDERS).collect()
    assert [(r.order_status, r.shipping_city, r.shipping_state) for r in row] == [("shipped", "Pune", "MH")]
    items = spark.createDataFrame([(1, 1, 7, 3, "2.50", "0.50"), (1, 1, 7, 3, "2.50", "0.50"), (2, 1, 7, 0, "1", "0"),
                                   (3, 1, None, 1, "-1", "0")],
                                  "order_item_id int, order_id int, product_id int, quantity int, unit_price string, discount string")
    good, bad = stage_split(items, NUMBERED_ITEMS)
    assert [(r.order_item_id, float(r.line_total)) for r in good.collect()] == [(1, 7.0)]
    assert {(r.order_item_id, tuple(r.reasons)) for r in bad.collect()} == {
        ("2", ("check:quantity_positive",)), ("3", ("null:product_id", "check:unit_price_not_negative"))}


def test_dedupe_sorts_only_repeated_keys(spark):
    rnd = random.Random(6)
    rows = [(i, rnd.randint(0, 9), f"v{i}") for i in range(3000)] + [(rnd.randint(0, 20), rnd.randint(0, 9), f"w{i}") for i in range(50)]
    rows += [(None, 1, "a"), (None, 2, "b"), (7, None, "n")]
    df = spark.createDataFrame(rows, "k long, t long, v string").repartition(3).checkpoint()
    got = latest_of_repeated(df, ["k"], ["t"])
    assert sorted(got.collect(), key=str) == sorted(latest_per_key(df, ["k"], ["t"]).collect(), key=str)
    final = plan(got).split("Initial Plan")[0]
    assert "SortMergeJoin" not in final and "BroadcastHashJoin" in final
    unique = df.filter("k > 100")
    assert latest_of_repeated(unique, ["k"], ["t"]) is unique  # nothing repeats: no shuffle at all


def test_all_rules_of_a_table_take_one_scan(spark, scratch):
    spark.createDataFrame([(1, "a", 5), (None, "z", -1), (3, None, 2)], "id long, s string, n long").write.parquet(f"{scratch}/r")
    df = spark.read.parquet(f"{scratch}/r")
    report = dq.table_rules(df, "t", [*dq.not_null_rules("id", "s"), *dq.accepted_rules(s=["a", "b"]),
                                      *dq.range_rules(n_negative=F.col("n") < 0), dq.null_key_rule(("id", "s"))])
    assert [(r.check, r.column_name, r.violations, r.status) for r in report.collect()] == [
        ("not_null", "id", 1, "FAIL"), ("not_null", "s", 1, "FAIL"), ("accepted_values", "s", 1, "FAIL"),
        ("range", "n_negative", 1, "FAIL"), ("null_dimension_keys", "id,s", 2, "FAIL")]
    assert plan(report).split("Initial Plan")[0].count("FileScan") == 1


def test_settings_keep_tasks_small(spark):
    from starloom.session import configure
    unset, named = spark.newSession(), spark.newSession()
    keys = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m", "spark.sql.files.maxPartitionBytes": "32m"}
    for key in keys:
        unset.conf.unset(key)
        named.conf.set(key, "8m")
    configure(unset), configure(named)
    for key, value in keys.items():
        assert unset.conf.get(key) == value
        assert named.conf.get(key) == "8m"  # what the cluster names stays


def test_stored_rows_are_computed_once(spark):
    from starloom.session import stored
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    df = spark.range(0, 100, 1, 3).selectExpr("id", "struct(id AS a, cast(NULL AS string) AS b) AS s").mapInArrow(
        run, "id long, s struct<a:long,b:string>")
    kept = stored(df)
    assert seen.value == 100
    assert sorted(kept.collect()) == sorted((i, (i, None)) for i in range(100))
    assert kept.schema == df.schema and seen.value == 100
    assert stored(df.filter("id < 0")).count() == 0


def test_steps_run_at_once_and_keep_their_order():
    import threading
    from starloom.plans.warehouse import at_once
    together = threading.Barrier(3, timeout=20)

    def step(i):
        together.wait()
        return i * 10
    assert at_once(step, [3, 1, 2]) == [30, 10, 20]


# -------------------------------------------------------- disk of a refresh
def _shop(spark, path):
    """Tables of the driver's shape, with repeated and null keys and rows that are rejected."""
    rnd = random.Random(4)

    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).coalesce(2).write.parquet(f"{path}/{name}.parquet")
    put("region", [(0, "EAST"), (1, "WEST")], "r_regionkey int, r_name string")
    put("nation", [(i, f"N{i}", i % 2) for i in range(4)], "n_nationkey int, n_name string, n_regionkey int")
    put("customer", [(i, f"Customer#{i}", (i or 0) % 4, 1.5, "CITY") for i in [*range(40), None, None, 7]],
        "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    put("part", [(i, f"p{i}", f"b{(i or 0) % 3}", f"t{(i or 0) % 5}", 1, 10.25 + (i or 0)) for i in [*range(30), None]],
        "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double")
    day = lambda: T(1997, 1, 1) + dt.timedelta(hours=rnd.randrange(9000))
    put("orders", [(i, rnd.choice([*range(40), None]), rnd.choice("FOP"), 9.5, day(), "LOW") for i in [*range(300), None, None, 5, 6]],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string")
    items = [(rnd.choice([*range(310), None]), rnd.randrange(30), 1, rnd.choice((1, 2, None)), float(rnd.choice((0, 1, 5, 9))), 1.0, 0.05, 0.0,
              "N", "O", day()) for _ in range(1500)]
    put("lineitem", items + items[:40], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")


TABLES = [f"{kind}/{n}" for kind in ("staging", "rejected") for n in ("customers", "products", "orders", "order_items", "payments")] + [
    "warehouse/dim_customer", "warehouse/dim_product", "warehouse/dim_payment", "warehouse/dim_date", "warehouse/fact_orders",
    *[f"analytics/mart_{n}" for n in ("daily_sales", "product_performance", "customer_performance", "category_performance", "payment_analysis")],
    *[f"quality/{n}" for n in ("warehouse_checks", "reconciliation", "scd2_integrity")]]


def test_a_refresh_in_slices_stores_the_same_tables(spark, scratch, monkeypatch):
    from starloom.plans import warehouse
    _shop(spark, f"{scratch}/in")
    cut = []

    def counted(n, key, *tables, was=warehouse.slices):
        cut.append(n)
        return was(n, key, *tables)
    monkeypatch.setattr(warehouse, "slices", counted)
    found = {}
    for n, runs in ((1, 1), (3, 2)):
        monkeypatch.setattr(warehouse, "SLICE_BYTES", warehouse.input_bytes(spark, f"{scratch}/in") // n + 1)
        cut.clear()
        for _ in range(runs):
            report = warehouse.full_refresh(spark, f"{scratch}/in", f"{scratch}/{n}")
        assert max(cut) == n
        rows = {t: sorted(map(str, spark.read.parquet(f"{scratch}/{n}/{t}").collect())) for t in TABLES}
        assert {t: len(rows[t]) for t in TABLES} == {t: report[t] for t in TABLES}
        found[n] = report, rows
    assert found[1] == found[3]
    assert all(len(pub.backups(spark, f"{scratch}/3/{t}")) == 1 for t in TABLES)
    assert rows["warehouse/fact_orders"] and rows["rejected/order_items"] and any("FAIL" in r for r in rows["quality/warehouse_checks"])


def test_a_refresh_leaves_only_its_tables_on_disk(spark, scratch):
    import glob
    import time
    from starloom.plans.warehouse import full_refresh
    from starloom.session import SMALL_ON_DISK, ensure_checkpoint_dir
    _shop(spark, f"{scratch}/in")
    local = [d.getPath() for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def left():
        shuffled = {f for d in local for f in glob.glob(f"{d}/*/shuffle_*")}
        return shuffled, set(glob.glob(ensure_checkpoint_dir(spark).removeprefix("file:") + "/starloom-*"))
    before = left()
    named = {k: spark.conf.get(k, None) for k in SMALL_ON_DISK}
    assert full_refresh(spark, f"{scratch}/in", f"{scratch}/out")["warehouse/fact_orders"] > 0
    until = time.time() + 20  # files are removed beside the next jobs
    while (left()[0] - before[0]) and time.time() < until:
        time.sleep(0.2)
    after = left()
    assert not after[0] - before[0] and not after[1] - before[1]
    assert {k: spark.conf.get(k, None) for k in SMALL_ON_DISK} == named
    assert glob.glob(f"{scratch}/out/staging/orders/*.zstd.parquet")


def test_a_table_is_published_slice_by_slice(spark, scratch):
    path, asked = f"{scratch}/t", []

    def parts(n):
        for i in range(n):
            asked.append((i, len(os.listdir(scratch))))
            yield spark.range(i * 10, i * 10 + i + 1).selectExpr("id", "id % 2 AS k")
    assert pub.publish(parts(3), path, verify=lambda df: df.count() - 6, partition_by=["k"]).rows == 6
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 10, 11, 20, 21, 22]
    assert asked == [(0, 0), (1, 1), (2, 1)]  # each when the one before is stored
    again = pub.publish(parts(2), path, partition_by=["k"])
    assert again.rows == 3 and len(pub.backups(spark, path)) == 1
    assert pub.publish(parts(3), path, dry_run=True).rows == 6
    with pytest.raises(pub.PublishError):
        pub.publish(parts(3), path, verify=lambda df: df.count())
    assert spark.read.parquet(path).count() == 3


def test_few_steps_run_at_once():
    import threading
    import time
    from starloom.plans.warehouse import at_once
    lock, now, most = threading.Lock(), [0], []

    def step(i):
        with lock:
            now[0] += 1
            most.append(now[0])
        time.sleep(0.02)
        with lock:
            now[0] -= 1
        return i
    assert at_once(step, range(9), 2) == [*range(9)] and max(most) <= 2


def test_slices_of_a_check_add_up(spark):
    fact = spark.createDataFrame([(i % 7, 1, 2, 3, 4) for i in range(20)] + [(None, 1, 2, 3, 4)] * 2 + [(99, 1, 2, 3, 4)],
                                 "order_id long, product_key long, quantity int, unit_price int, discount int")
    from starloom.plans.warehouse import slices
    whole = dq.report_rows(dq.duplicate_fact_groups(fact))
    assert whole[0].violations == 8
    assert dq.report_rows([dq.duplicate_fact_groups(f) for f in slices(4, "order_id", fact)]) == whole
