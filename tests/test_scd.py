"""SCD1/SCD2 edge cases on literal fixtures (FIXTURES.md section 3)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starloom.operators import scd
from starloom.operators.temporal import point_in_time_join, version_match_count

D = dt.date
T = dt.datetime
DIM = ("customer_key long, customer_id long, first_name string, last_name string, email string, city string, "
       "state string, country string, signup_date date, effective_from timestamp_ntz, "
       "effective_to timestamp_ntz, is_current boolean")
SRC = ("customer_id long, first_name string, last_name string, email string, city string, state string, "
       "country string, signup_date date, updated_at timestamp_ntz")

BASE = [
    (0, 1, "Ann", "Lee", "ann@x.com", "Pune", "MH", "IN", D(2024, 1, 1), T(2024, 1, 1), None, True),
    (1, 2, "Bob", "Ray", "bob@x.com", "Oslo", None, "NO", D(2024, 1, 2), T(2024, 1, 2), T(2024, 3, 1), False),
    (2, 2, "Bob", "Ray", "bob@x.com", "Bergen", None, "NO", D(2024, 1, 2), T(2024, 3, 1), None, True),
    (3, 3, "Cy", "Dee", "cy@x.com", "Rome", "LZ", "IT", D(2024, 1, 3), T(2024, 1, 3), None, True),
]
SNAP = [
    (1, "Ann", "Lee", "ann@x.com", "Pune", "MH", "IN", D(2024, 1, 1), T(2024, 5, 1)),
    (2, "Bob", "Ray", "bob@x.com", "Bergen", None, "NO", D(2024, 1, 2), T(2024, 5, 1)),
    (3, "Cy", "Dee", "cy@x.com", "Rome", "LZ", "IT", D(2024, 1, 3), T(2024, 5, 1)),
]


def dim(spark, rows=BASE):
    return spark.createDataFrame(rows, DIM)


def src(spark, rows):
    return spark.createDataFrame(rows, SRC)


def with_row(rows, cid, **changes):
    out = []
    names = [f.split()[0] for f in SRC.split(", ")]
    for r in rows:
        if r[0] == cid:
            d = dict(zip(names, r))
            d.update(changes)
            r = tuple(d[n] for n in names)
        out.append(r)
    return out


def by_key(df):
    return {r["customer_key"]: r for r in df.collect()}


def test_change_one_city(spark):
    chg = with_row(SNAP, 1, city="LISBON", updated_at=T(2027, 6, 1, 8))
    out = by_key(scd.scd2_merge(dim(spark), src(spark, chg)))
    assert len(out) == 5
    old, new = out[0], out[4]  # old key kept, new key = max + 1
    assert old["effective_to"] == T(2027, 6, 1, 8) and old["is_current"] is False
    assert new["customer_id"] == 1 and new["city"] == "LISBON" and new["is_current"] is True
    assert new["effective_from"] == T(2027, 6, 1, 8) and new["effective_to"] is None


def test_identical_snapshot_is_noop(spark):
    out = scd.scd2_merge(dim(spark), src(spark, SNAP))
    assert sorted(out.collect()) == sorted(dim(spark).collect())


def test_null_safe_comparison(spark):
    chg = with_row(SNAP, 2, state="VT")           # NULL -> value: change
    chg = with_row(chg, 3, state=None)            # value -> NULL: change
    out = scd.scd2_merge(dim(spark), src(spark, chg))
    cur = {r["customer_id"]: r for r in out.filter("is_current").collect()}
    assert cur[2]["state"] == "VT" and cur[3]["state"] is None
    assert out.count() == 6
    # NULL -> NULL (id 2 keeps state NULL) is not a change
    assert scd.scd2_merge(dim(spark), src(spark, SNAP)).count() == 4


def test_new_id_snapshot_inserts_strict_rejects(spark):
    chg = SNAP + [(4, "Dan", "Moe", "dan@x.com", "Lima", None, "PE", D(2024, 2, 1), T(2024, 5, 1))]
    out = by_key(scd.scd2_merge(dim(spark), src(spark, chg)))
    assert out[4]["customer_id"] == 4 and out[4]["effective_from"] == T(2024, 2, 1)
    with pytest.raises(scd.Scd2ValidationError) as e:
        scd.scd2_merge(dim(spark), src(spark, chg[3:]), mode="strict")
    assert dict(e.value.violations)["id_without_current_version"] == 1


def test_untracked_and_missing_ids(spark):
    chg = with_row(SNAP, 1, signup_date=D(2023, 1, 1))   # untracked only
    chg = [r for r in chg if r[0] != 3]                   # id 3 absent
    out = scd.scd2_merge(dim(spark), src(spark, chg))
    assert out.count() == 4
    assert out.filter("customer_id = 3 AND is_current").count() == 1


@pytest.mark.parametrize("when", [T(2024, 1, 1), None])
def test_change_time_not_after_start_rejected(spark, when):
    chg = with_row(SNAP, 1, city="X", updated_at=when)
    with pytest.raises(scd.Scd2ValidationError) as e:
        scd.scd2_merge(dim(spark), src(spark, chg))
    assert "change_time_not_after_current_start" in dict(e.value.violations)


def test_duplicate_batch_and_two_current_rejected(spark):
    with pytest.raises(scd.Scd2ValidationError) as e:
        scd.scd2_merge(dim(spark), src(spark, SNAP + SNAP[:1]))
    assert "duplicate_change_ids" in dict(e.value.violations)
    two = BASE + [(9, 2, "Bob", "Ray", "bob@x.com", "Oslo", None, "NO", D(2024, 1, 2), T(2024, 2, 1), None, True)]
    with pytest.raises(scd.Scd2ValidationError) as e:
        scd.scd2_merge(dim(spark, two), src(spark, SNAP))
    assert "multiple_current_versions" in dict(e.value.violations)


def test_empty_dimension_starts_at_zero(spark):
    out = scd.scd2_merge(spark.createDataFrame([], DIM), src(spark, SNAP))
    assert sorted(r["customer_key"] for r in out.collect()) == [0, 1, 2]


def test_strict_feed_opens_version_even_without_difference(spark):
    out = scd.scd2_merge(dim(spark), src(spark, SNAP[:1]), mode="strict")
    assert out.filter("customer_id = 1").count() == 2


def test_repair_start(spark):
    late = [list(r) for r in BASE]
    late[0][9] = T(2024, 2, 15)      # id 1 first version starts late
    late[1][9] = T(2024, 1, 20)      # id 2 earliest version starts late
    out = {r["customer_key"]: r for r in scd.scd2_repair_start(dim(spark, [tuple(r) for r in late])).collect()}
    assert out[0]["effective_from"] == T(2024, 1, 1)
    assert out[1]["effective_from"] == T(2024, 1, 2)
    assert out[2]["effective_from"] == T(2024, 3, 1)   # later version untouched


def test_integrity_report(spark):
    ok = {r["check"]: r["violations"] for r in scd.scd2_integrity(dim(spark)).collect()}
    assert set(ok.values()) == {0}
    gap = [list(r) for r in BASE]
    gap[1][10] = T(2024, 2, 1)       # closed version ends before the next starts
    bad = {r["check"]: r["violations"] for r in scd.scd2_integrity(dim(spark, [tuple(r) for r in gap])).collect()}
    assert bad["broken_chain"] == 1


def test_point_in_time_edges(spark):
    orders = spark.createDataFrame([(10, 2, T(2024, 1, 2)), (11, 2, T(2024, 3, 1)), (12, 2, T(2024, 1, 1))],
                                   "order_id long, customer_id long, order_date timestamp_ntz")
    d = dim(spark).select("customer_id", "customer_key", "effective_from", "effective_to")
    got = {r["order_id"]: r["customer_key"]
           for r in point_in_time_join(orders, d, "customer_id", "order_date").collect()}
    assert got == {10: 1, 11: 2}     # at start -> that version; at end -> next; before first -> none
    counts = {r["order_id"]: r["match_count"] for r in
              version_match_count(orders, d, "order_id", "customer_id", "order_date", "customer_key").collect()}
    assert counts == {10: 1, 11: 1, 12: 0}
    bucketed = {r["order_id"]: r["customer_key"] for r in
                point_in_time_join(orders, d, "customer_id", "order_date", many=0).collect()}
    assert bucketed == got


def test_scd1_upsert(spark):
    chg = spark.createDataFrame([(2, None, "Trondheim", T(2024, 6, 1)), (2, None, "Narvik", T(2024, 5, 1)),
                                 (7, "new@x.com", "Kyiv", T(2024, 6, 1))],
                                "customer_id long, email string, city string, updated_at timestamp_ntz")
    out = scd.scd1_upsert(dim(spark), chg, "customer_id", ["email", "city"])
    rows = [r for r in out.collect() if r["customer_id"] == 2]
    assert len(rows) == 2 and {r["city"] for r in rows} == {"Trondheim"}    # latest change, all versions
    assert {r["email"] for r in rows} == {"bob@x.com"}                       # NULL never clears
    assert out.count() == 4                                                  # new id dropped by default
    ins = scd.scd1_upsert(dim(spark), chg, "customer_id", ["email", "city"], insert_new=True,
                          version_key="customer_key")
    new = ins.filter("customer_id = 7").collect()
    assert len(new) == 1 and new[0]["customer_key"] == 4 and new[0]["is_current"]


def test_what_if_does_not_write(spark):
    d = dim(spark)
    out = scd.scd2_what_if(d, src(spark, SNAP), 1, {"city": "LISBON"}, "2027-06-01 08:00:00")
    assert out.filter("customer_id = 1").count() == 2
    assert d.count() == 4


def test_from_log_and_batched_apply_agree(spark):
    rows = [(1, T(2024, 1, d), d, t) for d, t in enumerate("aabbbaac", start=1)]
    rows += [(2, T(2024, 1, d), 100 + d, t) for d, t in enumerate("xxy", start=1)]
    log = spark.createDataFrame(rows, "user_id long, ts timestamp_ntz, event_id long, event_type string")
    whole = scd.scd2_from_log(log, "user_id", "ts", ["event_type"], ["event_id"])
    got = sorted((r["user_id"], r["effective_from"], r["event_type"], r["effective_to"]) for r in whole.collect())
    assert [g[2] for g in got if g[0] == 1] == ["a", "b", "a", "c"]
    empty = spark.createDataFrame([], "version_key long, user_id long, event_type string, "
                                      "effective_from timestamp_ntz, effective_to timestamp_ntz, is_current boolean")
    first = scd.scd2_apply_log(empty, log.filter(F.col("ts") < T(2024, 1, 4)), "user_id", "ts",
                               ["event_type"], "event_id", "version_key")
    both = scd.scd2_apply_log(first, log.filter(F.col("ts") >= T(2024, 1, 4)), "user_id", "ts",
                              ["event_type"], "event_id", "version_key")
    inc = sorted((r["user_id"], r["effective_from"], r["event_type"], r["effective_to"]) for r in both.collect())
    assert inc == got
    keys = [r["version_key"] for r in both.collect()]
    assert len(keys) == len(set(keys))


def test_sequence_applies_several_changes_in_order(spark):
    chg = SNAP + [(1, "Ann", "Lee", "ann@x.com", "Delhi", "DL", "IN", D(2024, 1, 1), T(2024, 6, 1)),
                  (1, "Ann", "Lee", "ann@x.com", "Delhi", "DL", "IN", D(2024, 1, 1), T(2024, 7, 1)),
                  (1, "Ann", "Lee", "ann@x.com", "Goa", "GA", "IN", D(2024, 1, 1), T(2024, 8, 1)),
                  (5, "Eve", "Kim", "eve@x.com", "Seoul", None, "KR", D(2024, 4, 1), T(2024, 6, 1))]
    with pytest.raises(scd.Scd2ValidationError):
        scd.scd2_merge(dim(spark), src(spark, chg))          # default: duplicate ids rejected
    out = scd.scd2_merge(dim(spark), src(spark, chg), sequence=True)
    one = sorted((r["effective_from"], r["city"], r["effective_to"], r["customer_key"])
                 for r in out.filter("customer_id = 1").collect())
    assert one == [(T(2024, 1, 1), "Pune", T(2024, 6, 1), 0), (T(2024, 6, 1), "Delhi", T(2024, 8, 1), 4),
                   (T(2024, 8, 1), "Goa", None, 5)]
    new = out.filter("customer_id = 5").collect()
    assert len(new) == 1 and new[0]["effective_from"] == T(2024, 4, 1) and new[0]["customer_key"] == 6
    assert out.count() == 7
    assert {r["check"]: r["violations"] for r in scd.scd2_integrity(out).collect()}["broken_chain"] == 0


def test_asof_join_matches_interval_join_with_hot_key(spark):
    import random
    from starloom.operators.temporal import asof_join
    rnd = random.Random(11)
    vers, facts, vk = [], [], 0
    for cid in range(6):
        t = T(2024, 1, 1)
        for _ in range(rnd.randint(1, 4) if cid else 40):          # customer 0: long history
            end = t + dt.timedelta(days=rnd.randint(1, 9))
            vers.append((vk, cid, t, end)); vk += 1; t = end
        vers[-1] = vers[-1][:3] + (None,)                           # last version open
    for i in range(3000):
        cid = 0 if i % 3 == 0 else rnd.randint(0, 6)                # customer 0: a third of facts
        facts.append((i, cid, T(2023, 12, 25) + dt.timedelta(hours=rnd.randint(0, 24 * 300))))
    fdf = spark.createDataFrame(facts, "order_id long, customer_id long, order_date timestamp_ntz")
    vdf = spark.createDataFrame(vers, "customer_key long, customer_id long, effective_from timestamp_ntz, "
                                      "effective_to timestamp_ntz")
    ref = point_in_time_join(fdf, vdf, "customer_id", "order_date")
    got = asof_join(fdf, vdf, "customer_id", "order_date", num_partitions=7)
    key = lambda df: sorted((r["order_id"], r["customer_key"]) for r in df.collect())
    assert key(got) == key(ref)
    left = asof_join(fdf, vdf, "customer_id", "order_date", how="left", num_partitions=5)
    assert left.count() == 3000
    assert left.filter("customer_key IS NULL").count() == 3000 - ref.count()


def test_repair_guards_abort(spark):
    orders = spark.createDataFrame([(10, 1, T(2024, 1, 5)), (11, 2, T(2024, 3, 2))],
                                   "order_id long, customer_id long, order_date timestamp_ntz")
    ok = scd.scd2_repair_start(dim(spark), orders=orders, expected_orders=2)
    assert ok.count() == 4
    early = orders.unionByName(spark.createDataFrame([(12, 3, T(2023, 12, 1))],
                                                     "order_id long, customer_id long, order_date timestamp_ntz"))
    with pytest.raises(scd.Scd2ValidationError) as e:
        scd.scd2_repair_start(dim(spark), orders=early)
    assert dict(e.value.violations) == {"orders_not_matching_one_version": 1}
    with pytest.raises(scd.Scd2ValidationError):
        scd.scd2_repair_start(dim(spark), orders=orders, expected_orders=300)


def test_sequence_strict_opens_a_version_per_change(spark):
    chg = [(1, "Ann", "Lee", "ann@x.com", "Pune", "MH", "IN", D(2024, 1, 1), T(2024, 6, 1)),
           (1, "Ann", "Lee", "ann@x.com", "Pune", "MH", "IN", D(2024, 1, 1), T(2024, 7, 1))]
    out = scd.scd2_merge(dim(spark), src(spark, chg), mode="strict", sequence=True)
    one = sorted((r["effective_from"], r["effective_to"]) for r in out.filter("customer_id = 1").collect())
    assert one == [(T(2024, 1, 1), T(2024, 6, 1)), (T(2024, 6, 1), T(2024, 7, 1)), (T(2024, 7, 1), None)]
    with pytest.raises(scd.Scd2ValidationError):
        scd.scd2_merge(dim(spark), src(spark, chg + [(9, "Z", "Z", "z@x", "C", "S", "K", D(2024, 1, 1),
                                                       T(2024, 6, 1))]), mode="strict", sequence=True)


def test_from_log_with_a_user_holding_a_third_of_the_log(spark):
    import random
    from pyspark.sql import Window
    rnd = random.Random(5)
    rows = [(0 if i % 3 == 0 else rnd.randint(1, 40), T(2024, 1, 1) + dt.timedelta(seconds=i), i,
             rnd.choice("ab")) for i in range(6000)]
    log = spark.createDataFrame(rows, "user_id long, ts timestamp_ntz, event_id long, event_type string")
    got = scd.scd2_from_log(log, "user_id", "ts", ["event_type"], ["event_id"], num_partitions=9)
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    starts = log.withColumn("p", F.lag("event_type").over(w)).filter(
        F.col("p").isNull() | (F.col("p") != F.col("event_type")))
    ref = starts.select("user_id", "event_type", F.col("ts").alias("effective_from"),
                        F.lead("ts").over(w).alias("effective_to"))
    cols = ["user_id", "event_type", "effective_from", "effective_to"]
    assert sorted(got.select(*cols).collect()) == sorted(ref.select(*cols).collect())


def test_apply_log_reports_late_rows(spark):
    cols = "user_id long, ts timestamp_ntz, event_id long, event_type string"
    first = spark.createDataFrame([(1, T(2024, 1, 5), 1, "a")], cols)
    empty = spark.createDataFrame([], "version_key long, user_id long, event_type string, effective_from timestamp_ntz, "
                                      "effective_to timestamp_ntz, is_current boolean")
    dim_ = scd.scd2_apply_log(empty, first, "user_id", "ts", ["event_type"], "event_id", "version_key")
    batch = spark.createDataFrame([(1, T(2024, 1, 4), 2, "b"), (1, None, 3, "c"), (1, T(2024, 1, 6), 4, "d")], cols)
    assert {r.event_id for r in scd.scd2_late_rows(dim_, batch, "user_id", "ts").collect()} == {2, 3}
    with pytest.raises(scd.Scd2ValidationError, match="late_rows=2"):
        scd.scd2_apply_log(dim_, batch, "user_id", "ts", ["event_type"], "event_id", "version_key")


def test_integrity_finds_overlaps_of_closed_versions(spark):
    rows = [(0, 1, "A", "B", "e", "c", "s", "k", D(2024, 1, 1), T(2024, 1, 1), T(2024, 1, 10), False),
            (1, 1, "A", "B", "e", "c", "s", "k", D(2024, 1, 1), T(2024, 1, 3), T(2024, 1, 10), False),
            (2, 1, "A", "B", "e", "c", "s", "k", D(2024, 1, 1), T(2024, 1, 10), None, True)]
    found = {r["check"]: r["violations"] for r in scd.scd2_integrity(dim(spark, rows)).collect()}
    assert found["overlapping_versions"] == 1 and sum(found.values()) == 1


def test_merge_names_missing_columns(spark):
    from starloom.sources.readers import ContractError
    with pytest.raises(ContractError, match="city"):
        scd.scd2_merge(dim(spark), src(spark, SNAP).drop("city"))
    with pytest.raises(ContractError, match="signup_date"):
        scd.scd2_repair_start(dim(spark).drop("signup_date"))
    with pytest.raises(ValueError):
        scd.scd2_merge(dim(spark), src(spark, SNAP), sequence=True, return_parts=True)
