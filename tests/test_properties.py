"""Property tests (SURVEY section 5 (d)): incremental application equals the
whole-log computation; distributed keys and neighbours equal their
single-task definitions."""

import datetime as dt

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from starloom.operators import scd
from starloom.operators.keys import dense_key
from starloom.operators.sequence import with_neighbours

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
T0 = dt.datetime(2024, 1, 1)
SPEC = scd.Scd2Spec(key="user_id", version_key="version_key", tracked=("event_type",), change_ts="ts")
EMPTY = ("version_key long, user_id long, event_type string, effective_from timestamp_ntz, "
         "effective_to timestamp_ntz, is_current boolean")


# batches: for each batch, a map user -> value (at most one change per user per batch)
batches_st = st.lists(st.dictionaries(st.integers(0, 4), st.sampled_from("abc"), max_size=5),
                      min_size=1, max_size=4)


@SETTINGS
@given(batches=batches_st)
def test_snapshot_merges_equal_log_versions(spark, batches):
    rows = []
    for b, changes in enumerate(batches):
        for user, value in changes.items():
            rows.append((user, T0 + dt.timedelta(days=b, hours=user), b * 10 + user, value))
    log = spark.createDataFrame(rows, "user_id long, ts timestamp_ntz, event_id long, event_type string")
    dim = spark.createDataFrame([], EMPTY)
    for b in range(len(batches)):
        snap = log.filter(F.col("event_id").between(b * 10, b * 10 + 9)).select("user_id", "event_type", "ts")
        dim = scd.scd2_merge(dim, snap, SPEC, mode="snapshot")
        dim = spark.createDataFrame(dim.collect(), EMPTY)   # materialise between batches
    cols = ["user_id", "event_type", "effective_from", "effective_to", "is_current"]
    whole = scd.scd2_from_log(log, "user_id", "ts", ["event_type"], ["event_id"]) if rows else None
    got = sorted(tuple(r) for r in dim.select(*cols).collect())
    want = sorted(tuple(r) for r in whole.select(*cols).collect()) if whole is not None else []
    assert got == want
    keys = [r["version_key"] for r in dim.collect()]
    assert sorted(keys) == list(range(len(keys)))          # dense, unique, from 0


@SETTINGS
@given(values=st.lists(st.tuples(st.integers(0, 3), st.sampled_from("xy")), min_size=1, max_size=60),
       parts=st.integers(1, 6))
def test_neighbours_equal_window(spark, values, parts):
    rows = [(k if i % 3 else 0, i, v) for i, (k, v) in enumerate(values)]   # key 0 is hot
    df = spark.createDataFrame(rows, "k long, t long, v string")
    got = with_neighbours(df, ["k"], ["t"], ["v"], prev=True, nxt=True, num_partitions=parts)
    w = Window.partitionBy("k").orderBy("t")
    ref = df.select("k", "t", F.lag("v").over(w).alias("p"), F.lead("v").over(w).alias("n"))
    bad = got.join(ref, ["k", "t"]).filter(~F.col("prev_v").eqNullSafe(F.col("p"))
                                            | ~F.col("next_v").eqNullSafe(F.col("n")))
    assert bad.count() == 0


@SETTINGS
@given(ids=st.sets(st.integers(-10**6, 10**6), min_size=1, max_size=200), parts=st.integers(1, 9))
def test_dense_key_equals_row_number(spark, ids, parts):
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    got = {r["id"]: r["k"] for r in dense_key(df, ["id"], "k", num_partitions=parts).collect()}
    assert got == {i: n for n, i in enumerate(sorted(ids))}


@SETTINGS
@given(values=st.lists(st.tuples(st.integers(0, 2), st.sampled_from("ab")), min_size=1, max_size=50),
       parts=st.integers(1, 7))
def test_from_log_equals_window_definition(spark, values, parts):
    rows = [(k if i % 2 else 0, T0 + dt.timedelta(minutes=i), i, v) for i, (k, v) in enumerate(values)]
    log = spark.createDataFrame(rows, "user_id long, ts timestamp_ntz, event_id long, event_type string")
    got = scd.scd2_from_log(log, "user_id", "ts", ["event_type"], ["event_id"], num_partitions=parts)
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    starts = log.withColumn("p", F.lag("event_type").over(w)).filter(
        F.col("p").isNull() | (F.col("p") != F.col("event_type")))
    ref = starts.select("user_id", "event_type", F.col("ts").alias("effective_from"),
                        F.lead("ts").over(w).alias("effective_to"))
    cols = ["user_id", "event_type", "effective_from", "effective_to"]
    assert sorted(got.select(*cols).collect()) == sorted(ref.select(*cols).collect())
