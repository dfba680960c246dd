"""Stored dimensions: rows in any order, replays, crashes, compaction."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from starloom.operators.scd import scd2_from_log
from starloom.plans.incremental import incremental_log_run
from starloom.sinks import publish as pub
from starloom.sinks.dimension_log import DimensionLog

LOG = "user_id long, ts timestamp_ntz, event_id long, event_type string"
T0 = dt.datetime(2024, 1, 1)


def events(spark, rows):
    return spark.createDataFrame([(u, None if t is None else T0 + dt.timedelta(minutes=t), i, v) for u, t, i, v in rows], LOG)


def log_at(spark, root):
    return DimensionLog(spark, str(root), events(spark, []).schema, "user_id", "ts", "event_id", ["event_type"])


def brute(rows):
    """(user, value, from, to, last seen) of the whole log read in order."""
    out = []
    for user in {r[0] for r in rows}:
        mine = sorted({r for r in rows if r[0] == user}, key=lambda r: (r[1], r[2]))
        runs = []
        for _, t, _, v in mine:
            if runs and runs[-1][0] == v:
                runs[-1][2] = t
            else:
                runs.append([v, t, t])
        for n, (v, start, seen) in enumerate(runs):
            out.append((user, v, start, runs[n + 1][1] if n + 1 < len(runs) else None, seen))
    return sorted(out, key=str)


def versions(log):
    def at(t):
        return None if t is None else int((t - T0).total_seconds() // 60)
    return sorted(((r.user_id, r.event_type, at(r.effective_from), at(r.effective_to), at(r.last_seen))
                   for r in log.versions().collect()), key=str)


@pytest.mark.parametrize("seed", range(4))
def test_batches_in_any_order_give_the_versions_of_the_whole_log(spark, scratch, seed):
    rnd = random.Random(seed)
    rows = [(0 if i % 3 == 0 else rnd.randint(1, 6), rnd.randint(0, 40), i, rnd.choice("aab")) for i in range(150)]
    rnd.shuffle(rows)
    cuts = sorted(rnd.sample(range(1, 150), 3))
    log = log_at(spark, scratch + "/dim")
    done = []
    for a, b in zip([0, *cuts], [*cuts, 150]):
        again = rnd.sample(done, min(3, len(done)))  # rows delivered twice count once
        done += rows[a:b]
        assert log.apply(events(spark, rows[a:b] + again))
        assert versions(log) == brute(done)
        if rnd.random() < 0.5:
            log.compact()
            log.vacuum()
            assert versions(log) == brute(done)
    keys = [r.version_key for r in log.versions().collect()]
    assert len(keys) == len(set(keys))


def test_late_row_splits_confirms_and_joins(spark, scratch):
    log = log_at(spark, scratch + "/dim")
    log.apply(events(spark, [(1, 10, 1, "a"), (1, 50, 2, "a"), (1, 90, 3, "b")]))
    first = {r.effective_from: r.version_key for r in log.versions().collect()}
    log.apply(events(spark, [(1, 30, 4, "b")]))  # splits a: it goes on at its confirmation
    assert [v[1:] for v in versions(log)] == [("a", 10, 30, 10), ("a", 50, 90, 50), ("b", 30, 50, 30), ("b", 90, None, 90)]
    log.apply(events(spark, [(1, 20, 5, "b")]))  # takes over the start of a version, which keeps its key
    keys = {r.effective_from: r.version_key for r in log.versions().collect()}
    assert keys[T0 + dt.timedelta(minutes=10)] == first[T0 + dt.timedelta(minutes=10)] and len(set(keys.values())) == 4
    log.apply(events(spark, [(1, 5, 6, "a")]))  # before the first version: it begins earlier
    assert versions(log)[0] == (1, "a", 5, 20, 10)
    assert {r.version_key for r in log.versions().collect() if r.effective_from == T0 + dt.timedelta(minutes=5)} == {
        first[T0 + dt.timedelta(minutes=10)]}


def test_a_batch_writes_in_proportion_to_its_changes(spark, scratch):
    log = log_at(spark, scratch + "/dim")
    log.apply(events(spark, [(u, t, 100 * u + t, "ab"[t % 2]) for u in range(200) for t in range(20)]))
    assert log.last().changed_rows == 4000
    log.apply(events(spark, [(7, 100, 1, "z"), (8, 3, 2, "z")]))
    assert log.last().changed_rows <= 6
    assert spark.read.parquet(f"{log.root}/data/batch=1").count() == log.last().changed_rows


def test_replays_rejects_and_late_modes(spark, scratch):
    log = log_at(spark, scratch + "/dim")
    batch = events(spark, [(1, 10, 1, "a"), (None, 11, 2, "a"), (2, None, 3, "a")])
    assert log.apply(batch, 4) and not log.apply(batch, 4) and not log.apply(batch, 3)
    assert sorted((r.event_id, r.reason) for r in log.rejected().collect()) == [(2, "no key"), (3, "no time")]
    log.apply(events(spark, [(1, 5, 4, "b"), (1, 10, 5, "c"), (1, 12, 6, "d"), (3, 1, 7, "x")]), 5, late="reject")
    assert sorted((r.event_id, r.reason) for r in log.rejected().filter("batch = 5").collect()) == [(4, "late"), (5, "late")]
    assert [v[1] for v in versions(log)] == ["a", "d", "x"]
    assert log.apply(events(spark, []), 6) and log.last().changed_rows == 0


def test_crash_between_data_and_commit(spark, scratch, monkeypatch):
    source = events(spark, [(1, 1, 1, "a"), (1, 2, 2, "b"), (2, 3, 3, "a")])
    log = log_at(spark, scratch + "/dim")
    assert incremental_log_run(source.filter("event_id < 2"), log)

    def crash(*args, **kwargs):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr("starloom.sinks.dimension_log.write_once", crash)
        with pytest.raises(RuntimeError):
            incremental_log_run(source, log)
    # rows were written, but neither they nor the mark are visible
    assert pub.exists(spark, f"{log.root}/data/batch=1")
    assert log.mark() == T0 + dt.timedelta(minutes=1) and [v[1] for v in versions(log)] == ["a"]
    assert incremental_log_run(source, log)
    assert log.mark() == T0 + dt.timedelta(minutes=3)
    assert versions(log) == brute([(1, 1, 1, "a"), (1, 2, 2, "b"), (2, 3, 3, "a")])
    assert not incremental_log_run(source, log) and log.last().seq == 1


def test_compaction_and_vacuum_keep_the_last_states(spark, scratch):
    log = log_at(spark, scratch + "/dim")
    rows = []
    for n in range(5):
        rows += [(u, 10 * n + u, 100 * n + u, "ab"[(n + u) % 2]) for u in range(4)]
        log.apply(events(spark, rows[-4:]))
        if n in (1, 3):
            log.compact()
    os.makedirs(f"{log.root}/data/batch=9")  # an attempt that was never committed
    log.vacuum()
    assert [n for n, _ in pub.listed(spark, f"{log.root}/data", "batch")] == [4]
    assert [n for n, _ in pub.listed(spark, f"{log.root}/base", "batch")] == [3]
    assert versions(log) == brute(rows)
    with pytest.raises(pub.PublishError):  # a second writer of the same sequence number
        log._commit(log.commits().orderBy(F.asc("seq")).collect()[-2], 5, None, None, None, 0, 0)


def test_from_log_agrees(spark, scratch):
    rnd = random.Random(1)
    rows = [(rnd.randint(0, 3), rnd.randint(0, 60), i, rnd.choice("ab")) for i in range(200)]
    got = scd2_from_log(events(spark, rows), "user_id", "ts", ["event_type"], ["event_id"])
    own = sorted(((r.user_id, r.event_type, int((r.effective_from - T0).total_seconds() // 60)) for r in got.collect()), key=str)
    assert own == sorted([v[:3] for v in brute(rows)], key=str)
