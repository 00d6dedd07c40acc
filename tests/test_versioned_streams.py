"""Version streams: completeness of both sides, calendar queue, bounded versions, corrections, late usage and
clearing, ordered output, null amounts."""

from datetime import timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from meterline.operators import account_total_changes, enrich_usage, usage_alerts
from meterline.plans.jobs import alerting_job, quota_enrichment_job
from meterline.session import scratch_path
from meterline.sources.log import write_log
from meterline.sources.codec import encode_usage
from meterline.streaming import enrich
from meterline.streaming.enrich import enrich_changes, enrich_static, enrich_versioned, folded
from meterline.streaming.alerts import stream_usage_alerts, stream_versioned_alerts
from meterline.streaming.keyed_state import Calendar, VersionStore, packed
from meterline.streaming.runner import BATCH, await_end, fresh_paths, run_to_end
from meterline.streaming.totals import stream_total_changes
from helpers import USAGE_DDL, VERSION_DDL, usage, versions

DAY = 86_400_000_000


# ---- state, on a stand-in that counts calls

class Value:
    def __init__(self, handle):
        self.value, self.handle = None, handle

    def get(self):
        self.handle.calls += 1
        return self.value

    def update(self, value):
        self.handle.calls += 1
        self.value = value

    def clear(self):
        self.value = None


class Map:
    def __init__(self, handle):
        self.rows, self.handle = {}, handle

    def getValue(self, key):
        self.handle.calls += 1
        return self.rows.get(key)

    def updateValue(self, key, value):
        self.handle.calls += 1
        self.rows[key] = value

    def removeKey(self, key):
        self.handle.calls += 1
        self.rows.pop(key, None)


class Handle:
    def __init__(self):
        self.calls, self.timers = 0, []

    def getMapState(self, *_):
        return Map(self)

    def getValueState(self, *_):
        return Value(self)

    def registerTimer(self, ms):
        self.timers.append(ms)


def test_release_does_not_depend_on_what_waits():
    costs = []
    for waiting in (1, 10, 500):
        handle = Handle()
        queue = Calendar(handle)
        queue.add(np.array([[d * DAY + 7_000_000, d, 0] for d in range(waiting)]))
        handle.calls = 0
        got = queue.release(min(handle.timers), min(handle.timers))
        assert got.tolist() == [[7_000_000, 0, 0]]
        costs.append(handle.calls)
    assert costs[0] == costs[1] == costs[2]


def test_calendar_releases_part_of_a_bucket():
    handle = Handle()
    queue = Calendar(handle)
    queue.add(np.array([[5_000_000, 1, 2], [5_000_000, 1, 1], [9_000_000, 1, 3]]))
    queue.add(np.array([[4_000_000, 1, 4]]))
    assert handle.timers == [5000, 4000]
    assert queue.release(4000, 5000)[:, 2].tolist() == [4, 1, 2]
    assert handle.timers[-1] == 9000 and queue.release(5000, 5000).tolist() == []
    assert queue.release(9000, 9000)[:, 2].tolist() == [3] and not queue.parts.rows and not queue.rows.rows


def test_lookup_reads_its_buckets_only():
    handle = Handle()
    store = VersionStore(handle)
    store.add(np.array([[i * DAY // 4, i, i % 2] for i in range(10_000)]))
    handle.calls = 0
    times = np.array([DAY // 8, 5 * DAY + 1, 5 * DAY + DAY // 2])
    found, version = store.in_force(times)
    assert found.all() and version[:, 1].tolist() == [0, 20, 22] and handle.calls <= 4
    store.prune(2400 * DAY + 5)
    assert len(store.rows.rows) == 100 and store.in_force(np.array([2400 * DAY + 5]))[1][0, 1] == 9600
    assert store.second() == 2400 * DAY + DAY // 4
    assert not store.in_force(np.array([10 * DAY]))[0].any()


def test_versions_of_equal_time_and_before_the_first_of_a_day():
    store = VersionStore(Handle())
    store.add(np.array([[10, 1, 0], [3 * DAY + 9, 2, 0]]))
    store.add(np.array([[10, 5, 0]]))
    found, version = store.in_force(np.array([9, 10, 3 * DAY, 3 * DAY + 9]))
    assert found.tolist() == [False, True, True, True] and version[1:, 1].tolist() == [5, 5, 2]
    assert store.around(2 * DAY, 4 * DAY)[:, 1].tolist() == [5, 2]


def random_history(seed):
    rng = np.random.default_rng(seed)
    n, m = 60, 25
    used = np.stack([rng.integers(0, 12 * DAY, n) // DAY * DAY // 3, rng.integers(0, 9, n), np.arange(n)], axis=1)
    vers = np.unique(rng.integers(0, 12 * DAY, m) // DAY * DAY // 3)
    rng.shuffle(vers)
    vers = np.stack([vers, rng.integers(0, 4, len(vers)), np.zeros(len(vers), int)], axis=1)
    return rng, used, vers


@pytest.mark.parametrize("seed", range(5))
def test_retractions_fold_to_the_batch_join(seed):
    """Any order of arrival, any cut into calls."""
    rng, used, vers = random_history(seed)
    proc = enrich.RetractingJoinProcessor("tie", None)
    proc.init(Handle())
    left = {}
    for part in np.array_split(rng.permutation(len(used) + len(vers)), 9):
        frame = pd.DataFrame([{"side": 1, "ts_us": used[i][0], "bytesUsed": used[i][1], "tie": used[i][2], "quota": 0,
                               "quota_null": False} if i < len(used) else
                              {"side": 0, "ts_us": vers[i - len(used)][0], "bytesUsed": 0, "tie": 0,
                               "quota": vers[i - len(used)][1], "quota_null": False} for i in part])
        for out in proc.handleInputRows(("a",), iter([frame.iloc[:3], frame.iloc[3:]]), None):
            for r in out.sort_values("step", kind="stable").itertuples():
                if r.op == "-U":
                    assert left.pop(r.tie) == r.quota
                else:
                    assert r.tie not in left
                    left[r.tie] = r.quota
    want = {}
    for ts, _, tie in used.tolist():
        before = [v for v in vers.tolist() if v[0] <= ts]
        if before:
            want[tie] = max(before)[1]
    assert left == want


# ---- accounts that share a key

def test_versions_of_accounts_that_share_a_key():
    rng = np.random.default_rng(3)
    store, given = VersionStore(Handle(), columns=4), {}
    for _ in range(6):
        new = np.stack([rng.integers(0, 40, 30) * DAY // 3, rng.integers(0, 99, 30), np.zeros(30, int), rng.integers(0, 7, 30)], axis=1)
        store.add(new)
        for ts, quota, _, code in new.tolist():
            given[code, ts] = quota
    times, codes = rng.integers(-DAY, 16 * DAY, 500), rng.integers(0, 8, 500)
    for low in (None, 5 * DAY):
        if low is not None:
            store.prune(low)
            times = np.maximum(times, low)
        found, version = store.in_force(times, codes)
        for t, c, f, v in zip(times.tolist(), codes.tolist(), found.tolist(), version.tolist()):
            best = max((ts for code, ts in given if code == c and ts <= t), default=None)
            assert f == (best is not None) and (not f or v[:2] == [best, given[c, best]])
    assert store.second() == min(sorted(ts for code, ts in given if code == c and ts > 5 * DAY)[0] for c in range(7))


def test_a_call_serves_all_accounts_of_its_key():
    """State calls depend on buckets, not on the number of accounts."""
    calls = []
    for accounts in (5, 500):
        proc, handle = enrich.RetractingJoinProcessor("tie", None, column="key_id"), Handle()
        proc.init(handle)
        side = [1, 0] * accounts
        frame = pd.DataFrame({"key_id": [f"k{i // 2}" for i in range(2 * accounts)], "side": side, "ts_us": [7 if x else 5 for x in side],
                              "bytesUsed": 1, "tie": range(2 * accounts), "quota": range(2 * accounts), "quota_null": False})
        out = pd.concat(list(proc.handleInputRows((0,), iter([frame]), None)))
        assert {(r.account, r.quota) for r in out.itertuples()} == {(f"k{i}", 2 * i + 1) for i in range(accounts)}
        calls.append(handle.calls)
    assert calls[0] == calls[1]


@pytest.mark.parametrize("groups", [1, 3])
def test_streams_of_grouped_accounts(spark, groups):
    v = [(a, 100 + i, "2021-10-01T00:00:00") for i, a in enumerate("abc")] + [("b", 200, "2021-10-04T00:00:00")]
    rows = [(a, 60, f"2021-10-0{d}T0{i}:00:00", 10 * d + i) for d in (2, 3, 5, 6) for i, a in enumerate("abc")]
    usage(spark, rows).coalesce(1).write.parquet(src := scratch_path(spark, "t-grouped"))
    s, table = spark.readStream.schema(USAGE_DDL).parquet(src), versions(spark, v)
    want = usage_alerts(enrich_usage(usage(spark, rows), table), "event_id")
    cols = ["ts", "account", "quota", "total"]
    out, _ = end(stream_usage_alerts(enrich_static(s, table), "event_id", clear_after=timedelta(days=3), account_groups=groups),
                 "t-grouped", spark)
    assert sorted(map(tuple, out.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))
    changes = ["op", "account", "totalUsage", "asOf", "event_id"]
    out, _ = end(stream_total_changes(s, "event_id", account_groups=groups), "t-grouped-totals", spark)
    want_changes = account_total_changes(usage(spark, rows), "event_id")
    assert sorted(map(tuple, out.select(*changes).collect())) == sorted(map(tuple, want_changes.select(*changes).collect()))
    done = ([(None, None, "2021-10-09T00:00:00", None)], [("z", 1, "2021-10-01T00:00:00")])
    for late in ("emit", "drop"):
        u, vs = streams(spark, [(rows, v), done])
        out, _ = end(stream_versioned_alerts(u, vs, "event_id", late=late, account_groups=groups), "t-grouped-v", spark)
        assert sorted(map(tuple, out.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))


# ---- streams

def streams(spark, files, version_first=()):
    """One micro-batch per pair of (usage rows, version rows); rows of key None are heartbeats."""
    usrc, vsrc = scratch_path(spark, "t-vs-u"), scratch_path(spark, "t-vs-v")
    for urows, vrows in files:
        usage(spark, urows).coalesce(1).write.mode("append").parquet(usrc)
        versions(spark, vrows).coalesce(1).write.mode("append").parquet(vsrc)
    u = spark.readStream.schema(USAGE_DDL).option("maxFilesPerTrigger", 1).parquet(usrc)
    v = spark.readStream.schema(VERSION_DDL).option("maxFilesPerTrigger", 1).parquet(vsrc)
    return u, v


def end(df, name, spark):
    out, ck = fresh_paths(spark, name)
    run_to_end(df, ck, "append", path=out)
    return spark.read.parquet(out), ck


LAGGING = [
    ([("a", 1, "2021-10-05T00:00:00", 1), ("a", 1, "2021-10-07T00:00:00", 2)], [("a", 100, "2021-10-01T00:00:00")]),
    ([("a", 1, "2021-10-12T00:00:00", 3)], [("b", 1, "2021-10-02T00:00:00")]),
    ([(None, None, "2021-10-20T00:00:00", None)], [("a", 200, "2021-10-06T00:00:00"), (None, None, "2021-10-07T00:00:00")]),
    ([(None, None, "2021-10-21T00:00:00", None)], [("a", 300, "2021-10-08T00:00:00")]),
]


def test_versions_that_lag_are_waited_for(spark):
    done = ([(None, None, "2021-10-22T00:00:00", None)], [(None, None, "9999-01-01T00:00:00")])
    for files, want in ((LAGGING, [(1, 100), (2, 200)]), (LAGGING + [done], [(1, 100), (2, 200), (3, 300)])):
        u, v = streams(spark, files)
        out, _ = end(enrich_versioned(u, v, "event_id", wait_for="both"), "t-lagging", spark)
        assert sorted((r["event_id"], r["quota"]) for r in out.collect()) == want
    u, v = streams(spark, LAGGING)      # waiting for usage only, the late versions are missed
    out, _ = end(enrich_versioned(u, v, "event_id"), "t-lagging", spark)
    assert sorted((r["event_id"], r["quota"]) for r in out.collect()) == [(1, 100), (2, 100), (3, 200)]


def test_waiting_for_both_needs_the_minimum_policy(spark):
    u, v = streams(spark, LAGGING[:1])
    spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "max")
    try:
        with pytest.raises(ValueError, match="min"):
            enrich_versioned(u, v, "event_id", wait_for="both")
    finally:
        spark.conf.unset("spark.sql.streaming.multipleWatermarkPolicy")
    with pytest.raises(ValueError, match="wait_for"):
        enrich_versioned(u, v, "event_id", wait_for="x")


def test_horizon_bounds_versions_of_idle_accounts(spark):
    files = [([("a", 1, "2021-10-02T00:00:00", 1)], [("a", i, f"2021-10-{i:02d}T00:00:00") for i in range(1, 9)]),
             ([("b", 1, "2021-10-20T00:00:00", 2)], [("b", 7, "2021-10-19T00:00:00")]),
             ([("a", 1, "2021-10-08T12:00:00", 3), ("a", 1, "2021-10-17T00:00:00", 4)], [("b", 8, "2021-10-20T12:00:00")])]
    u, v = streams(spark, files)
    out, ck = end(enrich_versioned(u, v, "event_id", horizon=timedelta(days=5)), "t-horizon", spark)
    # Row 3 is further behind than the horizon; row 4 isn't, and its version is still there.
    assert sorted((r["event_id"], r["quota"]) for r in out.collect()) == [(1, 2), (2, 7), (4, 8)]
    state = spark.read.format("statestore").option("path", ck).option("stateVarName", "versions").load()
    kept = [(r["key"]["key_id"], len(r["user_map_value"]["rows"]) // 24) for r in state.collect()]
    assert sorted(k for k, _ in kept if k == "a") == ["a"] and all(n == 1 for _, n in kept)


def test_late_usage_of_open_months_counts_with_clearing(spark):
    files = [([("a", 50, "2021-10-10T00:00:00", 1)], [("a", 100, "2021-09-01T00:00:00")]),
             ([("b", 1, "2021-10-20T00:00:00", 2)], [("b", 100, "2021-09-01T00:00:00")]),
             ([("a", 45, "2021-10-09T00:00:00", 3)], [("c", 1, "2021-09-01T00:00:00")]),
             ([("b", 1, "2021-11-05T00:00:00", 4)], [("d", 1, "2021-09-01T00:00:00")]),
             ([("a", 99, "2021-10-09T00:00:00", 5)], [("e", 1, "2021-09-01T00:00:00")])]
    u, v = streams(spark, files)
    out, ck = end(stream_versioned_alerts(u, v, "event_id", clear_after=timedelta(days=3)), "t-late-clear", spark)
    assert [(r["account"], r["total"], r["event_id"]) for r in out.collect()] == [("a", 95, 3)]
    state = spark.read.format("statestore").option("path", ck).option("stateVarName", "usage").load()
    assert [(r["key"]["key_id"], r["user_map_key"]["billingMonth"]) for r in state.collect()] == [("b", 11)]


def test_a_watermark_that_jumps_loses_nothing(spark):
    """Usage that waits is counted by its own time, even if the watermark passes its month's end at once."""
    files = [([("a", 95, "2021-10-10T00:00:00", 1), ("b", 1, "2021-12-10T00:00:00", 2)], [("a", 100, "2021-09-01T00:00:00")]),
             ([("b", 1, "2021-12-11T00:00:00", 3)], [("b", 100, "2021-09-01T00:00:00")])]
    u, v = streams(spark, files)
    out, _ = end(stream_versioned_alerts(u, v, "event_id", clear_after=timedelta(days=1)), "t-jump", spark)
    assert [(r["account"], r["total"]) for r in out.collect()] == [("a", 95)]


def published(spark, files):
    path = scratch_path(spark, "t-vs-log")
    for urows, _ in files:
        write_log(encode_usage(usage(spark, urows).coalesce(1), "input"), "files", path)
    return path


def test_alerting_job_with_versions_late_usage_and_clearing(spark):
    files = [([("a", 50, "2021-10-10T00:00:00", 1)], []), ([("a", 45, "2021-10-09T00:00:00", 2)], [])]
    table = versions(spark, [("a", 100, "2021-09-01T00:00:00")])
    vsrc = scratch_path(spark, "t-vs-job")
    table.write.parquet(vsrc)
    log = published(spark, files)
    for clear_after in (None, timedelta(days=3)):
        out, ck = fresh_paths(spark, "t-vs-job")
        stream = spark.readStream.schema(VERSION_DDL).parquet(vsrc)
        await_end(alerting_job(spark, stream, "files", log, streaming=True, checkpoint=ck, out=out, clear_after=clear_after,
                               max_per_trigger=1, trigger={"availableNow": True}))
        got = [(r["account"], r["total"]) for r in spark.read.parquet(out).collect()]
        assert got == [("a", 95)] == [(r["account"], r["total"]) for r in alerting_job(spark, table, "files", log).collect()]


def test_enrichment_job_is_ordered_and_complete(spark):
    files = [([("a", 1, "2021-10-10T00:00:00", 1)], []), ([("a", 2, "2021-10-09T00:00:00", 2)], []),
             ([("a", 3, "2021-10-12T00:00:00", 3)], []), ([("a", 4, "2021-10-11T00:00:00", 4)], [])]
    table = versions(spark, [("a", 100, "2021-09-01T00:00:00")])
    vsrc = scratch_path(spark, "t-vs-order")
    table.write.parquet(vsrc)
    out, ck = fresh_paths(spark, "t-vs-order")
    await_end(quota_enrichment_job(spark, spark.readStream.schema(VERSION_DDL).parquet(vsrc), "files", published(spark, files),
                                   streaming=True, checkpoint=ck, out=out, max_per_trigger=1, trigger={"availableNow": True}))
    main = [r["bytesUsed"] for r in spark.read.parquet(out).orderBy(BATCH, "ts").collect()]
    late = [r["bytesUsed"] for r in spark.read.parquet(out + "_late").collect()]
    assert main == [1, 3] and sorted(late) == [2, 4]


def test_changes_stream_corrects_usage(spark):
    files = [([("a", 1, "2021-10-05T00:00:00", 1), ("a", None, "2021-10-08T00:00:00", 2)], [("a", 100, "2021-10-01T00:00:00")]),
             ([("a", 1, "2021-10-12T00:00:00", 3)], [("a", None, "2021-10-06T00:00:00")])]
    u, v = streams(spark, files)
    out, _ = end(enrich_changes(u, v, "event_id"), "t-changes", spark)
    assert sorted((r["op"], r["event_id"], r["quota"]) for r in out.collect() if r["event_id"] == 2) == [
        ("+I", 2, 100), ("+U", 2, None), ("-U", 2, 100)]
    assert sorted((r["event_id"], r["quota"], r["bytesUsed"]) for r in folded(out).collect()) == [
        (1, 100, 1), (2, None, 0), (3, None, 1)]


# ---- null amounts count as 0

NULLS = [("a", 5, "2021-10-02T00:00:00", 1), ("a", None, "2021-10-03T00:00:00", 2), ("a", 90, "2021-10-04T00:00:00", 3)]


def test_null_amounts_in_streams(spark):
    src = scratch_path(spark, "t-nulls")
    usage(spark, NULLS).coalesce(1).write.parquet(src)
    v = versions(spark, [("a", 100, "2021-10-01T00:00:00")])
    s = spark.readStream.schema(USAGE_DDL).parquet(src)
    out, _ = end(stream_total_changes(s, "event_id"), "t-nulls", spark)
    want = account_total_changes(usage(spark, NULLS), "event_id")
    cols = ["op", "account", "totalUsage", "asOf", "event_id"]
    assert sorted(map(tuple, out.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))
    assert sorted(r["totalUsage"] for r in out.collect()) == [5, 5, 5, 5, 95]
    out, _ = end(stream_usage_alerts(enrich_static(s, v), "event_id"), "t-nulls-alerts", spark)
    batch = usage_alerts(enrich_usage(usage(spark, NULLS), v), "event_id")
    assert [(r["total"], r["event_id"]) for r in out.collect()] == [(95, 3)] and [r["total"] for r in batch.collect()] == [95]


def test_null_amounts_after_a_version_stream(spark):
    files = [(NULLS, [("a", 100, "2021-10-01T00:00:00")]),
             ([(None, None, "2021-10-09T00:00:00", None)], [("z", 1, "2021-10-01T00:00:00")])]
    u, v = streams(spark, files)
    out, _ = end(enrich_versioned(u, v, "event_id"), "t-nulls-v", spark)
    assert sorted((r["event_id"], r["bytesUsed"], r["quota"]) for r in out.collect()) == [(1, 5, 100), (2, 0, 100), (3, 90, 100)]


def test_a_stream_takes_over_from_a_batch(spark):
    """Totals, flags and null quotas go on; a key that has warned in the batch doesn't warn again."""
    from meterline.operators.alerts import billing_state

    v = versions(spark, [("a", 100, "2021-10-01T00:00:00"), ("b", 100, "2021-10-01T00:00:00"), ("c", None, "2021-10-01T00:00:00")])
    old = usage(spark, [("a", 60, "2021-10-02T00:00:00", 1), ("b", 95, "2021-10-02T00:00:00", 2), ("c", 9, "2021-10-02T00:00:00", 3),
                        ("a", None, "2021-10-02T00:00:00", 4)])
    state = billing_state(enrich_usage(old, v), "event_id")
    assert sorted((r["account"], r["quota"], r["total"], r["alerted"]) for r in state.collect()) == [
        ("a", 100, 60, False), ("b", 100, 95, True), ("c", None, 9, False)]
    src = scratch_path(spark, "t-handover")
    new = [("a", 35, "2021-10-03T00:00:00", 5), ("b", 50, "2021-10-03T00:00:00", 6), ("c", 1, "2021-10-03T00:00:00", 7)]
    usage(spark, new).coalesce(1).write.parquet(src)
    s = spark.readStream.schema(USAGE_DDL).parquet(src)
    out, ck = end(stream_usage_alerts(enrich_static(s, v), "event_id", initial=state), "t-handover", spark)
    assert [(r["account"], r["total"]) for r in out.collect()] == [("a", 95)]
    kept = spark.read.format("statestore").option("path", ck).option("stateVarName", "usage").load()
    assert sorted((r["key"]["account"], r["user_map_value"]["total"]) for r in kept.collect()) == [("a", 95), ("b", 145), ("c", 10)]


def test_takes_over_from_a_batch_of_large_joins(spark):
    """The batch's plan has joins by sort and merge; it is no part of the stream's plan, restarts included."""
    from meterline.operators.alerts import billing_state

    v = versions(spark, [(a, 100, "2021-10-01T00:00:00") for a in "abc"])
    old = usage(spark, [("a", 60, "2021-10-02T00:00:00", 1), ("b", 95, "2021-10-02T00:00:00", 2)])
    src = scratch_path(spark, "t-handover-large")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        state = billing_state(enrich_usage(old, v, strategy="shuffle"), "event_id")
        usage(spark, []).write.parquet(src)
        s = spark.readStream.schema(USAGE_DDL).parquet(src)
        q = stream_usage_alerts(enrich_static(s, v, max_broadcast_rows=0), "event_id", initial=state, account_groups=2)
        out, ck = fresh_paths(spark, "t-handover-large")
        for rows in ([("a", 20, "2021-10-03T00:00:00", 3)], [("a", 20, "2021-10-04T00:00:00", 4), ("b", 9, "2021-10-04T00:00:00", 5)]):
            usage(spark, rows).coalesce(1).write.mode("append").parquet(src)
            run_to_end(q, ck, "append", path=out)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [(r["account"], r["total"]) for r in spark.read.parquet(out).collect()] == [("a", 100)]
