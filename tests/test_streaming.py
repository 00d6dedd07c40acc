"""Batch = stream, restart safety, late rows and the version-stream join."""

import os
import subprocess
import sys
import textwrap

import pytest


from meterline import testdata as td
from meterline.operators import enrich_usage, usage_alerts
from meterline.session import scratch_path
from meterline.streaming.alerts import stream_usage_alerts
from meterline.streaming.enrich import enrich_static, enrich_versioned

from meterline.streaming.runner import fresh_paths, run_to_end, start
from helpers import t, usage, versions, write_in_event_order

ALERT = ["ts", "account", "billingYear", "billingMonth", "quota", "total", "message"]


def rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_alert_stream_survives_restart(spark, sf001):
    """Stop after the first file, resume from the checkpoint: same alerts as batch, none twice."""
    u = td.usage_from_events(spark, sf001)
    v = td.versions_from_events(spark, sf001)
    batch = rows(usage_alerts(enrich_usage(u, v), "event_id"), ALERT)
    src = scratch_path(spark, "t-restart")
    n_files = write_in_event_order(u, "ts", src)
    assert n_files >= 3
    out, ck = fresh_paths(spark, "t-restart")

    def query(max_files):
        s = spark.readStream.schema(u.schema).option("maxFilesPerTrigger", max_files).parquet(src)
        return stream_usage_alerts(enrich_static(s, v), "event_id")

    q = start(query(1), ck, "append", path=out, trigger={"processingTime": "0 seconds"})
    for _ in range(600):                      # at most about two minutes
        if q.exception() is not None or (q.lastProgress is not None and q.lastProgress["batchId"] >= 0):
            break
        q.awaitTermination(0.2)
    q.stop()
    assert q.exception() is None
    first = spark.read.parquet(out).count() if os.path.exists(out) else 0
    run_to_end(query(1), ck, "append", path=out)
    got = rows(spark.read.parquet(out), ALERT)
    assert got == batch and len(got) == len(set(got)) and first <= len(got)


def test_late_file_keeps_totals_in_static_join(spark):
    """A file whose times lie before those already seen is still joined and counted."""
    v = versions(spark, [("a", 100, "2021-10-01T00:00:00")])
    src = scratch_path(spark, "t-late")
    usage(spark, [("a", 50, "2021-10-10T00:00:00", 1)]).write.parquet(src)
    out, ck = fresh_paths(spark, "t-late")
    schema = "account string, bytesUsed long, ts timestamp, event_id long"
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    run_to_end(enrich_static(s, v), ck, "append", path=out)
    usage(spark, [("a", 45, "2021-10-02T00:00:00", 2)]).write.mode("append").parquet(src)
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    run_to_end(enrich_static(s, v), ck, "append", path=out)
    assert sorted(r["event_id"] for r in spark.read.parquet(out).collect()) == [1, 2]


def _versioned(spark, files, delay="0 seconds", late="emit"):
    """files: list of (usage rows, version rows), one micro-batch each."""
    usrc, vsrc = scratch_path(spark, "t-vu"), scratch_path(spark, "t-vv")
    for urows, vrows in files:
        usage(spark, urows).coalesce(1).write.mode("append").parquet(usrc)
        versions(spark, vrows).coalesce(1).write.mode("append").parquet(vsrc)
    us = spark.readStream.schema("account string, bytesUsed long, ts timestamp, event_id long") \
        .option("maxFilesPerTrigger", 1).parquet(usrc)
    vs = spark.readStream.schema("id string, quota long, ts timestamp").option("maxFilesPerTrigger", 1).parquet(vsrc)
    out, ck = fresh_paths(spark, "t-versioned")
    run_to_end(enrich_versioned(us, vs, "event_id", delay=delay, late=late), ck, "append", path=out)
    return sorted((r["event_id"], r["quota"]) for r in spark.read.parquet(out).collect())


def test_version_stream_waits_for_watermark(spark):
    files = [
        ([("a", 1, "2021-10-01T10:00:00", 1)], [("a", 100, "2021-10-01T00:00:00")]),
        # The version at 12:00 arrives together with usage at 13:00; usage at 11:00 came earlier.
        ([("a", 1, "2021-10-01T13:00:00", 3)], [("a", 200, "2021-10-01T12:00:00")]),
        ([("a", 1, "2021-10-02T00:00:00", 4)], [("b", 5, "2021-10-02T00:00:00")]),
    ]
    assert _versioned(spark, files) == [(1, 100), (3, 200), (4, 200)]


def test_version_stream_late_usage(spark):
    files = [
        ([("a", 1, "2021-10-05T00:00:00", 1)], [("a", 100, "2021-10-01T00:00:00")]),
        ([("a", 1, "2021-10-06T00:00:00", 2)], [("a", 300, "2021-10-05T12:00:00")]),
        ([("a", 1, "2021-10-02T00:00:00", 3)], [("b", 1, "2021-10-07T00:00:00")]),  # late usage
        ([("c", 1, "2021-10-20T00:00:00", 4)], [("c", 1, "2021-10-19T00:00:00")]),  # moves the watermark on
    ]
    # The late row is joined and emitted; with late="drop" it goes, unless the delay tolerates it.
    assert _versioned(spark, files) == [(1, 100), (2, 300), (3, 100), (4, 1)]
    assert _versioned(spark, files, late="drop") == [(1, 100), (2, 300), (4, 1)]
    assert _versioned(spark, files, "5 days", "drop") == [(1, 100), (2, 300), (3, 100)]


def test_version_stream_in_another_process_zone(tmp_path):
    """State times are epoch microseconds, so a process zone other than UTC changes nothing."""
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = tmp_path / "zone.py"
    script.write_text(textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {repo!r}); sys.path.insert(0, {repo + '/tests'!r})
        from meterline.session import build_session
        from test_streaming import _versioned
        spark = build_session("local[2]", shuffle_partitions=2)
        spark.sparkContext.setLogLevel("ERROR")
        files = [([("a", 1, "2021-10-31T23:30:00", 1)], [("a", 100, "2021-10-31T23:00:00")]),
                 ([("a", 1, "2021-11-01T01:00:00", 2)], [("a", 200, "2021-11-01T00:30:00")])]
        print("RESULT", _versioned(spark, files))
    """))
    env = dict(os.environ, TZ="America/New_York")
    out = subprocess.run([sys.executable, str(script)], env=env, capture_output=True, text=True, timeout=600)
    assert "RESULT [(1, 100), (2, 200)]" in out.stdout, out.stderr[-3000:]


def test_alert_stream_clears_state_after_month(spark):
    """With clearing on, a key's state is dropped once the watermark passes month end + grace; a row
    of that month arriving later is dropped, so it cannot restart the total."""
    from datetime import timedelta
    v = versions(spark, [("a", 100, "2021-09-01T00:00:00"), ("b", 100, "2021-09-01T00:00:00")])
    src = scratch_path(spark, "t-clear")
    for chunk in ([("a", 95, "2021-10-30T00:00:00", 1)], [("b", 1, "2021-11-03T00:00:00", 2)],
                  [("a", 95, "2021-10-31T00:00:00", 3)], [("b", 1, "2021-11-04T00:00:00", 4)]):
        usage(spark, chunk).coalesce(1).write.mode("append").parquet(src)
    s = spark.readStream.schema("account string, bytesUsed long, ts timestamp, event_id long") \
        .option("maxFilesPerTrigger", 1).parquet(src)
    out, ck = fresh_paths(spark, "t-clear")
    q = stream_usage_alerts(enrich_static(s, v), "event_id", clear_after=timedelta(days=1))
    run_to_end(q, ck, "append", path=out)
    got = sorted((r["account"], r["total"], r["event_id"]) for r in spark.read.parquet(out).collect())
    assert got == [("a", 95, 1)]
    state = spark.read.format("statestore").option("path", ck).option("stateVarName", "usage").load()
    months = sorted((r["key"]["account"], r["user_map_key"]["billingMonth"]) for r in state.collect())
    assert months == [("b", 11)]


def test_clearing_keeps_late_rows_of_open_months(spark):
    from datetime import timedelta
    v = versions(spark, [("a", 100, "2021-09-01T00:00:00")])
    src = scratch_path(spark, "t-open")
    for chunk in ([("a", 50, "2021-10-10T00:00:00", 1)], [("b", 1, "2021-10-20T00:00:00", 2)],
                  [("a", 45, "2021-10-09T00:00:00", 3)]):
        usage(spark, chunk).coalesce(1).write.mode("append").parquet(src)
    s = spark.readStream.schema("account string, bytesUsed long, ts timestamp, event_id long") \
        .option("maxFilesPerTrigger", 1).parquet(src)
    out, ck = fresh_paths(spark, "t-open")
    run_to_end(stream_usage_alerts(enrich_static(s, v), "event_id", clear_after=timedelta(days=3)), ck, "append", path=out)
    assert [(r["account"], r["total"], r["event_id"]) for r in spark.read.parquet(out).collect()] == [("a", 95, 3)]


def test_clearing_after_an_emitting_join_raises(spark, tmp_path):
    from datetime import timedelta
    s = spark.readStream.schema("account string, bytesUsed long, ts timestamp, event_id long").parquet(str(tmp_path))
    v = spark.readStream.schema("id string, quota long, ts timestamp").parquet(str(tmp_path))
    with pytest.raises(ValueError, match="late='drop'"):
        stream_usage_alerts(enrich_versioned(s, v, "event_id"), "event_id", clear_after=timedelta(days=1))


def test_alert_stream_adds_in_arrival_order(spark):
    """Documents the one difference to batch: the stream adds rows in arrival order (as the reference
    does), so a file replayed out of event order can move the warning to another row."""
    v = versions(spark, [("a", 100, "2021-10-01T00:00:00")])
    src = scratch_path(spark, "t-arrival")
    usage(spark, [("a", 60, "2021-10-05T00:00:00", 2)]).coalesce(1).write.parquet(src)
    usage(spark, [("a", 35, "2021-10-02T00:00:00", 1)]).coalesce(1).write.mode("append").parquet(src)
    s = spark.readStream.schema("account string, bytesUsed long, ts timestamp, event_id long") \
        .option("maxFilesPerTrigger", 1).parquet(src)
    out, ck = fresh_paths(spark, "t-arrival")
    run_to_end(stream_usage_alerts(enrich_static(s, v), "event_id"), ck, "append", path=out)
    stream = [(r["ts"], r["total"]) for r in spark.read.parquet(out).collect()]
    batch = [(r["ts"], r["total"]) for r in usage_alerts(enrich_usage(
        usage(spark, [("a", 60, "2021-10-05T00:00:00", 2), ("a", 35, "2021-10-02T00:00:00", 1)]), v),
        "event_id").collect()]
    assert batch == [(t("2021-10-05T00:00:00"), 95)]
    assert stream == [(t("2021-10-02T00:00:00"), 95)]


def test_alert_stream_key_without_quota(spark):
    v = versions(spark, [("a", 100, "2021-10-01T00:00:00"), ("a", 200, "2021-10-05T00:00:00")])
    src = scratch_path(spark, "t-noquota")
    usage(spark, [("a", 60, "2021-10-02T00:00:00", 1)]).coalesce(1).write.parquet(src)
    usage(spark, [("a", 150, "2021-10-06T00:00:00", 2)]).coalesce(1).write.mode("append").parquet(src)
    s = spark.readStream.schema("account string, bytesUsed long, ts timestamp, event_id long") \
        .option("maxFilesPerTrigger", 1).parquet(src)
    out, ck = fresh_paths(spark, "t-noquota")
    q = stream_usage_alerts(enrich_static(s, v), "event_id", key=("account", "billingYear", "billingMonth"))
    run_to_end(q, ck, "append", path=out)
    assert [(r["total"], r["quota"]) for r in spark.read.parquet(out).collect()] == [(210, 200)]


def test_alerts_with_clearing_after_version_stream(spark, sf001):
    """Two event-time operators in one query: the version-stream join hands its watermark on
    (``event_ts``), so the alert processor's clearing timers work without dropping released rows."""
    from datetime import timedelta
    from meterline.streaming.replays import EventOrderReplay

    rp = EventOrderReplay(spark, "t-chain")
    u = rp.source(td.usage_from_events(spark, sf001), "ts")
    v = rp.source(td.versions_from_events(spark, sf001), "ts")
    q = stream_usage_alerts(enrich_versioned(u, v, "event_id", late="drop"), "event_id", clear_after=timedelta(days=1))
    out, ck = fresh_paths(spark, "t-chain")
    rp.run(lambda: run_to_end(q, ck, "append", path=out))
    batch = usage_alerts(enrich_usage(td.usage_from_events(spark, sf001), td.versions_from_events(spark, sf001)),
                         "event_id")
    assert rows(spark.read.parquet(out), ALERT) == rows(batch, ALERT)


def test_streams_keep_large_quotas_exact(spark):
    """Quotas beyond 2**53 next to a null quota: both processors keep them exact."""
    big = 2**60 + 1
    v = versions(spark, [("a", big, "2021-10-01T00:00:00"), ("b", None, "2021-10-01T00:00:00")])
    rows_u = [("a", big, "2021-10-02T00:00:00", 1), ("b", 5, "2021-10-02T00:00:00", 2),
              ("a", 1, "2021-10-03T00:00:00", 3)]
    files = [(rows_u, [("a", big, "2021-10-01T00:00:00"), ("b", None, "2021-10-01T00:00:00")]),
             ([("c", 1, "2021-10-09T00:00:00", 4)], [("c", 1, "2021-10-08T00:00:00")])]
    assert _versioned(spark, files)[:3] == [(1, big), (2, None), (3, big)]
    src = scratch_path(spark, "t-big")
    usage(spark, rows_u).coalesce(1).write.parquet(src)
    s = spark.readStream.schema("account string, bytesUsed long, ts timestamp, event_id long").parquet(src)
    out, ck = fresh_paths(spark, "t-big")
    run_to_end(stream_usage_alerts(enrich_static(s, v), "event_id"), ck, "append", path=out)
    assert [(r["quota"], r["total"]) for r in spark.read.parquet(out).collect()] == [(big, big)]


def test_late_file_still_counts_in_stream_totals(spark):
    """The totals stream has no watermark: a file with times before those already seen is counted."""
    from meterline.streaming.runner import batch_folder_writer, latest_per_key
    from meterline.streaming.totals import stream_account_totals
    src = scratch_path(spark, "t-late-totals")
    schema = "account string, bytesUsed long, ts timestamp, event_id long"
    out, ck = fresh_paths(spark, "t-late-totals")
    for chunk in ([("a", 10, "2021-10-10T00:00:00", 1)], [("a", 5, "2021-10-02T00:00:00", 2)]):
        usage(spark, chunk).coalesce(1).write.mode("append").parquet(src)
        s = spark.readStream.schema(schema).parquet(src)
        run_to_end(stream_account_totals(s), ck, "update", sink=batch_folder_writer(out))
    got = [tuple(r) for r in latest_per_key(spark, out, ["account"]).collect()]
    assert got == [("a", 15, t("2021-10-10T00:00:00"))]


def test_version_table_read_as_stream_joins_like_batch(spark, sf001):
    """A whole version table read once as a stream (all versions in the first batch), usage replayed
    week by week: the state-based join gives the batch result without any broadcast."""
    from meterline.sources.versions import read_versions
    from meterline.streaming.replays import EventOrderReplay
    vpath = scratch_path(spark, "t-vtable")
    td.versions_from_events(spark, sf001).write.parquet(vpath)
    rp = EventOrderReplay(spark, "t-vtable-usage")
    u = rp.source(td.usage_from_events(spark, sf001), "ts")
    e = enrich_versioned(u, read_versions(spark, vpath, streaming=True), "event_id")
    out, ck = fresh_paths(spark, "t-vtable")
    rp.run(lambda: run_to_end(e, ck, "append", path=out))
    cols = ["account", "bytesUsed", "ts", "event_id", "quota"]
    batch = enrich_usage(td.usage_from_events(spark, sf001), td.versions_from_events(spark, sf001))
    assert rows(spark.read.parquet(out), cols) == rows(batch, cols)
