"""The five jobs end to end over a file copy of the log."""

import pytest
from pyspark.sql import functions as F

from meterline import testdata as td
from meterline.operators import account_totals, enrich_usage
from meterline.plans.jobs import (alerting_job, batch_totals_job, publish_job, quota_enrichment_job,
                                  streaming_totals_job)
from meterline.plans.views import ENRICH_SQL, register_log_table, register_views
from meterline.session import scratch_path
from meterline.sources.log import read_log
from meterline.sources.versions import checked_versions, read_versions, snapshot

from meterline.streaming.runner import BATCH, await_end, latest_per_key
from helpers import versions, write_in_event_order


@pytest.fixture(scope="module")
def log(spark, sf001):
    path = scratch_path(spark, "t-jobs-log")
    write_in_event_order(td.raw_log_from_events(spark, sf001), "timestamp", path)
    return path


def test_batch_totals_job(spark, sf001, log):
    got = batch_totals_job(spark, "files", log, start_at="2024-01-08T00:00:00Z", end_at="2024-01-15T00:00:00Z")
    u = td.usage_from_events(spark, sf001).where((F.col("ts") >= "2024-01-08") & (F.col("ts") < "2024-01-15"))
    want = account_totals(u).select("account", "totalConsumption")
    assert sorted(map(tuple, got.select("account", "totalConsumption").collect())) == sorted(map(tuple, want.collect()))


def test_streaming_totals_job(spark, sf001, log):
    out, ck = scratch_path(spark, "t-st-out"), scratch_path(spark, "t-st-ck")
    q = streaming_totals_job(spark, ck, out, "files", log, trigger={"availableNow": True}, max_per_trigger=1)
    await_end(q)
    got = latest_per_key(spark, out, ["account"]).select("account", "totalUsage")
    want = account_totals(td.usage_from_events(spark, sf001)).select("account", "totalConsumption")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_alerting_job_batch_equals_stream(spark, sf001, log):
    v = td.versions_from_events(spark, sf001)
    batch = alerting_job(spark, v, "files", log)
    out, ck = scratch_path(spark, "t-al-out"), scratch_path(spark, "t-al-ck")
    raw = read_log(spark, "files", path=log, streaming=True, max_files_per_trigger=1)
    from meterline.plans.jobs import usage_from_log
    from meterline.streaming.alerts import stream_usage_alerts
    from meterline.streaming.enrich import enrich_static
    from meterline.streaming.runner import run_to_end
    run_to_end(stream_usage_alerts(enrich_static(usage_from_log(raw, "record"), v), "log_position"), ck,
               path=out)
    cols = ["account", "billingYear", "billingMonth", "quota", "total", "message"]
    assert sorted(map(tuple, batch.select(*cols).collect())) == \
        sorted(map(tuple, spark.read.parquet(out).select(*cols).collect()))
    assert batch.count() > 0


def test_enrichment_job_stream_is_ordered(spark, sf001, log):
    vpath = scratch_path(spark, "t-en-v")
    td.versions_from_events(spark, sf001).coalesce(1).write.parquet(vpath)
    vs = read_versions(spark, vpath, streaming=True, max_files_per_trigger=1)
    out, ck = scratch_path(spark, "t-en-out"), scratch_path(spark, "t-en-ck")
    q = quota_enrichment_job(spark, vs, "files", log, streaming=True, checkpoint=ck, out=out)
    q.processAllAvailable()
    q.stop()
    df = spark.read.parquet(out)
    seq = [r["ts"] for r in df.orderBy(BATCH, "ts", "log_position").select("ts").collect()]
    assert seq == sorted(seq) and len(seq) > 0
    batch = quota_enrichment_job(spark, td.versions_from_events(spark, sf001), "files", log)
    assert batch.count() == len(seq)


def test_publish_job_batch_and_views(spark, sf001):
    path = scratch_path(spark, "t-pub")
    publish_job(td.usage_from_events(spark, sf001), "files", path)
    raw = read_log(spark, "files", path=path)
    table = register_log_table(raw)
    register_views(spark, table, td.versions_from_events(spark, sf001))
    sql = spark.sql(ENRICH_SQL)
    direct = enrich_usage(table, td.versions_from_events(spark, sf001))
    assert sql.count() == direct.count() > 0


def test_versions_reader_and_checks(spark):
    ids = spark.createDataFrame([(1,), (2,)], "n int").select(F.format_string("%06d", "n").alias("id"))
    snap = snapshot(spark, ids, 10_000_000_000, "2021-01-01T00:00:00.000Z")
    assert sorted(tuple(r) for r in snap.select("id", "quota").collect()) == [("000001", 10_000_000_000),
                                                                             ("000002", 10_000_000_000)]
    path = scratch_path(spark, "t-vers")
    snap.write.parquet(path)
    assert read_versions(spark, path).count() == 2
    dup = versions(spark, [("a", 1, "2021-01-01T00:00:00"), ("a", 2, "2021-01-01T00:00:00")])
    with pytest.raises(ValueError):
        checked_versions(dup)


def test_sql_views_bound_comparisons(spark):
    """An account of 300 versions gets a view of coarser intervals, none of which covers more than FAN versions."""
    from meterline.operators.asof import FAN
    from meterline.plans.views import enrich_sql

    start = 1_633_046_400
    v = spark.range(300).select(F.lit("a").alias("id"), F.col("id").alias("quota"), F.timestamp_seconds(start + 10 * F.col("id")).alias("ts"))
    u = spark.range(3010).select(F.lit("a").alias("account"), F.col("id").alias("bytesUsed"),
                                 F.timestamp_seconds(start - 5 + F.col("id")).alias("ts"))
    levels = register_views(spark, u, v)
    assert levels == 2 and spark.table("account_spans_1").count() == 5
    assert spark.table("account_intervals").groupBy("above").count().agg(F.max("count")).first()[0] == FAN
    got = {r["bytesUsed"]: r["quota"] for r in enrich_sql(spark, levels).collect()}
    assert got == {i: min((i - 5) // 10, 299) for i in range(5, 3010)}
    assert {r["bytesUsed"]: r["quota"] for r in spark.sql(ENRICH_SQL).collect()} == got
    assert register_views(spark, u, v.where("quota < 3")) == 1
