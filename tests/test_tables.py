import pytest

from meterline import testdata as td
from meterline.operators import account_totals, enrich_usage, usage_alerts
from meterline.session import scratch_path
from meterline.sources.tables import read_table, save_bucketed


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.strip() for line in plan.splitlines() if "Exchange" in line]


def test_bucketed_usage_needs_no_shuffle(spark, sf001):
    u = td.usage_from_events(spark, sf001)
    save_bucketed(u, "usage_bucketed", buckets=4, path=scratch_path(spark, "t-bucketed"))
    t = read_table(spark, "usage_bucketed")
    assert exchanges(account_totals(t)) == []
    alerts = usage_alerts(enrich_usage(t, td.versions_from_events(spark, sf001)), "event_id", plan="window")
    # Only the broadcast of the version intervals (and the shuffle that builds them) remain.
    assert all("Broadcast" in e or "hashpartitioning(id" in e for e in exchanges(alerts)), exchanges(alerts)
    want = usage_alerts(enrich_usage(u, td.versions_from_events(spark, sf001)), "event_id")
    assert sorted(map(tuple, alerts.collect())) == sorted(map(tuple, want.collect()))


def test_a_bucket_is_not_one_file_per_task(spark, sf001):
    u = td.usage_from_events(spark, sf001).repartition(16)
    path = scratch_path(spark, "t-bucketed-files")
    save_bucketed(u, "usage_bucketed_files", buckets=4, path=path)
    t = read_table(spark, "usage_bucketed_files")
    assert 1 < len(t.inputFiles()) <= 4 and t.count() == u.count()  # a bucket may be empty


def test_only_paths_below_the_shared_folder_are_removed(spark, tmp_path):
    from meterline.session import remove_path, scratch_path

    path = scratch_path(spark, "t-remove")
    spark.range(3).write.parquet(path)
    remove_path(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    with pytest.raises(ValueError):
        remove_path(spark, str(tmp_path))
