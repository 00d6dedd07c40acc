"""Every query of the library over the driver's test tables, by name.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole tables; the matching DuckDB
text is in :mod:`meterline.plans.oracle`.  Streamed entries replay the rows through Structured
Streaming to completion and return what the sink holds.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import testdata as td
from ..functions.billing import billing_key
from ..operators import (account_total_changes, account_totals, enrich_usage, in_time_order,
                         running_usage, usage_alerts, version_intervals)
from ..operators.scan import WIDTH
from ..schemas import BILLING_KEY
from ..sources.codec import decode_usage, usage_json
from ..sources.log import in_range
from .views import enrich_sql, register_views, totals_sql

TIE = "event_id"
ENRICHED_COLS = ["account", "bytesUsed", "ts", "event_id", "quota", "billingYear", "billingMonth"]


def _usage(spark, sf):
    return td.usage_from_events(spark, sf)


def _versions(spark, sf):
    return td.versions_from_events(spark, sf)


def _enriched(spark, sf, strategy="auto", width=WIDTH):
    return enrich_usage(_usage(spark, sf), _versions(spark, sf), strategy=strategy, width=width)


# The "_sliced" and "_hot_account" entries use narrow time buckets (see meterline.operators.scan), so that
# keys run across very many of them.
NARROW = timedelta(minutes=10)


def usage_scan(spark: SparkSession, sf: str) -> DataFrame:
    return _usage(spark, sf).select("account", "bytesUsed", "ts", "event_id")


def usage_json_q(spark, sf):
    return _usage(spark, sf).select(usage_json().alias("value"), "event_id")


def usage_json_roundtrip(spark, sf):
    raw = td.raw_log_from_events(spark, sf)
    return decode_usage(raw, keep=[F.col("offset").alias("event_id")])


def usage_record_time(spark, sf):
    raw = td.raw_log_from_events(spark, sf)
    return decode_usage(raw, ts_from="record", keep=[F.col("offset").alias("event_id")])


def usage_range(spark, sf):
    return in_range(usage_scan(spark, sf), td.RANGE_START + "Z", td.RANGE_END + "Z")


def account_totals_q(spark, sf):
    return account_totals(_usage(spark, sf))


def account_totals_range(spark, sf):
    return account_totals(usage_range(spark, sf))


def account_totals_changes(spark, sf):
    return account_total_changes(_usage(spark, sf), tie=TIE)


def account_totals_changes_sliced(spark, sf):
    return account_total_changes(_usage(spark, sf), tie=TIE, width=NARROW)


def account_totals_changes_hot_second(spark, sf):
    """Skew fixture: a third of the rows in one account at one time; its bucket is cut into pieces."""
    return account_total_changes(td.usage_hot_second(spark, sf), tie=TIE, piece_rows=200)


def quota_intervals(spark, sf):
    return version_intervals(_versions(spark, sf)).select("id", "quota", "valid_from", "valid_to")


def quota_intervals_sliced(spark, sf):
    return version_intervals(_versions(spark, sf), width=NARROW).select(
        "id", "quota", "valid_from", "valid_to")


def quota_enriched(spark, sf):
    return _enriched(spark, sf).select(*ENRICHED_COLS)


def quota_enriched_shuffle(spark, sf):
    """The interval join planned as a shuffle join (the choice for large version tables)."""
    return _enriched(spark, sf, "shuffle").select(*ENRICHED_COLS)


def quota_enriched_merge(spark, sf):
    return _enriched(spark, sf, "merge").select(*ENRICHED_COLS)


def quota_enriched_merge_sliced(spark, sf):
    return _enriched(spark, sf, "merge", NARROW).select(*ENRICHED_COLS)


def quota_enriched_ordered(spark, sf):
    return in_time_order(_enriched(spark, sf), TIE).select("account", "bytesUsed", "quota", "ts")


def quota_enriched_sql(spark, sf):
    return enrich_sql(spark, register_views(spark, _usage(spark, sf), _versions(spark, sf)))


def quota_enriched_dense_sql(spark, sf):
    """The SQL text where one account has as many versions as there are sign-ups, through views of coarser intervals."""
    return enrich_sql(spark, register_views(spark, td.usage_hot_account(spark, sf), td.versions_hot_account(spark, sf)))


def account_totals_sql(spark, sf):
    register_views(spark, _usage(spark, sf), _versions(spark, sf))
    return totals_sql(spark)


def billing_usage(spark, sf):
    return (_enriched(spark, sf).groupBy(*BILLING_KEY)
            .agg(F.sum("bytesUsed").alias("total"), F.count(F.lit(1)).alias("records"),
                 F.max("ts").alias("asOf")))


def running_usage_q(spark, sf):
    return running_usage(_enriched(spark, sf), TIE).select(*ENRICHED_COLS, "total")


def running_usage_sliced(spark, sf):
    return running_usage(_enriched(spark, sf), TIE, width=NARROW).select(
        *ENRICHED_COLS, "total")


ALERT_COLS = ["ts", "account", "billingYear", "billingMonth", "quota", "total", "message"]


def usage_alerts_q(spark, sf):
    return usage_alerts(_enriched(spark, sf), TIE).select(*ALERT_COLS)


def usage_alerts_sliced(spark, sf):
    return usage_alerts(_enriched(spark, sf), TIE, width=NARROW).select(*ALERT_COLS)


def usage_alerts_bucketed(spark, sf):
    """Alerts over usage stored bucketed by account: no shuffle of the usage rows at all."""
    from ..session import scratch_path
    from ..sources.tables import read_table, save_bucketed

    path = scratch_path(spark, "tables", "usage")
    name = "usage_by_account_" + path.rpartition("/")[2]  # frames of several calls don't meet
    save_bucketed(_usage(spark, sf), name, path=path)
    e = enrich_usage(read_table(spark, name), _versions(spark, sf))
    return usage_alerts(e, TIE, plan="window").select(*ALERT_COLS)


def _hot_enriched(spark, sf):
    return enrich_usage(td.usage_hot_account(spark, sf), _versions(spark, sf))


def running_usage_hot_account(spark, sf):
    """Skew fixture: one account holds a third of the rows; it is cut into its time buckets."""
    return running_usage(_hot_enriched(spark, sf), TIE, width=NARROW).select(
        *ENRICHED_COLS, "total")


def usage_alerts_hot_account(spark, sf):
    return usage_alerts(_hot_enriched(spark, sf), TIE, width=NARROW).select(*ALERT_COLS)


def quota_enriched_dense_versions(spark, sf):
    """The hot account's usage against as many versions as there are sign-ups, through interval levels."""
    return enrich_usage(td.usage_hot_account(spark, sf), td.versions_hot_account(spark, sf), "broadcast").select(
        *ENRICHED_COLS)


def usage_alerts_month_key(spark, sf):
    """Alerts keyed by account and month only: the total runs on across quota changes, each row is
    compared with the quota in force at its time."""
    return usage_alerts(_enriched(spark, sf), TIE, key=("account", "billingYear", "billingMonth")).select(
        *ALERT_COLS)


def usage_alert_messages(spark, sf):
    return usage_alerts_q(spark, sf).select("message")


def usage_alerts_long_range(spark, sf):
    e = enrich_usage(td.usage_from_orders(spark, sf), td.versions_from_customers(spark, sf))
    return usage_alerts(e, TIE).select(*ALERT_COLS)


def log_account_totals_range(spark, sf):
    """The bounded batch job over a file copy of the log (written by Spark from the events)."""
    from ..plans.jobs import batch_totals_job
    from ..session import scratch_path
    from ..sources.log import write_log

    path = scratch_path(spark, "logs", "events")
    write_log(td.raw_log_from_events(spark, sf), "files", path)
    return batch_totals_job(spark, "files", path, start_at=td.RANGE_START + "Z", end_at=td.RANGE_END + "Z")


def usage_range_micros(spark, sf):
    """A range with bounds finer than a millisecond."""
    return in_range(usage_scan(spark, sf), "2024-01-08T00:00:00.000500Z", "2024-01-15T11:59:59.999999Z")


def _published(spark, sf):
    from ..plans.jobs import publish_job
    from ..session import scratch_path

    path = scratch_path(spark, "logs", "published")
    publish_job(_usage(spark, sf), "files", path)
    return path


def usage_alerts_published(spark, sf):
    """The alert job, bounded, over the log that the publish job wrote."""
    from ..plans.jobs import alerting_job

    return alerting_job(spark, _versions(spark, sf), "files", _published(spark, sf)).select(*ALERT_COLS)


def quota_enriched_log_sql(spark, sf):
    """The SQL text over the SQL-declared log table, which reads the published log."""
    from ..sources.log import read_log
    from .views import register_log_table

    usage = register_log_table(read_log(spark, "files", path=_published(spark, sf)))
    return enrich_sql(spark, register_views(spark, usage, _versions(spark, sf)))


def quota_enriched_json_versions(spark, sf):
    """Versions read from a JSON source, checked, then joined."""
    from ..session import scratch_path
    from ..sources.versions import checked_versions, read_versions

    path = scratch_path(spark, "versions", "json")
    stamp = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    _versions(spark, sf).write.options(**stamp).json(path)
    versions = checked_versions(read_versions(spark, path, fmt="json"))
    return enrich_usage(_usage(spark, sf), versions).select(*ENRICHED_COLS)


def enriched_records(spark, sf):
    """Typed enriched records, matched by field name."""
    from ..operators import to_enriched_records

    return to_enriched_records(_enriched(spark, sf), keep=(TIE,))


def account_keys(spark, sf):
    return _enriched(spark, sf).select(billing_key().alias("key")).distinct()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from ..streaming import replays

    q = {
        "usage_scan": usage_scan,
        "usage_json": usage_json_q,
        "usage_json_roundtrip": usage_json_roundtrip,
        "usage_record_time": usage_record_time,
        "usage_range": usage_range,
        "account_totals": account_totals_q,
        "account_totals_range": account_totals_range,
        "account_totals_changes": account_totals_changes,
        "account_totals_changes_sliced": account_totals_changes_sliced,
        "account_totals_changes_hot_second": account_totals_changes_hot_second,
        "quota_intervals": quota_intervals,
        "quota_intervals_sliced": quota_intervals_sliced,
        "quota_enriched": quota_enriched,
        "quota_enriched_shuffle": quota_enriched_shuffle,
        "quota_enriched_merge": quota_enriched_merge,
        "quota_enriched_merge_sliced": quota_enriched_merge_sliced,
        "quota_enriched_ordered": quota_enriched_ordered,
        "quota_enriched_sql": quota_enriched_sql,
        "quota_enriched_dense_sql": quota_enriched_dense_sql,
        "account_totals_sql": account_totals_sql,
        "billing_usage": billing_usage,
        "running_usage": running_usage_q,
        "running_usage_sliced": running_usage_sliced,
        "usage_alerts": usage_alerts_q,
        "usage_alerts_sliced": usage_alerts_sliced,
        "usage_alerts_bucketed": usage_alerts_bucketed,
        "running_usage_hot_account": running_usage_hot_account,
        "usage_alerts_hot_account": usage_alerts_hot_account,
        "quota_enriched_dense_versions": quota_enriched_dense_versions,
        "usage_alerts_month_key": usage_alerts_month_key,
        "usage_alert_messages": usage_alert_messages,
        "usage_alerts_long_range": usage_alerts_long_range,
        "account_keys": account_keys,
        "log_account_totals_range": log_account_totals_range,
        "usage_range_micros": usage_range_micros,
        "usage_alerts_published": usage_alerts_published,
        "quota_enriched_log_sql": quota_enriched_log_sql,
        "quota_enriched_json_versions": quota_enriched_json_versions,
        "enriched_records": enriched_records,
    }
    q.update(replays.stream_queries())
    return q
