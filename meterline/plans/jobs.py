"""The five jobs of the application, as functions with keyword parameters (topic and brokers default to
``input`` and ``localhost:9092``).

* :func:`publish_job` — usage rows → JSON log records (null key, record time = event time).
* :func:`batch_totals_job` — one bounded range of the log → total and last time per account.
* :func:`streaming_totals_job` — the same aggregate, continuously, from the earliest offset.
* :func:`quota_enrichment_job` — usage joined to the quota in force, in event-time order.
* :func:`alerting_job` — running usage per account/month/quota, one warning above 90 %.

Batch forms return DataFrames; streaming forms start a query with a checkpoint and return it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import account_totals, enrich_usage, enriched_view, in_time_order, usage_alerts
from ..schemas import ALERT_RATIO, DEFAULT_BROKERS, DEFAULT_TOPIC
from ..sources.codec import decode_usage, encode_usage
from ..sources.log import in_range, kafka_columns, read_log, write_log
from ..streaming.alerts import stream_usage_alerts, stream_versioned_alerts
from ..streaming.enrich import enrich_static, enrich_versioned
from ..streaming.keyed_state import GROUPS
from ..streaming.ordered import ordered_batch_writer
from ..streaming.runner import batch_folder_writer, start
from ..streaming.totals import stream_account_totals

# The bounded job's range (its end leaves out the month's last millisecond, as given).
MONTH_START = "2021-10-01T00:00:00.000Z"
MONTH_END = "2021-10-31T23:59:59.999Z"
LOG_POSITION = "log_position"


def log_position() -> F.Column:
    """A long that orders records of equal time by their place in the log: partition, then offset; null in
    a file log that was published without them."""
    return F.col("partition").cast("long") * F.lit(1 << 40) + F.col("offset")


def usage_from_log(raw: DataFrame, ts_from: str = "body") -> DataFrame:
    """Decoded usage with a tie column that is never null: the log position, or else the bytes used (rows
    equal in account, time and bytes can change places without changing any result)."""
    usage = decode_usage(raw, ts_from=ts_from, keep=[log_position().alias(LOG_POSITION)])
    return usage.withColumn(LOG_POSITION, F.coalesce(LOG_POSITION, "bytesUsed"))


def publish_job(usage: DataFrame, kind: str = "files", path: str | None = None, topic: str = DEFAULT_TOPIC,
                brokers: str = DEFAULT_BROKERS, checkpoint: str | None = None,
                trigger: dict | None = None, record_id: str | None = None) -> StreamingQuery | None:
    """Write usage rows to the log; a column ``record_id`` gives the records ids, by which a reader finds those that an
    at-least-once sink wrote twice (:func:`~meterline.sources.codec.unique_records`).  A stream goes through the file sink (exactly once by its commit
    log and the checkpoint, every 5 seconds by default) or Kafka (at least once); a batch is written once."""
    raw = encode_usage(usage, topic, record_id=record_id)
    if not usage.isStreaming:
        write_log(raw, kind, path, brokers)
        return None
    trigger = trigger or {"processingTime": "5 seconds"}
    if kind == "kafka":
        q = (raw.select(*kafka_columns(raw)).writeStream.format("kafka")
                .option("kafka.bootstrap.servers", brokers).option("checkpointLocation", checkpoint)
                .trigger(**trigger).start())
        return q
    return start(raw, checkpoint, "append", path=path, trigger=trigger)


def batch_totals_job(spark: SparkSession, kind: str = "kafka", path: str | None = None,
                     topic: str = DEFAULT_TOPIC, brokers: str = DEFAULT_BROKERS,
                     start_at: str = MONTH_START, end_at: str = MONTH_END) -> DataFrame:
    """``account, totalConsumption, asOf`` over the records with ``start_at <= ts < end_at``.

    The source is bounded by record time and the same half-open range is then applied to every row.  Over
    files that is exact.  Kafka turns times into one offset per partition, so a record that was appended
    out of time order beyond the end offset is not read.
    """
    raw = read_log(spark, kind, path, topic, brokers, start=start_at, end=end_at)
    return account_totals(in_range(decode_usage(raw), start_at, end_at))


def streaming_totals_job(spark: SparkSession, checkpoint: str, out: str, kind: str = "kafka",
                         path: str | None = None, topic: str = DEFAULT_TOPIC, brokers: str = DEFAULT_BROKERS,
                         trigger: dict | None = None, max_per_trigger: int | None = None) -> StreamingQuery:
    """``account, totalUsage, asOf`` kept up to date from the earliest record; every micro-batch's
    changed accounts go to ``out/batch_id=N`` (read back with ``runner.latest_per_key``)."""
    raw = read_log(spark, kind, path, topic, brokers, streaming=True, starting="earliest",
                   max_files_per_trigger=max_per_trigger, max_offsets_per_trigger=max_per_trigger)
    totals = stream_account_totals(decode_usage(raw))
    return start(totals, checkpoint, "update", sink=batch_folder_writer(out), trigger=trigger)


def quota_enrichment_job(spark: SparkSession, versions: DataFrame, kind: str = "kafka", path: str | None = None,
                         topic: str = DEFAULT_TOPIC, brokers: str = DEFAULT_BROKERS, streaming: bool = False,
                         checkpoint: str | None = None, out: str | None = None,
                         delay: str = "0 seconds", late: str | None = None, trigger: dict | None = None,
                         max_per_trigger: int | None = None, wait_for: str = "usage",
                         late_out: str | None = None) -> DataFrame | StreamingQuery:
    """``account, bytesUsed, quota, ts`` in event-time order, event time from the log record.

    Batch: as-of join, then a global sort.  Stream: with a static version table a stream–static join
    (order within each micro-batch only); with a version stream the watermark-released join, whose batches in
    ``out`` concatenate into one ordered sequence (see :mod:`meterline.streaming.ordered`).  Usage behind the watermark
    is joined too, but can't have a place in that sequence: it goes to ``late_out`` (by default ``out`` with ``_late``
    behind it).  With ``late="drop"`` Spark drops it.  ``wait_for="both"`` waits for versions too (see
    :mod:`meterline.streaming.enrich`).
    """
    if not streaming:
        usage = usage_from_log(read_log(spark, kind, path, topic, brokers), ts_from="record")
        return enriched_view(in_time_order(enrich_usage(usage, versions), LOG_POSITION))
    raw = read_log(spark, kind, path, topic, brokers, streaming=True, starting="earliest",
                   max_files_per_trigger=max_per_trigger, max_offsets_per_trigger=max_per_trigger)
    usage = usage_from_log(raw, ts_from="record")
    columns, order = ["account", "bytesUsed", "quota", "ts", LOG_POSITION], ["ts", LOG_POSITION]
    if not versions.isStreaming:
        return start(enrich_static(usage, versions).select(*columns), checkpoint, "append",
                     sink=ordered_batch_writer(out, order), trigger=trigger)
    enriched = enrich_versioned(usage, versions, LOG_POSITION, delay=delay, late=late or "emit", wait_for=wait_for,
                                mark_late=True, account_groups=GROUPS)
    sink = ordered_batch_writer(out, order, late_out or out.rstrip("/") + "_late")
    return start(enriched.select(*columns, "late"), checkpoint, "append", sink=sink, trigger=trigger)


def alerting_job(spark: SparkSession, versions: DataFrame, kind: str = "kafka", path: str | None = None,
                 topic: str = DEFAULT_TOPIC, brokers: str = DEFAULT_BROKERS, streaming: bool = False,
                 checkpoint: str | None = None, out: str | None = None, ratio: float = ALERT_RATIO,
                 delay: str = "0 seconds", clear_after=None, late: str | None = None, trigger: dict | None = None,
                 max_per_trigger: int | None = None, wait_for: str = "usage") -> DataFrame | StreamingQuery:
    """Warnings ``ts, account, billingYear, billingMonth, quota, total, message``, one per billing key.

    Late usage counts as long as its month is open: always, or with ``clear_after`` until that long after the month's
    end (only ``late="drop"``, with a version stream, lets Spark drop it).  ``wait_for="both"`` waits for versions too.
    ``max_per_trigger`` (files, or Kafka offsets) and ``trigger`` bound a micro-batch of a long log.
    """
    if not streaming:
        usage = usage_from_log(read_log(spark, kind, path, topic, brokers), ts_from="record")
        return usage_alerts(enrich_usage(usage, versions), LOG_POSITION, ratio)
    raw = read_log(spark, kind, path, topic, brokers, streaming=True, starting="earliest",
                   max_files_per_trigger=max_per_trigger, max_offsets_per_trigger=max_per_trigger)
    usage = usage_from_log(raw, ts_from="record")
    if versions.isStreaming:
        alerts = stream_versioned_alerts(usage, versions, LOG_POSITION, ratio, clear_after=clear_after, delay=delay,
                                         late=late or "emit", wait_for=wait_for, account_groups=GROUPS)
    else:
        alerts = stream_usage_alerts(enrich_static(usage, versions), LOG_POSITION, ratio, clear_after=clear_after,
                                     watermark_delay=delay, account_groups=GROUPS)
    return start(alerts, checkpoint, "append", path=out, trigger=trigger)
