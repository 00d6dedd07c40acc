"""Replaying the test tables through Structured Streaming.

The rows Spark derives from the test tables are appended to their source folders one week of event
time at a time, each week written in parallel; after each week the stream runs with ``availableNow``
from its checkpoint and stops.  So micro-batches follow event time, and every replay also restarts
the query from its checkpoint once per week.  Results are read back from the sink, so each streamed
query can be compared with its batch form.  Every call writes to fresh folders below the shared
checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import testdata as td
from ..session import remove_path, scratch_path
from ..sources.codec import decode_usage, record_headers, unique_records
from ..sources.log import read_log
from .alerts import stream_usage_alerts, stream_versioned_alerts
from .carried import carried_alerts_writer
from .enrich import FINISHED, enrich_changes, enrich_static, enrich_versioned, folded
from .keyed_state import GROUPS
from .ordered import ordered_batch_writer, read_ordered
from .runner import await_end, batch_folder_writer, fresh_paths, latest_per_key, run_to_end
from .totals import stream_account_totals, stream_total_changes

TIE = "event_id"
CHUNK = timedelta(days=7)
CLEAR_AFTER = timedelta(days=1)     # grace after a month's end before its alert state is dropped


class EventOrderReplay:
    """Feeds tables to file streams in event-time chunks, running the query after each chunk."""

    def __init__(self, spark: SparkSession, name: str, chunk: timedelta = CHUNK):
        self.spark, self.chunk = spark, chunk
        self.base = scratch_path(spark, "replays", name)
        self.tables: list[tuple[DataFrame, Column, str]] = []

    def source(self, df: DataFrame, ts: str | Column, fmt: str = "parquet") -> DataFrame:
        """Register ``df`` and return the stream that will replay it by ``ts``: its event time, or a time
        of arrival to replay rows out of order."""
        path = f"{self.base}/{len(self.tables)}"
        self.tables.append((df, F.col(ts) if isinstance(ts, str) else ts, path))
        # The folder must exist before the stream is defined: start it with an empty file.
        self.spark.createDataFrame([], df.schema).write.mode("append").format(fmt).save(path)
        return self.spark.readStream.schema(df.schema).format(fmt).load(path)

    def run(self, step: Callable[[], None]) -> int:
        """Append chunk after chunk to every source, calling ``step`` (run the query to the end) after
        each one; returns the number of chunks.  The sources' folders are removed in the end."""
        bounds = [df.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi")).first() for df, ts, _ in self.tables]
        los = [b["lo"] for b in bounds if b["lo"] is not None]
        if not los:
            return 0
        lo, hi = min(los), max(b["hi"] for b in bounds if b["hi"] is not None)
        start = lo.replace(hour=0, minute=0, second=0, microsecond=0)
        n, parts = 0, max(1, self.spark.sparkContext.defaultParallelism)
        while start <= hi:
            end = start + self.chunk
            for df, ts, path in self.tables:
                (df.where((ts >= F.lit(start)) & (ts < F.lit(end)))
                   .repartition(parts).write.mode("append").parquet(path))
            step()
            n += 1
            start = end
        remove_path(self.spark, self.base)
        return n


def usage_log_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The raw JSON log replayed and decoded as a stream (times keep milliseconds, like the log)."""
    rp = EventOrderReplay(spark, "log")
    rp.source(td.raw_log_from_events(spark, sf), "timestamp")
    raw = read_log(spark, "files", path=rp.tables[0][2], streaming=True)
    out, ck = fresh_paths(spark, "usage_log")
    rp.run(lambda: run_to_end(decode_usage(raw, keep=[F.col("offset").alias(TIE)]), ck, "append", path=out))
    return spark.read.parquet(out)


def account_totals_unique_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Totals of a log in which every third record was written twice, the second time a day later."""
    rp = EventOrderReplay(spark, "unique")
    log = td.raw_log_from_events(spark, sf).withColumn("headers", record_headers("offset"))
    again = log.where(F.col("offset") % 3 == 0)
    both = log.withColumn("arrival", F.col("timestamp")).unionByName(again.withColumn("arrival", F.col("timestamp") + _days(1)))
    rp.source(both, "arrival")
    raw = read_log(spark, "files", path=rp.tables[0][2], streaming=True, headers=True)
    out, ck = fresh_paths(spark, "unique")
    q = stream_account_totals(decode_usage(unique_records(raw, "10 days")))
    rp.run(lambda: run_to_end(q, ck, "update", sink=batch_folder_writer(out)))
    return latest_per_key(spark, out, ["account"])


def account_totals_stream(spark: SparkSession, sf: str) -> DataFrame:
    rp = EventOrderReplay(spark, "totals")
    q = stream_account_totals(rp.source(td.usage_from_events(spark, sf), "ts"))
    out, ck = fresh_paths(spark, "totals")
    rp.run(lambda: run_to_end(q, ck, "update", sink=batch_folder_writer(out)))
    return latest_per_key(spark, out, ["account"])


def account_totals_changes_stream(spark: SparkSession, sf: str) -> DataFrame:
    rp = EventOrderReplay(spark, "changes")
    q = stream_total_changes(rp.source(td.usage_from_events(spark, sf), "ts"), TIE, account_groups=GROUPS)
    out, ck = fresh_paths(spark, "changes")
    rp.run(lambda: run_to_end(q, ck, "append", path=out))
    return spark.read.parquet(out)


def quota_enriched_stream(spark: SparkSession, sf: str) -> DataFrame:
    rp = EventOrderReplay(spark, "enriched")
    e = enrich_static(rp.source(td.usage_from_events(spark, sf), "ts"), td.versions_from_events(spark, sf))
    out, ck = fresh_paths(spark, "enriched")
    rp.run(lambda: run_to_end(e, ck, "append", path=out))
    return spark.read.parquet(out).select("account", "bytesUsed", "ts", TIE, "quota", "billingYear",
                                          "billingMonth")


def quota_enriched_dense_versions_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The stream-static join where the hot account has as many versions as there are sign-ups."""
    rp = EventOrderReplay(spark, "enriched_dense")
    e = enrich_static(rp.source(td.usage_hot_account(spark, sf), "ts"), td.versions_hot_account(spark, sf))
    out, ck = fresh_paths(spark, "enriched_dense")
    rp.run(lambda: run_to_end(e, ck, "append", path=out))
    return spark.read.parquet(out).select("account", "bytesUsed", "ts", TIE, "quota", "billingYear",
                                          "billingMonth")


def _versioned(spark: SparkSession, sf: str, name: str, late: str = "emit") -> tuple[EventOrderReplay, DataFrame]:
    rp = EventOrderReplay(spark, name)
    usage = rp.source(td.usage_from_events(spark, sf), "ts")
    versions = rp.source(td.versions_from_events(spark, sf), "ts")
    return rp, enrich_versioned(usage, versions, TIE, late=late, account_groups=GROUPS)


def quota_enriched_versions_stream(spark: SparkSession, sf: str) -> DataFrame:
    rp, e = _versioned(spark, sf, "enriched_versions")
    out, ck = fresh_paths(spark, "enriched_versions")
    rp.run(lambda: run_to_end(e, ck, "append", path=out))
    return spark.read.parquet(out).select("account", "bytesUsed", "ts", TIE, "quota", "billingYear",
                                          "billingMonth")


def quota_enriched_ordered_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Version-stream join written batch by batch in event order, read back as one sequence."""
    rp, e = _versioned(spark, sf, "enriched_ordered", late="drop")
    out, ck = fresh_paths(spark, "enriched_ordered")
    rp.run(lambda: run_to_end(e, ck, "append", sink=ordered_batch_writer(out, ["ts", TIE])))
    return read_ordered(spark, out, ["ts", TIE]).select("account", "bytesUsed", "quota", "ts")


def quota_enriched_late_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The version-stream join with every third usage row arriving ten days late: none is lost."""
    rp = EventOrderReplay(spark, "enriched_late")
    delay = F.when(F.col(TIE) % 3 == 0, F.expr("interval 10 days")).otherwise(F.expr("interval 0 days"))
    usage = rp.source(td.usage_from_events(spark, sf), F.col("ts") + delay)
    e = enrich_versioned(usage, rp.source(td.versions_from_events(spark, sf), "ts"), TIE, account_groups=GROUPS)
    out, ck = fresh_paths(spark, "enriched_late")
    rp.run(lambda: run_to_end(e, ck, "append", path=out))
    return spark.read.parquet(out).select("account", "bytesUsed", "ts", TIE, "quota", "billingYear",
                                          "billingMonth")


def _arriving(df: DataFrame, delay: Column) -> DataFrame:
    return df.withColumn("arrival", F.col("ts") + delay)


def _days(n: int) -> Column:
    return F.expr(f"interval {n} days")


def _heartbeats(df: DataFrame, delay: Column) -> DataFrame:
    """Rows without a key that say, for every day of ``df``, that it's over, and in the end that all is."""
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields if f.name != "ts"]
    days = df.select(F.date_trunc("day", "ts").alias("ts")).distinct().select(
        *empty, (F.col("ts") + F.expr("interval 1 day") - F.expr("interval 1 millisecond")).alias("ts"))
    beats = _arriving(days, delay)
    last = beats.agg((F.max("arrival") + CHUNK).alias("arrival")).select(
        *empty, F.lit(FINISHED).cast("timestamp").alias("ts"), "arrival")
    return beats.unionByName(last)


def _lagging(spark: SparkSession, sf: str, name: str, usage_delay: Column, version_delay: Column, beat_delay: Column,
             delay: str) -> DataFrame:
    """The join that waits for both sides, replayed by time of arrival; a side's heartbeats come with ``beat_delay``."""
    rp = EventOrderReplay(spark, name)
    sides = []
    for df, late in ((td.usage_from_events(spark, sf), usage_delay), (td.versions_from_events(spark, sf), version_delay)):
        rows = _arriving(df, late).unionByName(_heartbeats(df, beat_delay))
        sides.append(rp.source(rows, "arrival").drop("arrival"))
    e = enrich_versioned(*sides, TIE, delay=delay, wait_for="both", account_groups=GROUPS)
    out, ck = fresh_paths(spark, name)
    rp.run(lambda: run_to_end(e, ck, "append", path=out))
    return spark.read.parquet(out).select("account", "bytesUsed", "ts", TIE, "quota", "billingYear", "billingMonth")


def quota_enriched_lagging_versions_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Versions arrive a micro-batch after the usage they cover; the join waits for both sides."""
    return _lagging(spark, sf, "enriched_lagging", _days(0), _days(7), _days(7), "0 seconds")


def quota_enriched_delay_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Both sides up to two days out of order, within the watermark's delay of three days: nothing is late."""
    jitter = F.when(F.col("ts").cast("long") % 2 == 0, _days(2)).otherwise(_days(0))
    return _lagging(spark, sf, "enriched_delay", jitter, jitter, _days(2), "3 days")


def quota_enriched_changes_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The retracting join: every other version arrives ten days late; the folded change rows are the batch join."""
    rp = EventOrderReplay(spark, "enriched_changes")
    late = F.when(F.col("ts").cast("long") % 2 == 0, _days(10)).otherwise(_days(0))
    usage = rp.source(td.usage_from_events(spark, sf), "ts")
    versions = rp.source(_arriving(td.versions_from_events(spark, sf), late), "arrival").drop("arrival")
    out, ck = fresh_paths(spark, "enriched_changes")
    e = enrich_changes(usage, versions, TIE, account_groups=GROUPS)
    rp.run(lambda: run_to_end(e, ck, "append", path=out))
    return folded(spark.read.parquet(out)).select("account", "bytesUsed", "ts", TIE, "quota", "billingYear", "billingMonth")


def quota_enriched_ordered_late_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The enrichment written as an ordered sequence and a folder of late rows, read back together; every third usage
    row arrives ten days late."""
    rp = EventOrderReplay(spark, "enriched_ordered_late")
    late = F.when(F.col(TIE) % 3 == 0, _days(10)).otherwise(_days(0))
    usage = rp.source(_arriving(td.usage_from_events(spark, sf), late), "arrival").drop("arrival")
    e = enrich_versioned(usage, rp.source(td.versions_from_events(spark, sf), "ts"), TIE, mark_late=True,
                         account_groups=GROUPS)
    out, ck = fresh_paths(spark, "enriched_ordered_late")
    sink = ordered_batch_writer(f"{out}/main", ["ts", TIE], f"{out}/late")
    rp.run(lambda: run_to_end(e, ck, "append", sink=sink))
    return spark.read.parquet(f"{out}/main").unionByName(spark.read.parquet(f"{out}/late")).select(
        "account", "bytesUsed", "quota", "ts")


def usage_alerts_late_clearing_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Alerts after a version stream with monthly clearing over years of orders, every third of which arrives ten days
    late: the billing keys that warn (which row warns depends on the order of arrival)."""
    rp = EventOrderReplay(spark, "alerts_late_clearing", chunk=timedelta(days=366))
    late = F.when(F.col(TIE) % 3 == 0, _days(10)).otherwise(_days(0))
    usage = rp.source(_arriving(td.usage_from_orders(spark, sf), late), "arrival").drop("arrival")
    versions = rp.source(td.versions_from_customers(spark, sf), "ts")
    q = stream_versioned_alerts(usage, versions, TIE, clear_after=timedelta(days=20), account_groups=GROUPS,
                                bucket=timedelta(days=30))
    out, ck = fresh_paths(spark, "alerts_late_clearing")
    rp.run(lambda: run_to_end(q, ck, "append", path=out))
    return spark.read.parquet(out).select("account", "billingYear", "billingMonth", "quota")


def usage_alerts_clearing_orders_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Clearing over years of orders, so that the timers of many months fire between the runs."""
    rp = EventOrderReplay(spark, "alerts_clearing_orders", chunk=timedelta(days=366))
    e = enrich_static(rp.source(td.usage_from_orders(spark, sf), "ts"), td.versions_from_customers(spark, sf))
    q = stream_usage_alerts(e, TIE, clear_after=CLEAR_AFTER, account_groups=GROUPS)
    out, ck = fresh_paths(spark, "alerts_clearing_orders")
    rp.run(lambda: run_to_end(q, ck, "append", path=out))
    return spark.read.parquet(out).select("ts", "account", "billingYear", "billingMonth", "quota", "total",
                                          "message")


def usage_alerts_published_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The alert job reading the log that the publish job wrote."""
    from ..plans.jobs import alerting_job, publish_job

    path = scratch_path(spark, "logs", "published")
    publish_job(td.usage_from_events(spark, sf), "files", path)
    out, ck = fresh_paths(spark, "alerts_published")
    await_end(alerting_job(spark, td.versions_from_events(spark, sf), "files", path, streaming=True, checkpoint=ck,
                           out=out, trigger={"availableNow": True}))
    return spark.read.parquet(out).select("ts", "account", "billingYear", "billingMonth", "quota", "total",
                                          "message")


def usage_publish_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Usage published as a JSON log through the exactly-once file sink, then read and decoded."""
    from ..plans.jobs import publish_job

    rp = EventOrderReplay(spark, "publish")
    usage = rp.source(td.usage_from_events(spark, sf), "ts")
    out, ck = fresh_paths(spark, "publish")
    rp.run(lambda: await_end(publish_job(usage, "files", path=out, checkpoint=ck,
                                         trigger={"availableNow": True})))
    return decode_usage(read_log(spark, "files", path=out))


def usage_alerts_stream(spark: SparkSession, sf: str) -> DataFrame:
    rp = EventOrderReplay(spark, "alerts")
    e = enrich_static(rp.source(td.usage_from_events(spark, sf), "ts"), td.versions_from_events(spark, sf))
    q = stream_usage_alerts(e, TIE, account_groups=GROUPS)
    out, ck = fresh_paths(spark, "alerts")
    rp.run(lambda: run_to_end(q, ck, "append", path=out))
    return spark.read.parquet(out).select("ts", "account", "billingYear", "billingMonth", "quota", "total",
                                          "message")


def _carried(spark: SparkSession, sf: str, name: str, usage: DataFrame, **options) -> DataFrame:
    rp = EventOrderReplay(spark, name)
    e = enrich_static(rp.source(usage, "ts"), td.versions_from_events(spark, sf))
    out, ck = fresh_paths(spark, name)
    sink = carried_alerts_writer(out, f"{ck}_carry", TIE, **options)
    rp.run(lambda: run_to_end(e, ck, "append", sink=sink))
    return spark.read.parquet(out).select("ts", "account", "billingYear", "billingMonth", "quota", "total", "message")


def usage_alerts_carried_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Alerts of a stream through a carry table: every micro-batch is a batch run, no keyed state."""
    return _carried(spark, sf, "alerts_carried", td.usage_from_events(spark, sf))


def usage_alerts_hot_account_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The same where one account holds a third of every micro-batch: it is cut into narrow time buckets."""
    return _carried(spark, sf, "alerts_carried_hot", td.usage_hot_account(spark, sf), width=timedelta(minutes=10), compact=2)


def usage_alerts_handover_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Alerts of the batch up to a cut and of the stream that takes over from its totals, together."""
    from ..operators import enrich_usage, usage_alerts
    from ..operators.alerts import billing_state

    usage, versions = td.usage_from_events(spark, sf), td.versions_from_events(spark, sf)
    cut = F.lit(td.RANGE_START).cast("timestamp")
    before = enrich_usage(usage.where(F.col("ts") < cut), versions)
    rp = EventOrderReplay(spark, "alerts_handover")
    e = enrich_static(rp.source(usage.where(F.col("ts") >= cut), "ts"), versions)
    q = stream_usage_alerts(e, TIE, initial=billing_state(before, TIE), account_groups=GROUPS)
    out, ck = fresh_paths(spark, "alerts_handover")
    rp.run(lambda: run_to_end(q, ck, "append", path=out))
    columns = ["ts", "account", "billingYear", "billingMonth", "quota", "total", "message"]
    return usage_alerts(before, TIE).select(*columns).unionByName(spark.read.parquet(out).select(*columns))


def usage_alerts_clearing_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Alerts with monthly state clearing on (event-time mode, a timer per account and month)."""
    rp = EventOrderReplay(spark, "alerts_clearing")
    e = enrich_static(rp.source(td.usage_from_events(spark, sf), "ts"), td.versions_from_events(spark, sf))
    q = stream_usage_alerts(e, TIE, clear_after=CLEAR_AFTER, account_groups=GROUPS)
    out, ck = fresh_paths(spark, "alerts_clearing")
    rp.run(lambda: run_to_end(q, ck, "append", path=out))
    return spark.read.parquet(out).select("ts", "account", "billingYear", "billingMonth", "quota", "total",
                                          "message")


def usage_alerts_versions_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Alerts with the versions as a stream too: join and totals in one processor."""
    rp = EventOrderReplay(spark, "alerts_versions")
    usage = rp.source(td.usage_from_events(spark, sf), "ts")
    q = stream_versioned_alerts(usage, rp.source(td.versions_from_events(spark, sf), "ts"), TIE,
                                account_groups=GROUPS)
    out, ck = fresh_paths(spark, "alerts_versions")
    rp.run(lambda: run_to_end(q, ck, "append", path=out))
    return spark.read.parquet(out).select("ts", "account", "billingYear", "billingMonth", "quota", "total",
                                          "message")


def stream_queries() -> dict:
    return {
        "usage_log_stream": usage_log_stream,
        "account_totals_stream": account_totals_stream,
        "account_totals_unique_stream": account_totals_unique_stream,
        "account_totals_changes_stream": account_totals_changes_stream,
        "quota_enriched_stream": quota_enriched_stream,
        "quota_enriched_dense_versions_stream": quota_enriched_dense_versions_stream,
        "quota_enriched_versions_stream": quota_enriched_versions_stream,
        "quota_enriched_ordered_stream": quota_enriched_ordered_stream,
        "usage_publish_stream": usage_publish_stream,
        "usage_alerts_stream": usage_alerts_stream,
        "usage_alerts_versions_stream": usage_alerts_versions_stream,
        "usage_alerts_clearing_stream": usage_alerts_clearing_stream,
        "quota_enriched_late_stream": quota_enriched_late_stream,
        "usage_alerts_clearing_orders_stream": usage_alerts_clearing_orders_stream,
        "usage_alerts_published_stream": usage_alerts_published_stream,
        "quota_enriched_lagging_versions_stream": quota_enriched_lagging_versions_stream,
        "quota_enriched_delay_stream": quota_enriched_delay_stream,
        "quota_enriched_changes_stream": quota_enriched_changes_stream,
        "quota_enriched_ordered_late_stream": quota_enriched_ordered_late_stream,
        "usage_alerts_late_clearing_stream": usage_alerts_late_clearing_stream,
        "usage_alerts_handover_stream": usage_alerts_handover_stream,
        "usage_alerts_carried_stream": usage_alerts_carried_stream,
        "usage_alerts_hot_account_stream": usage_alerts_hot_account_stream,
    }

