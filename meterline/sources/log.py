"""The usage log: Kafka topic or a file replay of it, bounded or unbounded, plus its sink.

Both forms give the raw-log columns ``key, value, topic, partition, offset, timestamp`` so that decoding
(:mod:`meterline.sources.codec`) is the same.  The Kafka connector package is not bundled with
PySpark; ``read_log(kind="kafka")`` builds the reader and needs the package on the classpath.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import DEFAULT_BROKERS, DEFAULT_TOPIC, RAW_LOG

HEADERS = T.ArrayType(T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())]))
KAFKA_HINT = ("the Kafka source is not on the classpath: start Spark with "
              "--packages org.apache.spark:spark-sql-kafka-0-10_2.13:<spark version>, "
              "or use kind=\"files\" on a parquet copy of the log")


def _as_dt(t: str | datetime) -> datetime:
    """The instant, to the microsecond; text or times without a zone are UTC."""
    if isinstance(t, str):
        t = datetime.fromisoformat(t.replace("Z", "+00:00"))
    return t.replace(tzinfo=timezone.utc) if t.tzinfo is None else t.astimezone(timezone.utc)


def _epoch_ms(t: str | datetime, up: bool = False) -> int:
    """Epoch milliseconds for Kafka, rounded down, or up so that a bound loses no record."""
    us = (_as_dt(t) - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)
    return -(-us // 1000) if up else us // 1000


def kafka_options(topic: str = DEFAULT_TOPIC, brokers: str = DEFAULT_BROKERS, starting: str = "earliest",
                  start: str | datetime | None = None, end: str | datetime | None = None,
                  streaming: bool = False, max_offsets_per_trigger: int | None = None,
                  min_partitions: int | None = None, headers: bool = False) -> dict:
    """Reader options for the log topic.

    ``start``/``end`` bound a batch read by record time (Kafka looks up, per partition, the first offset
    at or after each time); a stream starts at ``start`` or at ``starting``.  A partition without a record
    at or after ``start`` gives none.  ``min_partitions`` reads a topic in more tasks than it has
    partitions.
    """
    opts = {"kafka.bootstrap.servers": brokers, "subscribe": topic, "includeHeaders": str(headers).lower()}
    if start is not None:
        opts["startingTimestamp"] = str(_epoch_ms(start))
        opts["startingOffsetsByTimestampStrategy"] = "latest"
    else:
        opts["startingOffsets"] = starting
    if end is not None:
        if streaming:
            raise ValueError("an unbounded read has no end")
        opts["endingTimestamp"] = str(_epoch_ms(end, up=True))
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    if streaming:
        opts["failOnDataLoss"] = "true"
        if max_offsets_per_trigger:
            opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return opts


def in_range(df: DataFrame, start: str | datetime | None, end: str | datetime | None, ts: str = "ts") -> DataFrame:
    """Half-open event-time range ``start <= ts < end``; on a parquet source the filter reaches the scan."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col(ts) >= F.lit(_as_dt(start)))
    if end is not None:
        cond = cond & (F.col(ts) < F.lit(_as_dt(end)))
    return df.where(cond)


def read_log(spark: SparkSession, kind: str = "files", path: str | None = None, topic: str = DEFAULT_TOPIC,
             brokers: str = DEFAULT_BROKERS, streaming: bool = False, starting: str = "earliest",
             start=None, end=None, max_files_per_trigger: int | None = None,
             max_offsets_per_trigger: int | None = None, min_partitions: int | None = None,
             headers: bool = False) -> DataFrame:
    """Raw log records, bounded (``read``) or unbounded (``readStream``); with their ``headers`` on request.

    ``kind="files"`` reads a parquet replay of the log (written by :func:`write_log`) at ``path``; the
    time range is then a row filter on the record time, pushed into the scan.
    """
    schema = T.StructType([*RAW_LOG.fields, T.StructField("headers", HEADERS)]) if headers else RAW_LOG
    if kind == "kafka":
        opts = kafka_options(topic, brokers, starting, start, end, streaming, max_offsets_per_trigger, min_partitions,
                             headers)
        reader = spark.readStream if streaming else spark.read
        try:
            df = reader.format("kafka").options(**opts).load()
        except Exception as e:  # noqa: BLE001 - re-raised with the fix
            if "kafka" in str(e).lower() and "data source" in str(e).lower():
                raise RuntimeError(KAFKA_HINT) from e
            raise
        return df.select(*[c.name for c in schema.fields])
    if kind != "files":
        raise ValueError(f"unknown log kind {kind!r}")
    if streaming:
        r = spark.readStream.schema(schema)
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        df = r.parquet(path)
    else:
        df = spark.read.schema(schema).parquet(path)
    df = df.where(F.col("topic") == topic)
    if start is not None or end is not None:
        df = in_range(df, start, end, ts="timestamp")
    return df


def kafka_columns(raw: DataFrame) -> list[str]:
    return ["key", "value", "topic", *(["headers"] if "headers" in raw.columns else [])]


def write_log(raw: DataFrame, kind: str = "files", path: str | None = None, brokers: str = DEFAULT_BROKERS,
              mode: str = "append") -> None:
    """Write log records (batch).  Kafka takes ``key, value, topic`` and ``headers``; files keep all raw columns."""
    if kind == "kafka":
        (raw.select(*kafka_columns(raw)).write.format("kafka")
            .option("kafka.bootstrap.servers", brokers).save())
    else:
        raw.write.mode(mode).parquet(path)
