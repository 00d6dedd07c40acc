"""JSON encoding and decoding of usage records, as column expressions (no Python per row).

Body: ``{"ts":"2021-10-01T00:00:00.000+0000","account":"000007","bytesUsed":1800}``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import DEFAULT_TOPIC, JSON_TS_FORMAT, USAGE_BODY_NO_TS, USAGE_PARSE

JSON_OPTIONS = {"timestampFormat": JSON_TS_FORMAT}


def usage_json(ts="ts", account="account", bytes_used="bytesUsed") -> Column:
    """The JSON body of a usage row; times in UTC with milliseconds (finer digits are cut)."""
    return F.to_json(F.struct(F.col(ts).alias("ts"), F.col(account).alias("account"),
                              F.col(bytes_used).alias("bytesUsed")), JSON_OPTIONS)


RECORD_ID = "record_id"


def record_headers(record_id: str | Column) -> Column:
    """Log headers that hold a record's id."""
    c = F.col(record_id) if isinstance(record_id, str) else record_id
    return F.array(F.struct(F.lit(RECORD_ID).alias("key"), c.cast("string").cast("binary").alias("value"))).alias("headers")


def unique_records(raw: DataFrame, within: str | None = None) -> DataFrame:
    """Each record of a log once, however often it was written: an at-least-once sink repeats records, with their ids.

    ``raw`` has ``headers`` with a record id (``read_log(..., headers=True)``); a record without one raises.  In a
    stream ``within`` bounds the state: a repeated record is found if its time is at most that far behind the latest
    one, and records still later are dropped by Spark, so it must cover the log's disorder too.  Without ``within`` ids are
    kept forever.  Repeats are alike, so it doesn't matter which one stays.
    """
    found = F.element_at(F.filter("headers", lambda h: h["key"] == RECORD_ID), 1)["value"].cast("string")
    checked = F.coalesce(found, F.raise_error(F.lit("a log record has no id")).cast("string"))
    rows = raw.withColumn(RECORD_ID, checked)
    if within is not None and raw.isStreaming:
        return rows.withWatermark("timestamp", within).dropDuplicatesWithinWatermark([RECORD_ID]).drop(RECORD_ID)
    return rows.dropDuplicates([RECORD_ID]).drop(RECORD_ID)


def encode_usage(usage: DataFrame, topic: str = DEFAULT_TOPIC, extra: Sequence[Column] = (),
                 record_id: str | Column | None = None) -> DataFrame:
    """Usage rows as log records: null key, JSON value, the topic, record time = event time (ms).  ``record_id``, which
    must tell rows apart and be the same in every attempt, goes into the record's headers."""
    extra = [*extra, *([record_headers(record_id)] if record_id is not None else [])]
    cols = [F.lit(None).cast("binary").alias("key"), usage_json().cast("binary").alias("value"),
            F.lit(topic).alias("topic"), *extra,
            F.timestamp_millis(F.unix_millis("ts")).alias("timestamp")]
    return usage.select(*cols)


def _parse(raw: DataFrame, schema, mode: str) -> Column:
    return F.from_json(F.col("value").cast("string"), schema, {**JSON_OPTIONS, "mode": mode})


def _bad_row(ts_from: str) -> Column:
    bad = F.col("_p").isNull() | F.col("_p.account").isNull() | F.col("_p.bytesUsed").isNull()
    if ts_from == "body":
        bad = bad | F.col("_p.ts").isNull()
    else:
        bad = bad | F.col("timestamp").isNull()
    return bad


def _select_usage(df: DataFrame, ts_from: str, keep: Sequence[str]) -> DataFrame:
    ts = F.col("_p.ts") if ts_from == "body" else F.col("timestamp")
    return df.select(ts.alias("ts"), F.col("_p.account").alias("account"),
                     F.col("_p.bytesUsed").alias("bytesUsed"), *keep)


def decode_usage(raw: DataFrame, ts_from: str = "body", keep: Sequence[str] = ()) -> DataFrame:
    """Strict decoding: a malformed body or a missing field fails the query, like the reference.

    ``ts_from="body"`` reads the time from the JSON body; ``"record"`` takes the log record's own
    timestamp and reads only ``account`` and ``bytesUsed`` from the body (the SQL-declared table).
    ``keep`` passes raw columns through (e.g. ``partition, offset`` as a tie).
    """
    schema = USAGE_PARSE if ts_from == "body" else USAGE_BODY_NO_TS
    parsed = raw.withColumn("_p", _parse(raw, schema, "FAILFAST"))
    checked = parsed.withColumn(
        "_p", F.when(_bad_row(ts_from), F.raise_error(F.concat(
            F.lit("malformed usage record: "), F.coalesce(F.col("value").cast("string"), F.lit("null")))))
        .otherwise(F.col("_p")))
    return _select_usage(checked, ts_from, keep)


def decode_usage_tolerant(raw: DataFrame, ts_from: str = "body",
                          keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Tolerant decoding: ``(usage, rejects)``; rejects keep the raw record.  Unknown fields are ignored."""
    schema = USAGE_PARSE if ts_from == "body" else USAGE_BODY_NO_TS
    parsed = raw.withColumn("_p", _parse(raw, schema, "PERMISSIVE")).withColumn("_bad", _bad_row(ts_from))
    good = _select_usage(parsed.where(~F.col("_bad")), ts_from, keep)
    rejects = parsed.where(F.col("_bad")).drop("_p", "_bad")
    return good, rejects
