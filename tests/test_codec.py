import pytest
from pyspark.sql import functions as F

from meterline import testdata as td
from meterline.schemas import RAW_LOG
from meterline.sources.codec import decode_usage, decode_usage_tolerant, encode_usage, usage_json
from meterline.sources.log import in_range, kafka_options, read_log, write_log
from meterline.session import scratch_path
from helpers import t, usage


def raw(spark, values, ts="2021-10-01T00:00:00"):
    rows = [(None, v.encode() if v is not None else None, "input", 0, i, t(ts)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, RAW_LOG)


def test_json_text_matches_declared_pattern(spark):
    u = usage(spark, [("000007", 1800, "2021-10-01T00:00:00", 1)])
    assert u.select(usage_json()).first()[0] == \
        '{"ts":"2021-10-01T00:00:00.000+0000","account":"000007","bytesUsed":1800}'


def test_round_trip_keeps_milliseconds(spark):
    u = usage(spark, [("000007", 18, "2021-10-01T00:00:00.123456", 1), ("000008", 0, "2021-10-31T23:59:59.999", 2)])
    back = decode_usage(encode_usage(u))
    assert [tuple(r) for r in back.orderBy("account").collect()] == [
        (t("2021-10-01T00:00:00.123"), "000007", 18), (t("2021-10-31T23:59:59.999"), "000008", 0)]


def test_record_time_form_reads_only_two_body_fields(spark):
    r = raw(spark, ['{"account":"000001","bytesUsed":5,"extra":1}'], ts="2021-10-02T00:00:00")
    out = decode_usage(r, ts_from="record").first()
    assert tuple(out) == (t("2021-10-02T00:00:00"), "000001", 5)


def test_strict_decoding_fails_on_garbage(spark):
    with pytest.raises(Exception):
        decode_usage(raw(spark, ["garbage"])).collect()


def test_strict_decoding_fails_on_missing_field(spark):
    with pytest.raises(Exception, match="malformed usage record"):
        decode_usage(raw(spark, ['{"account":"x"}'])).collect()


def test_tolerant_decoding_routes_bad_records(spark):
    vals = ["garbage", '{"account":"x"}',
            '{"ts":"2021-10-01T00:00:00.000+0000","account":"000001","bytesUsed":7,"unknown":true}']
    good, rejects = decode_usage_tolerant(raw(spark, vals))
    assert [tuple(r) for r in good.collect()] == [(t("2021-10-01T00:00:00"), "000001", 7)]
    assert sorted(r["value"].decode() for r in rejects.collect()) == sorted(vals[:2])


def test_range_is_half_open(spark):
    u = usage(spark, [("a", 1, "2021-10-01T00:00:00", 1), ("a", 1, "2021-10-31T23:59:59.999", 2),
                      ("a", 1, "2021-10-31T23:59:59.998", 3)])
    got = in_range(u, "2021-10-01T00:00:00.000Z", "2021-10-31T23:59:59.999Z")
    assert sorted(r["event_id"] for r in got.collect()) == [1, 3]


def test_file_log_round_trip_pushes_time_filter(spark, sf001):
    path = scratch_path(spark, "test-log")
    write_log(td.raw_log_from_events(spark, sf001), path=path)
    df = read_log(spark, path=path, start="2024-01-08T00:00:00Z", end="2024-01-15T00:00:00Z")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "timestamp" in plan.split("PushedFilters")[1][:300]
    n = df.count()
    expected = td.usage_from_events(spark, sf001).where(
        (F.col("ts") >= "2024-01-08") & (F.col("ts") < "2024-01-15")).count()
    assert n == expected > 0


def test_kafka_options_mapping():
    o = kafka_options(start="2021-10-01T00:00:00.000Z", end="2021-10-31T23:59:59.999Z")
    assert o["subscribe"] == "input" and o["kafka.bootstrap.servers"] == "localhost:9092"
    assert o["startingTimestamp"] == "1633046400000" and o["endingTimestamp"] == "1635724799999"
    s = kafka_options(streaming=True, max_offsets_per_trigger=1000)
    assert s["startingOffsets"] == "earliest" and s["maxOffsetsPerTrigger"] == "1000"
    with pytest.raises(ValueError):
        kafka_options(streaming=True, end="2021-10-31T00:00:00Z")


def test_tolerant_log_table_has_rejects_view(spark):
    from meterline.plans.views import register_log_table
    r = raw(spark, ["garbage", '{"account":"000001","bytesUsed":7}'], ts="2021-10-01T00:00:00")
    table = register_log_table(r, name="dc_tolerant", strict=False)
    assert [tuple(x) for x in table.collect()] == [(t("2021-10-01T00:00:00"), "000001", 7)]
    assert spark.sql("SELECT count(*) FROM dc_tolerant_rejects").first()[0] == 1


def test_kafka_without_connector_names_the_fix(spark):
    with pytest.raises(RuntimeError, match="spark-sql-kafka"):
        read_log(spark, "kafka", topic="input")


def test_repeated_log_records_count_once(spark):
    from meterline.sources.codec import unique_records
    from meterline.sources.log import kafka_columns, kafka_options
    from helpers import usage

    rows = usage(spark, [("a", 1, "2021-10-01T00:00:00", 1), ("a", 1, "2021-10-01T00:00:00", 2), ("b", 5, "2021-10-02T00:00:00", 3)])
    path = scratch_path(spark, "t-unique")
    for part in (rows, rows.where("event_id > 1")):     # a retried write
        write_log(encode_usage(part, record_id="event_id"), "files", path)
    raw = read_log(spark, "files", path=path, headers=True)
    assert raw.count() == 5
    assert sorted(tuple(r) for r in decode_usage(unique_records(raw)).select("account", "bytesUsed").collect()) == [
        ("a", 1), ("a", 1), ("b", 5)]       # equal records of different ids both stay
    assert kafka_columns(raw) == ["key", "value", "topic", "headers"]
    assert kafka_options(headers=True)["includeHeaders"] == "true" and kafka_options()["includeHeaders"] == "false"
    bare = scratch_path(spark, "t-unique-bare")
    write_log(encode_usage(rows), "files", bare)
    with pytest.raises(Exception, match="has no id"):
        unique_records(read_log(spark, "files", path=bare, headers=True)).collect()
