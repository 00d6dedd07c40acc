from datetime import datetime

from pyspark.sql import functions as F

from meterline.functions import (account_id, alert_message, billing_key, billing_month, billing_year,
                                 epoch_millis, from_epoch_millis, instant, instant_text, over_threshold)
from helpers import t


def one(spark, col, rows, ddl):
    return [r[0] for r in spark.createDataFrame(rows, ddl).select(col).collect()]


def test_instant_text_prints_fraction_like_java_instant(spark):
    rows = [(t("2021-10-01T00:00:00"),), (t("2021-10-01T00:00:00.160"),), (t("2021-10-01T00:00:00.160001"),),
            (t("2021-10-31T23:59:59.999"),)]
    got = one(spark, instant_text("ts"), rows, "ts timestamp")
    assert got == ["2021-10-01T00:00:00Z", "2021-10-01T00:00:00.160Z", "2021-10-01T00:00:00.160001Z",
                   "2021-10-31T23:59:59.999Z"]


def test_billing_period_is_utc_and_long(spark):
    df = spark.createDataFrame([(t("2021-10-31T23:59:59.999"),), (t("2021-11-01T00:00:00"),)], "ts timestamp")
    out = df.select(billing_year("ts").alias("y"), billing_month("ts").alias("m"))
    assert dict(out.dtypes) == {"y": "bigint", "m": "bigint"}
    assert [tuple(r) for r in out.collect()] == [(2021, 10), (2021, 11)]


def test_account_id_pads_and_keeps_long_numbers(spark):
    assert one(spark, account_id("n"), [(7,), (1234567,)], "n long") == ["000007", "1234567"]


def test_billing_key_text(spark):
    df = spark.createDataFrame([("000007", 2021, 10, 10_000_000_000)], "a string, y long, m long, q long")
    assert df.select(billing_key("a", "y", "m", "q")).first()[0] == "000007/2021/10/10000000000"


def test_threshold_is_strict_and_in_double(spark):
    rows = [(90, 100), (91, 100), (0, None), (9, 10)]
    got = one(spark, over_threshold("total", "quota"), rows, "total long, quota long")
    # Exact boundary (90 of 100, 9 of 10) does not pass: the comparison is strict.
    assert got == [False, True, None, False]


def test_alert_message_text(spark):
    df = spark.createDataFrame([(t("2021-10-05T12:00:00.160"), "000007", 91, 100)],
                               "ts timestamp, account string, total long, quota long")
    msg = df.select(alert_message()).first()[0]
    assert msg == "WARNING: as of 2021-10-05T12:00:00.160Z account 000007 has used 91 out of 100 bytes"


def test_epoch_millis_round_trip(spark):
    df = spark.range(1).select(instant("2021-10-01T00:00:00.000Z").alias("ts"))
    r = df.select(epoch_millis("ts").alias("ms"), from_epoch_millis(epoch_millis("ts")).alias("back")).first()
    assert r["ms"] == 1633046400000
    assert r["back"] == datetime(2021, 10, 1)


def test_session_zone_is_utc(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.range(1).select(F.current_timezone()).first()[0] == "UTC"


def test_shared_dir_comes_from_the_session(spark):
    from meterline.session import scratch_path, shared_dir
    base = shared_dir(spark)
    assert base and spark.sparkContext.getCheckpointDir() == base
    p1, p2 = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert p1.startswith(base) and p1 != p2
