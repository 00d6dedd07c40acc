import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from meterline.operators import account_total_changes, account_totals
from meterline.operators.scan import last_seen, next_in_order, running_sum, time_buckets
from helpers import t, usage


def test_account_totals(spark):
    u = usage(spark, [("a", 5, "2021-10-01T00:00:00", 1), ("a", 0, "2021-10-09T00:00:00", 2),
                      ("b", 7, "2021-10-03T00:00:00", 3)])
    got = sorted(tuple(r) for r in account_totals(u).collect())
    # A zero-byte row moves asOf but not the total.
    assert got == [("a", 5, t("2021-10-09T00:00:00")), ("b", 7, t("2021-10-03T00:00:00"))]


def test_account_totals_plan_combines_before_shuffle(spark):
    u = usage(spark, [("a", 5, "2021-10-01T00:00:00", 1)])
    plan = account_totals(u)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "partial_max" in plan


@pytest.mark.parametrize("plan", ["window", "buckets"])
def test_change_rows(spark, plan):
    u = usage(spark, [("a", 5, "2021-10-01T00:00:00", 1), ("a", 3, "2021-10-02T00:00:00", 2),
                      ("b", 1, "2021-10-02T00:00:00", 3)])
    got = sorted(tuple(r) for r in account_total_changes(u, "event_id", plan=plan)
                 .select("op", "account", "totalUsage", "asOf").collect())
    assert got == sorted([("+I", "a", 5, t("2021-10-01T00:00:00")), ("-U", "a", 5, t("2021-10-01T00:00:00")),
                          ("+U", "a", 8, t("2021-10-02T00:00:00")), ("+I", "b", 1, t("2021-10-02T00:00:00"))])


def skewed(spark, seed=7, n=400):
    """One key with most rows, many exact copies of one row, and a few small keys."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        k = "hot" if i % 4 else rnd.choice(["k1", "k2", "k3"])
        rows.append((k, rnd.randrange(0, 9), f"2021-10-{1 + rnd.randrange(0, 28):02d}T00:00:00", i))
    rows += [("hot", 1, "2021-10-15T00:00:00", 999)] * 60  # copies
    return spark.createDataFrame([(a, v, t(ts), e) for a, v, ts, e in rows], "k string, v long, ts timestamp, e long")


DAYS = [timedelta(days=d) for d in (1, 3, 400)]


def values(df, *cols):
    return sorted(repr(tuple(r[c] for c in cols)) for r in df.collect())


def test_buckets_spread_a_hot_key(spark):
    df = time_buckets(skewed(spark), ["k"], "ts", timedelta(days=3)).where("k = 'hot'")
    per = [r["count"] for r in df.groupBy("_bucket").count().collect()]
    assert len(per) >= 9 and max(per) < sum(per) / 2


@pytest.mark.parametrize("width", DAYS)
def test_buckets_equal_window(spark, width):
    df = skewed(spark).withColumn("q", F.when(F.col("e") % 5 == 0, F.lit(None)).otherwise(F.lit(1)))
    a = running_sum(df, ["k", "q"], ["ts", "e"], "v", "tot", prev_order="ts", plan="window")
    b = running_sum(df, ["k", "q"], ["ts", "e"], "v", "tot", prev_order="ts", width=width)
    # Only exact copies share (k, ts, e), so the multisets must agree.
    cols = ("k", "q", "ts", "e", "v", "tot", "_prev")
    assert values(a, *cols) == values(b, *cols)
    df = df.dropDuplicates(["k", "ts", "e"]).withColumn(
        "val", F.when(F.col("e") % 7 == 0, F.struct(F.col("e").alias("x"), F.lit("y").alias("y"))))
    for a, b in ((next_in_order(df, ["k"], ["ts", "e"], "nx", plan="window"), next_in_order(df, ["k"], ["ts", "e"], "nx", width=width)),
                 (last_seen(df, ["k"], ["ts", "e"], "val", "nx", plan="window"), last_seen(df, ["k"], ["ts", "e"], "val", "nx", width=width))):
        assert values(a, "k", "ts", "e", "nx") == values(b, "k", "ts", "e", "nx")


@pytest.mark.parametrize("plan", ["window", "buckets"])
def test_nulls_add_nothing(spark, plan):
    df = spark.createDataFrame([("a", None, t("2021-10-01T00:00:00"), 1), ("a", 5, t("2021-10-02T00:00:00"), 2),
                                ("a", 1, None, 3)], "k string, v long, ts timestamp, e long")
    out = running_sum(df, ["k"], ["ts", "e"], "v", "tot", plan=plan)
    assert sorted((r["e"], r["tot"]) for r in out.collect()) == [(1, 1), (2, 6), (3, 1)]  # no time comes first


@pytest.mark.parametrize("plan", ["window", "buckets"])
def test_overflow_raises(spark, plan):
    df = spark.createDataFrame([("a", 2**62, t("2021-10-01T00:00:00"), 1), ("a", 2**62, t("2021-10-02T00:00:00"), 2),
                                ("a", 2**62, t("2021-10-03T00:00:00"), 3)], "k string, v long, ts timestamp, e long")
    with pytest.raises(Exception, match="(?i)overflow"):
        running_sum(df, ["k"], ["ts", "e"], "v", "tot", plan=plan).collect()


def test_defining_a_result_runs_no_job(spark):
    df, tracker = skewed(spark), spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("define", "")
    running_sum(df, ["k"], ["ts", "e"], "v", "tot")
    assert not tracker.getJobIdsForGroup("define")
    spark.sparkContext.setJobGroup("", "")


def test_overflow_is_exact():
    import numpy as np
    from meterline.operators.scan import check_sums
    from meterline.streaming.alerts import checked_cumsum

    with pytest.raises(OverflowError):
        checked_cumsum(2 ** 63 - 1024, np.ones(2000, dtype="int64"))
    assert checked_cumsum(2 ** 63 - 10, np.ones(8, dtype="int64"))[-1] == 2 ** 63 - 2
    v = np.array([2 ** 62, 2 ** 62 - 1, 1], dtype="int64")
    assert check_sums(np.cumsum(v[:2]), v[:2])[-1] == 2 ** 63 - 1
    with pytest.raises(OverflowError):
        check_sums(np.cumsum(v), v)
