"""Streamed alerts through a carry table, and scans that cut busy buckets into pieces."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from meterline.operators import account_total_changes, scan, usage_alerts
from meterline.operators.alerts import billing_state
from meterline.operators.scan import _rows, crossing_rows, last_seen, next_in_order, running_sum, running_sum_of
from meterline.session import scratch_path
from meterline.streaming.carried import CarriedAlerts
from helpers import t

DDL = "account string, bytesUsed long, ts timestamp, event_id long, quota long, billingYear long, billingMonth long"
COLS = ["ts", "account", "billingYear", "billingMonth", "quota", "total", "message"]


def enriched(spark, rows):
    """rows: (account, bytesUsed, day or None, event_id, quota)."""
    return spark.createDataFrame(
        [(a, b, None if d is None else t(f"2021-10-{d:02d}T00:00:00"), e, q, 2021, 10) for a, b, d, e, q in rows], DDL)


BATCHES = [
    [("a", 50, 1, 1, 100), ("b", 95, 1, 2, 100), ("n", 5, 1, 3, None), ("c", 91, 1, 4, 100), ("c", -60, 2, 5, 100)],
    [("a", 41, 2, 6, 100), ("b", 500, 2, 7, 100), ("n", 500, 2, 8, None), ("c", 70, 3, 9, 100)],
    [],
    [("a", 9, 1, 10, 100), ("a", 95, 4, 11, 101), ("d", None, 4, 12, 10), ("d", 9, 4, 13, 10), ("d", 1, None, 14, 10)],
    [("a", 1, 5, 15, 101), ("d", 1, 5, 16, 10)],
]


def read_all(spark, out):
    return sorted(tuple(r) for r in spark.read.parquet(out).select(*COLS).collect())


@pytest.mark.parametrize("compact", [1, 2, 32])
def test_carried_equals_batch_and_replays_change_nothing(spark, compact):
    out = scratch_path(spark, "t-carried")
    sink = CarriedAlerts(f"{out}/alerts", f"{out}/state", "event_id", compact=compact)
    for n, rows in enumerate(BATCHES):
        for _ in range(2 if n % 2 else 1):      # the second and fourth batch run twice, as after a failure
            sink(enriched(spark, rows), n)
    got = read_all(spark, f"{out}/alerts")
    # by hand: every key warns once, at the first row of its batch's order that passes 90 %
    assert [(r[1], r[4], r[5], r[0].day) for r in got] == sorted(
        [("a", 100, 91, 2), ("b", 100, 95, 1), ("c", 100, 91, 1), ("a", 101, 95, 4), ("d", 10, 10, 4)],
        key=lambda r: (r[3], r[0], r[1]))
    state = sink.carry(spark, "account string, billingYear long, billingMonth long, quota long", len(BATCHES))
    want = {("a", 100): (100, True), ("a", 101): (96, True), ("b", 100): (595, True), ("c", 100): (101, True),
            ("n", None): (505, False), ("d", 10): (11, True)}
    assert {(r["account"], r["quota"]): (r["total"], r["alerted"]) for r in state.collect()} == want


def test_carried_takes_over_from_a_batch_and_resumes(spark):
    """A new sink over the same folders goes on; ``initial`` holds what a batch run left."""
    first, rest = enriched(spark, BATCHES[0]), [enriched(spark, b) for b in BATCHES[1:]]
    out = scratch_path(spark, "t-carried-initial")
    for n, batch in enumerate(rest):
        CarriedAlerts(f"{out}/alerts", f"{out}/state", "event_id", initial=billing_state(first, "event_id"))(batch, n)
    before = sorted(tuple(r) for r in usage_alerts(first, "event_id").select(*COLS).collect())
    got = sorted(before + read_all(spark, f"{out}/alerts"))
    assert [(r[1], r[4], r[5]) for r in got] == [("b", 100, 95), ("c", 100, 91), ("a", 100, 91), ("a", 101, 95), ("d", 10, 10)]


def test_carried_key_without_quota(spark):
    out = scratch_path(spark, "t-carried-month")
    key = ("account", "billingYear", "billingMonth")
    sink = CarriedAlerts(f"{out}/alerts", f"{out}/state", "event_id", key=key)
    for n, rows in enumerate([[("a", 50, 1, 1, 100)], [("a", 10, 2, 2, 1000), ("a", 40, 3, 3, 110)]]):
        sink(enriched(spark, rows), n)
    assert [(r[1], r[4], r[5]) for r in read_all(spark, f"{out}/alerts")] == [("a", 110, 100)]


def one_second(spark, n=3000):
    """A key whose rows all lie in one second, a third at one time, plus rows without a time and a small key."""
    df = spark.range(n).select(
        F.lit("hot").alias("k"), (F.col("id") % 9 - 2).alias("v"), F.col("id").alias("e"),
        F.when(F.col("id") % 50 == 0, F.lit(None))
         .otherwise(F.timestamp_micros(1_633_046_400_000_000 + F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 900)))
         .alias("ts"))
    return df.unionByName(df.where("e < 5").withColumn("k", F.lit("small")))


def test_pieces_bound_a_busy_second(spark):
    df = one_second(spark)
    whole = _rows(df, ["k"], ["ts", "e"], timedelta(hours=1), None).groupBy("_key", "_bucket").count()
    assert whole.agg(F.max("count")).first()[0] > 2900
    cut = _rows(df, ["k"], ["ts", "e"], timedelta(hours=1), 50).groupBy("_key", "_bucket").count()
    sizes = [r["count"] for r in cut.collect()]
    assert sum(sizes) == df.count() and len(sizes) > 30 and max(sizes) < 600


@pytest.mark.parametrize("piece_rows", [1, 7, 50, 10 ** 9])
def test_pieces_equal_window(spark, piece_rows):
    df = one_second(spark, 600).withColumn("val", F.when(F.col("e") % 7 == 0, F.col("e")))
    order, cut = ["ts", "e"], {"piece_rows": piece_rows}

    def same(a, b, *cols):
        assert sorted(map(repr, a.select(*cols).collect())) == sorted(map(repr, b.select(*cols).collect()))

    same(running_sum(df, ["k"], order, "v", "x", prev_order="ts", plan="window"),
         running_sum(df, ["k"], order, "v", "x", prev_order="ts", **cut), "k", "e", "x", "_prev")
    same(next_in_order(df, ["k"], order, "x", plan="window"), next_in_order(df, ["k"], order, "x", **cut), "k", "e", "x")
    same(last_seen(df, ["k"], order, "val", "x", plan="window"), last_seen(df, ["k"], order, "val", "x", **cut),
         "k", "e", "x")


def test_rows_meet_few_chosen_rows(spark, monkeypatch):
    """Each level lists some FAN chosen rows a piece, not all of a busy bucket, and its pieces are in the whole order."""
    lists, real = [], scan._marks
    monkeypatch.setattr(scan, "FAN", 4)
    monkeypatch.setattr(scan, "_marks", lambda chosen, up: lists.append(real(chosen, up)) or lists[-1])
    df, order = one_second(spark), ["ts", "e"]
    cut = _rows(df, ["k"], order, timedelta(hours=1), 2)
    longest = [marks.agg(F.max(F.size("_marks"))).first()[0] for marks in lists]
    assert len(longest) == scan.LEVELS and max(longest) < 100  # of some 1,500 chosen rows
    pieces = cut.where("k = 'hot'").groupBy("_bucket").agg(F.min(F.struct(*order)).alias("lo"), F.max(F.struct(*order)).alias("hi"))
    bounds = [(r.lo, r.hi) for r in pieces.orderBy("_bucket").collect()]
    flat = [(ts is not None, ts, e) for pair in bounds for ts, e in pair]
    assert len(bounds) > 1000 and flat == sorted(flat)
    a, b = (running_sum(df, ["k"], order, "v", "x", prev_order="ts", plan=p, piece_rows=n) for p, n in (("window", None), ("buckets", 2)))
    assert sorted(map(repr, a.select("k", "e", "x", "_prev").collect())) == sorted(map(repr, b.select("k", "e", "x", "_prev").collect()))


def test_pieces_in_alerts_and_changes(spark):
    df = one_second(spark, 600).select(F.col("k").alias("account"), F.col("v").alias("bytesUsed"), "ts", F.col("e").alias("event_id"))
    e = df.where("ts is not null").withColumns({"quota": F.lit(400).cast("long"), "billingYear": F.lit(2021).cast("long"),
                                                "billingMonth": F.lit(10).cast("long")})
    want = [tuple(r) for r in usage_alerts(e, "event_id", plan="window").collect()]
    assert len(want) == 1 and [tuple(r) for r in usage_alerts(e, "event_id", piece_rows=20).collect()] == want
    near = crossing_rows(e, ["account"], ["ts", "event_id"], "bytesUsed", "quota", lambda s, q: s > q, piece_rows=20)
    assert 0 < running_sum_of(near, ["ts", "event_id"], "bytesUsed", "s").count() < 300
    a, b = (account_total_changes(df, "event_id", plan=p, piece_rows=n) for p, n in (("window", None), ("buckets", 20)))
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
