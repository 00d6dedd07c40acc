from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from meterline.operators import as_of_join, enrich_usage, version_intervals, version_stats
from helpers import t, usage, versions

STRATEGIES = [("broadcast", "buckets"), ("shuffle", "buckets"), ("merge", "window"), ("merge", "buckets")]


def joined(spark, u, v, strategy, plan):
    out = as_of_join(u, v, values=["quota"], strategy=strategy, plan=plan)
    return sorted((r["event_id"], r["quota"]) for r in out.collect())


@pytest.fixture
def edge(spark):
    u = usage(spark, [
        ("a", 1, "2021-10-01T00:00:00", 1),   # before a's first version: dropped
        ("a", 1, "2021-10-02T00:00:00", 2),   # exactly at the version time: applies
        ("a", 1, "2021-10-03T00:00:00", 3),
        ("a", 1, "2021-10-05T00:00:00", 4),   # after the second version
        ("b", 1, "2021-10-03T00:00:00", 5),   # null quota version: kept with null
        ("zz", 1, "2021-10-03T00:00:00", 6),  # unknown account: dropped
    ])
    v = versions(spark, [("a", 100, "2021-10-02T00:00:00"), ("a", 200, "2021-10-04T00:00:00"),
                         ("b", None, "2021-10-01T00:00:00")])
    return u, v


@pytest.mark.parametrize("strategy,plan", STRATEGIES)
def test_as_of_edge_rows(spark, edge, strategy, plan):
    u, v = edge
    assert joined(spark, u, v, strategy, plan) == [(2, 100), (3, 100), (4, 200), (5, None)]


def test_auto_picks_and_checks(spark, edge):
    u, v = edge
    st = version_stats(v)
    assert (st.rows, st.keys, st.max_per_key, st.unique) == (3, 2, 2, True)
    assert joined(spark, u, v, "auto", "auto") == [(2, 100), (3, 100), (4, 200), (5, None)]


def test_duplicate_versions_need_a_tie(spark):
    u = usage(spark, [("a", 1, "2021-10-03T00:00:00", 1)])
    v = spark.createDataFrame([("a", 100, t("2021-10-02T00:00:00"), 1), ("a", 300, t("2021-10-02T00:00:00"), 2)],
                              "id string, quota long, ts timestamp, seq long")
    with pytest.raises(ValueError):
        as_of_join(u, v, values=["quota"])
    out = as_of_join(u, v, values=["quota"], tie="seq")
    assert [r["quota"] for r in out.collect()] == [300]


@pytest.mark.parametrize("plan", ["window", "buckets"])
def test_intervals(spark, plan):
    v = versions(spark, [("a", 1, "2021-01-01T00:00:00"), ("a", 2, "2021-02-01T00:00:00"),
                         ("a", 3, "2021-03-01T00:00:00"), ("b", 9, "2021-01-05T00:00:00")])
    iv = version_intervals(v, plan=plan)
    got = sorted((r["id"], r["quota"], r["valid_from"], r["valid_to"]) for r in iv.collect())
    assert got == [("a", 1, t("2021-01-01T00:00:00"), t("2021-02-01T00:00:00")),
                   ("a", 2, t("2021-02-01T00:00:00"), t("2021-03-01T00:00:00")),
                   ("a", 3, t("2021-03-01T00:00:00"), None),
                   ("b", 9, t("2021-01-05T00:00:00"), None)]


def test_enrichment_adds_billing_period(spark, edge):
    u, v = edge
    e = enrich_usage(u, v)
    assert {"quota", "billingYear", "billingMonth"} <= set(e.columns)
    assert {(r["billingYear"], r["billingMonth"]) for r in e.collect()} == {(2021, 10)}


def test_hot_account_with_many_versions_merge_buckets(spark):
    # One account holds most rows and many versions: the merge strategy in buckets must equal the
    # interval join, while no slice has to hold the whole account.
    urows = [("hot", i, f"2021-10-01T00:{i // 60:02d}:{i % 60:02d}", i) for i in range(600)]
    urows += [("cold", i, f"2021-10-01T00:00:{i:02d}", 1000 + i) for i in range(20)]
    vrows = [("hot", 10 * k, f"2021-10-01T00:{k:02d}:30") for k in range(10)]
    vrows += [("cold", 5, "2021-09-01T00:00:00")]
    u, v = usage(spark, urows), versions(spark, vrows)
    want = joined(spark, u, v, "broadcast", "auto")
    assert joined(spark, u, v, "merge", "buckets") == want
    assert len(want) == 600 - 30 + 20


def test_typed_enriched_records(spark, edge):
    from meterline.operators import to_enriched_records
    from meterline.schemas import ENRICHED
    u, v = edge
    rec = to_enriched_records(enrich_usage(u, v), keep=("event_id",))
    assert [(f.name, f.dataType) for f in rec.schema.fields][:6] == [(f.name, f.dataType) for f in ENRICHED.fields]
    assert rec.columns[-1] == "event_id" and rec.count() == 4


@pytest.fixture
def dense(spark):
    """An account of 10,000 versions and one of a few; what each usage row must get, by binary search."""
    from bisect import bisect_right
    from datetime import timedelta

    start = t("2021-10-01T00:00:00")
    vrows = [("hot", i, start + timedelta(seconds=60 * i + i % 7)) for i in range(10_000)]
    vrows += [("few", -i, start + timedelta(days=i)) for i in range(1, 4)]
    urows = [(("few", "hot", "zz")[i % 3], i, start + timedelta(seconds=1511 * i - 9000), i) for i in range(500)]
    urows += [("hot", 1, vrows[i][2], 1000 + i) for i in (0, 63, 64, 4095, 4096, 9999)]
    times = {a: [(ts, q) for i, q, ts in vrows if i == a] for a in ("few", "hot", "zz")}
    want = []
    for a, _, ts, e in urows:
        at = bisect_right([x[0] for x in times[a]], ts)
        want += [(e, times[a][at - 1][1])] if at else []
    return (spark.createDataFrame(urows, "account string, bytesUsed long, ts timestamp, event_id long"),
            spark.createDataFrame(vrows, "id string, quota long, ts timestamp"), sorted(want))


@pytest.mark.parametrize("strategy,plan", [("broadcast", "window"), ("shuffle", "buckets")])
def test_many_versions_through_levels(spark, dense, strategy, plan):
    u, v, want = dense
    assert joined(spark, u, v, strategy, plan) == want


def test_many_versions_in_a_stream(spark, dense, tmp_path):
    from meterline.streaming.enrich import enrich_static
    from meterline.streaming.runner import run_to_end

    u, v, want = dense
    u.repartition(2).write.parquet(str(tmp_path / "in"))
    s = spark.readStream.schema(u.schema).parquet(str(tmp_path / "in"))
    run_to_end(enrich_static(s, v), str(tmp_path / "ck"), "append", path=str(tmp_path / "out"))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r["event_id"], r["quota"]) for r in got.collect()) == want


def test_shuffle_join_splits_a_hot_account(spark):
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB"}
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, x in settings.items():
            spark.conf.set(k, x)
        n = 20_000
        u = spark.range(0, n, 1, 8).selectExpr("if(id % 3 = 0, cast(id % 200 as string), 'hot') as account", "id as bytesUsed",
                                               "timestamp_seconds(1600000000 + id) as ts", "id as event_id")
        v = u.select("account").distinct().selectExpr("account as id", "1L as quota", "timestamp_seconds(1) as ts")
        out = as_of_join(u, v, values=["quota"], strategy="shuffle")
        assert len(out.collect()) == n
        assert "SortMergeJoin(skew=true)" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, x in old.items():
            spark.conf.set(k, x)


def test_broadcast_beyond_its_bound_is_a_shuffle_join(spark, edge):
    u, v = edge
    out = as_of_join(u, v, values=["quota"], strategy="broadcast", max_broadcast_rows=2)
    assert "SortMergeJoin" in out._jdf.queryExecution().executedPlan().toString()
    assert sorted((r["event_id"], r["quota"]) for r in out.collect()) == [(2, 100), (3, 100), (4, 200), (5, None)]


def test_wide_values_are_not_broadcast(spark):
    """Few rows may be large: the bound is in bytes too."""
    from meterline.operators.asof import choose_strategy

    v = versions(spark, [("a", 1, "2021-10-01T00:00:00"), ("a", 2, "2021-10-05T00:00:00")])
    narrow, wide = version_stats(v), version_stats(v.withColumn("note", F.repeat(F.lit("x"), 1 << 20)))
    assert narrow.bytes < 200 and wide.bytes > 2 << 20
    assert choose_strategy(narrow) == "broadcast" and narrow.small() and not wide.small(max_bytes=1 << 20)
    assert choose_strategy(replace(wide, bytes=200 << 20)) == "shuffle"
