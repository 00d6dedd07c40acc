import random
from datetime import datetime, timedelta

import pytest

from meterline.operators import enrich_usage, running_usage, usage_alerts
from helpers import t, usage, versions

PLANS = [("window", timedelta(days=1)), ("buckets", timedelta(days=3))]


def hits(spark, urows, vrows, plan, n):
    e = enrich_usage(usage(spark, urows), versions(spark, vrows))
    out = usage_alerts(e, tie="event_id", plan=plan, width=n)
    return sorted((r["ts"], r["account"], r["total"], r["quota"]) for r in out.collect())


Q100 = [("a", 100, "2021-10-01T00:00:00")]


@pytest.mark.parametrize("plan,n", PLANS)
class TestEdgeRows:
    def test_exact_boundary_does_not_alert(self, spark, plan, n):
        assert hits(spark, [("a", 90, "2021-10-02T00:00:00", 1)], Q100, plan, n) == []

    def test_just_above(self, spark, plan, n):
        got = hits(spark, [("a", 90, "2021-10-02T00:00:00", 1), ("a", 1, "2021-10-03T00:00:00", 2)], Q100, plan, n)
        assert got == [(t("2021-10-03T00:00:00"), "a", 91, 100)]

    def test_alert_once_at_first_row(self, spark, plan, n):
        rows = [("a", 95, "2021-10-02T00:00:00", 1), ("a", 10, "2021-10-03T00:00:00", 2),
                ("a", 10, "2021-10-04T00:00:00", 3)]
        assert hits(spark, rows, Q100, plan, n) == [(t("2021-10-02T00:00:00"), "a", 95, 100)]

    def test_quota_change_mid_month_starts_new_total(self, spark, plan, n):
        v = Q100 + [("a", 200, "2021-10-05T00:00:00")]
        rows = [("a", 60, "2021-10-02T00:00:00", 1), ("a", 150, "2021-10-06T00:00:00", 2),
                ("a", 40, "2021-10-07T00:00:00", 3)]
        assert hits(spark, rows, v, plan, n) == [(t("2021-10-07T00:00:00"), "a", 190, 200)]

    def test_quota_going_back_resumes_total(self, spark, plan, n):
        v = Q100 + [("a", 200, "2021-10-05T00:00:00"), ("a", 100, "2021-10-06T00:00:00")]
        rows = [("a", 60, "2021-10-02T00:00:00", 1), ("a", 35, "2021-10-07T00:00:00", 2)]
        assert hits(spark, rows, v, plan, n) == [(t("2021-10-07T00:00:00"), "a", 95, 100)]

    def test_month_change_starts_new_total(self, spark, plan, n):
        rows = [("a", 80, "2021-10-31T12:00:00", 1), ("a", 80, "2021-11-01T00:00:00", 2)]
        assert hits(spark, rows, Q100, plan, n) == []

    def test_zone_edge_stays_in_october(self, spark, plan, n):
        rows = [("a", 50, "2021-10-31T23:59:59.999", 1), ("a", 50, "2021-10-01T00:00:00", 2)]
        assert hits(spark, rows, Q100, plan, n) == [(t("2021-10-31T23:59:59.999"), "a", 100, 100)]

    def test_null_quota_never_alerts(self, spark, plan, n):
        assert hits(spark, [("a", 10**12, "2021-10-02T00:00:00", 1)], [("a", None, "2021-10-01T00:00:00")],
                    plan, n) == []

    def test_equal_times_ordered_by_tie(self, spark, plan, n):
        rows = [("a", 85, "2021-10-02T00:00:00", 2), ("a", 10, "2021-10-02T00:00:00", 1)]
        # tie 1 (10) comes first: 10, then 95 crosses at event 2.
        e = enrich_usage(usage(spark, rows), versions(spark, Q100))
        out = usage_alerts(e, tie="event_id", plan=plan, width=n).collect()
        assert [(r["total"], r["message"]) for r in out] == [
            (95, "WARNING: as of 2021-10-02T00:00:00Z account a has used 95 out of 100 bytes")]


def test_running_usage_zero_bytes_and_totals(spark):
    rows = [("a", 0, "2021-10-02T00:00:00", 1), ("a", 5, "2021-10-03T00:00:00", 2)]
    e = enrich_usage(usage(spark, rows), versions(spark, Q100))
    got = sorted((r["event_id"], r["total"]) for r in running_usage(e, "event_id").collect())
    assert got == [(1, 0), (2, 5)]


def test_overflow_raises(spark):
    rows = [("a", 2**63 - 1, "2021-10-02T00:00:00", 1), ("a", 1, "2021-10-03T00:00:00", 2)]
    e = enrich_usage(usage(spark, rows), versions(spark, [("a", 2**62, "2021-10-01T00:00:00")]))
    with pytest.raises(Exception, match="(?i)overflow"):
        running_usage(e, "event_id").collect()


# --- independent check: a plain loop that adds in event order, like the reference's processor ---

def loop_alerts(urows, vrows, ratio=0.9):
    enriched = []
    for a, b, ts, e in sorted(urows, key=lambda r: (t(r[2]), r[3])):
        cands = [(t(vts), q) for i, q, vts in vrows if i == a and t(vts) <= t(ts)]
        if cands:
            enriched.append((a, b, t(ts), e, max(cands, key=lambda c: c[0])[1]))
    total, alerted, out = {}, set(), []
    for a, b, ts, e, q in enriched:
        k = (a, ts.year, ts.month, q)
        total[k] = total.get(k, 0) + b
        if k not in alerted and q is not None and total[k] > ratio * q:
            alerted.add(k)
            out.append((ts, a, total[k], q))
    return sorted(out)


def random_case(seed):
    rnd = random.Random(seed)
    accounts = ["hot"] * 8 + ["a", "b", "c"]
    base = datetime(2021, 10, 20)
    urows, used = [], set()
    for e in range(300):
        ts = base + timedelta(minutes=rnd.randrange(0, 60 * 24 * 20))
        urows.append((rnd.choice(accounts), rnd.randrange(0, 40), ts.isoformat(), e))
    vrows = []
    for acc in ["hot", "a", "b"]:
        for _ in range(rnd.randrange(1, 5)):
            ts = base + timedelta(minutes=rnd.randrange(-60 * 24 * 5, 60 * 24 * 20))
            if (acc, ts) not in used:
                used.add((acc, ts))
                vrows.append((acc, rnd.choice([100, 300, 1000, None]), ts.isoformat()))
    return urows, vrows


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("plan,n", PLANS)
def test_matches_plain_loop(spark, seed, plan, n):
    urows, vrows = random_case(seed)
    assert hits(spark, urows, vrows, plan, n) == loop_alerts(urows, vrows)


@pytest.mark.parametrize("plan,n", PLANS)
def test_key_without_quota_continues_month_total(spark, plan, n):
    """Optional key without the quota: the month's total runs on across a quota change."""
    v = Q100 + [("a", 200, "2021-10-05T00:00:00")]
    rows = [("a", 60, "2021-10-02T00:00:00", 1), ("a", 150, "2021-10-06T00:00:00", 2)]
    e = enrich_usage(usage(spark, rows), versions(spark, v))
    out = usage_alerts(e, "event_id", key=("account", "billingYear", "billingMonth"), plan=plan, width=n)
    assert [(r["total"], r["quota"]) for r in out.collect()] == [(210, 200)]


@pytest.mark.parametrize("key", [("account", "billingYear", "billingMonth", "quota"),
                                 ("account", "billingYear", "billingMonth")])
def test_candidate_buckets_lose_no_alert(spark, key):
    """Amounts of either sign and null or changing quotas: the bucket plan equals the plain window."""
    rng = random.Random(5)
    start = t("2021-10-01T00:00:00")
    urows = [(f"a{rng.randrange(40)}", rng.choice([rng.randrange(60), -rng.randrange(50)]),
              (start + timedelta(minutes=rng.randrange(60 * 24 * 40))).isoformat(), i) for i in range(1500)]
    vrows = [(f"a{a}", rng.choice([None, 50, 100, 200]), (start + timedelta(days=4 * d)).isoformat())
             for a in range(40) for d in range(10)]
    e = enrich_usage(usage(spark, urows), versions(spark, vrows), strategy="broadcast")
    found = [sorted(map(tuple, usage_alerts(e, "event_id", key=key, plan=p, width=timedelta(hours=30)).collect()))
             for p in ("window", "buckets")]
    assert found[0] == found[1] and len(found[0]) > 20
