"""Property checks against plain Python."""

from datetime import datetime, timedelta

from hypothesis import given, settings
from hypothesis import strategies as st

from meterline.functions import account_id, instant_text

EPOCH = datetime(1970, 1, 1)


def java_instant_text(d: datetime) -> str:
    """Instant.toString: seconds always, the fraction in groups of three digits only when non-zero."""
    base = d.strftime("%Y-%m-%dT%H:%M:%S")
    us = d.microsecond
    if us == 0:
        return base + "Z"
    if us % 1000 == 0:
        return f"{base}.{us // 1000:03d}Z"
    return f"{base}.{us:06d}Z"


@settings(max_examples=1, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=4_102_444_800_000_000), min_size=50, max_size=50),
       st.lists(st.integers(min_value=0, max_value=10**9), min_size=50, max_size=50))
def test_instant_text_and_account_id(spark, micros, ids):
    # One Spark job checks a batch of generated values (examples are costly, values are cheap).
    micros = micros + [0, 1000, 160_000, 160_001, 999_999]
    rows = [(EPOCH + timedelta(microseconds=m), i) for m, i in zip(micros, ids + [7] * 5)]
    df = spark.createDataFrame(rows, "ts timestamp, n long")
    got = df.select(instant_text("ts").alias("t"), account_id("n").alias("a")).collect()
    for (ts, n), r in zip(rows, got):
        assert r["t"] == java_instant_text(ts)
        assert r["a"] == f"{n:06d}"
