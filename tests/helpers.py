"""Small literal tables for unit tests."""

from datetime import datetime, timezone

from pyspark.sql import functions as F

USAGE_DDL = "account string, bytesUsed long, ts timestamp, event_id long"
VERSION_DDL = "id string, quota long, ts timestamp"


def t(s: str) -> datetime:
    """UTC instant from ISO text (naive datetimes are read in the session zone, which is UTC)."""
    d = datetime.fromisoformat(s.replace("Z", "+00:00"))
    return d.astimezone(timezone.utc).replace(tzinfo=None) if d.tzinfo else d


def usage(spark, rows):
    """rows: (account, bytesUsed, 'iso time', event_id)."""
    return spark.createDataFrame([(a, b, t(ts), e) for a, b, ts, e in rows], USAGE_DDL)


def versions(spark, rows):
    """rows: (id, quota, 'iso time')."""
    return spark.createDataFrame([(i, q, t(ts)) for i, q, ts in rows], VERSION_DDL)


def rows_of(df, *cols, order=None):
    sel = df.select(*cols) if cols else df
    if order:
        sel = sel.orderBy(*order)
    return [tuple(r) for r in sel.collect()]


def col_sum(df, c):
    return df.agg(F.sum(c)).first()[0]


def write_in_event_order(df, ts: str, path: str, days: int = 7) -> int:
    """Test fixture: one file per ``days`` of event time, oldest first (a one-file-per-trigger stream
    then reads them in event order); returns the file count."""
    from datetime import timedelta

    r = df.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi")).first()
    if r["lo"] is None:
        return 0
    start, n = r["lo"].replace(hour=0, minute=0, second=0, microsecond=0), 0
    while start <= r["hi"]:
        end = start + timedelta(days=days)
        df.where((F.col(ts) >= F.lit(start)) & (F.col(ts) < F.lit(end))).coalesce(1) \
          .write.mode("append").parquet(path)
        n, start = n + 1, end
    return n
