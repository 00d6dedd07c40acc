"""Running usage per billing key and the one-time warning above a share of the quota (batch form).

The billing key is ``(account, billingYear, billingMonth, quota)``: a quota change starts a new total
and may warn again; returning to an earlier quota continues that quota's total.
"""

from __future__ import annotations

from datetime import timedelta

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.billing import alert_message, over_threshold
from ..schemas import ALERT_RATIO, BILLING_KEY
from .scan import WIDTH, crossing_rows, running_sum, running_sum_of


def running_usage(enriched: DataFrame, tie: str, key: Sequence[str] = BILLING_KEY, plan: str = "buckets",
                  width: timedelta = WIDTH, piece_rows: int | None = None) -> DataFrame:
    """Add ``total``: the key's usage up to and including this row in ``(ts, tie)`` order."""
    return running_sum(enriched, list(key), ["ts", tie], "bytesUsed", "total", plan=plan,
                       width=width, piece_rows=piece_rows)


def usage_alerts(enriched: DataFrame, tie: str, ratio: float = ALERT_RATIO,
                 key: Sequence[str] = BILLING_KEY, plan: str = "buckets",
                 width: timedelta = WIDTH, piece_rows: int | None = None) -> DataFrame:
    """One row per billing key whose total passes ``ratio * quota``: the first row that does.

    Columns ``ts, account, total, quota, message`` plus ``billingYear, billingMonth``.  With time buckets, only
    the rows of the buckets in which a key can pass first get a running total.  The first hit
    is a grouped ``min`` over the hits (combined map-side), so no key's rows meet in one task.

    The default key includes the quota, like the reference: a quota change starts a new total.  With
    ``key=("account", "billingYear", "billingMonth")`` the month's total continues across quota
    changes and each row is compared with the quota in force at its time.
    """
    key = list(key)
    if plan == "window":
        run = running_usage(enriched, tie, key, plan, width)
    else:
        near = crossing_rows(enriched, key, ["ts", tie], "bytesUsed", "quota",
                             lambda total, quota: over_threshold(total, quota, ratio), width, piece_rows)
        run = running_sum_of(near, ["ts", tie], "bytesUsed", "total")
    hits = run.where(over_threshold("total", "quota", ratio))
    carried = [c for c in ("account", "billingYear", "billingMonth", "quota") if c not in key]
    first = hits.groupBy(*key).agg(F.min(F.struct("ts", tie, "total", *carried)).alias("_h"))
    out = first.select(F.col("_h.ts").alias("ts"), *[F.col(k) for k in key],
                       *[F.col(f"_h.{c}").alias(c) for c in carried], F.col("_h.total").alias("total"))
    return out.withColumn("message", alert_message("ts", "account", "total", "quota"))


def billing_state(enriched: DataFrame, tie: str, ratio: float = ALERT_RATIO, key: Sequence[str] = BILLING_KEY) -> DataFrame:
    """``key, total, alerted``: where each billing key stands after the given usage, from which a stream can go on.

    Null amounts count as 0; ``alerted`` holds if the key has passed ``ratio * quota`` at any row, so it never
    warns again.
    """
    key = list(key)
    totals = enriched.groupBy(*key).agg(F.sum(F.coalesce("bytesUsed", F.lit(0))).cast("long").alias("total"))
    passed = usage_alerts(enriched, tie, ratio, key).select(*[F.col(k).alias(f"_{k}") for k in key], F.lit(True).alias("_passed"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key]
    return totals.join(passed, same, "left").select(*key, "total", F.coalesce("_passed", F.lit(False)).alias("alerted"))
