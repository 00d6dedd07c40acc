"""Per-account usage totals (batch form) and the change rows of a continuously updated total."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scan import WIDTH, running_sum


def account_totals(usage: DataFrame, total: str = "totalConsumption", as_of: str = "asOf") -> DataFrame:
    """One row per account: sum of ``bytesUsed`` and the latest ``ts``.

    A grouped aggregate: partial sums are formed before the shuffle, so a hot account sends one row per
    input partition, not its rows.  The sum is checked: an overflowing total raises.
    """
    return usage.groupBy("account").agg(F.sum("bytesUsed").alias(total), F.max("ts").alias(as_of))


def account_total_changes(usage: DataFrame, tie: str, total: str = "totalUsage", as_of: str = "asOf",
                          plan: str = "buckets", width: timedelta = WIDTH, piece_rows: int | None = None) -> DataFrame:
    """The change rows an updating per-account total emits, one step per usage row in ``(ts, tie)`` order.

    First row of an account: ``+I``; every later row retracts the previous result (``-U``) and adds
    the new one (``+U``).  A null amount counts as 0.
    """
    run = running_sum(usage, ["account"], ["ts", tie], "bytesUsed", "_total", prev_order="ts",
                      plan=plan, width=width, piece_rows=piece_rows)
    run = run.withColumn("_asof", F.col("ts"))  # in time order the running max of ts is the row's ts
    first = F.col("_prev").isNull()
    steps = F.when(first, F.array(F.struct(F.lit("+I").alias("op"), F.col("_total").alias("t"),
                                           F.col("_asof").alias("a"))))\
             .otherwise(F.array(
                 F.struct(F.lit("-U").alias("op"), (F.col("_total") - F.coalesce("bytesUsed", F.lit(0))).alias("t"),
                          F.col("_prev").alias("a")),
                 F.struct(F.lit("+U").alias("op"), F.col("_total").alias("t"), F.col("_asof").alias("a"))))
    return (run.select("account", "ts", tie, F.explode(steps).alias("s"))
               .select(F.col("s.op").alias("op"), "account", F.col("s.t").alias(total),
                       F.col("s.a").alias(as_of), "ts", tie))
