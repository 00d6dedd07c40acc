"""Usage stored as a table bucketed by account, for repeated runs.

A table written with ``bucketBy(n, "account")`` is read back hash-partitioned by account.  That
partitioning satisfies every per-account grouping in the library — totals by account, and the running
usage and alerts by (account, year, month, quota) — so those plans need no shuffle of the usage rows;
the version side of the as-of join is broadcast and keeps the partitioning.  Sorting each bucket by
``(account, ts)`` lets the window's sort work on nearly ordered input.

Rows are rebalanced by account before they are written, so a bucket has one file and not one per task; Spark cuts
what a hot account makes too large into several tasks, hence files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shuffle_partitions


def save_bucketed(usage: DataFrame, table: str, buckets: int | None = None, path: str | None = None,
                  mode: str = "overwrite") -> None:
    """Write ``usage`` as a parquet table bucketed and sorted by account (at ``path`` if given)."""
    n = buckets or shuffle_partitions(usage.sparkSession)
    dealt = usage.hint("rebalance", n, F.col("account"))
    w = dealt.write.mode(mode).format("parquet").bucketBy(n, "account").sortBy("account", "ts")
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)


def read_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)
