"""Streaming usage alerts through a carry table instead of keyed state: no account's rows meet in one call.

Each micro-batch is an ordinary batch run.  The billing keys it touches begin with the total and flag that the earlier
batches left (the carry), :func:`~meterline.operators.alerts.usage_alerts` does the rest, with its time buckets, so a
hot account spreads over tasks; then the new totals and flags are written.  The result is that of the keyed processor
(:mod:`meterline.streaming.alerts`) without Python at rows.

Batch ``n`` writes its alerts to ``out/batch_id=n`` and the keys it touched to ``state/delta/batch_id=n``; every
``compact``-th batch writes all keys to ``state/full/batch_id=n``.  It reads only folders of earlier batches: the last full
one and the deltas after it, which their numbers tell.  So a batch that is run again, after a failure at any
point, overwrites its own folders with the same rows and nothing is counted twice.  Folders before the last full one
may be removed from time to time; this module removes none.

Null amounts count as 0; rows with equal times are ordered by the tie.  A batch may come in any event order, as with the
processor: totals follow the order within a batch and the order of batches.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.alerts import usage_alerts
from ..operators.scan import WIDTH
from ..schemas import ALERT_RATIO, BILLING_KEY
from .runner import BATCH

COMPACT = 32        # batches from one full carry table to the next


class CarriedAlerts:
    """A ``foreachBatch`` sink for enriched usage (``account, bytesUsed, ts, tie, quota, billingYear, billingMonth``).

    ``initial`` takes over from a batch run: rows of :func:`~meterline.operators.alerts.billing_state`.
    """

    def __init__(self, out: str, state: str, tie: str, ratio: float = ALERT_RATIO, key: Sequence[str] = BILLING_KEY,
                 width: timedelta = WIDTH, piece_rows: int | None = None, compact: int = COMPACT,
                 initial: DataFrame | None = None):
        if compact < 1:
            raise ValueError("compact must be at least 1")
        self.out, self.state, self.tie, self.ratio, self.key = out, state, tie, ratio, list(key)
        self.width, self.piece_rows, self.compact, self.initial = width, piece_rows, compact, initial

    def _key_schema(self, rows: DataFrame) -> str:
        return ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in self.key)

    def _join(self, left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        """Joins by key; a null quota equals a null quota."""
        right = right.withColumnsRenamed({k: f"_{k}" for k in self.key})
        right = right.select(*[F.col(c).alias(c) for c in right.columns])    # both sides may stem from the same rows
        same = F.lit(True)
        for k in self.key:
            same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
        return left.join(right, same, how)

    def carry(self, spark: SparkSession, schema: str, batch_id: int) -> DataFrame:
        """``key, total, alerted`` of every key as the batches before ``batch_id`` left it."""
        full = batch_id - 1 - batch_id % self.compact       # the last full table, if there is one
        read = spark.read.schema(f"{schema}, total long, alerted boolean")
        parts = [read.parquet(f"{self.state}/full/{BATCH}={full}").withColumn("_at", F.lit(full))] if full >= 0 else []
        if full < 0 and self.initial is not None:
            parts.append(self.initial.select(*self.key, "total", "alerted").withColumn("_at", F.lit(-1)))
        for n in range(full + 1, batch_id):
            parts.append(read.parquet(f"{self.state}/delta/{BATCH}={n}").withColumn("_at", F.lit(n)))
        if not parts:
            return spark.createDataFrame([], f"{schema}, total long, alerted boolean")
        log = parts[0]
        for part in parts[1:]:
            log = log.unionByName(part)
        latest = log.groupBy(*self.key).agg(F.max_by(F.struct("total", "alerted"), "_at").alias("_s"))
        return latest.select(*self.key, "_s.total", "_s.alerted")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, zero = batch.sparkSession, F.lit(0).cast("long")
        columns = [*dict.fromkeys(["account", "ts", self.tie, "quota", "billingYear", "billingMonth", *self.key])]
        rows = batch.select(*columns, F.coalesce(F.col("bytesUsed").cast("long"), zero).alias("bytesUsed")).persist()
        try:
            schema = self._key_schema(rows)
            before = self.carry(spark, schema, batch_id)
            new = rows.groupBy(*self.key).agg(F.sum("bytesUsed").alias("_part"))
            touched = self._join(new, before, "left").select(
                *self.key, "_part", F.coalesce("total", zero).alias("_prior"),
                F.coalesce("alerted", F.lit(False)).alias("_alerted"))
            # A key's carry is a row before all others: without a time and tie, nulls come first.
            empty = {c: F.lit(None).cast(rows.schema[c].dataType) for c in columns if c not in self.key}
            carried = touched.where(~F.col("_alerted")).withColumns(empty).select(
                *columns, F.col("_prior").alias("bytesUsed"))
            alerts = usage_alerts(rows.unionByName(carried), self.tie, self.ratio, self.key, width=self.width,
                                  piece_rows=self.piece_rows)
            done = touched.where("_alerted").select(*self.key)
            folder = f"{self.out}/{BATCH}={batch_id}"
            self._join(alerts, done, "left_anti").write.mode("overwrite").parquet(folder)
            passed = spark.read.schema(schema).parquet(folder).withColumn("_hit", F.lit(True))
            delta = self._join(touched, passed, "left").select(
                *self.key, (F.col("_prior") + F.col("_part")).alias("total"),
                (F.col("_alerted") | F.coalesce("_hit", F.lit(False))).alias("alerted"))
            folder = f"{self.state}/delta/{BATCH}={batch_id}"
            delta.write.mode("overwrite").parquet(folder)
            if batch_id % self.compact == self.compact - 1:
                whole = self.carry(spark, schema, batch_id)
                latest = spark.read.schema(f"{schema}, total long, alerted boolean").parquet(folder)
                rest = self._join(whole, latest, "left_anti")
                rest.unionByName(latest).write.mode("overwrite").parquet(f"{self.state}/full/{BATCH}={batch_id}")
        finally:
            rows.unpersist()


def carried_alerts_writer(out: str, state: str, tie: str, **options) -> Callable[[DataFrame, int], None]:
    """The sink as a function for :func:`~meterline.streaming.runner.start`; options are those of the class."""
    return CarriedAlerts(out, state, tie, **options)
